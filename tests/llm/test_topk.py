import math
import random

import pytest
from pyspark.sql import functions as F

from bulwark.llm import topk
from tools.check import compare

ROWS = "vec_id long, embedding array<float>"


def brute(rows, k, every):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width, out = max((len(v) for _, v in ok), default=0), set()
    ok = [(i, v + [0] * (width - len(v))) for i, v in ok]
    for q in {i for i, _ in ok if i % every == 0}:
        mine = min(v for i, v in ok if i == q)
        best = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in ok if i != q)[:k]
        out |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
    return out


def asked(spark, rows, k=20, every=20):
    df = spark.createDataFrame([(*r, 1) for r in rows], ROWS + ", score int")
    return {tuple(r) for r in topk.top_k(df, F.col("vec_id") % every == 0, k=k).collect()}


def as_float(x):
    return None if x is None else float(__import__("numpy").float32(x))


@pytest.mark.parametrize("lane, part", [(32768, 2048), (100, 7)])
def test_matches_brute_force(spark, monkeypatch, lane, part):
    monkeypatch.setattr(topk, "LANE_ROWS", lane)
    monkeypatch.setattr(topk, "LANE_QUERIES", part)
    rng = random.Random(4)
    centres = [[rng.gauss(0, 0.3) for _ in range(16)] for _ in range(6)]
    rows = [(i, [as_float(x + rng.gauss(0, 0.05)) for x in centres[i % 6]]) for i in range(900)]
    rows += [(i, [as_float(x) for x in centres[0]]) for i in range(900, 1300)]  # ties
    rng.shuffle(rows)
    assert asked(spark, rows) == brute(rows, 20, 20)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, [0.5]), (None, [1.0, 1.0]),
            (20, [-3.0, 100.0]), (20, [-3.0, 100.0]), (21, []), (22, [3.0e6, -2.0e6])]
    got = topk.top_k(spark.createDataFrame(rows, ROWS), F.col("vec_id") % 20 == 0).collect()
    assert sorted(tuple(r) for r in got) == sorted(
        (q, n, i, s) for q, mine in ((0, [64, 128]), (20, [-192, 6400]))
        for n, (s, i) in enumerate(sorted(((sum(a * b for a, b in zip(mine, v)), i) for i, v in (
            (0, [64, 128]), (5, [32, 0]), (20, [-192, 6400]), (20, [-192, 6400]), (21, [0, 0]), (22, [192000000, -128000000])) if i != q),
            key=lambda p: (-p[0], p[1])), 1)
    )
    assert topk.top_k(spark.createDataFrame([], ROWS), F.col("vec_id") % 20 == 0).count() == 0


def test_registered_query_matches_sql(spark, sf, duck):
    from bulwark.llm.queries import QUERIES, SQL

    assert compare(QUERIES["op2_topk_block_pruning"](spark, sf), duck, SQL["op2_topk_block_pruning"]) == ""


def test_clustered_sparse_vectors_skip_most_blocks(monkeypatch):
    """Each cluster has its own dimensions: a query scores the blocks of its cluster, and few besides."""
    np = topk.np
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(1)
    rows = np.zeros((40 * 128, 160), np.int64)
    for i in range(len(rows)):
        rows[i, 4 * (i // 128) : 4 * (i // 128) + 4] = rng.integers(20, 60, 4)
    ids = rng.permutation(len(rows))
    at, score, visited = topk.best_of(rows[::50], ids[::50], rows, ids, 20)
    product = rows[::50] @ rows.T
    product[np.arange(len(product)), np.arange(0, len(rows), 50)] = -1
    assert (score == -np.sort(-product, axis=1)[:, :20]).all()
    assert visited.mean() < 0.15 * (len(rows) / 64)
