import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from bulwark.llm import contentsort
from tools.check import compare

ROWS = "doc_id long, text string"


def brute(rows, largest=True):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max if largest else min)(known) if known else None
        sha = hashlib.sha256(t.encode()).hexdigest()
        left = True
        for i in ids:
            kept, left = (i == keep and left), (left and i != keep)
            out.append((i, keep, len(ids), kept, sha))
    return sorted(out, key=str)


def found(spark, rows, schema=ROWS, **how):
    got = contentsort.exact_groups(spark.createDataFrame(rows, schema), "doc_id", "text", **how)
    return sorted((tuple(r) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def varied(n=1500, seed=3):
    rng = random.Random(seed)
    rows = [(i, "x " * rng.randrange(200) + str(rng.randrange(300))) for i in range(n)]
    rows += [(n + i, "hot text " * 40) for i in range(n // 2)]  # a third of all rows
    rows += [(2 * n + i, "same beginning of more than thirty-two bytes " * 3 + str(i % 50)) for i in range(400)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("range_bytes", [1 << 30, 20_000, 2_000])
@pytest.mark.parametrize("largest", [True, False])
def test_matches_brute_force(spark, range_bytes, largest):
    rows = varied()
    assert found(spark, rows, range_bytes=range_bytes, keep_largest=largest) == brute(rows, largest)


def test_texts_alike_in_head_and_hash(spark, monkeypatch):
    """Splitters only place rows; what is equal is decided on whole texts."""
    rows = varied(500)
    monkeypatch.setattr(contentsort, "HEAD_BYTES", 0)
    monkeypatch.setattr(contentsort.F, "xxhash64", lambda *c: F.length("text").cast("long") * 0 if c == ("text",) else F.hash(*c).cast("long"))
    assert found(spark, rows, range_bytes=5_000) == brute(rows)


@pytest.mark.parametrize("range_bytes", [1 << 30, 1_000])
def test_odd_rows(spark, range_bytes):
    rows = [(1, None), (2, ""), (None, None), (None, "only"), (None, "only"), (5, "a"), (5, "a"), (4, "a"), (6, "A"), (7, "a "), (8, "é"), (9, "é")]
    rows += [(10 + i, "long " * 3000) for i in range(7)] + [(3, "repeated")] * 300
    assert found(spark, rows, range_bytes=range_bytes) == brute(rows)
    assert found(spark, [], range_bytes=range_bytes) == []


def test_repeated_rows_are_spread(spark):
    """Rows alike in id and text still fill several ranges."""
    rows = [(1, "again and again " * 20)] * 2000 + [(i, f"other {i} " * 20) for i in range(2, 2000)]
    df = spark.createDataFrame(rows, ROWS)
    seen = []
    kept = contentsort.checkpointed
    try:
        contentsort.checkpointed = lambda d: seen.append(kept(d)) or seen[-1]
        contentsort.exact_groups(df, "doc_id", "text", range_bytes=64_000).count()
    finally:
        contentsort.checkpointed = kept
    sizes = [r["count"] for r in seen[0].groupBy("part").count().collect()]
    assert max(sizes) < 4 * sum(sizes) / len(sizes)


def test_clashing_names_and_normal_form(spark):
    rows = [(1, "Ab", 7, "x", 0.5), (2, "aB", 8, "y", 0.25)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part int, `run` string, Kept double")
    got = contentsort.exact_groups(df, "doc_id", "text", normalised=F.lower)
    assert got.columns == ["doc_id", "part", "run", "keep_id", "group_size", "kept", "text_sha256"]
    assert [(r["doc_id"], r["part"], r["run"], r["keep_id"], r["group_size"], r["kept"]) for r in got.orderBy("doc_id").collect()] == [
        (1, 7, "x", 2, 2, False), (2, 8, "y", 2, 2, True)]


def test_registered_query_matches_sql(spark, sf, duck):
    from bulwark.llm.queries import QUERIES, SQL

    assert compare(QUERIES["op13_content_sort"](spark, sf), duck, SQL["op13_content_sort"]) == ""
