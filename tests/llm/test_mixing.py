import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from bulwark.llm import mixing

ROWS = "doc_id long, text string, source string"


def tokens(t):
    return len(re.findall("[^\x20\x09-\x0D]+", t or "")) + 1


def rows():
    rng = random.Random(6)
    sizes = {"a": 900, "b": 60, "c": 25, None: 4, "d": 300}
    out = [(s, " ".join("w" * rng.randrange(1, 40))) for s, n in sizes.items() for _ in range(n)]
    return [(i, t, s) for i, (s, t) in enumerate(out)] + [(5000, None, "a"), (5001, "", "b"), (None, "x y", "a"), (1, "again", "a")]


def brute(given, plan, blocks):
    """Every copy taken: (doc_id, text, source, epoch, block), from the plan's exponent and budget."""
    n = {}
    for _, t, s in given:
        n[s] = n.get(s, 0) + tokens(t)
    power = {s: (c / max(n.values())) ** plan.exponent for s, c in n.items()}
    out = []
    for s, c in n.items():
        want = max(c, math.ceil(power[s] / sum(power.values()) * plan.budget - 1e-6))
        for e in range(-(-want // c)):
            begin = e * c
            key = lambda r: hashlib.md5(f"mix:{'' if r[0] is None else r[0]}:{e}".encode()).hexdigest()  # noqa: B023, E731
            for i, t, _ in sorted((r for r in given if r[2] == s), key=key):
                if begin < want:
                    out.append((i, t, s, e, begin * blocks // want))
                begin += tokens(t)
    return out


@pytest.mark.parametrize("entropy, repeats", [(None, 2.0), (0.9, None), (0.99, 3.0), (None, None)])
def test_copies_match_plain_permutations(spark, entropy, repeats):
    given = rows()
    df = spark.createDataFrame([(*r, 1) for r in given], ROWS + ", Block int")
    out, plan = mixing.mix(df, F.col("source"), entropy=entropy, repeats=repeats, blocks=16)
    assert out.columns[:3] == ["doc_id", "text", "source"] and set(out.columns[3:]) == {"epoch", "block", "weight"}
    order = lambda r: tuple(map(str, r))
    got = sorted((tuple(r[c] for c in ("doc_id", "text", "source", "epoch", "block")) for r in out.collect()), key=order)
    want = sorted(brute(given, plan, 16), key=order)
    # rows that share an id have the same place in a permutation, so their blocks may change hands
    loose = lambda rs: [r for r in rs if r[0] != 1]
    assert loose(got) == loose(want) and len(got) == len(want)
    assert {r[:3] for r in given if r} <= {r[:3] for r in got}


def test_exponent_meets_its_target(spark):
    n = [5000, 900, 300, 40]
    totals = spark.createDataFrame([(x,) for x in n], "n long")
    share = lambda a: [x**a / sum(y**a for y in n) for x in n]
    entropy = lambda p: -sum(x * math.log(x) for x in p) / math.log(len(p))
    plan = mixing.fit_exponent(totals, 0.9, None)
    assert entropy(share(plan.exponent)) == pytest.approx(0.9, abs=1e-4)
    plan = mixing.fit_exponent(totals, None, 4.0)
    w = share(plan.exponent)
    assert max(x * plan.budget / y for x, y in zip(w, n)) == pytest.approx(4.0, rel=0.01)
    assert min(x * plan.budget / y for x, y in zip(w, n)) >= 0.999
    assert mixing.fit_exponent(totals, None, 1.0).exponent == 1.0
    assert mixing.fit_exponent(totals.limit(0), 0.9, 2.0).sources == 0


def test_blocks_hold_the_mixture(spark):
    df = spark.createDataFrame([(i, "w " * 20, "a" if i % 10 else "b") for i in range(4000)], ROWS)
    out, plan = mixing.mix(df, F.col("source"), repeats=2.0, blocks=8)
    share = {r["block"]: r["b"] for r in out.groupBy("block").agg(F.avg((F.col("source") == "b").cast("int")).alias("b")).collect()}
    want = out.select("weight").where("source = 'b'").first()[0]
    assert len(share) == 8 and all(s == pytest.approx(want, abs=0.02) for s in share.values())


def test_smaller_budget_and_empty_table(spark):
    df = spark.createDataFrame(rows(), ROWS)
    out, _ = mixing.mix(df, F.col("source"), repeats=2.0, budget=400)
    taken = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(mixing.tokens(F.col("text"))).alias("n")).collect()}
    assert 400 <= sum(taken.values()) <= 400 + 5 * 42
    assert mixing.mix(df.limit(0), F.col("source"))[0].count() == 0


def test_budgets_below_a_token(spark):
    given = [(i, "x y z", "big") for i in range(40)] + [(100, "x", "small")]
    df = spark.createDataFrame(given, ROWS)
    assert mixing.mix(df, F.col("source"), budget=0)[0].count() == 0
    one = mixing.mix(df, F.col("source"), budget=1)[0].groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in one} == {"big": 1, "small": 1}
    # the small source's part is below a millionth of a token
    few = spark.createDataFrame([(i, "w " * 50_000, "big") for i in range(60)] + [(100, None, "small")], ROWS)
    got = mixing.mix(few, F.col("source"), repeats=1.0, budget=1)[0].collect()
    assert {r["source"] for r in got} == {"big"} and min(r["epoch"] for r in got) == 0
