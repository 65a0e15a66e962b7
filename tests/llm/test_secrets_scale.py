"""A table's size moves no threshold."""

import random
import string

import pytest
from pyspark.sql import functions as F

from bulwark.llm import secrets
from tests.llm.test_secrets import corpus, spans


@pytest.mark.parametrize("copies", [20, 100])
def test_repeated_table_keeps_its_spans(spark, copies):
    rng = random.Random(5)
    rows = corpus(rng, 60)
    for i in range(200):
        rows.append((100 + i, "use " + "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(rng.randrange(16, 20))) + " now"))
        rows.append((400 + i, "use " + "".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randrange(16, 40))) + " now"))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    once = {r["doc_id"]: spans(r) for r in secrets.scan(df, ordinary_rows=len(rows)).collect()}
    many = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    found = secrets.scan(many, ordinary_rows=len(rows)).collect()
    assert len(found) == copies * len(rows)
    assert not [r["doc_id"] for r in found if spans(r) != once[r["doc_id"]]]


def test_running_totals_and_places_apart(spark):
    rng = random.Random(4)
    rows = []
    for n in (0, 1, 63, 64, 65, 200, 5000):
        starts = sorted(rng.sample(range(4 * n + 1), n))
        tokens = [(a, rng.randrange(a + 1, b + 1)) for a, b in zip(starts, [*starts[1:], 4 * n + 9])]
        base = sorted((rng.randrange(4 * n + 1), 0, 0) for _ in range(n // 5))
        base = [(a, k, a + rng.randrange(1, 12)) for a, k, _ in base]
        rows.append((n, [rng.randrange(9) for _ in range(n)], tokens, base))
    df = spark.createDataFrame(rows, "n int, v array<int>, t array<struct<start: bigint, end: bigint>>, b array<struct<start: bigint, kind: int, end: bigint>>")
    got = df.select("n", secrets.running(F.col("v"), lambda x, y: x + y).alias("s"), secrets.running(F.col("v"), lambda x, y: F.greatest(x, y)).alias("m"),
                    secrets.apart(F.col("t"), F.col("b")).alias("free")).collect()
    for r, (_, v, tokens, base) in zip(sorted(got, key=lambda r: r["n"]), rows):
        assert r["s"] == [sum(v[: i + 1]) for i in range(len(v))] and r["m"] == [max(v[: i + 1]) for i in range(len(v))]
        assert [tuple(x) for x in r["free"]] == [t for t in tokens if not any(a < t[1] and t[0] < b for a, _, b in base)]


def test_markov_spans_follow_the_plain_model(spark):
    """Ratios, threshold and spans as a plain program has them."""
    import math
    import re
    from collections import Counter

    rng = random.Random(6)
    rows = corpus(rng, 50)
    rows += [(100 + i, "see " + "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(rng.randrange(8, 30))) + " now") for i in range(80)]
    rows += [(300, "token=" + "".join(rng.choice("0123456789abcdef") for _ in range(30)) + "/and more"), (301, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: spans(r) for r in secrets.scan(df, ordinary_rows=10**6).collect()}

    token = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{8,}")
    from tests.llm.test_secrets import BASE, base

    plain = {i: [m for m in token.finditer(t) if not any(a < m.end() and m.start() < b for a, _, b in base(t))] for i, t in rows}
    values = {i: [m[2] if k == 0 else m[0] for k, (p, ok) in enumerate(BASE) for m in p.finditer(t) if ok(m)] for i, t in rows}
    pair = lambda t: [(secrets.ALPHABET.find(t[j - 1]) + 1 if j else 0) * secrets.WIDTH + secrets.ALPHABET.find(c) + 1 for j, c in enumerate(t)]
    distinct = {t: i for i, t in rows}.values()
    counts = {True: Counter(p for i in distinct for v in values[i] for p in pair(v)), False: Counter(p for i in distinct for m in plain[i] for p in pair(m[0]))}
    table = secrets.ratios(counts)
    least = max(0.0, math.log(sum(map(len, plain.values())) / sum(map(len, values.values())))) + math.log(1000.0)
    for i, t in rows:
        want = [(m.start(), 3, m.end()) for m in plain[i] if len(m[0]) >= 16 and sum(table[p] for p in pair(m[0])) > least]
        assert [s for s in found[i] if s[1] == 3] == want
    assert sum(s[1] == 3 for f in found.values() for s in f) > 5
