import random
import zlib

from pyspark.sql import functions as F

from bulwark.llm import sharding

ROWS = "doc_id long, text string"


def placed(df, shards=16, **more):
    return sharding.range_shards(df, F.xxhash64("text"), F.xxhash64("doc_id"), sharding.text_size(F.col("text")), shards=shards, **more)


def test_shards_hold_near_equal_bytes_and_slots_have_no_gaps(spark):
    rng = random.Random(1)
    rows = [(i, "x" * int(rng.paretovariate(1.2) * 20)) for i in range(3000)] + [(i, "hot" * 30) for i in range(3000, 5000)]
    rows += [(5001, None), (5002, ""), (None, "no id"), (None, "no id"), (7, "again"), (7, "again")]
    rows = [(i, t if t is None else t[:6000]) for i, t in rows]
    out = placed(spark.createDataFrame(rows, ROWS)).collect()
    assert len(out) == len(rows)
    size = lambda t: len((t or "").encode()) + 1
    total, held, slots = sum(size(t) for _, t in rows), [0] * 16, [[] for _ in range(16)]
    for r in out:
        held[r["shard"]] += size(r["text"])
        slots[r["shard"]].append(r["slot"])
    largest = max(size(t) for _, t in rows)
    assert all(abs(b - total / 16) <= 2 * (2 * total / 1024 + largest) for b in held)
    assert all(sorted(s) == list(range(len(s))) for s in slots)


def test_equal_texts_stay_together_unless_they_fill_a_range(spark):
    rows = [(i, f"text {i // 3} " + "y" * 50) for i in range(6000)]
    out = placed(spark.createDataFrame(rows, ROWS)).groupBy("text").agg(F.countDistinct("shard").alias("n"))
    assert out.where("n > 1").isEmpty()


def test_few_rows_many_shards_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", "old"), (2, "b", "old"), (3, "c", "old")], ROWS + ", SHARD string")
    out = placed(df)
    assert out.columns == ["doc_id", "text", "shard", "slot"]
    rows = out.collect()
    assert len(rows) == 3 and {r["slot"] for r in rows} == {0}
    assert placed(df.limit(0)).count() == 0


def test_same_places_however_the_rows_are_dealt(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 700).alias("text"))
    a, b = (placed(df.repartition(n)).select("doc_id", "shard", "slot") for n in (1, 7))
    assert a.exceptAll(b).isEmpty()


def test_registered_query(spark, sf):
    from bulwark.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op1_sampled_splitters"](spark, sf).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and {r["law"] for r in rows} == {"bytes"}
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), None)


def test_a_row_repeated_for_half_the_table_is_dealt_out(spark):
    rng = random.Random(2)
    rows = [(1, "repeated row " * 3)] * 1000 + [(i, "z" * rng.randrange(10, 70)) for i in range(2, 1002)]
    rng.shuffle(rows)
    out = placed(spark.createDataFrame(rows, ROWS)).collect()
    held, slots = [0] * 16, [[] for _ in range(16)]
    for r in out:
        held[r["shard"]] += len(r["text"]) + 1
        slots[r["shard"]].append(r["slot"])
    total = sum(held)
    assert len(out) == 2000 and all(sorted(s) == list(range(len(s))) for s in slots)
    assert all(abs(b - total / 16) <= 2 * (2 * total / 1024) + 71 for b in held)
    assert len({r["shard"] for r in out if r["doc_id"] == 1}) >= 7


def test_registered_query_is_balanced_and_gapless(spark, sf):
    from bulwark.llm.queries import QUERIES

    out = QUERIES["op1_sampled_splitters"](spark, sf).collect()
    held, slots = [0] * 16, [[] for _ in range(16)]
    for r in out:
        held[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    total, largest = sum(held), max(r["size"] for r in out)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert all(abs(b - total / 16) <= 2 * max(2 * total / 1024, largest) for b in held)
