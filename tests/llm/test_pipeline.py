import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from bulwark.llm import decontaminate
from tests.llm import plain

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, sf):
    """A sample folder's documents with planted rows, written as a folder of tables."""
    from bulwark.session import scratch_path

    folder = scratch_path(spark, "planted")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    long = docs.where("length(text) > 1500 and lang = 'en'").orderBy("doc_id").limit(3).collect()
    item = bench.orderBy("item_id").first()["text"]
    near = long[0]["text"].split(" ")
    near[10] = "changedword"
    planted = [(10_001, long[0]["text"]), (10_002, " ".join(near)), (10_003, long[1]["text"] + " " + item), (10_004, None), (10_005, ""),
               (10_006, "1234 5678 !!"), (10_007, item)]
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in planted]
    docs.unionByName(spark.createDataFrame(rows, docs.schema)).write.parquet(f"{folder}/documents.parquet")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    return folder, item


def test_stages(spark, corpus):
    folder, item = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]

    def step(f, given):
        out = f(spark, spark.createDataFrame(given, docs.schema), folder)
        return out, out.collect()

    out, kept = step(cp.language_id, list(before.values()))
    assert out.columns == COLUMNS
    assert {r["doc_id"] for r in kept} == set(before) - {10_004, 10_005, 10_006}

    out, single = step(cp.near_dedup, kept)
    assert out.columns == COLUMNS
    want = plain.components([(r["doc_id"], plain.shingles(r["text"], 5)) for r in kept])
    assert sorted(r["doc_id"] for r in single) == sorted(i for i, c in want.items() if i == c)
    assert not {10_001, 10_002} & {r["doc_id"] for r in single}

    out, clean = step(cp.decontamination, single)
    assert out.columns == COLUMNS and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    texts = {r["doc_id"]: r["text"] for r in clean}
    assert 10_007 not in texts and item not in texts.get(10_003, "")
    held = decontaminate.occurrences(spark.createDataFrame(clean, docs.schema).select("doc_id", "text"), spark.read.parquet(f"{folder}/benchmark.parquet"))
    hit = {r["doc_id"] for r in decontaminate.occurrences(spark.createDataFrame(single, docs.schema).select("doc_id", "text"), spark.read.parquet(f"{folder}/benchmark.parquet")).where(F.size("spans") > 0).collect()}
    assert held.where(F.size("spans") > 0).isEmpty()
    assert all(texts[r["doc_id"]] == r["text"] for r in single if r["doc_id"] not in hit)
    assert all(r["n_chars"] == len(r["text"]) for r in clean)

    out, mixed = step(cp.mixture, clean)
    assert out.columns == COLUMNS
    assert {r["doc_id"] for r in mixed} == set(texts)
    assert max(sum(r["doc_id"] == i for r in mixed) for i in texts) <= 2

    out, placed = step(cp.shards, mixed)
    assert out.columns == [*COLUMNS, "shard", "slot"] and len(placed) == len(mixed)
    slots = {}
    for r in placed:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_and_registration(spark, corpus):
    import __spark_entry__ as entry

    folder, _ = corpus
    out = entry.queries()["pipeline"](spark, folder)
    assert out.columns == [*COLUMNS, "shard", "slot"]
    ids = {r["doc_id"] for r in out.select("doc_id").collect()}
    assert not ids & {10_001, 10_002, 10_004, 10_005, 10_006, 10_007}
    assert [sum(n.startswith(f"op{i}_") for n in entry.queries()) for i in range(1, 11)] == [1] * 10


def test_extra_columns_with_an_operator_s_names_pass_through(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    more = docs.withColumns({c: F.lit(7) for c in ("score", "rejected", "epoch", "block", "weight", "spans", "items", "id", "h", "kept", "__text")})
    for name, f in cp.STAGES:
        out = f(spark, more, sf)
        assert out.columns[: len(more.columns)] == more.columns, name
        assert out.where("score <> 7 or rejected <> 7 or epoch <> 7 or block <> 7 or weight <> 7 or spans <> 7 or items <> 7 or id <> 7 or h <> 7 or kept <> 7").isEmpty()
        assert 0 < out.count() <= 120


def test_nulls_and_empty_table_pass_every_stage(spark, sf):
    rng = random.Random(1)
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    rows = [(None, plain.words_of(rng, 20), None, None, None), (5, plain.words_of(rng, 20), None, None, 3), (5, "x y", "en", None, None), (5, "x y", "en", None, None)]
    for name, f in cp.STAGES:
        out = f(spark, spark.createDataFrame(rows, schema), sf)
        assert out.columns[:5] == COLUMNS, name
        n = out.count()
        assert n <= 4 or name == "mixing" and n <= 8
        assert f(spark, spark.createDataFrame([], schema), sf).count() == 0
