import random

import pytest
from pyspark.sql import functions as F

from bulwark.llm import neardup
from tests.llm import plain

ROWS = "doc_id long, text string"


def check(spark, rows, width):
    got = {r["doc_id"]: r for r in neardup.near_duplicates(spark.createDataFrame(rows, ROWS), width=width).collect()}
    sets = [(i, plain.shingles(t, width)) for i, t in rows]
    want = plain.components(sets)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets}
    assert {i for i, r in got.items() if r["kept"]} == {i for i, c in want.items() if i == c}


@pytest.mark.parametrize("width", [2, 5])
def test_components_match_all_pairs(spark, width):
    rng = random.Random(3)
    rows = []
    for _ in range(12):  # families of copies, near copies and chains of edits
        base = plain.words_of(rng, rng.choice([3, 12, 60, 200])).split()
        for _ in range(rng.randrange(1, 9)):
            rows.append(" ".join(base))
            edited = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 15)):
                edited[rng.randrange(len(edited))] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(edited).upper())
            if rng.random() < 0.5:
                base = edited
    rows += ["", "   ", None, "one", "ONE", "two words", "two\twords ", plain.words_of(rng, 30_000)]
    rng.shuffle(rows)
    check(spark, list(enumerate(rows, 100)), width)


def test_documents_that_share_a_passage_but_not_enough_stay_apart(spark):
    rng = random.Random(5)
    passage = plain.words_of(rng, 60)
    check(spark, [(i, passage + " " + plain.words_of(rng, 25)) for i in range(40)], 2)


def test_null_ids_repeated_ids_and_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "q r s t"), (2, None), (3, "z")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, ROWS), width=2).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, True), (0, 1, False), (1, 1, True), (1, 1, True), (2, 2, True), (3, 3, True)]
    left = neardup.keep_one(spark.createDataFrame([(*r, "x") for r in rows], ROWS + ", kept string"), width=2)
    assert left.columns == ["doc_id", "text", "kept"]
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left.collect()) == [
        (0, "q r s t"), (1, "a b c d e f"), (2, ""), (3, "z")]


def test_a_batch_with_fewer_words_than_a_shingle(spark):
    for text in ("x", "x y", "x y z w"):
        assert neardup.near_duplicates(spark.createDataFrame([(1, text)], ROWS), width=5).first()["n_shingles"] == 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], ROWS)
    assert neardup.near_duplicates(empty).count() == 0
    assert neardup.keep_one(empty).count() == 0


def test_posterior_bounds_grow_with_the_batches():
    steps = neardup.needed_matches(0.8, 1e-7)
    assert [n for n, _ in steps] == [30, 60, 90, 120, 150]
    assert all(0 < m < 0.8 * n for n, m in steps)
    assert all(a[1] / a[0] < b[1] / b[0] for a, b in zip(steps, steps[1:]))


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(50)] + [(1000, i) for i in range(1001, 1100)] + [(2003, 2001), (2001, 2002), (2002, 2003), (7, 7)]
    got = {r["id"]: r["root"] for r in neardup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 1000 for i in range(1000, 1100)}, 2001: 2001, 2002: 2001, 2003: 2001}


def test_registered_query(spark, sf):
    from bulwark.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = plain.components([(i, plain.shingles(t, 2)) for i, t in docs])
    got = QUERIES["op10_bayes_minhash"](spark, sf)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want
    assert got.where(F.col("kept") != (F.col("doc_id") == F.col("component_id"))).isEmpty()
