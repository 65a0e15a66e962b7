import hashlib
import random

import numpy as np
import pytest

from bulwark.llm import decontaminate as d
from tests.llm import plain

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def windows(items, window):
    held = {}
    for i, t in items:
        w = plain.alnum_words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            held.setdefault(tuple(w[k : k + window]), set()).add(i)
    return held


def brute(docs, items, window):
    held, out = windows(items, window), {}
    lengths = {len(w) for w in held}
    for i, t in docs:
        w, hit, found = plain.alnum_words(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (x := held.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= x
        out[i] = (len(w), hit, found)
    return out


def test_suffix_array():
    rng = np.random.RandomState(1)
    for n, sigma in ((1, 1), (2, 2), (500, 2), (3000, 50)):
        s = rng.randint(0, sigma, n)
        s[n // 4 : n // 2] = s[: n // 2 - n // 4]
        s = np.append(s, 0)
        want = sorted(range(len(s)), key=lambda i: s[i:].tolist())
        assert d.suffix_array(s).tolist() == want


def test_wavelet_tree_ranks_and_symbols():
    s = np.random.RandomState(2).randint(0, 37, 1000)
    tree = d.WaveletTree(s, 37)
    c, i = np.repeat(np.arange(37), 5), np.tile([0, 1, 500, 999, 1000], 37)
    assert tree.rank(c, i).tolist() == [int((s[:y] == x).sum()) for x, y in zip(c, i)]
    got, rank = tree.symbol_and_rank(np.arange(1000))
    assert got.tolist() == s.tolist()
    assert rank.tolist() == [int((s[:y] == x).sum()) for y, x in enumerate(s)]


def test_index_finds_and_locates_every_occurrence():
    s = np.random.RandomState(3).randint(0, 3, 2000)
    index = d.FMIndex(s, 4)
    phrases = np.array([[0, 1, 2], [0, 2, 2], [1, 1, 1], [0, 0, 3]])
    low, high = index.search(phrases, np.array([2, 2, 3, 1]))
    for p, n, a, b in zip(phrases, (2, 2, 3, 1), low, high):
        p = p[3 - n :].tolist()
        want = [i for i in range(len(s)) if s[i : i + n].tolist() == p]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_hits_match_brute_force(spark, block_words):
    rng = random.Random(9)
    items = [(i, plain.words_of(rng, rng.choice([2, 5, 9, 10, 11, 40]), 300)) for i in range(30)]
    items += [(40, None), (41, ""), (42, "?!"), (43, items[3][1]), (44, "Ünïcode wörds äre hêre tøo yes they are right here")]
    docs = [(i, plain.words_of(rng, 300, 300)) for i in range(20)]
    for i in range(20, 60):
        part = rng.choice(items)[1] or ""
        docs.append((i, plain.words_of(rng, 20, 300) + " é, " + part.upper() + "! " + part + " " + plain.words_of(rng, 20, 300)))
    docs += [(60, None), (61, ""), (62, "..."), (63, plain.words_of(rng, 40_000, 300) + " " + items[5][1]), (64, docs[-1][1])]
    df = spark.createDataFrame([(*r, [7]) for r in docs], DOCS + ", spans array<int>")
    got = {r["doc_id"]: r for r in d.occurrences(df, spark.createDataFrame(items, ITEMS), block_words=block_words).collect()}
    texts = dict(docs)
    for i, (n, hit, found) in brute(docs, items, 10).items():
        assert (got[i]["n_words"], set(got[i]["items"])) == (n, found)
        assert {k for s in got[i]["spans"] for k in range(s["word"], s["word_end"])} == hit
        for s in got[i]["spans"]:
            assert plain.alnum_words(texts[i][s["start"] : s["end"]]) == plain.alnum_words(texts[i])[s["word"] : s["word_end"]]


def test_removal_cuts_spans_only(spark):
    phrase = "one two three four five six seven eight nine ten"
    docs = [(1, f"Äh, {phrase.upper()} eleven. End"), (2, phrase), (3, "clean text"), (4, None), (5, f"{phrase} {phrase}, x"), (6, "")]
    out = d.remove(spark.createDataFrame([(*r, 5) for r in docs], DOCS + ", n_words int"), spark.createDataFrame([(1, phrase)], ITEMS))
    assert out.columns == ["doc_id", "text", "n_words"]
    assert {r["n_words"] for r in out.collect()} == {5}
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "Äh,  eleven. End", 3: "clean text", 4: None, 5: ", x", 6: ""}


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([(1, "a b")], ITEMS)
    assert d.occurrences(docs.limit(0), items).count() == 0
    assert d.occurrences(docs, items.limit(0)).first()["spans"] == []
    assert d.occurrences(docs, items).first()["items"] == [1]
    unnamed = spark.createDataFrame([(None, "a b"), (2, "a b")], ITEMS)
    found = d.occurrences(docs, unnamed).first()
    assert found["items"] == [2] and len(found["spans"]) == 1


def test_registered_query(spark, sf):
    from bulwark.llm.queries import QUERIES

    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(i, "text").collect()] for t, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = {r["doc_id"]: r for r in QUERIES["op4_fm_index_decontamination"](spark, sf).collect()}
    for i, (n, hit, found) in brute(docs, items, 10).items():
        ids = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert tuple(got[i])[1:] == (n, len(hit), len(found), ids, bool(hit))
