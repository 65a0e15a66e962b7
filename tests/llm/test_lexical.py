import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from bulwark.llm import lexical
from tests.llm.plain import lower
from tools.check import compare

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def brute(docs, items, k=10):
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    n_docs, n_words = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms_of(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in held:
            m = 10 + (90 * sum(c.values()) * n_docs) // max(n_words, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, n, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **how):
    got = lexical.ranked(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **how)
    return sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(seed=5, n=400):
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 500}"
    docs = [(i, " ".join(word() for _ in range(rng.randrange(60)))) for i in range(n)]
    docs += [(n + i, docs[7][1]) for i in range(n // 2)]  # ties: a third are copies
    rng.shuffle(docs)
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 30)))) for i in range(25)]
    return docs, [*items, (100, docs[0][1] + " w1"), (101, "unheardof"), (102, ""), (103, None)]


@pytest.mark.parametrize("postings, reads, terms", [(2_000_000, 128, 1_000_000), (300, 2, 100), (40, 1, 7)])
def test_matches_brute_force(spark, monkeypatch, postings, reads, terms):
    monkeypatch.setattr(lexical, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(lexical.nra, "__defaults__", (reads,))
    docs, items = corpus()
    if terms < 100:
        items = items[:6]
    assert found(spark, docs, items, block_terms=terms) == brute(docs, items)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "Apple apple PEAR"), (3, "apple"), (None, "apple pear plum"), (4, "ÄPFEL äpfel Äpfel"), (5, "x" * 3000 + " pear"), (6, "plum " * 5000)]
    items = [(1, "APPLE"), (1, "pear"), (2, None), (3, "äpfel"), (None, "plum pear"), (5, "x" * 3000), (6, "nothing_here 12")]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, docs, [(1, "!?")]) == []
    assert found(spark, docs, items, k=1) == brute(docs, items, 1)


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 3, 4)], "doc_id long, text string, score int, item_id int")
    items = spark.createDataFrame([("q", "a zz", 1)], "item_id string, text string, doc_id int")
    got = lexical.ranked(docs, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and [tuple(r)[:3] for r in got.collect()] == [("q", 1, 1)]


def test_terms_that_share_a_hash(monkeypatch):
    """Words are terms by their bytes, whatever their hash."""
    vocabulary, place = lexical.Vocabulary.of(["ab", "cd", "xyz"])
    for w in lexical.cut(lexical.pa.array(["AB cd ef xyz ab abc", "cd"]), lexical.ALNUM):
        vocabulary.hashes[:] = 9
        vocabulary.alike = 3
        w.hashes[:] = 9
        word, term = vocabulary.places(w)
    assert sorted(zip(word.tolist(), term.tolist())) == sorted((i, int(place[t])) for i, t in [(0, 0), (1, 1), (3, 2), (4, 0), (6, 1)])


def test_reading_stops_early():
    """A document far ahead in every list ends the reading; flat lists are read to the end."""
    rng = np.random.default_rng(2)
    n, t = 50_000, 4
    docs, terms = np.tile(np.arange(n), t), np.repeat(np.arange(t), n)
    impacts = rng.integers(1, 1000, n * t)
    impacts[docs < 10] += 10_000 * (10 - docs[docs < 10])
    index = lexical.Index.of(np.arange(n), docs, terms, impacts, t)
    best, read = lexical.nra(index, np.arange(t), 10, [])
    assert [i for _, i in best] == list(range(10)) and read < 0.01 * n * t
    assert [-s for s, _ in best] == [int(impacts[docs == i].sum()) for i in range(10)]
    level = lexical.Index.of(np.arange(n), docs, terms, np.full(n * t, 7), t)
    best, read = lexical.nra(level, np.arange(t), 10, [])
    assert best == [(-7 * t, i) for i in range(10)] and read <= n * t
    assert lexical.nra(index, np.arange(t), 10, [(-10**9, -i) for i in range(10)])[1] == 128 * t  # others have won


def test_registered_query_matches_sql(spark, sf, duck):
    from bulwark.llm.queries import QUERIES, SQL

    assert compare(QUERIES["op12_nra_search"](spark, sf), duck, SQL["op12_nra_search"]) == ""
