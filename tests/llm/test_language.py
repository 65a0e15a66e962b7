import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bulwark.llm import language


def plain_symbols(text):
    out = []
    for c in text or "":
        s = language.symbol_table()[ord(c)]
        if s:
            out.append(int(s))
        elif out and out[-1] != 32:
            out.append(32)
    return out[:-1] if out and out[-1] == 32 else out


TEXTS = ["Ab  c1d!", None, "", " 12 ", "Éa ", "x", "日本 go", "a" * 2000, "ﬀ𝔘 z"]


def test_symbols_and_grams():
    parts = list(language.symbols(pa.array(TEXTS)))
    at = 0
    for s in parts:
        g = language.grams(s)
        for r in range(len(s.at) - 1):
            want = plain_symbols(TEXTS[at])
            assert s.symbols[s.at[r] : s.at[r + 1]].tolist() == want
            padded = [32] * 3 + want
            assert g[s.at[r] : s.at[r + 1]].tolist() == [sum(padded[i + k] << (16 * (3 - k)) for k in range(4)) for i in range(len(want))]
            at += 1
    assert at == len(TEXTS)


def plain_model(texts, order=4):
    """Interpolated Kneser-Ney by dictionaries: probability of the last symbol of an n-gram."""
    from collections import Counter

    levels, grams = {}, Counter()
    for t in texts:
        s = [32] * (order - 1) + plain_symbols(t)
        grams.update(tuple(s[i : i + order]) for i in range(len(s) - order + 1))
    for n in range(order, 0, -1):
        levels[n] = dict(grams)
        grams = Counter(g[1:] for g in levels[n])

    def prob(g, alphabet):
        n = len(g)
        if n == 0:
            return 1 / (alphabet + 1)
        counts = levels[n]
        ones, twos = (sum(c == k for c in counts.values()) for k in (1, 2))
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        same = [c for x, c in counts.items() if x[:-1] == g[:-1]]
        below = prob(g[1:], alphabet)
        if not same:
            return below
        return max(counts.get(g, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * below

    return prob, levels[1]


def test_probabilities_match_plain_kneser_ney():
    corpora = {0: ["abab abc", "cab"], 1: ["xyxy ab", "zzab a"]}
    lang, gram, count = [], [], []
    for i, texts in corpora.items():
        g = np.concatenate([language.grams(s) for s in language.symbols(pa.array(texts))])
        k, c = np.unique(g, return_counts=True)
        lang.append(np.full(len(k), i)), gram.append(k), count.append(c)
    model = language.build(["a", "b"], *(np.concatenate(x) for x in (lang, gram, count)))
    plain = {i: plain_model(t) for i, t in corpora.items()}
    alphabet = len({g for _, ones in plain.values() for g in ones})
    for text in ("abab", "zzxy q", "abc xyz"):
        s = next(language.symbols(pa.array([text])))
        padded = [32] * 3 + plain_symbols(text)
        logs = model.logs(language.grams(s))
        for i in range(len(s.symbols)):
            for k in (0, 1):
                assert logs[i, k] == pytest.approx(np.log(plain[k][0](tuple(padded[i : i + 4]), alphabet)), abs=1e-4)


def test_found_keys():
    keys = np.unique(np.random.RandomState(0).randint(0, 2**40, 5000).astype(np.uint64))
    table, order = language.Sorted.of(keys)
    asked = np.concatenate((keys, keys + np.uint64(1)))
    at = table.find(asked)
    known = set(keys.tolist())
    assert [(i >= 0) for i in at.tolist()] == [k in known for k in asked.tolist()]
    assert (keys[order][at[at >= 0]] == asked[at >= 0]).all()
    assert (language.Sorted.of(keys[:0])[0].find(keys) == -1).all()


def test_held_out_accuracy_and_awkward_texts(spark, sf):
    from bulwark.llm.queries import trained_languages

    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    model = trained_languages(docs)
    held = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    found = language.identify(held.select("text", "lang", F.lit(1).alias("Score")), "text", model).toPandas()
    assert list(found.columns) == ["text", "lang", "lang_pred", "score", "cross_entropy", "rejected"]
    assert (found["lang"] == found["lang_pred"]).mean() > 0.98
    assert not found["rejected"].any() and found["score"].between(0, 1).all()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "жщ ъы эю жщ ъы эю жщъы"), (5, docs.first()["text"] * 50)], "i int, text string")
    rows = {r["i"]: r for r in language.identify(odd, "text", model).collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 and rows[i]["rejected"] for i in (1, 2, 3))
    assert rows[4]["rejected"] and not rows[5]["rejected"]
    assert language.identify(odd.limit(0), "text", model).count() == 0


def test_nothing_to_learn_from(spark):
    rows = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string")
    model = language.fit(rows, "doc_id", "text", "lang")
    assert {r["lang_pred"] for r in language.identify(rows, "text", model).collect()} == {"und"}
    alone = language.fit(rows.withColumn("lang", F.lit("en")), "doc_id", "text", "lang")
    assert [r["lang_pred"] for r in language.identify(rows, "text", alone).collect()] == ["en", "und"]
