"""Perturbations: what they may change, and that layout does not matter."""

import pytest
from pyspark.sql import functions as F

from bulwark.functions import perturb
from bulwark.operators import corpus

LONG = ("The quick brown foxes jumped over lazy sleeping dogs, and the attackers deployed Malware! " * 20).strip()
TEXTS = ["", "a", "1 2 3 !!", "ab", "hello world again friends", LONG, "Ünïcödé wörds änd émojis 😀 hêre", "x" * 300,
         " ".join(["word"] * 400), "line one\nline two\ttabbed   spaced"]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string").cache()


def run(table, column, parts=None):
    df = table.repartition(parts) if parts else table
    return {r["id"]: r["x"] for r in df.select("id", column.alias("x")).collect()}


T, I = (lambda: F.col("t")), (lambda: F.col("id"))


def test_swap_changes_only_order(table):
    got = run(table, perturb.char_swap(T(), I()))
    for i, t in enumerate(TEXTS):
        assert sorted(got[i]) == sorted(t)
    assert got[1] == "a" and got[2] == "1 2 3 !!" and got[3] == "ba"
    assert 1 <= sum(a != b for a, b in zip(got[5], LONG)) <= 4


@pytest.mark.parametrize("name,n", [("homoglyph", 3), ("keyboard_typo", 2)])
def test_replacement_counts(table, name, n):
    got = run(table, getattr(perturb, name)(T(), I()))
    for i, t in enumerate(TEXTS):
        assert len(got[i]) == len(t)
        assert sum(a != b for a, b in zip(got[i], t)) <= n
    assert sum(a != b for a, b in zip(got[5], LONG)) == n
    assert got[2] == TEXTS[2]


def test_keyboard_keeps_case(spark):
    df = spark.createDataFrame([(1, "ABCDEFGH")], "id long, t string")
    assert df.select(perturb.keyboard_typo(T(), I(), 8).alias("x")).first()["x"].isupper()


def test_delete_and_insert(table):
    deleted, inserted = run(table, perturb.char_delete(T(), I())), run(table, perturb.char_insert(T(), I()))
    for i, t in enumerate(TEXTS):
        flat = " ".join(t.split())
        long5 = min(2, sum(len(w) >= 5 and w.isalpha() for w in t.split()))
        long4 = min(2, sum(len(w) >= 4 and w.isalpha() for w in t.split()))
        assert len(deleted[i]) == len(flat) - long5
        assert len(inserted[i]) == len(flat) + long4
    first = deleted[4].split()[0]
    assert first[0] == "h" and first[-1] == "o" and len(first) == 4


def words_of(t):
    return [w for w in t.split() if len(w) >= 4 and w.isalpha() and w.lower() not in perturb.STOP_WORDS]


@pytest.fixture(scope="module")
def dictionary(spark):
    vocabulary = sorted({w.lower() for t in TEXTS for w in words_of(t)})
    return spark.createDataFrame([(w, [w + "x", w + "y"]) for w in vocabulary], "word string, synonyms array<string>")


def test_synonyms_salted_or_not(spark, table, dictionary):
    a = corpus.synonym_attack(table, "id", "t", dictionary)
    b = corpus.synonym_attack(table, "id", "t", dictionary, floor=1, salts=4)
    c = corpus.synonym_attack(table, "id", "t", dictionary.unionByName(
        spark.createDataFrame([(None, ["never"])], dictionary.schema)))
    key = lambda df: sorted((r["id"], r["adv_text"]) for r in df.collect())
    assert key(a) == key(b) == key(c)
    got = dict(key(a))
    for i, t in enumerate(TEXTS):
        if not words_of(t):
            assert got[i] == t
        else:
            changed = sum(x != y for x, y in zip(got[i].split(), t.split()))
            assert changed == min(3, len(words_of(t)))
    assert corpus.synonym_attack(table, "id", "t", dictionary.where("false")).where("adv_text IS NULL").count() == 0


def test_capital_is_kept(spark):
    df = spark.createDataFrame([(1, "Hello")], "id long, t string")
    d = spark.createDataFrame([("hello", ["good day"])], "word string, synonyms array<string>")
    assert corpus.synonym_attack(df, "id", "t", d).first()["adv_text"] == "Good day"


def test_augmentations(table, spark):
    deleted = run(table, perturb.augment_delete(T(), I()))
    assert deleted[4] == TEXTS[4]
    assert len(deleted[5].split()) < len(LONG.split())
    shuffled = run(table, perturb.augment_shuffle(T(), I()))
    assert shuffled[4] == TEXTS[4]
    df = spark.createDataFrame([(1, "First. Second! Third? Fourth. Last."), (2, "A malware, b Attack! c hide; d hide")], "id long, t string")
    s = run(df, perturb.augment_shuffle(T(), I()))[1]
    assert s.startswith("First.") and s.endswith("Last.") and sorted(s.split()) == sorted("First. Second! Third? Fourth. Last.".split())
    w = run(df, perturb.augment_synonym(T(), I()))[2].split(" ")
    assert w[0] == "A" and "malware," not in w and "Attack!" not in w and "hide;" not in w and w[-1] == "hide"


def test_layout_does_not_matter(table, dictionary):
    d = corpus.with_synonym_map(table, "id", "t", dictionary)
    suite = perturb.attack_suite(T(), I(), F.col("_synonyms"), F.col("_script"))
    a = sorted(tuple(r) for r in corpus.perturb_corpus(d, "id", suite).collect())
    d2 = corpus.with_synonym_map(table.repartition(7, "t"), "id", "t", dictionary)
    b = sorted(tuple(r) for r in corpus.perturb_corpus(d2, "id", perturb.attack_suite(T(), I(), F.col("_synonyms"), F.col("_script"))).collect())
    assert a == b and len(a) == len(TEXTS) * 8


def test_noise_mix_shares(spark):
    df = spark.range(4000).select("id", F.lit("some vowels").alias("t"))
    got = df.select(perturb.noise_mix(T(), I(), 0.2).alias("x")).groupBy("x").count().collect()
    n = {r["x"]: r["count"] for r in got}
    assert set(n) == {"some vowels", "sm vwls", "somesome vowelsvowels"}
    assert abs(n["sm vwls"] - 800) < 120 and abs(n["somesome vowelsvowels"] - 800) < 120


def test_word_groups_hold_every_word(spark):
    df = spark.createDataFrame([("Apple banana cherry the damson",), ("apple elderberry x1y2",)], "t string")
    got = {r["word"]: r["synonyms"] for r in corpus.word_groups(df, "t").collect()}
    assert set(got) == {"apple", "banana", "cherry", "damson", "elderberry"}
    assert all(w not in s for w, s in got.items())


def test_blocks_cut_everywhere_the_same(spark):
    texts = ["", "a", "b" * 256, "c" * 257, "line\n" * 200, "é𝔘" * 300]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for overlap in (0, 1):
        for t, got in zip(texts, [r[0] for r in df.select(perturb._blocks(F.col("t"), overlap)).collect()]):
            assert got == [t[i : i + perturb.BLOCK + overlap] for i in range(0, max(1, len(t)), perturb.BLOCK)]


def test_edits_are_linear_in_the_text(spark):
    import time

    def seconds(n):
        df = spark.createDataFrame([(i, "åbcdé " * (n // 6)) for i in range(4)], "id long, t string").cache()
        df.count()
        best = 1e9
        for _ in range(3):
            t0 = time.time()
            df.select(F.sum(F.length(perturb.char_swap(T(), I())))).collect()
            best = min(best, time.time() - t0)
        return best

    assert seconds(800_000) < 5 * seconds(200_000) + 0.5


def test_attacks_from_a_shared_line_are_the_same(table, dictionary):
    d = corpus.with_synonym_map(table, "id", "t", dictionary).withColumn("_line", perturb.one_line(T()))
    d = d.unionByName(d.withColumns({"id": F.col("id") + 100, "_script": F.lit(None), "_synonyms": F.lit(None)}))
    plain, shared = (perturb.attack_suite(T(), I(), F.col("_synonyms"), F.col("_script"), line=x) for x in (None, F.col("_line")))
    of = lambda suite: sorted(tuple(r) for r in corpus.perturb_corpus(d, "id", suite).collect())
    assert of(plain) == of(shared) and all(r[-1] is not None for r in of(shared))
    step = d.where("_script is not null").select("id", perturb.synonym(T(), I(), F.col("_synonyms"), F.col("_script"), 8).alias("t"))
    for edit, n in ((perturb.char_swap, 5), (perturb.keyboard_typo, 4), (perturb.homoglyph, 5), (perturb.char_delete, 3), (perturb.char_insert, 3)):
        step = step.withColumn("t", edit(T(), I(), n)).localCheckpoint()
    alone = {r["id"]: r["t"] for r in step.collect()}
    assert alone.items() <= run(d, shared["combined"]).items() and len(alone) == len(TEXTS)


def test_first_words_are_found_in_the_head(spark):
    """The head is searched first; words at its edge, or too few in it, are found as in the whole line."""
    texts = [*TEXTS, "a b " * 10 + "lonely words " * 3, "short alphabets everywhere", "x " * 20 + "exactly1 exactly", "alpha beta gamma", ""]
    d = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "id long, t string").withColumn("l", perturb.one_line(T())).cache()
    for n in (1, 2, 3):
        for head in (5, 11, 12, 13, 17, 18, 40, 60, perturb.HEAD):
            pair = d.select(perturb.first_starts(F.col("l"), perturb.letters(5), n, head), perturb.word_starts(F.col("l"), perturb.letters(5), n + 1))
            assert all(a == b for a, b in pair.collect())


def test_the_random_attack_is_one_of_those_made(spark):
    from bulwark.plans import active

    d = spark.createDataFrame([(i, t, "c") for i, t in enumerate(TEXTS * 3)], "id long, t string, label string").withColumnRenamed("t", "full_text")
    rows = active.attacked(d, "id", "label", 42)
    assert "_keyboard_typo_text" in rows._jdf.queryExecution().analyzed().toString()
    mapped = corpus.with_synonym_map(d, "id", "full_text", corpus.word_groups(d, "full_text"), seed=42)
    suite = perturb.attack_suite(F.col("full_text"), I(), F.col("_synonyms"), F.col("_script"), 42)
    plain = corpus.perturb_corpus(mapped, "id", suite, ("label",)).withColumnRenamed("adv_text", "full_text")
    found, wanted = (sorted(tuple(r[c] for c in plain.columns) for r in x.collect()) for x in (rows, plain))
    assert found == wanted and len(found) == 8 * 3 * len(TEXTS)
