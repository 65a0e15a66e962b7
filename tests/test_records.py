"""Edge cases of preparing, flagging, routing and deduplicating."""

import pytest
from pyspark.sql import functions as F

from bulwark.functions import text as tx
from bulwark.operators import joins, records, skew


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{c} string" for c in cols))
    return df.select(expr.alias("x")).first()["x"]


def make(spark, rows):
    """(id, split, mention, text, label) among training rows of 3 to 22 words."""
    base = [(1000 + i, "train", "m", " ".join(["w"] * (i % 20 + 2)) + f" {i}", "T1059") for i in range(40)]
    df = spark.createDataFrame(base + rows, "id long, split string, mention string, full_text string, label_mapped string")
    return records.add_lengths(records.trim_nonempty(df))


def test_rich_text_variants(spark):
    row = dict(sentence_left="", mention="m", sentence_right="r", context_left="cl", context_right="cr")
    assert one(spark, tx.rich_text(), **row) == "cl m cr"
    assert one(spark, tx.rich_text_strict(), **row) == "m r"
    row = dict(sentence_left=" \n", mention=None, sentence_right=None, context_left=" a ", context_right=None)
    assert one(spark, tx.rich_text_strict(), **row) == "a"
    row = dict(sentence_left="l", mention=None, sentence_right=None, context_left=None, context_right=None)
    assert one(spark, tx.rich_text(), **row) == "l  "


def test_clean_text_cases(spark):
    def clean(t):
        return one(spark, tx.clean_text(F.col("t")), t=t)

    text = ("See https://evil.example.com/a/b?x=1 and mail bob@corp.example.org about C:\\Windows\\System32\\cmd.exe "
            "or /usr/local/bin/tool.sh with `rm -rf` and ```code\nblock``` — naïve café")
    out = clean(text)
    assert "[URL]" in out and "[EMAIL]" in out and "[CODE]" in out and "[CODE_BLOCK]" in out
    assert "tool.sh" in out and "/usr" not in out
    assert "naïve café" in out and "—" not in out
    assert out.endswith("[DOMAINS: evil.example.com]")
    many = " ".join(f"http://h{i}.example.com/x" for i in (3, 1, 3, 2, 5, 4, 6))
    assert clean(many).endswith("[DOMAINS: h3.example.com, h1.example.com, h2.example.com, h5.example.com, h4.example.com]")
    assert clean("short") == ""
    assert clean("x" * 10) == "" and clean("x" * 11) == "x" * 11
    assert clean(None) == ""
    assert clean("a" * 60) == "a" * 60


def test_email_search_equals_plain_pattern(spark):
    import re

    plain = re.compile(r"\S+@\S+\.\S+")  # fixed value: the pattern that the linear one must equal
    texts = ["a@b.c", "@@b.c", "a@b", "a@.c", "a@.cd", "a@b..", "x a@b.c, y", "@a@b.c", "a@b@c.d", "..@..", "a@.", "é@ü.ö z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["x"] for r in df.select(F.regexp_replace("t", tx.EMAIL, " [EMAIL] ").alias("x")).collect()]
    assert got == [plain.sub(" [EMAIL] ", t) for t in texts]


def test_file_names_equal_plain_patterns(spark):
    import random
    import re

    # The patterns that the linear ones must equal.
    windows = re.compile(r'[A-Za-z]:\\(?:[^\\/:*?"<>|\r\n]+\\)*([^\\/:*?"<>|\r\n]+)')
    unix = re.compile(r"/(?:[^/\s]+/)*([^/\s]+\.[a-zA-Z]+)")
    rnd = random.Random(11)
    texts = ["".join(rnd.choice("//\\\\aC: .b1\n") for _ in range(rnd.randrange(1, 40))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["x"] for r in df.select("i", tx.file_names(F.col("t")).alias("x")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == unix.sub(r" \1 ", windows.sub(r" \1 ", t)), repr(t)


def test_long_odd_texts_neither_overflow_nor_crawl(spark):
    import time

    texts = ["/a" * 50000, "C:" + "\\a" * 50000, "```" + "x\n" * 50000, "a@" * 50000, "x" * 200000, "a@b" + "." * 50000,
             ("/" + "a" * 50) * 3000, " " * 100000 + "x", "x" + " " * 100000 + "y", "//" * 50000, "a/b.c/" * 20000]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    t0 = time.time()
    n = df.select(F.length(tx.clean_text(F.col("t"))), F.length(tx.normalize_text(F.col("t"))),
                  F.length(tx.strip(F.col("t"))), F.length(tx.truncate_important(F.col("t")))).collect()
    assert len(n) == len(texts) and time.time() - t0 < 60


def test_normalize_and_truncate(spark):
    def norm(t):
        return one(spark, tx.normalize_text(F.col("t")), t=t)

    assert norm("the c2 server – an APT") == (
        "the C2 (command and control) server - an APT (advanced persistent threat)")
    assert norm("rate captain") == "rate captain"
    assert norm("IOCs") == "IOCs (indicators of compromise)"
    assert norm(None) == ""
    for n, expected in ((4000, 4000), (4001, 4007)):
        assert len(one(spark, tx.truncate_head_tail(F.col("t")), t="x" * n)) == expected
    text = "Plain one. Malware attack here. Another plain. An exploit."
    assert one(spark, tx.truncate_important(F.col("t"), 45), t=text) == "Malware attack here. An exploit. Plain one."
    assert one(spark, tx.truncate_important(F.col("t"), 5), t="abcdefgh. ij") == "abcde"


def test_labels(spark):
    df = spark.createDataFrame([("https://x/techniques/T1059",), ("https://x/techniques/T9999",), ("other",), (None,)],
                               "label_link string")
    got = [tuple(r) for r in records.map_technique_labels(df).select("label_id_str", "label_mapped", "label_id_encoded").collect()]
    assert got[0] == ("T1059", "T1059", 6)
    assert got[1] == ("T9999", "OTHER", 0)
    assert got[2][:2] == ("OTHER", "OTHER") and got[3][:2] == ("OTHER", "OTHER")
    assert one(spark, tx.doc_key(F.col("t")), t=" Report_1.TXT.txt\n") == "report_1.txt"


def test_reduce_labels_uses_training_rows_and_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [("train", "b"), ("train", "a"), ("train", "c"), ("train", "c"), ("test", "z"), ("test", "b"), ("test", None)],
        "split string, l string")
    got = {(r["split"], r["l"]): r["label_mapped"] for r in records.reduce_labels(df, "l", 2).collect()}
    assert got[("train", "c")] == "c" and got[("train", "a")] == "a"
    assert got[("train", "b")] == "OTHER" and got[("test", "b")] == "OTHER"
    assert got[("test", "z")] == "OTHER" and got[("test", None)] == "OTHER"


def test_flags_and_routes(spark):
    df = make(spark, [
        (1, "test", None, "a b c d e f g h i j", "T1059"),
        (2, "test", "", "a b c d e f g h i k", "T1059"),
        (3, "test", "m", "a b", "T1059"),
        (4, "test", "m", "a b c d", "OTHER"),
        (5, "test", "m", "a b c d", "T1059"),
        (6, "test", "m", " ".join("x" * 200), "T1059"),
        (7, "dev", "m", "same text in two splits here is fine ok", "T1059"),
        (8, "test", "m", "same text in two splits here is fine ok", "T1059"),
        (9, "dev", None, "same text in two splits here is fine ok", "T1059"),
    ])
    got = {r["id"]: r for r in records.annotate(df, "id").where("id < 1000").collect()}
    assert got[1]["flag_null_mention"] and got[2]["flag_null_mention"]
    assert got[3]["flag_short_text"] and not got[5]["flag_short_text"]
    assert got[4]["flag_other_tiny"] and not got[5]["flag_other_tiny"]
    assert got[6]["flag_long_text"] and got[6]["route"] == "clean"
    assert got[7]["flag_duplicate"] and got[9]["flag_duplicate"] and not got[8]["flag_duplicate"]
    assert got[7]["is_survivor"] and not got[9]["is_survivor"]
    counts = {r["split"]: r for r in records.guard_counts(df).collect()}
    assert counts["dev"]["total"] == 2 and counts["dev"]["flag_duplicate"] == 2
    assert counts["dev"]["quarantined"] == 1 and counts["dev"]["kept"] == 1


def test_single_training_row_has_bounds(spark):
    df = records.add_lengths(spark.createDataFrame([("train", "one two three four")], "split string, full_text string"))
    row = records.sigma_thresholds(df).first()
    assert (row["short_threshold"], row["long_threshold"]) == (4, 4)


def test_every_row_is_kept_quarantined_or_a_copy(spark):
    rows = [(i, "test", None if i % 7 == 0 else "m", f"text number {i % 40} with some more words", "OTHER") for i in range(400)]
    df = make(spark, rows)
    a = records.annotate(df, "id")
    n = a.count()
    kept, gone = a.where("is_survivor").count(), a.where("route = 'quarantine'").count()
    copies = a.where("route = 'clean' AND NOT is_survivor").count()
    assert kept + gone + copies == n
    assert a.where("is_survivor").select("split", "full_text").distinct().count() == kept


def test_hot_text_joins_like_any_other(spark):
    """A third of all rows share one text; with the floor at 1 it takes the salted way."""
    rows = [(i, "train", "hot" if i % 3 == 0 else f"t{i % 50}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, split string, full_text string")
    plain = {r["full_text"]: r["count"] for r in df.groupBy("full_text").count().collect()}
    got = joins.attach_copy_counts(df, "id", floor=1, salts=8).collect()
    assert len(got) == 3000
    assert all(r["dup_count"] == plain[r["full_text"]] for r in got)


def test_hot_keys_are_bounded(spark):
    counts = spark.range(5000).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    assert skew.hot_keys(counts, ["k"], floor=1).count() == 0
    counts = spark.createDataFrame([(1, 500)] + [(i, 1) for i in range(2, 502)], "k long, n long")
    assert [r["k"] for r in skew.hot_keys(counts, ["k"], floor=2).collect()] == [1]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.createDataFrame([(i, "h" if i % 2 else f"k{i % 9}") for i in range(200)], "id long, k string")
    right = spark.createDataFrame([("h", 1), ("k0", 2), ("k2", 3)], "k string, v int")
    a = sorted(tuple(r) for r in left.join(right, "k", how).select("id", "k", F.coalesce("v", F.lit(0))).collect())
    b = sorted(tuple(r) for r in skew.salted_join(left, right, ["k"], how, "id", salts=4, floor=1)
               .select("id", "k", F.coalesce("v", F.lit(0))).collect())
    assert a == b


def test_align_text_and_removal(spark):
    labels = spark.createDataFrame([(1, "A.txt"), (2, " a.TXT"), (3, "missing.txt")], "id long, document string")
    texts = spark.createDataFrame([("a.txt", "body")], "document string, full_text string")
    got = sorted((r["id"], r["full_text"]) for r in joins.align_text(labels, texts, "id", floor=1, salts=3).collect())
    assert got == [(1, "body")]
    assert [r["id"] for r in joins.available_docs(labels, texts, "id", floor=1, salts=3).collect()] == [1]
    pool = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "id long, text string")
    left = joins.remove_selected(pool, pool.where("id = 1"))
    assert [r["id"] for r in left.collect()] == [3]
