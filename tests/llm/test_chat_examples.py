"""Examples of a whole table: number, prefixes and targets, against the examples written out."""

import pytest
from pyspark.sql import functions as F

from bulwark.llm import chat
from tests.llm.test_chat import ROWS, rows, sha


@pytest.mark.parametrize("given", ["conversations", "odd"])
def test_digests_cover_every_example(spark, sf, given):
    turns = spark.createDataFrame([r for r in rows() if r[0] != 50], ROWS) if given == "odd" else spark.read.parquet(f"{sf}/conversations.parquet")
    segments = chat.formatted(turns)
    got = {r["conv_id"]: r for r in chat.digests(segments).collect()}
    replies = {r["conv_id"]: r["n"] for r in turns.groupBy("conv_id").agg(F.count(F.when(F.col("role") == "assistant", 1)).alias("n")).collect()}
    assert {c: r["n_examples"] for c, r in got.items()} == replies and max(replies.values()) > 1
    lines, chars = {c: "" for c in got}, dict.fromkeys(got, 0)
    ends = {(r["conv_id"], r["example"]): r["prefix_end"] for r in chat.examples(segments).collect()}
    for r in sorted(chat.rendered(segments).collect(), key=lambda r: r["example"]):
        assert ends.pop((r["conv_id"], r["example"])) == len(r["text"])
        lines[r["conv_id"]] += f"{len(r['text'])}:{r['target_start']}:{r['target_end']}:{sha(r['text'])}\n"
        chars[r["conv_id"]] += len(r["text"])
    assert not ends
    assert {c: (r["prefix_chars"], r["examples_sha256"]) for c, r in got.items()} == {c: (chars[c], sha(x)) for c, x in lines.items()}


def test_digests_read_their_losses_from_the_examples(spark):
    segments = chat.formatted(spark.createDataFrame([(1, 0, "user", "question"), (1, 1, "assistant", "answer")], ROWS))
    moved = segments.withColumns({"target_start": F.col("target_start") + 1, "target_end": F.col("target_end") - 1})
    assert chat.digests(moved).first()["loss_sha256"] == sha("nswe")
    with pytest.raises(Exception, match="doesn't fit its text"):
        chat.digests(segments.withColumn("start", F.col("start") + 1)).collect()
