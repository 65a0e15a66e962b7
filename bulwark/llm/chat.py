"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own.

An example's context is all turns in front of it, and only its reply is trainable. Contexts of one conversation are
prefixes of each other, so a conversation is formatted once, turn by turn, and an example is a prefix and a target
range of that text: `examples` has one row for each, `rendered` writes them out.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks around a turn, and the control strings of common templates that a text must not imitate.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
ANGLE = r"/?s>|\|im_(?:start|end)\|>|\|endoftext\|>|\|(?:system|user|assistant)\|>|/?SYS>"
BRACKET = r"/?INST\]"


def escaped(text: Column) -> Column:
    """Put a backslash behind the first character of every control string, and of every string that so looks."""
    text = F.regexp_replace(text, rf"<(\\*)(?={ANGLE})", r"<\\$1")
    return F.regexp_replace(text, rf"\[(\\*)(?={BRACKET})", r"[\\$1")


def unescaped(text: Column) -> Column:
    text = F.regexp_replace(text, rf"<\\(\\*)(?={ANGLE})", "<$1")
    return F.regexp_replace(text, rf"\[\\(\\*)(?={BRACKET})", "[$1")


def formatted(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, seq (0, 1, ...), segment, start, target_start, target_end: each turn's part of its conversation's text.

    Places are code points in that text; the target is the reply's text, null for other roles. Turns are ordered by
    turn, then role and text. A conversation's turns, texts included, are sorted in one task, which spills; its places
    need all lengths in front, and its digest its turns in order. So the longest conversation must fit a task's disk.
    Defined cases: null roles and texts are empty; a role's line ends are written as spaces cannot be, by \\n; rows
    without a conversation are one conversation of their own, null; repeated rows are turns of their own; further
    columns are dropped; no rows give no rows.
    """
    # A role is one line: a backslash is written as \\b, a line end as \\n.
    role = F.replace(F.replace(F.coalesce(F.col(role_col), F.lit("")), F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
        F.xxhash64(text).alias("h"),
        F.concat(F.lit(OPEN), escaped(role), F.lit("\n")).alias("head"), F.concat(escaped(text), F.lit(CLOSE)).alias("body"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "h")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body")
    placed = rows.withColumns({"seq": F.row_number().over(order) - 1, "start": F.coalesce(F.sum(size).over(before), F.lit(0))})
    mine = F.col("role").eqNullSafe("assistant")
    return placed.select(
        "conv_id", F.col("seq").cast("long").alias("seq"), F.concat("head", "body").alias("segment"), "start",
        F.when(mine, F.col("start") + F.length("head")).alias("target_start"),
        F.when(mine, F.col("start") + size - len(CLOSE)).alias("target_end"),
    )


def numbered(segments: DataFrame) -> DataFrame:
    """Segments, plus example (0, 1, ... for each conversation's assistant turns, else null) and prefix_end."""
    before = Window.partitionBy("conv_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    mine = F.col("target_start").isNotNull()
    return segments.withColumns({
        "example": F.when(mine, F.coalesce(F.sum(mine.cast("long")).over(before), F.lit(0).cast("long"))),
        "prefix_end": F.when(mine, F.col("start") + F.length("segment")),
    })


def examples(segments: DataFrame) -> DataFrame:
    """One row for each assistant turn: conv_id, example (0, 1, ...), prefix_end, target_start, target_end, seq.

    The example reads the first prefix_end code points of its conversation's text, up to and with the turn's end mark;
    the context ends at target_start, and the loss covers target_start to target_end.
    """
    return numbered(segments).where("example is not null").select("conv_id", "example", "prefix_end", "target_start", "target_end", "seq")


def rendered(segments: DataFrame) -> DataFrame:
    """Examples written out: conv_id, example, text, target_start, target_end.

    As many characters as all prefixes of a conversation have, so its square: for conversations of ordinary length.
    """
    own = examples(segments)
    parts = own.join(segments.select("conv_id", F.col("seq").alias("s"), "segment").withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("s") <= F.col("seq")))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s", "segment"))), lambda p: p["segment"]), "")
    return parts.groupBy("conv_id", "example", "target_start", "target_end").agg(joined.alias("text"))


def with_text(segments: DataFrame) -> DataFrame:
    """Segments, plus the role and text that they say, with marks and escapes undone."""
    body = F.col("segment")
    inner = F.substring(body, F.lit(len(OPEN) + 1), F.length(body) - len(OPEN) - len(CLOSE))
    cut = F.instr(inner, "\n")
    role = unescaped(F.substring(inner, F.lit(1), cut - 1))
    role = F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))
    return segments.withColumns({"role": role, "text": unescaped(F.substring(inner, cut + 1, F.length(inner) - cut))})


def read_back(segments: DataFrame) -> DataFrame:
    """conv_id, seq, role, text, loss, chars: what the formatted text says, with marks and escapes undone."""
    body = F.col("segment")
    loss = F.substring(body, (F.col("target_start") - F.col("start") + 1).cast("int"), (F.col("target_end") - F.col("target_start")).cast("int"))
    return with_text(segments).select("conv_id", "seq", "role", "text", unescaped(loss).alias("loss"), F.length(body).cast("long").alias("chars"))


NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples", "prefix_chars", "examples_sha256"]


def digests(segments: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted text and its examples: the columns of NAMES.

    Turns are read from their segments. All else is read from the examples: a loss is its example's target range, cut
    out of the text that was streamed so far, prefix_chars is what all examples read together, and examples_sha256
    covers a line `prefix_end:target_start:target_end:sha256 of the prefix` for each example.
    A digest needs its conversation's turns in order. They are sorted and streamed through it one by one, and a
    prefix's digest goes on from the one before, so a conversation of any length takes no more memory than its longest
    turn, and no prefix is read twice.
    """
    rows = (
        with_text(numbered(segments))
        .select("conv_id", "seq", "role", "text", "segment", "prefix_end", "target_start", "target_end")
        .repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    )
    conv_type = segments.schema["conv_id"].dataType.simpleString()
    schema = ", ".join(f"{n} {conv_type if n == 'conv_id' else 'string' if n.endswith('sha256') else 'long'}" for n in NAMES)
    kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in NAMES]
    kinds[0] = pa.int64() if conv_type == "bigint" else None
    names, unescape = NAMES, [(re.compile(rf"{a}\\(\\*)(?={b})"), rf"{a[-1]}\1") for a, b in (("<", ANGLE), (r"\[", BRACKET))]

    def table(done):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)

    def ended(state):
        conv, turns, all_turns, loss_chars, loss, chars, n, prefix_chars, lines, _ = state
        return conv, turns, all_turns.hexdigest(), loss_chars, loss.hexdigest(), chars, n, prefix_chars, lines.hexdigest()

    def run(batches):
        state, done = None, []
        for b in batches:
            for conv, _, role, text, segment, end, low, high in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if state is None or conv != state[0]:
                    if state is not None:
                        done.append(ended(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0, hashlib.sha256(), hashlib.sha256()]
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                start = state[5]
                state[5] += len(segment)
                state[9].update(segment.encode())
                if end is None:
                    continue
                if end != state[5] or low < start or high > end:
                    raise ValueError(f"example of conversation {conv} doesn't fit its text: {end}, {low}, {high}")
                target = segment[low - start : high - start]
                for pattern, plain in unescape:
                    target = pattern.sub(plain, target)
                state[3] += len(target)
                state[4].update(target.encode())
                state[6] += 1
                state[7] += end
                state[8].update(f"{end}:{low}:{high}:{state[9].hexdigest()}\n".encode())
            if len(done) > 5000:
                yield table(done)
                done = []
        if state is not None:
            done.append(ended(state))
        if done:
            yield table(done)

    return rows.mapInArrow(run, schema)
