"""Exact dedup by content sort.

A size-weighted sample of the normalised texts gives splitters, which deal the texts out into ranges of near equal
bytes. Each range is sorted by the whole text (Spark's external sort), which places equal texts next to each other;
neighbours are compared in full, and the runs of equal ones are the groups. A text whose copies fill more than a
range is split over several by its ids; the few runs of such texts are put together by their whole text.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bulwark.llm.common import LONG_MIN, plainly_named
from bulwark.session import checkpointed

#: Bytes of text in a range, and how many ranges there are at most (beyond, ranges grow and the sort spills).
RANGE_BYTES, MOST_RANGES = 16 << 20, 20_000
SAMPLES_PER_RANGE = 16
#: Bytes of a text that a splitter shows; texts that begin alike are ordered by a hash of the whole text.
HEAD_BYTES = 32
SEED = 20_013
BOUND = "struct<head: string, mark: bigint, tie: bigint, place: bigint>"


def unchanged(text: Column) -> Column:
    return text


def splitters(rows: DataFrame, total: int, ranges: int) -> list[tuple[str, int, int, int]]:
    """Quantile boundaries of a sample in which a row stands with probability in proportion to its size.

    A text that holds a single boundary is cut in front of its first row, so its rows stay together.
    """
    mean = max(1, total // ranges)
    step = max(1, mean // SAMPLES_PER_RANGE)
    draw = F.pmod(F.xxhash64("key.mark", "key.tie", "key.place", F.lit(SEED)), F.lit(step)) < F.col("size")
    drawn = rows.where(draw).select("key", F.greatest("size", F.lit(step)).alias("weight")).collect()
    picked, passed = set(), 0
    for key, weight in sorted((tuple(r["key"]), r["weight"]) for r in drawn):
        if passed + weight / 2 >= mean:
            picked.add(key)
            passed = 0
        passed += weight
    own: dict[tuple, int] = {}
    for head, mark, _, _ in picked:
        own[head, mark] = own.get((head, mark), 0) + 1
    return sorted({k if own[k[:2]] > 1 else (*k[:2], LONG_MIN, LONG_MIN) for k in picked})


def range_of(key: Column, bounds: Column, n: int) -> Column:
    """How many of the n sorted bounds are at or below the key: a binary search."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])
    return F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when((at + step <= n) & (F.get(bounds, at + step - 1) <= key), at + step).otherwise(at),
    )


def exact_groups(
    df: DataFrame,
    id_col: str,
    text_col: str,
    normalised: Callable[[Column], Column] = unchanged,
    keep_largest: bool = True,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Columns of df but the text, plus keep_id, group_size (long), kept (boolean) and text_sha256 of the normalised text.

    Rows whose normalised texts are identical are a group; the one with the largest (else smallest) id is kept.
    Texts cross one shuffle; only the sample (about 16 rows a range) reaches the driver, and what is broadcast is at
    most two narrow rows a range. df should be a table as read: rows alike in id and text are told apart by their
    place in the scan if their group must be split.
    Defined cases: null texts are equal to the empty text; a null id is smaller (else larger) than any other, so
    keep_id is null only if no row of the group has an id; of rows that share the kept id one stays; an empty table
    gives an empty result; input columns with the names of added ones are replaced; texts are compared by their
    bytes, however long, so neither case nor accents nor trailing spaces are ignored.
    """
    added = ("keep_id", "group_size", "kept", "text_sha256")
    taken = [c for c in df.columns if c.lower() not in added]
    named, name = plainly_named(df.select(*[F.col(f"`{c}`") for c in taken]))
    row_id, rest = name[id_col], [name[c] for c in taken if c != text_col]
    text = normalised(F.coalesce(F.col(name[text_col]), F.lit("")))
    key = F.struct(
        F.hex(F.substring(F.col("text").cast("binary"), 1, HEAD_BYTES)).alias("head"), F.xxhash64("text").alias("mark"),
        F.xxhash64(row_id).alias("tie"), F.monotonically_increasing_id().alias("place"),
    )
    rows = named.select(*rest, text.alias("text")).withColumns({"key": key, "size": F.octet_length("text") + F.lit(64)})
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    ranges = max(1, min(MOST_RANGES, -(-total // range_bytes)))
    cuts = splitters(rows, total, ranges) if ranges > 1 else []
    bounds = F.from_json(F.lit(json.dumps([dict(zip(("head", "mark", "tie", "place"), c, strict=True)) for c in cuts])), f"array<{BOUND}>")

    def cuts_text(bound: Column) -> Column:
        """The bound lies among the rows of this text."""
        return F.coalesce((bound["head"] == F.col("key.head")) & (bound["mark"] == F.col("key.mark")) & (bound["tie"] > LONG_MIN), F.lit(False))

    part = range_of(F.col("key"), bounds, len(cuts)) if cuts else F.lit(0)
    dealt = (
        rows.withColumn("part", part)
        .withColumn("split", cuts_text(F.get(bounds, F.col("part") - 1)) | cuts_text(F.get(bounds, F.col("part"))))
        .select(*rest, "text", "part", "split")
        .repartitionById(len(cuts) + 1, "part")
    )
    first = F.col(row_id).desc_nulls_last() if keep_largest else F.col(row_id).asc_nulls_last()
    best = F.max if keep_largest else F.min
    sorted_texts = Window.partitionBy("part").orderBy("text", first)
    new = F.coalesce(F.col("text") != F.lag("text").over(sorted_texts), F.lit(True))
    runs = dealt.withColumn("new", new).withColumn("run", F.sum(F.col("new").cast("long")).over(sorted_texts.rowsBetween(Window.unboundedPreceding, 0)))
    held = runs.select(*rest, "part", "split", "new", "run", F.sha2("text", 256).alias("sha"), F.when(F.col("split") & F.col("new"), F.col("text")).alias("text"))
    if not cuts:
        return _named(_counted(held, row_id, best), rest, taken, text_col)
    held = checkpointed(held)
    # Runs of texts that are split over ranges: two a range at most.
    parts = held.where("split").groupBy("part", "run").agg(F.count("*").alias("n"), best(row_id).alias("id"), F.max("text").alias("text"))
    alike = Window.partitionBy("text")
    order = F.desc_nulls_last("id") if keep_largest else F.asc_nulls_last("id")
    whole = parts.select(
        "part", "run", F.sum("n").over(alike).alias("whole_n"), best("id").over(alike).alias("whole_id"),
        (F.row_number().over(alike.orderBy(order, "part", "run")) == 1).alias("leads"),
    )
    found = _counted(held, row_id, best).join(F.broadcast(whole), ["part", "run"], "left").withColumns({
        "keep_id": F.when(F.col("leads").isNull(), F.col("keep_id")).otherwise(F.col("whole_id")),
        "group_size": F.coalesce("whole_n", "group_size"), "kept": F.col("kept") & F.coalesce("leads", F.lit(True)),
    })
    return _named(found, rest, taken, text_col)


def _counted(held: DataFrame, row_id: str, best: Callable) -> DataFrame:
    """Each run's size and best id; its first row is the one that stays."""
    run = Window.partitionBy("part", "run")
    return held.withColumns({"group_size": F.count("*").over(run), "keep_id": best(row_id).over(run), "kept": F.col("new")})


def _named(found: DataFrame, rest: list[str], taken: list[str], text_col: str) -> DataFrame:
    out = found.select(*rest, "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))
    return out.toDF(*[c for c in taken if c != text_col], "keep_id", "group_size", "kept", "text_sha256")
