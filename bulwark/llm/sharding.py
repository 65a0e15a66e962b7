"""Sharding by sampled splitters.

Records are ordered by (key, tie). A size-weighted sample of these pairs gives quantile boundaries, records are
dealt into the ranges between them, and ranges that turn out overfull are sampled again and subdivided. Shards are
runs of neighbouring ranges, cut where the running total of bytes passes each equal share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bulwark.llm.common import LONG_MIN, bounds_passed, longs, without
from bulwark.session import checkpointed

SEED = 20_011


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text, none for null, plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def range_shards(
    df: DataFrame,
    key: Column,
    tie: Column,
    size: Column,
    shards: int = 16,
    ranges_per_shard: int = 64,
    samples_per_range: int = 16,
) -> DataFrame:
    """Add `shard` (0 to shards - 1) and `slot` (0, 1, ... within the shard) so that shards hold near equal bytes.

    key, tie: long columns that order the rows; rows of one key stay together unless they fill a range or more.
    size: positive long. A range holds at most about twice the mean, so a shard is off its share by at most two
    ranges or one record, whichever is larger. Rows alike in key and tie that fill more than a range are told apart
    by their place in the scan, so df should be a table as read. The sample has about shards * ranges_per_shard * samples_per_range
    rows at any input size; only it, the boundaries and one total for each range reach the driver.
    Defined cases: null keys count as the smallest long; rows alike in key and tie are interchangeable; an empty
    table gives an empty result; input columns named shard or slot are replaced. Every row gets exactly one place.
    """
    rows = without(df, "shard", "slot").withColumns({
        "__key": F.coalesce(key, F.lit(LONG_MIN)), "__tie": F.coalesce(tie, F.lit(LONG_MIN)), "__size": size,
        "__place": F.monotonically_increasing_id(),
    })
    narrow = checkpointed(rows.select("__key", "__tie", "__size", "__place"))
    total = narrow.agg(F.coalesce(F.sum("__size"), F.lit(0)).alias("b")).first()["b"]
    ranges = shards * ranges_per_shard
    bounds, held = splitters(narrow, total, ranges, samples_per_range)
    heavy = [r for r, (b, n) in held.items() if b > 2 * max(1, total // ranges) and n > 1]
    if heavy:  # no boundary fits between rows alike in key and tie: these are told apart by their place
        alike = F.array_contains(longs(heavy), bounds_passed(F.col("__key"), F.col("__tie"), bounds).cast("long"))
        apart = F.when(alike, F.xxhash64("__place", F.lit(SEED))).otherwise(F.col("__tie"))
        rows, narrow = rows.withColumn("__tie", apart), checkpointed(narrow.withColumn("__tie", apart))
        bounds, held = splitters(narrow, total, ranges, samples_per_range)

    start, first, b, n = [], [], 0, 0
    for r in range(len(bounds) + 1):
        start.append(b)
        first.append(n)
        b, n = b + held.get(r, (0, 0))[0], n + held.get(r, (0, 0))[1]

    at = bounds_passed(F.col("__key"), F.col("__tie"), bounds)

    def shard_of(end: Column, piece: Column) -> Column:
        """The shard in which the middle of the piece lies."""
        middle = (F.get(longs(start), F.col("__range")) + end) * 2 - piece
        return F.least(F.lit(shards - 1), F.call_function("div", middle * shards, F.lit(2 * max(total, 1)))).cast("int")

    in_range = Window.partitionBy("__range").orderBy("__key")
    pieces = (
        narrow.withColumn("__range", at)
        .groupBy("__range", "__key")
        .agg(F.sum("__size").alias("piece"), F.count("*").alias("n"))
        .withColumn("shard", shard_of(F.sum("piece").over(in_range), F.col("piece")))
    )
    counts = {r["shard"]: r["n"] for r in pieces.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    before = [sum(counts.get(i, 0) for i in range(s)) for s in range(shards)]

    piece = F.sum("__size").over(Window.partitionBy("__range", "__key"))
    rank = F.row_number().over(Window.partitionBy("__range").orderBy("__key", "__tie")) - 1
    return (
        rows.withColumn("__range", at)
        .withColumns({"__end": F.sum("__size").over(in_range), "__piece": piece, "__rank": rank})
        .withColumn("shard", shard_of(F.col("__end"), F.col("__piece")))
        .withColumn("slot", (F.get(longs(first), F.col("__range")) + F.col("__rank") - F.get(longs(before), F.col("shard"))).cast("long"))
        .drop("__key", "__tie", "__size", "__place", "__range", "__end", "__piece", "__rank")
    )


def splitters(
    narrow: DataFrame, total: int, ranges: int, samples_per_range: int
) -> tuple[list[tuple[int, int]], dict[int, tuple[int, int]]]:
    """Sorted boundaries, and for each range its bytes and rows."""
    raw: set[tuple[int, int]] = set()
    pool = narrow
    mean = max(1, total // ranges)
    while True:
        grown = raw | set(quantiles(pool, max(1, mean // samples_per_range), mean))
        bounds = boundaries(grown)
        held = {
            r["r"]: (r["b"], r["n"])
            for r in narrow.groupBy(bounds_passed(F.col("__key"), F.col("__tie"), bounds).alias("r"))
            .agg(F.sum("__size").alias("b"), F.count("*").alias("n"))
            .collect()
        }
        overfull = [r for r, (b, n) in held.items() if b > 2 * mean and n > 1]
        if not overfull or grown == raw:
            return bounds, held
        raw = grown
        mine = F.array_contains(longs(overfull), bounds_passed(F.col("__key"), F.col("__tie"), bounds).cast("long"))
        pool = narrow.where(mine)
        samples_per_range *= 2  # a finer draw inside the ranges that were too full


def quantiles(pool: DataFrame, step: int, mean: int) -> list[tuple[int, int]]:
    """Draw each row with probability size / step, and take a key whenever `mean` more bytes have passed."""
    drawn = (
        pool.where(F.pmod(F.xxhash64(F.col("__tie"), F.col("__key"), F.lit(SEED)), F.lit(step)) < F.col("__size"))
        .select("__key", "__tie", F.greatest(F.col("__size"), F.lit(step)).alias("w"))
        .collect()
    )
    out, passed = [], 0
    for k, t, w in sorted(tuple(r) for r in drawn):
        if passed + w / 2 >= mean:
            out.append((k, t))
            passed = 0
        passed += w
    return out


def boundaries(raw: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """A key that no other boundary has is cut in front of its first row, so that its rows stay together."""
    own: dict[int, int] = {}
    for k, _ in raw:
        own[k] = own.get(k, 0) + 1
    return sorted({(k, t if own[k] > 1 else LONG_MIN) for k, t in raw})
