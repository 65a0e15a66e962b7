"""Joins and counts that hold when one key owns a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot from 1/HOT_SHARE of all rows up, so there can be at most HOT_SHARE hot keys.
# That bound is what makes broadcasting them safe at any size of the table.
HOT_SHARE = 1000
# Below this many rows a key fits one task anyway.
HOT_FLOOR = 100_000
SALTS = 64


def text_digest(text: Column) -> Column:
    """256-bit key of a text: groups and shuffles move 32 bytes instead of the text."""
    return F.unhex(F.sha2(text, 256))


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key. Counts are combined before the shuffle, so a hot key costs one row per task."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def hot_keys(counts: DataFrame, keys: list[str], floor: int = HOT_FLOOR) -> DataFrame:
    """Keys with at least 1/HOT_SHARE of all rows: HOT_SHARE rows at most."""
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.where((F.col("n") >= floor) & (F.col("n") * HOT_SHARE >= total)).select(
        *keys, F.lit(True).alias("_hot")
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str,
    row_id: str,
    counts: DataFrame | None = None,
    salts: int = SALTS,
    floor: int = HOT_FLOOR,
) -> DataFrame:
    """Equi-join of a skewed left side with a right side that is unique per key.

    Left rows of hot keys are spread over `salts` partitions by their id, and the right rows of
    those few keys are repeated once per salt. All other rows join as usual.
    """
    counts = key_counts(left, keys) if counts is None else counts
    hot = F.broadcast(hot_keys(counts, keys, floor))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int")).otherwise(0)
    spread = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    l = left.join(hot, keys, "left").withColumn("_salt", salt).drop("_hot")
    r = right.join(hot, keys, "left").withColumn("_salt", F.explode(spread)).drop("_hot")
    return l.join(r, [*keys, "_salt"], how).drop("_salt")
