"""Seeded draws that depend only on (id, tag, seed).

`rand(seed)` depends on the partition layout, so it changes under repartitioning and when a lost
task is run again. A draw hashed from the row's id does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 42


def _text(value) -> Column:
    return value.cast("string") if isinstance(value, Column) else F.lit(str(value))


def seeded_md5(row_id: Column, tag, seed: int = SEED) -> Column:
    return F.md5(F.concat_ws(":", _text(row_id), _text(tag), F.lit(str(seed))))


def uniform(row_id: Column, tag, seed: int = SEED) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of the digest."""
    head = F.substring(seeded_md5(row_id, tag, seed), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)


def pick(row_id: Column, tag, size, seed: int = SEED) -> Column:
    """Uniform integer in [0, size)."""
    return F.floor(uniform(row_id, tag, seed) * size).cast("int")


def let(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body`, inside one expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def stratified_draw(row_id: Column, tag: str, m: Column, n: int, seed: int = SEED) -> Column:
    """Ascending array of min(n, m) distinct positions in [0, m): one per equal stratum."""

    def drawn(bounds: Column) -> Column:
        total, k = bounds["m"], bounds["k"]

        def one(i: Column) -> Column:
            lo = F.floor(i * total / k)
            hi = F.floor((i + F.lit(1)) * total / k)
            u = uniform(row_id, F.concat(F.lit(tag + "-"), i.cast("string")), seed)
            return (lo + F.floor(u * (hi - lo))).cast("int")

        return F.when(total > 0, F.transform(F.sequence(F.lit(0), k - 1), one)).otherwise(
            F.array().cast("array<int>")
        )

    return let(F.struct(m.cast("int").alias("m"), F.least(F.lit(n), m.cast("int")).alias("k")), drawn)
