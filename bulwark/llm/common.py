"""Small helpers of this subpackage: literals of bounded tables, searches in them, column names."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG_MIN = -(2**63)


def longs(values: list[int]) -> Column:
    """A constant array of longs. Only for lists with a bound."""
    return F.from_json(F.lit(json.dumps([int(v) for v in values])), "array<bigint>")


def doubles(values: list[float]) -> Column:
    """A constant array of doubles. Only for lists with a bound."""
    return F.from_json(F.lit(json.dumps([float(v) for v in values])), "array<double>")


def bounds_passed(major: Column, minor: Column, bounds: list[tuple[int, int]]) -> Column:
    """How many of the sorted (major, minor) bounds are at or below the row's pair: a binary search."""
    n = len(bounds)
    if not n:
        return F.lit(0)
    majors, minors = longs([b[0] for b in bounds]), longs([b[1] for b in bounds])
    steps = [1 << i for i in reversed(range(n.bit_length()))]

    def move(at: Column, step: Column) -> Column:
        to = at + step
        k, t = F.get(majors, to - 1), F.get(minors, to - 1)
        return F.when((to <= n) & ((k < major) | ((k == major) & (t <= minor))), to).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), move)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns that the operator is about to add; names match regardless of case."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def plainly_named(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The columns renamed c0, c1, ..., and which is which, so that no name clashes with an operator's."""
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names, strict=True))
