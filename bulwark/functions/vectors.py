"""Scores over class-probability arrays (array<double>)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bulwark.functions.seeded import let

P_MIN = 1e-10
OUT_OF_RANGE_LOSS = 5.0
ALPHA, BETA, GAMMA = 0.4, 0.5, 0.2


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def softmax(logits: Column) -> Column:
    """Softmax, shifted by the largest logit so that exp() cannot overflow."""
    shifted = let(F.array_max(logits), lambda top: F.transform(logits, lambda x: F.exp(x - top)))
    return let(shifted, lambda e: let(total(e), lambda s: F.transform(e, lambda x: x / s)))


def _clip(p: Column) -> Column:
    return F.greatest(F.lit(P_MIN), F.least(F.lit(1.0), p))


def prediction(probs: Column) -> Column:
    """Index of the largest probability, the first one on ties."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def confidence(probs: Column) -> Column:
    return F.array_max(probs)


def entropy(probs: Column) -> Column:
    return -F.aggregate(probs, F.lit(0.0), lambda a, p: a + _clip(p) * F.log(_clip(p)))


def margin(probs: Column) -> Column:
    """Largest minus second largest; a single class gives the largest itself."""
    return let(
        F.sort_array(probs, asc=False),
        lambda s: F.get(s, F.lit(0)) - F.coalesce(F.get(s, F.lit(1)), F.lit(0.0)),
    )


def true_probability(probs: Column, label: Column) -> Column:
    """Clipped probability of the true class; NULL if the label is no index of the array."""
    return F.when((label >= 0) & (label < F.size(probs)), _clip(F.get(probs, label.cast("int"))))


def true_loss(probs: Column, label: Column) -> Column:
    return F.coalesce(-F.log(true_probability(probs, label)), F.lit(OUT_OF_RANGE_LOSS))


def confidence_flip(probs: Column, label: Column) -> Column:
    return F.coalesce(F.lit(1.0) - true_probability(probs, label), F.lit(1.0))


def utility(loss: Column, flip: Column, gap: Column, beta: float = BETA) -> Column:
    return F.lit(ALPHA) * loss + F.lit(beta) * flip + F.lit(GAMMA) * (F.lit(1.0) - gap)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def nearest_distance(point: Column, centres: Column) -> Column:
    """Distance to the nearest centre of an array<array<double>>."""
    return F.array_min(F.transform(centres, lambda c: euclidean(point, c)))
