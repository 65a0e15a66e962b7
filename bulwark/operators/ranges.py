"""Exact quantiles, histograms and running totals without one task that sees all rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bulwark.functions import vectors
from bulwark.session import checkpointed

ONE_TASK = 1_000_000  # values one task may hold
BINS = 4096
ACCURACY = 100_000  # ranks a sketch tells apart


def kth_smallest(df: DataFrame, col: str, k: int, lo: float, hi: float, n: int, one_task: int = ONE_TASK) -> float:
    """The value at position k (from 0) in sorted order.

    Counts per bin narrow the range around position k until one task can hold what is left. Each
    pass sends at most BINS counts to the driver.
    """
    x = F.col(col)
    while n > one_task and lo < hi and (hi - lo) / BINS > 0:
        width = (hi - lo) / BINS
        bins = (
            df.where(x.between(lo, hi))
            .groupBy(F.least(F.floor((x - lo) / width), F.lit(BINS - 1)).alias("b"))
            .agg(F.count("*").alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"))
            .orderBy("b").collect()
        )
        for b in bins:
            if k < b["n"]:
                lo, hi, n = float(b["lo"]), float(b["hi"]), b["n"]
                break
            k -= b["n"]
    if lo == hi:
        return lo
    counts = df.where(x.between(lo, hi)).groupBy(x.alias("v")).agg(F.count("*").alias("n"))
    upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy("v")))
    return float(upto.where(F.col("upto") > k).agg(F.min("v")).first()[0])


def exact_quantile(df: DataFrame, col: str, q: float, one_task: int = ONE_TASK, accuracy: int = ACCURACY) -> Column:
    """Linearly interpolated quantile as a literal, null without values. Two scans.

    The first builds a mergeable sketch, which brackets both order statistics around q within a few `accuracy`-ths of
    all rows. The second counts what lies below the bracket and each value in it; one task orders those values. If
    the bracket should miss (it is checked), counts per bin narrow the whole range instead.
    """
    d = df.select(F.col(col).cast("double").alias(col)).where(F.col(col).isNotNull())
    x = F.col(col)
    around = [F.lit(min(1.0, max(0.0, q + side * 2.0 / accuracy))) for side in (-1, 1)]
    n, lo, hi, bracket = d.agg(F.count("*"), F.min(x), F.max(x), F.percentile_approx(x, F.array(*around), accuracy)).first()
    if not n:
        return F.lit(None).cast("double")
    at = q * (n - 1)
    first, second = math.floor(at), math.ceil(at)
    # Near an end, or with fewer rows than the sketch tells apart, the end itself is the bound.
    low = lo if first <= 4 * n / accuracy + 1 else bracket[0]
    high = hi if n - 1 - second <= 4 * n / accuracy + 1 else bracket[1]
    value = F.when(x.between(low, high), x).when(x > high, F.lit(float("inf")))  # null: below
    counts = d.groupBy(value.alias("v")).agg(F.count("*").alias("n"))
    upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy(F.asc_nulls_first("v"))))
    below, a, b = upto.agg(
        F.coalesce(F.max(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)),
        F.min(F.when(F.col("upto") > first, F.col("v"))), F.min(F.when(F.col("upto") > second, F.col("v")))).first()
    if below > first or b > high:
        a = kth_smallest(d, col, first, lo, hi, n, one_task)
        b = a if second == first else kth_smallest(d, col, second, lo, hi, n, one_task)
    return F.lit(a + (b - a) * (at - first))


def bin_index(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin in [0, bins); the largest value falls into the last one."""
    inside = F.floor((x - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins)
    return F.coalesce(F.least(inside, F.lit(bins - 1)), F.lit(bins // 2)).cast("int")


def length_counts(df: DataFrame, text: str = "full_text", by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*by, F.length(text).alias("length")).agg(F.count("*").alias("n"))


def length_histogram(df: DataFrame, text: str = "full_text", bins: int = 50) -> DataFrame:
    """(bin, n, mean_length, median_length) from the counts per distinct length."""
    counts = length_counts(df, text)
    s = counts.agg(F.struct(
        F.min("length").cast("double").alias("lo"), F.max("length").cast("double").alias("hi"),
        (F.sum(F.col("length") * F.col("n")) / F.sum("n")).alias("mean"),
        F.percentile("length", 0.5, F.col("n")).alias("median"),
    ).alias("s")).scalar()
    b = bin_index(F.col("length").cast("double"), s["lo"], s["hi"], bins)
    return counts.groupBy(b.alias("bin")).agg(F.sum("n").alias("n")).select(
        "bin", "n", s["mean"].alias("mean_length"), s["median"].alias("median_length"))


def length_by_class(df: DataFrame, label: str = "label_mapped", text: str = "full_text", top: int = 10) -> DataFrame:
    """Five-number summary of text length in the largest classes, from counts per length."""
    largest = df.groupBy(label).agg(F.count("*").alias("size")).orderBy(F.desc("size"), label).limit(top)
    rows = df.join(F.broadcast(largest.select(label)), label, "left_semi")
    marks = F.percentile("length", F.array(*[F.lit(q) for q in (0.0, 0.25, 0.5, 0.75, 1.0)]), F.col("n"))
    summary = length_counts(rows, text, (label,)).groupBy(label).agg(F.sum("n").alias("n"), marks.alias("p"))
    names = ("min_length", "q1_length", "median_length", "q3_length", "max_length")
    return summary.select(label, "n", *[F.get("p", F.lit(i)).alias(c) for i, c in enumerate(names)])


def confidence_histogram(df: DataFrame, probs: str = "probs", label: str = "label") -> DataFrame:
    """(grp, bin, n): 50 bins overall, 30 bins each for right and wrong predictions."""
    p = F.col(probs)
    right = F.when(vectors.prediction(p) == F.col(label), "correct").otherwise("incorrect")
    long = df.select(vectors.confidence(p).alias("x"), F.explode(F.array(F.lit("all"), right)).alias("grp"))
    bounds = long.groupBy("grp").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))  # three groups
    binned = long.join(F.broadcast(bounds), "grp")
    overall = bin_index(F.col("x"), F.col("lo"), F.col("hi"), 50)
    part = bin_index(F.col("x"), F.col("lo"), F.col("hi"), 30)
    b = F.when(F.col("grp") == "all", overall).otherwise(part)
    return binned.groupBy("grp", b.alias("bin")).agg(F.count("*").alias("n"))


def roc_steps(df: DataFrame, probs: str = "probs", label: str = "label") -> DataFrame:
    """One-vs-rest: per class and distinct score the counts there (pos, neg) and from the top down (tp, fp).

    Rows are first counted per (class, score). Running totals over a class would bring all its
    scores into one task, so the counts are range-partitioned by (class, score), summed inside each
    partition and shifted by the totals of the partitions in front. The checkpoint pins the
    partition numbers, which both steps must agree on.
    """
    long = df.select(F.col(label).alias("y"), F.posexplode(probs).alias("class", "score"))
    counts = long.groupBy("class", "score").agg(
        F.count_if(F.col("y") == F.col("class")).alias("pos"), F.count_if(F.col("y") != F.col("class")).alias("neg"))
    parts = checkpointed(
        counts.repartitionByRange("class", F.desc("score")).withColumn("_part", F.spark_partition_id()))
    ahead = Window.partitionBy("class").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("class")
    # One row per class and partition it touches: at most partitions + classes rows.
    offsets = parts.groupBy("class", "_part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).select(
        "class", "_part",
        F.coalesce(F.sum("p").over(ahead), F.lit(0)).alias("_p0"),
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_n0"),
        F.sum("p").over(whole).alias("positives"),
        F.sum("n").over(whole).alias("negatives"),
    )
    inside = Window.partitionBy("class", "_part").orderBy(F.desc("score"))
    return (
        parts.withColumns({"_p": F.sum("pos").over(inside), "_n": F.sum("neg").over(inside)})
        .join(F.broadcast(offsets), ["class", "_part"])
        .select("class", "score", "pos", "neg", (F.col("_p") + F.col("_p0")).alias("tp"),
                (F.col("_n") + F.col("_n0")).alias("fp"), "positives", "negatives")
    )


def roc_curve(df: DataFrame, probs: str = "probs", label: str = "label") -> DataFrame:
    return roc_steps(df, probs, label).select(
        "class", F.col("score").alias("threshold"),
        (F.col("fp") / F.nullif("negatives", F.lit(0))).alias("fpr"),
        (F.col("tp") / F.nullif("positives", F.lit(0))).alias("tpr"),
    )


def roc_auc(df: DataFrame, probs: str = "probs", label: str = "label") -> DataFrame:
    """Trapezoid area per class. A step's trapezoid follows from its own counts."""
    area = F.col("neg") * (2 * F.col("tp") - F.col("pos"))
    return roc_steps(df, probs, label).groupBy("class").agg(
        (F.sum(area) / F.nullif(2.0 * F.max("positives") * F.max("negatives"), F.lit(0.0))).alias("auc"))
