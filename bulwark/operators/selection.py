"""Scoring, selecting, sampling, capping and balancing."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bulwark.functions import vectors
from bulwark.functions.perturb import augment_random
from bulwark.functions.seeded import SEED, pick, seeded_md5, uniform
from bulwark.functions.text import OTHER
from bulwark.session import checkpointed

# Seeded draws fall evenly into this many buckets, whatever the data.
BUCKETS = 65536
# Rows a core-set pass sends to the driver.
CORESET_BATCH = 256


def score_pool(df: DataFrame, probs: str = "probs", label: str = "label", beta: float = vectors.BETA) -> DataFrame:
    p, y = F.col(probs), F.col(label)
    return df.withColumns({
        "entropy": vectors.entropy(p),
        "margin": vectors.margin(p),
        "loss": vectors.true_loss(p, y),
        "confidence_flip": vectors.confidence_flip(p, y),
    }).withColumn("utility", vectors.utility(F.col("loss"), F.col("confidence_flip"), F.col("margin"), beta))


def low_confidence(df: DataFrame, tau: float = 0.7, probs: str = "probs") -> DataFrame:
    p = F.col(probs)
    return df.where(vectors.confidence(p) < tau).withColumns({
        "prediction": vectors.prediction(p),
        "confidence": vectors.confidence(p),
        "entropy": vectors.entropy(p),
    })


def candidates(df: DataFrame, row_id: str, tau: float = 0.7) -> DataFrame:
    """First attack per record, in suite order, that flips a right prediction or leaves low confidence.

    Input: one row per (record, attack) with attack_order, label, original_pred, adv_pred and
    adv_confidence.
    """
    flipped = (F.col("original_pred") == F.col("label")) & (F.col("adv_pred") != F.col("label"))
    kind = F.when(flipped, "_misclassification").when(F.col("adv_confidence") < tau, "_low_confidence")
    hits = df.withColumn("detection_method", F.concat("attack", kind)).where("detection_method IS NOT NULL")
    rest = [c for c in hits.columns if c != row_id]
    return hits.groupBy(row_id).agg(F.min_by(F.struct(*rest), "attack_order").alias("c")).select(row_id, "c.*")


def select_entropy(df: DataFrame, row_id: str, budget: int) -> DataFrame:
    return df.orderBy(F.desc("entropy"), row_id).limit(budget)


def select_margin(df: DataFrame, row_id: str, budget: int) -> DataFrame:
    return df.orderBy("margin", row_id).limit(budget)


def select_composite(df: DataFrame, row_id: str, budget: int) -> DataFrame:
    return df.orderBy(F.desc("utility"), row_id).limit(budget)


def select_random(df: DataFrame, row_id: str, budget: int, seed: int = SEED) -> DataFrame:
    return df.orderBy(seeded_md5(F.col(row_id), "random", seed), row_id).limit(budget)


def _distance(a: list[float], b: list[float]) -> float:
    acc = 0.0
    for x, y in zip(a, b):
        acc = acc + (x - y) * (x - y)
    return math.sqrt(acc)


def coreset_order(df: DataFrame, row_id: str, budget: int, probs: str = "probs",
                  batch: int = CORESET_BATCH) -> list:
    """Ids in greedy k-center order, starting at the smallest id.

    One pass over the pool fetches the `batch` farthest rows. Distances to the chosen set only
    shrink, so as long as the farthest of those rows is farther than the last one fetched, no row
    outside the batch can be the next centre, and the greedy choice goes on without another pass.
    """
    state = checkpointed(df.select(row_id, F.col(probs).alias("_p")))  # score the pool once, not once per pass
    first = state.orderBy(row_id).first()
    if first is None:
        return []
    chosen, new, passes = [first[0]], [list(first["_p"])], 0
    state = state.withColumn("_d", F.lit(float("inf")))
    while len(chosen) < budget:
        centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in new])
        state = state.withColumn("_d", F.least("_d", vectors.nearest_distance(F.col("_p"), centres)))
        passes += 1
        if passes % 8 == 0:
            state = checkpointed(state)
        far = state.where(~F.col(row_id).isin(chosen)).orderBy(F.desc("_d"), row_id).limit(batch).collect()
        if not far:
            break
        bound = far[-1]["_d"] if len(far) == batch else -1.0
        open_rows = [[r["_d"], r[row_id], list(r["_p"])] for r in far]
        new = []
        while open_rows and len(chosen) < budget:
            best = max(range(len(open_rows)), key=lambda i: open_rows[i][0])  # first one on ties
            d, best_id, p = open_rows[best]
            if new and not d > bound:
                break
            chosen.append(best_id)
            new.append(p)
            del open_rows[best]
            for r in open_rows:
                r[0] = min(r[0], _distance(r[2], p))
    return chosen


def select_coreset(df: DataFrame, row_id: str, budget: int, probs: str = "probs",
                   batch: int = CORESET_BATCH) -> DataFrame:
    """Greedy k-center rows of the pool, with their rank. Only `budget` ids pass through the driver."""
    ids = coreset_order(df, row_id, budget, probs, batch)
    id_type = df.schema[row_id].dataType.simpleString()
    ranks = df.sparkSession.createDataFrame(
        [(i, k + 1) for k, i in enumerate(ids)], f"{row_id} {id_type}, rank int")
    return df.join(F.broadcast(ranks), row_id)


def select_entropy_coreset(df: DataFrame, row_id: str, budget: int, probs: str = "probs") -> DataFrame:
    """Core-set of the 2B rows of highest entropy; like the list it starts from the first of them."""
    pool = select_entropy(df, row_id, 2 * budget)
    ranked = pool.withColumn("_order", F.row_number().over(Window.orderBy(F.desc("entropy"), row_id)))  # 2B rows
    return select_coreset(ranked, "_order", budget, probs).drop("_order")


STRATEGIES = {
    "entropy": (select_entropy, lambda: [F.desc("entropy")]),
    "margin": (select_margin, lambda: [F.col("margin")]),
    "composite": (select_composite, lambda: [F.desc("utility")]),
}


def with_rank(selected: DataFrame, row_id: str, order: list[Column]) -> DataFrame:
    """1-based rank. The window holds one round's budget of rows."""
    return selected.withColumn("rank", F.row_number().over(Window.orderBy(*order, row_id)))


def select_top_b(scored: DataFrame, row_id: str, strategy: str, budget: int, seed: int = SEED) -> DataFrame:
    """The budgeted selection of any strategy, ranked."""
    if strategy in STRATEGIES:
        choose, order = STRATEGIES[strategy]
        return with_rank(choose(scored, row_id, budget), row_id, order())
    if strategy == "random":
        key = seeded_md5(F.col(row_id), "random", seed)
        return with_rank(select_random(scored, row_id, budget, seed), row_id, [key])
    if strategy == "coreset":
        return select_coreset(scored, row_id, budget)
    if strategy == "entropy_coreset":
        return select_entropy_coreset(scored, row_id, budget)
    raise ValueError(f"unknown strategy {strategy}")


def rank_within(scored: DataFrame, row_id: str, group: str, strategy: Column, budget: Column, most: int, seed: int = SEED) -> DataFrame:
    """Budgeted selections of several groups at once, by the strategies that order rows by one figure.

    strategy and budget are columns, alike for all rows of a group; `most` is the largest budget, which lets every
    task drop rows early.
    """
    figure = (
        F.when(strategy == "entropy", -F.col("entropy")).when(strategy == "margin", F.col("margin"))
        .when(strategy == "composite", -F.col("utility")).otherwise(0.0)
    )
    draw = F.when(strategy == "random", seeded_md5(F.col(row_id), "random", seed)).otherwise("")
    keyed = scored.withColumns({"_figure": figure, "_draw": draw, "_budget": budget})
    rank = F.row_number().over(Window.partitionBy(group).orderBy("_figure", "_draw", row_id))
    kept = keyed.withColumn("rank", rank).where((F.col("rank") <= most) & (F.col("rank") <= F.col("_budget")))
    return kept.drop("_figure", "_draw", "_budget")


def _drawn(df: DataFrame, row_id: str, tag: str, seed: int) -> DataFrame:
    return df.withColumn("_u", uniform(F.col(row_id), tag, seed)).withColumn(
        "_bucket", F.floor(F.col("_u") * BUCKETS).cast("int"))


def _smallest_draws(drawn: DataFrame, row_id: str, keys: list[str], n: int) -> DataFrame:
    """Exactly the n rows with the smallest draws (per key).

    Counts per bucket of the draw give the last bucket needed and how many rows lie in front of it.
    Rows of earlier buckets are all taken as they are; only the last one is ranked, so no task ever
    ranks more than the rows of one bucket, 1/BUCKETS of a class, however hot it is. Null is a key
    like any other.
    """
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("_bucket"))  # at most BUCKETS rows per key
    counts = drawn.groupBy(*keys, "_bucket").agg(F.count("*").alias("n")).withColumn("_before", upto - F.col("n"))
    last = counts.where(F.col("_before") < n).groupBy(*keys).agg(
        F.max("_bucket").alias("_last"), F.max("_before").alias("_before"))
    if keys:
        own = last.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_last", "_before")
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
        cut = drawn.join(own, same).drop(*[f"_of_{k}" for k in keys])
    else:
        row = last.select(F.struct("_last", "_before").alias("s")).scalar()
        cut = drawn.withColumn("_s", row).select("*", "_s.*").drop("_s")
    rank = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy("_u", row_id))
    edge = cut.where(F.col("_bucket") == F.col("_last")).withColumn("_rank", rank).where(
        F.col("_rank") <= n - F.col("_before")).drop("_rank")
    return cut.where(F.col("_bucket") < F.col("_last")).unionByName(edge).drop("_u", "_bucket", "_last", "_before")


def exact_sample(df: DataFrame, row_id: str, n: int, tag: str = "sample", seed: int = SEED) -> DataFrame:
    """Exactly min(n, rows) rows, the ones with the smallest draws."""
    return _smallest_draws(_drawn(df, row_id, tag, seed), row_id, [], n)


def cap_classes(df: DataFrame, row_id: str, label: str, cap: int, tag: str = "cap", seed: int = SEED) -> DataFrame:
    """At most `cap` rows per class, the ones with the smallest draws; rows without a class are one."""
    return _smallest_draws(_drawn(df, row_id, tag, seed), row_id, [label], cap)


def shuffle_rows(df: DataFrame, row_id: str, tag: str = "shuffle", seed: int = SEED) -> DataFrame:
    """Add `position` (from 1), a seeded permutation of all rows.

    Draws are uniform, so the BUCKETS buckets are of even size; each is numbered on its own and
    shifted by the number of rows in front of it.
    """
    drawn = _drawn(df, row_id, tag, seed)
    upto = F.sum("n").over(Window.orderBy("_bucket"))
    before = drawn.groupBy("_bucket").agg(F.count("*").alias("n")).select(
        "_bucket", (upto - F.col("n")).alias("_before"))
    number = F.row_number().over(Window.partitionBy("_bucket").orderBy("_u", row_id))
    return (
        drawn.withColumn("_number", number)
        .join(F.broadcast(before), "_bucket")  # BUCKETS rows
        .withColumn("position", F.col("_before") + F.col("_number"))
        .drop("_u", "_bucket", "_number", "_before")
    )


def balance_other(df: DataFrame, row_id: str, n: int = 600, label: str = "label_mapped", seed: int = SEED) -> DataFrame:
    """At most `n` rows of the OTHER class; all rows of the other classes."""
    rest = df.where(~F.col(label).eqNullSafe(F.lit(OTHER)))
    return rest.unionByName(exact_sample(df.where(F.col(label) == OTHER), row_id, n, "other", seed))


def balance_classes(
    df: DataFrame,
    row_id: str,
    label: str = "label_mapped",
    text: str = "full_text",
    at_least: int = 50,
    at_most: int = 800,
    augment=augment_random,
    seed: int = SEED,
) -> DataFrame:
    """Cap large classes and fill small ones to `at_least` with augmented copies of random members.

    `augment(text, row_id, copy, seed)` gives the text of a copy. Adds is_augmented and copy (0 for
    originals). Classes that need filling have fewer than `at_least` rows, so their windows are small.
    Rows without a class are capped like a class, but not filled.
    """
    small = df.groupBy(label).agg(F.count("*").alias("_size")).where(F.col("_size") < at_least)
    number = F.row_number().over(Window.partitionBy(label).orderBy(uniform(F.col(row_id), "cap", seed), row_id))
    members = df.join(small.select(label), label, "left_semi").withColumn("_member", number)
    wanted = small.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(at_least) - F.col("_size")))).select(
        label,
        F.col("copy").cast("int").alias("copy"),
        (pick(F.col(label), F.concat(F.lit("fill-"), F.col("copy").cast("string")), F.col("_size"), seed) + 1)
        .alias("_member"),
    )
    filled = members.join(wanted, [label, "_member"]).withColumn(
        text, augment(F.col(text), F.col(row_id), F.col("copy"), seed)).drop("_member")
    originals = cap_classes(df, row_id, label, at_most, seed=seed)
    return originals.withColumns({"copy": F.lit(0), "is_augmented": F.lit(False)}).unionByName(
        filled.withColumn("is_augmented", F.lit(True)))


def rank_classes(df: DataFrame, metric: str) -> DataFrame:
    """Classes by a metric, largest first, with the mean over classes."""
    mean = df.agg(F.avg(metric).alias("mean")).scalar()
    return df.select("*", mean.alias("mean_" + metric)).orderBy(F.desc(metric), "label")
