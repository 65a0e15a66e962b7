"""Mixing sources by temperature.

Token shares p become weights p^a / sum p^a. The exponent a (1: as found, 0: all alike) is bisected until the
weights just meet a target entropy or a limit on how often a source repeats. Weights are realised by a budget of
tokens for each source, filled with seeded permutations of its documents, one after another, the last one cut off
where the budget ends; blocks take an equal part of every source's budget.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bulwark.llm.common import without
from bulwark.session import checkpointed

SEED = "mix"
#: Places of a permutation that one window ranks: 1 / DEALS of a source, as a digest decides.
DEALS = 4096
STEPS = 40
#: Up to so many sources their budgets are broadcast; beyond, the join is left to Spark.
BROADCAST_SOURCES = 10_000


@dataclass(frozen=True)
class Plan:
    """Exponent, tokens of the mixture, and sources of the input."""

    exponent: float
    budget: int
    sources: int


def tokens(text: Column) -> Column:
    """Words between white space, and 1, so that an empty document has a place too."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")) + 1).cast("long")


def order_key(id_: Column, epoch: Column) -> Column:
    """Place of a document in a permutation: a digest that any SQL engine can repeat."""
    return F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(id_.cast("string"), F.lit("")), epoch.cast("string")))


def bisected(fits, steps: int = STEPS) -> float:
    """The smallest exponent between 0 and 1 that fits, if all above it fit and 1 does."""
    low, high = 0.0, 1.0
    if fits(low):
        return low
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    return high


def fit_exponent(totals: DataFrame, entropy: float | None, repeats: float | None) -> Plan:
    """totals: tokens n of each source. Both targets hold if both are given; neither: shares stay as found.

    entropy: the least normalised entropy (0 to 1) of the weights; the largest exponent that reaches it.
    repeats: the most often that a source is read; the smallest exponent that keeps to it. It wins over entropy.
    The budget is the least that reads every source whole. Sums over sources run in Spark for a grid of exponents at
    once, so any number of sources will do; each pass narrows the exponent 64 times.
    """
    total, k, most, least = totals.agg(F.sum("n"), F.count("*"), F.max("n"), F.min("n")).first()
    if not k:
        return Plan(1.0, 0, 0)
    if k == 1 or (entropy is None and repeats is None):
        return Plan(1.0, total, k)
    low = 0.0
    # The largest source has the smallest ratio of tokens to weight, so it is read once and source i
    # (most / n_i)^(1 - a) times; the smallest source decides.
    if repeats is not None and most > least:
        low = bisected(lambda a: (most / least) ** (1.0 - a) <= max(1.0, repeats))
    if entropy is None:
        exponent = low
    else:
        a, b, p = low, 1.0, F.col("n") / total
        for _ in range(STEPS // 6):
            grid = [a + (b - a) * i / 64 for i in range(65)]
            sums = totals.agg(*[x for g in grid for x in (F.sum(p**g), F.sum(p**g * g * F.log(p)))]).first()
            h = [(math.log(z) - s / z) / math.log(k) for z, s in zip(sums[::2], sums[1::2], strict=True)]
            i = max((j for j in range(65) if h[j] >= entropy - 1e-9), default=0)
            a, b = grid[i], grid[min(64, i + 1)]
        exponent = a
    exponent = round(exponent, 6)
    # tokens / weight of the largest source: total * p_max * sum p^a / p_max^a
    scale = totals.agg(F.sum((F.col("n") / most) ** F.lit(exponent))).first()[0]
    return Plan(exponent, round(most * scale), k)


def mix(
    docs: DataFrame,
    source: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    entropy: float | None = None,
    repeats: float | None = 4.0,
    blocks: int = 64,
    budget: int | None = None,
) -> tuple[DataFrame, Plan]:
    """Rows of docs, once for each time they are taken, plus epoch, block and weight (their source's).

    Every source is read whole at least once if no budget is given, so nothing is left out; a smaller budget takes
    less of every source by its weight. A document is taken if the tokens in front of it in its source's stream are
    fewer than the source's budget. The block of a document is the part of the budget in which it begins. Running
    totals are kept within 1 / 4096 of a source's permutation and shifted by the totals in front, so a source with
    a third of all rows is no task's burden. A row taken several times travels as often, its text with it.
    Defined cases: null is a source like any other; empty and null texts count one token; rows that share id and
    text are separate rows, taken alike or not by their order; no rows give no rows, nor does a budget of 0, nor a
    source whose part of the budget comes to less than a token (it is rounded up from a millionth of one on); input columns epoch, block and
    weight are replaced.
    """
    rows = without(docs, "epoch", "block", "weight").withColumns({
        "__source": F.coalesce(source.cast("string"), F.lit("\x00")), "__n": tokens(F.col(text_col)),
    })
    totals = checkpointed(rows.groupBy("__source").agg(F.sum("__n").alias("n")))
    plan = fit_exponent(totals, entropy, repeats)
    asked = plan.budget if budget is None else budget
    most = totals.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    power = (F.col("n") / most) ** F.lit(plan.exponent)
    scale = totals.agg(F.coalesce(F.sum(power), F.lit(1.0))).first()[0]
    # A source's budget in tokens; rounding must not cost the largest source its last document.
    wanted = totals.select(
        "__source", "n", (power / scale).alias("weight"), F.ceil(power / scale * asked - 1e-6).cast("long").alias("want")
    ).withColumn("want", F.greatest("want", F.col("n")) if budget is None else F.col("want")).where("want > 0")
    epochs = F.call_function("div", F.col("want") + F.col("n") - 1, F.col("n"))
    taken = (
        rows.join(F.broadcast(wanted) if plan.sources <= BROADCAST_SOURCES else wanted, "__source")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), epochs - 1)))
    )
    # Whole permutations are taken anyway; where a document begins is needed for all of them, for its block.
    key = order_key(F.col(id_col), F.col("epoch"))
    place = taken.withColumns({"__key": key, "__deal": F.conv(F.substring(key, 1, 3), 16, 10).cast("int")})
    sums = place.groupBy("__source", "epoch", "__deal").agg(F.sum("__n").alias("tokens"))
    front = Window.partitionBy("__source", "epoch").orderBy("__deal").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("__source", "epoch", "__deal", F.coalesce(F.sum("tokens").over(front), F.lit(0)).alias("__front"))
    within = Window.partitionBy("__source", "epoch", "__deal").orderBy("__key").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("epoch") * F.col("n") + F.col("__front") + F.col("__within")
    out = (
        place.withColumn("__within", F.coalesce(F.sum("__n").over(within), F.lit(0)))
        .join(starts, ["__source", "epoch", "__deal"])
        .withColumn("__begin", begin)
        .where(F.col("__begin") < F.col("want"))
        .withColumn("block", F.call_function("div", F.col("__begin") * blocks, F.col("want")).cast("int"))
    )
    given = [F.col(f"`{c}`") for c in rows.columns if c not in ("__source", "__n")]
    return out.select(*given, F.col("epoch").cast("int").alias("epoch"), "block", "weight"), plan
