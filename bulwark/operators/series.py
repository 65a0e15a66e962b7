"""Per-run series: efficiency, drift, schedules, early stopping. A run holds one row per iteration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Defaults of the adaptive schedule.
BUDGET, BUDGET_MIN, BUDGET_MAX, BUDGET_STEP = 50, 10, 100, 10
GAIN, DRIFT = 0.01, 0.02
TAU, TAU_RATE, TARGET_ASR, TAU_MIN, TAU_MAX = 0.7, 0.1, 0.3, 0.1, 0.95
DRIFT_TAU_MIN, DRIFT_TAU_STEP = 0.3, 0.1

BETTER_HIGH = ("clean_accuracy", "robust_accuracy", "f1_macro", "f1_weighted")
BETTER_LOW = ("attack_success_rate",)


def _window(run: list[str]):
    return Window.partitionBy(*run).orderBy("iteration")


def round_metrics(df: DataFrame) -> DataFrame:
    rates = ("clean_accuracy", "robust_accuracy", "attack_success_rate")
    return df.withColumns({c: F.round(c, 4) for c in rates if c in df.columns})


def final_iteration(df: DataFrame, run: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in run]
    return df.groupBy(*run).agg(F.max_by(F.struct(*rest), "iteration").alias("f")).select(*run, "f.*")


def exclude_baseline(df: DataFrame, run: list[str]) -> DataFrame:
    """Iterations with labelled samples; for a run without any its last row."""
    labelled = F.col("n_labeled_samples") > 0
    w = Window.partitionBy(*run)
    return (
        df.withColumns({
            "_any": F.max(labelled).over(w),
            "_last": F.max("iteration").over(w) == F.col("iteration"),
        })
        .where(labelled | (~F.col("_any") & F.col("_last")))
        .drop("_any", "_last")
    )


def best_iteration(df: DataFrame, run: list[str]) -> DataFrame:
    """Highest robust accuracy among labelled iterations, the earliest on ties."""
    order = Window.partitionBy(*run).orderBy(F.desc("robust_accuracy"), "iteration")
    kept = exclude_baseline(df, run).withColumn("_rank", F.row_number().over(order))
    return kept.where("_rank = 1").drop("_rank")


def efficiency(df: DataFrame, run: list[str]) -> DataFrame:
    """Per iteration after the first: cumulative and marginal robustness gain per labelled sample."""
    w = _window(run)
    n, robust = F.col("n_labeled_samples"), F.col("robust_accuracy")
    delta = robust - F.first("robust_accuracy").over(w)
    cumulative = delta / F.greatest(n, F.lit(1))
    marginal = (robust - F.lag("robust_accuracy").over(w)) / F.greatest(
        n - F.lag("n_labeled_samples").over(w), F.lit(1))
    step = F.row_number().over(w) - 1
    return df.select(
        *run, "iteration", step.alias("step"), "robust_accuracy", "n_labeled_samples",
        delta.alias("delta_robust"), cumulative.alias("cumulative_efficiency"),
        F.when(step == 1, cumulative).otherwise(marginal).alias("marginal_efficiency"),
    ).where("step > 0")


def label_efficiency(df: DataFrame, run: list[str]) -> DataFrame:
    """Per run: mean, final and largest efficiency and the total gain; zeros below two rows."""
    last = efficiency(df, run).groupBy(*run).agg(
        F.avg("cumulative_efficiency").alias("label_efficiency"),
        F.max_by("cumulative_efficiency", "iteration").alias("final_efficiency"),
        F.max("cumulative_efficiency").alias("max_efficiency"),
        F.max_by("delta_robust", "iteration").alias("total_delta_robust"),
        F.max_by("n_labeled_samples", "iteration").alias("total_labeled"),
    )
    figures = ("label_efficiency", "final_efficiency", "max_efficiency", "total_delta_robust")
    runs = df.groupBy(*run).agg(F.count("*").alias("n_rows"))
    return runs.join(last, run, "left").select(
        *run, "n_rows", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in figures],
        F.coalesce("total_labeled", F.lit(0)).alias("total_labeled"))


def strategy_comparison(df: DataFrame, run: list[str]) -> DataFrame:
    """Final figures and efficiency of every run of at least two rows."""
    final = final_iteration(df, run).select(
        *run,
        F.col("robust_accuracy").alias("final_robust_accuracy"),
        F.col("clean_accuracy").alias("final_clean_accuracy"),
        F.col("attack_success_rate").alias("final_asr"),
        F.col("n_labeled_samples").alias("total_labeled"),
    )
    eff = label_efficiency(df, run).where("n_rows >= 2").select(*run, "label_efficiency", "total_delta_robust")
    return final.join(eff, run)


def timeline_deltas(df: DataFrame, run: list[str]) -> DataFrame:
    """Logged rows: rounded metrics; from iteration 1 on the gain over the first logged row."""
    w = _window(run)
    delta = F.col("robust_accuracy") - F.first(F.round("robust_accuracy", 4)).over(w)
    later = (F.col("iteration") > 0) & (F.row_number().over(w) > 1)
    n = F.col("n_labeled_samples")
    return round_metrics(df.withColumns({
        "label_efficiency": F.when(later, F.when(n > 0, F.round(delta / n, 6)).otherwise(0.0)),
        "delta_robust_accuracy": F.when(later, F.round(delta, 4)),
    }))


def drift_alerts(df: DataFrame, run: list[str], drift: float = DRIFT, start: float = 0.0) -> DataFrame:
    """Change of robust accuracy against the previous active round, and whether it is an alert."""
    active = df.where("iteration >= 1")
    before = F.coalesce(F.lag("robust_accuracy").over(_window(run)), F.lit(start))
    return active.withColumn("delta_robust", F.col("robust_accuracy") - before).withColumn(
        "drift_alert", (F.col("delta_robust") < -drift) & (F.col("iteration") > 1))


def adaptive_step(budget: Column, tau: Column, delta: Column, asr: Column, iteration: Column) -> tuple[Column, Column]:
    """Next budget and threshold from the last round's figures."""
    moved = F.when(delta > GAIN, F.greatest(F.lit(BUDGET_MIN), budget - BUDGET_STEP)).otherwise(
        F.least(F.lit(BUDGET_MAX), budget + BUDGET_STEP))
    new_tau = F.greatest(F.lit(TAU_MIN), F.least(F.lit(TAU_MAX), tau - TAU_RATE * (asr - TARGET_ASR)))
    alert = (delta < -DRIFT) & (iteration > 1)
    return (
        F.when(alert, F.lit(BUDGET_MAX)).otherwise(moved),
        F.when(alert, F.greatest(F.lit(DRIFT_TAU_MIN), new_tau - DRIFT_TAU_STEP)).otherwise(new_tau),
    )


def adaptive_schedule(df: DataFrame, run: list[str], budget: int = BUDGET, tau: float = TAU,
                      start: float = 0.0) -> DataFrame:
    """Budget and threshold after each active round: a fold over the run's few rows."""
    rounds = F.array_sort(F.collect_list(F.struct("iteration", "robust_accuracy", "attack_success_rate")))

    def state(b, t, prev, delta, rows):
        return F.struct(b.cast("int").alias("budget"), t.cast("double").alias("tau"),
                        prev.cast("double").alias("prev"), delta.cast("double").alias("delta"), rows.alias("rows"))

    def step(acc, x):
        delta = x["robust_accuracy"] - acc["prev"]
        b, t = adaptive_step(acc["budget"], acc["tau"], delta, x["attack_success_rate"], x["iteration"])
        row = F.struct(x["iteration"].alias("iteration"), b.cast("int").alias("budget"),
                       t.cast("double").alias("tau"), delta.alias("delta_robust"))
        return state(b, t, x["robust_accuracy"], delta, F.concat(acc["rows"], F.array(row)))

    empty = F.array().cast("array<struct<iteration:int,budget:int,tau:double,delta_robust:double>>")
    first = state(F.lit(budget), F.lit(tau), F.lit(start), F.lit(0.0), empty)
    folded = df.where("iteration >= 1").groupBy(*run).agg(rounds.alias("rounds")).select(
        *run, F.explode(F.aggregate("rounds", first, step)["rows"]).alias("s"))
    return folded.select(*run, "s.*")


def early_stop(df: DataFrame, run: list[str], score: str = "dev_f1", patience: int = 5) -> DataFrame:
    """Per run: best epoch before stopping, and the epoch at which `patience` epochs brought no new best."""
    w = Window.partitionBy(*run).orderBy("epoch")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    steps = df.withColumns({
        "_step": F.row_number().over(w),
        "_new": F.col(score) > F.coalesce(F.max(score).over(before), F.lit(0.0)),
    })
    steps = steps.withColumn("_best", F.coalesce(F.max(F.when(F.col("_new"), F.col("_step"))).over(w), F.lit(0)))
    stops = steps.withColumn("_stop", F.col("_step") - F.col("_best") >= patience)
    first_stop = F.min(F.when(F.col("_stop"), F.col("epoch"))).over(Window.partitionBy(*run))
    used = stops.withColumn("stop_epoch", first_stop).where(
        F.col("stop_epoch").isNull() | (F.col("epoch") <= F.col("stop_epoch")))
    return used.groupBy(*run, "stop_epoch").agg(
        F.max(F.when(F.col("_new"), F.col("epoch"))).alias("best_epoch"),
        F.max(F.when(F.col("_new"), F.col(score))).alias("best_score"),
        F.max("epoch").alias("last_epoch"),
    )


def best_per_metric(df: DataFrame, name: str = "model") -> DataFrame:
    """(metric, best): the largest value wins, for the attack success rate the smallest; then the name."""
    metrics = [m for m in (*BETTER_HIGH, *BETTER_LOW) if m in df.columns]
    long = df.select(name, *metrics).unpivot([name], metrics, "metric", "value")
    key = F.struct(F.when(F.col("metric").isin(*BETTER_LOW), F.col("value")).otherwise(-F.col("value")), F.col(name))
    return long.groupBy("metric").agg(F.min_by(name, key).alias("best"))


def relative_efficiency(df: DataFrame, seed: str = "seed", strategy: str = "strategy",
                        base: str = "random") -> DataFrame:
    """Per strategy: mean final figures over seeds, and efficiency relative to the base strategy."""
    run = [seed, strategy]
    finals = label_efficiency(df, run).where("n_rows >= 2").join(
        final_iteration(df, run).select(*run, "robust_accuracy"), run)
    means = finals.groupBy(strategy).agg(
        F.avg("robust_accuracy").alias("robust_accuracy"),
        F.avg("total_delta_robust").alias("delta_from_baseline"),
        F.avg("final_efficiency").alias("mean_efficiency"),
    )
    reference = means.where(F.col(strategy) == base).agg(
        F.coalesce(F.max("mean_efficiency"), F.lit(1e-10)).alias("r")).scalar()
    return means.withColumn(
        "relative_efficiency", F.col("mean_efficiency") / F.greatest(F.abs(reference), F.lit(1e-10)))
