"""Classification, robustness and experiment metrics as aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bulwark.functions.text import explain_selection, words


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def balanced(total: Column, classes: Column, size: Column) -> Column:
    return total / (classes * size)


def class_weights(df: DataFrame, label: str, num_classes: int) -> DataFrame:
    """Balanced weight per class of 0..num_classes-1 and of every other class found; 1.0 for classes without rows."""
    counts = df.groupBy(F.col(label).cast("int").alias("class")).agg(F.count("*").alias("n"))
    s = counts.agg(F.struct(F.sum("n").alias("total"), F.count("*").alias("k")).alias("s")).scalar()
    classes = df.sparkSession.range(num_classes).select(F.col("id").cast("int").alias("class"))
    return classes.join(counts, "class", "full").where("class is not null").select(
        "class", F.coalesce(balanced(s["total"], s["k"], F.col("n")), F.lit(1.0)).alias("weight"))


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def confusion_grid(counts: DataFrame) -> DataFrame:
    """Counts on the whole grid of classes that occur, 0 where a pair does not.

    Every class that occurs is set against the list of them all, so a row holds one side of the grid and no row the
    whole; the counts are added to the zero cells by their pair.
    """
    classes = counts.select(F.explode(F.array("label", "prediction")).alias("c")).distinct()
    others = classes.agg(F.array_sort(F.collect_set("c"))).scalar()
    zero = classes.select(F.col("c").alias("label"), F.explode(others).alias("prediction"), F.lit(0).cast("long").alias("n"))
    return zero.unionByName(counts.select("label", "prediction", "n")).groupBy("label", "prediction").agg(F.sum("n").alias("n"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return confusion_grid(confusion_counts(df, label, prediction))


def confusion_normalized(matrix: DataFrame) -> DataFrame:
    row = F.sum("n").over(Window.partitionBy("label"))
    return matrix.select("label", "prediction", ratio(F.col("n"), row).alias("share"))


def per_class_scores(matrix: DataFrame) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, specificity, f1 and support per class.

    Each cell of the matrix counts for its row class and its column class, so one grouping gives all.
    """
    n, same = F.col("n"), F.col("label") == F.col("prediction")
    sides = matrix.select(F.explode(F.array(
        F.struct(F.col("label").alias("label"), F.when(same, n).otherwise(0).alias("tp"),
                 F.lit(0).cast("long").alias("fp"), F.when(same, 0).otherwise(n).alias("fn")),
        F.struct(F.col("prediction").alias("label"), F.lit(0).cast("long").alias("tp"),
                 F.when(same, 0).otherwise(n).alias("fp"), F.lit(0).cast("long").alias("fn")),
    )).alias("s")).select("s.*")
    c = sides.groupBy("label").agg(*[F.sum(x).alias(x) for x in ("tp", "fp", "fn")])
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    total = c.agg(F.sum(tp + fn)).scalar()
    return c.withColumn("tn", total - tp - fp - fn).select(
        "label", "tp", "fp", "fn", "tn",
        ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(tn, tn + fp).alias("specificity"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fn).alias("support"),
    )


def _summary(scores: DataFrame) -> DataFrame:
    n, s = F.sum("support"), F.col("support")

    def weighted(x):
        return ratio(F.sum(F.col(x) * s), n)

    def micro():
        tp, fp, fn = F.sum("tp"), F.sum("fp"), F.sum("fn")
        return ratio(2 * tp, 2 * tp + fp + fn)

    return scores.agg(
        ratio(F.sum("tp"), n).alias("accuracy"),
        F.avg(F.when(s > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1").alias("f1_macro"), weighted("f1").alias("f1_weighted"), micro().alias("f1_micro"),
        F.avg("precision").alias("precision_macro"), weighted("precision").alias("precision_weighted"),
        F.avg("recall").alias("recall_macro"), weighted("recall").alias("recall_weighted"),
        n.alias("n"),
    )


SUMMARY = ("accuracy", "balanced_accuracy", "f1_macro", "f1_weighted", "f1_micro", "precision_macro",
           "precision_weighted", "recall_macro", "recall_weighted")


def summary_metrics(scores: DataFrame) -> DataFrame:
    return _summary(scores).unpivot([], list(SUMMARY), "metric", "value")


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(metric, value), with one f1_<class> row per class."""
    scores = per_class_scores(confusion_counts(df, label, prediction))
    return summary_metrics(scores).unionByName(scores.select(
        F.concat(F.lit("f1_"), F.col("label").cast("string")).alias("metric"), F.col("f1").alias("value")))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per class, then accuracy, macro avg and weighted avg."""
    scores = per_class_scores(confusion_counts(df, label, prediction))
    rows = scores.select(F.col("label").cast("string").alias("class"), "precision", "recall",
                         F.col("f1").alias("f1_score"), "support")
    s = _summary(scores).select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class"), F.col("accuracy").alias("precision"),
                 F.col("accuracy").alias("recall"), F.col("accuracy").alias("f1_score"), F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("precision_macro").alias("precision"),
                 F.col("recall_macro").alias("recall"), F.col("f1_macro").alias("f1_score"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("precision_weighted").alias("precision"),
                 F.col("recall_weighted").alias("recall"), F.col("f1_weighted").alias("f1_score"),
                 F.col("n").alias("support")),
    )).alias("s")).select("s.*")
    return rows.unionByName(s)


def _outcomes() -> dict[str, Column]:
    clean = F.col("original_pred") == F.col("label")
    robust = F.col("adv_pred") == F.col("label")
    return {
        "n_samples": F.count("*"),
        "n_originally_correct": F.count_if(clean),
        "n_robust_correct": F.count_if(robust),
        "n_successful_attacks": F.count_if(clean & ~robust),
        "n_changed": F.count_if(F.col("original_pred") != F.col("adv_pred")),
    }


def robustness_metrics(df: DataFrame) -> DataFrame:
    c = df.agg(*[v.alias(k) for k, v in _outcomes().items()])
    n, clean, robust = F.col("n_samples"), F.col("n_originally_correct"), F.col("n_robust_correct")
    return c.select(
        ratio(clean, n).alias("clean_accuracy"),
        ratio(robust, n).alias("robust_accuracy"),
        ratio(F.col("n_successful_attacks"), clean).alias("attack_success_rate"),
        (1 - ratio(F.col("n_changed"), n)).alias("prediction_stability"),
        ratio(clean - robust, n).alias("accuracy_drop"),
        ratio(clean - robust, clean).alias("relative_accuracy_drop"),
        "n_samples", "n_originally_correct", "n_successful_attacks",
    )


def attack_metrics(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Attack figures, per group if asked; an empty table without groups gives zeros."""
    c = df.groupBy(*by).agg(*[v.alias(k) for k, v in _outcomes().items()])
    n, clean, robust = F.col("n_samples"), F.col("n_originally_correct"), F.col("n_robust_correct")
    return c.select(
        *by, "n_samples", "n_originally_correct", "n_robust_correct", "n_successful_attacks",
        ratio(clean, n).alias("clean_accuracy"), ratio(robust, n).alias("robust_accuracy"),
        ratio(F.col("n_successful_attacks"), clean).alias("attack_success_rate"),
        ratio(clean - robust, n).alias("robustness_gap"),
    )


def class_asr(df: DataFrame, *by: str) -> DataFrame:
    clean, robust = F.col("original_pred") == F.col("label"), F.col("adv_pred") == F.col("label")
    c = df.groupBy(*(by or ("label_name",))).agg(
        F.count("*").alias("total"), F.count_if(clean).alias("originally_correct"),
        F.count_if(robust).alias("still_correct"), F.count_if(clean & ~robust).alias("attacks_successful"))
    return c.withColumn("asr", ratio(F.col("attacks_successful"), F.col("originally_correct")))


def flagged_by_method(scanned: DataFrame, candidates: DataFrame) -> DataFrame:
    """(method, n): candidates per attack, all candidates, and records scanned (one row each)."""
    per = candidates.rollup("attack").agg(F.count("*").alias("n")).select(
        F.coalesce("attack", F.lit("total_flagged")).alias("method"), "n")
    return per.unionByName(scanned.agg(F.count("*").alias("n")).select(
        F.lit("total_scanned").alias("method"), "n"))


def entropy_stats(scored: DataFrame, median: Column) -> DataFrame:
    """Figures of a scored pool; `median` comes from ranges.exact_quantile."""
    return scored.agg(
        F.count("*").alias("n_candidates"),
        F.avg("entropy").alias("entropy_mean"), F.stddev_pop("entropy").alias("entropy_std"),
        median.alias("entropy_median"), F.min("entropy").alias("entropy_min"), F.max("entropy").alias("entropy_max"),
        F.avg("margin").alias("margin_mean"), F.stddev_pop("margin").alias("margin_std"),
    )


def selection_log(selected: DataFrame, pool: DataFrame, strategy: str, budget: int, method: Column,
                  attack: Column, confidence: Column) -> DataFrame:
    """One row on a round: sizes, entropy figures, and why the first five were selected."""
    size = pool.agg(F.count("*").alias("n")).scalar()
    found = selected.agg(*selection_figures(method, attack, confidence))
    return found.select(F.lit(strategy).alias("strategy"), F.lit(budget).alias("budget"), size.alias("pool_size"), "*")


def selection_figures(method: Column, attack: Column, confidence: Column) -> list[Column]:
    """Aggregates over one selection: its size, entropy figures, and why the first five were selected."""
    reason = explain_selection(F.col("entropy"), F.col("margin"), method, attack, confidence)
    top = F.slice(F.array_sort(F.collect_list(F.when(F.col("rank") <= 5, F.struct("rank", reason.alias("why"))))), 1, 5)
    return [
        F.count("*").alias("n_selected"),
        F.avg("entropy").alias("entropy_mean"), F.stddev_pop("entropy").alias("entropy_std"),
        F.min("entropy").alias("entropy_min"), F.max("entropy").alias("entropy_max"),
        F.array_join(F.transform(top, lambda t: t["why"]), " | ").alias("top_explanations"),
    ]


def iteration_summary(events: DataFrame, metrics: DataFrame) -> DataFrame:
    """Per iteration and type of event found: events of the type, all events, and the metrics logged for it."""
    counts = events.groupBy("iteration", "event_type").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("iteration"))  # one row per type
    return counts.withColumn("n_events", total).join(metrics, "iteration", "left")


def seed_aggregate(long: DataFrame, keys=("model", "method", "metric")) -> DataFrame:
    """Mean and population deviation over seeds of a long metric table."""
    return long.where(F.col("value").isNotNull()).groupBy(*keys).agg(
        F.avg("value").alias("value_mean"), F.stddev_pop("value").alias("value_std"))


def budget_ablation(runs: DataFrame) -> DataFrame:
    return runs.groupBy("budget").agg(
        F.avg("total_samples").alias("total_samples"), F.avg("robust_accuracy").alias("robust_accuracy"),
        F.avg("attack_success_rate").alias("attack_success_rate"))


def robustness_summary(runs: DataFrame) -> DataFrame:
    """One row from the accuracies (clean, attacked, defended) of three runs."""
    clean, hit, healed = F.col("clean_accuracy"), F.col("accuracy_under_attack"), F.col("accuracy_after_defense")
    return runs.select(
        clean, hit, healed,
        F.round((clean - hit) * 100, 2).alias("accuracy_drop_pct"),
        F.round((healed - hit) * 100, 2).alias("accuracy_recovery_pct"),
        F.round((clean - hit) / F.greatest(clean, F.lit(1e-6)), 4).alias("relative_accuracy_drop"),
    )


def metrics_pivot(long: DataFrame, name: str = "model") -> DataFrame:
    """Metric rows, a column for every model found, four decimals, N/A where a model lacks the metric."""
    wide = long.groupBy("metric").pivot(name).agg(F.first(F.format_string("%.4f", F.col("value"))))
    return wide.na.fill("N/A")


def text_length_stats(df: DataFrame, text: str = "full_text", label: str = "label_mapped") -> DataFrame:
    n = F.length(text)
    return df.agg(
        F.count("*").alias("total_samples"), F.countDistinct(label).alias("unique_labels"),
        F.avg(n).alias("avg_text_length"), F.max(n).alias("max_text_length"), F.min(n).alias("min_text_length"),
        F.stddev(n).alias("std_text_length"))


def augmented_share(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if("is_augmented").alias("augmented_samples"),
                  F.count_if(~F.col("is_augmented")).alias("original_samples"))


def balance_dispersion(tables: dict[str, DataFrame], label: str = "label_mapped") -> DataFrame:
    """Per table: rows, sample deviation of class sizes, mean text length."""
    def one(name, df):
        per = df.groupBy(label).agg(F.count("*").alias("n"), F.sum(F.length("full_text")).alias("chars"))
        return per.agg(F.sum("n").alias("samples"), F.stddev("n").alias("class_std"),
                       (F.sum("chars") / F.sum("n")).alias("avg_length")).select(F.lit(name).alias("name"), "*")

    return reduce(DataFrame.unionByName, [one(k, v) for k, v in tables.items()])


def dataset_table(df: DataFrame) -> DataFrame:
    """Per split and in total: rows, share, classes, mean words. Texts are read once."""
    n_words = F.size(words(F.col("full_text")))
    per_label = df.groupBy("split", "label_mapped").agg(F.count("*").alias("n"), F.sum(n_words).alias("words"))
    per = per_label.rollup("split").agg(
        F.sum("n").alias("n"), F.countDistinct("label_mapped").alias("classes"),
        (F.sum("words") / F.sum("n")).alias("mean_words"))
    total = F.max("n").over(Window.partitionBy())  # one row per split and the total
    return per.select(F.coalesce("split", F.lit("total")).alias("split"), "n",
                      (100.0 * F.col("n") / total).alias("pct"), "classes", "mean_words")


def audit_rollup(counts: DataFrame, thresholds: DataFrame, train_words: DataFrame, robustness: DataFrame) -> DataFrame:
    """(stage, key, value) records of a guarded run.

    `counts` is the per-split table of records.guard_counts; records are counted at ingest, and
    anomalies are the measured ones.
    """
    def rows(df, stage, columns, prefix=None):
        cast = df.select(*([prefix] if prefix else []), *[F.col(c).cast("double").alias(c) for c in columns])
        long = cast.unpivot([prefix] if prefix else [], list(columns), "key", "value")
        key = F.concat(F.col(prefix), F.lit("."), F.col("key")) if prefix else F.col("key")
        return long.select(F.lit(stage).alias("stage"), key.alias("key"), "value")

    totals = counts.agg(F.sum("total").alias("total_records"), F.count("*").alias("splits_loaded"))
    split = counts.select("split", F.col("kept").alias("records"), "anomalies",
                          (F.col("total") - F.col("anomalies")).alias("clean"))
    return reduce(DataFrame.unionByName, [
        rows(totals, "ingestion", ["total_records", "splits_loaded"]),
        rows(split, "etl", ["records"], "split"),
        rows(train_words, "etl", ["avg_word_count_train"]),
        rows(thresholds, "detection", ["short_threshold", "long_threshold"]),
        rows(split, "detection", ["clean", "anomalies"], "split"),
        rows(robustness, "ml_analytics", ["clean_accuracy", "accuracy_under_attack", "accuracy_after_defense",
                                          "accuracy_drop_pct", "accuracy_recovery_pct"]),
    ])
