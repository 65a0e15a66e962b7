"""Joins of records with documents, predictions, metrics and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bulwark.functions.text import doc_key
from bulwark.operators.skew import HOT_FLOOR, SALTS, key_counts, salted_join, text_digest


def attach_copy_counts(df: DataFrame, row_id: str, text: str = "full_text", within=("split",),
                       floor: int = HOT_FLOOR, salts: int = SALTS) -> DataFrame:
    """Add dup_count, the number of rows with the same text. Hot texts are salted."""
    keys = [*within, "_digest"]
    keyed = df.withColumn("_digest", text_digest(F.col(text)))
    counts = key_counts(keyed, keys)
    joined = salted_join(keyed, counts.withColumnRenamed("n", "dup_count"), keys, "left", row_id, counts,
                         salts, floor)
    return joined.drop("_digest")


def available_docs(labels: DataFrame, texts: DataFrame, row_id: str, key: str = "document",
                   floor: int = HOT_FLOOR, salts: int = SALTS) -> DataFrame:
    """Label rows whose document exists. Documents with very many label rows are salted."""
    l = labels.withColumn("doc_clean", doc_key(F.col(key)))
    return salted_join(l, texts.select(doc_key(F.col(key)).alias("doc_clean")), ["doc_clean"], "left_semi", row_id,
                       floor=floor, salts=salts)


def align_text(labels: DataFrame, texts: DataFrame, row_id: str, key: str = "document",
               floor: int = HOT_FLOOR, salts: int = SALTS) -> DataFrame:
    """Label rows with the text of their document, by normalised document name.

    Many label rows may name one document, so that side is salted where it is hot. Rows without a
    document are dropped, as the semi-join in front of the left join does.
    """
    l = labels.drop("full_text").withColumn("doc_clean", doc_key(F.col(key)))
    r = texts.select(doc_key(F.col(key)).alias("doc_clean"), "full_text")
    return salted_join(l, r, ["doc_clean"], "inner", row_id, floor=floor, salts=salts)


def remove_selected(pool: DataFrame, selected: DataFrame, text: str = "text") -> DataFrame:
    """Pool without every row whose text equals a selected one. `selected` is one round's budget."""
    gone = selected.select(text_digest(F.col(text)).alias("_digest")).distinct()
    return pool.withColumn("_digest", text_digest(F.col(text))).join(gone, "_digest", "left_anti").drop("_digest")


def pair_predictions(clean: DataFrame, perturbed: DataFrame, row_id: str) -> DataFrame:
    """Attack results: clean and perturbed prediction of the same record."""
    return (
        clean.join(perturbed, row_id)
        .withColumn("originally_correct", F.col("original_pred") == F.col("label"))
        .withColumn("still_correct", F.col("adv_pred") == F.col("label"))
        .withColumn("attack_success", F.col("originally_correct") & ~F.col("still_correct"))
    )


def label_names(df: DataFrame, names: DataFrame, key: str, name: str) -> DataFrame:
    """Readable label from a class dictionary (one row per class), else the id as text."""
    return df.join(names.select(key, name), key, "left").withColumn(
        "label_name", F.coalesce(name, F.col(key).cast("string"))).drop(name)


def join_metric_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Metrics (metric, value) that both sides have, with difference and relative change."""
    x = a.where(F.col("value").isNotNull()).select("metric", F.col("value").alias("baseline"))
    y = b.where(F.col("value").isNotNull()).select("metric", F.col("value").alias("adversarial"))
    diff = F.col("adversarial") - F.col("baseline")
    return x.join(y, "metric").select(
        "metric", "baseline", "adversarial",
        diff.alias("difference"),
        F.when(F.col("baseline") != 0, diff / F.abs("baseline")).alias("relative_change"),
    )


def compare_models(a: DataFrame, b: DataFrame) -> DataFrame:
    """join_metric_sets plus the reduction of the attack success rate in percent."""
    drop = F.when(F.col("baseline") > 0, (F.col("baseline") - F.col("adversarial")) / F.col("baseline") * 100)
    return join_metric_sets(a, b).withColumn(
        "asr_reduction_percent",
        F.when(F.col("metric") == "attack_success_rate", F.coalesce(drop, F.lit(0.0))),
    )
