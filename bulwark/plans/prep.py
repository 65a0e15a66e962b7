"""Training-table preparation, plain and enhanced."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bulwark.functions import text as tx
from bulwark.functions.perturb import augment_random
from bulwark.functions.seeded import SEED
from bulwark.operators import joins, records
from bulwark.operators import selection as sel
from bulwark.session import checkpointed


def _train_and_rest(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col("split") == "train"), df.where(F.col("split") != "train")


def label_and_encode(df: DataFrame, top_k: int) -> DataFrame:
    """Labels reduced by the training split, codes over the labels of all splits.

    The codes travel to the texts: dealt by label, the largest label's texts would meet in one task.
    """
    reduced = records.reduce_labels(df, "label_id", top_k)
    return records.encode_labels(reduced, dictionary=F.broadcast(records.label_dictionary(reduced)))  # top_k + 1 rows


def prep(variants: DataFrame, row_id: str, top_k: int = 15, other_rows: int = 600, seed: int = SEED) -> DataFrame:
    """Rich text, reduced and encoded labels; OTHER downsampled in the training split only."""
    # Parsed once: labels, sample and output all read these tables.
    rich = checkpointed(variants.withColumn("full_text", tx.rich_text_strict()))
    df = checkpointed(label_and_encode(rich, top_k))
    train, rest = _train_and_rest(df)
    out = sel.balance_other(train, row_id, other_rows, seed=seed).unionByName(rest)
    return records.project_available(out, (row_id, *records.TRAINING_COLUMNS, "split"))


def prep_enhanced(
    labels: DataFrame,
    texts: DataFrame,
    row_id: str,
    strategy: str = "head_tail",
    top_k: int = 15,
    at_least: int = 50,
    at_most: int = 800,
    clean: bool = True,
    augment=augment_random,
    seed: int = SEED,
) -> DataFrame:
    """Labels joined with cleaned, truncated documents; training classes capped and filled.

    Cleaning comes before the label join's fan-out and before the labels are reduced.
    """
    body = F.col("full_text")
    if clean:
        body = tx.normalize_text(tx.clean_text(body))
    prepared = texts.withColumn("full_text", body).withColumn(
        "full_text", tx.TRUNCATIONS[strategy](F.col("full_text")))
    # Cleaned once: capping, filling and the other splits all read this table.
    df = checkpointed(label_and_encode(joins.align_text(labels, prepared, row_id), top_k))
    train, rest = _train_and_rest(df)
    balanced = sel.balance_classes(train, row_id, at_least=at_least, at_most=at_most, augment=augment, seed=seed)
    out = balanced.unionByName(rest.withColumns({"copy": F.lit(0), "is_augmented": F.lit(False)}))
    return records.project_available(out, (row_id, "copy", *records.TRAINING_COLUMNS, "split"))
