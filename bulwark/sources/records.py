"""Readers of record splits, their variants and whole documents."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulwark.functions.text import negative_to_other
from bulwark.session import checkpointed

RECORD_COLUMNS = ("document", "mention", "sentence_left", "sentence_right", "context_left", "context_right",
                  "label_link", "label_id", "label", "label_title", "entity_type")
RECORD_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RECORD_COLUMNS])

# File names below a data folder.
BASE_FILES = {"train": "train.jsonl", "dev": "dev.jsonl", "test": "test.jsonl"}
CONTEXT_FILE, NEGATIVE_FILE, DEV_CONTEXT_FILE = "train_w_con.jsonl", "train_w_con_w_neg.jsonl", "dev_w_con.jsonl"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path can be read on whatever file system it names."""
    try:
        spark.read.text(path)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def scan_jsonl(spark: SparkSession, path: str, split: str, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """Rows of a JSON-lines file with their split. The schema is given, so no inference pass runs."""
    return spark.read.schema(schema).json(path).withColumn("split", F.lit(split))


def malformed_lines(spark: SparkSession, path: str, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """(line): lines that aren't JSON objects of the schema; scan_jsonl gives nulls for them."""
    kept = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.schema(kept).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return checkpointed(rows.where(F.col("_corrupt_record").isNotNull())).select(F.col("_corrupt_record").alias("line"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _variant(spark, base, file, split, schema) -> DataFrame | None:
    path = f"{base.rstrip('/')}/{file}"
    if not exists(spark, path):
        return None
    return scan_jsonl(spark, path, split, schema).withColumn("variant", F.lit(file.removesuffix(".jsonl")))


def ingest_splits(spark: SparkSession, base: str, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """One table of all splits found; the context-enriched training file joins the training split."""
    wanted = [(f, s) for s, f in BASE_FILES.items()] + [(CONTEXT_FILE, "train")]
    found = [_variant(spark, base, f, s, schema) for f, s in wanted]
    found = [d for d in found if d is not None]
    if not found:
        raise FileNotFoundError(f"no record files below {base}")
    return _union(found)


def ingest_variants(spark: SparkSession, base: str, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """Training file, its context variant and the hard negatives; the enriched dev file if there is one."""
    dev = DEV_CONTEXT_FILE if exists(spark, f"{base}/{DEV_CONTEXT_FILE}") else BASE_FILES["dev"]
    train = [_variant(spark, base, f, "train", schema) for f in (BASE_FILES["train"], CONTEXT_FILE)]
    negatives = _variant(spark, base, NEGATIVE_FILE, "train", schema)
    if negatives is not None:
        train.append(negatives.withColumn("label_id", negative_to_other(F.col("label_id"))))
    rest = [_variant(spark, base, dev, "dev", schema), _variant(spark, base, BASE_FILES["test"], "test", schema)]
    return _union([d for d in (*train, *rest) if d is not None])


def scan_text_files(spark: SparkSession, folder: str) -> DataFrame:
    """(document, full_text) of every .txt file below a folder.

    The name is the last path part that ends in .txt, which also covers folders that Spark wrote
    with partitionBy("document").
    """
    path = F.col("_metadata.file_path")
    name = F.coalesce(
        F.nullif(F.regexp_extract(path, r"/document=([^/]+\.txt)/[^/]*$", 1), F.lit("")),
        F.regexp_extract(path, r"([^/]+)$", 1),
    )
    files = (
        spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True)
        .text(folder, wholetext=True)
    )
    return files.select(name.alias("document"), F.col("value").alias("full_text"))
