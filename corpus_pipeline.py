"""A run over a corpus: language, near copies, benchmark passages, mixture, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulwark.llm import decontaminate, language, mixing, neardup, sharding
from bulwark.llm.common import plainly_named
from bulwark.llm.queries import table, trained_languages
from bulwark.session import scratch_path

SHARDS = 16


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that some language model explains; null texts and texts without a letter go."""
    rows, name = plainly_named(docs)
    judged = language.identify(rows, name["text"], trained_languages(docs))
    return judged.where("not rejected").select(*name.values()).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component linked by 80 % of five-word shingles."""
    return neardup.keep_one(docs, "doc_id", "text", width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ten words or more that benchmark items hold are cut out; what has no word left goes."""
    clean = decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources as flat as two readings of the smallest allow. Every document is taken once at least."""
    rows, name = plainly_named(docs)
    mixed, _ = mixing.mix(rows, F.col(name["source"]), name["doc_id"], name["text"], repeats=2.0)
    return mixed.select(*name.values()).toDF(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and its place there; rows that repeat a document are dealt out like others."""
    tie = F.xxhash64("doc_id", "source")
    return sharding.range_shards(docs, F.xxhash64("text"), tie, sharding.text_size(F.col("text")), shards=SHARDS)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("sharding", shards),
]

#: SQL can't state a character model's rejections or sampled splitters.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each writes Parquet below spark.checkpoint.dir, which the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
