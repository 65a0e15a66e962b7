"""The guarded run: ingest, store, prepare, flag, route, store again, report."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulwark.functions.text import rich_text
from bulwark.operators import records
from bulwark.sources import records as src
from bulwark.sources import stores


def prepare(raw: DataFrame) -> DataFrame:
    """Rich text, trimmed and non-empty, labels from links, lengths."""
    rich = raw.withColumn("full_text", rich_text())
    return records.add_lengths(records.map_technique_labels(records.trim_nonempty(rich)))


def per_split(prefix: str, splits: tuple[str, ...], **counted: Column) -> list[Column]:
    """Counts of true rows by split, named prefix/split.key, to be observed while a table is written."""
    return [
        F.count_if((F.col("split") == s) & F.coalesce(c, F.lit(False))).alias(f"{prefix}/{s}.{key}")
        for s in splits for key, c in counted.items()
    ]


class Run:
    """What a run observes of itself: counts that its own writes make, and the seconds of its stages."""

    def __init__(self, splits: tuple[str, ...]):
        self.splits, self.observations, self.seconds = splits, [], []
        self._begun = time.monotonic()

    def observed(self, df: DataFrame, prefix: str, **counted: Column) -> DataFrame:
        self.observations.append(Observation())
        return df.observe(self.observations[-1], *per_split(prefix, self.splits, **counted))

    def finished(self, stage: str) -> None:
        self.seconds.append((stage, time.monotonic() - self._begun - sum(s for _, s in self.seconds)))

    def audit(self, spark: SparkSession) -> DataFrame:
        """(stage, key, value): known only once the observed writes are done."""
        rows = [(*k.split("/", 1), v) for o in self.observations for k, v in o.get.items()]
        return spark.createDataFrame(rows, "stage string, key string, value long")

    def runtime(self, spark: SparkSession) -> DataFrame:
        total = [("total", sum(s for _, s in self.seconds))]
        return spark.createDataFrame(self.seconds + total, "stage string, seconds double")


def run_guard(spark: SparkSession, data: str, out: str, schema: T.StructType = src.RECORD_SCHEMA,
              row_id: str | None = None) -> dict[str, DataFrame]:
    """Run all stages below `out` and return the stored tables and reports.

    Raw records are stored first and read back, so the later stages scan Parquet, and a record is
    known by its place in that store unless it brings an id of its own. `audit` holds what the run's
    own writes counted on the way, without a further pass, and `runtime` the seconds of its stages.
    """
    raw_path, routed_path = f"{out}/raw", f"{out}/routed"
    run = Run(tuple(src.BASE_FILES))
    stores.store_raw(run.observed(src.ingest_splits(spark, data, schema), "ingestion", records=F.lit(True)), raw_path)
    run.finished("ingestion")
    raw = spark.read.parquet(raw_path) if row_id else stores.with_record_id(spark, raw_path)
    key = row_id or "record_id"
    prepared = records.project_available(prepare(raw), (key, *records.CORE_COLUMNS))
    known = records.facts(prepared, key)
    run.finished("preparation")
    flags = records.annotate_facts(known, key).select(key, *records.FLAGS, "is_anomaly", "route", "is_survivor")
    annotated = run.observed(
        prepared.join(flags, key), "detection", records=F.lit(True), **{f: F.col(f) for f in records.FLAGS},
        anomalies=F.col("is_anomaly"), quarantined=F.col("route") == "quarantine", kept=F.col("is_survivor"))
    stores.store_routed(annotated, routed_path)
    run.finished("detection and storage")
    clean = stores.scan_store(spark, routed_path, route="clean")
    return {
        "counts": records.guard_counts(known),
        "thresholds": records.sigma_thresholds(known.where(F.col("split") == "train")),
        "stats": records.split_stats(clean),
        "clean": clean,
        "quarantine": stores.scan_store(spark, routed_path, route="quarantine"),
        "audit": run.audit(spark),
        "runtime": run.runtime(spark),
    }
