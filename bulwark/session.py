"""Session helpers: a default session for tests and benches, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "bulwark") -> SparkSession:
    """A local session for tests and benches. On a cluster the caller supplies the session."""
    n = 8 if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (`spark.checkpoint.dir`).

    A temporary folder is used only in local mode, where driver and executors are one process.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="bulwark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/bulwark/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, which outlives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give costly text work all cores when a file scan has fewer partitions than there are cores.

    A table of a few big row groups scans in as few tasks. A scan of many files is left as it is.
    Only for plain scans: counting partitions of a plan with shuffles would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
