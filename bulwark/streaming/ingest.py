"""File streams: flag records as they arrive, drop repeated texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulwark.operators import records
from bulwark.operators.skew import text_digest
from bulwark.session import checkpointed

DEDUP_SALTS = 16
#: Segments of stored digests that are merged into one; rows of a segment's file and of a page within.
FANOUT, SEGMENT_ROWS, PAGE_ROWS = 16, 4_000_000, 2_000
#: Digests of a batch that are looked up by value.
LOOKUP = 2_000


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).format(fmt).load(folder)


def table_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table as a stream, whether its path is one file or a folder of files.

    The last name is given as a pattern: a plain path would also become the base of partition folders, which a file can't be.
    """
    folder, _, name = path.rpartition("/")
    return spark.readStream.schema(schema).parquet(f"{folder}/{{{name}}}")


def fixed_bounds(train: DataFrame) -> Column:
    """The training split's bounds, read once as two numbers, for a stream to compare with."""
    row = records.sigma_thresholds(train).first()
    return F.struct(F.lit(row["short_threshold"]).alias("short_threshold"),
                    F.lit(row["long_threshold"]).alias("long_threshold"))


def flag_stream(stream: DataFrame, bounds: Column, labels: DataFrame, label: str) -> DataFrame:
    """Trim, measure and flag. `labels` is the static table of kept labels (k rows)."""
    kept = F.broadcast(labels.select(label, F.lit(True).alias("_kept")))
    mapped = F.when(F.col("_kept"), F.col(label)).otherwise(F.lit(records.tx.OTHER))
    labelled = records.trim_nonempty(stream).join(kept, label, "left").withColumn("label_mapped", mapped).drop("_kept")
    return records.route(records.add_row_flags(records.add_lengths(labelled), bounds))


def dedup_stream(stream: DataFrame, row_id: str, text: str = "full_text", salts: int = DEDUP_SALTS,
                 *, event_time: str, delay: str = "1 hour") -> DataFrame:
    """First row per text within `delay` of event time; which one is first is the stream's choice.

    A text that fills a large share of the stream is first reduced within `salts` parts of its
    rows, so the second step sees at most `salts` rows of it per batch. Remembered texts expire
    after `delay`, so the state is bounded; dedup_to_store remembers all of them.
    """
    salt = F.pmod(F.xxhash64(row_id), F.lit(salts))
    keyed = stream.withColumns({"text_hash": F.hex(text_digest(F.col(text))), "_salt": salt})
    marked = keyed.withWatermark(event_time, delay)
    parts = marked.dropDuplicatesWithinWatermark(["text_hash", "_salt"])
    return parts.dropDuplicatesWithinWatermark(["text_hash"]).drop("_salt")


def segments(number: int) -> list[str]:
    """The segments that hold the digests of all batches before `number`: whole powers of FANOUT first, then single ones.

    `level=1/first=32` holds batches 32 to 47. There are fewer than FANOUT segments of each level.
    """
    out, done, width = [], 0, 1
    while width * FANOUT <= number:
        width *= FANOUT
    while done < number:
        while done + width > number:
            width //= FANOUT
        out.append(f"level={_level(width)}/first={done}")
        done += width
    return out


def _level(width: int) -> int:
    return 0 if width == 1 else 1 + _level(width // FANOUT)


def _write_segment(digests: DataFrame, path: str, rows: int) -> None:
    """Digests in sorted files of about SEGMENT_ROWS, with bounds for each page, which are as narrow as pages are many."""
    files = max(1, -(-rows // SEGMENT_ROWS))
    (
        digests.repartitionByRange(files, "text_hash").sortWithinPartitions("text_hash").write.mode("overwrite")
        .option("parquet.page.row.count.limit", str(PAGE_ROWS)).option("parquet.enable.dictionary", "false").parquet(path)
    )


def compact(spark: SparkSession, index: str, number: int) -> None:
    """Merge the FANOUT last segments of a level into one of the next, wherever `number` batches complete one.

    A function of the batch number alone, into folders of their own: a repeated batch repeats it.
    """
    width = FANOUT
    while number and number % width == 0:
        first, part = number - width, width // FANOUT
        merged = spark.read.parquet(*[f"{index}/level={_level(part)}/first={first + i * part}" for i in range(FANOUT)]).select("text_hash")
        _write_segment(merged, f"{index}/level={_level(width)}/first={first}", merged.count())
        width *= FANOUT


def known_among(spark: SparkSession, index: str, number: int, digests: DataFrame) -> DataFrame:
    """The digests (`text_hash`, one row each) that an earlier batch stored.

    Up to LOOKUP of them are pushed into the scan as values, which then reads only the pages whose bounds admit one;
    more are joined, as they would touch most pages anyway.
    """
    held = spark.read.parquet(*[f"{index}/{s}" for s in segments(number)]).select("text_hash")
    few = [r[0] for r in digests.limit(LOOKUP + 1).collect()]
    if len(few) > LOOKUP:
        return held.join(digests, "text_hash", "left_semi")
    return held.where(F.col("text_hash").isin(few)) if few else held.where("false")


def dedup_to_store(stream: DataFrame, row_id: str, store: str, checkpoint: str, text: str = "full_text") -> DataFrame:
    """Keep the smallest id of each text per batch, and only texts that the store doesn't hold yet.

    What is remembered is a table of digests beside the stored texts, so the query keeps no state and never reads a
    stored text again. The digests stand in sorted segments, which are merged level by level: a batch looks its own
    digests up in a few of them. A batch that is repeated after a failure overwrites its own folders.
    """
    spark = stream.sparkSession
    index = f"{store}/digests"
    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(LOOKUP))

    def add(batch: DataFrame, number: int) -> None:
        keyed = batch.withColumn("text_hash", F.hex(text_digest(F.col(text))))
        # Ids are combined before the shuffle; a text that fills the batch costs one row per task.
        first = checkpointed(keyed.groupBy("text_hash").agg(F.min(row_id).alias(row_id)))
        if number:
            compact(spark, index, number)
            first = first.join(known_among(spark, index, number, first.select("text_hash")), "text_hash", "left_anti")
            first = checkpointed(first)
        rows = keyed.select(row_id, text).join(first, row_id).dropDuplicates([row_id, "text_hash"])
        rows.select("text_hash", row_id, text).write.mode("overwrite").parquet(f"{store}/texts/batch={number}")
        _write_segment(first.select("text_hash"), f"{index}/level=0/first={number}", first.count())

    stream.writeStream.foreachBatch(add).trigger(availableNow=True).option("checkpointLocation", checkpoint).start().awaitTermination()
    return spark.read.parquet(f"{store}/texts").drop("batch")


def drain(stream: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Process what is there into a Parquet sink, then read it. A restart goes on from the checkpoint."""
    q = (
        stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", checkpoint).start(sink)
    )
    q.awaitTermination()
    return stream.sparkSession.read.parquet(sink)
