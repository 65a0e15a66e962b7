"""File streams (R)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulwark.operators import records
from bulwark.queries import views
from bulwark.queries.registry import query
from bulwark.session import scratch_path
from bulwark.streaming import ingest

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
])


def documents(spark, sf):
    stream = ingest.table_stream(spark, f"{sf.rstrip('/')}/documents.parquet", SCHEMA)
    mention = F.nullif(F.regexp_extract("text", "([A-Z][a-z]{7,})", 1), F.lit(""))
    return stream.select("doc_id", F.col("text").alias("full_text"), "source", mention.alias("mention"))


@query("stream_ingest_flag", """
    SELECT doc_id, word_count, char_count, flag_short_text, flag_long_text, flag_null_mention, flag_other_tiny, route
    FROM v_routed""")
def stream_ingest_flag(spark, sf):
    train = views.labelled(spark, sf).where("split = 'train'")
    kept = records.top_labels(records.trim_nonempty(views.docs(spark, sf)).where("split = 'train'"), "source", 15)
    flagged = ingest.flag_stream(documents(spark, sf), ingest.fixed_bounds(train), kept, "source")
    base = scratch_path(spark, "stream")
    return ingest.drain(flagged, f"{base}/out", f"{base}/checkpoint").select(
        "doc_id", "word_count", "char_count", *records.ROW_FLAGS, "route")


@query("stream_dedup", """
    SELECT upper(sha256(full_text)) AS text_hash, min(doc_id) AS doc_id, full_text FROM v_docs GROUP BY full_text""")
def stream_dedup(spark, sf):
    base = scratch_path(spark, "stream")
    return ingest.dedup_to_store(documents(spark, sf), "doc_id", f"{base}/store", f"{base}/checkpoint")
