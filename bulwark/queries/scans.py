"""Scans, sources and sinks (S)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulwark.operators import metrics, records
from bulwark.queries import views
from bulwark.queries.registry import query
from bulwark.queries.views import table
from bulwark.session import checkpointed, scratch_path, spread
from bulwark.sources import archives, stores
from bulwark.sources import records as src

KEYED_SCHEMA = T.StructType([T.StructField("rec_id", T.LongType()), *src.RECORD_SCHEMA.fields])
PLAIN = ("rec_id", "document", "mention", "sentence_left", "sentence_right", "label_link", "label_id")
RICH = (*PLAIN[:5], "context_left", "context_right", *PLAIN[5:])


def mention_files(spark, sf):
    """The mention records written as the split files a data folder holds."""
    base = scratch_path(spark, "records")
    m = checkpointed(views.mentions(spark, sf))
    for name, split, columns in (
        ("train", "train", PLAIN), ("train_w_con", "train", RICH), ("train_w_con_w_neg", "train", RICH),
        ("dev", "dev", PLAIN), ("dev_w_con", "dev", RICH), ("test", "test", PLAIN),
    ):
        m.where(F.col("split") == split).select(*columns).write.json(f"{base}/{name}.jsonl")
    return base


@query("scan_jsonl", "SELECT doc_id, text, lang, source, 'train' AS split FROM documents")
def scan_jsonl(spark, sf):
    path = scratch_path(spark, "jsonl")
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    d.write.json(path)
    return src.scan_jsonl(spark, path, "train", d.schema)


_PLAIN_SQL = "rec_id, document, mention, sentence_left, sentence_right"
_TAIL_SQL = "label_link, label_id"


@query("ingest_splits", f"""
    SELECT {_PLAIN_SQL}, NULL::VARCHAR AS context_left, NULL::VARCHAR AS context_right, {_TAIL_SQL}, split, split AS variant
    FROM v_mentions
    UNION ALL SELECT {_PLAIN_SQL}, context_left, context_right, {_TAIL_SQL}, split, 'train_w_con'
    FROM v_mentions WHERE split = 'train'""")
def ingest_splits(spark, sf):
    return src.ingest_splits(spark, mention_files(spark, sf), KEYED_SCHEMA).select(*RICH, "split", "variant")


views.SQL["v_variants"] = """
    SELECT *, split AS variant FROM (SELECT * REPLACE (NULL::VARCHAR AS context_left, NULL::VARCHAR AS context_right)
                                     FROM v_mentions) WHERE split <> 'dev'
    UNION ALL SELECT *, 'train_w_con' FROM v_mentions WHERE split = 'train'
    UNION ALL SELECT * REPLACE (CASE WHEN label_id = '1906' THEN 'OTHER' ELSE label_id END AS label_id),
                     'train_w_con_w_neg' FROM v_mentions WHERE split = 'train'
    UNION ALL SELECT *, 'dev_w_con' FROM v_mentions WHERE split = 'dev'"""


@query("ingest_variants", f"""
    SELECT {_PLAIN_SQL}, context_left, context_right, {_TAIL_SQL}, split, variant FROM v_variants""")
def ingest_variants(spark, sf):
    return src.ingest_variants(spark, mention_files(spark, sf), KEYED_SCHEMA).select(*RICH, "split", "variant")


@query("scan_text_files", "SELECT concat('page_', page_id, '.txt') AS document, coalesce(html, '') AS full_text FROM pages")
def scan_text_files(spark, sf):
    """Pages packed as one text file each into an archive per task, and read back whole."""
    path = scratch_path(spark, "texts")
    name = F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".txt"))
    pages = spread(table(spark, sf, "pages"), "page_id")
    archives.write_text_archives(pages.select(name.alias("document"), F.col("html").alias("full_text")), path)
    return archives.scan_text_archives(spark, path)


@query("store_raw_parquet", "SELECT split, doc_id, md5(full_text) AS text_md5, lang, source, mention FROM v_docs")
def store_raw_parquet(spark, sf):
    """Every stored value, read back from the store."""
    stored = stores.store_raw(views.docs(spark, sf), scratch_path(spark, "raw"))
    return stored.select("split", "doc_id", F.md5("full_text").alias("text_md5"), "lang", "source", "mention")


@query("store_clean_quarantine", """
    SELECT route, split, doc_id, label_mapped, word_count FROM v_kept
    UNION ALL SELECT route, split, doc_id, label_mapped, word_count FROM v_routed WHERE route = 'quarantine'""")
def store_clean_quarantine(spark, sf):
    annotated = records.annotate(views.labelled(spark, sf), "doc_id")
    return stores.store_routed(annotated, scratch_path(spark, "routed")).select(
        "route", "split", "doc_id", "label_mapped", "word_count")


def attack_report(spark, sf):
    """Attack figures per attack as nested objects."""
    m = metrics.attack_metrics(views.attacks(spark, sf), ("attack",))
    return m.select("attack", F.struct(
        F.struct("n_samples", "n_successful_attacks").alias("counts"),
        F.struct(*[F.round(c, 6).alias(c) for c in ("clean_accuracy", "attack_success_rate")]).alias("rates"),
    ).alias("metrics"))


_REPORT = """
    SELECT attack, count(*) AS n_samples, count(*) FILTER (original_pred = label AND adv_pred <> label) AS n_successful_attacks,
           round(avg((original_pred = label)::INTEGER), 6) AS clean_accuracy,
           round(count(*) FILTER (original_pred = label AND adv_pred <> label)
                 / count(*) FILTER (original_pred = label), 6) AS attack_success_rate
    FROM v_attacks GROUP BY attack"""
_FLAT = ("metrics.counts.n_samples", "metrics.counts.n_successful_attacks", "metrics.rates.clean_accuracy",
         "metrics.rates.attack_success_rate")


@query("json_report_sink", _REPORT)
def json_report_sink(spark, sf):
    """Nested report written as JSON text, parsed back."""
    path = scratch_path(spark, "report")
    report = attack_report(spark, sf)
    stores.write_report(report, path)
    schema = report.schema.simpleString()
    return spark.read.text(path).select(F.from_json("value", schema).alias("r")).select("r.*").select("attack", *_FLAT)


@query("json_report_scan", _REPORT)
def json_report_scan(spark, sf):
    path = scratch_path(spark, "report")
    report = attack_report(spark, sf)
    stores.write_report(report, path)
    return stores.read_report(spark, path, report.schema).select("attack", *_FLAT)


@query("parquet_scan", "SELECT doc_id, lang, source FROM v_docs WHERE split = 'dev'")
def parquet_scan(spark, sf):
    path = scratch_path(spark, "raw")
    stores.store_raw(views.docs(spark, sf), path)
    return stores.scan_store(spark, path, split="dev").select("doc_id", "lang", "source")
