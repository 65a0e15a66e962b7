"""Joins (J)."""

from pyspark.sql import functions as F

from bulwark.operators import joins, records
from bulwark.operators import selection as sel
from bulwark.queries import views
from bulwark.queries.common import rounded
from bulwark.queries.registry import query
from bulwark.queries.views import table

_KEY = "concat('DOC_', doc_id, '.txt')"


def _named(df):
    return df.withColumn("document", F.concat(F.lit("DOC_"), F.col("doc_id").cast("string"), F.lit(".txt")))


@query("join_dup_counts", "SELECT doc_id, split, count(*) OVER (PARTITION BY split, full_text) AS dup_count FROM v_labelled")
def join_dup_counts(spark, sf):
    d = views.labelled(spark, sf).select("doc_id", "split", "full_text")
    return joins.attach_copy_counts(d, "doc_id").select("doc_id", "split", "dup_count")


@query("join_available_docs", "SELECT doc_id, quality FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)")
def join_available_docs(spark, sf):
    l = _named(table(spark, sf, "labels"))
    d = _named(table(spark, sf, "documents").select("doc_id"))
    return joins.available_docs(l, d, "doc_id").select("doc_id", "quality")


@query("join_labels_text", "SELECT l.doc_id, quality, toxic, text AS full_text FROM labels l JOIN documents USING (doc_id)")
def join_labels_text(spark, sf):
    l = _named(table(spark, sf, "labels"))
    d = _named(table(spark, sf, "documents")).withColumnRenamed("text", "full_text")
    return joins.align_text(l, d, "doc_id").select("doc_id", "quality", "toxic", "full_text")


@query("pool_remove_selected", """
    WITH sel AS (SELECT full_text FROM v_docs ORDER BY md5(concat_ws(':', doc_id, 'random', 42)), doc_id LIMIT 50)
    SELECT doc_id FROM v_docs WHERE full_text NOT IN (SELECT full_text FROM sel)""")
def pool_remove_selected(spark, sf):
    pool = views.docs(spark, sf).select("doc_id", "full_text")
    chosen = sel.select_random(pool, "doc_id", 50)
    return joins.remove_selected(pool, chosen, "full_text").select("doc_id")


@query("join_clean_adv_preds", """
    SELECT vec_id, label, original_pred, adv_pred,
           original_pred = label AS originally_correct, adv_pred = label AS still_correct,
           original_pred = label AND adv_pred <> label AS attack_success
    FROM v_predictions""")
def join_clean_adv_preds(spark, sf):
    p = views.predictions(spark, sf)
    return joins.pair_predictions(
        p.select("vec_id", "label", "original_pred"), p.select("vec_id", "adv_pred"), "vec_id")


def method_metrics(spark, sf, method):
    """Mean metrics (metric, value) of one method over seeds."""
    return views.seed_metrics(spark, sf).where(F.col("method") == method).groupBy("metric").agg(
        F.avg("value").alias("value"))


_SETS = """
    WITH m AS (SELECT method, metric, avg(value) AS value FROM v_seed_metrics GROUP BY 1, 2),
         x AS (SELECT a.metric, a.value AS baseline, b.value AS adversarial FROM m a JOIN m b USING (metric)
               WHERE a.method = 'random' AND b.method = 'entropy')
    SELECT metric, round(baseline, 6) AS baseline, round(adversarial, 6) AS adversarial,
           round(adversarial - baseline, 6) AS difference,
           round(CASE WHEN baseline <> 0 THEN (adversarial - baseline) / abs(baseline) END, 6) AS relative_change"""


@query("join_metric_sets", _SETS + " FROM x")
def join_metric_sets(spark, sf):
    return rounded(joins.join_metric_sets(method_metrics(spark, sf, "random"), method_metrics(spark, sf, "entropy")))


@query("model_comparison", _SETS + """,
           round(CASE WHEN metric = 'attack_success_rate'
                      THEN CASE WHEN baseline > 0 THEN (baseline - adversarial) / baseline * 100 ELSE 0 END END, 6)
             AS asr_reduction_percent FROM x""")
def model_comparison(spark, sf):
    return rounded(joins.compare_models(method_metrics(spark, sf, "random"), method_metrics(spark, sf, "entropy")))


@query("join_label_dim", """
    WITH dim AS (SELECT label_mapped, (row_number() OVER (ORDER BY label_mapped) - 1)::INTEGER AS label_id_encoded
                 FROM (SELECT DISTINCT label_mapped FROM v_labelled WHERE split = 'train'))
    SELECT doc_id, split, label_id_encoded FROM v_labelled JOIN dim USING (label_mapped)""")
def join_label_dim(spark, sf):
    """Codes come from the training split; labels it lacks are dropped."""
    d = views.labelled(spark, sf).select("doc_id", "split", "label_mapped")
    dim = records.label_dictionary(d.where("split = 'train'"))
    return records.encode_labels(d, dictionary=dim).select("doc_id", "split", "label_id_encoded")
