"""Set operations (U)."""

from pyspark.sql import functions as F

from bulwark.functions import perturb
from bulwark.operators import records
from bulwark.queries import views
from bulwark.queries.registry import query
from bulwark.queries.views import table


@query("union_missing_cols", """
    SELECT doc_id, text AS full_text, lang, NULL::BIGINT AS turn FROM documents
    UNION ALL BY NAME SELECT conv_id AS doc_id, text AS full_text, turn FROM conversations""")
def union_missing_cols(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("text").alias("full_text"), "lang")
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("text").alias("full_text"), "turn")
    return d.unionByName(c, allowMissingColumns=True)


_U = views.u_sql("doc_id", "'mix'", 99)


@query("union_adversarial_mix", rf"""
    SELECT doc_id, source, full_text, 'clean' AS origin FROM v_docs
    UNION ALL
    SELECT doc_id, source,
           CASE WHEN {_U} < 0.2 THEN regexp_replace(full_text, '[aeiou]', '', 'g')
                WHEN {_U} < 0.4 THEN regexp_replace(full_text, '([\p{{L}}\p{{N}}_]{{4,}})', '\1\1', 'g')
                ELSE full_text END, 'perturbed' FROM v_docs""")
def union_adversarial_mix(spark, sf):
    d = views.docs(spark, sf).select("doc_id", "source", "full_text")
    noisy = d.withColumn("full_text", perturb.noise_mix(F.col("full_text"), F.col("doc_id"), 0.2, 99))
    return d.withColumn("origin", F.lit("clean")).unionByName(noisy.withColumn("origin", F.lit("perturbed")))


@query("union_pools", """
    SELECT vec_id, 0 AS priority FROM v_scored WHERE margin < 0.1
    UNION ALL SELECT vec_id, 1 FROM v_scored WHERE entropy > 1.5""")
def union_pools(spark, sf):
    """Two candidate pools; the first has priority."""
    s = views.scored(spark, sf)
    a = s.where("margin < 0.1").select("vec_id", F.lit(0).alias("priority"))
    return a.unionByName(s.where("entropy > 1.5").select("vec_id", F.lit(1).alias("priority")))


@query("distinct_labels", "SELECT DISTINCT label_mapped FROM v_labelled")
def distinct_labels(spark, sf):
    return views.labelled(spark, sf).select("label_mapped").distinct().orderBy("label_mapped")


@query("dedup_exact", "SELECT split, min(doc_id) AS doc_id, full_text FROM v_labelled GROUP BY split, full_text")
def dedup_exact(spark, sf):
    return records.dedup_exact(views.labelled(spark, sf).select("split", "doc_id", "full_text"), "doc_id")
