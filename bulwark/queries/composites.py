"""Whole runs (G)."""

from pyspark.sql import functions as F

from bulwark.operators import records
from bulwark.plans import guard, prep
from bulwark.queries import aggregates, views
from bulwark.queries.perturbation import augment_delete_sql, augment_shuffle_sql, augment_synonym_sql
from bulwark.queries.projections import CLEAN_SQL, NORMALIZE_SQL, _strip
from bulwark.queries.registry import query
from bulwark.queries.scans import KEYED_SCHEMA, mention_files
from bulwark.queries.views import table, u_sql
from bulwark.session import scratch_path, spread
from bulwark.sources import records as src

_FIXED = ", ".join(f"'{t}'" for t in records.tx.TOP_TECHNIQUES)
views.SQL["v_ingested"] = """
    SELECT rec_id, mention, sentence_left, sentence_right, NULL::VARCHAR AS context_left, NULL::VARCHAR AS context_right,
           label_link, split, 0 AS variant FROM v_mentions
    UNION ALL SELECT rec_id, mention, sentence_left, sentence_right, context_left, context_right, label_link, split, 1
    FROM v_mentions WHERE split = 'train'"""
views.SQL["v_g_labelled"] = rf"""
    WITH r AS (SELECT rec_id * 2 + variant AS row_id, mention, split, label_link,
                 trim(CASE WHEN length(sentence_left) > 0
                   THEN concat(coalesce(sentence_left, ''), ' ', coalesce(mention, ''), ' ', coalesce(sentence_right, ''))
                   ELSE concat(coalesce(context_left, ''), ' ', coalesce(mention, ''), ' ', coalesce(context_right, '')) END)
                 AS full_text FROM v_ingested)
    SELECT row_id, mention, split, full_text,
           CASE WHEN regexp_extract(label_link, 'techniques/(T\d+)', 1) IN ({_FIXED})
                THEN regexp_extract(label_link, 'techniques/(T\d+)', 1) ELSE 'OTHER' END AS label_mapped,
           len(regexp_split_to_array(full_text, '\s+'))::INTEGER AS word_count
    FROM r WHERE length(full_text) > 0"""
views.SQL["v_g_stats"] = views.SQL["v_stats"].replace("v_labelled", "v_g_labelled")
views.SQL["v_g_flagged"] = views.SQL["v_flagged"].replace("v_labelled", "v_g_labelled").replace("v_stats", "v_g_stats")
views.SQL["v_g_routed"] = views.SQL["v_routed"].replace("v_flagged", "v_g_flagged")
_G_REPORT = aggregates.REPORT_SQL.replace("v_routed", "v_g_routed")


@query("guard_run", f"""
    WITH c AS ({_G_REPORT}),
         k AS (SELECT DISTINCT split, full_text, word_count FROM v_g_routed WHERE route = 'clean'),
         s AS (SELECT split, count(*) AS stored, round(avg(word_count), 2) AS word_count_mean,
                      round(stddev_samp(word_count), 2) AS word_count_std FROM k GROUP BY split),
         q AS (SELECT split, count(*) AS stored_quarantine FROM v_g_routed WHERE route = 'quarantine' GROUP BY split)
    SELECT * FROM c JOIN s USING (split) JOIN q USING (split)""")
def guard_run(spark, sf):
    """From record files to stores and reports; the figures come from the stores."""
    out = guard.run_guard(spark, mention_files(spark, sf), scratch_path(spark, "guard"))
    stats = out["stats"].select("split", F.col("total_records").alias("stored"), "word_count_mean", "word_count_std")
    quarantined = out["quarantine"].groupBy("split").agg(F.count("*").alias("stored_quarantine"))
    return out["counts"].join(stats, "split").join(quarantined, "split")


@query("guard_run_audit", f"""
    WITH c AS ({_G_REPORT}),
         w AS (SELECT s.split, coalesce(x.n, 0) AS n, c.* EXCLUDE (split) FROM (VALUES ('train'), ('dev'), ('test')) s(split)
               LEFT JOIN (SELECT split, count(*) AS n FROM v_ingested GROUP BY 1) x USING (split) LEFT JOIN c USING (split))
    SELECT 'ingestion' AS stage, concat(split, '.records') AS key, n AS value FROM w
    UNION ALL SELECT 'detection', concat(split, '.', if(name = 'total', 'records', name)), value
    FROM (UNPIVOT (SELECT split, {", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in ("total", *records.FLAGS, "anomalies", "quarantined", "kept"))} FROM w)
          ON total, {", ".join(records.FLAGS)}, anomalies, quarantined, kept INTO NAME name VALUE value)""")
def guard_run_audit(spark, sf):
    """Ingest, flag and store counts that the run's own writes made; the SQL recounts them."""
    return guard.run_guard(spark, mention_files(spark, sf), scratch_path(spark, "guard"))["audit"]


_U_OTHER = u_sql("row_key", "'other'")


@query("prep_run", rf"""
    WITH s AS (SELECT concat(variant, ':', rec_id) AS row_key, split, label_id, coalesce(mention, '') AS m,
                      nullif({_strip('sentence_left')}, '') AS sl, nullif({_strip('sentence_right')}, '') AS sr,
                      nullif({_strip('context_left')}, '') AS cl, nullif({_strip('context_right')}, '') AS cr
               FROM v_variants),
         t AS (SELECT row_key, split, label_id, {_strip("CASE WHEN sl IS NULL AND sr IS NULL THEN concat_ws(' ', cl, m, cr) ELSE concat_ws(' ', sl, m, sr) END")} AS full_text FROM s),
         top AS (SELECT label_id FROM t WHERE split = 'train' GROUP BY 1 ORDER BY count(*) DESC, label_id LIMIT 8),
         l AS (SELECT *, CASE WHEN label_id IN (SELECT label_id FROM top) THEN label_id ELSE 'OTHER' END AS label_mapped FROM t),
         codes AS (SELECT label_mapped, (row_number() OVER (ORDER BY label_mapped) - 1)::INTEGER AS label_id_encoded
                   FROM (SELECT DISTINCT label_mapped FROM l)),
         kept AS (SELECT * FROM l WHERE split <> 'train' OR label_mapped <> 'OTHER'
                  UNION ALL (SELECT * FROM l WHERE split = 'train' AND label_mapped = 'OTHER' ORDER BY {_U_OTHER}, row_key LIMIT 100))
    SELECT row_key, full_text, label_id, label_mapped, label_id_encoded, split FROM kept JOIN codes USING (label_mapped)""")
def prep_run(spark, sf):
    v = src.ingest_variants(spark, mention_files(spark, sf), KEYED_SCHEMA)
    keyed = v.withColumn("row_key", F.concat("variant", F.lit(":"), F.col("rec_id").cast("string")))
    return prep.prep(keyed.drop("document", "label", "label_title", "entity_type"), "row_key", top_k=8, other_rows=100)


views.SQL["v_doc_clean"] = CLEAN_SQL.replace("v_raw_texts", "(SELECT doc_id::VARCHAR AS id, text FROM documents)") + f"""
    SELECT id::BIGINT AS doc_id, CASE WHEN length(n) <= 4000 THEN n
             ELSE concat(left(n, 2000), ' [...] ', right(n, 2000)) END AS full_text
    FROM (SELECT id, {NORMALIZE_SQL} AS n FROM cleaned)"""
views.SQL["v_enh"] = """
    WITH l AS (SELECT doc_id, concat('q', quality, 't', toxic) AS label_id, full_text,
                      CASE doc_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'dev' ELSE 'train' END AS split
               FROM labels JOIN v_doc_clean USING (doc_id)),
         top AS (SELECT label_id FROM l WHERE split = 'train' GROUP BY 1 ORDER BY count(*) DESC, label_id LIMIT 3)
    SELECT *, CASE WHEN label_id IN (SELECT label_id FROM top) THEN label_id ELSE 'OTHER' END AS label_mapped FROM l"""
views.SQL["v_enh_train"] = f"""
    SELECT *, count(*) OVER (PARTITION BY label_mapped) AS size,
           row_number() OVER (PARTITION BY label_mapped ORDER BY {aggregates.U_CAP}, doc_id) AS k
    FROM v_enh WHERE split = 'train'"""
views.SQL["v_enh_fill"] = f"""
    WITH c AS (SELECT label_mapped, size, unnest(range(1, 50 - size + 1)) AS copy
               FROM (SELECT DISTINCT label_mapped, size FROM v_enh_train WHERE size < 50)),
         f AS (SELECT label_mapped, copy, floor({aggregates.U_FILL} * size)::BIGINT + 1 AS k FROM c)
    SELECT concat(doc_id, '|', copy) AS doc_id, concat(doc_id, '/', copy) AS rid, full_text AS t
    FROM f JOIN v_enh_train USING (label_mapped, k)"""
views.SQL["v_enh_s"] = augment_synonym_sql("v_enh_fill")
views.SQL["v_enh_d"] = augment_delete_sql("v_enh_fill")
views.SQL["v_enh_h"] = augment_shuffle_sql("v_enh_fill")
_K3 = f"floor({u_sql('rid', chr(39) + 'augmentation' + chr(39))} * 3)"


@query("prep_run_enhanced", f"""
    WITH codes AS (SELECT label_mapped, (row_number() OVER (ORDER BY label_mapped) - 1)::INTEGER AS label_id_encoded
                   FROM (SELECT DISTINCT label_mapped FROM v_enh)),
         x AS (SELECT DISTINCT * FROM (SELECT doc_id, t FROM v_enh_s WHERE {_K3} = 0 UNION ALL
               SELECT doc_id, t FROM v_enh_d WHERE {_K3} = 1 UNION ALL SELECT doc_id, t FROM v_enh_h WHERE {_K3} = 2)),
         rows AS (
           SELECT doc_id, 0 AS copy, full_text, label_id, label_mapped, FALSE AS is_augmented, split
           FROM v_enh_train WHERE k <= 200
           UNION ALL SELECT doc_id, 0, full_text, label_id, label_mapped, FALSE, split FROM v_enh WHERE split <> 'train'
           UNION ALL SELECT e.doc_id, split_part(x.doc_id, '|', 2)::INTEGER, x.t, label_id, label_mapped, TRUE, split
           FROM x JOIN v_enh_train e ON e.doc_id = split_part(x.doc_id, '|', 1)::BIGINT)
    SELECT doc_id, copy, full_text, label_id, label_mapped, label_id_encoded, is_augmented, split
    FROM rows JOIN codes USING (label_mapped)""")
def prep_run_enhanced(spark, sf):
    name = F.concat(F.lit("DOC_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    labels = table(spark, sf, "labels").select(
        "doc_id", name.alias("document"), F.concat(F.lit("q"), "quality", F.lit("t"), "toxic").alias("label_id"),
        views.split_of(F.col("doc_id")).alias("split"))
    texts = spread(table(spark, sf, "documents"), "doc_id").select(name.alias("document"), F.col("text").alias("full_text"))
    return prep.prep_enhanced(labels, texts, "doc_id", top_k=3, at_most=200).drop("document")
