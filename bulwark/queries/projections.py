"""Scalar functions and projections (P)."""

from pyspark.sql import functions as F

from bulwark.functions import text as tx
from bulwark.operators import joins, records
from bulwark.queries import views
from bulwark.queries.registry import query
from bulwark.queries.views import table

SP = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"


def _strip(x):
    return rf"regexp_replace({x}, '^{SP}+|{SP}+$', '', 'g')"


@query("rich_text_spark", """
    SELECT conv_id, turn,
           CASE WHEN length(sentence_left) > 0
                THEN concat(coalesce(sentence_left, ''), ' ', coalesce(mention, ''), ' ', coalesce(sentence_right, ''))
                ELSE concat(coalesce(context_left, ''), ' ', coalesce(mention, ''), ' ', coalesce(context_right, ''))
           END AS full_text
    FROM v_context""")
def rich_text_spark(spark, sf):
    return views.context(spark, sf).select("conv_id", "turn", tx.rich_text().alias("full_text"))


@query("rich_text_strict", f"""
    WITH s AS (SELECT conv_id, turn, coalesce(mention, '') AS m,
                      nullif({_strip('sentence_left')}, '') AS sl, nullif({_strip('sentence_right')}, '') AS sr,
                      nullif({_strip('context_left')}, '') AS cl, nullif({_strip('context_right')}, '') AS cr
               FROM v_context)
    SELECT conv_id, turn,
           {_strip("CASE WHEN sl IS NULL AND sr IS NULL THEN concat_ws(' ', cl, m, cr) ELSE concat_ws(' ', sl, m, sr) END")}
           AS full_text
    FROM s""")
def rich_text_strict(spark, sf):
    return views.context(spark, sf).select("conv_id", "turn", tx.rich_text_strict().alias("full_text"))


@query("trim_nonempty", "SELECT doc_id, trim(full_text) AS full_text FROM v_docs WHERE length(trim(full_text)) > 0")
def trim_nonempty(spark, sf):
    return records.trim_nonempty(views.docs(spark, sf).select("doc_id", "full_text"))


@query("technique_extract", r"""
    SELECT page_id, coalesce(regexp_extract(label_link, 'techniques/(T\d+)', 1), '') AS technique_id
    FROM v_links WHERE label_link IS NOT NULL
    UNION ALL SELECT page_id, NULL FROM v_links WHERE label_link IS NULL""")
def technique_extract(spark, sf):
    return views.links(spark, sf).select("page_id", tx.technique_id(F.col("label_link")).alias("technique_id"))


_FIXED = ", ".join(f"('{t}')" for t in (*tx.TOP_TECHNIQUES, tx.OTHER))
LABELS_SQL = rf"""
    WITH l AS (SELECT page_id, coalesce(nullif(regexp_extract(label_link, 'techniques/(T\d+)', 1), ''), 'OTHER')
                      AS label_id_str FROM v_links),
         fixed(label) AS (VALUES {_FIXED}),
         codes AS (SELECT label, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS code FROM fixed),
         m AS (SELECT page_id, label_id_str,
                      CASE WHEN label_id_str IN (SELECT label FROM fixed) THEN label_id_str ELSE 'OTHER' END
                      AS label_mapped FROM l)
"""


@query("label_default", LABELS_SQL + "SELECT page_id, label_id_str FROM m")
def label_default(spark, sf):
    label = tx.label_or_other(tx.technique_id(F.col("label_link")))
    return views.links(spark, sf).select("page_id", label.alias("label_id_str"))


@query("label_fixed_set", LABELS_SQL + """
    SELECT page_id, label_id_str, label_mapped, code AS label_id_encoded FROM m JOIN codes ON label = label_mapped""")
def label_fixed_set(spark, sf):
    return records.map_technique_labels(views.links(spark, sf)).select(
        "page_id", "label_id_str", "label_mapped", "label_id_encoded")


@query("label_encode", """
    WITH codes AS (SELECT label_mapped, (row_number() OVER (ORDER BY label_mapped) - 1)::INTEGER AS code
                   FROM (SELECT DISTINCT label_mapped FROM v_labelled))
    SELECT doc_id, label_mapped, code AS label_id_encoded FROM v_labelled JOIN codes USING (label_mapped)""")
def label_encode(spark, sf):
    d = views.labelled(spark, sf).select("doc_id", "label_mapped")
    return records.encode_labels(d).select("doc_id", "label_mapped", "label_id_encoded")


@query("word_count", "SELECT doc_id, word_count FROM v_labelled")
def word_count(spark, sf):
    d = records.trim_nonempty(views.docs(spark, sf).select("doc_id", "full_text"))
    return records.add_lengths(d).select("doc_id", "word_count")


@query("char_count", "SELECT doc_id, char_count FROM v_labelled")
def char_count(spark, sf):
    d = records.trim_nonempty(views.docs(spark, sf).select("doc_id", "full_text"))
    return records.add_lengths(d).select("doc_id", "char_count")


@query("project_available", "SELECT mention, full_text, label_mapped, word_count, char_count, split FROM v_labelled")
def project_available(spark, sf):
    return records.project_available(views.labelled(spark, sf))


@query("doc_key_normalize", "SELECT rec_id, lower(trim(replace(document, '.txt', ''))) AS doc_key FROM v_mentions")
def doc_key_normalize(spark, sf):
    return views.mentions(spark, sf).select("rec_id", tx.doc_key(F.col("document")).alias("doc_key"))


@query("negative_sentinel", """
    SELECT rec_id, CASE WHEN label_id = '1906' THEN 'OTHER' ELSE label_id END AS label_id FROM v_mentions""")
def negative_sentinel(spark, sf):
    return views.mentions(spark, sf).select("rec_id", tx.negative_to_other(F.col("label_id")).alias("label_id"))


# The patterns for links, mail addresses, paths and code, and the marks that replace them.
CLEAN_SQL = rf"""
    WITH a AS (SELECT id, text AS o,
                      list_filter(regexp_extract_all(text, 'https?://([a-zA-Z0-9.-]+)(?:/[^\s]*)?', 1),
                                  lambda h, i: list_position(regexp_extract_all(text, 'https?://([a-zA-Z0-9.-]+)(?:/[^\s]*)?', 1), h) = i)[1:5]
                      AS hosts,
                      regexp_replace(text, 'https?://[^\s]+', ' [URL] ', 'g') AS t FROM v_raw_texts),
         b AS (SELECT id, o, hosts, regexp_replace(t, '\S+@\S+\.\S+', ' [EMAIL] ', 'g') AS t FROM a),
         c AS (SELECT id, o, hosts, regexp_replace(t,
                      '[A-Za-z]:\\(?:[^\\/:*?"<>|\r\n]+\\)*([^\\/:*?"<>|\r\n]+)', ' \1 ', 'g') AS t FROM b),
         d AS (SELECT id, o, hosts, regexp_replace(t, '/(?:[^/\s]+/)*([^/\s]+\.[a-zA-Z]+)', ' \1 ', 'g') AS t FROM c),
         e AS (SELECT id, o, hosts, regexp_replace(regexp_replace(t, '```[\s\S]*?```', ' [CODE_BLOCK] ', 'g'),
                      '`[^`]+`', ' [CODE] ', 'g') AS t FROM d),
         f AS (SELECT id, o, hosts, regexp_replace(t,
                      '[^\p{{L}}\p{{N}}_\s.,:;\-()\[\]''"/@#$%&*+=<>?!]', ' ', 'g') AS t FROM e),
         g AS (SELECT id, o, hosts, trim(regexp_replace(t, '{SP}+', ' ', 'g')) AS t FROM f),
         h AS (SELECT id, o, concat(CASE WHEN length(t) > 10 THEN t ELSE '' END,
                      CASE WHEN len(hosts) > 0 THEN concat(' [DOMAINS: ', array_to_string(hosts, ', '), ']') ELSE '' END) AS t
               FROM g),
         cleaned AS (SELECT id, CASE WHEN length(trim(t)) < 50 AND length(o) > 50 THEN left(t, length(o)::INTEGER)
                                     ELSE trim(t) END AS clean_text FROM h)
"""

NORMALIZE_SQL = "clean_text"
NORMALIZE_SQL = f"replace(replace({NORMALIZE_SQL}, '–', '-'), '—', '-')"
for _abbr, _long in tx.ABBREVIATIONS:
    NORMALIZE_SQL = rf"regexp_replace({NORMALIZE_SQL}, '(?i)\b{_abbr}\b', '{_abbr} ({_long})', 'g')"


@query("clean_text", CLEAN_SQL + "SELECT id, clean_text FROM cleaned")
def clean_text(spark, sf):
    return views.raw_texts(spark, sf).select("id", tx.clean_text(F.col("text")).alias("clean_text"))


@query("normalize_text", f"""
    WITH t AS (SELECT doc_id, full_text AS clean_text FROM v_docs)
    SELECT doc_id, {NORMALIZE_SQL} AS norm_text FROM t""")
def normalize_text(spark, sf):
    return views.texts(spark, sf).select("doc_id", tx.normalize_text(F.col("full_text")).alias("norm_text"))


@query("truncate_head", "SELECT doc_id, left(full_text, 4000) AS cut FROM v_docs")
def truncate_head(spark, sf):
    return views.docs(spark, sf).select("doc_id", tx.truncate_head(F.col("full_text")).alias("cut"))


@query("truncate_tail", "SELECT doc_id, right(full_text, 4000) AS cut FROM v_docs")
def truncate_tail(spark, sf):
    return views.docs(spark, sf).select("doc_id", tx.truncate_tail(F.col("full_text")).alias("cut"))


@query("truncate_head_tail", """
    SELECT doc_id, CASE WHEN length(full_text) <= 4000 THEN full_text
                        ELSE concat(left(full_text, 2000), ' [...] ', right(full_text, 2000)) END AS cut FROM v_docs""")
def truncate_head_tail(spark, sf):
    return views.docs(spark, sf).select("doc_id", tx.truncate_head_tail(F.col("full_text")).alias("cut"))


_HITS = " + ".join(f"contains(lower(s), '{k}')::INTEGER" for k in tx.KEYWORDS)


@query("truncate_important", rf"""
    WITH s AS (SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS pos FROM (
                 SELECT doc_id, string_split(regexp_replace(full_text, '([.!?]){SP}+', concat('\1', chr(1)), 'g'), chr(1)) AS ss
                 FROM v_docs WHERE length(full_text) > 4000)),
         r AS (SELECT doc_id, s, pos, {_HITS} AS score FROM s),
         n AS (SELECT *, row_number() OVER w AS k, sum(length(s)) OVER w AS used FROM r
               WINDOW w AS (PARTITION BY doc_id ORDER BY score DESC, pos ROWS UNBOUNDED PRECEDING)),
         stop AS (SELECT doc_id, coalesce(min(CASE WHEN used >= 4000 THEN k END), max(k) + 1) AS k FROM n GROUP BY doc_id),
         kept AS (SELECT n.doc_id, string_agg(s, ' ' ORDER BY n.k) AS cut FROM n JOIN stop USING (doc_id)
                  WHERE n.k < stop.k GROUP BY n.doc_id)
    SELECT d.doc_id, CASE WHEN length(full_text) <= 4000 THEN full_text ELSE coalesce(cut, left(full_text, 4000)) END AS cut
    FROM v_docs d LEFT JOIN kept USING (doc_id)""")
def truncate_important(spark, sf):
    return views.texts(spark, sf).select("doc_id", tx.truncate_important(F.col("full_text")).alias("cut"))


@query("preview_text", "SELECT doc_id, concat(left(full_text, 200), '...') AS preview FROM v_docs")
def preview_text(spark, sf):
    return views.docs(spark, sf).select("doc_id", tx.preview(F.col("full_text")).alias("preview"))


@query("explain_selection", """
    WITH s AS (SELECT vec_id, entropy, margin, list_max(probs) AS confidence,
                      CASE WHEN list_position(probs, list_max(probs)) - 1 <> label
                           THEN 'synonym_misclassification' ELSE 'synonym_low_confidence' END AS method
               FROM v_scored)
    SELECT vec_id, concat_ws('; ',
             concat(CASE WHEN entropy > 1.5 THEN 'Very high' WHEN entropy > 1.0 THEN 'High' ELSE 'Moderate' END,
                    ' uncertainty (entropy=', printf('%.3f', entropy), ')'),
             CASE WHEN margin < 0.1 THEN 'nearly equal top-2 class probabilities'
                  WHEN margin < 0.3 THEN 'small margin between top predictions' END,
             CASE WHEN contains(method, 'misclassification') THEN 'attack caused misclassification via synonym'
                  ELSE concat('low model confidence (', printf('%.3f', confidence), ')') END) AS explanation
    FROM s""")
def explain_selection(spark, sf):
    from bulwark.functions import vectors

    p = F.col("probs")
    method = F.when(vectors.prediction(p) != F.col("label"), "synonym_misclassification").otherwise(
        "synonym_low_confidence")
    return views.scored(spark, sf).select(
        "vec_id",
        tx.explain_selection(F.col("entropy"), F.col("margin"), method, F.lit("synonym"),
                             vectors.confidence(p)).alias("explanation"),
    )


@query("round_metrics", """
    SELECT seed, strategy, iteration, round(clean_accuracy, 4) AS clean_accuracy,
           round(robust_accuracy, 4) AS robust_accuracy, round(attack_success_rate, 4) AS attack_success_rate,
           n_labeled_samples FROM v_timeline""")
def round_metrics(spark, sf):
    from bulwark.operators.series import round_metrics as rounded

    return rounded(views.timeline(spark, sf))


@query("event_details_json", """
    SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k, value AS detail_value,
           concat('{"k":', json_extract_string(props, '$.k'), ',"event_type":"', event_type, '"}') AS details
    FROM v_events""")
def event_details_json(spark, sf):
    """Details become one nested value, written as JSON and read back."""
    k = F.from_json("props", "k int")["k"]
    e = views.audit_events(spark, sf).withColumn("details", F.to_json(F.struct(k.alias("k"), "event_type")))
    back = F.from_json("details", "k int, event_type string")
    return e.select("event_id", back["k"].alias("k"), F.col("value").alias("detail_value"), "details")


@query("null_drop", "SELECT doc_id, mention FROM v_docs WHERE mention IS NOT NULL AND full_text IS NOT NULL")
def null_drop(spark, sf):
    return views.docs(spark, sf).dropna(subset=["full_text", "mention"]).select("doc_id", "mention")


@query("label_name_lookup", """
    SELECT s.s_suppkey, coalesce(r.r_name, n.n_regionkey::VARCHAR) AS label_name
    FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey
    LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def label_name_lookup(spark, sf):
    names = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    s = table(spark, sf, "supplier").join(
        F.broadcast(table(spark, sf, "nation")), F.col("n_nationkey") == F.col("s_nationkey"))
    return joins.label_names(s, names, "n_regionkey", "r_name").select("s_suppkey", "label_name")
