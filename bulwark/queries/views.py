"""Fixture views over the given tables, in Spark and (dict SQL) in DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulwark.functions import vectors
from bulwark.functions.seeded import uniform
from bulwark.operators import records
from bulwark.session import spread

STRATEGIES = ("entropy", "margin", "random")
ATTACKS = ("synonym", "char_swap", "homoglyph", "keyboard_typo", "char_deletion")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def split_of(row_id: Column) -> Column:
    r = F.pmod(row_id, F.lit(10))
    return F.when(r == 0, "test").when(r == 1, "dev").otherwise("train")


def docs(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id",
        F.col("text").alias("full_text"),
        "lang",
        "source",
        split_of(F.col("doc_id")).alias("split"),
        F.nullif(F.regexp_extract("text", "([A-Z][a-z]{7,})", 1), F.lit("")).alias("mention"),
    )


def texts(spark, sf) -> DataFrame:
    """Whole documents for costly text work, on all cores."""
    return spread(docs(spark, sf).select("doc_id", "full_text"), "doc_id")


def labelled(spark, sf) -> DataFrame:
    """Trimmed documents, labelled by source: the 15 largest of the training split, else OTHER."""
    d = records.trim_nonempty(spread(docs(spark, sf), "doc_id"))
    return records.add_lengths(records.reduce_labels(d, "source", k=15))


def context(spark, sf) -> DataFrame:
    """Neighbouring turns. Turns are consecutive, so equi-joins find them without a window per conversation."""
    c = table(spark, sf, "conversations")
    left = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("sentence_left"))
    right = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("sentence_right"))
    return (
        c.join(left, ["conv_id", "turn"], "left")
        .join(right, ["conv_id", "turn"], "left")
        .select(
            "conv_id", "turn", "sentence_left", F.col("text").alias("mention"), "sentence_right",
            F.col("role").alias("context_left"), F.col("turn").cast("string").alias("context_right"),
        )
    )


def mentions(spark, sf) -> DataFrame:
    """Annotated mention records as a raw file holds them."""
    n = F.pmod(F.col("conv_id") * 37 + F.col("turn") * 11, F.lit(190)) + 1000
    return context(spark, sf).select(
        "conv_id", "turn",
        (F.col("conv_id") * 1000 + F.col("turn")).alias("rec_id"),
        F.concat(F.lit(" Conv_"), F.col("conv_id").cast("string"), F.lit(".txt")).alias("document"),
        "mention", "sentence_left", "sentence_right", "context_left", "context_right",
        F.when(F.pmod(n, F.lit(10)) == 0, F.lit(None).cast("string"))
        .when(F.pmod(n, F.lit(10)) == 1, F.lit("https://example.org/groups/G7"))
        .otherwise(F.concat(F.lit("https://example.org/techniques/T"), n.cast("string")))
        .alias("label_link"),
        F.when(F.pmod(F.col("conv_id"), F.lit(9)) == 0, F.lit("1906"))
        .otherwise((F.pmod(F.col("conv_id"), F.lit(19)) + 100).cast("string")).alias("label_id"),
        split_of(F.col("conv_id")).alias("split"),
    )


def links(spark, sf) -> DataFrame:
    number = F.regexp_extract("url", r"/([a-z]{2})/(\d+)", 2).cast("int")
    return table(spark, sf, "pages").select(
        "page_id", "url",
        F.when(F.pmod(number, F.lit(10)) == 0, F.lit(None).cast("string"))
        .when(F.pmod(number, F.lit(10)) == 1, F.lit("https://example.org/groups/G7"))
        .otherwise(F.concat(F.lit("https://example.org/techniques/T"),
                            (F.pmod(number, F.lit(190)) + 1000).cast("string")))
        .alias("label_link"),
    )


def raw_texts(spark, sf) -> DataFrame:
    """Documents and pages, the latter with markup, links and paths."""
    d = spread(table(spark, sf, "documents"), "doc_id").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text")
    p = spread(table(spark, sf, "pages"), "page_id").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"),
        F.concat_ws(" ", "html", "url").alias("text"),
    )
    return d.union(p)


def predictions(spark, sf) -> DataFrame:
    i, label = F.col("vec_id"), F.col("label")

    def flipped(tag, share, step):
        return F.when(uniform(i, tag) < share, F.pmod(label + step, F.lit(10))).otherwise(label).cast("int")

    return table(spark, sf, "embeddings").select(
        "vec_id", "label",
        flipped(0, 0.2, 1).alias("original_pred"),
        flipped(1, 0.35, 3).alias("adv_pred"),
        flipped(2, 0.25, 5).alias("defended_pred"),
    )


def probs(spark, sf) -> DataFrame:
    """Every tenth component, from the class on, adds up to the class's logit: all of a vector counts."""
    def logit(c):
        mine = F.filter("embedding", lambda x, i: F.pmod(i, F.lit(10)) == c)
        return F.aggregate(mine, F.lit(0.0), lambda a, x: a + x.cast("double")) * 4

    logits = F.transform(F.sequence(F.lit(0), F.lit(9)), logit)
    return table(spark, sf, "embeddings").select("vec_id", "label", vectors.softmax(logits).alias("probs"))


def scored(spark, sf) -> DataFrame:
    from bulwark.operators.selection import score_pool

    return score_pool(probs(spark, sf))


def timeline(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")

    def share(*types):
        return F.avg(F.col("event_type").isin(*types).cast("double"))

    strategy = F.get(F.array(*map(F.lit, STRATEGIES)), F.pmod("user_id", F.lit(3)).cast("int"))
    return (
        e.groupBy(
            F.pmod("user_id", F.lit(5)).cast("int").alias("seed"),
            strategy.alias("strategy"),
            (F.dayofmonth("ts") - 1).alias("iteration"),
        )
        .agg(
            F.lit(1.0).__sub__(share("error")).alias("clean_accuracy"),
            share("view", "click", "purchase").alias("robust_accuracy"),
            share("error").alias("attack_success_rate"),
        )
        .withColumn("n_labeled_samples", (F.col("iteration") * 50).cast("long"))
    )


def audit_events(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", "event_type", (F.dayofmonth("ts") - 1).alias("iteration"), "value", "props"
    )


def attacks(spark, sf) -> DataFrame:
    """Predictions exploded over attack names, with a success threshold and a confidence per attack."""
    p = predictions(spark, sf).select("vec_id", "label", "original_pred")
    names = F.array(*[F.struct(F.lit(a).alias("attack"), F.lit(i).alias("attack_order"))
                      for i, a in enumerate(ATTACKS)])
    x = p.withColumn("a", F.explode(names)).select("vec_id", "label", "original_pred", "a.*")
    u = uniform(F.col("vec_id"), F.concat(F.lit("attack-"), F.col("attack_order").cast("string")))
    return x.select(
        "*",
        F.when(u < 0.1 + 0.08 * F.col("attack_order"), F.pmod(F.col("label") + 3, F.lit(10)))
        .otherwise(F.col("label")).cast("int").alias("adv_pred"),
        uniform(F.col("vec_id"), F.concat(F.lit("confidence-"), F.col("attack_order").cast("string")))
        .alias("adv_confidence"),
    )


def seed_metrics(spark, sf) -> DataFrame:
    """Long table (model, seed, method, metric, value) of the last iteration of every run."""
    from bulwark.operators.series import final_iteration

    last = final_iteration(timeline(spark, sf), ["seed", "strategy"])
    return last.select(
        F.concat(F.lit("model-"), F.pmod("seed", F.lit(2)).cast("string")).alias("model"),
        "seed", F.col("strategy").alias("method"),
        "clean_accuracy", "robust_accuracy", "attack_success_rate",
        F.col("n_labeled_samples").cast("double").alias("n_labeled_samples"),
    ).unpivot(
        ["model", "seed", "method"],
        ["clean_accuracy", "robust_accuracy", "attack_success_rate", "n_labeled_samples"],
        "metric", "value",
    )


def text_label(spark, sf) -> DataFrame:
    l = table(spark, sf, "labels")
    d = docs(spark, sf).select("doc_id", "full_text", "split", "source")
    return d.join(l, "doc_id")


def u_sql(row_id: str, tag: str, seed: int = 42) -> str:
    return (
        f"(concat('0x', substr(md5(concat_ws(':', {row_id}, {tag}, {seed})), 1, 8))::BIGINT"
        f" / 4294967296.0::DOUBLE)"
    )


SQL = {
    "v_docs": """
        SELECT doc_id, text AS full_text, lang, source,
               CASE doc_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'dev' ELSE 'train' END AS split,
               nullif(regexp_extract(text, '([A-Z][a-z]{7,})', 1), '') AS mention
        FROM documents""",
    "v_top15": """
        SELECT source FROM (SELECT trim(full_text) AS t, source, split FROM v_docs)
        WHERE split = 'train' AND length(t) > 0
        GROUP BY source ORDER BY count(*) DESC, source LIMIT 15""",
    "v_labelled": r"""
        SELECT doc_id, trim(full_text) AS full_text, lang, source, split, mention,
               CASE WHEN source IN (SELECT source FROM v_top15) THEN source ELSE 'OTHER' END AS label_mapped,
               len(regexp_split_to_array(trim(full_text), '\s+'))::INTEGER AS word_count,
               length(trim(full_text))::INTEGER AS char_count
        FROM v_docs WHERE length(trim(full_text)) > 0""",
    "v_stats": """
        SELECT avg(word_count) AS mean_wc, stddev_samp(word_count) AS std_wc
        FROM v_labelled WHERE split = 'train'""",
    "v_flagged": """
        SELECT d.*,
               word_count < greatest(3, trunc(mean_wc - 3 * std_wc)::INTEGER) AS flag_short_text,
               word_count > trunc(mean_wc + 3 * std_wc)::INTEGER AS flag_long_text,
               (mention IS NULL OR length(mention) = 0) AS flag_null_mention,
               (label_mapped = 'OTHER' AND word_count < 5) AS flag_other_tiny,
               count(*) OVER (PARTITION BY split, full_text) > 1 AS flag_duplicate
        FROM v_labelled d, v_stats""",
    "v_routed": """
        SELECT *, (flag_short_text OR flag_long_text OR flag_null_mention OR flag_other_tiny OR flag_duplicate)
                  AS is_anomaly,
               CASE WHEN flag_short_text OR flag_null_mention OR flag_other_tiny
                    THEN 'quarantine' ELSE 'clean' END AS route
        FROM v_flagged""",
    "v_kept": """
        SELECT * FROM v_routed WHERE route = 'clean'
        QUALIFY row_number() OVER (PARTITION BY split, full_text ORDER BY doc_id) = 1""",
    "v_context": """
        SELECT conv_id, turn,
               lag(text) OVER w AS sentence_left, text AS mention, lead(text) OVER w AS sentence_right,
               role AS context_left, turn::VARCHAR AS context_right
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
    "v_mentions": """
        SELECT conv_id, turn, conv_id * 1000 + turn AS rec_id,
               ' Conv_' || conv_id || '.txt' AS document,
               mention, sentence_left, sentence_right, context_left, context_right,
               CASE WHEN ((conv_id * 37 + turn * 11) % 190 + 1000) % 10 = 0 THEN NULL
                    WHEN ((conv_id * 37 + turn * 11) % 190 + 1000) % 10 = 1 THEN 'https://example.org/groups/G7'
                    ELSE 'https://example.org/techniques/T' || ((conv_id * 37 + turn * 11) % 190 + 1000) END
                    AS label_link,
               CASE WHEN conv_id % 9 = 0 THEN '1906' ELSE (conv_id % 19 + 100)::VARCHAR END AS label_id,
               CASE conv_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'dev' ELSE 'train' END AS split
        FROM v_context""",
    "v_links": r"""
        SELECT page_id, url,
               CASE WHEN number % 10 = 0 THEN NULL
                    WHEN number % 10 = 1 THEN 'https://example.org/groups/G7'
                    ELSE 'https://example.org/techniques/T' || (number % 190 + 1000) END AS label_link
        FROM (SELECT page_id, url, regexp_extract(url, '/([a-z]{2})/(\d+)', 2)::INTEGER AS number FROM pages)""",
    "v_raw_texts": """
        SELECT 'd' || doc_id AS id, text FROM documents
        UNION ALL SELECT 'p' || page_id, concat_ws(' ', html, url) FROM pages""",
    "v_predictions": f"""
        SELECT vec_id, label,
               CASE WHEN {u_sql('vec_id', '0')} < 0.2 THEN (label + 1) % 10 ELSE label END AS original_pred,
               CASE WHEN {u_sql('vec_id', '1')} < 0.35 THEN (label + 3) % 10 ELSE label END AS adv_pred,
               CASE WHEN {u_sql('vec_id', '2')} < 0.25 THEN (label + 5) % 10 ELSE label END AS defended_pred
        FROM embeddings""",
    "v_logits": """
        SELECT vec_id, label,
               [4 * list_sum([embedding[i]::DOUBLE FOR i IN range(c, len(embedding) + 1, 10)]) FOR c IN range(1, 11)] AS logits
        FROM embeddings""",
    "v_probs": """
        SELECT vec_id, label, [x / list_sum(e) FOR x IN e] AS probs
        FROM (SELECT vec_id, label, [exp(x - list_max(logits)) FOR x IN logits] AS e FROM v_logits)""",
    "v_scored": """
        SELECT *, 0.4 * loss + 0.5 * confidence_flip + 0.2 * (1 - margin) AS utility
        FROM (
          SELECT vec_id, label, probs,
                 -list_sum([greatest(1e-10, least(1.0, p)) * ln(greatest(1e-10, least(1.0, p))) FOR p IN probs])
                   AS entropy,
                 list_reverse_sort(probs)[1] - list_reverse_sort(probs)[2] AS margin,
                 CASE WHEN label >= 0 AND label < len(probs)
                      THEN -ln(greatest(1e-10, least(1.0, probs[label + 1]))) ELSE 5.0 END AS loss,
                 CASE WHEN label >= 0 AND label < len(probs)
                      THEN 1 - greatest(1e-10, least(1.0, probs[label + 1])) ELSE 1.0 END AS confidence_flip
          FROM v_probs)""",
    "v_timeline": """
        SELECT (user_id % 5)::INTEGER AS seed,
               ['entropy', 'margin', 'random'][(user_id % 3) + 1] AS strategy,
               (date_part('day', ts) - 1)::INTEGER AS iteration,
               1 - avg((event_type = 'error')::INTEGER) AS clean_accuracy,
               avg((event_type IN ('view', 'click', 'purchase'))::INTEGER) AS robust_accuracy,
               avg((event_type = 'error')::INTEGER) AS attack_success_rate,
               ((date_part('day', min(ts)) - 1) * 50)::BIGINT AS n_labeled_samples
        FROM events GROUP BY 1, 2, 3""",
    "v_final": """
        SELECT * FROM v_timeline
        QUALIFY row_number() OVER (PARTITION BY seed, strategy ORDER BY iteration DESC) = 1""",
    "v_events": """
        SELECT event_id, event_type, (date_part('day', ts) - 1)::INTEGER AS iteration, value, props FROM events""",
    "v_attacks": f"""
        SELECT vec_id, label, original_pred, attack, attack_order,
               CASE WHEN {u_sql('vec_id', "'attack-' || attack_order")} < 0.1 + 0.08 * attack_order
                    THEN (label + 3) % 10 ELSE label END AS adv_pred,
               {u_sql('vec_id', "'confidence-' || attack_order")} AS adv_confidence
        FROM v_predictions,
             (VALUES ('synonym', 0), ('char_swap', 1), ('homoglyph', 2), ('keyboard_typo', 3), ('char_deletion', 4))
             a(attack, attack_order)""",
    "v_seed_metrics": """
        SELECT 'model-' || (seed % 2) AS model, seed, strategy AS method, metric, value
        FROM (UNPIVOT (SELECT seed, strategy, clean_accuracy, robust_accuracy, attack_success_rate,
                              n_labeled_samples::DOUBLE AS n_labeled_samples FROM v_final)
              ON clean_accuracy, robust_accuracy, attack_success_rate, n_labeled_samples
              INTO NAME metric VALUE value)""",
    "v_text_label": """
        SELECT d.doc_id, d.full_text, d.split, d.source, l.quality, l.toxic
        FROM v_docs d JOIN labels l USING (doc_id)""",
    "v_confusion": """
        SELECT t.c AS label, p.c AS prediction, coalesce(n, 0)::BIGINT AS n
        FROM (SELECT DISTINCT label AS c FROM v_predictions UNION SELECT adv_pred FROM v_predictions) t
        CROSS JOIN (SELECT DISTINCT label AS c FROM v_predictions UNION SELECT adv_pred FROM v_predictions) p
        LEFT JOIN (SELECT label, adv_pred, count(*) AS n FROM v_predictions GROUP BY 1, 2) x
               ON x.label = t.c AND x.adv_pred = p.c""",
    "v_class_counts": """
        SELECT *, (SELECT sum(n) FROM v_confusion) - tp - fp - fn AS tn FROM (
          SELECT c.label,
                 sum(CASE WHEN m.label = c.label AND prediction = c.label THEN n ELSE 0 END) AS tp,
                 sum(CASE WHEN m.label <> c.label AND prediction = c.label THEN n ELSE 0 END) AS fp,
                 sum(CASE WHEN m.label = c.label AND prediction <> c.label THEN n ELSE 0 END) AS fn
          FROM (SELECT DISTINCT label FROM v_confusion) c, v_confusion m GROUP BY c.label)""",
    "v_class_scores": """
        SELECT label, tp, fp, fn, tn,
               CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
               CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
               CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS specificity,
               CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1,
               tp + fn AS support
        FROM v_class_counts""",
}
