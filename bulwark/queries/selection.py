"""Top-k, selection, sampling and balancing (T)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from bulwark.operators import metrics
from bulwark.operators import selection as sel
from bulwark.queries import aggregates, views
from bulwark.queries.common import rounded
from bulwark.queries.registry import query
from bulwark.queries.views import u_sql

BUDGET = 50


@query("top5_labels", """
    SELECT split, label_mapped, n FROM (SELECT split, label_mapped, count(*) AS n FROM v_labelled GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY split ORDER BY n DESC, label_mapped) <= 5""")
def top5_labels(spark, sf):
    counts = views.labelled(spark, sf).groupBy("split", "label_mapped").agg(F.count("*").alias("n"))
    order = Window.partitionBy("split").orderBy(F.desc("n"), "label_mapped")
    return counts.withColumn("r", F.row_number().over(order)).where("r <= 5").drop("r")


@query("topk_label_reduce", "SELECT doc_id, source, label_mapped FROM v_labelled")
def topk_label_reduce(spark, sf):
    return views.labelled(spark, sf).select("doc_id", "source", "label_mapped")


def _select(name, strategy, column, order):
    value = f", round({column}, 6) AS {column}" if column else ""

    @query(name, f"SELECT vec_id{value} FROM v_scored ORDER BY {order}, vec_id LIMIT {BUDGET}")
    def run(spark, sf):
        chosen = sel.select_top_b(views.scored(spark, sf), "vec_id", strategy, BUDGET)
        return rounded(chosen.select("vec_id", *([column] if column else [])))


_select("select_entropy", "entropy", "entropy", "v_scored.entropy DESC")
_select("select_margin", "margin", "margin", "v_scored.margin")
_select("select_composite", "composite", "utility", "v_scored.utility DESC")
_select("select_random", "random", None, "md5(concat_ws(':', vec_id, 'random', 42))")

_CORESET = """
    WITH RECURSIVE pool AS ({pool}),
      s(r, ids, vecs) AS (
        SELECT 1, [first(k ORDER BY k)], [first(probs ORDER BY k)] FROM pool
        UNION ALL
        SELECT any_value(r) + 1,
               list_append(any_value(ids), arg_max(k, (d, -k))),
               list_append(any_value(vecs), arg_max(probs, (d, -k)))
        FROM (SELECT r, ids, vecs, k, probs, list_min([list_distance(probs, c) FOR c IN vecs]) AS d
              FROM s, pool WHERE NOT list_contains(ids, k) AND r < {budget}) GROUP BY r)
    SELECT {out} FROM (SELECT unnest(ids) AS k, generate_subscripts(ids, 1) AS rank
                       FROM (SELECT ids FROM s ORDER BY r DESC LIMIT 1)) {join}"""


@query("select_coreset", _CORESET.format(
    pool="SELECT vec_id AS k, probs FROM v_probs", budget=BUDGET, out="k AS vec_id, rank::INTEGER AS rank", join=""))
def select_coreset(spark, sf):
    return sel.select_coreset(views.probs(spark, sf), "vec_id", BUDGET).select("vec_id", "rank")


@query("select_entropy_coreset", _CORESET.format(
    pool=f"""SELECT row_number() OVER (ORDER BY entropy DESC, vec_id) AS k, vec_id, probs FROM v_scored
             QUALIFY k <= {2 * BUDGET}""",
    budget=BUDGET, out="vec_id, rank::INTEGER AS rank", join="JOIN pool USING (k)"))
def select_entropy_coreset(spark, sf):
    return sel.select_entropy_coreset(views.scored(spark, sf), "vec_id", BUDGET).select("vec_id", "rank")


@query("exact_sample", f"SELECT doc_id, lang FROM v_docs ORDER BY {u_sql('doc_id', chr(39) + 'sample' + chr(39))}, doc_id LIMIT 200")
def exact_sample(spark, sf):
    return sel.exact_sample(views.docs(spark, sf).select("doc_id", "lang"), "doc_id", 200)


@query("shuffle", f"""
    SELECT doc_id, row_number() OVER (ORDER BY {u_sql('doc_id', chr(39) + 'shuffle' + chr(39))}, doc_id) AS position FROM v_docs""")
def shuffle(spark, sf):
    return sel.shuffle_rows(views.docs(spark, sf).select("doc_id"), "doc_id")


@query("balance_other", "SELECT doc_id, label_mapped FROM v_other_capped")
def balance_other(spark, sf):
    train = views.labelled(spark, sf).where("split = 'train'").select("doc_id", "label_mapped")
    return sel.balance_other(train, "doc_id", 60)


@query("balance_classes", "SELECT doc_id, label_mapped, full_text, copy, is_augmented FROM v_balanced")
def balance_classes(spark, sf):
    return aggregates.balanced_train(spark, sf).select("doc_id", "label_mapped", "full_text", "copy", "is_augmented")


@query("class_metric_ranking", """
    SELECT label, round(asr, 6) AS asr, round(avg(asr) OVER (), 6) AS mean_asr
    FROM (SELECT label, coalesce(count(*) FILTER (original_pred = label AND adv_pred <> label)
                 / nullif(count(*) FILTER (original_pred = label), 0), 0) AS asr FROM v_predictions GROUP BY label)""")
def class_metric_ranking(spark, sf):
    scores = metrics.class_asr(views.predictions(spark, sf), "label").select("label", "asr")
    return rounded(sel.rank_classes(scores, "asr"))
