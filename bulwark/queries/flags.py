"""Flags, routing and candidate rules (F)."""

from pyspark.sql import functions as F

from bulwark.operators import records
from bulwark.operators import selection as sel
from bulwark.operators import series
from bulwark.queries import views
from bulwark.queries.registry import query


def _row_flag(name):
    @query(name, f"SELECT doc_id, split, {name} FROM v_flagged")
    def run(spark, sf):
        return records.add_row_flags(views.labelled(spark, sf)).select("doc_id", "split", name)


for _name in records.ROW_FLAGS:
    _row_flag(_name)


@query("flag_duplicate", "SELECT doc_id, split, flag_duplicate FROM v_flagged")
def flag_duplicate(spark, sf):
    d = views.labelled(spark, sf).select("doc_id", "split", "full_text")
    return records.mark_copies(d, "doc_id").select("doc_id", "split", "flag_duplicate")


@query("is_anomaly", """
    SELECT doc_id, flag_short_text, flag_long_text, flag_null_mention, flag_other_tiny, flag_duplicate, is_anomaly
    FROM v_routed""")
def is_anomaly(spark, sf):
    known = records.facts(views.labelled(spark, sf), "doc_id")
    return records.annotate_facts(known, "doc_id").select("doc_id", *records.FLAGS, "is_anomaly")


@query("route_severe", "SELECT doc_id, split, route FROM v_routed")
def route_severe(spark, sf):
    return records.route(records.add_row_flags(views.labelled(spark, sf))).select("doc_id", "split", "route")


@query("low_confidence_filter", """
    SELECT vec_id, label, (list_position(probs, list_max(probs)) - 1)::INTEGER AS prediction,
           round(list_max(probs), 6) AS confidence, round(entropy, 6) AS entropy
    FROM v_scored WHERE list_max(probs) < 0.3""")
def low_confidence_filter(spark, sf):
    return sel.low_confidence(views.probs(spark, sf), 0.3).select(
        "vec_id", "label", "prediction", F.round("confidence", 6).alias("confidence"),
        F.round("entropy", 6).alias("entropy"))


@query("candidate_rule", """
    SELECT vec_id, attack, adv_pred, round(adv_confidence, 6) AS adv_confidence,
           concat(attack, CASE WHEN original_pred = label AND adv_pred <> label
                               THEN '_misclassification' ELSE '_low_confidence' END) AS detection_method
    FROM v_attacks
    WHERE (original_pred = label AND adv_pred <> label) OR adv_confidence < 0.7
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY attack_order) = 1""")
def candidate_rule(spark, sf):
    return sel.candidates(views.attacks(spark, sf), "vec_id").select(
        "vec_id", "attack", "adv_pred", F.round("adv_confidence", 6).alias("adv_confidence"), "detection_method")


@query("exclude_baseline_iter", """
    SELECT seed, strategy, iteration, n_labeled_samples FROM v_timeline t
    WHERE n_labeled_samples > 0
       OR (iteration = (SELECT max(iteration) FROM v_timeline x WHERE x.seed = t.seed AND x.strategy = t.strategy)
           AND NOT EXISTS (SELECT 1 FROM v_timeline x WHERE x.seed = t.seed AND x.strategy = t.strategy
                           AND x.n_labeled_samples > 0))""")
def exclude_baseline_iter(spark, sf):
    return series.exclude_baseline(views.timeline(spark, sf), ["seed", "strategy"]).select(
        "seed", "strategy", "iteration", "n_labeled_samples")
