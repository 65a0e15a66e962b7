"""Series over iterations and score thresholds (W)."""

from pyspark.sql import functions as F

from bulwark.operators import ranges, series
from bulwark.operators import selection as sel
from bulwark.queries import views
from bulwark.queries.common import rounded
from bulwark.queries.registry import query

RUN = ["seed", "strategy"]

views.SQL["v_efficiency"] = """
    SELECT *, CASE WHEN step = 1 THEN cumulative ELSE marginal END AS marginal_efficiency FROM (
      SELECT seed, strategy, iteration, robust_accuracy, n_labeled_samples,
             row_number() OVER w - 1 AS step,
             robust_accuracy - first_value(robust_accuracy) OVER w AS delta_robust,
             (robust_accuracy - first_value(robust_accuracy) OVER w) / greatest(n_labeled_samples, 1) AS cumulative,
             (robust_accuracy - lag(robust_accuracy) OVER w)
               / greatest(n_labeled_samples - lag(n_labeled_samples) OVER w, 1) AS marginal
      FROM v_timeline WINDOW w AS (PARTITION BY seed, strategy ORDER BY iteration))
    WHERE step > 0"""
views.SQL["v_run_efficiency"] = """
    SELECT r.seed, r.strategy, r.n_rows, coalesce(label_efficiency, 0) AS label_efficiency,
           coalesce(final_efficiency, 0) AS final_efficiency, coalesce(max_efficiency, 0) AS max_efficiency,
           coalesce(total_delta_robust, 0) AS total_delta_robust, coalesce(total_labeled, 0) AS total_labeled
    FROM (SELECT seed, strategy, count(*) AS n_rows FROM v_timeline GROUP BY 1, 2) r
    LEFT JOIN (SELECT seed, strategy, avg(cumulative) AS label_efficiency, arg_max(cumulative, iteration) AS final_efficiency,
                      max(cumulative) AS max_efficiency, arg_max(delta_robust, iteration) AS total_delta_robust,
                      arg_max(n_labeled_samples, iteration) AS total_labeled
               FROM v_efficiency GROUP BY 1, 2) e USING (seed, strategy)"""


@query("label_efficiency", """
    SELECT seed, strategy, n_rows, round(label_efficiency, 8) AS label_efficiency, round(final_efficiency, 8) AS final_efficiency,
           round(max_efficiency, 8) AS max_efficiency, round(total_delta_robust, 8) AS total_delta_robust, total_labeled
    FROM v_run_efficiency""")
def label_efficiency(spark, sf):
    return rounded(series.label_efficiency(views.timeline(spark, sf), RUN), 8)


@query("marginal_efficiency", """
    SELECT seed, strategy, iteration, step::INTEGER AS step, round(robust_accuracy, 8) AS robust_accuracy, n_labeled_samples,
           round(delta_robust, 8) AS delta_robust, round(cumulative, 8) AS cumulative_efficiency,
           round(marginal_efficiency, 8) AS marginal_efficiency FROM v_efficiency""")
def marginal_efficiency(spark, sf):
    return rounded(series.efficiency(views.timeline(spark, sf), RUN), 8)


@query("strategy_comparison", """
    SELECT seed, strategy, round(f.robust_accuracy, 8) AS final_robust_accuracy, round(f.clean_accuracy, 8) AS final_clean_accuracy,
           round(f.attack_success_rate, 8) AS final_asr, f.n_labeled_samples AS total_labeled,
           round(e.label_efficiency, 8) AS label_efficiency, round(e.total_delta_robust, 8) AS total_delta_robust
    FROM v_final f JOIN v_run_efficiency e USING (seed, strategy) WHERE n_rows >= 2""")
def strategy_comparison(spark, sf):
    return rounded(series.strategy_comparison(views.timeline(spark, sf), RUN), 8)


@query("timeline_deltas", """
    WITH d AS (SELECT *, row_number() OVER w > 1 AND iteration > 0 AS later,
                      robust_accuracy - first_value(round(robust_accuracy, 4)) OVER w AS delta
               FROM v_timeline WINDOW w AS (PARTITION BY seed, strategy ORDER BY iteration))
    SELECT seed, strategy, iteration, round(clean_accuracy, 4) AS clean_accuracy, round(robust_accuracy, 4) AS robust_accuracy,
           round(attack_success_rate, 4) AS attack_success_rate, n_labeled_samples,
           CASE WHEN later THEN CASE WHEN n_labeled_samples > 0 THEN round(delta / n_labeled_samples, 6) ELSE 0 END END
             AS label_efficiency,
           CASE WHEN later THEN round(delta, 4) END AS delta_robust_accuracy FROM d""")
def timeline_deltas(spark, sf):
    return series.timeline_deltas(views.timeline(spark, sf), RUN)


@query("selection_rank", """
    SELECT vec_id, round(entropy, 6) AS entropy, row_number() OVER (ORDER BY entropy DESC, vec_id)::INTEGER AS rank
    FROM (SELECT * FROM v_scored ORDER BY entropy DESC, vec_id LIMIT 50)""")
def selection_rank(spark, sf):
    return rounded(sel.select_top_b(views.scored(spark, sf), "vec_id", "entropy", 50).select("vec_id", "entropy", "rank"))


_RUN_ROWS = "seed, strategy, iteration, round(robust_accuracy, 8) AS robust_accuracy, n_labeled_samples"


@query("best_iteration", f"""
    SELECT {_RUN_ROWS} FROM v_timeline
    WHERE n_labeled_samples > 0 OR (seed, strategy) NOT IN (SELECT (seed, strategy) FROM v_timeline WHERE n_labeled_samples > 0)
    QUALIFY row_number() OVER (PARTITION BY seed, strategy ORDER BY t.robust_accuracy DESC, iteration) = 1"""
       .replace("FROM v_timeline\n    WHERE n", "FROM v_timeline t\n    WHERE n", 1))
def best_iteration(spark, sf):
    return rounded(series.best_iteration(views.timeline(spark, sf), RUN).select(
        "seed", "strategy", "iteration", "robust_accuracy", "n_labeled_samples"), 8)


@query("best_model_per_metric", """
    WITH m AS (SELECT strategy, avg(clean_accuracy) AS c, avg(robust_accuracy) AS r, avg(attack_success_rate) AS a
               FROM v_final GROUP BY 1)
    SELECT 'clean_accuracy' AS metric, (SELECT strategy FROM m ORDER BY c DESC, strategy LIMIT 1) AS best
    UNION ALL SELECT 'robust_accuracy', (SELECT strategy FROM m ORDER BY r DESC, strategy LIMIT 1)
    UNION ALL SELECT 'attack_success_rate', (SELECT strategy FROM m ORDER BY a, strategy LIMIT 1)""")
def best_model_per_metric(spark, sf):
    last = series.final_iteration(views.timeline(spark, sf), RUN)
    means = last.groupBy("strategy").agg(
        *[F.avg(c).alias(c) for c in ("clean_accuracy", "robust_accuracy", "attack_success_rate")])
    return series.best_per_metric(means, "strategy")


@query("final_iteration", f"SELECT {_RUN_ROWS} FROM v_final")
def final_iteration(spark, sf):
    return rounded(series.final_iteration(views.timeline(spark, sf), RUN).select(
        "seed", "strategy", "iteration", "robust_accuracy", "n_labeled_samples"), 8)


@query("drift_alert", """
    SELECT seed, strategy, iteration, round(delta, 8) AS delta_robust, delta < -0.02 AND iteration > 1 AS drift_alert
    FROM (SELECT seed, strategy, iteration, robust_accuracy - lag(robust_accuracy, 1, 0.0)
                 OVER (PARTITION BY seed, strategy ORDER BY iteration) AS delta FROM v_timeline WHERE iteration >= 1)""")
def drift_alert(spark, sf):
    return rounded(series.drift_alerts(views.timeline(spark, sf), RUN).select(
        "seed", "strategy", "iteration", "delta_robust", "drift_alert"), 8)


@query("relative_efficiency", """
    WITH m AS (SELECT strategy, avg(f.robust_accuracy) AS r, avg(total_delta_robust) AS d, avg(final_efficiency) AS e
               FROM v_run_efficiency JOIN v_final f USING (seed, strategy) WHERE n_rows >= 2 GROUP BY strategy)
    SELECT strategy, round(r, 8) AS robust_accuracy, round(d, 8) AS delta_from_baseline, round(e, 8) AS mean_efficiency,
           round(e / greatest(abs(coalesce((SELECT e FROM m WHERE strategy = 'random'), 1e-10)), 1e-10), 6)
             AS relative_efficiency FROM m""")
def relative_efficiency(spark, sf):
    r = series.relative_efficiency(views.timeline(spark, sf))
    return r.select("strategy", *[F.round(c, 8).alias(c) for c in ("robust_accuracy", "delta_from_baseline", "mean_efficiency")],
                    F.round("relative_efficiency", 6).alias("relative_efficiency"))


@query("adaptive_schedule", """
    WITH RECURSIVE t AS (SELECT *, row_number() OVER (PARTITION BY seed, strategy ORDER BY iteration) AS k
               FROM v_timeline WHERE iteration >= 1),
         s AS (
           SELECT DISTINCT seed, strategy, 0::BIGINT AS k, 0 AS iteration, 50 AS budget, 0.7::DOUBLE AS tau,
                  0.0::DOUBLE AS prev, 0.0::DOUBLE AS delta FROM t
           UNION ALL
           SELECT seed, strategy, k, iteration,
                  CASE WHEN alert THEN 100 WHEN delta > 0.01 THEN greatest(10, budget - 10) ELSE least(100, budget + 10) END,
                  CASE WHEN alert THEN greatest(0.3, tau - 0.1) ELSE tau END, prev, delta
           FROM (SELECT t.seed, t.strategy, t.k, t.iteration, s.budget, t.robust_accuracy AS prev,
                        t.robust_accuracy - s.prev AS delta,
                        greatest(0.1, least(0.95, s.tau - 0.1 * (t.attack_success_rate - 0.3))) AS tau,
                        t.robust_accuracy - s.prev < -0.02 AND t.iteration > 1 AS alert
                 FROM s JOIN t ON t.seed = s.seed AND t.strategy = s.strategy AND t.k = s.k + 1))
    SELECT seed, strategy, iteration, budget, round(tau, 8) AS tau, round(delta, 8) AS delta_robust FROM s WHERE k > 0""")
def adaptive_schedule(spark, sf):
    return rounded(series.adaptive_schedule(views.timeline(spark, sf), RUN), 8)


@query("early_stop_epoch", """
    WITH e AS (SELECT seed, strategy, iteration AS epoch, robust_accuracy AS f1,
                      row_number() OVER w AS k,
                      robust_accuracy > coalesce(max(robust_accuracy) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                        AS is_new
               FROM v_timeline WINDOW w AS (PARTITION BY seed, strategy ORDER BY iteration)),
         b AS (SELECT *, coalesce(max(CASE WHEN is_new THEN k END) OVER (PARTITION BY seed, strategy ORDER BY epoch), 0) AS best_k
               FROM e),
         s AS (SELECT *, min(CASE WHEN k - best_k >= 5 THEN epoch END) OVER (PARTITION BY seed, strategy) AS stop_epoch FROM b)
    SELECT seed, strategy, stop_epoch, max(CASE WHEN is_new THEN epoch END) AS best_epoch,
           round(max(CASE WHEN is_new THEN f1 END), 8) AS best_score, max(epoch) AS last_epoch
    FROM s WHERE stop_epoch IS NULL OR epoch <= stop_epoch GROUP BY seed, strategy, stop_epoch""")
def early_stop_epoch(spark, sf):
    """Robust accuracy per iteration stands for the dev F1 per epoch."""
    e = views.timeline(spark, sf).select("seed", "strategy", F.col("iteration").alias("epoch"),
                                         F.col("robust_accuracy").alias("dev_f1"))
    return rounded(series.early_stop(e, RUN), 8)


views.SQL["v_roc"] = """
    SELECT class, score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
           sum(pos) OVER (PARTITION BY class) AS p, sum(neg) OVER (PARTITION BY class) AS n
    FROM (SELECT class, score, count(*) FILTER (label = class) AS pos, count(*) FILTER (label <> class) AS neg
          FROM (SELECT label, unnest(probs) AS score, (generate_subscripts(probs, 1) - 1)::INTEGER AS class FROM v_probs)
          GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY class ORDER BY score DESC)"""


@query("roc_curve", """
    SELECT class, round(score, 6) AS threshold, round(fp / nullif(n, 0), 6) AS fpr, round(tp / nullif(p, 0), 6) AS tpr
    FROM v_roc""")
def roc_curve(spark, sf):
    return rounded(ranges.roc_curve(views.probs(spark, sf)))


@query("roc_auc", """
    WITH c AS (SELECT class, tp / p AS tpr, fp / n AS fpr, score FROM v_roc)
    SELECT class, round(sum((fpr - prev_fpr) * (tpr + prev_tpr) / 2), 6) AS auc
    FROM (SELECT class, tpr, fpr, lag(tpr, 1, 0.0) OVER w AS prev_tpr, lag(fpr, 1, 0.0) OVER w AS prev_fpr
          FROM c WINDOW w AS (PARTITION BY class ORDER BY score DESC)) GROUP BY class""")
def roc_auc(spark, sf):
    return rounded(ranges.roc_auc(views.probs(spark, sf)))
