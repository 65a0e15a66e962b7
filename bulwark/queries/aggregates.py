"""Aggregations (A)."""

from pyspark.sql import functions as F

from bulwark.functions import vectors
from bulwark.operators import metrics, ranges, records
from bulwark.operators import selection as sel
from bulwark.queries import views
from bulwark.queries.common import rounded
from bulwark.queries.registry import query
from bulwark.queries.views import table


@query("word_count_profile", """
    SELECT round(avg(word_count), 6) AS mean_wc, round(stddev_samp(word_count), 6) AS std_wc,
           quantile_disc(word_count, 0.05) AS p5_wc, quantile_disc(word_count, 0.95) AS p95_wc
    FROM v_labelled WHERE split = 'train'""")
def word_count_profile(spark, sf):
    return rounded(records.word_count_profile(views.labelled(spark, sf).where("split = 'train'")))


@query("sigma_thresholds", """
    SELECT greatest(3, trunc(mean_wc - 3 * std_wc)::INTEGER) AS short_threshold,
           trunc(mean_wc + 3 * std_wc)::INTEGER AS long_threshold FROM v_stats""")
def sigma_thresholds(spark, sf):
    return records.sigma_thresholds(views.labelled(spark, sf).where("split = 'train'"))


@query("label_distribution", "SELECT label_mapped, count(*) AS n FROM v_labelled GROUP BY 1")
def label_distribution(spark, sf):
    return records.label_distribution(views.labelled(spark, sf))


REPORT_SQL = """
    SELECT split, count(*) AS total,
           sum(flag_short_text::INTEGER)::BIGINT AS flag_short_text, sum(flag_long_text::INTEGER)::BIGINT AS flag_long_text,
           sum(flag_null_mention::INTEGER)::BIGINT AS flag_null_mention, sum(flag_other_tiny::INTEGER)::BIGINT AS flag_other_tiny,
           sum(flag_duplicate::INTEGER)::BIGINT AS flag_duplicate, sum(is_anomaly::INTEGER)::BIGINT AS anomalies,
           sum((route = 'quarantine')::INTEGER)::BIGINT AS quarantined,
           count(DISTINCT CASE WHEN route = 'clean' THEN full_text END) AS kept
    FROM v_routed GROUP BY split"""


@query("guard_report", REPORT_SQL)
def guard_report(spark, sf):
    """The flagship: per split what came in, was flagged, quarantined and kept."""
    return records.guard_counts(views.labelled(spark, sf))


@query("anomaly_summary", f"""
    SELECT split, total, anomalies, total - anomalies AS clean, round(anomalies * 100.0::DOUBLE / total, 6) AS anomaly_pct
    FROM ({REPORT_SQL})""")
def anomaly_summary(spark, sf):
    return rounded(records.anomaly_summary(records.guard_counts(views.labelled(spark, sf))))


@query("flag_breakdown", f"""
    SELECT split, flag, n FROM (UNPIVOT ({REPORT_SQL})
        ON flag_short_text, flag_long_text, flag_null_mention, flag_other_tiny, flag_duplicate
        INTO NAME flag VALUE n) WHERE n > 0""")
def flag_breakdown(spark, sf):
    return records.flag_breakdown(records.guard_counts(views.labelled(spark, sf)))


@query("adaptation_report", f"""
    SELECT split, total AS "before", quarantined, kept AS "after",
           round((total - kept) * 100.0::DOUBLE / total, 6) AS reduction_pct FROM ({REPORT_SQL})""")
def adaptation_report(spark, sf):
    return rounded(records.adaptation_report(records.guard_counts(views.labelled(spark, sf))))


STATS_SQL = """
    WITH s AS (SELECT split, count(*) AS total_records, round(avg(word_count), 2) AS word_count_mean,
                      round(stddev_samp(word_count), 2) AS word_count_std, min(word_count) AS word_count_min,
                      max(word_count) AS word_count_max FROM v_kept GROUP BY split),
         l AS (SELECT split, string_agg(x, ',' ORDER BY x) AS label_distribution
               FROM (SELECT split, concat(label_mapped, '=', count(*)) AS x FROM v_kept GROUP BY split, label_mapped)
               GROUP BY split)
    SELECT * FROM s JOIN l USING (split)"""


@query("split_stats", STATS_SQL)
def split_stats(spark, sf):
    flagged = records.add_row_flags(views.labelled(spark, sf))
    return records.split_stats(records.survivors(flagged, "doc_id", ["label_mapped", "word_count"]))


ROBUSTNESS_SQL = """
    SELECT clean_accuracy, accuracy_under_attack, accuracy_after_defense,
           round((clean_accuracy - accuracy_under_attack) * 100, 2) AS accuracy_drop_pct,
           round((accuracy_after_defense - accuracy_under_attack) * 100, 2) AS accuracy_recovery_pct,
           round((clean_accuracy - accuracy_under_attack) / greatest(clean_accuracy, 1e-6), 4) AS relative_accuracy_drop
    FROM (SELECT round(avg((original_pred = label)::INTEGER), 4) AS clean_accuracy,
                 round(avg((adv_pred = label)::INTEGER), 4) AS accuracy_under_attack,
                 round(avg((defended_pred = label)::INTEGER), 4) AS accuracy_after_defense FROM v_predictions)"""


def three_runs(spark, sf):
    def accuracy(c):
        return F.round(F.avg((F.col(c) == F.col("label")).cast("int")), 4)

    return views.predictions(spark, sf).agg(
        accuracy("original_pred").alias("clean_accuracy"), accuracy("adv_pred").alias("accuracy_under_attack"),
        accuracy("defended_pred").alias("accuracy_after_defense"))


@query("robustness_summary", ROBUSTNESS_SQL)
def robustness_summary(spark, sf):
    return metrics.robustness_summary(three_runs(spark, sf))


@query("audit_rollup", f"""
    WITH r AS ({REPORT_SQL}), b AS ({ROBUSTNESS_SQL})
    SELECT 'ingestion' AS stage, 'total_records' AS key, sum(total)::DOUBLE AS value FROM r
    UNION ALL SELECT 'ingestion', 'splits_loaded', count(*)::DOUBLE FROM r
    UNION ALL SELECT 'etl', split || '.records', kept::DOUBLE FROM r
    UNION ALL SELECT 'etl', 'avg_word_count_train', round(avg(word_count), 2) FROM v_kept WHERE split = 'train'
    UNION ALL SELECT 'detection', 'short_threshold', greatest(3, trunc(mean_wc - 3 * std_wc)::INTEGER)::DOUBLE FROM v_stats
    UNION ALL SELECT 'detection', 'long_threshold', trunc(mean_wc + 3 * std_wc)::INTEGER::DOUBLE FROM v_stats
    UNION ALL SELECT 'detection', split || '.anomalies', anomalies::DOUBLE FROM r
    UNION ALL SELECT 'detection', split || '.clean', (total - anomalies)::DOUBLE FROM r
    UNION ALL SELECT 'ml_analytics', key, value FROM (UNPIVOT (SELECT clean_accuracy, accuracy_under_attack,
              accuracy_after_defense, accuracy_drop_pct, accuracy_recovery_pct FROM b)
              ON clean_accuracy, accuracy_under_attack, accuracy_after_defense, accuracy_drop_pct, accuracy_recovery_pct
              INTO NAME key VALUE value)""")
def audit_rollup(spark, sf):
    d = views.labelled(spark, sf)
    train = d.where("split = 'train'")
    kept = records.survivors(records.add_row_flags(d), "doc_id", ["word_count"]).where("split = 'train'")
    return metrics.audit_rollup(
        records.guard_counts(d), records.sigma_thresholds(train),
        kept.agg(F.round(F.avg("word_count"), 2).alias("avg_word_count_train")),
        metrics.robustness_summary(three_runs(spark, sf)))


@query("text_length_stats", """
    SELECT count(*) AS total_samples, count(DISTINCT label_mapped) AS unique_labels,
           round(avg(char_count), 6) AS avg_text_length, max(char_count) AS max_text_length,
           min(char_count) AS min_text_length, round(stddev_samp(char_count), 6) AS std_text_length FROM v_labelled""")
def text_length_stats(spark, sf):
    return rounded(metrics.text_length_stats(views.labelled(spark, sf)))


def plain_copy(text, row_id, copy, seed):
    """Augmentation that copies, so that SQL can state the filled table."""
    return text


def balanced_train(spark, sf):
    train = views.labelled(spark, sf).where("split = 'train'").select("doc_id", "label_mapped", "full_text")
    return sel.balance_classes(train, "doc_id", at_least=50, at_most=100, augment=plain_copy)


U_CAP = views.u_sql("doc_id", "'cap'")
U_FILL = views.u_sql("label_mapped", "'fill-' || copy")
views.SQL["v_balanced"] = f"""
    WITH t AS (SELECT doc_id, label_mapped, full_text, count(*) OVER (PARTITION BY label_mapped) AS size,
                      row_number() OVER (PARTITION BY label_mapped ORDER BY {U_CAP}, doc_id) AS k
               FROM v_labelled WHERE split = 'train'),
         c AS (SELECT label_mapped, size, unnest(range(1, 50 - size + 1)) AS copy
               FROM (SELECT DISTINCT label_mapped, size FROM t WHERE size < 50)),
         f AS (SELECT label_mapped, copy, floor({U_FILL} * size)::BIGINT + 1 AS k FROM c)
    SELECT doc_id, label_mapped, full_text, 0 AS copy, FALSE AS is_augmented FROM t WHERE k <= 100
    UNION ALL SELECT doc_id, label_mapped, full_text, copy::INTEGER, TRUE FROM f JOIN t USING (label_mapped, k)"""
U_OTHER = views.u_sql("doc_id", "'other'")
views.SQL["v_other_capped"] = f"""
    SELECT doc_id, label_mapped, full_text FROM v_labelled WHERE split = 'train' AND label_mapped <> 'OTHER'
    UNION ALL (SELECT doc_id, label_mapped, full_text FROM v_labelled WHERE split = 'train' AND label_mapped = 'OTHER'
               ORDER BY {U_OTHER}, doc_id LIMIT 60)"""


@query("augmented_share", """
    SELECT count(*) FILTER (is_augmented) AS augmented_samples, count(*) FILTER (NOT is_augmented) AS original_samples
    FROM v_balanced""")
def augmented_share(spark, sf):
    return metrics.augmented_share(balanced_train(spark, sf))


_DISPERSION = """SELECT '{0}' AS name, sum(n)::BIGINT AS samples, round(stddev_samp(n), 6) AS class_std,
    round(sum(chars) / sum(n), 6) AS avg_length
    FROM (SELECT label_mapped, count(*) AS n, sum(length(full_text)) AS chars FROM {1} GROUP BY 1)"""


@query("balance_dispersion", f"""
    {_DISPERSION.format('original', 'v_other_capped')} UNION ALL {_DISPERSION.format('enhanced', 'v_balanced')}""")
def balance_dispersion(spark, sf):
    train = views.labelled(spark, sf).where("split = 'train'").select("doc_id", "label_mapped", "full_text")
    return rounded(metrics.balance_dispersion({
        "original": sel.balance_other(train, "doc_id", 60), "enhanced": balanced_train(spark, sf)}))


_WORDS = r"len(list_filter(regexp_split_to_array(full_text, '[\s\x0B\x1C-\x1F\x85\p{Z}]+'), lambda w: w <> ''))"


@query("dataset_table", rf"""
    SELECT coalesce(split, 'total') AS split, count(*) AS n,
           round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM v_labelled), 6) AS pct,
           count(DISTINCT label_mapped) AS classes, round(avg({_WORDS}), 6) AS mean_words
    FROM v_labelled GROUP BY ROLLUP (split)""")
def dataset_table(spark, sf):
    return rounded(metrics.dataset_table(views.labelled(spark, sf)))


@query("class_weights", """
    SELECT c.c::INTEGER AS class, round(coalesce((SELECT count(*) FROM embeddings)
             / ((SELECT count(DISTINCT label) FROM embeddings) * n), 1.0), 6)::DOUBLE AS weight
    FROM range(12) c(c) LEFT JOIN (SELECT label, count(*)::DOUBLE AS n FROM embeddings GROUP BY 1) x ON x.label = c.c""")
def class_weights(spark, sf):
    """Two of the twelve classes have no rows."""
    return rounded(metrics.class_weights(table(spark, sf, "embeddings"), "label", 12))


def _matrix(spark, sf):
    return metrics.confusion_matrix(views.predictions(spark, sf), "label", "adv_pred")


@query("confusion_matrix", "SELECT label, prediction, n FROM v_confusion")
def confusion_matrix(spark, sf):
    return _matrix(spark, sf)


@query("confusion_normalized", """
    SELECT label, prediction, round(coalesce(n / nullif(sum(n) OVER (PARTITION BY label), 0), 0), 6)::DOUBLE AS share
    FROM v_confusion""")
def confusion_normalized(spark, sf):
    return rounded(metrics.confusion_normalized(_matrix(spark, sf)))


@query("per_class_counts", """
    SELECT label, tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, tn::BIGINT AS tn,
           round(precision, 6) AS precision, round(recall, 6) AS recall, round(specificity, 6) AS specificity
    FROM v_class_scores""")
def per_class_counts(spark, sf):
    return rounded(metrics.per_class_scores(_matrix(spark, sf)).drop("f1", "support"))


@query("classification_metrics", """
    WITH s AS (SELECT sum(tp) / sum(support) AS accuracy, avg(CASE WHEN support > 0 THEN recall END) AS balanced_accuracy,
                      avg(f1) AS f1_macro, sum(f1 * support) / sum(support) AS f1_weighted,
                      2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)) AS f1_micro,
                      avg(precision) AS precision_macro, sum(precision * support) / sum(support) AS precision_weighted,
                      avg(recall) AS recall_macro, sum(recall * support) / sum(support) AS recall_weighted
               FROM v_class_scores)
    SELECT metric, round(value, 6) AS value FROM (UNPIVOT s ON COLUMNS(*) INTO NAME metric VALUE value)
    UNION ALL SELECT concat('f1_', label), round(f1, 6) FROM v_class_scores""")
def classification_metrics(spark, sf):
    return rounded(metrics.classification_metrics(views.predictions(spark, sf), "label", "adv_pred"))


@query("classification_report", """
    SELECT label::VARCHAR AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
           round(f1, 6) AS f1_score, support::BIGINT AS support FROM v_class_scores
    UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
                     round(sum(tp) / sum(support), 6), sum(support)::BIGINT FROM v_class_scores
    UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
                     sum(support)::BIGINT FROM v_class_scores
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                     round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
                     sum(support)::BIGINT FROM v_class_scores""")
def classification_report(spark, sf):
    return rounded(metrics.classification_report(views.predictions(spark, sf), "label", "adv_pred"))


_OUTCOMES = """count(*) AS n_samples, count(*) FILTER (original_pred = label) AS n_originally_correct,
    count(*) FILTER (adv_pred = label) AS n_robust_correct,
    count(*) FILTER (original_pred = label AND adv_pred <> label) AS n_successful_attacks,
    count(*) FILTER (original_pred <> adv_pred) AS n_changed"""
_ATTACK = """n_samples, n_originally_correct, n_robust_correct, n_successful_attacks,
    round(n_originally_correct / n_samples, 6) AS clean_accuracy, round(n_robust_correct / n_samples, 6) AS robust_accuracy,
    round(coalesce(n_successful_attacks / nullif(n_originally_correct, 0), 0), 6) AS attack_success_rate,
    round((n_originally_correct - n_robust_correct) / n_samples, 6) AS robustness_gap"""


@query("robustness_metrics", f"""
    SELECT round(n_originally_correct / n_samples, 6) AS clean_accuracy,
           round(n_robust_correct / n_samples, 6) AS robust_accuracy,
           round(coalesce(n_successful_attacks / nullif(n_originally_correct, 0), 0), 6) AS attack_success_rate,
           round(1 - n_changed / n_samples, 6) AS prediction_stability,
           round((n_originally_correct - n_robust_correct) / n_samples, 6) AS accuracy_drop,
           round(coalesce((n_originally_correct - n_robust_correct) / nullif(n_originally_correct, 0), 0), 6)
             AS relative_accuracy_drop,
           n_samples, n_originally_correct, n_successful_attacks
    FROM (SELECT {_OUTCOMES} FROM v_predictions)""")
def robustness_metrics(spark, sf):
    return rounded(metrics.robustness_metrics(views.predictions(spark, sf)))


@query("attack_metrics", f"SELECT {_ATTACK} FROM (SELECT {_OUTCOMES} FROM v_predictions)")
def attack_metrics(spark, sf):
    return rounded(metrics.attack_metrics(views.predictions(spark, sf)))


@query("attack_comparison", f"SELECT attack, {_ATTACK} FROM (SELECT attack, {_OUTCOMES} FROM v_attacks GROUP BY attack)")
def attack_comparison(spark, sf):
    return rounded(metrics.attack_metrics(views.attacks(spark, sf), ("attack",)))


@query("per_class_asr", """
    SELECT *, round(coalesce(attacks_successful / nullif(originally_correct, 0), 0), 6) AS asr
    FROM (SELECT concat('class-', label) AS label_name, count(*) AS total,
                 count(*) FILTER (original_pred = label) AS originally_correct,
                 count(*) FILTER (adv_pred = label) AS still_correct,
                 count(*) FILTER (original_pred = label AND adv_pred <> label) AS attacks_successful
          FROM v_predictions GROUP BY 1)""")
def per_class_asr(spark, sf):
    p = views.predictions(spark, sf).withColumn("label_name", F.concat(F.lit("class-"), F.col("label").cast("string")))
    return rounded(metrics.class_asr(p))


@query("flagged_by_method", """
    WITH c AS (SELECT vec_id, attack FROM v_attacks
               WHERE (original_pred = label AND adv_pred <> label) OR adv_confidence < 0.7
               QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY attack_order) = 1)
    SELECT coalesce(attack, 'total_flagged') AS method, count(*) AS n FROM c GROUP BY ROLLUP (attack)
    UNION ALL SELECT 'total_scanned', count(DISTINCT vec_id) FROM v_attacks""")
def flagged_by_method(spark, sf):
    a = views.attacks(spark, sf)
    return metrics.flagged_by_method(views.predictions(spark, sf), sel.candidates(a, "vec_id"))


@query("entropy_stats", """
    SELECT count(*) AS n_candidates, round(avg(entropy), 6) AS entropy_mean, round(stddev_pop(entropy), 6) AS entropy_std,
           round(median(entropy), 6) AS entropy_median, round(min(entropy), 6) AS entropy_min,
           round(max(entropy), 6) AS entropy_max, round(avg(margin), 6) AS margin_mean,
           round(stddev_pop(margin), 6) AS margin_std FROM v_scored""")
def entropy_stats(spark, sf):
    s = views.scored(spark, sf)
    return rounded(metrics.entropy_stats(s, ranges.exact_quantile(s, "entropy", 0.5)))


@query("selection_log", """
    WITH s AS (SELECT *, row_number() OVER (ORDER BY entropy DESC, vec_id) AS rank FROM v_scored
               QUALIFY rank <= 50),
         w AS (SELECT rank, concat_ws('; ',
                 concat(CASE WHEN entropy > 1.5 THEN 'Very high' WHEN entropy > 1.0 THEN 'High' ELSE 'Moderate' END,
                        ' uncertainty (entropy=', printf('%.3f', entropy), ')'),
                 CASE WHEN margin < 0.1 THEN 'nearly equal top-2 class probabilities'
                      WHEN margin < 0.3 THEN 'small margin between top predictions' END,
                 concat('low model confidence (', printf('%.3f', list_max(probs)), ')')) AS why FROM s WHERE rank <= 5)
    SELECT 'entropy' AS strategy, 50 AS budget, (SELECT count(*) FROM v_scored) AS pool_size, count(*) AS n_selected,
           round(avg(entropy), 6) AS entropy_mean, round(stddev_pop(entropy), 6) AS entropy_std,
           round(min(entropy), 6) AS entropy_min, round(max(entropy), 6) AS entropy_max,
           (SELECT string_agg(why, ' | ' ORDER BY rank) FROM w) AS top_explanations FROM s""")
def selection_log(spark, sf):
    pool = views.scored(spark, sf)
    chosen = sel.select_top_b(pool, "vec_id", "entropy", 50)
    return rounded(metrics.selection_log(
        chosen, pool, "entropy", 50, F.lit("natural_low_confidence"), F.lit("none"), vectors.confidence(F.col("probs"))))


@query("iteration_summary", """
    SELECT e.*, m.robust_accuracy
    FROM (SELECT iteration, event_type, count(*) AS n, (sum(count(*)) OVER (PARTITION BY iteration))::BIGINT AS n_events
          FROM v_events GROUP BY iteration, event_type) e
    LEFT JOIN (SELECT iteration, round(avg(robust_accuracy), 6) AS robust_accuracy FROM v_timeline GROUP BY iteration) m
    USING (iteration)""")
def iteration_summary(spark, sf):
    m = views.timeline(spark, sf).groupBy("iteration").agg(F.round(F.avg("robust_accuracy"), 6).alias("robust_accuracy"))
    return metrics.iteration_summary(views.audit_events(spark, sf), m)


@query("seed_aggregate", """
    SELECT model, method, metric, round(avg(value), 6) AS value_mean, round(stddev_pop(value), 6) AS value_std
    FROM v_seed_metrics GROUP BY ALL""")
def seed_aggregate(spark, sf):
    return rounded(metrics.seed_aggregate(views.seed_metrics(spark, sf)))


@query("budget_ablation", """
    SELECT budget, round(avg(total_samples), 6) AS total_samples, round(avg(robust_accuracy), 6) AS robust_accuracy,
           round(avg(attack_success_rate), 6) AS attack_success_rate
    FROM (SELECT [10, 20, 50, 100][iteration % 4 + 1]::INTEGER AS budget, iteration, robust_accuracy, attack_success_rate,
                 [10, 20, 50, 100][iteration % 4 + 1] * iteration AS total_samples FROM v_timeline) GROUP BY budget""")
def budget_ablation(spark, sf):
    """Iterations stand for runs with four budgets."""
    budget = F.get(F.array(*map(F.lit, (10, 20, 50, 100))), F.pmod("iteration", F.lit(4)))
    runs = views.timeline(spark, sf).withColumn("budget", budget).withColumn(
        "total_samples", F.col("budget") * F.col("iteration"))
    return rounded(metrics.budget_ablation(runs))


@query("length_histogram", """
    WITH s AS (SELECT min(length(full_text))::DOUBLE AS lo, max(length(full_text))::DOUBLE AS hi,
                      avg(length(full_text)) AS mean, median(length(full_text)) AS med FROM v_docs)
    SELECT least(floor((length(full_text) - lo) / (hi - lo) * 50), 49)::INTEGER AS bin, count(*) AS n,
           round(any_value(mean), 6) AS mean_length, any_value(med) AS median_length
    FROM v_docs, s GROUP BY 1""")
def length_histogram(spark, sf):
    return rounded(ranges.length_histogram(views.docs(spark, sf)))


@query("length_by_class", """
    WITH top AS (SELECT label_mapped FROM v_labelled GROUP BY 1 ORDER BY count(*) DESC, label_mapped LIMIT 10)
    SELECT label_mapped, count(*) AS n, min(char_count)::DOUBLE AS min_length,
           quantile_cont(char_count, 0.25) AS q1_length, quantile_cont(char_count, 0.5) AS median_length,
           quantile_cont(char_count, 0.75) AS q3_length, max(char_count)::DOUBLE AS max_length
    FROM v_labelled WHERE label_mapped IN (SELECT label_mapped FROM top) GROUP BY 1""")
def length_by_class(spark, sf):
    return ranges.length_by_class(views.labelled(spark, sf))


@query("confidence_histogram", """
    WITH x AS (SELECT list_max(probs) AS x,
                      CASE WHEN list_position(probs, list_max(probs)) - 1 = label THEN 'correct' ELSE 'incorrect' END AS c
               FROM v_probs),
         g AS (SELECT x, 'all' AS grp FROM x UNION ALL SELECT x, c FROM x),
         b AS (SELECT *, min(x) OVER (PARTITION BY grp) AS lo, max(x) OVER (PARTITION BY grp) AS hi,
                      CASE WHEN grp = 'all' THEN 50 ELSE 30 END AS bins FROM g)
    SELECT grp, coalesce(least(floor((x - lo) / nullif(hi - lo, 0) * bins), bins - 1), bins // 2)::INTEGER AS bin,
           count(*) AS n FROM b GROUP BY 1, 2""")
def confidence_histogram(spark, sf):
    return ranges.confidence_histogram(views.probs(spark, sf))


@query("metrics_pivot", """
    SELECT metric,
           coalesce(max(printf('%.4f', value)) FILTER (method = 'entropy'), 'N/A') AS entropy,
           coalesce(max(printf('%.4f', value)) FILTER (method = 'margin'), 'N/A') AS margin,
           coalesce(max(printf('%.4f', value)) FILTER (method = 'random'), 'N/A') AS random
    FROM (SELECT method, metric, avg(value) AS value FROM v_seed_metrics GROUP BY 1, 2) GROUP BY metric""")
def metrics_pivot(spark, sf):
    means = views.seed_metrics(spark, sf).groupBy("method", "metric").agg(F.avg("value").alias("value"))
    return metrics.metrics_pivot(means, "method")
