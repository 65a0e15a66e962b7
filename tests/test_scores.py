"""Scores, metrics, selection, series and quantiles against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from bulwark.functions import vectors
from bulwark.operators import metrics, ranges, records, series
from bulwark.operators import selection as sel


def probs_table(spark, n=200, k=4, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        w = [rnd.random() ** 3 for _ in range(k)]
        s = sum(w)
        rows.append((i, rnd.randrange(k), [x / s for x in w]))
    return rows, spark.createDataFrame(rows, "id long, label int, probs array<double>")


def test_vector_edge_cases(spark):
    df = spark.createDataFrame([([1.0],), ([0.5, 0.5],), ([0.0, 1.0],)], "p array<double>")
    p = F.col("p")
    got = [tuple(r) for r in df.select(
        vectors.prediction(p), vectors.margin(p), F.round(vectors.entropy(p), 6),
        F.round(vectors.true_loss(p, F.lit(0)), 4), vectors.true_loss(p, F.lit(9)), vectors.confidence_flip(p, F.lit(-1)),
    ).collect()]
    assert got[0] == (0, 1.0, 0.0, 0.0, 5.0, 1.0)
    assert got[1][:3] == (0, 0.0, round(math.log(2), 6))
    assert got[2][:2] == (1, 1.0) and got[2][3] == round(-math.log(1e-10), 4)
    big = spark.createDataFrame([([1000.0, 1000.0],)], "l array<double>").select(vectors.softmax(F.col("l")).alias("s")).first()
    assert big["s"] == [0.5, 0.5]


def greedy_centres(rows, budget):
    chosen, dist = [rows[0][0]], {r[0]: math.inf for r in rows}
    by_id = {r[0]: r[2] for r in rows}
    while len(chosen) < min(budget, len(rows)):
        c = by_id[chosen[-1]]
        for i, p in by_id.items():
            dist[i] = min(dist[i], math.sqrt(sum((x - y) * (x - y) for x, y in zip(p, c))))
        chosen.append(max((i for i in by_id if i not in chosen), key=lambda i: (dist[i], -i)))
    return chosen


@pytest.mark.parametrize("batch", [1, 7, 256])
def test_coreset_equals_plain_greedy(spark, batch):
    rows, df = probs_table(spark, 120)
    assert sel.coreset_order(df, "id", 15, batch=batch) == greedy_centres(rows, 15)


def test_coreset_with_copies_and_small_pool(spark):
    rows = [(i, 0, [1.0, 0.0] if i < 5 else [0.0, 1.0]) for i in range(8)]
    df = spark.createDataFrame(rows, "id long, label int, probs array<double>")
    order = sel.coreset_order(df, "id", 20)
    assert len(order) == len(set(order)) == 8 and order[:2] == [0, 5]
    assert sel.coreset_order(df.where("id < 0"), "id", 3) == []


def test_sampling_is_exact_and_layout_free(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7).cast("string").alias("l"))
    a = sorted(r["id"] for r in sel.exact_sample(df, "id", 321).collect())
    b = sorted(r["id"] for r in sel.exact_sample(df.repartition(13), "id", 321).collect())
    assert len(a) == 321 and a == b
    assert sel.exact_sample(df, "id", 9000).count() == 5000
    capped = sel.cap_classes(df, "id", "l", 100).groupBy("l").count().collect()
    assert {r["count"] for r in capped} == {100}


def test_cap_equals_plain_ranking_on_a_hot_class(spark):
    from bulwark.functions.seeded import uniform

    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 40)).alias("l"))
    us = df.select("id", "l", uniform(F.col("id"), "cap").alias("u")).collect()
    want = set()
    for label in {r["l"] for r in us}:
        want |= {r["id"] for r in sorted((r for r in us if r["l"] == label), key=lambda r: (r["u"], r["id"]))[:30]}
    assert {r["id"] for r in sel.cap_classes(df, "id", "l", 30).collect()} == want


def test_shuffle_is_a_permutation(spark):
    got = sel.shuffle_rows(spark.range(1000), "id").collect()
    assert sorted(r["position"] for r in got) == list(range(1, 1001))
    assert [r["id"] for r in sorted(got, key=lambda r: r["position"])] != list(range(1000))


def test_balance_classes_bounds(spark):
    rows = [(i, "big", f"b {i}") for i in range(90)] + [(100 + i, "small", f"s {i}") for i in range(3)] + \
           [(200 + i, "mid", f"m {i}") for i in range(20)]
    df = spark.createDataFrame(rows, "id long, label_mapped string, full_text string")
    out = sel.balance_classes(df, "id", at_least=10, at_most=50)
    n = {r["label_mapped"]: r["count"] for r in out.groupBy("label_mapped").count().collect()}
    assert n == {"big": 50, "small": 10, "mid": 20}
    assert out.where("is_augmented").count() == 7
    assert out.select("id", "copy").distinct().count() == 80


def test_balance_other_keeps_all_other_classes(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 60, "OTHER").when(F.col("id") < 90, "a").alias("label_mapped"))
    n = {r["label_mapped"]: r["count"] for r in sel.balance_other(df, "id", 25).groupBy("label_mapped").count().collect()}
    assert n == {"OTHER": 25, "a": 30, None: 10}


def test_metrics_without_right_answers_or_rows(spark):
    schema = "label int, original_pred int, adv_pred int"
    wrong = metrics.robustness_metrics(spark.createDataFrame([(0, 1, 1), (1, 0, 0)], schema)).first()
    assert wrong["attack_success_rate"] == 0.0 and wrong["relative_accuracy_drop"] == 0.0
    empty = metrics.attack_metrics(spark.createDataFrame([], schema)).first()
    assert (empty["n_samples"], empty["clean_accuracy"], empty["attack_success_rate"]) == (0, 0.0, 0.0)


def test_published_run_figures(spark):
    from bulwark.operators.learning import summarize_runs

    runs = spark.createDataFrame([("LogReg_clean", 0.8225), ("LogReg_clean_vs_adv", 0.8181), ("LogReg_adv_training", 0.8186)],
                                 "model string, accuracy double")
    r = summarize_runs(runs).first()
    assert (r["accuracy_drop_pct"], r["accuracy_recovery_pct"], r["relative_accuracy_drop"]) == (0.44, 0.05, 0.0053)


def test_confusion_grid_has_zero_cells(spark):
    m = metrics.confusion_matrix(spark.createDataFrame([(0, 0), (0, 2)], "label int, prediction int"))
    got = {(r["label"], r["prediction"]): r["n"] for r in m.collect()}
    assert got == {(0, 0): 1, (0, 2): 1, (2, 0): 0, (2, 2): 0}
    s = {r["label"]: r for r in metrics.per_class_scores(m).collect()}
    assert s[2]["recall"] == 0.0 and s[2]["fp"] == 1 and s[2]["tn"] == 1


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantile_at_any_task_size(spark, q):
    rnd = random.Random(3)
    values = [rnd.gauss(0, 1) ** 3 for _ in range(997)] + [0.25] * 500
    df = spark.createDataFrame([(v,) for v in values], "x double")
    plain = df.agg(F.percentile("x", q).alias("v")).first()["v"]
    for size in (20, 10**6):
        got = df.agg(ranges.exact_quantile(df, "x", q, one_task=size).alias("v")).first()["v"]
        assert got == pytest.approx(plain, abs=1e-12)
    assert df.agg(ranges.exact_quantile(df.limit(0), "x", q).alias("v")).first()["v"] is None


def test_nothing_unlisted_is_lost(spark):
    events = spark.createDataFrame([(0, "click"), (0, "login"), (1, "click"), (0, "login")], "iteration int, event_type string")
    m = spark.createDataFrame([(0, 0.5)], "iteration int, robust_accuracy double")
    got = {(r["iteration"], r["event_type"]): (r["n"], r["n_events"], r["robust_accuracy"]) for r in metrics.iteration_summary(events, m).collect()}
    assert got == {(0, "click"): (1, 3, 0.5), (0, "login"): (2, 3, 0.5), (1, "click"): (1, 1, None)}
    wide = metrics.metrics_pivot(spark.createDataFrame([("a", "x", 1.0), ("new", "y", 2.0)], "model string, metric string, value double"))
    assert sorted(map(tuple, wide.select("metric", "a", "new").collect())) == [("x", "1.0000", "N/A"), ("y", "N/A", "2.0000")]
    weights = metrics.class_weights(spark.createDataFrame([(0,), (7,)], "label int"), "label", 3)
    assert {r["class"]: r["weight"] for r in weights.collect()} == {0: 1.0, 1: 1.0, 2: 1.0, 7: 1.0}


def test_null_class_is_capped_like_a_class(spark):
    rows = [(i, None if i % 3 == 0 else "a") for i in range(30)]
    df = spark.createDataFrame(rows, "id long, label string")
    got = sel.cap_classes(df, "id", "label", 4).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in got} == {None: 4, "a": 4}
    assert sel.cap_classes(df, "id", "label", 100).count() == 30


def test_many_classes(spark):
    df = spark.range(100_000).select(F.col("id").cast("int").alias("label"), ((F.col("id") + F.col("id") % 2) % 100_000).cast("int").alias("prediction"))
    scores = metrics.per_class_scores(metrics.confusion_counts(df))
    assert scores.count() == 100_000
    assert metrics.summary_metrics(scores).where("metric = 'accuracy'").first()["value"] == pytest.approx(0.5)
    labels = records.label_dictionary(df.select(F.col("label").cast("string").alias("l")), "l")
    assert labels.count() == 100_000


def test_roc_auc_equals_pair_counting(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.randrange(3), [round(rnd.random(), 1) for _ in range(3)]) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, label int, probs array<double>")
    got = {r["class"]: r["auc"] for r in ranges.roc_auc(df).collect()}
    for c in range(3):
        pos, neg = [r[2][c] for r in rows if r[1] == c], [r[2][c] for r in rows if r[1] != c]
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert got[c] == pytest.approx(wins / (len(pos) * len(neg)))
    last = ranges.roc_curve(df).where("class = 0").orderBy("threshold").first()
    assert (last["fpr"], last["tpr"]) == (1.0, 1.0)


def timeline(spark, robust, labelled=None):
    rows = [("r", i, 0.9, x, 0.2, (50 * i if labelled is None else labelled[i])) for i, x in enumerate(robust)]
    return spark.createDataFrame(rows, "run string, iteration int, clean_accuracy double, robust_accuracy double, "
                                       "attack_success_rate double, n_labeled_samples long")


def test_series_of_few_rows(spark):
    assert series.label_efficiency(timeline(spark, []), ["run"]).count() == 0
    one = series.label_efficiency(timeline(spark, [0.5]), ["run"]).first()
    assert (one["n_rows"], one["label_efficiency"], one["total_labeled"]) == (1, 0.0, 0)
    two = series.label_efficiency(timeline(spark, [0.5, 0.6]), ["run"]).first()
    assert two["label_efficiency"] == pytest.approx(0.1 / 50)
    assert series.best_iteration(timeline(spark, [0.9, 0.6, 0.7, 0.7]), ["run"]).first()["iteration"] == 2
    assert series.best_iteration(timeline(spark, [0.9, 0.6], [0, 0]), ["run"]).first()["iteration"] == 1


def test_drift_needs_more_than_the_limit(spark):
    got = series.drift_alerts(timeline(spark, [0.0, 0.50, 0.48, 0.45]), ["run"], drift=0.02).orderBy("iteration").collect()
    assert [r["drift_alert"] for r in got] == [False, 0.48 - 0.50 < -0.02, True]


def schedule(robust, asr=0.2, budget=50, tau=0.7):
    out, prev = [], 0.0
    for t, x in enumerate(robust, 1):
        delta, prev = x - prev, x
        budget = max(10, budget - 10) if delta > 0.01 else min(100, budget + 10)
        tau = max(0.1, min(0.95, tau - 0.1 * (asr - 0.3)))
        if delta < -0.02 and t > 1:
            budget, tau = 100, max(0.3, tau - 0.1)
        out.append((t, budget, round(tau, 9)))
    return out


def test_adaptive_schedule_fold_and_step_agree(spark):
    from bulwark.plans.active import next_settings

    robust = [0.5, 0.52, 0.525, 0.4, 0.6, 0.6]
    got = series.adaptive_schedule(timeline(spark, [0.3] + robust), ["run"]).orderBy("iteration").collect()
    assert [(r["iteration"], r["budget"], round(r["tau"], 9)) for r in got] == schedule(robust)
    budget, tau, prev = 50, 0.7, 0.0
    for t, x in enumerate(robust, 1):
        (budget, tau), other = next_settings(spark, [(budget, tau, x - prev, 0.2, t), (50, 0.7, 0.0, 0.2, 1)])
        prev = x
        assert (t, budget, round(tau, 9)) == schedule(robust)[t - 1] and other == next_settings(spark, [(50, 0.7, 0.0, 0.2, 1)])[0]


def test_early_stop(spark):
    scores = [0.1, 0.3, 0.2, 0.3, 0.25, 0.1, 0.05, 0.9]
    df = spark.createDataFrame([("r", i + 1, s) for i, s in enumerate(scores)], "run string, epoch int, dev_f1 double")
    r = series.early_stop(df, ["run"], patience=5).first()
    assert (r["best_epoch"], r["best_score"], r["stop_epoch"], r["last_epoch"]) == (2, 0.3, 7, 7)
    r = series.early_stop(df, ["run"], patience=9).first()
    assert (r["best_epoch"], r["stop_epoch"]) == (8, None)


def test_candidates_first_attack_wins(spark):
    rows = [(1, "a", 0, 5, 5, 5, 0.9), (1, "b", 1, 5, 5, 6, 0.9), (1, "c", 2, 5, 5, 5, 0.1),
            (2, "a", 0, 5, 4, 6, 0.9), (2, "b", 1, 5, 4, 6, 0.69), (3, "a", 0, 5, 5, 5, 0.7)]
    df = spark.createDataFrame(rows, "id long, attack string, attack_order int, label int, original_pred int, adv_pred int, adv_confidence double")
    got = {r["id"]: r["detection_method"] for r in sel.candidates(df, "id").collect()}
    assert got == {1: "b_misclassification", 2: "b_low_confidence"}
