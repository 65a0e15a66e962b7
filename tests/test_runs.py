"""Sources, stores, streams, models and plans."""

import json
import os

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulwark.functions import perturb
from bulwark.operators import learning, metrics, multifit, records
from bulwark.plans import active, guard, prep
from bulwark.queries import learning as learning_queries
from bulwark.queries import streams as stream_queries
from bulwark.queries import views
from bulwark.session import scratch_path
from bulwark.sources import records as src
from bulwark.sources import archives, stores
from bulwark.streaming import ingest


def write_lines(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        for r in rows:
            f.write((json.dumps(r) if r is not None else "") + "\n")


@pytest.fixture()
def folder(tmp_path):
    def rec(i, **kw):
        return {"document": f"D{i}.txt", "mention": f"m{i}", "sentence_left": f"some left words here {i}",
                "sentence_right": "and right ones", "label_link": "https://x/techniques/T1059", "label_id": 7, **kw}

    write_lines(tmp_path / "train.jsonl", [rec(i) for i in range(12)] + [None, rec(0), rec(99, mention=None)])
    write_lines(tmp_path / "train_w_con.jsonl", [rec(20, context_left="c")])
    write_lines(tmp_path / "train_w_con_w_neg.jsonl", [rec(30, label_id=1906), rec(31, label_id=5)])
    write_lines(tmp_path / "dev.jsonl", [rec(40)])
    write_lines(tmp_path / "dev_w_con.jsonl", [rec(41), rec(42)])
    write_lines(tmp_path / "test.jsonl", [rec(50), rec(51)])
    return str(tmp_path)


def test_ingest(spark, folder):
    n = {(r["split"], r["variant"]): r["count"] for r in src.ingest_splits(spark, folder).groupBy("split", "variant").count().collect()}
    assert n == {("train", "train"): 14, ("train", "train_w_con"): 1, ("dev", "dev"): 1, ("test", "test"): 2}
    v = src.ingest_variants(spark, folder)
    assert {r["variant"] for r in v.where("split = 'dev'").collect()} == {"dev_w_con"}
    assert {r["label_id"] for r in v.where("variant = 'train_w_con_w_neg'").collect()} == {"OTHER", "5"}
    with pytest.raises(FileNotFoundError):
        src.ingest_splits(spark, folder + "/nothing")


def test_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n", encoding="utf-8")
    (tmp_path / "b.md").write_text("no", encoding="utf-8")
    assert [tuple(r) for r in src.scan_text_files(spark, str(tmp_path)).collect()] == [("a.txt", "one\ntwo\n")]


def test_guard_run_without_ids(spark, folder):
    out = guard.run_guard(spark, folder, scratch_path(spark, "test-guard"))
    counts = {r["split"]: r for r in out["counts"].collect()}
    assert counts["train"]["total"] == 15 and counts["train"]["flag_duplicate"] == 2
    assert counts["train"]["quarantined"] == 1 and counts["train"]["kept"] == 13
    assert out["clean"].where("split = 'train'").count() == 13
    assert out["quarantine"].count() == 1
    assert out["stats"].count() == 3
    audit = {(r["stage"], r["key"]): r["value"] for r in out["audit"].collect()}
    assert audit["detection", "train.kept"] == 13 and audit["detection", "train.quarantined"] == 1
    for split, r in counts.items():  # what the run saw agrees with a recount
        assert audit["detection", f"{split}.records"] == r["total"] and audit["detection", f"{split}.anomalies"] == r["anomalies"]
    spent = {r["stage"]: r["seconds"] for r in out["runtime"].collect()}
    assert spent["total"] == pytest.approx(sum(v for k, v in spent.items() if k != "total")) and len(spent) == 4


def test_archives_of_text_files(spark, tmp_path):
    rows = [(f"{i}.txt", "é" * i) for i in range(40)] + [("empty.txt", None), ("skip.md", "no"), ("long.txt", "x" * 5_000_000)]
    folder = str(tmp_path / "a")
    archives.write_text_archives(spark.createDataFrame(rows, "document string, full_text string").repartition(3), folder)
    (tmp_path / "a" / "half.zip.open").write_bytes(b"left by a lost task")
    want = sorted((d, t or "") for d, t in rows if d.endswith(".txt"))
    got = archives.scan_text_archives(spark, folder)
    assert sorted(tuple(r) for r in got.collect()) == want and got.rdd.getNumPartitions() == 3
    # By Spark's own reader, as for stores that only Spark reads.
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.texts.link./in", f"file://{folder}")
    assert sorted(tuple(r) for r in archives.scan_text_archives(spark, "viewfs://texts/in").collect()) == want
    (tmp_path / "none").mkdir()
    assert archives.scan_text_archives(spark, str(tmp_path / "none")).count() == 0


def test_store_prunes_partitions(spark, sf):
    path = scratch_path(spark, "test-raw")
    stores.store_raw(views.docs(spark, sf), path)
    plan = stores.scan_store(spark, path, split="dev")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_malformed_lines_are_counted(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"document": "a"}\nnot json\n{"document": \n{"document": "b"}\n', encoding="utf-8")
    assert sorted(r["line"] for r in src.malformed_lines(spark, str(tmp_path / "x.jsonl")).collect()) == ["not json", '{"document": ']


def test_multi_line_report(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"a": {"b": 1}}, indent=2), encoding="utf-8")
    assert stores.read_report(spark, str(tmp_path / "r.json"), "a struct<b:int>", True).first()["a"]["b"] == 1


def test_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("full_text", T.StringType())])
    incoming, base = str(tmp_path / "in"), str(tmp_path / "run")
    os.makedirs(incoming)

    def arrive(rows, name):
        write_lines(f"{incoming}/{name}.json", [{"id": i, "full_text": t} for i, t in rows])

    def drain():
        stream = ingest.file_stream(spark, incoming, schema, "*.json", "json")
        return sorted((r["full_text"], r["id"]) for r in ingest.dedup_to_store(stream, "id", f"{base}/out", f"{base}/cp").collect())

    arrive([(i, "hot") for i in range(99, 0, -1)] + [(200, "a"), (200, "a")], "one")
    assert drain() == [("a", 200), ("hot", 1)]
    arrive([(300, "hot"), (302, "b"), (301, "b")], "two")
    assert drain() == [("a", 200), ("b", 301), ("hot", 1)]


@pytest.mark.parametrize("parts", [1, 3])
def test_streams_read_tables_that_are_folders_of_files(spark, tmp_path, parts):
    rows = [(i, f"Text number {i % 40} of the folder", "en", "web", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    docs.repartition(parts).write.parquet(str(tmp_path / "documents.parquet"))
    assert stream_queries.stream_ingest_flag(spark, str(tmp_path)).count() == 60
    firsts = stream_queries.stream_dedup(spark, str(tmp_path)).select("doc_id").collect()
    assert sorted(r[0] for r in firsts) == list(range(40))


def bytes_read(spark):
    """Bytes that all finished stages have read so far."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    empty = jvm.java.util.ArrayList()
    stages = sc.statusStore().stageList(empty, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), empty)
    return sum(stages.apply(i).inputBytes() for i in range(stages.size()))


def test_segments_cover_all_batches_once():
    for n in range(600):
        covered = []
        for s in ingest.segments(n):
            level, first = (int(p.split("=")[1]) for p in s.split("/"))
            assert first % ingest.FANOUT**level == 0
            covered += range(first, first + ingest.FANOUT**level)
        assert covered == list(range(n))


def test_stream_store_is_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "FANOUT", 2)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("full_text", T.StringType())])
    incoming, base = str(tmp_path / "in"), str(tmp_path / "run")
    os.makedirs(incoming)
    for batch in range(6):
        write_lines(f"{incoming}/{batch}.json", [{"id": 100 * batch + i, "full_text": f"text {i + batch}"} for i in range(5)])
        stream = ingest.file_stream(spark, incoming, schema, "*.json", "json")
        got = ingest.dedup_to_store(stream, "id", f"{base}/out", f"{base}/cp").collect()
        assert sorted(int(r["full_text"].split()[1]) for r in got) == list(range(5 + batch))
    assert os.path.isdir(f"{base}/out/digests/level=2/first=0") and ingest.segments(6) == ["level=2/first=0", "level=1/first=4"]


def test_a_lookup_reads_few_pages_of_a_large_store(spark, tmp_path):
    """Twenty times the store, about the same bytes read."""
    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(ingest.LOOKUP))
    read = []
    asked = spark.createDataFrame([(x,) for x in ("0" * 64, "7" * 64, "F" * 64)], "text_hash string")
    for n in (100_000, 2_000_000):
        index = str(tmp_path / f"index{n}")
        digests = spark.range(n).select(F.upper(F.sha2(F.col("id").cast("string"), 256)).alias("text_hash"))
        ingest._write_segment(digests, f"{index}/level=0/first=0", n)
        held = digests.limit(1).union(asked)
        before = bytes_read(spark)
        found = ingest.known_among(spark, index, 1, asked.union(spark.createDataFrame([(held.first()[0],)], "text_hash string"))).count()
        read.append(bytes_read(spark) - before)
        assert found == 1
        size = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(index) for f in fs)
    assert read[1] < 2 * read[0] + 500_000 and read[1] < size / 10, (read, size)


def test_dedup_with_event_time(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("full_text", T.StringType())])
    write_lines(tmp_path / "x.json", [{"id": i, "ts": f"2024-01-01T00:0{i}:00Z", "full_text": "t" if i < 3 else "u"} for i in range(5)])
    stream = ingest.file_stream(spark, str(tmp_path), schema, "*.json", "json")
    out = ingest.drain(ingest.dedup_stream(stream, "id", event_time="ts"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r["full_text"] for r in out.collect()) == ["t", "u"]


def test_tfidf_salted_equals_plain(spark, sf):
    d = views.docs(spark, sf).select("doc_id", "full_text")
    a = learning.tfidf_terms(d, "doc_id")
    b = learning.tfidf_terms(d, "doc_id", floor=1, salts=4)
    assert a.exceptAll(b).count() == 0 and b.count() == a.count()


def test_terms_that_share_a_key_travel_as_strings(spark, sf, monkeypatch):
    d = views.docs(spark, sf).select("doc_id", "full_text")
    want = learning.tfidf_terms(d, "doc_id")
    monkeypatch.setattr(learning, "term_key", lambda t: F.pmod(F.xxhash64(t), F.lit(50)))
    got = learning.tfidf_terms(d, "doc_id")
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_terms_are_counted_in_hash_tables(spark, monkeypatch):
    d = spark.createDataFrame([(1, "a b a \n"), (2, "b \u2028"), (3, None), (4, "")], "doc_id long, full_text string")
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df.checkpoint()

    monkeypatch.setattr(learning, "checkpointed", noted)
    scratch_path(spark, "terms")  # sets the folder of checkpoints
    got = {(r["doc_id"], r["term"]): (r["tf"], r["df"]) for r in learning.tfidf_terms(d, "doc_id").collect()}
    assert got == {(1, "a"): (2, 1), (1, "b"): (1, 2), (2, "b"): (1, 2), (2, "\u2028"): (1, 1), (4, ""): (1, 1)}
    assert plans and not any("SortAggregate" in p for p in plans)


def test_hashing_is_that_of_the_stages(spark):
    """Vectors of all kinds of texts equal Tokenizer's and HashingTF's, without their functions in the plan."""
    from pyspark.ml import PipelineModel

    texts = ["", " ", "a", " a", "a ", "a  b", "A\tB\nC\x0bD\fE\rF", "ΑΣ ΑΣ. ΟΔΥΣΣΕΥΣ Σ ΣΑ", "İstanbul ẞ ǅ Ⅷ", "a b\u0085c\u2028d", "\n\n", "日本語 テスト",
             "x" * 1001, "\U0001F600 \U00010400 Ꭰ ჿ Ა", "one two one  two " * 300, None]
    for some in (texts, ["\n "], ["", ""]):
        d = spark.createDataFrame([(i, t, "l", None) for i, t in enumerate(some)], "doc_id long, full_text string, label string, more array<int>").coalesce(1)
        ours = learning.hashing(d, "label", ("doc_id", "more"))
        theirs = PipelineModel(stages=learning.hashing_stages()).transform(d.dropna(subset=["full_text"])).select(*ours.columns)
        assert ours.schema["raw_features"].dataType == theirs.schema["raw_features"].dataType
        assert [(r["doc_id"], r["raw_features"]) for r in ours.collect()] == [(r["doc_id"], r["raw_features"]) for r in theirs.collect()]
        assert "MapInArrow" in plan_of(ours) and plan_of(ours).count("UDF") < plan_of(theirs).count("UDF")


def test_blocks_keep_rare_terms_sparse(spark):
    """A block's dense part holds frequent terms only, so a scan costs about its entries; both parts together are all features."""
    rng = np.random.default_rng(5)
    rows = [(i, float(i % 3), 1.0, Vectors.sparse(2000, {t: float(rng.normal()) for t in {0, i % 9, *rng.integers(0, 2000, 12).tolist()}}))
            for i in range(300)]
    table = spark.createDataFrame([*rows, (300, 0.0, 1.0, Vectors.sparse(2000, {}))], ["id", "label", "weight", "features"]).coalesce(1)
    scale, theta = rng.uniform(0.5, 2, 2000), rng.normal(size=(2, 3, 2001))
    packed = multifit.packed(active.of_all(table), "id", scale)
    (block,) = multifit.blocks_of(packed.toArrow().to_batches())
    x = np.array([r["features"].toArray() * scale for r in table.collect()])
    entries = np.count_nonzero(x)
    assert len(block.x) and len(block.dense_terms) and block.dense.size <= multifit.SPARSE * entries
    t, p = multifit.by_term(theta), rng.normal(size=(301, 6))
    g = np.ones((2001, 6))
    block.add_gradient(p, g)
    assert np.allclose(block.logits(t), x @ t[:-1] + t[-1])
    assert np.allclose(g[:-1] - 1, x.T @ p) and np.allclose(g[-1] - 1, p.sum(axis=0))
    once, twice = (sorted((r["id"], r["model"], r["label"], *np.round(r["probs"], 9)) for r in df.collect()) for df in (
        multifit.scored_rows(table, "id", scale, theta), multifit.scored(packed, theta)))
    assert once == twice and len(once) == 602


def test_a_fit_sends_as_many_gradients_as_the_cores_ask_for(spark, monkeypatch):
    rows = [(i, i % 2, Vectors.sparse(3, {i % 2: 1.0, 2: float(i % 5)})) for i in range(400)]
    table = spark.createDataFrame(rows, ["id", "label", "features"]).repartition(90, "id")
    scale = multifit.deviations(table)
    blocks = multifit.packed(table.withColumns({"model": F.lit(multifit.ALL), "weight": F.lit(1.0)}), "id", scale)
    own = blocks.where("false").unionByName(blocks)
    seen, losses = [], multifit.losses

    def noted(blocks, *a):
        seen.append(blocks.rdd.getNumPartitions())
        return losses(blocks, *a)

    monkeypatch.setattr(multifit, "losses", noted)
    found = multifit.fit(own, np.ones((2, 2)), scale, 0.1)
    assert max(seen) <= multifit.SCAN_TASKS * spark.sparkContext.defaultParallelism < own.rdd.getNumPartitions()
    assert found.gradient.max() <= multifit.TOLERANCE and np.array_equal(found.theta[0], found.theta[1])


def test_an_mllib_fit_sends_as_many_gradients_as_the_cores_ask_for(spark, monkeypatch):
    rows = [(float(i % 2), Vectors.sparse(3, {i % 2: 1.0, 2: float(i % 5)})) for i in range(400)]
    most, seen = multifit.SCAN_TASKS * spark.sparkContext.defaultParallelism, []
    own = spark.createDataFrame(rows, ["label", "features"])
    many, few = own.repartition(most + 50), own.repartition(2)
    real = learning.classifier()

    class Noted:
        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))
            return real.fit(rows)

    monkeypatch.setattr(learning, "classifier", lambda weight=None: Noted())
    models = [learning.fit_classifier(t) for t in (many, few)]
    assert many.rdd.getNumPartitions() > most
    assert seen == [(most, 400), (2, 400)]  # a table of few partitions keeps them
    a, b = (m.coefficientMatrix.toArray() for m in models)
    assert np.abs(a - b).max() < 1e-3


def test_labels_are_encoded_where_the_texts_are(spark):
    kinds = [*["big"] * 4, *["mid"] * 3, "rare"]
    rows = [(i, f"text {i}", None if i == 7 else kinds[i % 8], "train" if i % 5 else "test") for i in range(80)]
    df = spark.createDataFrame(rows, "id long, full_text string, label_id string, split string")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = prep.label_and_encode(df, 2)
        plan = out._jdf.queryExecution().executedPlan().toString()
        codes = {(r["label_mapped"], r["label_id_encoded"]) for r in out.collect()}
        assert "SortMergeJoin" not in plan and out.count() == 80
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert codes == {("OTHER", 0), ("big", 1), ("mid", 2)}


def test_weighted_mix(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, l string")
    mix = learning.weighted_mix(dict.fromkeys(learning.RETRAIN_WEIGHTS, df), "l", learning.RETRAIN_WEIGHTS)
    got = {(r["id"], r["origin"]): r["weight"] for r in mix.collect()}
    assert got[(1, "clean")] == pytest.approx(0.6 * 9 / (2 * 6))
    assert got[(3, "adversarial")] == pytest.approx(0.2 * 9 / (2 * 3))
    assert len(got) == 9


def test_model_scores_and_runs(spark, sf):
    train, _, test = learning_queries.train_test(spark, sf)
    model = learning.train(train)
    scored = learning.with_probabilities(model, test).collect()
    assert scored and all(abs(sum(r["probs"]) - 1) < 1e-6 for r in scored)
    values = {r["metric"]: r["value"] for r in learning.evaluate(model, test).collect()}
    assert set(values) == {"accuracy", "f1_weighted", "precision_weighted", "recall_weighted"}
    assert values["accuracy"] == pytest.approx(values["recall_weighted"])
    # The same figures from the exported coefficients alone, in another engine.
    import duckdb

    table = learning.hashed(test, "label_mapped", ("doc_id",))
    hashed_model = learning.PipelineModel(stages=model.stages[2:])
    coef = learning.coefficient_table(hashed_model)
    terms, con = learning.term_counts(table, "doc_id"), duckdb.connect()
    for name, df in (("coef", coef), ("terms", terms), ("truth", hashed_model.transform(table).select("doc_id", F.col("label").cast("int").alias("label")))):
        con.register(name, df.toArrow())
    con.execute("""CREATE TABLE p AS SELECT doc_id, label, arg_max(class, (z, -class)) AS prediction FROM (
        SELECT doc_id, label, b.class, any_value(b.coefficient) + coalesce(sum(tf * c.coefficient), 0) AS z FROM truth CROSS JOIN (SELECT * FROM coef WHERE term IS NULL) b
        LEFT JOIN terms USING (doc_id) LEFT JOIN coef c ON c.term = terms.term AND c.class = b.class GROUP BY ALL) GROUP BY ALL""")
    want = dict(con.execute("SELECT doc_id, prediction FROM p").fetchall())
    assert {r["doc_id"]: r["prediction"] for r in scored} == want
    assert con.execute("SELECT avg((label = prediction)::INT) FROM p").fetchone()[0] == pytest.approx(values["accuracy"])
    precision = "SELECT sum(n * coalesce(r / nullif(m, 0), 0)) / sum(n) FROM (SELECT label AS c, count(*) AS n, sum((label = prediction)::INT) AS r FROM p GROUP BY 1) LEFT JOIN (SELECT prediction AS c, count(*) AS m FROM p GROUP BY 1) USING (c)"
    assert con.execute(precision).fetchone()[0] == pytest.approx(values["precision_weighted"])
    by_join = {r["doc_id"]: (r["prediction"], r["probs"]) for r in learning.sparse_scores(test, terms, coef, "doc_id", floor=5, salts=3).collect()}
    assert all(by_join[r["doc_id"]] == (r["prediction"], pytest.approx(r["probs"], abs=1e-9)) for r in scored)


def test_certificate_of_a_fit(spark, sf):
    """The penalised gradient is near 0 at a fit's coefficients and nowhere else; both optimisers agree."""
    train, _, _ = learning_queries.train_test(spark, sf)
    table = learning.hashed(train, "label_mapped", ("doc_id",))
    model = learning.train_hashed(table)
    assert learning.residual(model, table) < 2e-3
    rows = learning.fit_features(table).transform(table)
    scale = multifit.deviations(rows)
    blocks = multifit.packed(active.of_all(rows), "doc_id", scale)
    theirs = multifit.coefficients(model.stages[-1], scale)
    k = theirs.shape[1]
    ours = multifit.fit(blocks, np.ones((1, k)), scale, learning.REG_PARAM, tolerance=1e-4)
    assert ours.gradient[0] <= 1e-4 and np.abs(ours.theta - theirs)[:, :, :-1].max() < 0.02
    _, g = multifit.objective(blocks, 0.9 * theirs, np.ones((1, k)), np.zeros(1, int), learning.REG_PARAM)
    assert multifit.residual(g, 0.9 * theirs)[0] > 0.005


def test_models_with_rows_of_their_own(spark):
    """Each model's gradient is that of its rows and weights, summed plainly; blocks of several sizes hold the same."""
    rng = np.random.default_rng(3)
    from pyspark.ml.linalg import Vectors

    rows = [(i, int(rng.integers(-1, 3)), float(rng.integers(0, 3)), float(rng.uniform(0.1, 1)), Vectors.sparse(6, sorted(rng.choice(6, 3, replace=False).tolist()), rng.normal(size=3)))
            for i in range(40)]
    df = spark.createDataFrame(rows, ["id", "model", "label", "weight", "features"]).repartition(3)
    scale, weights, theta = rng.uniform(0.5, 2, 6), rng.uniform(0.5, 2, (3, 3)), rng.normal(size=(3, 3, 7))
    value, g = multifit.objective(multifit.packed(df, "id", scale), theta, weights, np.arange(3), 0.1)
    for m in range(3):
        loss, total, grad = 0.0, 0.0, np.zeros((3, 7))
        for _, own, label, w, x in rows:
            if own in (-1, m):
                x = np.append(x.toArray() * scale, 1.0)
                p = np.exp(theta[m] @ x) / np.exp(theta[m] @ x).sum()
                w *= weights[m][int(label)]
                loss, total = loss - w * np.log(p[int(label)]), total + w
                grad += w * np.outer(p - np.eye(3)[int(label)], x)
        flat = theta[m].copy()
        flat[:, -1] = 0
        assert value[m] == pytest.approx(loss / total + 0.05 * (flat**2).sum()) and np.allclose(g[m], grad / total + 0.1 * flat)
    empty = multifit.objective(multifit.packed(df.where("false"), "id", scale), theta, weights, np.arange(3), 0.1)
    assert np.isfinite(empty[0]).all()


def test_models_beat_the_largest_class_where_words_tell(spark):
    rows = [(i, f"{'alpha beta' if i % 3 else 'gamma delta'} filler word {i % 7}", "a" if i % 3 else "b") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, full_text string, label_mapped string")
    runs = {r["model"]: r for r in learning.robust_runs(df.where("doc_id < 90"), df.where("doc_id >= 90"), "doc_id").collect()}
    assert runs["LogReg_clean"]["accuracy"] > 0.9
    assert runs["LogReg_adv_training"]["train_records"] == 2 * runs["LogReg_clean"]["train_records"] == 180
    assert "train_time_s" not in runs["LogReg_clean"].asDict()


def test_training_reads_texts_once(spark, sf):
    train, _, _ = learning_queries.train_test(spark, sf)
    table = learning.hashed(train, "label_mapped")
    assert "full_text" not in plan_of(table) and "parquet" not in plan_of(table).lower()
    assert table.rdd.getNumPartitions() == learning.drop_incomplete(train, "label_mapped").rdd.getNumPartitions()


def test_candidates_come_from_every_attack(spark, sf):
    train, pool, test = learning_queries.train_test(spark, sf)
    data = active.prepare(train, pool, test, "doc_id", "label_mapped", active.Settings())
    n = pool.count()
    assert {r["attack"]: r["count"] for r in data.hits.groupBy("attack").count().collect()} == dict.fromkeys(
        perturb.attack_suite(F.lit("x"), F.lit(1), F.lit(None).cast("map<string,array<string>>"),
                             F.lit(None).cast("array<struct<n: int, rank: int, place: int, word: string>>")), n)
    found = active.detect(data, "doc_id", 1.01)
    assert found.count() == n and set(r[0] for r in found.select("attack").distinct().collect()) <= {"synonym", "char_swap"}
    chosen = found.orderBy("doc_id").limit(3).select("doc_id", F.lit(0).alias("model"))
    rows = active.selected_rows(data, found, chosen, [1], "doc_id")
    assert {(r["model"], r["weight"]): r["count"] for r in rows.groupBy("model", "weight").count().collect()} == {(0, 0.2): 6, (1, 0.2): 2 * n}
    assert data.class_rows.sum() == train.count()


def test_first_hits_are_found_without_their_features(spark, monkeypatch):
    v, seen, find = lambda *x: Vectors.sparse(2, [0, 1], x), [], active.sel.candidates
    pool = spark.createDataFrame([(1, 0.0, v(1, 3)), (2, 1.0, v(3, 1))], ["doc_id", "label", "features"])
    hits = spark.createDataFrame([(i, 0.0, a, n, f"{i}{a}", v(i, n + 1)) for i, a, n in (
        (1, "b", 1), (1, "a", 0), (2, "b", 1), (2, "c", 2), (2, "b", 1))], ["doc_id", "label", "attack", "attack_order", "copy_key", "features"])
    first = multifit.Models(np.zeros((1, 2, 3)), np.ones(2), np.zeros(1), np.zeros(1))
    data = active.Prepared(pool, hits.localCheckpoint(), None, None, None, np.ones(2), np.ones(2), first)
    monkeypatch.setattr(active.sel, "candidates", lambda df, *a: seen.append(df.columns) or find(df, *a))
    found = {r["doc_id"]: (r["attack"], r["features"].toArray().tolist()) for r in active.detect(data, "doc_id", 0.7).collect()}
    assert found == {1: ("a", [1.0, 1.0]), 2: ("b", [2.0, 2.0])} and "features" not in seen[0]


def test_runs_together_are_the_runs_alone(spark, sf):
    """Several settings in one scan give the timelines that each gives by itself."""
    train, pool, test = learning_queries.train_test(spark, sf)
    data = active.prepare(train, pool, test, "doc_id", "label_mapped", active.Settings(tau=0.97))
    base = active.Settings(tau=0.97, budget=4, rounds=2)
    settings = [active.replace(base, **c) for c in ({"strategy": "all", "rounds": 1, "adaptive": False}, {"strategy": "margin"},
                {"strategy": "entropy_coreset", "budget": 3}, {"strategy": "composite", "beta": 2.0}, {"strategy": "random", "adaptive": False})]
    together = active.checked(active.run_together(data, "doc_id", settings), ["run"]).orderBy("run", "iteration").collect()
    flags = ("adds_up", "pool_shrinks", "in_budget", "rates_in_range", "explained")
    assert all(r[c] for r in together for c in flags) and {r["run"] for r in together} == set(range(5))
    assert [r["n_selected"] for r in together if r["run"] == 1][:2] == [0, 4]
    whole = [r for r in together if r["run"] == 0]
    assert [r["n_selected"] for r in whole] == [0, whole[0]["pool_size"]] and whole[0]["pool_size"] > 4
    for i, s in ((1, settings[1]), (3, settings[3])):
        alone = active.run_together(data, "doc_id", [s]).orderBy("iteration").collect()
        mine = [r for r in together if r["run"] == i]
        for a, b in zip(alone, mine, strict=True):
            assert (a["n_selected"], a["pool_size"], a["top_explanations"]) == (b["n_selected"], b["pool_size"], b["top_explanations"])
            assert a["robust_accuracy"] == b["robust_accuracy"] and a["entropy_mean"] == pytest.approx(b["entropy_mean"], abs=1e-6)


def test_grid_is_complete():
    grid = [active.replace(active.Settings(), **g) for g in active.GRID]
    assert {s.strategy for s in grid} == {"all", "random", "entropy", "margin", "coreset", "entropy_coreset", "composite"}
    of = lambda f, g: {f(s) for s in grid if s.strategy == "composite" and g(s)}
    assert of(lambda s: s.beta, lambda s: s.budget == 50 and s.rounds == 5) == {0.0, 0.25, 0.5, 1.0, 2.0}
    assert of(lambda s: s.budget, lambda s: s.beta == 0.5) == {10, 20, 50, 100} and of(lambda s: s.rounds, lambda s: True) == {1, 3, 5, 7}


def test_model_under_attack_feeds_the_comparison(spark, sf):
    train, _, test = learning_queries.train_test(spark, sf)
    hits = learning.attacked_predictions(learning.train(train), test, "doc_id", "label_mapped", {
        "none": F.col("full_text"), "empty": F.lit("")})
    m = {r["attack"]: r for r in metrics.attack_metrics(hits, ("attack",)).collect()}
    assert m["none"]["n_successful_attacks"] == 0 and m["none"]["robust_accuracy"] == m["none"]["clean_accuracy"]
    assert m["empty"]["n_samples"] == test.count()


def test_active_learning_removes_what_it_selects(spark, sf):
    train, pool, test = learning_queries.train_test(spark, sf)
    s = active.Settings(budget=10, rounds=2, strategy="margin", tau=0.95)
    rows = active.active_learning(train, pool, test, "doc_id", s=s).orderBy("iteration").collect()
    assert rows[0]["iteration"] == 0 and rows[0]["n_labeled_samples"] == 0
    for a, b in zip(rows, rows[1:]):
        assert b["n_labeled_samples"] == a["n_labeled_samples"] + b["n_selected"]
    assert all(0 <= r["attack_success_rate"] <= 1 for r in rows)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_in_the_jvm_without_cross_joins(spark, sf):
    d = views.labelled(spark, sf)
    for df in (records.guard_counts(d), records.annotate(d, "doc_id"), records.split_stats(records.survivors(
            records.add_row_flags(d), "doc_id", ["label_mapped", "word_count"]))):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_duplicate_marks_need_no_window(spark, sf):
    plan = plan_of(records.mark_copies(views.labelled(spark, sf), "doc_id"))
    assert "Window" not in plan


def test_scan_reads_only_needed_columns(spark, sf):
    plan = plan_of(views.table(spark, sf, "labels").groupBy("quality").agg(F.count("*")))
    assert "ReadSchema: struct<quality:int>" in plan
