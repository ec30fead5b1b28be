import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidewatch.functions import running
from tidewatch.operators import evaluate as ev
from tidewatch.operators import features, maintenance, models, perturb
from tidewatch.operators.registry import Registry
from tidewatch.roles import Roles
from tidewatch.session import materialize
from tidewatch.sources.tables import FIXTURE


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("slice_rows", [3, 1_000_000])
def test_auc_is_exact_with_ties(spark, monkeypatch, slice_rows):
    original = running.running_totals
    monkeypatch.setattr(ev, "running_totals", lambda *a, **k: original(*a, **k, slice_rows=slice_rows))
    rng = random.Random(1)
    pairs = [(rng.randint(0, 1), round(rng.random(), 1)) for _ in range(200)]
    df = spark.createDataFrame(pairs, "label int, score double").repartition(4)
    assert ev.roc_auc(df).first()["roc_auc"] == pytest.approx(brute_auc(pairs))


def test_metrics_edge_cases(spark):
    one = spark.createDataFrame([(0, 0.0, 0.2), (0, 0.0, 0.4)], "label int, prediction double, score double")
    row = ev.evaluate(one).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"], row["roc_auc"]) == (1.0, 0.0, 0.0, 0.0, 0.5)
    mixed = spark.createDataFrame([(0, 0.0), (0, 1.0), (1, 1.0), (1, 1.0), (2, 0.0)], "label int, prediction double")
    want = (2 * (2 * 1 / (2 + 2)) + 2 * (2 * 2 / (2 + 3)) + 1 * 0) / 5
    assert ev.weighted_f1(mixed).first()["weighted_f1"] == pytest.approx(want)


def test_feature_steps(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 3.0), ("b", None), (None, 5.0), ("a", 7.0)], "c string, x double")
    assert features.modes(df, ["c"]) == {"c": "a"} and features.medians(df, ["x"]) == {"x": 4.0}
    codes = features.label_codes(df, ["c"])
    encoded = features.encode(df, codes, ["c"])
    assert {(r["c"], r["c_encoded"]) for r in encoded.collect()} == {("a", 0), ("b", 1), (None, 2)}
    flat = df.select(F.lit(3.0).alias("k"), "x")
    scaled = features.standardize(flat, features.scaling(flat, ["k", "x"])).collect()
    assert {r["k"] for r in scaled} == {0.0} and sum(r["x"] for r in scaled if r["x"] is not None) == pytest.approx(0.0)
    single = features.class_distribution(spark.createDataFrame([(0,), (0,)], "has_claim int")).first()
    assert (single["n_negative"], single["n_positive"], single["imbalanced"]) == (2, 0, True)


def test_split_does_not_depend_on_partitions(policies):
    labelled = features.add_label(policies, FIXTURE)
    once = {r[0] for r in features.stratified_split(labelled, "object_id").where("is_test").select("object_id").collect()}
    again = {r[0] for r in features.stratified_split(labelled.repartition(7), "object_id").where("is_test").select("object_id").collect()}
    assert once == again and 0.15 < len(once) / policies.count() < 0.25
    folds = {r["fold"]: r["count"] for r in features.stratified_folds(labelled, "object_id").groupBy("fold").count().collect()}
    assert set(folds) == {0, 1, 2} and max(folds.values()) - min(folds.values()) < 10


def test_perturbations_do_not_depend_on_partitions(policies):
    for change in (
        lambda df: perturb.overwrite_target(df, FIXTURE, "object_id", 0.3, start=2),
        lambda df: perturb.add_spikes(df, FIXTURE, "object_id", ["premium", "insured_value"], 0.1, start=2),
    ):
        # averages may differ in the last bit, as rows are added up in another order
        once, again = (change(df).withColumns({c: F.round(c, 6) for c in ("premium", "insured_value")}) for df in (policies, policies.repartition(5)))
        assert once.exceptAll(again).count() == 0 and once.where("batch_num = 1").exceptAll(policies.where("batch_num = 1")).count() == 0
    changed = perturb.overwrite_target(policies, FIXTURE, "object_id", 0.3, start=2).where("batch_num = 2 and claim_paid = 1")
    assert changed.count() == 75


def test_maintenance_rules(spark):
    rows = [("DecisionTree", 1, 0.8, 0.60, 0.7, 0.5), ("RandomForest", 2, 0.6, 0.605, None, 2.0), ("Other", 3, 0.9, 0.62, 0.9, None), ("DecisionTree", 4, 0.9, 0.625, 0.7, 0.1)]
    history = spark.createDataFrame(rows, "model_name string, ts int, accuracy double, f1 double, roc_auc double, inference_time double")
    assert maintenance.champion(history).first()["ts"] == 3
    assert maintenance.champion(history.limit(0)).count() == 0
    checked = {r["ts"]: r["violations"] for r in maintenance.check_thresholds(history).collect()}
    assert checked == {1: ["f1"], 2: ["accuracy", "f1", "inference_time"], 3: ["f1"], 4: ["f1"]}
    scores = {r["ts"]: r["s"] for r in history.select("ts", maintenance.performance_score().alias("s")).collect()}
    assert scores[2] == pytest.approx((0.6 * 0.3 + 0.605 * 0.4) / 0.7)
    characteristics = spark.createDataFrame([(1, 0.5, 0.0)], "batch_num int, sparse_data double, anomalous_values double")
    fit = {r["model_name"]: r["adaptation"] for r in maintenance.adaptation_scores(characteristics).collect()}
    assert fit["DecisionTree"] == pytest.approx((0.8 + 0.6 * 0.5) / 1.4)
    averages = maintenance.recent_average(history, ["ts"], 2)
    chosen = maintenance.choose_model(averages, maintenance.adaptation_scores(characteristics), ["batch_num"]).first()
    assert chosen["model_name"] == "DecisionTree"
    assert chosen["score"] == pytest.approx(0.7 * (0.9 * 0.3 + 0.625 * 0.4 + 0.7 * 0.3) + 0.3 * fit["DecisionTree"])
    only = maintenance.choose_model(averages.where("model_name = 'Other'"), maintenance.adaptation_scores(characteristics), ["batch_num"]).first()
    assert only["score"] == pytest.approx(0.7 * (0.9 * 0.3 + 0.62 * 0.4 + 0.9 * 0.3) + 0.15)  # no rules: neutral
    versions = maintenance.with_versions(history)
    best = {r["model_name"]: r["version"] for r in maintenance.best_version(versions, "roc_auc").collect()}
    assert best == {"DecisionTree": 1, "RandomForest": 1, "Other": 1}


@pytest.fixture(scope="module")
def ready(policies):
    pipeline = models.fit_features(policies, FIXTURE)
    return pipeline, materialize(models.labelled(policies, FIXTURE, pipeline))


def test_features_are_scaled_and_target_is_optional(ready, policies):
    from pyspark.ml.stat import Summarizer

    pipeline, rows = ready
    names = models.feature_names(FIXTURE, policies.columns)
    stats = rows.select(Summarizer.metrics("mean", "count").summary(F.col("features")).alias("s")).first()["s"]
    assert len(stats["mean"]) == len(names) and max(abs(m) for m in stats["mean"]) < 1e-9
    unseen = policies.drop("claim_paid").withColumn("make", F.lit("never seen"))
    assert pipeline.transform(unseen).count() == policies.count()


def test_registry_reload_update_and_promotion(spark, ready, tmp_path):
    pipeline, rows = ready
    registry = Registry(spark, str(tmp_path))
    assert registry.versions().count() == 0 and registry.champion() is None
    model = models.estimator(models.FOREST, 10, maxDepth=3, numTrees=3).fit(rows)
    trained = models.Trained(models.FOREST, model, {"maxDepth": 3, "numTrees": 3})
    assert registry.register(pipeline, trained, {"f1": 0.5, "roc_auc": 0.6}, batch_id=1, run_id="first") == 1
    assert registry.register(pipeline, trained, {"f1": 0.5, "roc_auc": 0.6}, batch_id=1, run_id="first") == 1
    grown = models.update(trained, rows)
    assert isinstance(grown.model, models.Ensemble) and len(grown.model.members) == 2
    assert registry.register(pipeline, grown, {"f1": 0.7}, batch_id=2, is_incremental=True, parent_version=1) == 2
    _, loaded, metrics = registry.load(models.FOREST, 2)
    assert metrics == {"f1": 0.7} and loaded.params == {"maxDepth": 3, "numTrees": 3}
    a = models.score(rows, grown.model).select("object_id", "score")
    b = models.score(rows, loaded.model).select("object_id", F.col("score").alias("again"))
    assert a.join(b, "object_id").where("abs(score - again) > 1e-12").count() == 0
    assert registry.best("roc_auc")["version"] == 1 and registry.latest(models.FOREST)["version"] == 2
    assert registry.promote(models.FOREST, 1, {"f1": 0.5}) and not registry.promote(models.FOREST, 2, {"f1": 0.505})
    assert registry.promote(models.FOREST, 2, {"f1": 0.7}) and registry.champion() == {"model_name": models.FOREST, "version": 2}


def test_network_and_tree_updates_keep_their_type(ready):
    _, rows = ready
    network = models.Trained(models.NETWORK, models.estimator(models.NETWORK, 10, hidden=[4], maxIter=5).fit(rows))
    assert list(models.update(network, rows).model.getLayers()) == [10, 4, 2]
    tree = models.Trained(models.TREE, models.estimator(models.TREE, 10, maxDepth=3).fit(rows), {"maxDepth": 3})
    assert type(models.update(tree, rows).model) is type(tree.model)


def test_shapley_adds_up_to_the_score(ready):
    _, rows = ready
    model = models.estimator(models.TREE, 10, maxDepth=4).fit(rows)
    few = materialize(rows.orderBy("object_id").limit(5))
    names = models.feature_names(FIXTURE, rows.columns)
    total = models.shapley(few, model, names, "object_id", 3).groupBy("object_id").agg(F.sum("shapley").alias("sum"))
    from pyspark.ml.functions import array_to_vector

    base = models.score(few.limit(1).select(array_to_vector(F.array(*[F.lit(0.0)] * 10)).alias("features")), model).first()["score"]
    joined = models.score(few, model).join(total, "object_id").collect()
    assert len(joined) == 5 and all(r["sum"] == pytest.approx(r["score"] - base) for r in joined)


def test_roles_of_policy_files_give_twelve_features():
    from tidewatch.roles import POLICY, POLICY_COLUMNS

    assert len(features.feature_columns(POLICY, POLICY_COLUMNS)) == 12
    assert Roles(batch=None).by == []


def test_champion_over_many_slices_as_a_plain_loop(spark, monkeypatch):
    import random

    from tidewatch.functions import running
    from tidewatch.operators import maintenance

    monkeypatch.setattr(running.running_maximum, "__defaults__", (7,))
    for seed in range(3):
        rng = random.Random(seed)
        rows = [(t, f"m{t % 3}", None if rng.random() < 0.2 else round(rng.random() * (t + 5) / 40, 3)) for t in range(60)]
        if seed == 0:
            rows[0] = (0, "m0", None)
        held = rows[0]
        for row in rows[1:]:
            if held[2] is not None and row[2] is not None and row[2] > held[2] + 0.01:
                held = row
        frame = spark.createDataFrame(rows, "ts long, model_name string, f1 double").repartition(3)
        assert [tuple(r) for r in maintenance.champion(frame).collect()] == [held]
    assert maintenance.champion(frame.limit(0)).count() == 0


def test_merged_forest_scores_as_the_mean_of_its_parts_and_ages(spark, ready, tmp_path):
    from pyspark.ml import PipelineModel

    from tidewatch.operators.forests import Ensemble, merge_forests

    _, rows = ready
    parts = [models.estimator(models.FOREST, 10, maxDepth=3, numTrees=n).setSeed(n).fit(rows) for n in (2, 3, 1)]
    one = models.score(rows, Ensemble(parts)).select("object_id", "score", "prediction")
    for i, part in enumerate(parts):
        one = one.join(models.score(rows, part).select("object_id", F.col("score").alias(f"s{i}")), "object_id")
    plain = (2 * F.col("s0") + 3 * F.col("s1") + F.col("s2")) / 6
    assert one.where(F.abs(plain - F.col("score")) > 1e-12).count() == 0 and one.count() == rows.count()
    folders = []
    for i, part in enumerate(parts):
        folders.append(str(tmp_path / f"part {i}"))
        PipelineModel([part]).save(folders[-1])
    aged = merge_forests(spark, folders, str(tmp_path / "aged"), max_trees=3)
    assert aged.getNumTrees == 3 and [t.toDebugString for t in aged.trees][2].split("\n", 1)[1] == parts[2].trees[0].toDebugString.split("\n", 1)[1]
    assert [t.toDebugString.split("\n", 1)[1] for t in aged.trees[:2]] == [t.toDebugString.split("\n", 1)[1] for t in parts[1].trees[1:]]
    assert merge_forests(spark, folders * 30, str(tmp_path / "many")).getNumTrees == 6
    with pytest.raises((FileNotFoundError, AnalysisException)):
        merge_forests(spark, [str(tmp_path / "aged")], str(tmp_path / "none"))


def test_a_hundred_updates_score_in_one_plan(spark, ready, tmp_path):
    import shutil

    from pyspark.ml import PipelineModel

    from tidewatch.operators.forests import Ensemble

    _, rows = ready
    part = models.estimator(models.FOREST, 10, maxDepth=2, numTrees=1).fit(rows)
    PipelineModel([part]).save(str(tmp_path / "0"))
    folders = [str(tmp_path / "0")] + [shutil.copytree(tmp_path / "0", tmp_path / str(i)).as_posix() for i in range(1, 100)]
    small, large = (models.score(rows, Ensemble(folders[:n])) for n in (2, 100))
    size = lambda df: len(df._jdf.queryExecution().analyzed().toString().splitlines())
    assert size(small) == size(large)
    assert large.join(models.score(rows, part).select("object_id", F.col("score").alias("s")), "object_id").where("abs(s - score) > 1e-12").count() == 0


def test_text_codes_are_saved_and_unseen_texts_keep_the_last_code(spark, tmp_path):
    from tidewatch.operators.text_codes import TextCodes, TextCodesModel

    rows = spark.createDataFrame([("b", "x"), ("a", None), ("b", ""), (None, "x")], "k string, v string")
    model = TextCodes(inputCols=["k", "v"], outputCols=["kc", "vc"]).fit(rows)
    fresh = spark.createDataFrame([(1, "a", "x"), (2, "b", ""), (3, "c", None), (4, None, "y"), (4, None, "y")], "id int, k string, v string")
    want = [(1, 0.0, 1.0), (2, 1.0, 0.0), (3, 2.0, 2.0), (4, 2.0, 2.0), (4, 2.0, 2.0)]
    model.save(str(tmp_path / "codes"))
    for one in (model, TextCodesModel.load(str(tmp_path / "codes"))):
        assert [tuple(r) for r in one.transform(fresh).orderBy("id").select("id", "kc", "vc").collect()] == want
    empty = TextCodes(inputCols=["k"], outputCols=["kc"]).fit(rows.limit(0))
    assert {r.kc for r in empty.transform(fresh).collect()} == {0.0}


def test_large_text_codes_are_not_broadcast(spark, monkeypatch):
    from tidewatch.operators import text_codes

    rows = spark.range(50).select(F.concat(F.lit("t"), "id").alias("k"))
    model = text_codes.TextCodes(inputCols=["k"], outputCols=["c"]).fit(rows)
    narrow = model.transform(rows)
    monkeypatch.setattr(text_codes, "BROADCAST_BYTES", 100)
    wide = model.transform(rows)
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" in plan(narrow) and "strategy=broadcast" not in plan(wide)
    assert sorted(r.c for r in wide.collect()) == sorted(r.c for r in narrow.collect()) == list(range(50))
