"""Files, shuffles and passes that must not multiply with the batches."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import evaluate, models, rules
from tidewatch.queries import learning, modeling
from tidewatch.roles import Roles
from tidewatch.sources import commits, sinks
from tidewatch.sources.tables import FIXTURE
from tidewatch.streaming import landing


def files(path) -> int:
    return len(list(Path(path).rglob("part-*")))


@pytest.fixture(scope="module")
def scattered(spark):
    """Forty batches, each with rows in all of eight partitions."""
    return spark.range(2000).select((F.col("id") % 40).alias("batch_num"), "id").repartition(8, "id")


def test_batches_have_few_files_however_many_tasks_held_them(spark, scattered, tmp_path):
    sinks.write_batches(scattered, f"{tmp_path}/raw", keys=["batch_num"])
    sinks.write_analyzed(scattered, f"{tmp_path}/analyzed", FIXTURE)
    landing.land(scattered, f"{tmp_path}/landed", "batch_num", 0)
    for name in ("raw", "analyzed", "landed"):
        assert files(tmp_path / name) <= 42
        back = spark.read.parquet(f"{tmp_path}/{name}").selectExpr("cast(batch_num as bigint) batch_num", "id")
        assert back.exceptAll(scattered).isEmpty() and back.count() == 2000


def test_a_huge_batch_is_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_IN_TASK", 250)
    rows = spark.range(3000).select(F.when(F.col("id") < 2900, 1).otherwise(F.col("id")).alias("batch_num"), F.lit("same").alias("v"))
    sizes = [r["count"] for r in sinks.gathered(rows, ["batch_num"]).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 600 and sum(sizes) == 3000


def test_a_run_has_no_folder_per_batch_and_old_runs_are_read(spark, scattered, tmp_path):
    root = str(tmp_path)
    batches = scattered.select("batch_num").distinct()
    scattered.withColumn("v", F.lit("old")).write.partitionBy("batch_num").parquet(f"{root}/a/run=1")
    batches.coalesce(1).write.parquet(f"{root}/committed/run=1")
    some = scattered.where("batch_num < 30").withColumn("v", F.lit("new"))
    assert commits.write_run({"a": some}, some.select("batch_num").distinct(), root, ["batch_num"]) == 2
    assert files(tmp_path / "a/run=2") <= 8
    found = commits.read_committed(spark, root, "a").groupBy("v").agg(F.countDistinct("batch_num").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    assert sorted(tuple(r) for r in found) == [("new", 30, 1500), ("old", 10, 500)]


def test_sets_of_small_batches_are_grown_in_their_tasks(spark, policies, monkeypatch):
    found = rules.baskets(policies, FIXTURE)
    plain = lambda sets: sorted((r.batch_num, tuple(r.itemset), r.n, r.n_rows) for r in sets.collect())
    levels = plain(rules.itemsets(found, FIXTURE, 0.05, in_task=0))
    mixed = plain(rules.itemsets(found, FIXTURE, 0.05, in_task=found.groupBy("batch_num").count().agg(F.max("count")).first()[0] - 1))
    monkeypatch.setattr(rules, "BLOCK", 3)
    monkeypatch.setattr(rules, "_grown", None)
    assert plain(rules.itemsets(found, FIXTURE, 0.05)) == levels == mixed
    assert len(levels) > 100 and rules.itemsets(found.limit(0), FIXTURE, 0.05).isEmpty()
    whole = found.where("batch_num = 1").drop("batch_num")
    assert rules.itemsets(whole, Roles(), 0.05).count() == sum(r[0] == 1 for r in levels)


def test_scores_are_read_once_by_all_metrics(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(i):
        seen.add(1)
        return i % 7 / 7

    rows = spark.range(70).select((F.col("id") % 2).alias("label"), (F.col("id") % 3 % 2).cast("double").alias("prediction"), score("id").alias("score"))
    assert evaluate.evaluate(rows).first()["n"] == 70 and seen.value == 70


def test_attribution_scores_each_set_of_features_once_a_row(spark, policies, monkeypatch):
    ready = models.labelled(policies, FIXTURE, models.fit_features(policies, FIXTURE)).limit(20).localCheckpoint()
    names = models.feature_names(FIXTURE, policies.columns)
    model = models.estimator(models.TREE, len(names), maxDepth=4).fit(models.labelled(policies, FIXTURE, models.fit_features(policies, FIXTURE)))
    rows = []
    real = models.score

    def counted(df, fitted):
        rows.append(df.count())
        return real(df, fitted)

    monkeypatch.setattr(models, "score", counted)
    found = models.shapley(ready, model, names, "object_id").groupBy("object_id").agg(F.sum("shapley").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    assert 0 < rows[0] < 20 * 16 * (len(names) + 1)
    whole = {r["object_id"]: r["score"] for r in real(ready, model).collect()}
    none = real(ready.limit(1).withColumn("features", F.expr("features")).select(models.array_to_vector(F.array(*[F.lit(0.0)] * len(names))).alias("features")), model).first()["score"]
    assert all(r["n"] == len(names) and r["s"] == pytest.approx(whole[r["object_id"]] - none) for r in found) and len(found) == 20


def test_policies_are_built_once_a_query(spark, folder, monkeypatch):
    calls = []
    for module in (learning, modeling):
        real = module.stored_policies
        monkeypatch.setattr(module, "stored_policies", lambda *a, real=real: calls.append(1) or real(*a))
    monkeypatch.setattr(learning, "policies", None)
    assert learning.choose_model(spark, folder).count() > 0 and len(calls) == 1
    assert modeling.grown_forest(spark, folder).count() > 0 and len(calls) == 2
