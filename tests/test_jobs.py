import pytest
from pyspark.sql import functions as F

from tidewatch.operators import models, quality
from tidewatch.operators.profile import batch_profile
from tidewatch.operators.registry import Registry
from tidewatch.plans import jobs
from tidewatch.roles import POLICY, POLICY_COLUMNS
from tidewatch.sources import batching, files, sinks
from tidewatch.sources.tables import FIXTURE, table
from tidewatch.streaming import monitor


@pytest.fixture(scope="module")
def policy_files(spark, folder, tmp_path_factory):
    """Two CSV files in the policy layout with text dates."""
    root = tmp_path_factory.mktemp("policies")
    orders = table(spark, folder, "orders").where("o_orderkey < 600")
    day = F.upper(F.date_format("o_orderdate", "dd-MMM-yy"))
    made = {
        "SEX": F.col("o_custkey") % 3, "INSR_BEGIN": day, "INSR_END": F.upper(F.date_format(F.date_add("o_orderdate", 365), "dd-MMM-yy")),
        "INSR_TYPE": F.element_at(F.array(F.lit(1201), F.lit(1202), F.lit(1204)), (F.col("o_custkey") % 3 + 1).cast("int")),
        "INSURED_VALUE": F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice")), "PREMIUM": F.round(F.col("o_totalprice") / 100, 2),
        "OBJECT_ID": F.col("o_orderkey"), "PROD_YEAR": F.year("o_orderdate"), "SEATS_NUM": F.col("o_orderkey") % 9,
        "CARRYING_CAPACITY": F.lit(None).cast("int"), "TYPE_VEHICLE": F.col("o_orderpriority"), "CCM_TON": F.col("o_custkey"),
        "MAKE": F.col("o_orderstatus"), "USAGE": F.lit("Own"), "CLAIM_PAID": F.when(F.col("o_orderkey") % 4 == 0, F.col("o_totalprice")),
    }
    rows = orders.select(*[e.cast("string").alias(c) for c, e in made.items()], "o_orderkey").toPandas().sort_values("o_orderkey")
    for i, part in enumerate((rows[rows.o_orderkey < 350], rows[rows.o_orderkey >= 350])):
        part[list(POLICY_COLUMNS)].to_csv(root / f"part{i}.csv", index=False)
    return root


def test_sources_are_cut_in_file_order(spark, policy_files):
    paths = [f"{policy_files}/part0.csv", f"{policy_files}/missing.csv", f"{policy_files}/part1.csv"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = files.read_sources(spark, paths, 100).cache()
        assert rows.count() == 600
        info = batching.batch_info(rows, 100, [paths[0], paths[2]]).orderBy("batch_num").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r["batch_num"], r["batch_index"], r["total_batches"], r["start_row"], r["end_row"]) for r in info] == [
        (1, 1, 4, 0, 100), (2, 2, 4, 100, 200), (3, 3, 4, 200, 300), (4, 4, 4, 300, 350), (5, 1, 3, 0, 100), (6, 2, 3, 100, 200), (7, 3, 3, 200, 250),
    ]
    wrong = rows.where((F.col("source") == paths[0]) & (F.col("row_index") != F.col("OBJECT_ID").cast("bigint")))
    assert wrong.count() == 0


def test_policy_folder_is_typed(spark, policy_files):
    typed = files.typed_policies(files.read_policy_folder(spark, str(policy_files)))
    assert typed.count() == 600 and typed.where("INSR_BEGIN is null or INSR_END is null").count() == 0
    metrics = quality.dq_metrics(typed, POLICY).first()
    assert metrics["bad_date_ratio"] == 0 and metrics["missing_per_column"]["CARRYING_CAPACITY"] == 1.0
    with pytest.raises(FileNotFoundError):
        files.read_policy_folder(spark, "/tmp/no-such-folder")


def test_collect_and_stored_batches(spark, policy_files, tmp_path):
    store = jobs.Store(str(tmp_path))
    profile = jobs.collect(spark, [f"{policy_files}/part0.csv", f"{policy_files}/part1.csv"], store, POLICY, 200)
    assert [r["total_rows"] for r in profile.orderBy("batch_num").collect()] == [200, 150, 200, 50]
    assert spark.read.parquet(store.profiles).count() == 4 * 15
    assert files.storage_volume(spark, store.raw, "*.parquet").first()["files"] == 4
    replay = files.read_stored_batches(spark, str(policy_files))
    assert {r["batch_num"]: r["count"] for r in replay.groupBy("batch_num").count().collect()} == {1: 350, 2: 250}


def test_analysis_can_be_repeated(spark, policies, tmp_path):
    store = jobs.Store(str(tmp_path))
    some = policies.where("batch_num <= 3")
    jobs.run_analysis(some, store, FIXTURE)
    first = spark.read.parquet(f"{store.rules}/reference").count()
    jobs.run_analysis(some, store, FIXTURE)
    assert spark.read.json(store.dq).count() == 3 and spark.read.json(store.drift).count() == 3
    assert spark.read.parquet(f"{store.rules}/reference").count() == first == 5
    assert spark.read.parquet(store.analyzed).count() > 0


def test_pipeline_inference_and_summary(spark, policy_files, tmp_path):
    store = jobs.Store(str(tmp_path))
    sources = [f"{policy_files}/part0.csv", f"{policy_files}/part1.csv"]
    rows = files.typed_policies(files.read_sources(spark, sources, 150).drop("source", "row_index", "batch_index"))
    grids = {models.TREE: {"maxDepth": [3]}}
    history = jobs.run_pipeline(rows, POLICY, store, initial=2, update_every=2, names=[models.TREE], grids=grids)
    assert sorted(r["batch_num"] for r in history.collect()) == [3, 4, 5]
    assert Registry(spark, store.registry).versions().count() == 2
    scored = jobs.run_inference(spark, sources[1], store.scored, POLICY, store)
    back = spark.read.option("header", True).csv(store.scored)
    assert back.count() == scored.count() == 250 and "predict" in back.columns and set(POLICY_COLUMNS) <= set(back.columns)
    report = jobs.run_summary(spark, store, POLICY).first()["report"]
    for section in ("model_metrics", "data_quality", "performance", "drift", "hyperparameters"):
        assert f'"{section}"' in report


def test_stream_equals_batch(spark, policies, tmp_path):
    landing = f"{tmp_path}/landing"
    policies.repartition(5).write.parquet(landing)
    stream = monitor.stream_parquet(spark, landing, policies.schema, files_per_trigger=2)
    monitor.profile_stream(stream, FIXTURE, f"{tmp_path}/reports", f"{tmp_path}/offsets").awaitTermination()
    found = spark.read.json(f"{tmp_path}/reports").collect()
    want = batch_profile(policies, FIXTURE).collect()
    key = lambda r: (r["batch_num"], r["total_rows"], round(r["data_quality"], 9))
    assert sorted(map(key, found)) == sorted(map(key, want))


def test_monitor_stream_writes_every_batch(spark, policies, tmp_path):
    store = jobs.Store(f"{tmp_path}/store")
    landing = f"{tmp_path}/landing"
    for n in (1, 2):
        policies.where(F.col("batch_num") == n).coalesce(1).write.mode("append").parquet(landing)
    stream = monitor.stream_parquet(spark, landing, policies.schema)
    monitor.monitor(stream, store, FIXTURE, f"{tmp_path}/offsets").awaitTermination()
    reports = spark.read.json(store.dq).select("batch_num", "before.n_rows").collect()
    assert sorted((r["batch_num"], r["n_rows"]) for r in reports) == [(1, 250), (2, 250)]
    whole = quality.dq_report(policies.where("batch_num <= 2"), FIXTURE).selectExpr("batch_num", "round(after.missing_total_ratio, 9) m").collect()
    again = spark.read.json(store.dq).selectExpr("batch_num", "round(after.missing_total_ratio, 9) m").collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, again))


def test_rule_files_have_a_header_even_when_empty(spark, tmp_path):
    empty = spark.createDataFrame([], sinks.RULE_SCHEMA)
    sinks.write_rules(empty.repartition(1), f"{tmp_path}/rules", FIXTURE)
    lines = spark.read.text(f"{tmp_path}/rules").collect()
    assert [r[0] for r in lines] == ["support,confidence,lift,antecedents_str,consequents_str"]


def test_replay_keeps_every_file_and_its_own_header(spark, tmp_path):
    (tmp_path / "a b.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "c.csv").write_text("y,x\n20,10\n")
    (tmp_path / "d%20+é.csv").write_text("z\n7\n")
    (tmp_path / "e.csv").write_text("")
    got = sorted(files.read_stored_batches(spark, str(tmp_path)).select("batch_num", "x", "y", "z").collect(), key=str)
    assert [tuple(r) for r in got] == [(1, "1", "2", None), (1, "3", "4", None), (2, "10", "20", None), (3, None, None, "7")]


def test_collecting_twice_keeps_what_was_stored(spark, policy_files, tmp_path):
    store = jobs.Store(str(tmp_path))
    first = jobs.collect(spark, [f"{policy_files}/part0.csv"], store, POLICY, 200)
    second = jobs.collect(spark, [f"{policy_files}/part1.csv"], store, POLICY, 200)
    assert [r["batch_num"] for r in first.orderBy("batch_num").collect()] == [1, 2]
    assert [r["batch_num"] for r in second.orderBy("batch_num").collect()] == [3, 4]
    stored = spark.read.parquet(store.raw).groupBy("batch_num").count().orderBy("batch_num").collect()
    assert [tuple(r) for r in stored] == [(1, 200), (2, 150), (3, 200), (4, 50)]
    assert spark.read.parquet(store.profiles).select("batch_num").distinct().count() == 4


def test_versions_grow_and_a_retry_adds_nothing(spark, policies, tmp_path):
    registry = Registry(spark, str(tmp_path))
    part = lambda n: policies.where(F.col("batch_num") == n)
    grids = {models.FOREST: {"numTrees": [3], "maxDepth": [3]}}
    with pytest.raises(LookupError):
        jobs.update_model(part(1), FIXTURE, registry)
    jobs.train_models(part(1), FIXTURE, registry, [models.FOREST], grids)
    for n in (2, 3, 3):
        jobs.update_model(part(n), FIXTURE, registry, models.FOREST, batch_id=n)
    rows = registry.versions().orderBy("version").collect()
    assert [(r.version, r.parent_version, r.is_incremental, r.batch_id) for r in rows] == [(1, None, False, None), (2, 1, True, 2), (3, 2, True, 3)]
    assert [len(r.members) for r in rows] == [1, 2, 3] and rows[2].members[:2] == rows[1].members
    ready = models.labelled(part(3), FIXTURE, registry.load(models.FOREST, 1)[0])
    for version in (1, 2, 3):
        assert models.score(ready, registry.load(models.FOREST, version)[1].model).count() == ready.count()


def test_history_by_reigns_equals_the_loop(spark, policies, tmp_path):
    from tidewatch.operators.evaluate import batch_performance
    from tidewatch.operators.features import LABEL, add_label

    store = jobs.Store(str(tmp_path))
    registry = Registry(spark, store.registry)
    rows = policies.withColumn("batch_num", F.col("object_id") % 8 * 3)
    batch = F.col("batch_num")
    grids = {models.TREE: {"maxDepth": [3]}}
    with pytest.raises(LookupError):
        jobs.follow(rows, FIXTURE, registry, store)
    jobs.train_models(rows.where(batch <= 3), FIXTURE, registry, [models.TREE], grids, batch_id=3)
    features, trained, _ = registry.load(models.TREE, 1)
    wanted = {}
    for window, better in (((6, 9), True), ((12, 15), False), ((18,), True), ((21,), True)):
        for number in window:
            scored = add_label(jobs.score_batches(rows.where(batch == number), FIXTURE, registry), FIXTURE)
            row = batch_performance(scored, ["batch_num"], LABEL).first()
            wanted[number] = (registry.champion()["version"], row["accuracy"], row["f1"])
        refitted = models.update(models.Trained(models.TREE, trained.model, {"maxDepth": 1 + len(wanted)}), models.labelled(rows.where(batch == window[-1]), FIXTURE, features))
        version = registry.register(features, refitted, {"f1": 2.0 * len(wanted)})
        assert registry.promote(models.TREE, version, {"f1": 2.0 * len(wanted) if better else 0.0}, after=window[-1]) is better
    later = rows.where(batch > 3)
    versions = {r["batch_num"]: r["version"] for r in jobs.reigning(later, FIXTURE, registry).collect()}
    found = {r["batch_num"]: (versions[r["batch_num"]], r["accuracy"], r["f1"]) for r in jobs.follow(later, FIXTURE, registry, store).collect()}
    assert found.keys() == wanted.keys() and len({v for v, *_ in wanted.values()}) == 3
    assert all(found[n] == pytest.approx(wanted[n]) for n in wanted)
    assert jobs.follow(rows.limit(0), FIXTURE, registry, store).count() == 0


def test_newest_batches_read_only_their_folders(spark, tmp_path):
    path = str(tmp_path / "reports")
    for n in (12, 40):
        rows = spark.range(n).select((F.col("id") - 2).alias("batch_num"), F.struct((F.col("id") * 2).alias("twice")).alias("part"))
        sinks.write_reports(rows, path, FIXTURE)
        found = sinks.read_newest(spark, path, FIXTURE, 10)
        assert [r["batch_num"] for r in found.orderBy("batch_num").collect()] == list(range(n - 12, n - 2)) and len(found.inputFiles()) == 10
    assert sinks.read_newest(spark, str(tmp_path / "absent"), FIXTURE, schema="batch_num long").count() == 0
