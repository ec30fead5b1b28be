"""Queries that train models, run jobs or run a stream. Trees differ between engines, so most have no SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import evaluate as ev
from tidewatch.operators import forests, models
from tidewatch.operators.features import LABEL, add_label, stratified_split
from tidewatch.operators.registry import Registry
from tidewatch.operators.text_codes import TextCodes, TextCodesModel
from tidewatch.plans import jobs, report
from tidewatch.queries import sql
from tidewatch.queries.mining import RULE
from tidewatch.queries.registry import query, rounded
from tidewatch.queries.tables import ALL, DQ_SQL, dq_columns
from tidewatch.session import materialize, scratch_folder
from tidewatch.sources import checked, files, sinks
from tidewatch.sources.tables import BATCH_ROWS, FIXTURE, stored_policies
from tidewatch.streaming import landing, monitor

# Small settings: the queries show the operators, they do not search for a good model.
SMALL = {
    models.TREE: {"maxDepth": 5},
    models.FOREST: {"maxDepth": 5, "numTrees": 10},
    models.NETWORK: {"hidden": [8], "maxIter": 20},
}


def _ready(spark: SparkSession, folder: str, rows: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Training and test rows with features, label and weight. ``rows`` are the stored policies, if the caller has them."""
    rows = stored_policies(spark, folder) if rows is None else rows
    split = materialize(stratified_split(add_label(rows, FIXTURE), "object_id", LABEL))
    features = models.fit_features(split.where("not is_test"), FIXTURE)
    return (
        materialize(models.labelled(split.where("not is_test"), FIXTURE, features)),
        materialize(models.labelled(split.where("is_test"), FIXTURE, features)),
    )


def _names() -> list[str]:
    return models.feature_names(FIXTURE, sql.COLUMNS)


def _fit(train: DataFrame, name: str):
    return models.estimator(name, len(_names()), **SMALL[name]).fit(train)


@query("train_models")
def train_models(spark: SparkSession, folder: str) -> DataFrame:
    """All three classifiers: test metrics and whether each is the best."""
    train, test = _ready(spark, folder)
    scored = None
    for ordinal, name in enumerate(models.MODEL_NAMES):
        part = models.score(test, _fit(train, name)).select(F.lit(name).alias("model_name"), F.lit(ordinal).alias("ordinal"), "label", "prediction", "score")
        scored = part if scored is None else scored.unionByName(part)
    metrics = materialize(ev.evaluate(scored, by=["model_name", "ordinal"]))
    best = metrics.agg(F.min_by("model_name", F.struct((-F.col("roc_auc")).alias("a"), F.col("ordinal"))).alias("b")).scalar()
    return metrics.withColumn("best", F.col("model_name") == best)


@query("cross_validation")
def cross_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Stratified three-fold search over two tree depths."""
    train, test = _ready(spark, folder)
    found = models.train(train, models.TREE, {"maxDepth": [3, 5], "minInstancesPerNode": [2, 4]}, "object_id")
    chosen = {f"best_{k}": F.lit(v) for k, v in found.params.items()} | {"cv_roc_auc": F.lit(found.cv_score)}
    return ev.evaluate(models.score(test, found.model)).withColumns(chosen)


@query("incremental_update")
def incremental_update(spark: SparkSession, folder: str) -> DataFrame:
    """Every classifier before and after going on with later batches, on held-out rows."""
    train, test = _ready(spark, folder)
    middle = train.agg(F.percentile_approx("batch_num", 0.5)).first()[0]
    early, late = train.where(F.col("batch_num") <= middle), train.where(F.col("batch_num") > middle)
    held = test.where(F.col("batch_num") > middle)
    scored = None
    for name in models.MODEL_NAMES:
        first = models.Trained(name, _fit(early, name), SMALL[name] if name != models.NETWORK else {})
        for stage, model in (("before", first.model), ("after", models.update(first, late).model)):
            part = models.score(held, model).select(F.lit(name).alias("model_name"), F.lit(stage).alias("stage"), "label", "prediction", "score")
            scored = part if scored is None else scored.unionByName(part)
    return ev.evaluate(scored, by=["model_name", "stage"])


@query(
    "grown_forest",
    f"""WITH {sql.POLICIES} SELECT batch_num, count(*) AS n_rows, 30::INTEGER AS trees, 20::INTEGER AS aged_trees, 0::DOUBLE AS largest_difference
    FROM policies GROUP BY 1""",
)
def grown_forest(spark: SparkSession, folder: str) -> DataFrame:
    """A forest grown by two updates, as one model: its score of every row is the mean of its parts' scores. Aged to 20 trees besides."""
    stored = stored_policies(spark, folder)
    train, _ = _ready(spark, folder, stored)
    thirds = [train.where(F.pmod(F.xxhash64("object_id"), F.lit(3)) == i) for i in range(3)]
    trained = models.Trained(models.FOREST, _fit(thirds[0], models.FOREST), SMALL[models.FOREST])
    for part in thirds[1:]:
        trained = models.update(trained, part)
    rows = models.fit_features(stored, FIXTURE).transform(stored).select("batch_num", "features")
    scored = models.score(rows, trained.model).withColumnRenamed("score", "merged").drop("prediction")
    for i, member in enumerate(trained.model.members):
        scored = models.score(scored, member).withColumnRenamed("score", f"part{i}").drop("prediction")
    apart = F.abs(F.col("merged") - (F.col("part0") + F.col("part1") + F.col("part2")) / 3)
    aged = forests.Ensemble(trained.model.members, max_trees=20)
    return scored.groupBy("batch_num").agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(trained.model.getNumTrees).alias("trees"), F.lit(aged.getNumTrees).alias("aged_trees"),
        F.round(F.max(apart), 9).alias("largest_difference"),
    )


@query(
    "text_codes",
    f"""WITH {sql.POLICIES}, known AS (SELECT make, row_number() OVER (ORDER BY make) - 1 AS code FROM policies WHERE batch_num % 2 = 1 AND make IS NOT NULL GROUP BY 1)
    SELECT object_id, coalesce(code, (SELECT count(*) FROM known))::DOUBLE AS make_code FROM (SELECT object_id, make || CASE WHEN object_id % 10 = 0 THEN '?' ELSE '' END AS make FROM policies) LEFT JOIN known USING (make)""",
)
def text_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes fitted on the odd batches, saved, loaded again, and given to all rows, of which every tenth id has a text unseen before."""
    root, rows = scratch_folder(spark), stored_policies(spark, folder)
    TextCodes(inputCols=["make"], outputCols=["make_code"]).fit(rows.where("batch_num % 2 = 1")).save(f"{root}/codes")
    asked = rows.select("object_id", F.concat("make", F.when(F.col("object_id") % 10 == 0, "?").otherwise("")).alias("make"))
    return TextCodesModel.load(f"{root}/codes").transform(asked).select("object_id", "make_code")


@query("feature_importance")
def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = _ready(spark, folder)
    return models.importances(_fit(train, models.FOREST), _names(), spark, 10)


@query("shapley")
def shapley(spark: SparkSession, folder: str) -> DataFrame:
    """Mean absolute attribution per feature over all test rows."""
    train, test = _ready(spark, folder)
    found = models.shapley(test, _fit(train, models.FOREST), _names(), "object_id")
    return found.groupBy("feature").agg(F.avg(F.abs("shapley")).alias("mean_abs_shapley"), F.count(F.lit(1)).alias("rows"))


@query("score_batches")
def score_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Train on the first batches, register, then score the later ones with the champion, per batch."""
    rows = stored_policies(spark, folder)
    registry = Registry(spark, scratch_folder(spark))
    grids = {models.TREE: {"maxDepth": [4]}}
    jobs.train_models(rows.where("batch_num <= 3"), FIXTURE, registry, [models.TREE], grids)
    scored = jobs.score_batches(rows.where("batch_num > 3"), FIXTURE, registry)
    return ev.batch_performance(add_label(scored, FIXTURE), ["batch_num"], LABEL)


@query(
    "stream_profile",
    f"""WITH {sql.POLICIES} SELECT batch_num, count(*) AS total_rows, 13::BIGINT AS columns_count,
    round(1 - ({sql.NULL_CELLS})::DOUBLE / (count(*) * 13), 6) AS data_quality FROM policies GROUP BY 1""",
)
def stream_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Land the rows as files, profile them as a stream, read the reports back."""
    root = scratch_folder(spark)
    stored = stored_policies(spark, folder)
    sinks.gathered(stored, ["batch_num"]).write.parquet(f"{root}/landing")
    stream = monitor.stream_parquet(spark, f"{root}/landing", stored.schema, files_per_trigger=4)
    monitor.profile_stream(stream, FIXTURE, f"{root}/reports", f"{root}/offsets").awaitTermination()
    found = spark.read.schema("batch_num long, total_rows long, columns_count long, data_quality double").json(f"{root}/reports")
    return rounded(found, "data_quality")


@query(
    "csv_batches",
    """SELECT o_orderkey // 1000 + 1 AS batch_num, count(*) AS n_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY 1""",
)
def csv_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Write one large CSV source in key order, read it back, and cut it into batches by file order."""
    root = scratch_folder(spark)
    rows = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_totalprice").repartitionByRange("o_orderkey")
    rows.sortWithinPartitions("o_orderkey").write.option("header", True).csv(f"{root}/orders")
    found = files.read_sources(spark, [f"{root}/orders", f"{root}/absent"], BATCH_ROWS)
    key = F.col("o_orderkey").cast("bigint")
    return found.groupBy("batch_num").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.round(F.sum(F.col("o_totalprice").cast("double")), 2).alias("total")
    )


@query(
    "stored_batches",
    f"WITH {sql.POLICIES} SELECT batch_num, count(*) AS n_rows, count(insr_end) AS with_end, round(sum(premium), 2) AS premium FROM policies GROUP BY 1",
)
def stored_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Write the raw batches as partitioned files and read them back."""
    root = scratch_folder(spark)
    sinks.write_batches(stored_policies(spark, folder), f"{root}/raw", keys=["batch_num"])
    return _batch_sums(spark, f"{root}/raw")


def _batch_sums(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.parquet(path).withColumn("batch_num", F.col("batch_num").cast("bigint"))
    return stored.groupBy("batch_num").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("insr_end").alias("with_end"), F.round(F.sum("premium"), 2).alias("premium")
    )


@query(
    "collected_twice",
    f"WITH {sql.POLICIES} SELECT batch_num, count(*) AS n_rows, count(insr_end) AS with_end, round(sum(premium), 2) AS premium FROM policies GROUP BY 1",
)
def collected_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Write the odd batches, then the even ones, then the odd ones again: nothing is lost or doubled."""
    root = scratch_folder(spark)
    rows = stored_policies(spark, folder)
    for rest in (1, 0, 1):
        sinks.write_batches(rows.where(F.col("batch_num") % 2 == rest), f"{root}/raw", keys=["batch_num"])
    return _batch_sums(spark, f"{root}/raw")


@query(
    "replayed_files",
    f"""WITH {sql.POLICIES} SELECT make, count(*) AS n_rows, sum(object_id)::BIGINT AS ids, sum(CASE WHEN batch_num % 2 = 0 THEN prod_year END)::BIGINT AS years,
    round(sum(CASE WHEN batch_num % 2 = 1 THEN premium END), 2) AS premium FROM policies GROUP BY 1""",
)
def replayed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Raw files with two different headers in one folder, replayed each under its own names."""
    root = scratch_folder(spark)
    rows = stored_policies(spark, folder)
    headers = {1: ("object_id", "premium", "make"), 0: ("make", "prod_year", "object_id")}
    for rest, columns in headers.items():
        part = rows.where(F.col("batch_num") % 2 == rest).select(*columns)
        part.write.mode("append").option("header", True).csv(f"{root}/raw")
    found = files.read_stored_batches(spark, f"{root}/raw")
    return found.groupBy("make").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("object_id").cast("bigint")).alias("ids"), F.sum(F.col("prod_year").cast("bigint")).alias("years"),
        F.round(F.sum(F.col("premium").cast("double")), 2).alias("premium"),
    )


@query(
    "registry_versions",
    f"""WITH {sql.POLICIES}, b AS (SELECT DISTINCT object_id % 4 + 1 AS batch_num FROM policies WHERE object_id % 4 > 0)
    SELECT 'RandomForest' AS model_name, (batch_num - 1)::INTEGER AS version, CASE WHEN batch_num > 2 THEN (batch_num - 2)::INTEGER END AS parent_version,
    batch_num > 2 AS is_incremental, batch_num AS batch_id, (batch_num - 1)::INTEGER AS members FROM b""",
)
def registry_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Train on two quarters, update on the other two, repeat the last update: versions, parents and saved members."""
    rows = stored_policies(spark, folder).withColumn("batch_num", F.col("object_id") % 4 + 1)
    registry = Registry(spark, scratch_folder(spark))
    jobs.train_models(rows.where("batch_num <= 2"), FIXTURE, registry, [models.FOREST], {models.FOREST: {"numTrees": [10], "maxDepth": [5]}}, batch_id=2)
    for number in (3, 4, 4):
        jobs.update_model(rows.where(F.col("batch_num") == number), FIXTURE, registry, models.FOREST, batch_id=number)
    return registry.versions().select("model_name", "version", "parent_version", "is_incremental", "batch_id", F.size("members").alias("members"))


@query(
    "analysis_reports",
    f"""WITH {sql.VERDICT} SELECT batch_num, drift_detected, affected, quality_issues FROM verdict WHERE batch_num > 1""",
)
def analysis_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Run the whole analysis job into a store and read its drift reports of the later batches."""
    store = jobs.Store(scratch_folder(spark))
    rows = stored_policies(spark, folder)
    jobs.run_analysis(rows, store, FIXTURE)
    found = spark.read.schema(jobs.DRIFT_SCHEMA).json(store.drift).where("batch_num > 1")
    names = F.array_join(F.array_sort("affected_features.feature"), ",")
    return found.select("batch_num", "drift_detected", names.alias("affected"), "quality_issues")


# Rows of both halves of a file of the split stream.
FILE_ROWS = 500_000


def _split_store(spark: SparkSession, folder: str) -> jobs.Store:
    """All batches as a stream of two micro-batches whose every file holds a part of most batches, so each comes in both."""
    store = jobs.Store(scratch_folder(spark))
    rows = stored_policies(spark, folder, packed=True)
    files_each = -(-rows.count() // FILE_ROWS) or 1
    for rest in (0, 1):
        rows.where(F.pmod(F.xxhash64("object_id"), F.lit(2)) == rest).repartition(files_each).write.mode("append").parquet(f"{store.root}/files")
    stream = monitor.stream_parquet(spark, f"{store.root}/files", rows.schema, files_each)
    monitor.monitor(stream, store, FIXTURE, f"{store.root}/offsets").awaitTermination()
    return store


@query(
    "monitor_split",
    f"""WITH {sql.VERDICT} SELECT v.batch_num, p.n_rows, drift_detected, affected, quality_issues
    FROM verdict v JOIN (SELECT batch_num, count(*) AS n_rows FROM policies GROUP BY 1) p USING (batch_num) WHERE v.batch_num > 1""",
)
def monitor_split(spark: SparkSession, folder: str) -> DataFrame:
    """Drift reports of batches that were split over micro-batches: those of the whole batches."""
    store = _split_store(spark, folder)
    names = F.array_join(F.array_sort("affected_features.feature"), ",")
    found = jobs.read_reports(spark, store, "drift", FIXTURE).where("batch_num > 1")
    sizes = jobs.read_reports(spark, store, "dq", FIXTURE).select("batch_num", F.col("before.n_rows").cast("bigint").alias("n_rows"))
    return found.drop("n_rows").join(sizes, "batch_num").select("batch_num", "n_rows", "drift_detected", names.alias("affected"), "quality_issues")


def _analysed_store(spark: SparkSession, folder: str) -> jobs.Store:
    """A store after two runs over the odd and one over all batches; the last committed run of a batch counts."""
    store = jobs.Store(scratch_folder(spark))
    rows = stored_policies(spark, folder, packed=True)
    jobs.run_analysis(rows.where("batch_num % 2 = 1"), store, FIXTURE)
    jobs.run_analysis(rows, store, FIXTURE)
    return store


@query("stored_dq_reports", DQ_SQL)
def stored_dq_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Quality before and after cleaning, read back from the committed reports of repeated runs."""
    return dq_columns(jobs.read_reports(spark, _analysed_store(spark, folder), "dq", FIXTURE))


@query(
    "stored_rules",
    f"WITH {sql.POLICIES}, {sql.CLEANED}, {sql.mining('cleaned')}, {sql.itemsets(0.03)}, {sql.coded_rules(0.4, 1.05)}, {sql.top()} SELECT batch_num, {RULE} FROM best",
)
def stored_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules of the cleaned batches, read back from the committed reports of repeated runs."""
    found = jobs.read_reports(spark, _analysed_store(spark, folder), "rules", FIXTURE)
    return rounded(found, "support", "confidence", "lift").select("batch_num", "support", "confidence", "lift", "antecedents_str", "consequents_str")


@query("stored_cleaned", f"WITH {sql.POLICIES}, {sql.CLEANED} SELECT {ALL} FROM (SELECT * REPLACE (round(premium, 6) AS premium) FROM cleaned)")
def stored_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned rows, read back from the committed rows of repeated runs."""
    found = jobs.read_reports(spark, _analysed_store(spark, folder), "analyzed", FIXTURE)
    return rounded(found, "premium").select("batch_num", *sql.COLUMNS)


@query(
    "stream_batches",
    """WITH sized AS (SELECT k, count(*) AS n FROM (SELECT o_orderkey % 3 AS k FROM orders) GROUP BY 1),
    offsets AS (SELECT k, coalesce(sum(ceil(n / 400)) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized),
    rows AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey % 3 ORDER BY o_orderkey) - 1 AS place FROM orders)
    SELECT CAST(before + place // 400 + 1 AS BIGINT) AS batch_num, count(*) AS n_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,
    round(sum(o_totalprice), 2) AS total FROM rows JOIN offsets ON o_orderkey % 3 = k GROUP BY 1""",
)
def stream_batches(spark: SparkSession, folder: str) -> DataFrame:
    """A stream over three CSV files, stopped after the first two and started again, cut into row batches."""
    root = scratch_folder(spark)
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_totalprice")
    for part, stop in ((0, False), (1, True), (2, True)):
        one = orders.where(F.col("o_orderkey") % 3 == part).repartitionByRange(1, "o_orderkey").sortWithinPartitions("o_orderkey")
        one.write.mode("append").option("header", True).csv(f"{root}/files")
        if stop:
            stream = landing.stream_positions(spark, f"{root}/files", ["o_orderkey", "o_totalprice"])
            landing.collect_stream(stream, 400, f"{root}/raw", f"{root}/ledger", f"{root}/offsets").awaitTermination()
    key = F.col("o_orderkey").cast("bigint")
    found = spark.read.parquet(f"{root}/raw")
    return found.groupBy(F.col("batch_num").cast("bigint").alias("batch_num")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.round(F.sum(F.col("o_totalprice").cast("double")), 2).alias("total")
    )


@query(
    "checked_files",
    f"""WITH {sql.POLICIES}, f AS (SELECT object_id % 4 AS part, count(*) AS n FROM policies GROUP BY 1)
    SELECT CASE part WHEN 0 THEN 'plain' WHEN 1 THEN 'packed' WHEN 2 THEN 'cut' ELSE 'binary' END AS kind, CASE WHEN part < 2 THEN n ELSE 0 END::BIGINT AS rows,
    0::BIGINT AS bad_records, part > 1 AS skipped, CASE part WHEN 2 THEN 'cannot be unpacked: EOFError' WHEN 3 THEN 'not UTF-8 text' END AS why FROM f
    UNION ALL SELECT 'all rows read', count(*), 0, false, NULL FROM policies WHERE object_id % 4 < 2""",
)
def checked_files(spark: SparkSession, folder: str) -> DataFrame:
    """Quarters of the rows as a plain, a packed, a cut off and a binary file in one folder: outcome by file, and the rows read."""
    root = scratch_folder(spark)
    rows = stored_policies(spark, folder).select("object_id", "premium", "make")
    for part, (kind, ending) in enumerate((("plain", "csv"), ("packed", "csv.gz"), ("cut", "csv.gz"), ("binary", "csv"))):
        one = rows.where(F.col("object_id") % 4 == part).coalesce(1).write.option("header", True)
        one.parquet(f"{root}/{kind}") if kind == "binary" else one.option("compression", "gzip" if ending == "csv.gz" else "none").csv(f"{root}/{kind}")
        _place(spark, f"{root}/{kind}", f"{root}/all/{kind}.{ending}", 0.6 if kind == "cut" else 1.0)
    read, outcome = checked.read_checked(spark, f"{root}/all", rows.columns)
    kind = F.regexp_extract("path", r"([a-z]+)\.csv", 1).alias("kind")
    whole = read.where("object_id is not null").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("all rows read").alias("kind"), "rows", F.lit(0).cast("bigint").alias("bad_records"), F.lit(False).alias("skipped"), F.lit(None).cast("string").alias("why")
    )
    return outcome.select(kind, "rows", "bad_records", "skipped", "why").unionByName(whole)


def _place(spark: SparkSession, source: str, target: str, share: float) -> None:
    """The one data file of a folder under another name, or the first ``share`` of its bytes."""
    from pyarrow import fs

    name = spark._jvm.org.apache.hadoop.fs.Path(f"{source}/part-*")
    found = name.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(name)[0]
    system, base = fs.FileSystem.from_uri(found.getPath().toUri().toString().replace("file:/", "file:///", 1))
    _, out = fs.FileSystem.from_uri(target.replace("file:/", "file:///", 1) if target.startswith("file:") else f"file://{target}" if target.startswith("/") else target)
    system.create_dir(out.rsplit("/", 1)[0], recursive=True)
    left = int(found.getLen() * share)
    with system.open_input_stream(base, compression=None) as read, system.open_output_stream(out, compression=None) as write:
        while left > 0 and (chunk := read.read(min(left, 1 << 20))):
            write.write(chunk)
            left -= len(chunk)


@query(
    "summary_drift",
    f"""WITH {sql.VERDICT}, last AS (SELECT * FROM verdict ORDER BY batch_num DESC LIMIT 10)
    SELECT max(batch_num) AS batch_number, arg_max(drift_detected, batch_num) AS drift_detected, coalesce(arg_max(coalesce(drift_type, 'none'), batch_num), 'none') AS drift_type,
    arg_max(n_affected, batch_num)::BIGINT AS affected, arg_max(quality_issues, batch_num) AS quality_issues, count(*) AS reports,
    count(CASE WHEN drift_detected THEN 1 END) AS with_drift, round(count(CASE WHEN drift_detected THEN 1 END)::DOUBLE / count(*), 6) AS drift_rate FROM last""",
)
def summary_drift(spark: SparkSession, folder: str) -> DataFrame:
    """The summary's drift section over the newest ten stored reports, whose folders alone are read."""
    store = jobs.Store(scratch_folder(spark))
    jobs.run_analysis(stored_policies(spark, folder), store, FIXTURE)
    found = report.drift_overview(sinks.read_newest(spark, store.drift, FIXTURE, schema=jobs.DRIFT_SCHEMA), FIXTURE)
    return rounded(found, "drift_rate").select(
        "batch_number", "drift_detected", "drift_type", F.col("affected_features_count").cast("bigint").alias("affected"), "quality_issues",
        F.col("total_drift_reports_analyzed").alias("reports"), F.col("batches_with_drift").alias("with_drift"), "drift_rate",
    )


@query(
    "summary_quality",
    DQ_SQL.replace("SELECT b.batch_num", "SELECT * FROM (SELECT b.batch_num", 1).replace("SELECT * FROM (", "SELECT batch_num AS batch_id, after_missing_total_ratio AS missing_total_ratio, "
    "after_duplicate_ratio AS duplicate_ratio, after_invalid_ratio AS invalid_ratio, after_n_rows AS total_rows, NOT after_any_issue AS data_quality_passed FROM (", 1)
    + ") ORDER BY batch_num DESC LIMIT 1",
)
def summary_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The summary's quality section: the newest stored report of the cleaned rows."""
    store = jobs.Store(scratch_folder(spark))
    jobs.run_analysis(stored_policies(spark, folder), store, FIXTURE)
    newest = [sinks.read_newest(spark, path, FIXTURE, 1) for path in (store.dq, store.consistency)]
    ratios = ("missing_total_ratio", "duplicate_ratio", "invalid_ratio")
    return rounded(report.latest_quality(*newest, FIXTURE), *ratios).select("batch_id", *ratios, "total_rows", "data_quality_passed")


@query(
    "pipeline_history",
    f"""WITH {sql.POLICIES} SELECT object_id % 8 + 1 AS batch_num, true AS metrics_in_range, true AS same_champion_same_scores
    FROM policies WHERE object_id % 8 >= 3 GROUP BY 1""",
)
def pipeline_history(spark: SparkSession, folder: str) -> DataFrame:
    """Eighths of the rows as batches: train on three, update once on two, score the last five. Each batch's history equals its own champion's scores of it.

    The update is promoted whatever its gain, so two champions reign.
    """
    store, batch, middle = jobs.Store(scratch_folder(spark)), F.col("batch_num"), 5
    registry = Registry(spark, store.registry)
    rows = stored_policies(spark, folder).withColumn("batch_num", F.col("object_id") % 8 + 1)
    grids = {models.FOREST: {"numTrees": [10], "maxDepth": [5]}}
    jobs.train_models(rows.where(batch <= 3), FIXTURE, registry, [models.FOREST], grids, batch_id=3)
    later = rows.where(batch > 3)
    done = jobs.update_model(later.where(batch <= middle), FIXTURE, registry, models.FOREST, batch_id=middle)
    if not done["promoted"]:
        registry.promote(models.FOREST, done["version"], {"f1": float("inf")}, after=middle)
    history = jobs.follow(later, FIXTURE, registry, store).select("batch_num", "accuracy", "f1")
    again = None
    for version, part in ((1, later.where(batch <= middle)), (2, later.where(batch > middle))):
        scored = jobs.score_batches(part, FIXTURE, registry, {"model_name": models.FOREST, "version": version})
        found = ev.batch_performance(add_label(scored, FIXTURE), ["batch_num"], LABEL).select("batch_num", F.col("accuracy").alias("a"), F.col("f1").alias("b"))
        again = found if again is None else again.unionByName(found)
    inside = F.col("accuracy").between(0, 1) & F.col("f1").between(0, 1)
    same = (F.abs(F.col("a") - F.col("accuracy")) < 1e-9) & (F.abs(F.col("b") - F.col("f1")) < 1e-9)
    return history.join(again, "batch_num", "left").select("batch_num", inside.alias("metrics_in_range"), F.coalesce(same, F.lit(False)).alias("same_champion_same_scores"))


@query("full_report")
def full_report(spark: SparkSession, folder: str) -> DataFrame:
    """Analyse all batches, train on the first, follow the rest, and write the summary as JSON."""
    store = jobs.Store(scratch_folder(spark))
    rows = stored_policies(spark, folder)
    jobs.run_analysis(rows, store, FIXTURE)
    registry = Registry(spark, store.registry)
    jobs.train_models(rows.where("batch_num <= 3"), FIXTURE, registry, [models.TREE], {models.TREE: {"maxDepth": [4]}})
    jobs.follow(rows.where("batch_num > 3"), FIXTURE, registry, store)
    return jobs.run_summary(spark, store, FIXTURE)
