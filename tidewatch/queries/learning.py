"""Queries over features, evaluation, perturbation and model maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.order_stats import wide_quantiles
from tidewatch.operators import evaluate as ev
from tidewatch.operators import features, maintenance, perturb
from tidewatch.operators.features import LABEL
from tidewatch.plans import report
from tidewatch.queries import sql
from tidewatch.queries.registry import query, r6, rounded
from tidewatch.session import materialize
from tidewatch.sources.tables import FIXTURE, policies, stored_policies

CATEGORIES = ["sex", "insr_type", "make", "usage"]
SCALED = ["insured_value", "premium", "prod_year"]


@query(
    "impute_features",
    f"""WITH {sql.POLICIES}, m AS (SELECT median(premium) AS premium, median(seats_num) AS seats_num, median(carrying_capacity) AS carrying_capacity FROM policies)
    SELECT object_id, coalesce(p.insured_value, 0.0) AS insured_value, coalesce(p.claim_paid, 0.0) AS claim_paid, round(coalesce(p.premium, m.premium), 6) AS premium,
    round(coalesce(p.seats_num, m.seats_num), 6) AS seats_num, round(coalesce(p.carrying_capacity, m.carrying_capacity), 6) AS carrying_capacity FROM policies p, m""",
)
def impute_features(spark: SparkSession, folder: str) -> DataFrame:
    filled = features.impute_features(stored_policies(spark, folder), FIXTURE)
    return filled.select("object_id", "insured_value", "claim_paid", r6("premium"), r6("seats_num"), r6("carrying_capacity"))


@query(
    "impute_mode",
    f"""WITH {sql.POLICIES}, gaps AS (SELECT object_id, CASE WHEN object_id % 7 = 0 THEN NULL ELSE make END AS make, CASE WHEN object_id % 5 = 0 THEN NULL ELSE insr_type END AS insr_type
    FROM policies), m AS (SELECT (SELECT make FROM gaps WHERE make IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS make,
    (SELECT insr_type FROM gaps WHERE insr_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS insr_type)
    SELECT object_id, coalesce(g.make, m.make) AS make, coalesce(g.insr_type, m.insr_type) AS insr_type FROM gaps g, m""",
)
def impute_mode(spark: SparkSession, folder: str) -> DataFrame:
    gaps = policies(spark, folder).select(
        "object_id",
        F.when(F.col("object_id") % 7 != 0, F.col("make")).alias("make"),
        F.when(F.col("object_id") % 5 != 0, F.col("insr_type")).alias("insr_type"),
    )
    common = features.modes(gaps, ["make", "insr_type"])
    return gaps.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in common.items()})


@query(
    "label_encode",
    f"WITH {sql.POLICIES} SELECT object_id, "
    + ", ".join(f"dense_rank() OVER (ORDER BY CAST({c} AS VARCHAR)) - 1 AS {c}_encoded" for c in CATEGORIES)
    + " FROM policies",
)
def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored_policies(spark, folder)
    encoded = features.encode(rows, features.label_codes(rows, CATEGORIES), CATEGORIES)
    return encoded.select("object_id", *[f"{c}_encoded" for c in CATEGORIES])


@query("duration", f"WITH {sql.POLICIES} SELECT object_id, coalesce(date_diff('day', insr_begin, insr_end), 1) AS policy_duration FROM policies")
def duration(spark: SparkSession, folder: str) -> DataFrame:
    return features.add_duration(policies(spark, folder), FIXTURE).select("object_id", "policy_duration")


@query("target", f"WITH {sql.POLICIES} SELECT object_id, CASE WHEN claim_paid > 0 THEN 1 ELSE 0 END AS has_claim FROM policies")
def target(spark: SparkSession, folder: str) -> DataFrame:
    return features.add_label(policies(spark, folder), FIXTURE).select("object_id", LABEL)


@query(
    "feature_table",
    f"WITH {sql.POLICIES} SELECT batch_num, insured_value, premium, seats_num, carrying_capacity, prod_year::DOUBLE AS prod_year, claim_paid FROM policies",
)
def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return features.project(policies(spark, folder), FIXTURE).withColumn("prod_year", F.col("prod_year").cast("double"))


@query(
    "standardize",
    f"""WITH {sql.POLICIES}, s AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED)} FROM policies)
    SELECT object_id, {", ".join(f"round(({c} - m_{c}) / s_{c}, 5) AS {c}" for c in SCALED)}, 0.0::DOUBLE AS flat FROM policies, s""",
)
def standardize(spark: SparkSession, folder: str) -> DataFrame:
    rows = policies(spark, folder).select("object_id", *SCALED, F.lit(7.0).alias("flat"))
    scaled = features.standardize(rows, features.scaling(rows, [*SCALED, "flat"]))
    return scaled.select("object_id", *[F.round(c, 5).alias(c) for c in SCALED], "flat")


@query(
    "class_distribution",
    f"""WITH {sql.POLICIES} SELECT batch_num, count(*) - count(CASE WHEN claim_paid > 0 THEN 1 END) AS n_negative, count(CASE WHEN claim_paid > 0 THEN 1 END) AS n_positive,
    round({sql.share("claim_paid > 0")}, 6) AS positive_share, {sql.share("claim_paid > 0")} < 0.05 AS imbalanced FROM policies GROUP BY 1""",
)
def class_distribution(spark: SparkSession, folder: str) -> DataFrame:
    labelled = features.add_label(policies(spark, folder), FIXTURE)
    return rounded(features.class_distribution(labelled, by=["batch_num"]), "positive_share")


@query(
    "class_weights",
    f"""WITH {sql.POLICIES}, c AS (SELECT CASE WHEN claim_paid > 0 THEN 1 ELSE 0 END AS has_claim, count(*) AS n FROM policies GROUP BY 1)
    SELECT has_claim, n, round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n), 6) AS weight FROM c""",
)
def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.class_weights(features.add_label(policies(spark, folder), FIXTURE)), "weight")


def _hash_sql(seed: int) -> str:
    """``key_hash`` of an integer key; HUGEINT keeps products from overflowing."""
    mixed = "((object_id::BIGINT & 4294967295)::HUGEINT * 1640531527 % 4294967296)"
    top = f"((((object_id::BIGINT >> 32) & 4294967295) + {mixed} + {seed}) % 4294967296 * 668265263 % 1048576)"
    return f"({top} * 4294967296 + {mixed})::BIGINT"


@query(
    "strat_split",
    f"""WITH {sql.POLICIES}, h AS (SELECT object_id, CASE WHEN claim_paid > 0 THEN 1 ELSE 0 END AS has_claim, {_hash_sql(42)} AS h FROM policies),
    l AS (SELECT has_claim, quantile_cont(h::DOUBLE, 0.2) AS cut FROM h GROUP BY 1) SELECT object_id, has_claim, h <= cut AS is_test FROM h JOIN l USING (has_claim)""",
)
def strat_split(spark: SparkSession, folder: str) -> DataFrame:
    labelled = features.add_label(stored_policies(spark, folder), FIXTURE)
    return features.stratified_split(labelled, "object_id").select("object_id", LABEL, "is_test")


@query(
    "strat_folds",
    f"""WITH {sql.POLICIES}, h AS (SELECT object_id, CASE WHEN claim_paid > 0 THEN 1 ELSE 0 END AS has_claim, {_hash_sql(42)} AS h FROM policies),
    l AS (SELECT has_claim, quantile_cont(h::DOUBLE, {1 / 3}) AS a, quantile_cont(h::DOUBLE, {2 / 3}) AS b FROM h GROUP BY 1)
    SELECT object_id, has_claim, CAST(h > a AS INTEGER) + CAST(h > b AS INTEGER) AS fold FROM h JOIN l USING (has_claim)""",
)
def strat_folds(spark: SparkSession, folder: str) -> DataFrame:
    labelled = features.add_label(stored_policies(spark, folder), FIXTURE)
    return features.stratified_folds(labelled, "object_id").select("object_id", LABEL, "fold")


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Every row three times, once per stand-in classifier, with a deterministic score."""
    return stand_ins(policies(spark, folder))


def stand_ins(rows: DataFrame) -> DataFrame:
    tree = F.coalesce(F.col("seats_num"), F.lit(0.0)) / 50
    network = F.greatest(F.col("premium"), F.lit(0.0)) / 10000
    forest = F.coalesce(F.col("insured_value"), F.lit(0.0)) / 100000
    named = {"DecisionTree": tree, "NeuralNetwork": network, "RandomForest": forest}
    scores = F.array(*[F.struct(F.lit(n).alias("model_name"), s.alias("score")) for n, s in named.items()])
    label = F.coalesce((F.col("claim_paid") > 0).cast("int"), F.lit(0)).alias("label")
    each = rows.select("object_id", "batch_num", label, F.inline(scores))
    return each.withColumn("prediction", F.when(F.col("score") >= 0.6, 1.0).otherwise(0.0))


SCORED = f"{sql.POLICIES}, {sql.SCORED}"
BY = ["model_name", "batch_num"]


@query("confusion", f"WITH {SCORED} SELECT model_name, batch_num, {sql.CONFUSION} FROM scored GROUP BY 1, 2")
def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return ev.confusion(scored(spark, folder), by=BY)


BINARY = 'round(accuracy, 6) AS accuracy, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1'


@query("binary_metrics", f"WITH {SCORED} SELECT model_name, batch_num, n, {BINARY} FROM ({sql.binary('model_name, batch_num')})")
def binary_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ev.binary_metrics(scored(spark, folder), by=BY), "accuracy", "precision", "recall", "f1")


WEIGHTED = """SELECT model_name, batch_num, sum(f1 * support) / sum(support) AS f1 FROM (
  SELECT model_name, batch_num, c, count(CASE WHEN label = c THEN 1 END) AS support,
    coalesce(2.0 * count(CASE WHEN label = c AND prediction = c THEN 1 END) / nullif(count(CASE WHEN label = c THEN 1 END) + count(CASE WHEN prediction = c THEN 1 END), 0), 0) AS f1
  FROM scored, (VALUES (0), (1)) v(c) GROUP BY 1, 2, 3) GROUP BY 1, 2"""


@query("weighted_f1", f"WITH {SCORED} SELECT model_name, batch_num, round(f1, 6) AS weighted_f1 FROM ({WEIGHTED})")
def weighted_f1(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ev.weighted_f1(scored(spark, folder), by=BY), "weighted_f1")


@query("roc_auc", f"WITH {SCORED} SELECT model_name, round(roc_auc, 6) AS roc_auc FROM ({sql.auc('model_name')})")
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ev.roc_auc(scored(spark, folder), by=["model_name"]), "roc_auc")


@query("roc_auc_by_batch", f"WITH {SCORED} SELECT model_name, batch_num, round(roc_auc, 6) AS roc_auc FROM ({sql.auc('model_name, batch_num')})")
def roc_auc_by_batch(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ev.roc_auc(scored(spark, folder), by=BY), "roc_auc")


@query(
    "batch_performance",
    f"""WITH {SCORED} SELECT model_name, batch_num, n, round(accuracy, 6) AS accuracy, round(w.f1, 6) AS f1 FROM ({sql.binary("model_name, batch_num")}) b
    JOIN ({WEIGHTED}) w USING (model_name, batch_num)""",
)
def batch_performance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ev.batch_performance(scored(spark, folder), BY), "accuracy", "f1")


@query(
    "metric_drift",
    f"""WITH {SCORED}, b AS ({sql.binary("model_name, batch_num")}), long AS ({" UNION ALL ".join(f"SELECT model_name, batch_num, '{m}' AS metric, round({m}, 6) AS value FROM b" for m in ("accuracy", "recall", "f1"))}),
    ref AS (SELECT metric, value AS reference FROM long WHERE model_name = 'RandomForest' AND batch_num = 1)
    SELECT batch_num, metric, reference, value, round(abs(value - reference) / (abs(reference) + 1e-8), 6) AS relative_change,
    abs(value - reference) / (abs(reference) + 1e-8) > 0.1 AS drifted FROM long JOIN ref USING (metric) WHERE model_name = 'RandomForest'""",
)
def metric_drift(spark: SparkSession, folder: str) -> DataFrame:
    forest = scored(spark, folder).where("model_name = 'RandomForest'")
    metrics = rounded(ev.binary_metrics(forest, by=["batch_num"]), "accuracy", "recall", "f1")
    rows = materialize(ev.as_metric_rows(metrics, ["accuracy", "recall", "f1"], ["batch_num"]))
    return rounded(ev.metric_drift(rows, rows.where("batch_num = 1"), by=["batch_num"]), "relative_change")


def history(spark: SparkSession, folder: str, rows: DataFrame | None = None) -> DataFrame:
    """A metric history, one version per model and batch, measured on the stand-in scores. Some AUCs are left out.

    ``rows`` are the stored policies, if the caller has them.
    """
    rows = stored_policies(spark, folder) if rows is None else rows
    measured = ev.evaluate(stand_ins(rows), by=BY)
    speed = rows.groupBy("batch_num").agg((F.max("insured_value") / 100000).alias("inference_time"))
    return materialize(
        measured.join(speed, "batch_num").select(
            "model_name",
            F.col("batch_num").alias("ts"),
            F.col("batch_num").alias("version"),
            r6("accuracy"),
            r6("f1"),
            F.when(F.col("batch_num") % 5 != 0, r6(F.col("roc_auc"))).alias("roc_auc"),
            r6("inference_time"),
        )
    )


H = sql.HISTORY


@query(
    "best_version",
    f"""WITH {H} SELECT model_name, version, roc_auc FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY coalesce(roc_auc, '-inf'::DOUBLE) DESC, version) AS r
    FROM history) WHERE r = 1""",
)
def best_version(spark: SparkSession, folder: str) -> DataFrame:
    return maintenance.best_version(history(spark, folder), "roc_auc")


@query("latest_version", f"WITH {H} SELECT model_name, version, accuracy, f1 FROM history WHERE version = (SELECT max(version) FROM history)")
def latest_version(spark: SparkSession, folder: str) -> DataFrame:
    return maintenance.latest_version(history(spark, folder)).select("model_name", "version", "accuracy", "f1")


@query(
    "thresholds",
    f"""WITH {H} SELECT model_name, ts, array_to_string(list_filter([CASE WHEN accuracy < 0.7 THEN 'accuracy' END, CASE WHEN f1 < 0.65 THEN 'f1' END,
    CASE WHEN inference_time > 1.0 THEN 'inference_time' END], lambda x: x IS NOT NULL), ',') AS violations,
    NOT coalesce(accuracy < 0.7, false) AND NOT coalesce(f1 < 0.65, false) AND NOT coalesce(inference_time > 1.0, false) AS meets_thresholds FROM history""",
)
def thresholds(spark: SparkSession, folder: str) -> DataFrame:
    found = maintenance.check_thresholds(history(spark, folder))
    return found.select("model_name", "ts", F.array_join("violations", ",").alias("violations"), "meets_thresholds")


@query("metric_trend", f"WITH {H} SELECT ts, roc_auc AS value FROM history WHERE model_name = 'RandomForest' AND roc_auc IS NOT NULL")
def metric_trend(spark: SparkSession, folder: str) -> DataFrame:
    return maintenance.metric_trend(history(spark, folder), "RandomForest", "roc_auc")


LAST10 = """last10 AS (SELECT * FROM history ORDER BY ts DESC, model_name DESC LIMIT 10),
averages AS (SELECT model_name, avg(accuracy) AS accuracy, avg(f1) AS f1, avg(roc_auc) AS roc_auc FROM last10 GROUP BY 1)"""
PERF = """(coalesce(accuracy * 0.3, 0) + coalesce(f1 * 0.4, 0) + coalesce(roc_auc * 0.3, 0)) /
  nullif(CASE WHEN accuracy IS NULL THEN 0 ELSE 0.3 END + CASE WHEN f1 IS NULL THEN 0 ELSE 0.4 END + CASE WHEN roc_auc IS NULL THEN 0 ELSE 0.3 END, 0)"""


@query("avg_last10", f"WITH {H}, {LAST10} SELECT model_name, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, round(roc_auc, 6) AS roc_auc FROM averages")
def avg_last10(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(maintenance.recent_average(history(spark, folder), ["ts", "model_name"]), "accuracy", "f1", "roc_auc")


@query("perf_score", f"WITH {H} SELECT model_name, ts, round(coalesce({PERF}, 0), 8) AS performance FROM history")
def perf_score(spark: SparkSession, folder: str) -> DataFrame:
    return history(spark, folder).select("model_name", "ts", F.round(maintenance.performance_score(), 8).alias("performance"))


ZEROS = " + ".join(f"count(CASE WHEN {c} = 0 THEN 1 END)" for c in sql.NUMBERS)
CHARACTER = f"""{sql.QUARTILES}, {sql.QUALITY},
character AS (SELECT batch_num, ({ZEROS})::DOUBLE / (count(*) * {len(sql.NUMBERS)}) AS sparse_data, any_value(outliers)::DOUBLE / (count(*) * {len(sql.NUMBERS)}) AS anomalous_values,
  {len(sql.NUMBERS)}::DOUBLE / 13 AS numerical_features, 3::DOUBLE / 13 AS categorical_features FROM policies JOIN outliers USING (batch_num) GROUP BY 1)"""


def _fit_sql() -> str:
    parts = []
    for name, weights in maintenance.ADAPTATION_WEIGHTS.items():
        value = " + ".join(f"{w} * (1.0 - abs({c} - 0.5))" for c, w in weights.items())
        parts.append(f"SELECT batch_num, '{name}' AS model_name, ({value}) / ({sum(weights.values())!r})::DOUBLE AS adaptation FROM character")
    return " UNION ALL ".join(parts)


@query(
    "data_characteristics",
    f"""WITH {sql.POLICIES}, {CHARACTER} SELECT batch_num, round(sparse_data, 6) AS sparse_data, round(anomalous_values, 6) AS anomalous_values,
    round(numerical_features, 6) AS numerical_features, round(categorical_features, 6) AS categorical_features, sparse_data > 0.3 AS is_sparse_data,
    anomalous_values > 0.1 AS is_anomalous_values FROM character""",
)
def data_characteristics(spark: SparkSession, folder: str) -> DataFrame:
    found = maintenance.characteristic_flags(maintenance.data_characteristics(stored_policies(spark, folder), FIXTURE))
    return rounded(found, "sparse_data", "anomalous_values", "numerical_features", "categorical_features")


@query("adapt_score", f"WITH {sql.POLICIES}, {CHARACTER}, fit AS ({_fit_sql()}) SELECT batch_num, model_name, round(adaptation, 6) AS adaptation FROM fit")
def adapt_score(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(maintenance.adaptation_scores(maintenance.data_characteristics(stored_policies(spark, folder), FIXTURE)), "adaptation")


@query(
    "choose_model",
    f"""WITH {H}, {CHARACTER}, {LAST10}, fit AS ({_fit_sql()}), s AS (SELECT f.batch_num, a.model_name, 0.7 * coalesce({PERF}, 0) + 0.3 * f.adaptation AS score
    FROM averages a JOIN fit f USING (model_name)) SELECT batch_num, model_name, round(score, 6) AS score FROM (SELECT *,
    row_number() OVER (PARTITION BY batch_num ORDER BY score DESC, model_name) AS r FROM s) WHERE r = 1""",
)
def choose_model(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored_policies(spark, folder)
    averages = maintenance.recent_average(history(spark, folder, rows), ["ts", "model_name"])
    fit = maintenance.adaptation_scores(maintenance.data_characteristics(rows, FIXTURE))
    return rounded(maintenance.choose_model(averages, fit, ["batch_num"]), "score")


@query(
    "champion",
    f"""WITH RECURSIVE {H}, ordered AS (SELECT *, row_number() OVER (ORDER BY ts, model_name) AS i FROM history),
    reign AS (SELECT 1::BIGINT AS i, model_name, ts, f1 FROM ordered WHERE i = 1
      UNION ALL SELECT r.i + 1, CASE WHEN o.f1 > r.f1 + 0.01 THEN o.model_name ELSE r.model_name END, CASE WHEN o.f1 > r.f1 + 0.01 THEN o.ts ELSE r.ts END,
        CASE WHEN o.f1 > r.f1 + 0.01 THEN o.f1 ELSE r.f1 END FROM reign r JOIN ordered o ON o.i = r.i + 1)
    SELECT model_name, ts, f1 FROM reign WHERE i = (SELECT max(i) FROM reign)""",
)
def champion(spark: SparkSession, folder: str) -> DataFrame:
    return maintenance.champion(history(spark, folder), ["ts", "model_name"]).select("model_name", "ts", "f1")


@query(
    "perturb_label",
    f"""WITH {sql.POLICIES}, h AS (SELECT *, row_number() OVER (PARTITION BY batch_num ORDER BY {_hash_sql(7)}) AS r, count(*) OVER (PARTITION BY batch_num) AS n FROM policies)
    SELECT object_id, batch_num, CASE WHEN batch_num >= 3 AND r <= floor(n * 0.3) THEN 1.0 ELSE claim_paid END AS claim_paid FROM h""",
)
def perturb_label(spark: SparkSession, folder: str) -> DataFrame:
    return perturb.overwrite_target(stored_policies(spark, folder), FIXTURE, "object_id", 0.3, start=3).select("object_id", "batch_num", "claim_paid")


@query(
    "perturb_shift",
    f"""WITH {sql.POLICIES}, s AS (SELECT batch_num, stddev_samp(insured_value) AS a, stddev_samp(premium) AS b, stddev_samp(prod_year) AS c FROM policies GROUP BY 1)
    SELECT object_id, batch_num, {", ".join(f"round(CASE WHEN batch_num >= 3 THEN {c} + 0.3 * {s} ELSE {c} END, 4) AS {c}" for c, s in zip(SCALED, "abc"))}
    FROM policies JOIN s USING (batch_num)""",
)
def perturb_shift(spark: SparkSession, folder: str) -> DataFrame:
    moved = perturb.shift_columns(policies(spark, folder), FIXTURE, ["claim_paid", *SCALED, "seats_num"], 0.3, start=3)
    return moved.select("object_id", "batch_num", *[F.round(c, 4).alias(c) for c in SCALED])


@query(
    "perturb_spike",
    f"""WITH {sql.POLICIES}, h AS (SELECT *, {_hash_sql(7)} AS h, count(*) OVER (PARTITION BY batch_num) AS n FROM policies),
    k AS (SELECT *, batch_num >= 3 AND row_number() OVER (PARTITION BY batch_num ORDER BY h) <= floor(n * 0.05) AS hit FROM h),
    s AS (SELECT batch_num, avg(insured_value) AS ma, stddev_samp(insured_value) AS sa, avg(premium) AS mb, stddev_samp(premium) AS sb FROM policies GROUP BY 1)
    SELECT object_id, batch_num, round(CASE WHEN hit AND h % 2 = 0 THEN ma + CASE WHEN (h // 2) % 2 = 0 THEN 5 ELSE -5 END * sa ELSE insured_value END, 4) AS insured_value,
    round(CASE WHEN hit AND h % 2 = 1 THEN mb + CASE WHEN (h // 2) % 2 = 0 THEN 5 ELSE -5 END * sb ELSE premium END, 4) AS premium FROM k JOIN s USING (batch_num)""",
)
def perturb_spike(spark: SparkSession, folder: str) -> DataFrame:
    spiked = perturb.add_spikes(stored_policies(spark, folder), FIXTURE, "object_id", ["insured_value", "premium"], 0.05, start=3)
    return spiked.select("object_id", "batch_num", F.round("insured_value", 4).alias("insured_value"), F.round("premium", 4).alias("premium"))


@query(
    "summary_models",
    f"""WITH {H} SELECT count(DISTINCT model_name) AS total_models, count(*) AS total_versions,
    (SELECT string_agg(model_name || ':' || n, ',' ORDER BY model_name) FROM (SELECT model_name, count(*) AS n FROM history GROUP BY 1)) AS model_counts FROM history""",
)
def summary_models(spark: SparkSession, folder: str) -> DataFrame:
    pairs = F.transform(F.array_sort(F.map_entries("model_counts")), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return report.model_metrics(history(spark, folder)).withColumn("model_counts", F.array_join(pairs, ","))


@query(
    "summary_perf",
    f"""WITH {H}, f AS (SELECT * FROM history WHERE model_name = 'RandomForest') SELECT round(avg(accuracy), 6) AS avg_accuracy, round(avg(f1), 6) AS avg_f1,
    round(avg(inference_time), 6) AS avg_inference_time, count(*) AS total_batches_evaluated, max_by(accuracy, ts) AS latest_accuracy, max_by(f1, ts) AS latest_f1,
    max_by(inference_time, ts) AS latest_inference_time, max(ts) AS latest_batch FROM f""",
)
def summary_perf(spark: SparkSession, folder: str) -> DataFrame:
    forest = history(spark, folder).where("model_name = 'RandomForest'").withColumnRenamed("ts", "batch_num")
    return rounded(report.performance(forest, FIXTURE), "avg_accuracy", "avg_f1", "avg_inference_time")


@query("selection_history", f"WITH {H} SELECT model_name, version, ts, accuracy, f1 FROM history ORDER BY ts DESC, model_name DESC LIMIT 5")
def selection_history(spark: SparkSession, folder: str) -> DataFrame:
    return report.selection_history(history(spark, folder))


@query(
    "quantiles_with_nan",
    f"""WITH {sql.POLICIES}, v AS (SELECT batch_num, premium::DOUBLE AS x FROM policies WHERE object_id % 10 <> 0 AND object_id % 7 <> 0 AND premium IS NOT NULL)
    SELECT batch_num, round(quantile_cont(x, 0.25), 6) AS q1, round(quantile_cont(x, 0.5), 6) AS q2, round(quantile_cont(x, 0.95), 6) AS q95 FROM v GROUP BY 1""",
)
def quantiles_with_nan(spark: SparkSession, folder: str) -> DataFrame:
    """Exact quantiles of a column with NaN in a tenth and NULL in a seventh of the rows."""
    odd = F.when(F.col("object_id") % 10 == 0, F.lit(float("nan"))).when(F.col("object_id") % 7 != 0, F.col("premium"))
    rows = stored_policies(spark, folder).withColumn("x", odd)
    found = wide_quantiles(rows, ["batch_num"], ["x"], [0.25, 0.5, 0.95])
    return found.select("batch_num", *[r6(F.col("x")[i], name) for i, name in enumerate(("q1", "q2", "q95"))])
