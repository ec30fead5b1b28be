"""Queries over drift detection and its history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import drift
from tidewatch.queries import sql
from tidewatch.queries.registry import query, r6, rounded
from tidewatch.session import materialize
from tidewatch.sources.tables import FIXTURE, policies, stored_policies

PINNED = "batch_num = 1"


@query(
    "ref_numeric",
    f"WITH {sql.POLICIES} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS "min", max({c})::DOUBLE AS "max",
        count({c}) AS n_samples FROM policies WHERE batch_num = 1"""
        for c in sql.MONITORED
    ),
)
def ref_numeric(spark: SparkSession, folder: str) -> DataFrame:
    found = drift.numeric_reference(policies(spark, folder).where(PINNED), FIXTURE)
    return found.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@query(
    "category_shares",
    f"""WITH {sql.POLICIES}, {sql.shares(sql.CATEGORICAL)} SELECT batch_num, col AS "column", v AS value, n, total::BIGINT AS total, round(share, 6) AS share,
    count(*) OVER (PARTITION BY batch_num, col) AS n_categories FROM shares""",
)
def category_shares(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(drift.categorical_shares(policies(spark, folder), FIXTURE), "share")


@query(
    "drift_quartile",
    f"""WITH {sql.POLICIES}, {sql.SHIFT} SELECT batch_num, col AS "column", round(q1, 6) AS q1, round(q3, 6) AS q3, round(similarity, 6) AS similarity, drifted,
    round(q1_change_percent, 6) AS q1_change_percent, round(q3_change_percent, 6) AS q3_change_percent FROM shift""",
)
def drift_quartile(spark: SparkSession, folder: str) -> DataFrame:
    table = materialize(drift.quartile_table(stored_policies(spark, folder), FIXTURE, list(FIXTURE.monitored_numeric)))
    found = drift.quartile_shift(table, table.where(PINNED).drop("batch_num"), FIXTURE)
    measured = [r6(c) for c in ("q1", "q3", "similarity", "q1_change_percent", "q3_change_percent")]
    return found.select("batch_num", "column", *measured, "drifted")


def _chi(spark: SparkSession, folder: str, on: str) -> DataFrame:
    shares = materialize(drift.categorical_shares(policies(spark, folder), FIXTURE))
    found = drift.share_chi_square(shares, shares.where(PINNED).drop("batch_num"), FIXTURE, on=on)
    return found.select("batch_num", "column", r6("statistic"), "df", r6("p_value"), "drifted")


@query(
    "drift_chisq",
    f"""WITH {sql.POLICIES}, {sql.CHI} SELECT batch_num, col AS "column", round(statistic, 6) AS statistic, df, round({sql.CHI_P}, 6) AS p_value,
    {sql.CHI_P} < 0.01 AS drifted FROM chi""",
)
def drift_chisq(spark: SparkSession, folder: str) -> DataFrame:
    return _chi(spark, folder, "shares")


@query(
    "drift_chisq_counts",
    f"""WITH {sql.POLICIES}, {sql.CHI} SELECT batch_num, col AS "column", round(statistic * total, 6) AS statistic, df, round({sql.tail("statistic * total")}, 6) AS p_value,
    {sql.tail("statistic * total")} < 0.01 AS drifted FROM chi""",
)
def drift_chisq_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _chi(spark, folder, "counts")


@query(
    "drift_chisq_unseen",
    """WITH e AS (SELECT event_id // 1000 + 1 AS batch_num, CAST(user_id AS VARCHAR) AS v FROM events), s AS (SELECT batch_num, v, count(*) AS n FROM e GROUP BY 1, 2),
    base AS (SELECT v, n::DOUBLE / sum(n) OVER () AS e FROM s WHERE batch_num = 1)
    SELECT s.batch_num, (SELECT count(*) FROM base) + count(CASE WHEN b.v IS NULL THEN 1 END) - 1 AS df, count(CASE WHEN b.v IS NULL THEN 1 END) > 0 AS unseen_category
    FROM s LEFT JOIN base b ON s.v = b.v GROUP BY 1""",
)
def drift_chisq_unseen(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.roles import Roles
    from tidewatch.sources.tables import events

    roles = Roles(monitored_categorical=("user_id",))
    shares = materialize(drift.categorical_shares(events(spark, folder), roles))
    found = drift.share_chi_square(shares, shares.where(PINNED).drop("batch_num"), roles)
    return found.select("batch_num", "df", (F.col("statistic") == float("inf")).alias("unseen_category"))


@query(
    "drift_target",
    f"""WITH {sql.POLICIES}, {sql.TARGET} SELECT batch_num, round(distribution_change, 6) AS distribution_change, distribution_change > 0.1 AS drifted,
    CASE WHEN distribution_change > 0.1 THEN round(least(distribution_change, 1.0), 6) ELSE 0.0 END AS confidence FROM target""",
)
def drift_target(spark: SparkSession, folder: str) -> DataFrame:
    shares = materialize(drift.categorical_shares(policies(spark, folder), FIXTURE, ["claim_paid"]))
    found = drift.target_shift(shares, shares.where(PINNED).drop("batch_num"), FIXTURE)
    return rounded(found, "distribution_change", "confidence")


@query("drift_missing", f"WITH {sql.POLICIES}, {sql.QUARTILES}, {sql.QUALITY} SELECT batch_num, n_rows, round(missing_ratio, 6) AS missing_ratio FROM quality")
def drift_missing(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(drift.missing_ratios(policies(spark, folder), FIXTURE), "missing_ratio")


@query("drift_outliers", f"WITH {sql.POLICIES}, {sql.QUARTILES}, {sql.QUALITY} SELECT batch_num, outliers FROM outliers")
def drift_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return drift.outlier_counts(stored_policies(spark, folder), FIXTURE)


@query(
    "drift_quality",
    f"""WITH {sql.POLICIES}, {sql.QUARTILES}, {sql.QUALITY} SELECT batch_num, round(missing_value_drift, 6) AS missing_value_drift, round(outlier_drift, 6) AS outlier_drift,
    missing_value_drift > 0.05 OR outlier_drift > 0.5 AS quality_issues FROM quality""",
)
def drift_quality(spark: SparkSession, folder: str) -> DataFrame:
    found = drift.quality_drift(stored_policies(spark, folder), FIXTURE)
    return found.select("batch_num", r6("missing_value_drift"), r6("outlier_drift"), "quality_issues")


@query("drift_features", f"WITH {sql.VERDICT} SELECT batch_num, round(confidence, 6) AS confidence, n_affected > 0 AS drifted, affected FROM features")
def drift_features(spark: SparkSession, folder: str) -> DataFrame:
    found = drift.covariate(drift.feature_scores(stored_policies(spark, folder), FIXTURE), FIXTURE)
    return found.select("batch_num", r6("confidence"), "drifted", F.array_join(F.array_sort("affected_features.feature"), ",").alias("affected"))


def _reports(spark: SparkSession, folder: str) -> DataFrame:
    """The drift history of all batches, written once."""
    return materialize(drift.detect(stored_policies(spark, folder), FIXTURE))


@query(
    "drift_verdict",
    f"""WITH {sql.VERDICT} SELECT batch_num, n_rows, drift_detected, coalesce(drift_type, 'none') AS drift_type, round(confidence, 6) AS confidence, affected,
    quality_issues, round(missing_value_drift, 6) AS missing_value_drift, round(outlier_drift, 6) AS outlier_drift FROM verdict""",
)
def drift_verdict(spark: SparkSession, folder: str) -> DataFrame:
    found = drift.detect(stored_policies(spark, folder), FIXTURE)
    return found.select(
        "batch_num", "n_rows", "drift_detected", F.coalesce("drift_type", F.lit("none")).alias("drift_type"), r6("confidence"),
        F.array_join(F.array_sort("affected_features.feature"), ",").alias("affected"), "quality_issues",
        r6("missing_value_drift"), r6("outlier_drift"),
    )


PAIR_SQL = sql.VERDICT.replace("o.o_orderkey // 1000 + 1 AS batch_num", "CASE WHEN year(o.o_orderdate) < 1998 THEN 1 ELSE 2 END AS batch_num")


@query(
    "drift_pair",
    f"""WITH {PAIR_SQL} SELECT n_rows, drift_detected, drift_type, round(confidence, 6) AS confidence, affected, round(concept_shift_confidence, 6) AS concept_shift_confidence,
    quality_issues, round(missing_value_drift, 6) AS missing_value_drift, round(outlier_drift, 6) AS outlier_drift FROM verdict WHERE batch_num = 2""",
)
def drift_pair(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored_policies(spark, folder)
    early = F.year("insr_begin") < 1998
    found = drift.detect_between(rows.where(early), rows.where(~early), FIXTURE)
    return found.select(
        "n_rows", "drift_detected", "drift_type", r6("confidence"), F.array_join(F.array_sort("affected_features.feature"), ",").alias("affected"),
        r6("concept_shift_confidence"), "quality_issues", r6("missing_value_drift"), r6("outlier_drift"),
    )


@query(
    "drift_summary",
    f"""WITH {sql.VERDICT} SELECT count(*) AS total_batches_analyzed, count(CASE WHEN drift_detected THEN 1 END) AS batches_with_drift,
    round(count(CASE WHEN drift_detected THEN 1 END)::DOUBLE / count(*), 6) AS drift_rate, max(CASE WHEN drift_detected THEN batch_num END) AS last_drift_batch,
    count(CASE WHEN drift_detected AND drift_type = 'covariate' THEN 1 END) AS covariate_batches,
    count(CASE WHEN drift_detected AND drift_type = 'concept' THEN 1 END) AS concept_batches FROM verdict""",
)
def drift_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(drift.drift_summary(_reports(spark, folder), FIXTURE), "drift_rate").drop("status", "drift_types")


@query(
    "drift_top_features",
    f"""WITH {sql.VERDICT} SELECT t.col AS feature, count(*) AS n FROM tests t JOIN verdict v ON v.batch_num = t.batch_num WHERE t.drifted AND v.drift_detected
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
)
def drift_top_features(spark: SparkSession, folder: str) -> DataFrame:
    return drift.top_features(_reports(spark, folder))


@query(
    "drift_trend",
    f"""WITH {sql.VERDICT} SELECT count(*) AS total_batches, string_agg(DISTINCT drift_type, ',') AS drift_types_observed,
    round(coalesce(avg(CASE WHEN confidence > 0 THEN confidence END), 0.0), 6) AS average_confidence,
    (SELECT count(CASE WHEN drift_detected THEN 1 END) FROM (SELECT * FROM verdict ORDER BY batch_num DESC LIMIT 5)) AS recent_drifts,
    CASE WHEN (SELECT count(CASE WHEN drift_detected THEN 1 END) FROM (SELECT * FROM verdict ORDER BY batch_num DESC LIMIT 5)) >= 3 THEN 'increasing'
      WHEN (SELECT count(CASE WHEN drift_detected THEN 1 END) FROM (SELECT * FROM verdict ORDER BY batch_num DESC LIMIT 5)) <= 1 THEN 'decreasing'
      ELSE 'stable' END AS drift_trend,
    (SELECT string_agg(col, ',' ORDER BY n DESC, col) FROM (SELECT col, count(*) AS n FROM tests WHERE drifted GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5))
      AS most_frequent_affected_features FROM verdict""",
)
def drift_trend(spark: SparkSession, folder: str) -> DataFrame:
    found = rounded(drift.drift_trend(_reports(spark, folder), FIXTURE), "average_confidence")
    listed = {c: F.array_join(c, ",") for c in ("drift_types_observed", "most_frequent_affected_features")}
    return found.withColumns(listed)


@query(
    "drift_latest",
    f"WITH {sql.VERDICT} SELECT batch_num, drift_detected, quality_issues FROM verdict ORDER BY batch_num DESC LIMIT 10",
)
def drift_latest(spark: SparkSession, folder: str) -> DataFrame:
    return drift.latest(_reports(spark, folder), FIXTURE).select("batch_num", "drift_detected", "quality_issues")


@query(
    "ks_two_sample",
    f"""WITH {sql.POLICIES}, long AS ({sql.cells("policies", sql.MONITORED)}), v AS (SELECT * FROM long WHERE v IS NOT NULL),
    cur AS (SELECT batch_num, col, v, count(*) AS n FROM v GROUP BY 1, 2, 3),
    pts AS (SELECT DISTINCT k.batch_num, c.col, c.v FROM (SELECT DISTINCT batch_num FROM cur) k JOIN cur c ON c.batch_num IN (1, k.batch_num)),
    f AS (SELECT p.batch_num, p.col, sum(coalesce(a.n, 0)) OVER w::DOUBLE / sum(coalesce(a.n, 0)) OVER (PARTITION BY p.batch_num, p.col) AS fa,
      sum(coalesce(b.n, 0)) OVER w::DOUBLE / sum(coalesce(b.n, 0)) OVER (PARTITION BY p.batch_num, p.col) AS fb
      FROM pts p LEFT JOIN cur a ON a.batch_num = p.batch_num AND a.col = p.col AND a.v = p.v LEFT JOIN cur b ON b.batch_num = 1 AND b.col = p.col AND b.v = p.v
      WINDOW w AS (PARTITION BY p.batch_num, p.col ORDER BY p.v))
    SELECT batch_num, col AS "column", round(max(abs(fa - fb)), 6) AS ks FROM f GROUP BY 1, 2""",
)
def ks_two_sample(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(drift.ks_statistic(policies(spark, folder), FIXTURE, 1), "ks")


@query(
    "cohen_d",
    f"""WITH {sql.POLICIES}, long AS ({sql.cells("policies", sql.MONITORED)}),
    s AS (SELECT batch_num, col, avg(v) AS m, var_samp(v) AS s2, count(v) AS n FROM long GROUP BY 1, 2),
    d AS (SELECT a.batch_num, a.col, (a.m - r.m) / sqrt(((a.n - 1) * a.s2 + (r.n - 1) * r.s2) / (a.n + r.n - 2)) AS d FROM s a JOIN s r ON r.batch_num = 1 AND r.col = a.col)
    SELECT batch_num, col AS "column", round(d, 5) AS cohen_d, abs(d) >= 0.1 AS meaningful FROM d""",
)
def cohen_d(spark: SparkSession, folder: str) -> DataFrame:
    return drift.effect_size(policies(spark, folder), FIXTURE, 1).withColumn("cohen_d", F.round("cohen_d", 5))
