"""The summary report: small queries over the history tables the jobs write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.drift import drift_trend, latest
from tidewatch.roles import Roles
from tidewatch.session import ratio


def model_metrics(registry: DataFrame) -> DataFrame:
    """Versions per model and over all."""
    per_model = registry.groupBy("model_name").agg(F.count(F.lit(1)).alias("versions"))
    return per_model.agg(
        F.count(F.lit(1)).alias("total_models"),
        F.coalesce(F.sum("versions"), F.lit(0)).alias("total_versions"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("model_name", "versions")))).alias("model_counts"),
    )


def latest_quality(dq_reports: DataFrame, consistency: DataFrame, roles: Roles) -> DataFrame:
    """The newest batch's cleaned metrics and its rule check."""
    newest = dq_reports.agg(F.max_by(F.struct(roles.batch, "after", "flags_after"), roles.batch).alias("d")).where("d is not null")
    checked = consistency.agg(F.max_by(F.struct(roles.batch, "n_rules_checked", "any_issue"), roles.batch).alias("c"))
    both = newest.withColumn("c", checked.scalar())
    return both.select(
        F.col(f"d.{roles.batch}").alias("batch_id"),
        F.col("d.after.missing_total_ratio").alias("missing_total_ratio"),
        F.col("d.after.duplicate_ratio").alias("duplicate_ratio"),
        F.col("d.after.invalid_ratio").alias("invalid_ratio"),
        F.col("d.after.n_rows").alias("total_rows"),
        F.col("d.after.n_cols").alias("total_columns"),
        (~F.col("d.flags_after.any_issue")).alias("data_quality_passed"),
        F.coalesce(F.col("c.n_rules_checked"), F.lit(0)).alias("consistency_rules_checked"),
        F.coalesce(F.col("c.any_issue"), F.lit(False)).alias("consistency_issues"),
        F.col(f"c.{roles.batch}").alias("consistency_batch_id"),
    )


def performance(history: DataFrame, roles: Roles) -> DataFrame:
    """Averages over all evaluated batches, and the newest row."""
    metrics = ("accuracy", "f1", "inference_time")
    newest = F.max_by(F.struct(roles.batch, *metrics), roles.batch)
    summed = history.agg(
        *[F.avg(m).alias(f"avg_{m}") for m in metrics], F.count(F.lit(1)).alias("total_batches_evaluated"), newest.alias("n")
    )
    return summed.select(
        *[f"avg_{m}" for m in metrics],
        "total_batches_evaluated",
        *[F.col(f"n.{m}").alias(f"latest_{m}") for m in metrics],
        F.col(f"n.{roles.batch}").alias("latest_batch"),
    )


def drift_overview(reports: DataFrame, roles: Roles, last: int = 10) -> DataFrame:
    """The newest report, and rate and trend over the last ones."""
    recent = latest(reports, roles, last)
    newest = recent.agg(F.max_by(F.struct("*"), roles.batch).alias("n")).where("n is not null")
    counted = recent.agg(F.count(F.lit(1)).alias("total"), F.count_if("drift_detected").alias("hits"))
    trend = drift_trend(recent, roles)
    summary = trend.select(F.struct(*trend.columns)).scalar()
    both = newest.withColumn("c", counted.select(F.struct("total", "hits")).scalar()).withColumn("drift_history_summary", summary)
    return both.select(
        F.col(f"n.{roles.batch}").alias("batch_number"),
        "n.drift_detected",
        F.coalesce("n.drift_type", F.lit("none")).alias("drift_type"),
        "n.confidence",
        F.size("n.affected_features").alias("affected_features_count"),
        "n.affected_features",
        "n.concept_shift_confidence",
        "n.target_distribution_change",
        "n.quality_issues",
        F.col("n.anomalies").alias("quality_anomalies"),
        F.col("c.total").alias("total_drift_reports_analyzed"),
        F.col("c.hits").alias("batches_with_drift"),
        ratio(F.col("c.hits"), F.col("c.total")).alias("drift_rate"),
        "drift_history_summary",
    )


def selection_history(registry: DataFrame, last: int = 5) -> DataFrame:
    """The newest versions of all models."""
    newest = registry.orderBy(F.desc("ts"), F.desc("model_name")).limit(last)
    return newest.select("model_name", "version", "ts", "accuracy", "f1")


def full_report(**sections: DataFrame) -> DataFrame:
    """One JSON document per call: every section is a list of its (few) rows."""
    names = list(sections)
    first = sections[names[0]]
    start = first.sparkSession.range(1).select()
    packed = {n: df.agg(F.collect_list(F.struct(*df.columns)).alias("rows")).scalar() for n, df in sections.items()}
    document = start.withColumns(packed)
    return document.select(F.to_json(F.struct(*names)).alias("report"))
