"""Choosing and watching model versions, as queries over a history table.

History columns: ``model_name, ts`` and metric columns that may be missing (NULL).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.coerce import numeric_columns, string_columns
from tidewatch.functions.running import running_maximum
from tidewatch.operators.drift import outlier_counts
from tidewatch.roles import Roles
from tidewatch.session import materialize, ratio

# Default limits and weights.
THRESHOLDS = {"accuracy": 0.7, "f1": 0.65, "inference_time": 1.0}
PERFORMANCE_WEIGHTS = {"accuracy": 0.3, "f1": 0.4, "roc_auc": 0.3}
ADAPTATION_WEIGHTS = {
    "DecisionTree": {"sparse_data": 0.8, "anomalous_values": 0.6, "numerical_features": 0.7, "categorical_features": 0.9},
    "RandomForest": {"sparse_data": 0.7, "anomalous_values": 0.8, "numerical_features": 0.8, "categorical_features": 0.8},
    "NeuralNetwork": {"sparse_data": 0.5, "anomalous_values": 0.4, "numerical_features": 0.9, "categorical_features": 0.6},
}
DATA_LIMITS = {"sparse_data": 0.3, "anomalous_values": 0.1}
NEUTRAL = 0.5


def best_version(registry: DataFrame, metric: str) -> DataFrame:
    """Per model the version with the highest metric; a missing metric ranks last, the earliest wins ties."""
    value = F.coalesce(F.col(metric), F.lit(float("-inf")))
    return registry.groupBy("model_name").agg(
        F.min_by("version", F.struct((-value).alias("v"), F.col("version"))).alias("version"),
        F.max(metric).alias(metric),
    )


def latest_version(registry: DataFrame) -> DataFrame:
    """Per model its newest version, all columns."""
    others = [c for c in registry.columns if c != "model_name"]
    newest = registry.groupBy("model_name").agg(F.max_by(F.struct(*others), "version").alias("r"))
    return newest.select("model_name", "r.*")


def check_thresholds(history: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """Add ``violations`` (metric names) and ``meets_thresholds``. A missing metric is not checked."""
    limits = THRESHOLDS if thresholds is None else thresholds
    broken = []
    for metric, limit in limits.items():
        if metric in history.columns:
            bad = F.col(metric) > limit if metric == "inference_time" else F.col(metric) < limit
            broken.append(F.when(bad, F.lit(metric)))
    violations = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return history.withColumn("violations", violations).withColumn("meets_thresholds", F.size("violations") == 0)


def metric_trend(history: DataFrame, model_name: str, metric: str) -> DataFrame:
    """One model's series of one metric, in order."""
    series = history.where((F.col("model_name") == model_name) & F.col(metric).isNotNull())
    return series.select("ts", F.col(metric).alias("value")).orderBy("ts")


def recent_average(history: DataFrame, order: Sequence[str] = ("ts",), last: int = 10, metrics: Sequence[str] = tuple(PERFORMANCE_WEIGHTS)) -> DataFrame:
    """Mean metrics per model over the last records of all models together."""
    newest = history.orderBy(*[F.desc(c) for c in order]).limit(last)
    return newest.groupBy("model_name").agg(*[F.avg(m).alias(m) for m in metrics])


def performance_score(weights: dict[str, float] | None = None) -> Column:
    """Weighted mean of the metrics that are present; 0 when none is."""
    weights = PERFORMANCE_WEIGHTS if weights is None else weights
    total = sum((F.when(F.col(m).isNotNull(), w).otherwise(0.0) for m, w in weights.items()), F.lit(0.0))
    value = sum((F.coalesce(F.col(m) * w, F.lit(0.0)) for m, w in weights.items()), F.lit(0.0))
    return F.when(total > 0, value / total).otherwise(0.0)


def data_characteristics(df: DataFrame, roles: Roles, outliers: DataFrame | None = None) -> DataFrame:
    """Per batch: share of zero cells and of outlier cells among numbers, shares of column kinds."""
    by = [c for c in roles.by if c in df.columns]
    numeric, text = numeric_columns(df, by), string_columns(df, by)
    columns = [c for c in df.columns if c not in by]
    zeros = sum((F.count(F.when(F.col(c) == 0, 1)) for c in numeric), F.lit(0))
    counted = df.groupBy(*by).agg((F.count(F.lit(1)) * len(numeric)).alias("_cells"), zeros.alias("_zeros"))
    outliers = outlier_counts(df, roles) if outliers is None else outliers
    joined = counted.join(outliers, by) if by else counted.withColumn("outliers", outliers.scalar())
    return joined.select(
        *by,
        ratio(F.col("_zeros"), F.col("_cells")).alias("sparse_data"),
        ratio(F.col("outliers"), F.col("_cells")).alias("anomalous_values"),
        F.lit(len(numeric) / len(columns)).alias("numerical_features"),
        F.lit(len(text) / len(columns)).alias("categorical_features"),
    )


def characteristic_flags(characteristics: DataFrame) -> DataFrame:
    return characteristics.withColumns({f"is_{c}": F.col(c) > limit for c, limit in DATA_LIMITS.items()})


def adaptation_scores(characteristics: DataFrame, weights: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """``..., model_name, adaptation``: how well each known model suits the data, one row per input row and model."""
    weights = ADAPTATION_WEIGHTS if weights is None else weights
    scores = []
    for model, rules in weights.items():
        used = {c: w for c, w in rules.items() if c in characteristics.columns}
        known = sum((F.when(F.col(c).isNotNull(), w).otherwise(0.0) for c, w in used.items()), F.lit(0.0))
        value = sum((F.coalesce((1.0 - F.abs(F.col(c) - 0.5)) * w, F.lit(0.0)) for c, w in used.items()), F.lit(0.0))
        score = F.when(known > 0, value / known).otherwise(NEUTRAL)
        scores.append(F.struct(F.lit(model).alias("model_name"), score.alias("adaptation")))
    kept = [c for c in characteristics.columns if not any(c in rules for rules in weights.values())]
    return characteristics.select(*kept, F.inline(F.array(*scores)))


def choose_model(
    averages: DataFrame, adaptation: DataFrame, by: Sequence[str] = (), performance_weight: float = 0.7, adaptation_weight: float = 0.3
) -> DataFrame:
    """Per batch the model with the best weighted score; ties by name.

    Averages hold one row per model and travel with each adaptation row; models without adaptation
    rules count as neutral.
    """
    scored = materialize(averages.withColumn("performance", performance_score()).select("model_name", "performance"))
    models = scored.agg(F.collect_list(F.struct("model_name", "performance")).alias("m"))
    per_batch = adaptation.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("model_name", "adaptation"))).alias("_fit"))
    fit = F.coalesce(F.try_element_at("_fit", F.col("m.model_name")), F.lit(NEUTRAL))
    candidates = per_batch.select(*by, "_fit", F.explode(models.scalar()).alias("m")).select(
        *by,
        F.col("m.model_name").alias("model_name"),
        (F.lit(performance_weight) * F.col("m.performance") + F.lit(adaptation_weight) * fit).alias("score"),
    )
    best = candidates.groupBy(*by).agg(F.min_by(F.struct("model_name", "score"), F.struct((-F.col("score")).alias("s"), F.col("model_name"))).alias("b"))
    return best.select(*by, "b.*")


def champion(history: DataFrame, order: Sequence[str] = ("ts",), metric: str = "f1", improvement: float = 0.01) -> DataFrame:
    """The record that reigns at the end: the first one, then each that beats the reigning metric by
    more than ``improvement``.

    Only a record above all records before it can ever take over, so a running maximum leaves the few strict records,
    and one aggregate folds these in order. A first record without a metric reigns for good. ``order`` identifies a record.
    """
    if improvement < 0:
        raise ValueError("improvement must not be negative")
    columns = history.columns
    rows = running_maximum(history.select("*", F.struct(*order).alias("_at")), order, metric, "_before")
    first = rows.agg(F.min("_at").alias("a"))
    value = F.col(metric)
    strict = value.isNotNull() & (F.col("_before").isNull() | (value > F.col("_before")))
    records = rows.where(strict | (F.col("_at") == first.scalar()))
    listed = records.agg(F.array_sort(F.collect_list(F.struct("_at", F.struct(*columns).alias("r")))).alias("records")).where(F.size("records") > 0)
    better = lambda held, new: F.when(new["r"][metric] > held["r"][metric] + improvement, new).otherwise(held)
    return listed.select(F.aggregate("records", F.col("records")[0], better).alias("held")).select("held.r.*")


def with_versions(history: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    """Number the records of each model from 1."""
    return history.withColumn("version", F.row_number().over(Window.partitionBy("model_name").orderBy(*order)))
