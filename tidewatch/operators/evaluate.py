"""Classifier metrics as aggregates over scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.running import running_totals
from tidewatch.session import materialize, ratio

EPSILON = 1e-8


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """TN, FP, FN, TP."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*by).agg(
        F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp")
    )


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1 with 0 for an empty denominator."""
    counts = confusion(df, label, prediction, by)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *by,
        (tp + fp + fn + tn).alias("n"),
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def weighted_f1(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """F1 of every class averaged by its number of true rows."""
    cells = df.groupBy(*by, F.col(label).cast("double").alias("_y"), F.col(prediction).cast("double").alias("_p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    hit = F.when(F.col("_y") == F.col("_p"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("_y").alias("class"), F.col("n").alias("support"), none.alias("predicted"), hit.cast("bigint").alias("tp")),
        F.struct(F.col("_p").alias("class"), none.alias("support"), F.col("n").alias("predicted"), none.alias("tp")),
    )
    per_class = (
        cells.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    )
    f1 = ratio(F.col("tp") * 2, F.col("support") + F.col("predicted"))
    return per_class.groupBy(*by).agg((F.sum(f1 * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; 0.5 when a class is absent.

    Equal scores are combined first; the running count of negatives is then taken over distinct
    scores in range-partitioned slices.
    """
    by = list(by)
    per_score = df.groupBy(*by, F.col(score).alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg")
    )
    ranked = running_totals(per_score, ["_score"], {"_below": "_neg"}, by=by)
    wins = F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / F.lit(2.0)))
    summed = ranked.groupBy(*by).agg(wins.alias("_wins"), F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    pairs = F.col("_p").cast("double") * F.col("_n")
    return summed.select(*by, F.when(pairs > 0, F.col("_wins") / pairs).otherwise(0.5).alias("roc_auc"))


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """The five standard metrics together. The scored rows are written once, as two aggregates read them."""
    by = list(by)
    df = materialize(df.select(*by, label, prediction, score))
    return _beside(binary_metrics(df, label, prediction, by), roc_auc(df, label, score, by), by)


def _beside(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Join two tables of one row per group."""
    return left.join(right, by) if by else left.withColumns({c: right.select(c).scalar() for c in right.columns})


def batch_performance(df: DataFrame, by: Sequence[str], label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows, accuracy and weighted F1 per batch, for prequential monitoring."""
    right = F.avg((F.col(label) == F.col(prediction)).cast("double"))
    accuracy = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), right.alias("accuracy"))
    return _beside(accuracy, weighted_f1(df, label, prediction, by).withColumnRenamed("weighted_f1", "f1"), list(by))


def metric_drift(current: DataFrame, reference: DataFrame, threshold: float = 0.1, by: Sequence[str] = ()) -> DataFrame:
    """Relative change of every metric both tables (``metric, value``) have."""
    by = list(by)
    pinned = reference.select("metric", F.col("value").alias("reference"))
    joined = current.join(F.broadcast(pinned), "metric")  # one row per metric
    change = F.abs(F.col("value") - F.col("reference")) / (F.abs("reference") + EPSILON)
    return joined.select(*by, "metric", "reference", "value", change.alias("relative_change"), (change > threshold).alias("drifted"))


def as_metric_rows(df: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Wide metric columns to ``metric, value`` rows."""
    return df.select(*by, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(list(by), list(metrics), "metric", "value")
