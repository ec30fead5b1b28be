"""Model features: imputation, encoding, scaling, splitting and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.coerce import as_label, day_difference
from tidewatch.functions.hashing import key_hash
from tidewatch.functions.order_stats import group_sizes, quantiles, wide_quantiles
from tidewatch.functions.running import running_totals
from tidewatch.roles import POLICY_DROPPED, Roles
from tidewatch.session import attach, materialize, sized

LABEL = "has_claim"
DURATION = "policy_duration"


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact whole-table medians."""
    found = {row["column"]: row["q"][0] for row in quantiles(df, [], columns, [0.5]).collect()} if columns else {}
    return {c: found.get(c) for c in columns}


def modes(df: DataFrame, columns: Sequence[str], unknown: str = "Unknown") -> dict[str, str]:
    """Most frequent text form of each column; ties take the smallest, all-missing gives ``unknown``."""
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), as_label(df, c).alias("value")) for c in columns]))
    counted = df.select(cells).where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    found = {row["column"]: row["mode"] for row in best.collect()} if columns else {}
    return {c: found.get(c, unknown) for c in columns}


def impute_features(df: DataFrame, roles: Roles) -> DataFrame:
    """Zero, median or mode for what is missing, by role."""
    present = set(df.columns)
    zeros = [c for c in (*roles.zero_features, roles.target) if c in present]
    middles = medians(df, [c for c in roles.median_features if c in present])
    common = modes(df, [c for c in roles.categorical_features if c in present])
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in zeros}
    filled |= {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in middles.items()}
    filled |= {c: F.coalesce(as_label(df, c), F.lit(m)) for c, m in common.items()}
    return df.withColumns(filled)


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, code``: every distinct text value numbered from 0 in sorted order."""
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), as_label(df, c).alias("value")) for c in columns]))
    distinct = df.select(cells).where("value is not null").distinct().withColumn("_one", F.lit(1).cast("bigint"))
    return running_totals(distinct, ["value"], {"code": "_one"}, by=["column"]).drop("_one")


def encode(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``{column}_encoded``; values without a code get one past the last."""
    codes = materialize(codes)
    counts = {row["column"]: row["n"] for row in codes.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    for c in columns:
        own = codes.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias(f"{c}_encoded"))
        joined = df.withColumn("_value", as_label(df, c)).join(sized(own, counts.get(c, 0)), "_value", "left").drop("_value")
        df = joined.withColumn(f"{c}_encoded", F.coalesce(F.col(f"{c}_encoded"), F.lit(counts.get(c, 0)).cast("bigint")))
    return df


def add_duration(df: DataFrame, roles: Roles) -> DataFrame:
    return df.withColumn(DURATION, F.coalesce(day_difference(F.col(roles.begin), F.col(roles.end)), F.lit(1)))


def add_label(df: DataFrame, roles: Roles) -> DataFrame:
    """1 when the target amount is positive, else 0, missing included."""
    return df.withColumn(LABEL, F.coalesce((F.col(roles.target) > 0).cast("int"), F.lit(0)))


def feature_columns(roles: Roles, columns: Sequence[str]) -> list[str]:
    numbers = [c for c in (*roles.zero_features, *roles.median_features) if c in columns]
    encoded = [f"{c}_encoded" for c in roles.categorical_features if c in columns]
    return numbers + encoded + ([DURATION] if roles.begin in columns and roles.end in columns else [])


def project(df: DataFrame, roles: Roles) -> DataFrame:
    """Drop dates, identifier, raw categories and garbage columns."""
    gone = [roles.begin, roles.end, roles.identifier, *roles.categorical_features, *POLICY_DROPPED]
    return df.drop(*[c for c in gone if c])


def class_distribution(df: DataFrame, label: str = LABEL, rare: float = 0.05, by: Sequence[str] = ()) -> DataFrame:
    """Counts and shares of both classes, with a warning flag when positives are rare."""
    counted = df.groupBy(*by).agg(
        F.count_if(F.col(label) == 0).alias("n_negative"),
        F.count_if(F.col(label) == 1).alias("n_positive"),
    )
    total = F.col("n_negative") + F.col("n_positive")
    share = F.when(total > 0, F.col("n_positive") / total).otherwise(0.0)
    return counted.withColumn("positive_share", share).withColumn("imbalanced", F.col("positive_share") < rare)


def scaling(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, mean, std`` with the population deviation."""
    stats = [
        F.struct(F.lit(c).alias("column"), F.avg(c).alias("mean"), F.stddev_pop(F.col(c).cast("double")).alias("std")) for c in columns
    ]
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def standardize(df: DataFrame, stats: DataFrame, suffix: str = "") -> DataFrame:
    """(x - mean) / std; a constant column becomes 0."""
    scaled = {}
    for row in stats.collect():
        centred = F.col(row["column"]) - F.lit(row["mean"])
        scaled[f"{row['column']}{suffix}"] = centred / F.lit(row["std"]) if row["std"] else centred * F.lit(0.0)
    return df.withColumns(scaled)


def stratified_split(df: DataFrame, key: str, label: str = LABEL, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``: in each class the rows whose key hash is within the lowest ``test_share``.

    The limit per class is an exact quantile of the hash, so the split does not depend on how rows
    are partitioned, and no class is sorted in one task.
    """
    hashed = df.withColumn("_hash", key_hash(df, key, seed))
    _, classes = group_sizes(hashed, [label])
    limit = wide_quantiles(hashed, [label], ["_hash"], [test_share]).select(label, F.col("_hash")[0].alias("_limit"))
    return attach(hashed, limit, [label], classes).withColumn("is_test", F.col("_hash") <= F.col("_limit")).drop("_hash", "_limit")


def stratified_folds(df: DataFrame, key: str, label: str = LABEL, folds: int = 3, seed: int = 42) -> DataFrame:
    """Add ``fold`` (0 ..): equal hash ranges inside every class."""
    hashed = df.withColumn("_hash", key_hash(df, key, seed))
    cuts = [i / folds for i in range(1, folds)]
    _, classes = group_sizes(hashed, [label])
    limits = wide_quantiles(hashed, [label], ["_hash"], cuts).select(label, F.col("_hash").alias("_limits"))
    placed = attach(hashed, limits, [label], classes)
    fold = F.size(F.filter("_limits", lambda limit: F.col("_hash") > limit))
    return placed.withColumn("fold", fold).drop("_hash", "_limits")


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """``label, n, weight`` with weight = rows / (classes * rows of the class)."""
    counted = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counted.agg(F.struct(F.sum("n").cast("double").alias("rows"), F.count(F.lit(1)).alias("classes")).alias("t")).scalar()
    weighted = counted.withColumn("_t", totals)
    return weighted.select(label, "n", (F.col("_t.rows") / (F.col("_t.classes") * F.col("n"))).alias("weight"))


def add_class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    weights = class_weights(df, label).select(label, "weight")
    return df.join(F.broadcast(weights), label, "left")  # one row per class
