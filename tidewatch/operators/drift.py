"""Drift of every batch against a pinned reference batch.

All statistics are per (batch, column) and come from map-side combined aggregates; the reference is
the same table filtered to the reference batch. Categories that a batch lacks are accounted for from
totals, so batches are never paired with the whole reference list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.coerce import as_label, numeric_columns
from tidewatch.functions.order_stats import group_sizes, quantiles
from tidewatch.functions.running import running_totals
from tidewatch.functions.special import chi_square_p
from tidewatch.roles import DriftLimits, Roles
from tidewatch.session import attach, materialize, ratio

QUARTILES = (0.25, 0.75)


def first_batch(df: DataFrame, roles: Roles) -> int:
    """The batch pinned as reference: the smallest batch number."""
    return df.agg(F.min(roles.batch)).first()[0]


def numeric_reference(reference: DataFrame, roles: Roles) -> DataFrame:
    """Mean, sample deviation, range and count of every monitored number; all-missing ones drop out."""
    columns = [c for c in roles.monitored_numeric if c in reference.columns]
    stats = [
        F.struct(
            F.lit(c).alias("column"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
            F.count(c).alias("n_samples"),
        )
        for c in columns
    ]
    return reference.agg(F.array(*stats).alias("s")).select(F.inline("s")).where("n_samples > 0")


def categorical_shares(df: DataFrame, roles: Roles, columns: Sequence[str] | None = None) -> DataFrame:
    """Count and relative frequency of every value: ``batch, column, value, n, total, share``."""
    by = [c for c in roles.by if c in df.columns]
    present = [c for c in (columns or roles.monitored_categorical) if c in df.columns]
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), as_label(df, c).alias("value")) for c in present]))
    counted = df.select(*by, cells).where("value is not null").groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = counted.groupBy(*by, "column").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_categories"))
    joined = attach(counted, totals, by + ["column"])
    return joined.withColumn("share", F.col("n") / F.col("total"))


def quartile_table(df: DataFrame, roles: Roles, columns: Sequence[str]) -> DataFrame:
    """``batch, column, q1, q3`` of the given numbers."""
    by = [c for c in roles.by if c in df.columns]
    found = quantiles(df, by, columns, QUARTILES)
    return found.select(*by, "column", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))


def quartile_shift(quartiles: DataFrame, reference: DataFrame, roles: Roles, limits: DriftLimits = DriftLimits()) -> DataFrame:
    """Similarity of each column's quartiles to the reference quartiles."""
    pinned = reference.select("column", F.col("q1").alias("q1_ref"), F.col("q3").alias("q3_ref"))
    joined = quartiles.join(F.broadcast(pinned), "column")  # one row per monitored column
    width = F.col("q3_ref") - F.col("q1_ref") + limits.epsilon

    def moved(now: str, ref: str) -> Column:
        return F.abs((F.col(now) - F.col(ref)) / width)

    def percent(now: str, ref: str) -> Column:
        return F.when(F.col(ref) != 0, (F.col(now) - F.col(ref)) / F.col(ref) * 100).otherwise(0.0)

    similarity = 1 - F.least(F.lit(1.0), moved("q1", "q1_ref") + moved("q3", "q3_ref"))
    return (
        joined.withColumn("similarity", similarity)
        .withColumn("drifted", F.col("similarity") < limits.min_similarity)
        .withColumn("score", 1 - F.col("similarity"))
        .withColumn("q1_change_percent", percent("q1", "q1_ref"))
        .withColumn("q3_change_percent", percent("q3", "q3_ref"))
    )


def share_chi_square(
    shares: DataFrame, reference: DataFrame, roles: Roles, limits: DriftLimits = DriftLimits(), on: str = "shares"
) -> DataFrame:
    """Chi-square of each batch's category shares against the reference shares.

    ``on="counts"`` scales the statistic to row counts. A category unseen in the reference gives an
    infinite statistic. Reference categories absent from the batch add their share each, which is
    what the matched ones leave of the reference total.
    """
    by = [c for c in roles.by if c in shares.columns]
    pinned = reference.select("column", "value", F.col("n").alias("n_ref"), F.col("total").alias("total_ref"))
    per_column = reference.groupBy("column").agg(F.first("total").alias("_rows"), F.count(F.lit(1)).alias("_known"))
    joined = attach(shares, pinned, ["column", "value"])
    expected = F.col("n_ref") / F.col("total_ref")
    matched = F.sum(F.when(F.col("n_ref").isNotNull(), F.pow(F.col("share") - expected, F.lit(2)) / expected).otherwise(0.0))
    summed = joined.groupBy(*by, "column").agg(
        matched.alias("_matched"),
        F.coalesce(F.sum("n_ref"), F.lit(0)).alias("_ref_rows"),
        F.count(F.when(F.col("n_ref").isNull(), 1)).alias("unseen"),
        F.first("total").alias("total"),
    )
    known = summed.join(F.broadcast(per_column), "column")  # one row per monitored column
    statistic = F.col("_matched") + (F.col("_rows") - F.col("_ref_rows")) / F.col("_rows")
    if on == "counts":
        statistic = statistic * F.col("total")
    statistic = F.when(F.col("unseen") > 0, F.lit(float("inf"))).otherwise(statistic)
    return (
        known.withColumn("statistic", statistic)
        .withColumn("df", F.col("_known") + F.col("unseen") - 1)
        .withColumn("p_value", F.when(F.col("unseen") > 0, 0.0).otherwise(chi_square_p(F.col("statistic"), F.col("df"))))
        .withColumn("drifted", F.col("p_value") < limits.p_value)
        .withColumn("score", 1 - F.col("p_value"))
        .select(*by, "column", "statistic", "df", "p_value", "drifted", "score")
    )


def target_shift(shares: DataFrame, reference: DataFrame, roles: Roles, limits: DriftLimits = DriftLimits()) -> DataFrame:
    """Summed absolute change of the target's value shares; a value on one side only meets a small constant."""
    by = [c for c in roles.by if c in shares.columns]
    gap = F.lit(limits.missing_side)
    pinned = reference.select("value", F.col("share").alias("share_ref"))
    alone = F.abs(F.col("share_ref") - gap)
    everything = pinned.agg(F.coalesce(F.sum(alone), F.lit(0.0)).alias("all")).scalar()
    known = pinned.agg(F.count(F.lit(1)).alias("known")).scalar()
    joined = attach(shares, pinned, ["value"])
    change = F.abs(F.coalesce("share_ref", gap) - F.col("share"))
    summed = joined.groupBy(*by).agg(F.sum(change).alias("_change"), F.coalesce(F.sum(alone), F.lit(0.0)).alias("_alone"))
    total = F.when(F.col("_known") > 0, F.col("_change") + (F.col("_all") - F.col("_alone"))).otherwise(0.0)
    return (
        summed.withColumns({"_all": everything, "_known": known}).withColumn("distribution_change", total)
        .withColumn("drifted", F.col("distribution_change") > limits.target_change)
        .withColumn("confidence", F.when(F.col("drifted"), F.least("distribution_change", F.lit(1.0))).otherwise(0.0))
        .drop("_change", "_alone", "_all", "_known")
    )


def missing_ratios(df: DataFrame, roles: Roles) -> DataFrame:
    """Share of missing cells per batch."""
    by = [c for c in roles.by if c in df.columns]
    columns = [c for c in df.columns if c not in by]
    filled = sum((F.count(c) for c in columns), F.lit(0))
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), filled.alias("_filled"))
    cells = F.col("n_rows") * len(columns)
    return counted.select(*by, "n_rows", ratio(cells - F.col("_filled"), cells).alias("missing_ratio"))


def outlier_counts(
    df: DataFrame, roles: Roles, quartiles: DataFrame | None = None, limits: DriftLimits = DriftLimits(), groups: int | None = None
) -> DataFrame:
    """Cells outside the batch's own Tukey fences, summed over all numeric columns.

    ``groups`` is the number of batches, if known.
    """
    by = [c for c in roles.by if c in df.columns]
    columns = numeric_columns(df, by)
    if quartiles is None or groups is None:
        _, groups = group_sizes(df, by)
        quartiles = quartile_table(df, roles, columns) if quartiles is None else quartiles
    reach = (F.col("q3") - F.col("q1")) * limits.whisker
    fences = quartiles.where(F.col("column").isin(columns)).groupBy(*by).agg(
        F.map_from_entries(
            F.collect_list(F.struct("column", F.struct((F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))))
        ).alias("_fences")
    )
    wide = [F.col("_fences")[c][side].alias(f"_{side}_{i}") for i, c in enumerate(columns) for side in ("low", "high")]
    joined = attach(df.select(*by, *columns), fences.select(*by, *wide), by, groups)

    def outside(i: int, c: str) -> Column:
        return F.when((F.col(c) < F.col(f"_low_{i}")) | (F.col(c) > F.col(f"_high_{i}")), 1).otherwise(0)

    counts = sum((outside(i, c) for i, c in enumerate(columns)), F.lit(0))
    return joined.groupBy(*by).agg(F.sum(counts).alias("outliers"))


def quality_drift(
    df: DataFrame,
    roles: Roles,
    reference: int | None = None,
    limits: DriftLimits = DriftLimits(),
    quartiles: DataFrame | None = None,
    groups: int | None = None,
) -> DataFrame:
    """Change of the missing ratio and of the outlier count against the reference batch."""
    reference = first_batch(df, roles) if reference is None else reference
    joined = missing_ratios(df, roles).join(outlier_counts(df, roles, quartiles, limits, groups), roles.by)
    measured = materialize(joined)
    pinned = measured.where(F.col(roles.batch) == reference).select(F.struct("missing_ratio", "outliers")).scalar()
    missing = F.abs(F.col("missing_ratio") - F.col("_ref.missing_ratio"))
    outliers = F.abs(F.col("outliers") - F.col("_ref.outliers")) / F.greatest("_ref.outliers", F.lit(1))
    return (
        measured.withColumn("_ref", pinned).withColumn("missing_value_drift", missing)
        .withColumn("outlier_drift", outliers)
        .withColumn("missing_drifted", F.col("missing_value_drift") > limits.missing_change)
        .withColumn("outlier_drifted", F.col("outlier_drift") > limits.outlier_change)
        .withColumn("quality_issues", F.col("missing_drifted") | F.col("outlier_drifted"))
        .drop("_ref")
    )


def feature_scores(df: DataFrame, roles: Roles, reference: int | None = None, limits: DriftLimits = DriftLimits(), on: str = "shares", quartiles: DataFrame | None = None) -> DataFrame:
    """One row per batch and monitored column: test, score, whether the score counts, whether it drifted."""
    reference = first_batch(df, roles) if reference is None else reference
    pinned = F.col(roles.batch) == reference
    parts = []
    numeric = [c for c in roles.monitored_numeric if c in df.columns]
    if numeric:
        table = materialize(quartile_table(df, roles, numeric)) if quartiles is None else quartiles.where(F.col("column").isin(numeric))
        shift = quartile_shift(table, table.where(pinned).drop(roles.batch), roles, limits)
        parts.append(
            shift.select(
                *roles.by,
                "column",
                F.lit("robust_distribution").alias("drift_type"),
                F.lit("IQR_quartile_change").alias("test"),
                "score",
                F.col("drifted").alias("counts"),
                "drifted",
                "q1_change_percent",
                "q3_change_percent",
                F.lit(None).cast("double").alias("statistic"),
                F.lit(None).cast("double").alias("p_value"),
            )
        )
    categorical = [c for c in roles.monitored_categorical if c in df.columns]
    if categorical:
        shares = materialize(categorical_shares(df, roles, categorical))
        tested = share_chi_square(shares, shares.where(pinned).drop(roles.batch), roles, limits, on)
        parts.append(
            tested.select(
                *roles.by,
                "column",
                F.lit("categorical_distribution").alias("drift_type"),
                F.lit("Chi-squared").alias("test"),
                "score",
                F.lit(True).alias("counts"),
                "drifted",
                F.lit(None).cast("double").alias("q1_change_percent"),
                F.lit(None).cast("double").alias("q3_change_percent"),
                "statistic",
                "p_value",
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    order = {c: i for i, c in enumerate(numeric + categorical)}
    ordinals = F.create_map(*[F.lit(v) for pair in order.items() for v in pair])
    return result.withColumn("ordinal", ordinals[F.col("column")])


def covariate(scores: DataFrame, roles: Roles) -> DataFrame:
    """Batch decision from its column scores: mean score, affected columns, detected or not."""
    feature = F.struct(
        "ordinal", F.col("column").alias("feature"), "drift_type", F.col("score").alias("confidence"), "test",
        "q1_change_percent", "q3_change_percent", "statistic", "p_value",
    )
    summed = scores.groupBy(*roles.by).agg(
        F.coalesce(F.avg(F.when(F.col("counts"), F.col("score"))), F.lit(0.0)).alias("confidence"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), feature))).alias("_features"),
    )
    features = F.transform("_features", lambda f: f.dropFields("ordinal"))
    return summed.select(*roles.by, (F.size("_features") > 0).alias("drifted"), "confidence", features.alias("affected_features"))


def detect(df: DataFrame, roles: Roles, reference: int | None = None, limits: DriftLimits = DriftLimits(), on: str = "shares") -> DataFrame:
    """The combined report, one row per batch.

    Column drift sets type ``covariate``; a target shift overrides the type with ``concept`` and adds
    its own figures; quality changes are reported but do not set ``drift_detected``.
    """
    reference = first_batch(df, roles) if reference is None else reference
    numeric = numeric_columns(df, roles.by)
    _, groups = group_sizes(df, roles.by)
    quartiles = materialize(quartile_table(df, roles, numeric)) if numeric else None
    features = covariate(feature_scores(df, roles, reference, limits, on, quartiles), roles)
    quality = quality_drift(df, roles, reference, limits, quartiles, groups)
    joined = quality.join(features.withColumnsRenamed({"drifted": "_covariate", "confidence": "_confidence"}), roles.by, "left")
    if roles.target in df.columns:
        shares = materialize(categorical_shares(df, roles, [roles.target]))
        pinned = shares.where(F.col(roles.batch) == reference).drop(roles.batch)
        shifted = target_shift(shares, pinned, roles, limits)
        joined = joined.join(shifted.withColumnsRenamed({"drifted": "_concept", "confidence": "_shift"}), roles.by, "left")
    else:
        joined = joined.withColumns({"_concept": F.lit(False), "_shift": F.lit(0.0), "distribution_change": F.lit(0.0)})
    covariate_hit, concept_hit = F.coalesce("_covariate", F.lit(False)), F.coalesce("_concept", F.lit(False))
    anomalies = F.array_compact(
        F.array(
            F.when(F.col("missing_drifted"), F.struct(F.lit("missing_value_drift").alias("type"), F.col("missing_value_drift").alias("severity"))),
            F.when(F.col("outlier_drifted"), F.struct(F.lit("outlier_drift").alias("type"), F.col("outlier_drift").alias("severity"))),
        )
    )
    no_features = F.array().cast(joined.schema["affected_features"].dataType)
    return joined.select(
        *roles.by,
        "n_rows",
        (covariate_hit | concept_hit).alias("drift_detected"),
        F.when(concept_hit, "concept").when(covariate_hit, "covariate").alias("drift_type"),
        F.when(covariate_hit, F.col("_confidence")).otherwise(0.0).alias("confidence"),
        F.when(covariate_hit, F.col("affected_features")).otherwise(no_features).alias("affected_features"),
        F.when(concept_hit, F.col("_shift")).alias("concept_shift_confidence"),
        F.when(concept_hit, F.col("distribution_change")).alias("target_distribution_change"),
        "quality_issues",
        "missing_value_drift",
        "outlier_drift",
        anomalies.alias("anomalies"),
    )


def detect_between(reference: DataFrame, current: DataFrame, roles: Roles, limits: DriftLimits = DriftLimits(), on: str = "shares") -> DataFrame:
    """One-shot comparison of two tables with the same columns."""
    columns = [c for c in reference.columns if c != roles.batch and c in current.columns]
    both = (
        reference.select(F.lit(0).cast("bigint").alias(roles.batch), *columns)
        .unionByName(current.select(F.lit(1).cast("bigint").alias(roles.batch), *columns))
    )
    return detect(both, roles, 0, limits, on).where(F.col(roles.batch) == 1).drop(roles.batch)


def drift_summary(reports: DataFrame, roles: Roles) -> DataFrame:
    """Totals over a report history; one row, or status ``no_drift_history`` when it is empty."""
    hit = F.col("drift_detected")
    total = F.col("total_batches_analyzed")
    return reports.agg(
        F.count(F.lit(1)).alias("total_batches_analyzed"),
        F.count_if(hit).alias("batches_with_drift"),
        F.max(F.when(hit, F.col(roles.batch))).alias("last_drift_batch"),
        F.count_if(hit & (F.col("drift_type") == "covariate")).alias("covariate_batches"),
        F.count_if(hit & (F.col("drift_type") == "concept")).alias("concept_batches"),
        F.collect_set(F.when(hit, F.col("drift_type"))).alias("drift_types"),
    ).select(
        F.when(total == 0, "no_drift_history").otherwise("ok").alias("status"),
        total,
        "batches_with_drift",
        ratio(F.col("batches_with_drift"), total).alias("drift_rate"),
        "last_drift_batch",
        "covariate_batches",
        "concept_batches",
        F.array_sort("drift_types").alias("drift_types"),
    )


def top_features(reports: DataFrame, k: int = 5, drifted_only: bool = True) -> DataFrame:
    """Columns most often affected, ties by name."""
    used = reports.where("drift_detected") if drifted_only else reports
    named = used.select(F.explode("affected_features.feature").alias("feature"))
    return named.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "feature").limit(k)


def latest(reports: DataFrame, roles: Roles, n: int = 10) -> DataFrame:
    """The newest ``n`` rows of a history table."""
    return reports.orderBy(F.desc(roles.batch)).limit(n)


def drift_trend(reports: DataFrame, roles: Roles, recent: int = 5, k: int = 5) -> DataFrame:
    """Types seen, commonest columns, mean positive confidence, and direction over the last reports."""
    features = top_features(reports, k, drifted_only=False)
    listed = features.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "feature"))).alias("f"))
    newest = reports.orderBy(F.desc(roles.batch)).limit(recent).agg(F.count_if("drift_detected").alias("recent_drifts"))
    whole = reports.agg(
        F.count(F.lit(1)).alias("total_batches"),
        F.array_sort(F.collect_set("drift_type")).alias("drift_types_observed"),
        F.coalesce(F.avg(F.when(F.col("confidence") > 0, F.col("confidence"))), F.lit(0.0)).alias("average_confidence"),
    )
    recent_drifts = newest.scalar()
    trend = F.when(F.col("recent_drifts") >= 3, "increasing").when(F.col("recent_drifts") <= 1, "decreasing").otherwise("stable")
    return (
        whole.withColumn("recent_drifts", recent_drifts)
        .withColumn("drift_trend", trend)
        .withColumn("most_frequent_affected_features", listed.select(F.col("f.feature")).scalar())
    )



def ks_statistic(df: DataFrame, roles: Roles, reference: int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance of every batch to the reference batch, per column.

    Between two neighbouring values of a batch only the reference curve moves, and it only rises, so
    the largest gap is found at or just below a value of the batch. Both curves are running totals
    over distinct values.
    """
    reference = first_batch(df, roles) if reference is None else reference
    columns = [c for c in (columns or roles.monitored_numeric) if c in df.columns]
    doubles = [F.col(c).cast("double").alias(c) for c in columns]
    cells = df.select(*roles.by, *doubles).unpivot(roles.by, columns, "column", "value").where("value is not null")
    counted = materialize(cells.groupBy(*roles.by, "column", "value").agg(F.count(F.lit(1)).alias("n")))
    in_reference = F.coalesce(F.sum(F.when(F.col(roles.batch) == reference, F.col("n"))), F.lit(0))
    points = counted.groupBy("column", "value").agg(in_reference.alias("ref"))
    curve = running_totals(points, ["value"], {"ref_below": "ref"}, by=["column"])
    own = running_totals(counted, ["value"], {"below": "n"}, by=[*roles.by, "column"])
    sizes = counted.groupBy(*roles.by, "column").agg(F.sum("n").alias("size"))
    ref_sizes = counted.where(F.col(roles.batch) == reference).groupBy("column").agg(F.sum("n").alias("ref_size"))
    joined = own.join(curve, ["column", "value"]).join(sizes, [*roles.by, "column"]).join(F.broadcast(ref_sizes), "column")
    under = F.abs(F.col("below") / F.col("size") - F.col("ref_below") / F.col("ref_size"))
    at = F.abs((F.col("below") + F.col("n")) / F.col("size") - (F.col("ref_below") + F.col("ref")) / F.col("ref_size"))
    return joined.groupBy(*roles.by, "column").agg(F.max(F.greatest(under, at)).alias("ks"))


def effect_size(df: DataFrame, roles: Roles, reference: int | None = None, minimum: float = 0.1) -> DataFrame:
    """Cohen's d of every batch against the reference batch, with the pooled sample deviation."""
    reference = first_batch(df, roles) if reference is None else reference
    columns = [c for c in roles.monitored_numeric if c in df.columns]
    stats = [
        F.struct(F.lit(c).alias("column"), F.avg(c).alias("mean"), F.var_samp(c).alias("var"), F.count(c).alias("n")) for c in columns
    ]
    table = materialize(df.groupBy(*roles.by).agg(F.array(*stats).alias("s")).select(*roles.by, F.inline("s")))
    pinned = table.where(F.col(roles.batch) == reference).select(
        "column", F.col("mean").alias("mean_ref"), F.col("var").alias("var_ref"), F.col("n").alias("n_ref")
    )
    joined = table.join(F.broadcast(pinned), "column")  # one row per monitored column
    freedom = F.col("n") + F.col("n_ref") - 2
    pooled = F.when(freedom > 0, F.sqrt(((F.col("n") - 1) * F.col("var") + (F.col("n_ref") - 1) * F.col("var_ref")) / freedom))
    d = F.when(pooled > 0, (F.col("mean") - F.col("mean_ref")) / pooled).otherwise(0.0)
    return joined.select(*roles.by, "column", d.alias("cohen_d"), (F.abs(d) >= minimum).alias("meaningful"))
