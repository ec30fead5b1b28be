"""Cleaning steps in their fixed order: drop rows, blank bad values, fill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.coerce import numeric_columns, string_columns
from tidewatch.functions.order_stats import wide_quantiles
from tidewatch.roles import Cleaning, Roles
from tidewatch.session import attach, stored


def drop_rows(df: DataFrame, roles: Roles, cleaning: Cleaning = Cleaning()) -> DataFrame:
    """Drop repeated rows, rows whose begin lies after their end, and rows without a time."""
    if cleaning.drop_duplicates:
        df = df.distinct()
    return drop_bad_dates(df, roles, cleaning)


def drop_bad_dates(df: DataFrame, roles: Roles, cleaning: Cleaning = Cleaning()) -> DataFrame:
    if cleaning.drop_bad_date_order and roles.begin in df.columns and roles.end in df.columns:
        df = df.where(~F.coalesce(F.col(roles.begin) > F.col(roles.end), F.lit(False)))
    if cleaning.drop_missing_time and roles.time in df.columns:
        df = df.where(F.col(roles.time).isNotNull())
    return df


def blank_values(df: DataFrame, roles: Roles, cleaning: Cleaning = Cleaning()) -> DataFrame:
    """Out-of-range and negative values become NULL, then the zero-default columns are filled."""
    changed = {}
    if cleaning.out_of_range_to_null:
        for rule in roles.ranges:
            if rule.column in df.columns:
                changed[rule.column] = F.when(F.col(rule.column).between(rule.low, rule.high), F.col(rule.column))
    if cleaning.negative_to_null:
        for column in roles.non_negative:
            if column in df.columns:
                value = changed.get(column, F.col(column))
                changed[column] = F.when(value >= 0, value)
    for column in roles.zero_default:
        if column in df.columns:
            changed[column] = F.coalesce(changed.get(column, F.col(column)), F.lit(0).cast(df.schema[column].dataType))
    return df.withColumns(changed) if changed else df


def impute(df: DataFrame, roles: Roles, cleaning: Cleaning = Cleaning()) -> DataFrame:
    """Fill missing numbers with the batch's median or mean, missing text with a constant.

    The rows are written once, because counting gaps, the statistics and the fill each read them.
    The counting pass finds the columns that miss anything; only those get a statistic.
    """
    by = [c for c in roles.by if c in df.columns]
    method = (cleaning.impute_numeric or "none").lower()
    if method != "none":
        df = _impute_numeric(df, by, [c for c in numeric_columns(df, by) if c not in roles.zero_default], method)
    fill = cleaning.impute_categorical
    if fill and fill.lower() != "none":
        df = df.withColumns({c: F.coalesce(F.col(c), F.lit(fill)) for c in string_columns(df, by)})
    return df


def _impute_numeric(df: DataFrame, by: list[str], columns: list[str], method: str) -> DataFrame:
    if not columns:
        return df
    df = stored(df)
    per_group = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in columns])
    missing = [F.max(F.col("_n") - F.col(c)).alias(c) for c in columns]
    found = per_group.agg(F.count(F.lit(1)).alias("_groups"), *missing).first()
    gaps = [c for c in columns if (found[c] or 0) > 0]
    if not gaps:
        return df
    if method == "median":
        stats = wide_quantiles(df, by, gaps, [0.5])
        stats = stats.select(*by, *[F.col(c)[0].alias(f"_fill_{c}") for c in gaps])
    else:
        stats = df.groupBy(*by).agg(*[F.avg(c).alias(f"_fill_{c}") for c in gaps])
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_fill_{c}")) for c in gaps}
    return attach(df, stats, by, found["_groups"]).select(*[filled.get(c, F.col(c)).alias(c) for c in df.columns])


def clean(df: DataFrame, roles: Roles, cleaning: Cleaning = Cleaning()) -> DataFrame:
    return impute(blank_values(drop_rows(df, roles, cleaning), roles, cleaning), roles, cleaning)
