"""Quality metrics per batch, threshold flags, and the before/after report."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.clean import clean
from tidewatch.roles import Cleaning, QualityLimits, Roles
from tidewatch.session import ratio, stored

COPIES = "_copies"


def collapse(df: DataFrame) -> DataFrame:
    """Distinct full rows with their number of copies.

    Equal rows meet in the map-side combine, so a group of copies of any size stays cheap, and both
    the duplicate ratio and the de-duplicated table come out of this one shuffle.
    """
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def invalid_checks(df: DataFrame, roles: Roles) -> dict[str, Column]:
    """Name -> condition for every validity check whose column exists. Missing values are not invalid."""
    checks: dict[str, Column] = {}
    for rule in roles.allowed:
        if rule.column in df.columns:
            checks[rule.name] = ~F.col(rule.column).isin(list(rule.values))
    for rule in roles.ranges:
        if rule.column in df.columns:
            checks[rule.name] = ~F.col(rule.column).between(rule.low, rule.high)
    for column in roles.non_negative:
        if column in df.columns:
            checks[f"{column}_negative"] = F.col(column) < 0
    return checks


def dq_metrics(df: DataFrame, roles: Roles) -> DataFrame:
    """All metrics of every batch in one aggregate over the collapsed rows."""
    return collapsed_metrics(collapse(df), roles)


def collapsed_metrics(rows: DataFrame, roles: Roles) -> DataFrame:
    by = [c for c in roles.by if c in rows.columns]
    columns = [c for c in rows.columns if c not in by and c != COPIES]
    checks = invalid_checks(rows, roles)
    dated = roles.begin in columns and roles.end in columns

    counted = [f"sum(if({quoted(c)} IS NULL, {COPIES}, 0)) AS _null_{i}" for i, c in enumerate(columns)]
    if dated:
        counted.append(f"sum(if({quoted(roles.begin)} > {quoted(roles.end)}, {COPIES}, 0)) AS _order")
    bad = [F.sum(F.when(check, F.col(COPIES)).otherwise(0)).alias(f"_bad_{i}") for i, check in enumerate(checks.values())]
    totals = [f"sum({COPIES}) AS n_rows", f"sum({COPIES} - 1) AS _repeats"]
    aggregated = rows.groupBy(*by).agg(*map(F.expr, totals + counted), *bad)
    aggregated = aggregated.fillna(0, [c for c in aggregated.columns if c not in by])

    nulls = {c: f"_null_{i}" for i, c in enumerate(columns)}
    all_nulls = f"({' + '.join(nulls.values()) or '0'})"
    invalid = {name: _share(f"_bad_{i}") for i, name in enumerate(checks)}
    dates = [_share(part) for part in ("_order", nulls[roles.begin], nulls[roles.end])] if dated else ["0.0D"]
    return aggregated.selectExpr(
        *map(quoted, by),
        "n_rows",
        f"{len(columns)} AS n_cols",
        f"{_share(all_nulls, f'(n_rows * {len(columns)})', 1.0)} AS missing_total_ratio",
        f"{_as_map({c: _share(count) for c, count in nulls.items()})} AS missing_per_column",
        f"{_share('_repeats')} AS duplicate_ratio",
        f"{_share(nulls[roles.time], empty=1.0) if roles.time in nulls else '1.0D'} AS bad_time_ratio",
        f"array_max(array({', '.join(dates)})) AS bad_date_ratio",
        f"array_max(array({', '.join(invalid.values()) or '0.0D'})) AS invalid_ratio",
        f"{_as_map(invalid)} AS invalid_breakdown",
    )


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _share(part: str, whole: str = "n_rows", empty: float = 0.0) -> str:
    return f"if({whole} > 0, cast({part} AS double) / cast({whole} AS double), {empty}D)"


def _as_map(values: dict[str, str]) -> str:
    """SQL for a map from names to numbers."""
    pairs = [f"{text(name)}, {value}" for name, value in values.items()]
    return f"map({', '.join(pairs)})" if pairs else "cast(map() AS map<string, double>)"


def quality_flags(metrics: DataFrame, limits: QualityLimits = QualityLimits()) -> DataFrame:
    """Add one boolean per threshold and their disjunction."""
    flags = {
        "too_many_missing": F.col("missing_total_ratio") > limits.max_missing_total,
        "too_many_duplicates": F.col("duplicate_ratio") > limits.max_duplicate_ratio,
        "too_many_bad_dates": F.col("bad_date_ratio") > limits.max_bad_date_ratio,
        "too_many_invalid": F.col("invalid_ratio") > limits.max_invalid_ratio,
    }
    any_issue = F.lit(False)
    for flag in flags.values():
        any_issue = any_issue | flag
    return metrics.withColumns(flags | {"any_issue": any_issue})


FLAGS = ("too_many_missing", "too_many_duplicates", "too_many_bad_dates", "too_many_invalid", "any_issue")


def dq_report(
    df: DataFrame, roles: Roles, limits: QualityLimits = QualityLimits(), cleaning: Cleaning = Cleaning()
) -> DataFrame:
    """Metrics and flags before and after cleaning: ``batch, before, after, flags_before, flags_after``."""
    return clean_with_report(df, roles, limits, cleaning)[1]


def clean_with_report(
    df: DataFrame, roles: Roles, limits: QualityLimits = QualityLimits(), cleaning: Cleaning = Cleaning()
) -> tuple[DataFrame, DataFrame]:
    """The cleaned rows, and the report on both sides of the cleaning.

    The collapsed rows are written once and serve as both the "before" input and the de-duplicated
    start of the cleaning. Batches that cleaning empties keep their "before" side.
    """
    by = [c for c in roles.by if c in df.columns]
    rows = stored(collapse(df))
    before = _packed(quality_flags(collapsed_metrics(rows, roles), limits), by, "before")
    if cleaning.drop_duplicates:
        start = rows.drop(COPIES)
    else:
        start = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(COPIES)))).drop(COPIES, "_copy")
    cleaned = clean(start, roles, replace(cleaning, drop_duplicates=False)).select(*df.columns)
    after = _packed(quality_flags(dq_metrics(cleaned, roles), limits), by, "after")
    joined = before.join(after, by, "left") if by else before.withColumns({c: after.select(c).scalar() for c in after.columns})
    return cleaned, joined.select(*by, "before", "after", "flags_before", "flags_after")


def _packed(metrics: DataFrame, by: list[str], when: str) -> DataFrame:
    measured = [c for c in metrics.columns if c not in by and c not in FLAGS]
    return metrics.select(*by, F.struct(*measured).alias(when), F.struct(*FLAGS).alias(f"flags_{when}"))


def invalid_breakdown(metrics: DataFrame, roles: Roles) -> DataFrame:
    """One row per batch and validity check."""
    return metrics.select(*roles.by, F.explode("invalid_breakdown").alias("check", "ratio"))


def missing_breakdown(metrics: DataFrame, roles: Roles) -> DataFrame:
    """One row per batch and column."""
    return metrics.select(*roles.by, F.explode("missing_per_column").alias("column_name", "ratio"))


def duplicates(df: DataFrame, roles: Roles) -> DataFrame:
    """Rows, distinct rows and duplicate ratio per batch."""
    by = [c for c in roles.by if c in df.columns]
    counts = collapse(df).groupBy(*by).agg(F.sum(COPIES).alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))
    repeated = F.col("n_rows") - F.col("n_distinct")
    return counts.withColumn("duplicate_ratio", ratio(repeated, F.col("n_rows")))
