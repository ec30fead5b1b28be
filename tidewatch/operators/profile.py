"""Batch and column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.roles import Roles
from tidewatch.session import ratio


def _columns(df: DataFrame, roles: Roles) -> list[str]:
    return [c for c in df.columns if c not in roles.by]


def batch_profile(df: DataFrame, roles: Roles) -> DataFrame:
    """Rows, columns and the share of filled cells per batch."""
    columns = _columns(df, roles)
    filled = sum((F.count(c) for c in columns), F.lit(0))
    counted = df.groupBy(*roles.by).agg(F.count(F.lit(1)).alias("total_rows"), filled.alias("_filled"))
    return counted.select(
        *roles.by,
        "total_rows",
        F.lit(len(columns)).alias("columns_count"),
        ratio(F.col("_filled"), F.col("total_rows") * len(columns)).alias("data_quality"),
    )


def column_profile(df: DataFrame, roles: Roles, approximate: bool = False) -> DataFrame:
    """Type, missing and distinct counts, and min/max/mean of numbers, per batch and column.

    All but the distinct counts is one aggregate combined before its shuffle. Exact distinct counts take a second
    pass that shuffles each distinct cell text once; ``approximate`` sketches them in the first pass instead.
    """
    columns = _columns(df, roles)
    numeric = {c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)}
    profile = _measured(df, roles, columns, numeric, approximate)
    if approximate:
        return profile
    cells = F.inline(F.array(*[F.struct(F.lit(i).alias("ordinal"), F.col(c).cast("string").alias("text")) for i, c in enumerate(columns)]))
    distinct = df.select(*roles.by, cells).where("text is not null").distinct()
    counts = distinct.groupBy(*roles.by, "ordinal").agg(F.count(F.lit(1)).alias("_distinct"))
    joined = profile.join(counts, [*roles.by, "ordinal"], "left")
    return joined.withColumn("unique_count", F.coalesce("_distinct", F.lit(0).cast("bigint"))).select(*profile.columns)


def _measured(df: DataFrame, roles: Roles, columns: list[str], numeric: set[str], approximate: bool) -> DataFrame:
    nothing = F.lit(None).cast("double")

    def measured(ordinal: int, c: str):
        number = F.col(c).cast("double")
        return F.struct(
            F.lit(ordinal).alias("ordinal"),
            F.lit(c).alias("column_name"),
            F.lit("numeric" if c in numeric else "categorical").alias("data_type"),
            F.count(F.when(F.col(c).isNull(), 1)).alias("null_count"),
            (F.approx_count_distinct(c) if approximate else F.lit(0).cast("bigint")).alias("unique_count"),
            (F.min(number) if c in numeric else nothing).alias("min_value"),
            (F.max(number) if c in numeric else nothing).alias("max_value"),
            (F.avg(number) if c in numeric else nothing).alias("mean_value"),
        )

    stats = F.array(*[measured(i, c) for i, c in enumerate(columns)])
    return df.groupBy(*roles.by).agg(stats.alias("s")).select(*roles.by, F.inline("s"))


def top_missing(profile: DataFrame, roles: Roles, k: int = 5) -> DataFrame:
    """The ``k`` columns of each batch that miss most, ties in column order."""
    ranked = Window.partitionBy(*roles.by).orderBy(F.desc("null_count"), "ordinal")
    return profile.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
