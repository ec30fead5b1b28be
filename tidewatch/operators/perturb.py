"""Deterministic table changes for testing monitors: relabelled rows, shifted columns, spikes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.hashing import key_hash
from tidewatch.functions.order_stats import group_sizes, kth_smallest
from tidewatch.roles import Roles
from tidewatch.session import attach


def _chosen(df: DataFrame, roles: Roles, key: str, strength: float, start: int, seed: int) -> DataFrame:
    """Mark ``_chosen``: the int(rows * strength) rows of each active batch with the lowest key hash.

    The cut is an exact order statistic, so a batch is never sorted in one task.
    """
    hashed = df.withColumn("_hash", key_hash(df, key, seed))
    active = hashed.where(F.col(roles.batch) >= start)
    _, groups = group_sizes(active, roles.by)
    limit = kth_smallest(active, roles.by, "_hash", lambda n: F.floor(n * F.lit(strength)))
    joined = attach(hashed, limit.withColumnRenamed("kth", "_limit"), roles.by, groups)
    return joined.withColumn("_chosen", F.coalesce(F.col("_hash") <= F.col("_limit"), F.lit(False)))


def overwrite_target(df: DataFrame, roles: Roles, key: str, strength: float, start: int = 0, seed: int = 7) -> DataFrame:
    """Concept change: set the target of a share of rows to 1."""
    chosen = _chosen(df, roles, key, strength, start, seed)
    one = F.lit(1).cast(df.schema[roles.target].dataType)
    return chosen.withColumn(roles.target, F.when(F.col("_chosen"), one).otherwise(F.col(roles.target))).select(*df.columns)


def _spread(df: DataFrame, roles: Roles, columns: Sequence[str]) -> DataFrame:
    stats = [F.avg(c).alias(f"_mean_{c}") for c in columns] + [F.stddev_samp(c).alias(f"_std_{c}") for c in columns]
    return attach(df, df.groupBy(*roles.by).agg(*stats), roles.by)


def shift_columns(df: DataFrame, roles: Roles, columns: Sequence[str], strength: float, start: int = 0, first: int = 3) -> DataFrame:
    """Covariate change: add ``strength`` batch deviations to the first columns that are not the target."""
    moved = [c for c in columns if c in df.columns and c != roles.target][:first]
    spread = _spread(df, roles, moved)
    active = F.col(roles.batch) >= start
    shifted = {c: F.col(c) + F.when(active, F.coalesce(F.col(f"_std_{c}"), F.lit(0.0)) * strength).otherwise(0.0) for c in moved}
    return spread.withColumns(shifted).select(*df.columns)


def add_spikes(
    df: DataFrame, roles: Roles, key: str, columns: Sequence[str], strength: float, start: int = 0, seed: int = 7, reach: float = 5.0
) -> DataFrame:
    """Anomalies: one cell in each of a share of rows becomes mean plus or minus ``reach`` deviations.

    Row, column and sign all follow from the key's hash. Batch statistics are those before the change.
    """
    used = [c for c in columns if c in df.columns and c != roles.target]
    spread = _spread(_chosen(df, roles, key, strength, start, seed), roles, used)
    pick = F.pmod(F.col("_hash"), F.lit(len(used)))
    sign = F.when(F.pmod(F.floor(F.col("_hash") / len(used)), F.lit(2)) == 0, 1.0).otherwise(-1.0)

    def spiked(i: int, c: str) -> Column:
        value = F.col(f"_mean_{c}") + sign * reach * F.col(f"_std_{c}")
        return F.when(F.col("_chosen") & (pick == i), value).otherwise(F.col(c).cast("double"))

    return spread.withColumns({c: spiked(i, c) for i, c in enumerate(used)}).select(*df.columns)
