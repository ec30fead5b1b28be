"""Exact interpolated quantiles per group, for groups of any size. NaN counts as missing.

Values are located by repeated counting: rows are counted per value range (a map-side combined
aggregate, so a hot group adds no shuffle), only the ranges that hold a wanted rank are kept, and
those ranges are split further until each is small enough to sort. Groups that are small enough as a whole are sorted at once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import materialize, sized

# Largest range of values, or group, that is sorted in one task.
MAX_IN_TASK = 100_000
CELLS = 4096


def quantiles(
    df: DataFrame,
    by: Sequence[str],
    columns: Sequence[str],
    probs: Sequence[float],
    in_task: int = MAX_IN_TASK,
) -> DataFrame:
    """One row per group and column: ``by..., column, q`` with ``q`` in the order of ``probs``.

    Groups of at most ``in_task`` rows meet in one task each, all columns together; larger ones stay where they are and are narrowed down.
    """
    by, columns, probs = list(by), list(columns), [float(p) for p in probs]
    whole = F.lit(True)
    for c in by:
        whole = whole & F.col(c).isNotNull()
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_small", whole & (F.col("_rows") <= in_task))
    groups, small = sizes.agg(F.count(F.lit(1)), F.count_if("_small")).first()
    if small == groups:
        return _sorted(df, by, columns, probs)
    if small == 0:
        return _narrowed(df, by, columns, probs, in_task)
    picked = sized(materialize(sizes.where("_small").select(*by)), small)
    rest = _narrowed(df.join(picked, by, "left_anti"), by, columns, probs, in_task)
    return _sorted(df.join(picked, by, "left_semi"), by, columns, probs).unionByName(rest)


def _sorted(df: DataFrame, by: list[str], columns: list[str], probs: list[float]) -> DataFrame:
    wide = df.select(*by, *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    fields = {f.name: f.dataType.simpleString() for f in wide.schema.fields}
    schema = ", ".join([f"`{c}` {fields[c]}" for c in by] + ["`column` string, q array<double>"])

    def of_group(table: pa.Table) -> pa.Table:
        names, found = [], []
        for i, c in enumerate(columns):
            values = table[f"_{i}"].to_numpy()
            values = np.sort(values[~np.isnan(values)])
            if len(values):
                at = (len(values) - 1) * np.array(probs)
                below, above = values[np.floor(at).astype("int64")], values[np.ceil(at).astype("int64")]
                names.append(c)
                found.append(below + (above - below) * (at - np.floor(at)))
        keys = {c: table[c].take(np.zeros(len(names), dtype="int64")) for c in by}
        return pa.table(keys | {"column": pa.array(names, pa.string()), "q": pa.array(found, pa.list_(pa.float64()))})

    return wide.groupBy(*by).applyInArrow(of_group, schema)


def _narrowed(df: DataFrame, by: list[str], columns: list[str], probs: list[float], in_task: int) -> DataFrame:
    keys = by + ["column"]
    positions = [(lambda total, p=p: (total - 1) * F.lit(p)) for p in probs]
    at = _located(_long(df, by, columns), keys, positions, in_task)
    return at.select(*keys, F.array(*[_interpolated(position(F.col("total"))) for position in positions]).alias("q"))


def kth_smallest(df: DataFrame, by: Sequence[str], column: str, k: Callable[[Column], Column], in_task: int = MAX_IN_TASK) -> DataFrame:
    """``by..., kth``: the k-th smallest value (from 1) of each group, ``k`` a function of the group size.

    Groups where ``k`` is below 1 are left out.
    """
    by = list(by)
    at = _located(_long(df, by, [column]), by + ["column"], [lambda total: k(total) - 1], in_task)
    rank = (k(F.col("total")) - 1).cast("bigint")
    return at.where(k(F.col("total")) >= 1).select(*by, F.col("at")[rank].alias("kth"))


def wide_quantiles(df: DataFrame, by: Sequence[str], columns: Sequence[str], probs: Sequence[float], in_task: int = MAX_IN_TASK) -> DataFrame:
    """The same in one row per group, with one array column per input column; groups without any value have none."""
    by, columns = list(by), list(columns)
    long = quantiles(df, by, columns, probs, in_task)
    picked = [F.first(F.when(F.col("column") == c, F.col("q")), ignorenulls=True).alias(c) for c in columns]
    return long.groupBy(*by).agg(*picked)


def group_sizes(df: DataFrame, by: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest group, and number of groups."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    largest, groups = sizes.agg(F.max("n"), F.count(F.lit(1))).first()
    return largest or 0, groups


def _long(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    doubles = [F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns]
    return df.select(*by, *doubles).unpivot(by, columns, "column", "value").where("value is not null")


def _slot(value: Column) -> Column:
    """A coarse number that never decreases when the value increases."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * 256).cast("bigint")


def _cell(value: Column) -> Column:
    share = (value - F.col("low")) / (F.col("high") - F.col("low"))
    return F.least(F.floor(share * CELLS), F.lit(CELLS - 1)).cast("bigint")


def _ranks(positions: list[Callable[[Column], Column]]) -> Column:
    """Zero-based ranks around each wanted position of a group with ``total`` rows."""
    wanted = []
    for position in positions:
        at = position(F.col("total"))
        wanted += [F.floor(at), F.ceil(at)]
    return F.array_distinct(F.array(*[w.cast("bigint") for w in wanted]))


def _keep_hit(ranges: DataFrame) -> DataFrame:
    """Keep the ranges that contain a wanted rank, and in each only the ranks it contains."""
    inside = F.filter("ranks", lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n")))
    return ranges.withColumn("ranks", inside).where(F.size("ranks") > 0)


def _located(values: DataFrame, keys: list[str], positions: list[Callable[[Column], Column]], in_task: int) -> DataFrame:
    """``keys..., total, at``: group size and a map from each wanted rank to its value."""
    slots = values.groupBy(*keys, _slot(F.col("value")).alias("slot")).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    ordered = Window.partitionBy(*keys).orderBy("slot")
    found = (
        slots.withColumn("before", F.sum("n").over(ordered) - F.col("n"))
        .withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
        .withColumn("ranks", _ranks(positions))
    )
    kept = ["low", "high", "n", "before", "total", "ranks"]
    found = materialize(_keep_hit(found).select(*keys, *kept))
    while True:
        count, biggest = found.agg(F.count(F.lit(1)), F.max(F.when(F.col("low") < F.col("high"), F.col("n")))).first()
        inside = values.join(sized(found.where("low < high"), count), keys).where(F.col("value").between(F.col("low"), F.col("high")))
        if (biggest or 0) <= in_task:
            break
        cells = inside.groupBy(*keys, "low", "high", "before", "total", "ranks", _cell(F.col("value")).alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("lowest"), F.max("value").alias("highest")
        )
        within = Window.partitionBy(*keys, "low").orderBy("cell")
        finer = cells.withColumn("before", F.col("before") + F.sum("n").over(within) - F.col("n"))
        finer = finer.drop("low", "high").withColumnsRenamed({"lowest": "low", "highest": "high"})
        done = found.where("low = high").select(*keys, *kept)
        found = materialize(_keep_hit(finer).select(*keys, *kept).unionByName(done))

    counted = inside.groupBy(*keys, "low", "before", "total", "ranks", "value").agg(F.count(F.lit(1)).alias("n"))
    within = Window.partitionBy(*keys, "low").orderBy("value")
    placed = _keep_hit(counted.withColumn("before", F.col("before") + F.sum("n").over(within) - F.col("n")))
    single = found.where("low = high").withColumn("value", F.col("low"))
    hits = placed.select(*keys, "total", "ranks", "value").unionByName(single.select(*keys, "total", "ranks", "value"))
    pairs = hits.select(*keys, "total", F.explode("ranks").alias("rank"), "value")
    return pairs.groupBy(*keys).agg(
        F.first("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at")
    )


def _interpolated(position: Column) -> Column:
    below = F.col("at")[F.floor(position).cast("bigint")]
    above = F.col("at")[F.ceil(position).cast("bigint")]
    return below + (above - below) * (position - F.floor(position))
