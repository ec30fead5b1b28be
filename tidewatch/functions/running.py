"""Running totals over a sorted table without pulling it into one partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import materialize, materialize_counted, sized

# Rows per slice of the sorted table.
SLICE_ROWS = 50_000


def running_totals(
    df: DataFrame, order: Sequence[str], sums: dict[str, str], by: Sequence[str] = (), slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Add ``sums`` (new name -> summed column), each the total over the rows before this one.

    The rows are range-partitioned by ``by + order`` into slices of about ``slice_rows`` and written once, so each
    slice is a fixed run of the sorted table. Slices are summed (one row each), the sums are accumulated, and a window
    inside every slice finishes the work. ``by + order`` must identify a row, which callers ensure
    by aggregating equal keys first; then no slice can be hot.
    """
    by, order = list(by), list(order)
    df, rows = materialize_counted(df)
    slices = -(-rows // slice_rows) or 1
    sliced = materialize(df.repartitionByRange(slices, *by, *order).withColumn("_slice", F.spark_partition_id()))
    slices = sliced.groupBy(*by, "_slice").agg(*[F.sum(c).alias(f"_{name}") for name, c in sums.items()])
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(*by, "_slice", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums])
    inside = Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = sliced.join(sized(*materialize_counted(offsets)), by + ["_slice"])
    totals = {n: F.col(f"_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()}
    return joined.withColumns(totals).drop("_slice", *[f"_{n}" for n in sums])


def running_maximum(df: DataFrame, order: Sequence[str], column: str, name: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``name``, the largest ``column`` over the rows before this one, null if there is none; sliced as in ``running_totals``."""
    order = list(order)
    df, rows = materialize_counted(df)
    slices = -(-rows // slice_rows) or 1
    sliced = materialize(df.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    tops = sliced.groupBy("_slice").agg(F.max(column).alias("_top")).select("_slice", F.max("_top").over(earlier).alias("_top"))
    inside = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = sliced.join(sized(*materialize_counted(tops)), "_slice")
    return joined.withColumn(name, F.greatest("_top", F.max(column).over(inside))).drop("_slice", "_top")
