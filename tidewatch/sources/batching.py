"""Cutting tables into batches of a fixed number of rows, without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.running import running_totals
from tidewatch.session import materialize_counted, sized


def with_file_position(df: DataFrame) -> DataFrame:
    """Add the hidden file columns that fix a row's place: file, split start, row inside the split.

    ``df`` must be a plain file scan. Row ids grow within a split in file order, in every format.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_row"),
    )


def index_rows(df: DataFrame, source: str = "source") -> DataFrame:
    """Dense zero-based ``row_index`` per source, in file order, from ``with_file_position`` columns.

    Only one row per file split is aggregated and accumulated; the data rows are not shuffled.
    """
    splits = df.groupBy(source, "_file", "_split").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy(source).orderBy("_file", "_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    placed = df.join(sized(*materialize_counted(starts)), [source, "_file", "_split"])
    index = F.col("_start") + F.col("_row") - F.col("_first")
    return placed.withColumn("row_index", index).drop("_file", "_split", "_row", "_first", "_start")


def index_by_order(df: DataFrame, order: Sequence[str], source: str = "source") -> DataFrame:
    """Dense zero-based ``row_index`` per source in the order of columns that identify a row."""
    return running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), order, {"row_index": "_one"}, by=[source]).drop("_one")


def cut_batches(df: DataFrame, batch_rows: int, sources: Sequence[str], source: str = "source") -> DataFrame:
    """Add ``batch_index`` (in its source) and ``batch_num`` (over all sources) from ``row_index``.

    ``sources`` lists the sources in reading order; the counter goes on from one to the next. There is
    one offset per listed source, so the offsets can be broadcast.
    """
    sizes = source_sizes(df, batch_rows, sources, source)
    earlier = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(source, F.coalesce(F.sum("total_batches").over(earlier), F.lit(0)).alias("_before"))
    indexed = df.withColumn("batch_index", batch_of(F.col("row_index"), batch_rows))
    joined = indexed.join(F.broadcast(offsets), source)
    return joined.withColumn("batch_num", F.col("_before") + F.col("batch_index")).drop("_before")


def batch_of(row_index: Column, batch_rows: int) -> Column:
    return F.floor(row_index / F.lit(batch_rows)).cast("bigint") + 1


def source_sizes(df: DataFrame, batch_rows: int, sources: Sequence[str], source: str = "source") -> DataFrame:
    """Rows and batches per source; one row per source."""
    position = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col(source))
    counted = df.groupBy(source).agg(F.count(F.lit(1)).alias("total_rows"))
    batches = F.ceil(F.col("total_rows") / batch_rows).cast("bigint")
    return counted.select(source, position.alias("position"), "total_rows", batches.alias("total_batches"))


def batch_info(df: DataFrame, batch_rows: int, sources: Sequence[str], source: str = "source") -> DataFrame:
    """One row per batch: its place and half-open row range in its source."""
    cut = df.groupBy(source, "batch_num", "batch_index").agg(F.min("row_index").alias("start_row"), (F.max("row_index") + 1).alias("end_row"))
    sizes = source_sizes(df, batch_rows, sources, source).select(source, "total_batches")
    joined = cut.join(F.broadcast(sizes), source)
    return joined.select(source, "batch_num", "batch_index", "total_batches", "start_row", "end_row")
