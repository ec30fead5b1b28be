"""Session set-up, checkpointing, and joins that measure a side before broadcasting it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A statistics table is broadcast only when its measured size is below this.
BROADCAST_BYTES = 64 * 1024 * 1024


def local_session(app: str = "tidewatch", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and laptops; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder in ``spark.checkpoint.dir``; make one up only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="tidewatch-checkpoint-")
    context.setCheckpointDir(shared)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder now, so later plans read it instead of redoing it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name on the shared checkpoint storage."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The same as Parquet in the scratch folder: for tables with a row per input row or more, which take a fraction of a checkpoint's disk."""
    if "void" in dict(df.dtypes).values():
        return materialize(df)
    folder = scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def materialize_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """The same, with the number of rows written."""
    written = materialize(df)
    return written, written.count()


def row_width(schema: T.StructType) -> int:
    """Rough bytes per row, used with a measured row count."""
    width = 16
    for field in schema.fields:
        if isinstance(field.dataType, (T.ArrayType, T.MapType)):
            width += 512
        elif isinstance(field.dataType, T.StringType):
            width += 64
        elif isinstance(field.dataType, T.StructType):
            width += row_width(field.dataType)
        else:
            width += 16
    return width


def sized(stats: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark a table for broadcast if its counted size allows it."""
    rows = stats.count() if rows is None else rows
    if rows * row_width(stats.schema) <= BROADCAST_BYTES:
        return F.broadcast(stats)
    return stats


def attach(rows: DataFrame, stats: DataFrame, keys: list[str], groups: int | None = None) -> DataFrame:
    """Left-join per-group statistics onto rows.

    ``groups`` is the number of groups if a count of them was already made; otherwise the statistics
    are written and counted first. A small table is broadcast, so the rows are not shuffled; a large
    one is left to a shuffled join, where adaptive execution splits hot keys. Without keys the single
    statistics row becomes literals.
    """
    if not keys:
        row = stats.first()
        return rows.withColumns({c: F.lit(row[c]).cast(stats.schema[c].dataType) for c in stats.columns})
    if groups is None:
        stats, groups = materialize_counted(stats)
    return rows.join(sized(stats, groups), keys, "left")


def ratio(part: Column, whole: Column, empty: float = 0.0) -> Column:
    """``part / whole`` as double, ``empty`` when there is nothing to divide by."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(empty))
