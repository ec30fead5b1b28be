"""Writers for raw batches, cleaned data, reports, rules, scores and performance history."""

from __future__ import annotations

import heapq
import os
import shutil
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.rules import top_rules
from tidewatch.roles import Roles
from tidewatch.sources.files import path_exists

RULE_SCHEMA = "support double, confidence double, lift double, antecedents_str string, consequents_str string"
PERFORMANCE_SCHEMA = "batch_num long, accuracy double, f1 double, inference_time double, ts timestamp"
FLAT = (T.NumericType, T.StringType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _plain(df: DataFrame) -> DataFrame:
    """Dates as ISO text, for CSV."""
    dated = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in dated})


# Folders and rows that one task writes at most, about.
FOLDERS_IN_TASK = 100
ROWS_IN_TASK = 250_000
# The same where a task opens the files itself, see ``_write_local``.
LOCAL_FOLDERS_IN_TASK = 500


def gathered(df: DataFrame, keys: Sequence[str], folders_in_task: int | None = None) -> DataFrame:
    """The rows in ranges of ``keys``, so that a table written by ``keys`` has about one file per key and one more per range, however
    many tasks held a key's rows before.

    Rows of equal keys are dealt over ranges at random, so a huge batch is no hot task. ``df`` is read three times: callers write it once before.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    folders, rows = sizes.agg(F.count(F.lit(1)), F.sum("n")).first()
    ranges = max(-(-folders // (folders_in_task or FOLDERS_IN_TASK)), -(-(rows or 0) // ROWS_IN_TASK), 1)
    return df.withColumn("_dealt", F.rand(0)).repartitionByRange(ranges, *keys, "_dealt").drop("_dealt")


def write_batches(df: DataFrame, path: str, keys: Sequence[str] = ("source", "batch_num"), fmt: str = "parquet", max_rows: int = 1_000_000) -> None:
    """Raw batches under one folder per key. Large batches are split over files of ``max_rows`` rows.

    A batch's rows are gathered in few files, a huge batch in many tasks. Batches that are not written now stay as they are.
    """
    writer = gathered(df, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_rows).partitionBy(*keys)
    writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)


def _local_path(df: DataFrame, path: str, by: Sequence[str]) -> str | None:
    """``path`` as tasks can open it, if it is on a local or mounted disk and the folders are named by one whole number."""
    if len(by) != 1 or not isinstance(df.schema[by[0]].dataType, T.IntegralType) or len(df.columns) < 2:
        return None
    spark = df.sparkSession
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(hadoop_path).toUri().getPath() if files.getUri().getScheme() == "file" else None


def _write_local(df: DataFrame, root: str, key: str) -> None:
    """Folders by ``key`` under a local path, replacing those of the same numbers: text lines if the one other column is ``value``, else Parquet.

    The same as Spark's writer with dynamic overwrite, but a file costs a fraction of a millisecond instead of tens of them: on a local
    disk without its native library Hadoop starts processes for every file. Tasks write to a staging folder, each attempt to its own;
    when all have ended the folders of the attempts that count are moved to their places.
    """
    os.makedirs(root, exist_ok=True)
    staging = f"{root}/.staging-{uuid.uuid4().hex}"
    lines = set(df.columns) == {key, "value"}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        attempt = f"{task.partitionId()}-{task.taskAttemptId()}"
        number, file = (), None
        for batch in batches:
            rows = batch.drop_columns([key])
            values = batch.column(key).to_pylist()
            at = 0
            while at < len(values):
                to = next((i for i in range(at, len(values)) if values[i] != values[at]), len(values))
                if values[at] != number:
                    if file is not None:
                        file.close()
                    number = values[at]
                    folder = f"{staging}/{attempt}/{key}={'__HIVE_DEFAULT_PARTITION__' if number is None else number}"
                    os.makedirs(folder)
                    name = f"{folder}/part-{task.partitionId():05d}-{uuid.uuid4().hex}"
                    file = open(f"{name}.json", "w", encoding="utf-8", newline="") if lines else pq.ParquetWriter(f"{name}.snappy.parquet", rows.schema)
                part = rows.slice(at, to - at)
                file.writelines(f"{line}\n" for line in part.column(0).to_pylist()) if lines else file.write_batch(part)
                at = to
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_pydict({"attempt": [attempt]})

    dealt = gathered(df, [key], LOCAL_FOLDERS_IN_TASK).sortWithinPartitions(key)
    try:
        attempts = [r[0] for r in dealt.mapInArrow(write, "attempt string").collect()]
        moved = set()
        for attempt in attempts:
            for name in os.listdir(f"{staging}/{attempt}"):
                source, target = f"{staging}/{attempt}/{name}", f"{root}/{name}"
                if name in moved:
                    for file in os.listdir(source):
                        os.rename(f"{source}/{file}", f"{target}/{file}")
                    continue
                if os.path.isdir(target):
                    shutil.rmtree(target)
                os.rename(source, target)
                moved.add(name)
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def write_analyzed(df: DataFrame, path: str, roles: Roles, fmt: str = "parquet") -> None:
    """Cleaned rows by batch; only the batches present are replaced."""
    out = _plain(df) if fmt == "csv" else df
    root = _local_path(df, path, roles.by) if fmt == "parquet" else None
    if root is not None and all(isinstance(f.dataType, FLAT) for f in df.schema.fields):
        return _write_local(df.select(*[c for c in df.columns if c not in roles.by], *roles.by), root, roles.batch)
    writer = gathered(out, roles.by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*roles.by)
    writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)


def write_reports(df: DataFrame, path: str, roles: Roles) -> None:
    """Nested reports (quality, consistency, drift) as JSON lines by batch; rewriting a batch replaces it."""
    root = _local_path(df, path, roles.by)
    if root is not None:
        line = F.to_json(F.struct(*[c for c in df.columns if c not in roles.by])).alias("value")
        return _write_local(df.select(*roles.by, line), root, roles.batch)
    gathered(df, roles.by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*roles.by).json(path)


def write_rules(rules: DataFrame, path: str, roles: Roles, k: int = 5) -> None:
    """A small rule table as CSV with header, also when empty."""
    top_rules(rules, roles, k).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RULE_SCHEMA).parquet(path)


def pin_rules(spark: SparkSession, path: str, mine) -> DataFrame:
    """The reference rules at ``path``; mined by ``mine()`` and stored only when there are none yet."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        rules = mine().select("support", "confidence", "lift", "antecedents_str", "consequents_str")
        rules.coalesce(1).write.mode("ignore").parquet(path)
    return read_rules(spark, path)


def write_scored(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Input columns plus ``predict``."""
    out = df.withColumnRenamed("prediction", "predict").drop("features", "score", "rawPrediction", "probability")
    out.write.mode("overwrite").option("header", True).csv(path) if fmt == "csv" else out.write.mode("overwrite").parquet(path)


def append_performance(df: DataFrame, path: str, roles: Roles) -> None:
    """Performance rows, one folder per batch, so a repeated batch does not double."""
    gathered(df, roles.by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*roles.by).parquet(path)


def read_history(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """A history table, empty when nothing was written yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)


def newest_folders(spark: SparkSession, path: str, roles: Roles, n: int) -> list[str]:
    """The folders of the ``n`` highest batch numbers of a table written by batch. Names are listed; no file is opened."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{roles.batch}=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    numbers = [status.getPath().getName().split("=", 1)[1] for status in found]
    highest = heapq.nlargest(n, (int(number) for number in numbers if number.lstrip("-").isdigit()))
    return [f"{path.rstrip('/')}/{roles.batch}={number}" for number in highest]


def read_newest(spark: SparkSession, path: str, roles: Roles, n: int = 10, schema: T.StructType | str | None = None, fmt: str = "json") -> DataFrame:
    """The rows of the newest ``n`` batches of a table written by batch: only their folders are read, however long the history is.

    A report table has one row a batch, so these are its newest ``n`` rows. Rows without a batch number are not among them. An empty
    table needs a ``schema``.
    """
    folders = newest_folders(spark, path, roles, n)
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", path).format(fmt)
    found = (reader.schema(schema) if schema is not None else reader).load(folders)
    return found.withColumn(roles.batch, F.col(roles.batch).cast("bigint"))
