"""Readers for raw files: one CSV, a folder of policy files, several sources in order, stored batches."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.coerce import coerce
from tidewatch.functions.running import running_totals
from tidewatch.roles import POLICY_COLUMNS, POLICY_DATES, POLICY_NUMBERS
from tidewatch.session import materialize, sized
from tidewatch.sources.batching import cut_batches, index_rows, with_file_position


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    matches = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop_path)
    return matches is not None and len(matches) > 0


def read_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    """A CSV with header as text columns; without ``columns`` the header names them. All files have the same header."""
    if columns:
        return spark.read.schema(text_schema(columns)).option("header", True).csv(path)
    return spark.read.option("header", True).csv(path)


def read_policy_folder(spark: SparkSession, folder: str) -> DataFrame:
    """All CSV files of a folder under the 15 policy names, by position; unreadable files are skipped."""
    pattern = f"{folder.rstrip('/')}/*.csv"
    if not path_exists(spark, pattern):
        raise FileNotFoundError(f"no CSV files in {folder}")
    reader = spark.read.schema(text_schema(POLICY_COLUMNS)).option("header", True).option("enforceSchema", True)
    return reader.option("ignoreCorruptFiles", True).csv(pattern)


def typed_policies(df: DataFrame) -> DataFrame:
    return coerce(df, POLICY_DATES, POLICY_NUMBERS)


def read_sources(spark: SparkSession, paths: Sequence[str], batch_rows: int) -> DataFrame:
    """Several CSV sources one after another, cut into batches by row count in file order.

    Missing paths are skipped; the batch counter goes on across sources. Columns are united by name.
    """
    present = [p for p in paths if path_exists(spark, p)]
    if not present:
        raise FileNotFoundError("none of the sources exists")
    parts = [with_file_position(read_csv(spark, p)).withColumn("source", F.lit(p)) for p in present]
    indexed = [index_rows(part) for part in parts]
    united = indexed[0]
    for part in indexed[1:]:
        united = united.unionByName(part, allowMissingColumns=True)
    return cut_batches(united, batch_rows, present)


def storage_volume(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Number of files and total megabytes; file contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return files.agg(F.count(F.lit(1)).alias("files"), (F.coalesce(F.sum("length"), F.lit(0)) / 1048576).alias("megabytes"))


def read_stored_batches(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Every stored raw file, numbered as a batch in name order (from 1), each under its own header's names.

    Files of one header are one scan, and the scans are united by name. Files without a header line hold no rows and are
    not counted. Paths are taken from the scans themselves, so names may hold blanks and other odd characters.
    """
    pattern = f"{folder.rstrip('/')}/*.csv"
    if not path_exists(spark, pattern):
        raise FileNotFoundError(f"no CSV files in {folder}")
    lines = spark.read.text(pattern).select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_at"), "value")
    headers = materialize(lines.where("_at = 0 and trim(value) <> ''").groupBy("_path").agg(F.first("value").alias("header")))
    named = headers.withColumns({"_name": F.url_decode(F.replace("_path", F.lit("+"), F.lit("%2B"))), "_one": F.lit(1).cast("bigint")})
    order = materialize(running_totals(named, ["_name", "_path"], {"_before": "_one"}).select("_path", (F.col("_before") + 1).alias("batch_num")))
    united = None
    for row in headers.groupBy("header").agg(F.array_sort(F.collect_list("_path")).alias("paths")).orderBy(F.col("paths")[0]).collect():
        paths = [unquote(p) for p in row["paths"]]
        names = columns or read_csv(spark, paths[0]).columns
        part = read_csv(spark, paths, names).withColumn("_path", F.col("_metadata.file_path"))
        united = part if united is None else united.unionByName(part, allowMissingColumns=True)
    if united is None:
        raise FileNotFoundError(f"no CSV file in {folder} has a header")
    return united.join(sized(order), "_path").drop("_path")
