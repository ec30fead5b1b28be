"""Folders that may hold broken files: every file is judged before it is read, and what was skipped is reported with the reason."""

from __future__ import annotations

import codecs
import gzip
import zlib
from collections.abc import Iterator, Sequence
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import materialize
from tidewatch.sources.files import path_exists, read_csv

OUTCOME_SCHEMA = "path string, bytes long, rows long, bad_records long, skipped boolean, why string"
CHUNK = 1 << 20
EMPTY, BINARY, BROKEN = "no rows", "not UTF-8 text", "cannot be unpacked"


def _local(path: str) -> str:
    """A scan's path as ``pyarrow.fs`` wants it: schemes other than ``file`` stay."""
    parts = urlparse(path)
    return unquote(parts.path) if parts.scheme in ("", "file") else unquote(path)


def _unpack(path: str) -> str | None:
    """Why a packed file cannot be read to its end as text, or None; errors of the storage are raised. One chunk is in memory."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path) if urlparse(path).scheme not in ("", "file") else (fs.LocalFileSystem(), _local(path))
    decoder, seen = codecs.getincrementaldecoder("utf-8")(), False
    try:
        with system.open_input_file(inner) as raw, gzip.open(raw) as stream:
            while chunk := stream.read(CHUNK):
                seen = True
                if b"\0" in chunk:
                    return BINARY
                decoder.decode(chunk)
            decoder.decode(b"", final=True)
    except UnicodeDecodeError:
        return BINARY
    except (EOFError, gzip.BadGzipFile, zlib.error) as error:
        return f"{BROKEN}: {type(error).__name__}"
    return None if seen else EMPTY


def _unpacked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield frame.assign(why=[_unpack(path) for path in frame["path"]])[["path", "why"]]


def _listing(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, int]]:
    """Name and size of every file; scans leave out empty ones, so the file system is asked."""
    found = []
    for path in paths:
        pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
        for status in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []:
            if status.isFile():
                found.append((status.getPath().toString(), status.getLen()))
    return found


def judge_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, bytes, why``: every file under the paths (globs), with the reason not to read it or null.

    Plain files are judged by a scan of their lines, which splits large ones: a line that is not UTF-8 or holds a NUL byte makes the file binary.
    Packed files (``.gz``), which no scan can split anyway, are unpacked to the end by one task each, so a damaged one does not
    fail a job. Files without a line are listed as empty.
    """
    listed = materialize(spark.createDataFrame(_listing(spark, paths), "path string, bytes long"))
    packed = F.endswith("path", F.lit(".gz"))
    tasks = max(1, min(listed.where(packed).count(), 4096))
    whys = listed.where(packed).select("path").repartition(tasks, "path").mapInPandas(_unpacked, "path string, why string")
    names = [_local(r["path"]) for r in listed.where(~packed & (F.col("bytes") > 0)).select("path").collect()]  # the scan needs them by name
    if names:
        lines = spark.read.text(names).select(F.col("_metadata.file_path").alias("path"), "value")
        odd = ~F.is_valid_utf8("value") | F.contains("value", F.lit("\0"))
        plain = lines.groupBy("path").agg(F.when(F.max(odd), BINARY).when(F.max(F.trim("value") != ""), F.lit(None)).otherwise(EMPTY).alias("why"))
        whys = whys.unionByName(plain)
    key = F.regexp_replace("path", r"^file:/+", "/")
    whys = whys.withColumn("_key", F.url_decode(F.replace(key, F.lit("+"), F.lit("%2B")))).drop("path").withColumn("_judged", F.lit(True))
    named = listed.withColumn("_key", F.url_decode(F.replace(F.replace(key, F.lit("%"), F.lit("%25")), F.lit("+"), F.lit("%2B"))))
    joined = named.join(whys, "_key", "left")
    return joined.select("path", "bytes", F.when(F.col("_judged"), F.col("why")).otherwise(EMPTY).alias("why"))


def read_checked(spark: SparkSession, folder: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of all readable CSV files of a folder, and an outcome per file: ``path, bytes, rows, bad_records, skipped, why``.

    Files are ``*.csv`` and ``*.csv.gz``, each with a header line; columns are named by position. A file that is empty, not
    text, or broken is skipped whole. A record with too few or too many fields counts as bad; it is kept, its missing fields null and its
    surplus dropped. ``rows`` counts the records of a file that were read, bad ones included, header excluded.
    """
    patterns = [f"{folder.rstrip('/')}/*.csv{ending}" for ending in ("", ".gz")]
    patterns = [p for p in patterns if path_exists(spark, p)]
    if not patterns:
        raise FileNotFoundError(f"no CSV files in {folder}")
    judged = materialize(judge_files(spark, patterns))
    good = [_local(r["path"]) for r in judged.where("why is null").select("path").collect()]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, "_bad")])
    if not good:
        counted = spark.createDataFrame([], "_key string, rows long, bad_records long")
        rows = spark.createDataFrame([], T.StructType(schema.fields[:-1]))
    else:
        reader = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("columnNameOfCorruptRecord", "_bad")
        read = reader.csv(good)
        rows = read_csv(spark, good, columns)
        places = read.select(*read.columns, F.col("_metadata.file_path").alias("_path"))
        # Every column is referred to, as the reader sees missing fields only in columns that it has to parse.
        wide = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in columns]))
        seen = places.select("_path", F.col("_bad").isNotNull().alias("_odd"), wide.alias("_wide"))
        counted = seen.groupBy("_path").agg(F.count_if(F.col("_wide") >= 0).alias("rows"), F.count_if("_odd").alias("bad_records"))
        key = F.url_decode(F.replace(F.regexp_replace("_path", r"^file:/+", "/"), F.lit("+"), F.lit("%2B")))
        counted = counted.select(key.alias("_key"), "rows", "bad_records")
    named = judged.withColumn("_key", F.regexp_replace("path", r"^file:/+", "/"))
    outcome = named.join(counted, "_key", "left").select(
        "path", "bytes", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), F.coalesce("bad_records", F.lit(0)).cast("bigint").alias("bad_records"),
        F.col("why").isNotNull().alias("skipped"), "why",
    )
    return rows, outcome
