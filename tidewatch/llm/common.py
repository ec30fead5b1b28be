"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidewatch.session import scratch_folder

# Bytes of text that one step inside a task works on; a longer text makes a step of its own.
CHUNK_BYTES = 4 * 1024 * 1024


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    folder = scratch_folder(spark)
    df.write.parquet(folder, compression=codec)
    return spark.read.schema(df.schema).parquet(folder)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column, without copying; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return ends - ends[0], raw[ends[0] : ends[-1]]


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a batch with at most ``limit`` bytes of text, or one row."""
    offsets, _ = utf8(batch.column(batch.schema.get_field_index(text)))
    at, rows = 0, batch.num_rows
    while at < rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), rows)
        yield batch.slice(at, to - at)
        at = to
