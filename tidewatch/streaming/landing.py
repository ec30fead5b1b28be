"""State that outlives a micro-batch: where row batches of a stream begin, and all rows that a batch has had so far."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewatch.session import materialize, sized
from tidewatch.sources import sinks
from tidewatch.sources.batching import batch_of, index_rows
from tidewatch.sources.files import path_exists, text_schema

LEDGER = "source string, total_rows long, total_batches long, batches_before long, micro long"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row per source that the stream has cut: its size and how many batches come before it."""
    if not path_exists(spark, f"{path}/micro=*/_SUCCESS"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def stream_positions(spark: SparkSession, folder: str, columns: Sequence[str], files_per_trigger: int = 1) -> DataFrame:
    """Text rows of new CSV files with the file, its age and the split that each row is from."""
    reader = spark.readStream.schema(text_schema(columns)).option("header", True).option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(folder).select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_modification_time").alias("_age"),
        F.col("_metadata.file_block_start").alias("_split"),
    )


def cut_micro_batch(df: DataFrame, batch_rows: int, ledger: str, micro: int) -> DataFrame:
    """Rows of one micro-batch with ``source, row_index, batch_index, batch_num``; the ledger then holds its files.

    A file is a source. Files of a micro-batch come in the order of their age, then name, after all files of earlier
    micro-batches; the counter goes on from one to the next. A micro-batch that is repeated after a stop finds the counter where it
    was, since only entries of earlier micro-batches count, and replaces its own entry.
    """
    spark = df.sparkSession
    before = read_ledger(spark, ledger).where(F.col("micro") < micro).agg(F.sum("total_batches")).first()[0] or 0
    rows = materialize(df.withColumns({"source": F.col("_file"), "_row": F.monotonically_increasing_id()}))
    sizes = rows.groupBy("source").agg(F.min("_age").alias("_age"), F.count(F.lit(1)).alias("total_rows"))
    earlier = Window.orderBy("_age", "source").rowsBetween(Window.unboundedPreceding, -1)
    entries = sizes.withColumn("total_batches", F.ceil(F.col("total_rows") / batch_rows).cast("bigint"))
    # One row per file of a micro-batch, which maxFilesPerTrigger bounds.
    entries = entries.withColumn("batches_before", F.lit(before).cast("bigint") + F.coalesce(F.sum("total_batches").over(earlier), F.lit(0)))
    entries = materialize(entries.select("source", "total_rows", "total_batches", "batches_before"))
    indexed = index_rows(rows.drop("_age"))
    cut = indexed.withColumn("batch_index", batch_of(F.col("row_index"), batch_rows)).join(sized(entries.select("source", "batches_before")), "source")
    out = materialize(cut.withColumn("batch_num", F.col("batches_before") + F.col("batch_index")).drop("batches_before"))
    entries.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/micro={micro}")
    return out


def collect_stream(stream: DataFrame, batch_rows: int, raw: str, ledger: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Cut the files of ``stream_positions`` into row batches and store them raw, by batch number.

    The numbers are those of ``read_sources`` over the same files in the order of their age. A repeated micro-batch writes the same batches again.
    """

    def work(df: DataFrame, micro: int) -> None:
        if not df.isEmpty():
            rows = cut_micro_batch(df, batch_rows, ledger, micro)
            sinks.write_batches(rows.drop("row_index", "batch_index"), raw, keys=["batch_num"])

    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def land(rows: DataFrame, path: str, batch: str, micro: int) -> DataFrame:
    """Keep a micro-batch's rows, and return all rows so far of the batches that it touches.

    A repeated micro-batch replaces what it landed before, so no split of a batch loses or doubles rows. The batch number is a column of
    the files, so a micro-batch over many batches has few files; each holds a range of numbers, and only ranges in question are read.
    """
    spark = rows.sparkSession
    rows = materialize(rows.withColumn("micro", F.lit(micro).cast("bigint")))
    gathered = sinks.gathered(rows, [batch]).sortWithinPartitions("micro", batch)
    gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("micro").parquet(path)
    touched = materialize(rows.select(batch).distinct())
    low, high = touched.agg(F.min(batch), F.max(batch)).first()
    landed = read_landed(spark, path, rows.drop("micro").schema, batch).where(F.col(batch).between(low, high))
    return landed.join(sized(touched), batch, "left_semi").select(*[c for c in rows.columns if c != "micro"])


def read_landed(spark: SparkSession, path: str, schema, batch: str = "batch_num") -> DataFrame:
    """All landed rows. Rows that were landed in folders by batch, as it once was, are read as well, unless their micro-batch was landed anew."""
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField("micro", T.LongType())])).option("basePath", path)
    parts = [reader.parquet(f"{path}/{folders}") for folders in ("micro=*", f"{batch}=*") if path_exists(spark, f"{path}/{folders}")]
    landed = parts[0] if len(parts) < 2 else parts[0].unionByName(parts[1].join(F.broadcast(parts[0].select("micro").distinct()), "micro", "left_anti"))
    return landed.select(*schema.names)
