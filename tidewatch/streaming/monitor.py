"""The same operators inside Structured Streaming micro-batches.

Files arrive in a folder; the batches that a micro-batch touches are analysed as a whole and their reports replace
those of the same batch numbers, so a restarted query repeats work without doubling it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.features import LABEL, add_label
from tidewatch.operators.profile import batch_profile
from tidewatch.operators.registry import Registry
from tidewatch.plans import jobs
from tidewatch.roles import Limits, Roles
from tidewatch.session import materialize, stored
from tidewatch.sources import sinks
from tidewatch.sources.files import path_exists, text_schema
from tidewatch.streaming import landing


def stream_csv(spark: SparkSession, folder: str, columns: Sequence[str], files_per_trigger: int = 1) -> DataFrame:
    """Raw text rows of new CSV files."""
    reader = spark.readStream.schema(text_schema(columns)).option("header", True).option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(folder)


def stream_parquet(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Run ``work(df, batch_id)`` on every micro-batch; ``once`` stops when the present files are done."""
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def monitor(
    stream: DataFrame,
    store: jobs.Store,
    roles: Roles,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    limits: Limits = Limits(),
    once: bool = True,
) -> StreamingQuery:
    """Quality, rules and drift of every batch that a micro-batch touches. Rows without a batch number get the micro-batch's own.

    Rows are landed first, and a batch is judged by all that has landed of it, so its reports are those of the whole batch however it
    is split over micro-batches. When more of the reference batch comes, it is pinned anew and every landed batch is judged again.
    """

    def work(df: DataFrame, batch_id: int) -> None:
        rows = prepare(df)
        if roles.batch not in rows.columns:
            rows = rows.withColumn(roles.batch, F.lit(batch_id + 1).cast("bigint"))
        if rows.isEmpty():
            return
        spark = rows.sparkSession
        touched = landing.land(rows, store.landed, roles.batch, batch_id)
        if path_exists(spark, f"{store.reference}/_SUCCESS"):
            pinned = spark.read.schema(touched.schema).parquet(store.reference).agg(F.min(roles.batch)).first()[0]
            grown = materialize(touched.where(F.col(roles.batch) == pinned))
            if not grown.isEmpty():
                jobs.repin_reference(grown, store, roles, limits)
                touched = landing.read_landed(spark, store.landed, touched.schema, roles.batch)
        jobs.run_analysis(stored(touched), store, roles, limits)

    return each_batch(stream, work, checkpoint, once)


def profile_stream(stream: DataFrame, roles: Roles, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Row counts and data quality per batch number as a stateful aggregate.

    Counts merge, so a batch may arrive in any number of files and micro-batches. The state holds one
    row per batch; each trigger rewrites only the batches it touched.
    """

    def work(df: DataFrame, batch_id: int) -> None:
        changed = materialize(df)
        if not changed.isEmpty():
            sinks.write_reports(changed, path, roles)

    profiled = batch_profile(stream, roles)
    writer = profiled.writeStream.outputMode("update").foreachBatch(work).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def score_stream(stream: DataFrame, roles: Roles, registry: Registry, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Score a stream with the champion and append it as parquet; a narrow, stateless query."""
    scored = jobs.score_batches(stream, roles, registry)
    writer = scored.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def follow_stream(
    stream: DataFrame, store: jobs.Store, roles: Roles, checkpoint: str, update_every: int = 5, model_name: str | None = None, once: bool = True
) -> StreamingQuery:
    """Prequential monitoring: score each micro-batch, record its metrics, update the model every few."""

    def work(df: DataFrame, batch_id: int) -> None:
        if df.isEmpty():
            return
        registry = Registry(df.sparkSession, store.registry)
        jobs.follow(df, roles, registry, store)
        if (batch_id + 1) % update_every == 0 and add_label(df, roles).select(LABEL).distinct().count() > 1:
            name = model_name or registry.champion()["model_name"]
            jobs.update_model(df, roles, registry, name, batch_id=batch_id + 1)

    return each_batch(stream, work, checkpoint, once)
