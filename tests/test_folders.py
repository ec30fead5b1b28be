"""Files and started processes that must not grow with the batches."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewatch.queries import modeling
from tidewatch.sources import sinks
from tidewatch.sources.tables import FIXTURE
from tidewatch.streaming import landing, monitor


def names(path, pattern="part-*") -> list[str]:
    return [p.name for p in Path(path).rglob(pattern)]


@pytest.fixture(scope="module")
def scattered(spark):
    """Forty batches and rows without a batch, each with rows in all of eight partitions."""
    number = F.when(F.col("id") % 50 < 40, F.col("id") % 50)
    moment = F.timestamp_micros(F.col("id") * 1_000_007)
    rows = spark.range(2000).select(number.alias("batch_num"), "id", (F.col("id") / 7).alias("x"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("é\"\n"), "id")).alias("t"), moment.alias("at"), F.to_date(moment).alias("day"))
    return rows.repartition(8, "id")


def test_a_micro_batch_has_no_folder_per_batch_and_old_folders_are_read(spark, scattered, tmp_path):
    path, rows = f"{tmp_path}/landed", scattered.where("batch_num is not null").select("batch_num", "id")
    for micro, part in ((0, "id < 800"), (1, "id >= 800 and id < 1600")):
        rows.where(part).withColumn("micro", F.lit(micro)).write.mode("append").partitionBy("batch_num", "micro").parquet(path)
    for _ in range(2):
        assert landing.land(rows.where("id >= 1600"), path, "batch_num", 2).count() == rows.count()
    assert len(names(f"{path}/micro=2")) <= 2
    assert landing.land(rows.where("id >= 800 and id < 1600 and batch_num = 7"), path, "batch_num", 1).where("batch_num <> 7 or id is null").isEmpty()
    back = landing.read_landed(spark, path, rows.schema)
    assert back.exceptAll(rows.where("id < 800 or id >= 1600 or batch_num = 7")).isEmpty() and back.count() < rows.count()


def test_the_split_stream_has_files_by_size_and_two_micro_batches(spark, monkeypatch):
    counts = []
    monkeypatch.setattr(modeling, "FILE_ROWS", 400)
    monkeypatch.setattr(modeling.monitor, "monitor", lambda stream, store, roles, offsets: monitor.each_batch(stream, lambda df, _: counts.append((df.count(), df.select("batch_num").distinct().count())), offsets))
    store = modeling._split_store(spark, "/root/testdata/sf0.001")
    assert len(names(f"{store.root.removeprefix('file:')}/files")) == 8
    assert len(counts) == 2 and sum(n for n, _ in counts) == 1500 and all(batches == 2 for _, batches in counts)


@pytest.mark.parametrize("rows_in_task", [100, 250_000])
def test_folders_by_batch_are_written_without_hadoop(spark, scattered, tmp_path, monkeypatch, rows_in_task):
    monkeypatch.setattr(sinks, "ROWS_IN_TASK", rows_in_task)
    dynamic = lambda df: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_num")
    nested = scattered.select("batch_num", F.struct("x", "t", "at").alias("s"), F.create_map("id", "x").alias("m"), "day", "t")
    for some in (scattered.where("true"), scattered.where("batch_num is null or batch_num = 3 or id > 1900")):
        packed = nested.join(some.select("t", "day").distinct(), ["t", "day"], "left_semi")
        sinks.write_reports(packed, f"{tmp_path}/new", FIXTURE)
        dynamic(packed).json(f"{tmp_path}/old")
        sinks.write_analyzed(some, f"{tmp_path}/new_rows", FIXTURE)
        dynamic(some).parquet(f"{tmp_path}/old_rows")
    for new in ("new", "new_rows"):
        assert not names(tmp_path / new, "*.crc") and not names(tmp_path / new, ".staging*")
        assert sorted(os.listdir(tmp_path / new)) == sorted(n for n in os.listdir(tmp_path / new.replace("new", "old")) if not n.endswith(".crc"))
    lines = lambda path: spark.read.text(path).withColumn("batch_num", F.col("batch_num").cast("bigint"))
    for got, want in ((lines(f"{tmp_path}/new"), lines(f"{tmp_path}/old")), (spark.read.parquet(f"{tmp_path}/new_rows"), spark.read.parquet(f"{tmp_path}/old_rows"))):
        assert sorted(got.dtypes) == sorted(want.dtypes) and got.count() == want.count() > 0
        assert got.exceptAll(want.select(*got.columns)).isEmpty()
    assert len(names(f"{tmp_path}/new_rows")) <= 41 + -(-2000 // rows_in_task)


def test_a_failed_write_leaves_the_folders_as_they_were(spark, scattered, tmp_path):
    sinks.write_reports(scattered, f"{tmp_path}/reports", FIXTURE)
    before = sorted(names(tmp_path))
    broken = scattered.withColumn("x", F.when(F.col("id") == 1500, F.raise_error(F.lit("stopped")).cast("double")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="stopped"):
        sinks.write_reports(broken, f"{tmp_path}/reports", FIXTURE)
    assert sorted(names(tmp_path)) == before and not names(tmp_path, ".staging*")
    sinks.write_reports(scattered.limit(0), f"{tmp_path}/reports", FIXTURE)
    assert sorted(names(tmp_path)) == before
