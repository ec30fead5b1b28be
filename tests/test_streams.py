"""Streams and report stores that are stopped in the middle."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tidewatch.plans import jobs
from tidewatch.sources import commits, files, sinks
from tidewatch.sources.tables import FIXTURE
from tidewatch.streaming import landing


def test_stream_cuts_batches_as_the_reader_does_also_after_a_stop(spark, tmp_path, monkeypatch):
    folder = tmp_path / "files"
    folder.mkdir()
    for n, (name, rows) in enumerate((("b.csv", 25), ("a.csv", 10), ("c.csv", 31))):
        (folder / name).write_text("x,y\n" + "".join(f"{name}{i},{i}\n" for i in range(rows)))
        os.utime(folder / name, (time.time() - 1000 + 100 * n,) * 2)
    paths = [f"{folder}/{n}.csv" for n in "bac"]
    want = sorted((r.x, r.batch_num) for r in files.read_sources(spark, paths, 10).collect())

    def run():
        stream = landing.stream_positions(spark, str(folder), ["x", "y"])
        landing.collect_stream(stream, 10, f"{tmp_path}/raw", f"{tmp_path}/ledger", f"{tmp_path}/offsets").awaitTermination()

    # The first run stops in its second micro-batch: once before the rows are written, once after the ledger's entry.
    write, calls = sinks.write_batches, []

    def failing(*args, **options):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        write(*args, **options)

    monkeypatch.setattr(sinks, "write_batches", failing)
    with pytest.raises(Exception, match="stopped"):
        run()
    assert landing.read_ledger(spark, f"{tmp_path}/ledger").count() == 2
    run()
    got = sorted((r.x, r.batch_num) for r in spark.read.parquet(f"{tmp_path}/raw").collect())
    assert got == want
    ledger = landing.read_ledger(spark, f"{tmp_path}/ledger").orderBy("micro").collect()
    assert [(r.total_rows, r.total_batches, r.batches_before) for r in ledger] == [(25, 3, 0), (10, 1, 3), (31, 4, 4)]


def test_a_repeated_micro_batch_lands_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "batch_num long, v string")
    more = spark.createDataFrame([(1, "d")], "batch_num long, v string")
    path = f"{tmp_path}/landed"
    assert landing.land(rows, path, "batch_num", 0).count() == 3
    for _ in range(2):
        assert sorted(r.v for r in landing.land(more, path, "batch_num", 1).collect()) == ["a", "b", "d"]
    assert landing.read_landed(spark, path, rows.schema).count() == 4


def test_a_run_counts_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path)
    batches = spark.createDataFrame([(1,), (2,)], "batch_num long")
    table = lambda v: batches.withColumn("v", F.lit(v))
    assert commits.read_committed(spark, root, "a") is None
    commits.write_run({"a": table("old"), "b": table("old")}, batches, root, ["batch_num"])
    # A run that stops between two tables.
    broken = table("new").withColumn("v", F.raise_error(F.lit("stopped")).cast("string"))
    with pytest.raises(Exception, match="stopped"):
        commits.write_run({"a": table("new"), "b": broken}, batches, root, ["batch_num"])
    read = lambda name: sorted(tuple(r) for r in commits.read_committed(spark, root, name).select("batch_num", "v").collect())
    assert read("a") == read("b") == [(1, "old"), (2, "old")]
    second = batches.where("batch_num = 2")
    commits.write_run({"a": second.withColumn("v", F.lit("new")), "b": second.withColumn("v", F.lit("new")).limit(0)}, second, root, ["batch_num"])
    assert read("a") == [(1, "old"), (2, "new")] and read("b") == [(1, "old")]


def test_analysis_stopped_between_sinks_leaves_the_old_reports(spark, policies, tmp_path, monkeypatch):
    store = jobs.Store(str(tmp_path))
    some = policies.where("batch_num <= 2")
    jobs.run_analysis(some, store, FIXTURE)
    before = {n: jobs.read_reports(spark, store, n, FIXTURE).count() for n in ("dq", "consistency", "drift", "rules", "analyzed")}
    real = jobs.analyze

    def broken(*args):
        result = real(*args)
        result.cleaned = result.cleaned.withColumn("make", F.raise_error(F.lit("stopped")).cast("string"))
        return result

    monkeypatch.setattr(jobs, "analyze", broken)
    with pytest.raises(Exception, match="stopped"):
        jobs.run_analysis(policies.where("batch_num <= 3"), store, FIXTURE)
    assert before == {n: jobs.read_reports(spark, store, n, FIXTURE).count() for n in before}
    assert sorted(r.batch_num for r in spark.read.json(store.dq).collect()) == [1, 2]
