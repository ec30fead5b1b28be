import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import coerce
from tidewatch.functions.order_stats import kth_smallest, quantiles
from tidewatch.functions.hashing import key_hash
from tidewatch.functions.running import running_totals
from tidewatch.functions.special import chi_square_p
from tidewatch.session import attach


@pytest.fixture(scope="module")
def hot(spark):
    """One group holds most rows; values repeat, are negative, tiny, huge or equal."""
    rng = random.Random(5)
    rows = [("hot", round(rng.gauss(0, 50), 2)) for _ in range(3000)] + [("flat", 7.0)] * 40
    rows += [("wide", x) for x in (-1e300, -2.5, 0.0, 1e-9, 1e-9, 3.0, 1e300)] + [("one", 4.25), ("none", None)]
    return rows, spark.createDataFrame(rows, "g string, v double").repartition(5)


@pytest.mark.parametrize("in_task", [0, 7, 10_000])
def test_quantiles_are_exact_for_any_group_size(hot, in_task):
    rows, df = hot
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    found = {r["g"]: r["q"] for r in quantiles(df, ["g"], ["v"], probs, in_task=in_task).collect()}
    for group in ("hot", "flat", "one"):
        values = [v for g, v in rows if g == group]
        assert found[group] == pytest.approx(list(np.quantile(values, probs)), rel=1e-12, abs=1e-9)
    assert found["wide"][3] == 1e-9
    assert "none" not in found


@pytest.mark.parametrize("in_task", [0, 10_000])
def test_quantiles_without_groups_and_over_several_columns(hot, in_task):
    rows, df = hot
    two = df.withColumn("w", -F.col("v"))
    found = {r["column"]: r["q"][0] for r in quantiles(two, [], ["v", "w"], [0.5], in_task=in_task).collect()}
    median = float(np.median([v for _, v in rows if v is not None]))
    assert found["v"] == pytest.approx(median) and found["w"] == pytest.approx(-median)


@pytest.mark.parametrize("in_task", [0, 10_000])
def test_kth_smallest(hot, in_task):
    rows, df = hot
    found = {r["g"]: r["kth"] for r in kth_smallest(df.where("g <> 'none'"), ["g"], "v", lambda n: F.floor(n * 0.3), in_task=in_task).collect()}
    values = sorted(v for g, v in rows if g == "hot")
    assert found["hot"] == values[899]
    assert "one" not in found


@pytest.mark.parametrize("slice_rows", [100, 10_000])
def test_running_totals(spark, slice_rows):
    rows = [(g, i, i % 7) for g in "ab" for i in range(500)]
    df = spark.createDataFrame(rows, "g string, i int, n int").repartition(6)
    found = {(r["g"], r["i"]): r["t"] for r in running_totals(df, ["i"], {"t": "n"}, by=["g"], slice_rows=slice_rows).collect()}
    for g in "ab":
        total = 0
        for i in range(500):
            assert found[(g, i)] == total
            total += i % 7


def poisson_sum(half, terms):
    """The tail for an even number of degrees of freedom."""
    return sum(math.exp(-half + k * math.log(half) - math.lgamma(k + 1)) for k in range(terms))


def test_chi_square_tail_matches_known_values(spark):
    known = [(3.841459, 1, 0.05), (6.634897, 1, 0.01), (9.210340, 2, 0.01), (18.307038, 10, 0.05), (0.5, 4, math.exp(-0.25) * 1.25)]
    known += [(0.0, 3, 1.0), (5000.0, 3, 0.0), (1000.0, 1000, poisson_sum(500, 500)), (200.0, 2, math.exp(-100)), (1100.0, 1000, poisson_sum(550, 500))]
    df = spark.createDataFrame([(float(x), d) for x, d, _ in known], "x double, d int")
    found = [r[0] for r in df.select(chi_square_p(F.col("x"), F.col("d"))).collect()]
    for got, (_, _, want) in zip(found, known):
        assert got == pytest.approx(want, abs=1e-6)


def test_dates_and_numbers(spark):
    raw = spark.createDataFrame(
        [(" 08-AUG-13 ", "12"), ("8-Aug-85", " -1.5e3 "), ("31-Feb-13", "12d"), ("2013-08-08", "NaN"), (None, ""), ("01-JAN-68", ".5")], "d string, ` n ` string"
    )
    typed = coerce.coerce(raw, dates=["d"], numbers=["n"])
    assert [None if r[0] is None else str(r[0]) for r in typed.collect()] == ["2013-08-08", "1985-08-08", None, "2013-08-08", None, "2068-01-01"]
    assert [r[1] for r in typed.collect()] == [12.0, -1500.0, None, None, None, 0.5]


def test_nan_becomes_null_and_items_split(spark):
    df = coerce.nan_to_null(spark.createDataFrame([(float("nan"),), (1.0,)], "x double"))
    assert sorted(df.collect(), key=str)[1][0] is None or df.where("x is null").count() == 1
    text = spark.createDataFrame([("a, b ,,c",), (None,), ("  ",)], "s string")
    assert [r[0] for r in text.select(coerce.split_items(F.col("s"))).collect()] == [["a", "b", "c"], [], []]


def test_day_difference_rounds_down(spark):
    df = spark.sql("select timestamp'2024-01-02 12:00:00' a, timestamp'2024-01-02 11:00:00' b, timestamp'2024-01-04 11:00:00' c")
    assert tuple(df.select(coerce.day_difference(F.col("a"), F.col("b")), coerce.day_difference(F.col("a"), F.col("c"))).first()) == (-1, 1)


def test_attach_keeps_rows_without_statistics(spark):
    rows = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    stats = spark.createDataFrame([(1, "x")], "k int, s string")
    assert sorted(tuple(r) for r in attach(rows, stats, ["k"]).collect()) == [(1, 5, "x"), (2, 6, None)]


def test_nan_is_missing_whatever_the_group_size(spark):
    rows = [(float("nan") if i % 10 == 0 else float(i),) for i in range(1000)] + [(None,)]
    df = spark.createDataFrame(rows, "v double")
    want = list(np.quantile([v for (v,) in rows if v is not None and v == v], [0.25, 0.5, 0.75, 0.95]))
    for in_task in (0, 50, 100_000):
        assert quantiles(df, [], ["v"], [0.25, 0.5, 0.75, 0.95], in_task=in_task).first()["q"] == pytest.approx(want)


def test_key_hash_tells_large_and_text_keys_apart(spark):
    keys = [(i << 31) for i in range(10)] + [(i << 32) + 5 for i in range(10)] + [2**52 - 1]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    found = [r[0] for r in df.select(key_hash(df, "k", 42)).collect()]
    assert len(set(found)) == len(set(keys)) and all(0 <= h < 2**52 for h in found)
    far = spark.createDataFrame([(-1,), (2**63 - 1,), (-(2**63),)], "k long")
    assert all(0 <= r[0] < 2**52 for r in far.select(key_hash(far, "k", 42)).collect())
    text = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert len({r[0] for r in text.select(key_hash(text, "k")).collect()}) == 3
