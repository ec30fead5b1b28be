import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import clean, profile, quality
from tidewatch.roles import Allowed, Cleaning, QualityLimits, Range, Roles

ROLES = Roles(
    begin="b", end="e", time="b", allowed=(Allowed("sex", (0, 1, 2)),), ranges=(Range("seats", 1, 80, "seats_out_of_range"),),
    non_negative=("paid",), zero_default=("seats",),
)
SCHEMA = "batch_num long, b date, e date, sex double, seats double, paid double, make string"


def frame(spark, rows):
    day = pd.Timestamp
    made = [(n, b and day(b).date(), e and day(e).date(), *rest) for n, b, e, *rest in rows]
    return spark.createDataFrame(made, SCHEMA)


@pytest.fixture(scope="module")
def rows(spark):
    return frame(
        spark,
        [
            (1, "2013-01-01", "2014-01-01", 0.0, 4.0, 10.0, "A"),
            (1, "2013-01-01", "2014-01-01", 0.0, 4.0, 10.0, "A"),
            (1, "2014-01-01", "2013-01-01", 7.0, 0.0, -5.0, None),
            (1, None, "2013-01-01", 1.0, None, None, "B"),
            (2, "2013-01-01", None, 2.0, 500.0, 30.0, None),
            (2, "2013-01-01", "2013-01-02", 2.0, 10.0, -1.0, "B"),
            (2, "2013-01-01", "2013-01-03", 2.0, 10.0, 50.0, "B"),
        ],
    )


def test_metrics_by_hand(rows):
    found = {r["batch_num"]: r for r in quality.dq_metrics(rows, ROLES).collect()}
    one = found[1]
    assert (one["n_rows"], one["n_cols"]) == (4, 6)
    assert one["missing_total_ratio"] == pytest.approx(4 / 24)
    assert one["duplicate_ratio"] == 0.25 and one["bad_time_ratio"] == 0.25 and one["bad_date_ratio"] == 0.25
    assert one["invalid_breakdown"] == {"sex_unknown": 0.25, "seats_out_of_range": 0.25, "paid_negative": 0.25}
    assert one["missing_per_column"]["paid"] == 0.25
    assert found[2]["invalid_ratio"] == pytest.approx(1 / 3)


def test_flags_are_strict(rows):
    metrics = quality.dq_metrics(rows, ROLES)
    limits = QualityLimits(max_missing_total=0.0, max_duplicate_ratio=0.25, max_bad_date_ratio=1, max_invalid_ratio=1)
    flags = {r["batch_num"]: r for r in quality.quality_flags(metrics, limits).collect()}
    assert flags[1]["too_many_missing"] and not flags[1]["too_many_duplicates"] and flags[1]["any_issue"]


def test_empty_table(spark):
    whole = Roles(batch=None, begin="b", end="e", time="b", allowed=ROLES.allowed)
    empty = frame(spark, []).drop("batch_num")
    row = quality.dq_metrics(empty, whole).first()
    assert (row["n_rows"], row["missing_total_ratio"], row["bad_time_ratio"], row["duplicate_ratio"], row["invalid_ratio"]) == (0, 1.0, 1.0, 0.0, 0.0)


def test_absent_columns_are_skipped(rows):
    row = quality.dq_metrics(rows.select("batch_num", "make"), ROLES).first()
    assert row["bad_time_ratio"] == 1.0 and row["bad_date_ratio"] == 0.0 and row["invalid_breakdown"] == {}


def test_clean_by_hand(rows):
    cleaned = sorted(clean.clean(rows, ROLES).collect(), key=lambda r: (r["batch_num"], str(r["e"])))
    assert [(r["batch_num"], r["seats"], r["paid"], r["make"]) for r in cleaned] == [
        (1, 4.0, 10.0, "A"), (2, 10.0, 40.0, "B"), (2, 10.0, 50.0, "B"), (2, 0.0, 30.0, "Unknown"),
    ]


def test_clean_switches(rows):
    off = Cleaning(False, False, False, False, False, "none", "none")
    assert clean.clean(rows, ROLES, off).count() == 7
    kept = quality.dq_report(rows, ROLES, cleaning=off).where("batch_num = 1").first()
    assert kept["before"]["n_rows"] == kept["after"]["n_rows"] == 4 and kept["after"]["duplicate_ratio"] == 0.25


def test_cleaning_leaves_no_gap_in_columns_with_values(policies):
    from tidewatch.sources.tables import FIXTURE

    cleaned = clean.clean(policies, FIXTURE)
    left = cleaned.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cleaned.columns if c != "insr_end"]).first()
    assert set(left) == {0}


def test_profiles(rows):
    batch = {r["batch_num"]: r for r in profile.batch_profile(rows, ROLES).collect()}
    assert batch[1]["data_quality"] == pytest.approx(20 / 24)
    columns = {(r["batch_num"], r["column_name"]): r for r in profile.column_profile(rows, ROLES).collect()}
    paid = columns[(1, "paid")]
    assert (paid["null_count"], paid["unique_count"], paid["min_value"], paid["max_value"], paid["mean_value"]) == (1, 2, -5.0, 10.0, 5.0)
    assert columns[(1, "make")]["data_type"] == "categorical" and columns[(1, "make")]["unique_count"] == 2
    sketched = {(r["batch_num"], r["column_name"]): r for r in profile.column_profile(rows, ROLES, approximate=True).collect()}
    assert all(sketched[k]["null_count"] == columns[k]["null_count"] and sketched[k]["unique_count"] == columns[k]["unique_count"] for k in columns)
    top = [r["column_name"] for r in profile.top_missing(profile.column_profile(rows, ROLES), ROLES, 2).where("batch_num = 1").orderBy("rank").collect()]
    assert top == ["b", "seats"]


def test_metrics_need_one_row_shuffle(rows):
    plan = quality.dq_metrics(rows, ROLES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
