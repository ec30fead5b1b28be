import pytest
from pyspark.sql import functions as F

from tidewatch.operators import drift
from tidewatch.roles import Roles
from tidewatch.sources.tables import FIXTURE

ROLES = Roles(target="y", monitored_numeric=("x",), monitored_categorical=("c",))


def frame(spark):
    rows = [(1, float(i), "ab"[i % 2], 0.0) for i in range(40)]
    rows += [(2, float(i), "ab"[i % 2], 0.0) for i in range(40)]
    rows += [(3, float(i + 100), "ab"[i % 2], 0.0) for i in range(40)]
    rows += [(4, float(i), "abz"[i % 3], float(i % 2)) for i in range(40)]
    rows += [(5, None if i < 30 else float(i), "ab"[i % 2], 0.0) for i in range(40)]
    return spark.createDataFrame(rows, "batch_num long, x double, c string, y double")


def test_verdicts(spark):
    found = {r["batch_num"]: r for r in drift.detect(frame(spark), ROLES).collect()}
    assert not found[1]["drift_detected"] and found[1]["outlier_drift"] == 0 and found[1]["missing_value_drift"] == 0
    assert not found[2]["drift_detected"] and found[2]["drift_type"] is None and found[2]["affected_features"] == []
    assert found[3]["drift_type"] == "covariate"
    assert [f["feature"] for f in found[3]["affected_features"]] == ["x"] and found[3]["affected_features"][0]["confidence"] == 1.0
    assert found[4]["drift_type"] == "concept" and found[4]["concept_shift_confidence"] == pytest.approx(0.999)
    assert [f["feature"] for f in found[4]["affected_features"]] == ["c"] and found[4]["affected_features"][0]["p_value"] == 0.0
    assert found[5]["quality_issues"] and [a["type"] for a in found[5]["anomalies"]][0] == "missing_value_drift"


def test_scores_against_itself_are_zero(policies):
    same = policies.where("batch_num = 1")
    row = drift.detect_between(same, same, FIXTURE).first()
    assert not row["drift_detected"] and not row["quality_issues"] and row["missing_value_drift"] == 0 and row["outlier_drift"] == 0
    scores = drift.feature_scores(same, FIXTURE)
    assert scores.agg(F.max(F.abs("score"))).first()[0] == pytest.approx(0.0, abs=1e-9)


def test_missing_reference_categories_add_their_share(spark):
    rows = [(1, None, v, 0.0) for v in "aabc"] + [(2, None, v, 0.0) for v in "aaab"]
    df = spark.createDataFrame(rows, "batch_num long, x double, c string, y double")
    shares = drift.categorical_shares(df, ROLES)
    found = drift.share_chi_square(shares, shares.where("batch_num = 1").drop("batch_num"), ROLES).where("batch_num = 2").first()
    assert found["statistic"] == pytest.approx(0.25**2 / 0.5 + 0 + 0.25) and found["df"] == 2
    counts = drift.share_chi_square(shares, shares.where("batch_num = 1").drop("batch_num"), ROLES, on="counts").where("batch_num = 2").first()
    assert counts["statistic"] == pytest.approx(4 * found["statistic"])


def test_history_summaries(spark):
    reports = drift.detect(frame(spark), ROLES)
    summary = drift.drift_summary(reports, ROLES).first()
    assert (summary["total_batches_analyzed"], summary["batches_with_drift"], summary["last_drift_batch"]) == (5, 3, 5)
    trend = drift.drift_trend(reports, ROLES).first()
    assert trend["drift_trend"] == "increasing" and trend["drift_types_observed"] == ["concept", "covariate"]
    empty = drift.drift_summary(reports.where("false"), ROLES).first()
    assert empty["status"] == "no_drift_history" and empty["drift_rate"] == 0


def test_ks_and_effect_size(spark):
    found = {r["batch_num"]: r["ks"] for r in drift.ks_statistic(frame(spark), ROLES, 1).collect()}
    assert found[1] == 0 and found[2] == 0 and found[3] == 1.0 and found[5] == pytest.approx(0.75)
    effect = {r["batch_num"]: r for r in drift.effect_size(frame(spark), ROLES, 1).collect()}
    assert effect[2]["cohen_d"] == 0 and effect[3]["meaningful"]


def test_all_missing_column_is_left_out(spark):
    df = spark.createDataFrame([(1, None, "a", 0.0), (2, 1.0, "a", 0.0)], "batch_num long, x double, c string, y double")
    assert drift.numeric_reference(df.where("batch_num = 1"), ROLES).count() == 0
    assert drift.detect(df, ROLES).where("batch_num = 2").first()["drift_detected"] is False
