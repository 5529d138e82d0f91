"""Rule validation, duplicates, column statistics, freshness."""
import math

import pytest

from tripflow.operators import quality as qa


def test_rules_nulls_ranges_unique(spark):
    df = spark.createDataFrame(
        [(1, 10.0, None), (1, -1.0, None), (264, float("nan"), None), (None, 5.0, None)],
        "zone_id int, zone_avg_fare double, event_timestamp timestamp_ntz")
    res = {(r["check"], r["column"]): r for r in qa.validate(df, "gold_zone_stats").collect()}
    assert res[("row_count", None)]["observed"] == 4 and res[("row_count", None)]["passed"]
    # zone_id: 1 null + 1 out of range + 2 duplicated rows
    assert res[("column", "zone_id")]["observed"] == 4
    # NaN is neither in nor out of range for min-only rules; -1 violates
    assert res[("column", "zone_avg_fare")]["observed"] == 1
    assert res[("column", "event_timestamp")]["observed"] == 4
    summ = qa.quality_summary(qa.validate(df, "gold_zone_stats")).collect()[0]
    assert not summ["success"] and summ["rows"] == 4


def test_missing_column_skip_or_fail(spark):
    df = spark.createDataFrame([(1,)], "zone_id int")
    skip = qa.validate(df, "silver_demand").collect()
    assert {r["column"] for r in skip} == {None, "zone_id"}
    fail = qa.validate(df, "silver_demand", missing="fail").collect()
    assert sum(not r["passed"] for r in fail) >= 3


def test_validate_or_fail_raises(spark):
    df = spark.createDataFrame([(0,)], "zone_id int")
    with pytest.raises(qa.QualityError):
        qa.validate_or_fail(df, "silver_demand")


def test_composite_duplicates_keep_false(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, None), (None, None)], "k int, v string")
    r = qa.duplicate_rows(df, ["k", "v"]).collect()[0]
    assert r["duplicate_rows"] == 4 and r["duplicate_groups"] == 2


def test_column_stats_skip_nan(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),)], "x double")
    r = qa.column_stats(df, "t").collect()[0]
    assert r["mean"] == 2.0 and math.isclose(r["std"], 1.4142, abs_tol=1e-4)


def test_freshness_levels(spark):
    df = spark.createDataFrame([("2024-01-31 23:58:00",), ("2024-01-31 23:50:00",)], "ts string") \
        .selectExpr("to_timestamp_ntz(ts) AS ts")
    out = qa.freshness({"bronze_streaming": (df, "ts")}, as_of="2024-02-01 00:00:00").collect()[0]
    assert out["age_seconds"] == 120 and out["within_sla"] and out["level"] == "green"
    out = qa.freshness({"bronze_streaming": (df.where("ts < '2024-01-31 23:55:00'"), "ts")},
                       as_of="2024-02-01 00:00:00").collect()[0]
    assert out["age_seconds"] == 600 and out["within_sla"] and out["level"] == "red"


def test_all_null_column_and_nan_in_not_null_rule(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, 1.0)],
                               "tpep_pickup_datetime timestamp_ntz, trip_distance double")
    res = {r["column"]: r for r in qa.validate(df, "bronze_raw").collect() if r["check"] == "column"}
    assert res["tpep_pickup_datetime"]["observed"] == 2 and not res["tpep_pickup_datetime"]["passed"]
    assert res["trip_distance"]["observed"] == 1          # NaN counts as missing
    assert "PULocationID" not in res                      # absent column skipped


def test_empty_frame_fails_min_rows(spark):
    df = spark.createDataFrame([], "zone_id int, pickup_hour int, day_of_week int, trip_count bigint")
    summ = qa.quality_summary(qa.validate(df, "silver_demand")).collect()[0]
    assert summ["rows"] == 0 and not summ["success"] and summ["failed"] == 1
