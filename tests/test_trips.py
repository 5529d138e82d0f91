"""Trip cleaning: every bound, inclusive/exclusive, nulls, NaN, empty input."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripflow.operators import trips as trp

BASE = dt.datetime(2024, 1, 15, 10, 0, 0)
SCHEMA = ("tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID int, "
          "DOLocationID int, trip_distance double, passenger_count int, total_amount double, trip_key string")


def row(key, minutes=10.0, pu=100, do=100, dist=2.0, pas=1, amt=20.0):
    return (BASE, BASE + dt.timedelta(minutes=minutes), pu, do, dist, pas, amt, key)


CASES = [
    ("ok", {}, True),
    ("dist0", {"dist": 0.0}, False), ("dist100", {"dist": 100.0}, False), ("dist99", {"dist": 99.99}, True),
    ("fare05", {"amt": 0.5}, False), ("fare1", {"amt": 1.0}, True), ("fare500", {"amt": 500.0}, True),
    ("fare501", {"amt": 500.01}, False),
    ("dur1", {"minutes": 1.0}, True), ("dur180", {"minutes": 180.0}, True),
    ("dur0.9", {"minutes": 0.9}, False), ("dur181", {"minutes": 180.5}, False),
    ("zone0", {"pu": 0}, False), ("zone1", {"pu": 1}, True), ("zone263", {"do": 263}, True),
    ("zone264", {"do": 264}, False),
    ("pnull", {"pas": None}, False), ("p0", {"pas": 0}, True), ("p9", {"pas": 9}, True), ("p10", {"pas": 10}, False),
    ("nan_dist", {"dist": float("nan")}, False), ("nan_amt", {"amt": float("nan")}, False),
]


def test_bounds(spark):
    df = spark.createDataFrame([row(k, **kw) for k, kw, _ in CASES], SCHEMA)
    kept = {r["trip_key"] for r in trp.clean_trips(df).collect()}
    assert kept == {k for k, _, keep in CASES if keep}


def test_features_and_names(spark):
    df = spark.createDataFrame([row("a", minutes=90)], SCHEMA)
    r = trp.clean_trips(df).collect()[0]
    assert r["pickup_hour"] == 10 and r["pickup_day_of_week"] == 0 and r["pickup_month"] == 1  # Monday
    assert r["duration_min"] == pytest.approx(90.0)
    assert trp.clean_trips(df).columns[:9] == trp.SILVER_TRIP_COLUMNS


def test_no_zone_filter_variant(spark):
    df = spark.createDataFrame([row("a", pu=0), row("b", do=300)], SCHEMA)
    assert trp.clean_trips(df).count() == 0
    assert trp.clean_trips(df, zone_filter=False).count() == 2


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert trp.clean_trips(df).count() == 0
    rep = trp.outlier_report(df).collect()[0]
    assert rep["rows_before"] == 0 and rep["pct_removed"] is None


def test_outlier_report_counts(spark):
    df = spark.createDataFrame([row(k, **kw) for k, kw, _ in CASES], SCHEMA)
    rep = trp.outlier_report(df).collect()[0]
    assert rep["rows_before"] == len(CASES)
    assert rep["rows_after"] == sum(keep for *_, keep in CASES)
    assert rep["passengers_violations"] == 2


def test_load_source(spark):
    raw = spark.createDataFrame([row("a")], SCHEMA)
    stream = raw.withColumn("date", F.lit("2024-01-15"))
    assert trp.load_source(raw, None, "combined").count() == 1
    u = trp.load_source(raw, stream, "combined")
    assert u.count() == 2 and "date" in u.columns
    with pytest.raises(ValueError):
        trp.load_source(raw, None, "streaming")
