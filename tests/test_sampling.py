"""Splits and samples: exact sizes, disjoint/complete, partition independence."""
import math

from pyspark.sql import functions as F

from tripflow.operators import sampling as smp
from tripflow.operators import trips as trp
from tripflow.sources.fixtures import trips_from_events, trips_from_lineitem

from conftest import SF001


def _keys(df):
    return {r[0] for r in df.select("trip_key").collect()}


def test_hash_split_disjoint_complete_and_partition_independent(spark):
    t = trp.clean_trips(trips_from_lineitem(spark, SF001))
    a = smp.hash_split(t, "trip_key")
    b = smp.hash_split(t.repartition(3), "trip_key")
    test_a, test_b = _keys(a.where("split = 'test'")), _keys(b.where("split = 'test'"))
    train_a = _keys(a.where("split = 'train'"))
    assert test_a == test_b
    assert not (test_a & train_a) and len(test_a) + len(train_a) == t.count()
    assert 0.17 < len(test_a) / t.count() < 0.23


def test_exact_split_size(spark):
    t = trp.clean_trips(trips_from_events(spark, SF001))
    n = t.count()
    s = smp.exact_split(t, "trip_key", 0.2)
    assert s.where("split = 'test'").count() == math.ceil(0.2 * n)
    assert s.count() == n


def test_exact_split_of_shared_keys(spark):
    """A key that a third of the rows share, also where those rows are equal, or the key is null."""
    for value in ("id", "id % 7", "1"):
        t = spark.range(1000).select(
            F.expr("CASE id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END").alias("k"), F.expr(value).alias("v"))
        want = sorted(map(str, t.collect()))
        for fraction in (0.2, 0.5, 0.9):
            s = smp.exact_split(t, "k", fraction)
            assert s.columns == ["k", "v", "split"]
            assert s.where("split = 'test'").count() == math.ceil(fraction * 1000)
            assert sorted(map(str, s.drop("split").collect())) == want
            again = smp.exact_split(t.repartition(3), "k", fraction)
            assert sorted(map(str, again.collect())) == sorted(map(str, s.collect()))
    assert smp.exact_split(t.where("v = 0"), "k").count() == 0
    assert smp.exact_split(t, "k", total=5000).where("split = 'test'").count() == 1000


def test_sample_rows_exact_and_brute_force(spark):
    t = trp.clean_trips(trips_from_events(spark, SF001))
    got = _keys(smp.sample_rows(t, 500, "trip_key"))
    rows = t.select("trip_key", F.md5(F.concat(F.lit("42|"), "trip_key")).alias("h")).collect()
    want = {k for _, k in sorted((r["h"], r["trip_key"]) for r in rows)[:500]}
    assert got == want
    assert _keys(smp.sample_rows(t.repartition(5), 500, "trip_key")) == want


def test_sample_more_than_rows_keeps_all(spark):
    t = trp.clean_trips(trips_from_events(spark, SF001))
    assert smp.sample_rows(t, 10 ** 9, "trip_key").count() == t.count()


def test_sample_of_shared_keys(spark):
    """Keys that a third of the rows share, also where those rows are equal, or the key is null."""
    for value in ("id", "id % 7", "1"):
        t = spark.range(1000).select(
            F.expr("CASE id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END").alias("k"), F.expr(value).alias("v"))
        for n in (0, 1, 321, 500, 999, 1000):
            got = smp.sample_rows(t, n, "k")
            assert got.count() == n
            assert sorted(map(str, got.collect())) == sorted(map(str, smp.sample_rows(t.repartition(3), n, "k").collect()))
    assert smp.sample_rows(t.limit(0), 5, "k").count() == 0


def test_hour_slice_caps_and_orders(spark):
    ev = trips_from_events(spark, SF001)
    s = smp.hour_slice(ev, "2024-01-15 10:30:00", batch_size=5)
    rows = s.collect()
    assert len(rows) == 5 and {r["date"] for r in rows} == {"2024-01-15"}
    ts = [r["tpep_pickup_datetime"] for r in rows]
    assert ts == sorted(ts) and all(t.hour == 10 for t in ts)
