"""Feature store, champions, metrics and model training."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripflow.operators import features as feat
from tripflow.operators import models as mdl
from tripflow.operators import sampling as smp
from tripflow.operators import store as fs
from tripflow.operators import trips as trp
from tripflow.sources.fixtures import trips_from_lineitem

from conftest import SF0001


def test_materialize_and_online_ttl(spark):
    d = dt.datetime
    src = spark.createDataFrame(
        [(1, d(2024, 1, 1), 1.0, 1.0, 1.0, 1), (1, d(2024, 1, 5), 2.0, 2.0, 2.0, 2),
         (2, d(2023, 1, 1), 3.0, 3.0, 3.0, 3), (3, d(2024, 2, 1), 4.0, 4.0, 4.0, 4)],
        "zone_id int, event_timestamp timestamp_ntz, zone_avg_fare double, zone_avg_duration_min double, "
        "zone_avg_distance double, zone_trip_count bigint")
    online = fs.materialize_incremental(src, fs.ZONE_VIEW, end="2024-01-31 00:00:00")
    got = {r["zone_id"]: r["zone_avg_fare"] for r in online.collect()}
    assert got == {1: 2.0, 2: 3.0}
    ent = spark.createDataFrame([(10, 1), (11, 2), (12, 9)], "req int, zone_id int")
    out = {r["req"]: r for r in fs.get_online_features(ent, online, fs.ZONE_VIEW, "2024-02-01 00:00:00").collect()}
    assert out[10]["found"] and out[10]["zone_avg_fare"] == 2.0
    assert not out[11]["found"] and out[11]["zone_avg_fare"] == 0.0     # expired (TTL 90 days)
    assert not out[12]["found"] and out[12]["zone_trip_count"] == 0
    ordered = fs.get_online_features(ent, online, fs.ZONE_VIEW, "2024-02-01 00:00:00", order_col="req")
    assert [r["req"] for r in ordered.collect()] == [10, 11, 12]


def test_champions_never_worse(spark):
    v = spark.createDataFrame([("m", 1, 5.0), ("m", 2, 6.0), ("m", 3, 4.0), ("m", 4, 4.0), ("n", 1, 1.0)],
                              "model string, version int, mae double")
    out = {(r["model"], r["version"]): r for r in mdl.champions(v).collect()}
    assert [out[("m", i)]["promoted"] for i in range(1, 5)] == [True, False, True, False]
    assert [out[("m", i)]["champion_version"] for i in range(1, 5)] == [1, 1, 3, 3]
    assert mdl.resolve_champion(v, "m") == 3


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "y double, p double")
    r = mdl.regression_metrics(df, "y", "p").collect()[0]
    assert r["mae"] == round(2 / 3, 6) and r["r2"] == 0.0


def test_gbt_beats_mean_predictor(spark):
    """The fare model (target total_amount). In the line-item fixture the
    trip duration depends on quantity only, which is not a feature, so the
    duration model has no signal to beat the mean with; the fare does."""
    raw = trips_from_lineitem(spark, SF0001)
    data = feat.enrich_trips(smp.hash_split(trp.clean_trips(raw), "trip_key"), feat.zone_stats(raw))
    train, test = data.where("split = 'train'"), data.where("split = 'test'")
    model = mdl.train(train, mdl.TRIP_FEATURES, "total_amount", max_iter=10)
    pred = mdl.score(model, test)
    m = mdl.regression_metrics(pred, "total_amount").collect()[0]
    mean = train.agg(F.avg("total_amount")).collect()[0][0]
    base = mdl.regression_metrics(test.withColumn("prediction", F.lit(mean)), "total_amount").collect()[0]
    assert m["mae"] < base["mae"] and m["r2"] > 0.5


def test_champion_mae_never_increases(spark):
    import random
    rnd = random.Random(5)
    rows = [("m", v, round(rnd.uniform(1, 10), 3)) for v in range(1, 60)]
    v = spark.createDataFrame(rows, "model string, version int, mae double")
    out = sorted(mdl.champions(v).collect(), key=lambda r: r["version"])
    mae = {r[1]: r[2] for r in rows}
    champ = [mae[r["champion_version"]] for r in out]
    assert all(a >= b for a, b in zip(champ, champ[1:]))
    assert champ[-1] == min(mae.values())


def test_fits_read_stored_tables(spark, scratch, monkeypatch):
    """A fit reads its rows several times: from stored trips and zones, not by
    deriving and cleaning the trips anew. The rows are the same."""
    from tripflow.plans import registry as R
    spark.range(600).selectExpr(
        "id AS l_orderkey", "id * 7 % 200 AS l_partkey", "id % 10 AS l_suppkey", "cast(id % 7 AS int) AS l_linenumber",
        "cast(id % 50 + 1 AS double) AS l_quantity", "900.0D + id * 150 AS l_extendedprice", "id % 9 / 100.0D AS l_tax",
        "cast('1995-01-01' AS timestamp_ntz) + make_dt_interval(cast(id % 90 AS int)) AS l_shipdate",
    ).write.parquet(f"{scratch}/lineitem.parquet")
    read = []

    def train(df, features, label):
        read.append(df)
        raise InterruptedError
    monkeypatch.setattr(R.mdl, "train", train)
    for query in (R.score_trips, R.score_fares, R.score_demand):
        with pytest.raises(InterruptedError):
            query(spark, scratch)
    trips = feat.enrich_trips(R.silver(spark, scratch), feat.zone_stats(R.raw(spark, scratch)))
    demand = feat.enrich_demand(R.silver_demand(spark, scratch), feat.zone_stats(R.raw(spark, scratch)))
    for got, want in zip(read, (trips, trips, demand), strict=True):
        assert got.inputFiles() and all("/table-" in f for f in got.inputFiles())
        want = want.where("split = 'train'").select(*got.columns)
        assert got.count() == want.count() > 0
        assert got.exceptAll(want).isEmpty()
