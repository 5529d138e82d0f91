"""Versioned lake tables, catalogue, streaming ingest and stream/batch parity."""
import pytest
from pyspark.sql import functions as F

from tripflow.operators import features as feat
from tripflow.sources import catalog as cat
from tripflow.sources.fixtures import BRONZE_COLUMNS, trips_from_events
from tripflow.sources.lake import Lake, export_features, read_months
from tripflow.streaming import ingest as stm

from conftest import SF001


def test_versions_history_time_travel_compact(spark, scratch):
    lake = Lake(spark, scratch)
    t = lake.table("bronze", "raw")
    assert not t.exists()
    a = spark.range(0, 100).withColumn("p", F.col("id") % 3)
    assert t.write(a, "overwrite") == 0
    assert t.write(spark.range(100, 150).withColumn("p", F.col("id") % 3), "append") == 1
    assert t.read().count() == 150 and t.read(version=0).count() == 100
    assert t.write(spark.range(0, 10).withColumn("p", F.lit(1)), "overwrite") == 2
    assert t.read().count() == 10 and t.read(version=1).count() == 150
    h = [(r["version"], r["mode"], r["rows"]) for r in t.history().collect()]
    assert h == [(0, "overwrite", 100), (1, "append", 50), (2, "overwrite", 10)]
    with pytest.raises(FileExistsError):
        t.write(a, "error")
    t.write(spark.range(10, 20).withColumn("p", F.lit(2)), "append")
    rep = t.compact(target_file_bytes=1 << 30)
    assert rep["files_after"] <= rep["files_before"] and t.read().count() == 20


def test_partitioned_append_and_sql(spark, scratch):
    lake = Lake(spark, scratch)
    ev = trips_from_events(spark, SF001)
    lake.table("bronze", "streaming").write(ev, "append", partition_by=["date"])
    got = lake.sql("SELECT count(*) AS n FROM s WHERE date = '2024-01-15'",
                   {"s": ("bronze", "streaming")}).collect()[0]["n"]
    assert got == ev.where("date = '2024-01-15'").count()


def test_catalog_and_schema(spark):
    s = cat.schema_for("silver_demand")
    assert [f.name for f in s.fields] == ["zone_id", "pickup_hour", "day_of_week", "month", "trip_count"]
    edges = {(r["table"], r["upstream"]) for r in cat.lineage_df(spark).collect()}
    assert ("gold_zone_stats", "bronze_raw") in edges
    df = spark.createDataFrame([(1, 2, 3, 4, 5, "x")], "zone_id bigint, pickup_hour bigint, day_of_week bigint, "
                                                       "month bigint, trip_count bigint, extra string")
    out = cat.enforce_schema(df, s)
    assert out.columns == [f.name for f in s.fields] and dict(out.dtypes)["trip_count"] == "int"
    assert cat.sla_seconds("10m") == 600


def test_read_months_and_export(spark, scratch):
    for m in ("2024-01", "2024-02"):
        spark.range(5).write.parquet(f"{scratch}/yellow_tripdata_{m}.parquet")
    assert read_months(spark, scratch, "2024-01, 2024-02").count() == 10
    zs = spark.range(3).withColumnRenamed("id", "zone_id")
    export_features(zs, f"{scratch}/features")
    assert len([f for f in spark.read.parquet(f"{scratch}/features").inputFiles()]) == 1


def _write_feed(df, path, weeks=("2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-02-12")):
    """One feed folder per week, in time order."""
    for lo, hi in zip(weeks, weeks[1:], strict=False):
        df.where(f"tpep_pickup_datetime >= '{lo}' AND tpep_pickup_datetime < '{hi}'").write.parquet(f"{path}/week={lo}")


def test_ingest_stream_gate_and_idempotence(spark, scratch):
    ev = trips_from_events(spark, SF001).select(*BRONZE_COLUMNS)
    _write_feed(ev, f"{scratch}/feed")
    stm.ingest_stream(spark, f"{scratch}/feed", ev.schema, f"{scratch}/table", f"{scratch}/ckpt")
    out = spark.read.parquet(f"{scratch}/table")
    assert out.count() == ev.count()
    # restart from the same checkpoint: nothing new, nothing duplicated
    stm.ingest_stream(spark, f"{scratch}/feed", ev.schema, f"{scratch}/table", f"{scratch}/ckpt")
    assert spark.read.parquet(f"{scratch}/table").count() == ev.count()
    # replay from a date into a fresh checkpoint
    stm.ingest_stream(spark, f"{scratch}/feed", ev.schema, f"{scratch}/table2", f"{scratch}/ckpt2",
                      from_date="2024-01-20")
    assert spark.read.parquet(f"{scratch}/table2").count() == \
        ev.where("tpep_pickup_datetime >= '2024-01-20'").count()


def test_demand_stream_equals_batch(spark, scratch):
    ev = trips_from_events(spark, SF001).select(*BRONZE_COLUMNS)
    _write_feed(ev, f"{scratch}/feed")
    late = ev.where("tpep_pickup_datetime < '2024-01-03'")      # older than all that came before
    run = lambda: stm.demand_stream(spark, stm.feed_stream(spark, f"{scratch}/feed", ev.schema),
                                    f"{scratch}/out", f"{scratch}/ckpt")
    run()
    late.write.parquet(f"{scratch}/feed/again")
    out = run()                                                 # resumes with the second feed only
    batch = (ev.union(late).where(F.col("PULocationID").between(1, 263))
             .groupBy(F.col("PULocationID").alias("zone_id"),
                      F.date_trunc("hour", "tpep_pickup_datetime").alias("window_start"))
             .agg(F.count(F.lit(1)).alias("trip_count")))
    cols = ["zone_id", "window_start", "trip_count"]
    assert out.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert batch.select(cols).exceptAll(out.select(cols)).count() == 0
    # a restart with no new files changes nothing
    assert run().select(cols).exceptAll(batch.select(cols)).count() == 0


def test_score_stream_with_stream_static_enrichment(spark, scratch):
    from tripflow.operators import models as mdl
    from tripflow.operators import sampling as smp
    from tripflow.operators import trips as trp
    from tripflow.sources.fixtures import trips_from_lineitem
    from conftest import SF0001
    raw = trips_from_lineitem(spark, SF0001)
    zones = feat.zone_stats(raw)
    train = feat.enrich_trips(smp.hash_split(trp.clean_trips(raw), "trip_key"), zones)
    model = mdl.train(train, mdl.TRIP_FEATURES, "total_amount", max_iter=3)
    ev = trips_from_events(spark, SF001)
    _write_feed(ev, f"{scratch}/feed")
    stream = feat.enrich_trips(trp.clean_trips(stm.feed_stream(spark, f"{scratch}/feed", ev.schema)), zones)
    calls = []

    def resolve():
        calls.append(1)
        return model
    stm.score_stream(stream, resolve, f"{scratch}/scored", f"{scratch}/ckpt", "predicted_fare")
    out = spark.read.parquet(f"{scratch}/scored")
    assert out.count() == trp.clean_trips(ev).count() and len(calls) >= 1
    assert "predicted_fare" in out.columns
