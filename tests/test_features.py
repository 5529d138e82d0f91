"""Zone statistics, demand and enrichment invariants on the driver data."""
from pyspark.sql import functions as F

from tripflow.operators import features as feat
from tripflow.operators import trips as trp
from tripflow.sources.fixtures import trips_from_events, trips_from_lineitem

from conftest import SF0001, SF001


def test_zone_stats_bounded_and_unique(spark):
    zs = feat.zone_stats(trips_from_lineitem(spark, SF001))
    assert zs.count() <= feat.MAX_ZONES
    assert zs.select("zone_id").distinct().count() == zs.count()
    assert zs.where((F.col("zone_id") < 1) | (F.col("zone_id") > 263)).count() == 0


def test_global_ts_is_max_of_zone_ts(spark):
    raw = trips_from_lineitem(spark, SF001)
    z = feat.zone_stats(raw).agg(F.max("event_timestamp")).collect()[0][0]
    g = feat.zone_stats(raw, ts_mode="global").select("event_timestamp").distinct().collect()
    assert len(g) == 1 and g[0][0] == z


def test_demand_total_equals_filtered_rows(spark):
    raw = trips_from_lineitem(spark, SF001)
    total = feat.demand(raw).agg(F.sum("trip_count")).collect()[0][0]
    assert total == raw.where(F.col("PULocationID").between(1, 263)).count()


def test_merge_keep_date_equals_union_aggregate(spark):
    raw, ev = trips_from_lineitem(spark, SF001), trips_from_events(spark, SF001)
    merged = feat.merge_demand([feat.demand(raw, keep_date=True), feat.demand(ev, keep_date=True)],
                               keep_date=True)
    union = raw.unionByName(ev, allowMissingColumns=True)
    direct = feat.demand(union, keep_date=True)
    cols = ["zone_id", "pickup_date", "pickup_hour", "day_of_week", "month", "trip_count"]
    assert merged.select(cols).exceptAll(direct.select(cols)).count() == 0
    assert direct.select(cols).exceptAll(merged.select(cols)).count() == 0


def test_enrich_missing_zone_is_zero(spark):
    trips = spark.createDataFrame([(1, 2, 5.0), (7, 1, 3.0)], "pickup_zone_id int, dropoff_zone_id int, x double")
    zones = spark.createDataFrame([(1, 10.0, 20.0, 3.0, 5, None)],
                                  "zone_id int, zone_avg_fare double, zone_avg_duration_min double, "
                                  "zone_avg_distance double, zone_trip_count bigint, event_timestamp timestamp_ntz")
    out = {r["pickup_zone_id"]: r for r in feat.enrich_trips(trips, zones).collect()}
    assert out[1]["pu_zone_avg_fare"] == 10.0 and out[1]["do_zone_avg_fare"] == 0.0
    assert out[7]["pu_zone_avg_fare"] == 0.0 and out[7]["do_zone_avg_duration_min"] == 20.0


def test_enrichment_keeps_every_row_with_unproven_zone_sizes(spark):
    """No broadcast is forced: a daily zone frame is joined as it measures."""
    raw = trips_from_lineitem(spark, SF0001)
    t = trp.clean_trips(raw)
    out = feat.enrich_trips(t, feat.zone_stats(raw))
    assert out.count() == t.count()
