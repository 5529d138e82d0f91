"""Zone statistics, demand aggregates and enrichment joins.

Aggregations are hash aggregates with a map-side partial step, so a hot
zone (even a third of all trips) is pre-combined in every task before the
shuffle and the shuffle carries at most one row per zone per task.
The zone table that enrichment joins against is bounded by construction —
one row per zone id in 1..263 — so it is broadcast and the large trip side
is never shuffled for the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions import duration_min, weekday_monday0
from tripflow.operators.trips import (DISTANCE_OPEN, DURATION_MIN,
                                      FARE_ZONE_STATS_OPEN, ZONE_MAX, ZONE_MIN)

ZONE_FEATURES = ["zone_avg_fare", "zone_avg_duration_min", "zone_avg_distance"]
ZONE_STATS_COLUMNS = ["zone_id", *ZONE_FEATURES, "zone_trip_count", "event_timestamp"]
MAX_ZONES = ZONE_MAX - ZONE_MIN + 1


def zone_stats(bronze: DataFrame, ts_mode: str = "zone") -> DataFrame:
    """Per pickup zone: mean fare, duration and distance (2 places), trip
    count, and ``event_timestamp`` (E1).

    ``ts_mode="zone"``: the zone's latest pickup day (current variant);
    ``ts_mode="global"``: the latest pickup day over all zones on every row
    (older variant, E4). The global maximum is taken over the aggregated
    result, which has at most 263 rows.
    """
    pu, do = (F.col(c).cast("timestamp_ntz") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime"))
    trips = bronze.select(
        F.col("PULocationID").alias("zone_id"), "total_amount", "trip_distance",
        duration_min(pu, do).alias("duration_min"), pu.alias("pickup_ts"),
    ).where(
        (F.col("trip_distance") > DISTANCE_OPEN[0]) & (F.col("trip_distance") < DISTANCE_OPEN[1])
        & (F.col("total_amount") > FARE_ZONE_STATS_OPEN[0])
        & (F.col("total_amount") < FARE_ZONE_STATS_OPEN[1])
        & F.col("zone_id").between(ZONE_MIN, ZONE_MAX)
        & F.col("duration_min").between(*DURATION_MIN))
    out = trips.groupBy("zone_id").agg(
        F.round(F.avg("total_amount"), 2).alias("zone_avg_fare"),
        F.round(F.avg("duration_min"), 2).alias("zone_avg_duration_min"),
        F.round(F.avg("trip_distance"), 2).alias("zone_avg_distance"),
        F.count(F.lit(1)).alias("zone_trip_count"),
        F.max("pickup_ts").cast("date").cast("timestamp_ntz").alias("event_timestamp"),
    )
    if ts_mode == "global":
        # <= 263 rows after the group-by: one small window, not a data-sized one
        out = out.withColumn("event_timestamp", F.max("event_timestamp").over(Window.partitionBy()))
    elif ts_mode != "zone":
        raise ValueError("ts_mode must be 'zone' or 'global'")
    return out.orderBy("zone_id")


def zone_stats_from_silver(silver: DataFrame, train_only: bool = True) -> DataFrame:
    """Zone statistics from silver trip rows — with ``train_only`` they are
    computed from train rows only, which removes the target leakage of
    joining whole-table zone means to test rows (SURVEY §0.2 #14)."""
    s = silver.where(F.col("split") == "train") if train_only and "split" in silver.columns else silver
    return (s.groupBy(F.col("pickup_zone_id").alias("zone_id")).agg(
        F.round(F.avg("total_amount"), 2).alias("zone_avg_fare"),
        F.round(F.avg("duration_min"), 2).alias("zone_avg_duration_min"),
        F.round(F.avg("trip_distance"), 2).alias("zone_avg_distance"),
        F.count(F.lit(1)).alias("zone_trip_count")))


def demand(bronze: DataFrame, zone_filter: bool = True, keep_date: bool = False) -> DataFrame:
    """Trips per (pickup zone, calendar date, hour) (E2). Day of week and
    month are functions of the date, so they are derived after the
    aggregate instead of being grouping keys. The date is dropped unless
    ``keep_date`` (then it is ``pickup_date``)."""
    pu = F.col("tpep_pickup_datetime").cast("timestamp_ntz")
    src = bronze.where(F.col("PULocationID").between(ZONE_MIN, ZONE_MAX)) if zone_filter else bronze
    agg = src.groupBy(
        F.col("PULocationID").alias("zone_id"),
        F.to_date(pu).alias("pickup_date"),
        F.hour(pu).alias("pickup_hour"),
    ).agg(F.count(F.lit(1)).alias("trip_count"))
    cols = ["zone_id", "pickup_hour", weekday_monday0("pickup_date").alias("day_of_week"),
            F.month("pickup_date").alias("month"), "trip_count"]
    if keep_date:
        cols.append("pickup_date")
    return agg.select(*cols)


def merge_demand(parts: list[DataFrame], keep_date: bool = False) -> DataFrame:
    """Combine per-source demand.

    ``keep_date=False`` reproduces the reference: the union is re-summed by
    (zone, hour, day of week, month) — the date is lost, so the grain changes.
    ``keep_date=True`` merges at the zone-date-hour grain (parts must come
    from ``demand(..., keep_date=True)``); this equals aggregating the union
    of the raw rows, but shuffles pre-aggregated rows only.
    """
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    keys = ["zone_id", "pickup_hour", "day_of_week", "month"]
    if keep_date:
        keys = ["zone_id", "pickup_date", "pickup_hour", "day_of_week", "month"]
    return u.groupBy(*keys).agg(F.sum("trip_count").alias("trip_count"))


def _prefixed_zone_side(zones: DataFrame, key: str, prefix: str) -> DataFrame:
    side = zones.select(F.col("zone_id").alias(key),
                        *[F.col(c).alias(f"{prefix}{c}") for c in ZONE_FEATURES])
    return side


def enrich_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Two left joins of trips with zone statistics, as pickup (``pu_``) and
    dropoff (``do_``) features; a missing zone gives 0 (D2, B8)."""
    j = (trips.join(_prefixed_zone_side(zones, "pickup_zone_id", "pu_"), "pickup_zone_id", "left")
              .join(_prefixed_zone_side(zones, "dropoff_zone_id", "do_"), "dropoff_zone_id", "left"))
    feats = [f"{p}{c}" for p in ("pu_", "do_") for c in ZONE_FEATURES]
    return j.select(*trips.columns,
                    *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in feats])


def enrich_demand(dem: DataFrame, zones: DataFrame) -> DataFrame:
    """Left join of demand rows with zone statistics on ``zone_id``; missing
    zone → 0 (D1)."""
    side = zones.select("zone_id", *ZONE_FEATURES, "zone_trip_count")
    j = dem.join(side, "zone_id", "left")
    return j.select(*dem.columns,
                    *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ZONE_FEATURES],
                    F.coalesce(F.col("zone_trip_count"), F.lit(0).cast("long")).alias("zone_trip_count"))
