"""Feature store on DataFrames.

The offline source is any frame with entity keys, features and an event
timestamp. Materialisation keeps the latest row per key inside a time
window and merges it into the online table (a keyed DataFrame/Parquet
table). Online reads are left joins of an entity frame with the online
table, with a TTL test — the entity frame can be a whole request stream.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions import duration_min
from tripflow.operators.features import MAX_ZONES, ZONE_FEATURES
from tripflow.operators.trips import (DISTANCE_OPEN, DURATION_MIN, FARE_ZONE_STATS_OPEN,
                                      ZONE_MAX, ZONE_MIN)


@dataclass(frozen=True)
class FeatureView:
    """Entity keys, feature columns, event-time column and time to live."""
    name: str
    keys: tuple
    features: tuple
    ts: str = "event_timestamp"
    ttl: timedelta = field(default=timedelta(days=90))
    max_entities: int | None = None      # proven bound on distinct keys, if any


# The zone feature view (entity zone_id, 3 doubles + 1 long, TTL 90 days).
ZONE_VIEW = FeatureView("zone_stats", ("zone_id",), (*ZONE_FEATURES, "zone_trip_count"),
                        "event_timestamp", timedelta(days=90), MAX_ZONES)


def daily_zone_stats(bronze: DataFrame) -> DataFrame:
    """Offline feature rows: zone statistics per pickup zone and pickup
    day, stamped with the day (one row per zone and day)."""
    pu, do = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    t = bronze.select(F.col("PULocationID").alias("zone_id"), "total_amount", "trip_distance",
                      duration_min(pu, do).alias("duration_min"),
                      F.to_date(pu).cast("timestamp_ntz").alias("event_timestamp")).where(
        (F.col("trip_distance") > DISTANCE_OPEN[0]) & (F.col("trip_distance") < DISTANCE_OPEN[1])
        & (F.col("total_amount") > FARE_ZONE_STATS_OPEN[0]) & (F.col("total_amount") < FARE_ZONE_STATS_OPEN[1])
        & F.col("zone_id").between(ZONE_MIN, ZONE_MAX) & F.col("duration_min").between(*DURATION_MIN))
    return t.groupBy("zone_id", "event_timestamp").agg(
        F.round(F.avg("total_amount"), 2).alias("zone_avg_fare"),
        F.round(F.avg("duration_min"), 2).alias("zone_avg_duration_min"),
        F.round(F.avg("trip_distance"), 2).alias("zone_avg_distance"),
        F.count(F.lit(1)).alias("zone_trip_count"))


def materialize_incremental(source: DataFrame, view: FeatureView, end: str, start: str | None = None,
                            online: DataFrame | None = None) -> DataFrame:
    """Latest feature row per entity with ``start < ts <= end`` merged into
    ``online`` (I12): per key, the row with the greatest event time wins.
    ``max(struct(ts, ...))`` is a partial+final aggregate, so a key with a
    third of all rows is reduced map-side."""
    cols = [view.ts, *view.features]
    cond = F.col(view.ts) <= F.to_timestamp_ntz(F.lit(end))
    if start is not None:
        cond = cond & (F.col(view.ts) > F.to_timestamp_ntz(F.lit(start)))
    new = source.where(cond).select(*view.keys, *cols)
    if online is not None:
        new = new.unionByName(online.select(*view.keys, *cols))
    latest = new.groupBy(*view.keys).agg(F.max(F.struct(*cols)).alias("_s"))
    return latest.select(*view.keys, *[F.col(f"_s.{c}").alias(c) for c in cols])


def get_online_features(entities: DataFrame, online: DataFrame, view: FeatureView, as_of: str,
                        prefix: str = "", default: float | None = 0.0,
                        order_col: str | None = None) -> DataFrame:
    """Features for every entity row, order-free (D3, I13): left join on the
    keys; a row older than ``as_of - ttl`` is expired; missing or expired
    features become ``default`` (0.0, as the scoring service does) and
    ``<prefix>found`` tells which rows were served from the store."""
    ttl_s = int(view.ttl.total_seconds())
    fresh = F.col(view.ts) >= F.timestamp_add("SECOND", F.lit(-ttl_s), F.to_timestamp_ntz(F.lit(as_of)))
    side = online.where(fresh).select(*view.keys, *view.features, F.lit(True).alias("_found"))
    j = entities.join(side, list(view.keys), "left")
    feats = []
    for c in view.features:
        v = F.col(c)
        if default is not None:
            v = F.coalesce(v, F.lit(default).cast(online.schema[c].dataType))
        feats.append(v.alias(f"{prefix}{c}"))
    out = j.select(*entities.columns, *feats, F.coalesce("_found", F.lit(False)).alias(f"{prefix}found"))
    # request order is kept through a position column of the entity frame
    return out.orderBy(order_col) if order_col else out
