"""Trip cleaning.

All filters are plain predicates on columns or on derived columns; Catalyst
substitutes the aliases and pushes the column-only predicates (distance,
amount, zone ids) into the Parquet scan of a real bronze table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions import duration_min, row_key, weekday_monday0

# Fixed values that define the cleaning rules of the reference pipeline.
ZONE_MIN, ZONE_MAX = 1, 263
DISTANCE_OPEN = (0.0, 100.0)          # 0 < trip_distance < 100
FARE_TRIPS = (1.0, 500.0)             # 1 <= total_amount <= 500 (trips)
FARE_ZONE_STATS_OPEN = (0.0, 500.0)   # 0 < total_amount < 500 (zone stats)
DURATION_MIN = (1.0, 180.0)           # 1 <= duration_min <= 180
PASSENGERS = (0, 9)                   # 0 <= passenger_count <= 9

# Columns of the bronze trip tables, from which a missing row key is derived.
BRONZE_TRIP_COLUMNS = [
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID",
    "DOLocationID", "trip_distance", "passenger_count", "total_amount",
]

SILVER_TRIP_COLUMNS = [
    "pickup_zone_id", "dropoff_zone_id", "trip_distance", "pickup_hour",
    "pickup_day_of_week", "pickup_month", "passenger_count", "duration_min",
    "total_amount",
]


def time_features(ts, prefix: str = "pickup_") -> list[Column]:
    """Hour, day of week (Monday = 0) and month of a timestamp."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return [F.hour(c).alias(f"{prefix}hour"),
            weekday_monday0(c).alias(f"{prefix}day_of_week"),
            F.month(c).alias(f"{prefix}month")]


def _rule_predicates(pickup_zone: Column, dropoff_zone: Column | None, distance: Column,
                     amount: Column, duration: Column, passengers: Column | None) -> dict:
    rules = {
        "distance": (distance > DISTANCE_OPEN[0]) & (distance < DISTANCE_OPEN[1]),
        "amount": amount.between(*FARE_TRIPS),
        "duration": duration.between(*DURATION_MIN),
        "pickup_zone": pickup_zone.between(ZONE_MIN, ZONE_MAX),
    }
    if dropoff_zone is not None:
        rules["dropoff_zone"] = dropoff_zone.between(ZONE_MIN, ZONE_MAX)
    if passengers is not None:
        rules["passengers"] = passengers.between(*PASSENGERS)
    return rules


def clean_trips(bronze: DataFrame, keep=("trip_key",), zone_filter: bool = True) -> DataFrame:
    """bronze trips → silver trip rows (features + targets).

    ``zone_filter=False`` gives the older variant (no zone-range filter).
    ``keep`` passes extra columns through, nulls included; ``trip_key``, which
    drives splits, is derived from the row where it is missing or null.
    Rows with a null feature or target are dropped (an absent
    ``passenger_count`` is no reason to); NaN cannot survive because every
    double column has a finite upper bound (NaN sorts above every number in
    Spark).
    """
    pu, do = (F.col(c).cast("timestamp_ntz") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime"))
    derived = row_key(bronze, BRONZE_TRIP_COLUMNS)
    key = F.coalesce(F.col("trip_key"), derived) if "trip_key" in bronze.columns else derived
    keep = [key.alias(k) if k == "trip_key" else F.col(k) for k in keep if k == "trip_key" or k in bronze.columns]
    has_pass = "passenger_count" in bronze.columns
    out = bronze.select(
        F.col("PULocationID").alias("pickup_zone_id"),
        F.col("DOLocationID").alias("dropoff_zone_id"),
        F.col("trip_distance"),
        *time_features(pu),
        (F.col("passenger_count") if has_pass else F.lit(None).cast("int")).alias("passenger_count"),
        duration_min(pu, do).alias("duration_min"),
        F.col("total_amount"),
        *keep,
    )
    rules = _rule_predicates(
        F.col("pickup_zone_id"), F.col("dropoff_zone_id"), F.col("trip_distance"),
        F.col("total_amount"), F.col("duration_min"),
        F.col("passenger_count") if has_pass else None)
    if not zone_filter:
        rules.pop("pickup_zone"), rules.pop("dropoff_zone")
    cond = None
    for p in rules.values():
        cond = p if cond is None else cond & p
    return out.where(cond).na.drop(subset=[c for c in SILVER_TRIP_COLUMNS if has_pass or c != "passenger_count"])


def outlier_report(bronze: DataFrame) -> DataFrame:
    """Rows before/after cleaning, % removed and the violations of each rule
    (C9), in a single aggregate pass (no second scan for ``after``)."""
    pu, do = (F.col(c).cast("timestamp_ntz") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime"))
    dur = duration_min(pu, do)
    rules = _rule_predicates(F.col("PULocationID"), F.col("DOLocationID"),
                             F.col("trip_distance"), F.col("total_amount"), dur,
                             F.col("passenger_count") if "passenger_count" in bronze.columns else None)
    ok = None
    for p in rules.values():
        ok = p if ok is None else ok & p
    aggs = [F.count(F.lit(1)).alias("rows_before"),
            F.count_if(F.coalesce(ok, F.lit(False))).alias("rows_after")]
    aggs += [F.count_if(~F.coalesce(p, F.lit(False))).alias(f"{name}_violations")
             for name, p in rules.items()]
    rep = bronze.agg(*aggs)
    return rep.withColumn(
        "pct_removed",
        F.round(F.when(F.col("rows_before") > 0,
                       (F.col("rows_before") - F.col("rows_after")) * 100.0 / F.col("rows_before")), 4))


def load_source(raw: DataFrame | None, streaming: DataFrame | None, data_source: str = "raw") -> DataFrame:
    """Choose ``raw`` / ``streaming`` / ``combined`` input (A13). Combined is a
    by-name union; the streaming rows' extra ``date`` column is null-filled
    on raw rows (H1). A missing streaming table is skipped in combined mode
    and is a clear error in streaming mode."""
    if data_source not in ("raw", "streaming", "combined"):
        raise ValueError(f"unknown data_source {data_source!r}")
    parts = []
    if data_source in ("raw", "combined"):
        if raw is None:
            raise ValueError("raw table is required")
        parts.append(raw)
    if data_source in ("streaming", "combined"):
        if streaming is not None:
            parts.append(streaming)
        elif data_source == "streaming":
            raise ValueError("data_source='streaming' but no streaming table exists")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
