"""Table catalogue: contracts, lineage and schema enforcement.

The catalogue is data: a DataFrame of tables and one of columns, so
lineage and contract checks are ordinary queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The five tables of the catalogue with layer, freshness
# target, partitioning, upstream tables and column contracts
# (type, nullable, min, max, unique).
CATALOG = [
    {"name": "bronze_raw", "owner": "data-engineering", "format": "parquet",
     "description": "Raw trip records as they were delivered",
     "layer": "bronze", "path": "bronze/raw", "freshness_sla": "24h",
     "partition_by": [], "upstream": [],
     "columns": [("tpep_pickup_datetime", "timestamp", False, None, None, False),
                 ("tpep_dropoff_datetime", "timestamp", False, None, None, False),
                 ("PULocationID", "int", False, 1, 263, False),
                 ("DOLocationID", "int", False, 1, 263, False),
                 ("trip_distance", "float", False, 0, None, False),
                 ("passenger_count", "int", True, 0, 9, False),
                 ("total_amount", "float", False, None, None, False)]},
    {"name": "bronze_streaming", "owner": "data-engineering", "format": "parquet",
     "description": "Streamed batches of trips, partitioned by date",
     "layer": "bronze", "path": "bronze/streaming", "freshness_sla": "10m",
     "partition_by": ["date"], "upstream": [],
     "columns": [("tpep_pickup_datetime", "timestamp", False, None, None, False),
                 ("tpep_dropoff_datetime", "timestamp", False, None, None, False),
                 ("PULocationID", "int", False, 1, 263, False),
                 ("DOLocationID", "int", False, 1, 263, False),
                 ("trip_distance", "float", False, 0, None, False),
                 ("passenger_count", "int", True, 0, 9, False),
                 ("total_amount", "float", False, None, None, False),
                 ("date", "string", True, None, None, False)]},
    {"name": "silver_trips", "owner": "ml-engineering", "format": "parquet",
     "description": "Cleaned trips with engineered features, outliers removed",
     "layer": "silver", "path": "silver/trips", "freshness_sla": "1h",
     "partition_by": [], "upstream": ["bronze_raw", "bronze_streaming"],
     "columns": [("pickup_zone_id", "int", False, 1, 263, False),
                 ("dropoff_zone_id", "int", False, 1, 263, False),
                 ("trip_distance", "float", False, 0, 100, False),
                 ("pickup_hour", "int", False, 0, 23, False),
                 ("pickup_day_of_week", "int", False, 0, 6, False),
                 ("pickup_month", "int", False, 1, 12, False),
                 ("passenger_count", "int", False, 0, 9, False),
                 ("duration_min", "float", False, 1, 180, False),
                 ("total_amount", "float", False, 1, 500, False)]},
    {"name": "silver_demand", "owner": "ml-engineering", "format": "parquet",
     "description": "Trip counts per zone per hour",
     "layer": "silver", "path": "silver/demand", "freshness_sla": "1h",
     "partition_by": [], "upstream": ["bronze_raw", "bronze_streaming"],
     "columns": [("zone_id", "int", False, 1, 263, False),
                 ("pickup_hour", "int", False, 0, 23, False),
                 ("day_of_week", "int", False, 0, 6, False),
                 ("month", "int", False, 1, 12, False),
                 ("trip_count", "int", False, 1, None, False)]},
    {"name": "gold_zone_stats", "owner": "ml-engineering", "format": "parquet",
     "description": "Statistics per zone for the feature store",
     "layer": "gold", "path": "gold/zone_stats", "freshness_sla": "24h",
     "partition_by": [], "upstream": ["bronze_raw"],
     "columns": [("zone_id", "int", False, 1, 263, True),
                 ("zone_avg_fare", "float", True, 0, None, False),
                 ("zone_avg_duration_min", "float", True, 0, None, False),
                 ("zone_avg_distance", "float", True, 0, None, False),
                 ("zone_trip_count", "int", True, 0, None, False),
                 ("event_timestamp", "timestamp", False, None, None, False)]},
]

_TYPES = {"timestamp": T.TimestampNTZType(), "int": T.IntegerType(), "float": T.DoubleType(),
          "string": T.StringType()}
_SLA_UNITS = {"s": 1, "m": 60, "h": 3600, "d": 86400}


def sla_seconds(text: str) -> int:
    return int(text[:-1]) * _SLA_UNITS[text[-1]]


def schema_for(name: str) -> T.StructType:
    """StructType of a catalogue table; constraints ride along as metadata."""
    t = next(x for x in CATALOG if x["name"] == name)
    return T.StructType([
        T.StructField(c, _TYPES[ty], nullable, {"min": lo, "max": hi, "unique": uq})
        for c, ty, nullable, lo, hi, uq in t["columns"]])


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the declared types and keep the declared columns (A6). Under
    ANSI mode a value that does not fit fails the job instead of silently
    becoming null."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def catalog_df(spark: SparkSession) -> DataFrame:
    rows = [(t["name"], t["layer"], t["path"], t["freshness_sla"], sla_seconds(t["freshness_sla"]),
             t["partition_by"], t["upstream"], t["owner"], t["format"], t["description"]) for t in CATALOG]
    return spark.createDataFrame(rows, "name string, layer string, path string, freshness_sla string, "
                                       "sla_seconds int, partition_by array<string>, upstream array<string>, "
                                       "owner string, format string, description string")


def columns_df(spark: SparkSession) -> DataFrame:
    rows = [(t["name"], c, ty, nullable, None if lo is None else float(lo),
             None if hi is None else float(hi), uq)
            for t in CATALOG for c, ty, nullable, lo, hi, uq in t["columns"]]
    return spark.createDataFrame(rows, "table string, column string, type string, nullable boolean, "
                                       "min double, max double, unique boolean")


def lineage_df(spark: SparkSession) -> DataFrame:
    """Upstream edges ``(table, upstream)`` by exploding the catalogue."""
    return catalog_df(spark).select(F.col("name").alias("table"), F.explode("upstream").alias("upstream"))


def stale_tables(freshness: DataFrame) -> DataFrame:
    """Which tables a late one makes stale (A14, I6): ``(table, late_table,
    depth, tightest_sla_seconds)`` for every table that misses its target in
    ``freshness`` (table, within_sla) and all tables built from it, at any
    distance; with the tightest target on the way. A recursive query over the
    upstream edges, as deep as there are tables at most."""
    spark = freshness.sparkSession
    tables = catalog_df(spark).select(F.col("name").alias("table"), F.col("sla_seconds").cast("long").alias("sla"))
    late = freshness.where(~F.col("within_sla")).select("table").join(tables, "table")
    edges = lineage_df(spark).join(tables, "table")
    return spark.sql(f"""
        WITH RECURSIVE stale AS (
          SELECT table AS late_table, table, 0 AS depth, sla AS tightest FROM {{late}}
          UNION ALL
          SELECT s.late_table, e.table, s.depth + 1, least(s.tightest, e.sla)
          FROM stale s JOIN {{edges}} e ON e.upstream = s.table WHERE s.depth < {len(CATALOG)})
        SELECT table, late_table, min(depth) AS depth, min(tightest) AS tightest_sla_seconds
        FROM stale GROUP BY table, late_table""", late=late, edges=edges)
