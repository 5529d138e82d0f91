"""Trip-shaped and metric-shaped inputs derived from the driver tables.

The driver ships TPC-H-like tables (``lineitem``, ``events`` ...), not trip
records. These functions derive tables with the trip schema of the bronze
layer (FIXTURES.md §5) purely with column expressions, so every query that
starts from them scans the whole driver table and its work grows with it.
Each has a DuckDB twin (``*_SQL``) used by the oracle check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the bronze trip table, in order.
BRONZE_COLUMNS = [
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID",
    "DOLocationID", "trip_distance", "passenger_count", "total_amount",
]


def _minutes(n):
    """A day-time interval of ``n`` minutes (adding it is microsecond math)."""
    return F.make_dt_interval(F.lit(0), F.lit(0), n)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` → bronze_raw-shaped trips (plus a unique-ish ``trip_key``)."""
    li = read_table(spark, sf_dir, "lineitem")
    base = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11 + F.col("l_partkey")) % 1440
    m = base.cast("int")
    n = (base + F.col("l_quantity") * 4 - 5).cast("int")
    return li.select(
        (F.col("l_shipdate") + _minutes(m)).alias("tpep_pickup_datetime"),
        (F.col("l_shipdate") + _minutes(n)).alias("tpep_dropoff_datetime"),
        (F.col("l_partkey") % 266).cast("int").alias("PULocationID"),
        (F.col("l_orderkey") % 266).cast("int").alias("DOLocationID"),
        (F.col("l_extendedprice") / 1000).alias("trip_distance"),
        F.when(F.col("l_tax") == 0, F.lit(None))
         .otherwise(F.col("l_linenumber") + 3).cast("int").alias("passenger_count"),
        (F.col("l_extendedprice") / 200).alias("total_amount"),
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
                    ).alias("trip_key"),
    )


def trips_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` → bronze_streaming-shaped trips with the ``date`` partition key."""
    return trips_of_events(read_table(spark, sf_dir, "events"))


def trips_of_events(ev: DataFrame) -> DataFrame:
    """The trips of ``events`` rows, read at once or as a stream."""
    return ev.select(
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("ts") + _minutes((F.col("event_id") * 7 % 200 - 5).cast("int"))).alias("tpep_dropoff_datetime"),
        (F.col("user_id") * 7 % 266).cast("int").alias("PULocationID"),
        (F.col("event_id") % 266).cast("int").alias("DOLocationID"),
        (F.col("value") / 4).alias("trip_distance"),
        F.when(F.col("event_type") == "error", F.lit(None))
         .otherwise((F.col("event_id") % 11).cast("int")).alias("passenger_count"),
        (F.col("value") * 1.0625).alias("total_amount"),
        F.col("event_id").cast("string").alias("trip_key"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
    )


def metrics_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` → metric samples ``(name, labels, ts, value)``.

    name = event_type, one label ``u`` = user_id % 5, value = event_id % 97
    (a counter with resets).
    """
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("name"),
        F.create_map(F.lit("u"), (F.col("user_id") % 5).cast("string")).alias("labels"),
        F.col("ts"),
        (F.col("event_id") % 97).cast("double").alias("value"),
    )


def region_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``region`` → one info sample each: ``region_info{u="<key>",region="<name>"} 1``."""
    return read_table(spark, sf_dir, "region").select(
        F.lit("region_info").alias("name"),
        F.create_map(F.lit("u"), F.col("r_regionkey").cast("string"), F.lit("region"), F.col("r_name")).alias("labels"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), F.lit(1.0).alias("value"))


def foreign_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` → report documents (event_id, report) of all sorts: complete
    ones, without metrics, with metrics that lack parts, and broken text."""
    digit = (F.col("event_id") % 10).cast("string")
    two = F.lpad((F.col("event_id") % 100).cast("string"), 2, "0")
    whole = F.concat(F.lit('{"metrics":[{"config":{"type":"DriftedColumnsCount(drift_share=0.5)"},"value":{"count":'), digit,
                     F.lit(',"share":0.'), digit, F.lit('}},{"config":{"type":"ValueDrift(column=a)","column":"a","threshold":0.3},"value":0.'),
                     two, F.lit('},{"config":{"type":"ValueDrift(column=b)","column":"b","method":"js"},"value":"0.'), two, F.lit('"}]}'))
    parts = F.concat(F.lit('{"metrics":[{"config":{"type":"ValueDrift","column":"a"}},{"config":null},7,{"config":{"type":"ValueDrift"},'
                           '"value":0.'), two, F.lit('}]}'))
    return read_table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "view", whole).when(F.col("event_type") == "purchase", parts)
        .when(F.col("event_type") == "click", F.lit('{"metrics":[]}')).when(F.col("event_type") == "signup", F.col("props"))
        .when(F.col("event_type") == "error", F.substring(whole, 1, 30)).alias("report"))


# --- DuckDB twins (used only by the oracle SQL) ---------------------------

TRIPS_LINEITEM_SQL = """
SELECT l_shipdate + to_minutes(CAST((l_orderkey*37+l_linenumber*11+l_partkey) % 1440 AS BIGINT)) AS tpep_pickup_datetime,
       l_shipdate + to_minutes(CAST((l_orderkey*37+l_linenumber*11+l_partkey) % 1440 + l_quantity*4-5 AS BIGINT)) AS tpep_dropoff_datetime,
       CAST(l_partkey % 266 AS INTEGER) AS PULocationID,
       CAST(l_orderkey % 266 AS INTEGER) AS DOLocationID,
       l_extendedprice/1000 AS trip_distance,
       CASE WHEN l_tax = 0 THEN NULL ELSE l_linenumber + 3 END AS passenger_count,
       l_extendedprice/200 AS total_amount,
       concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS trip_key
FROM lineitem"""

TRIPS_EVENTS_SQL = """
SELECT ts AS tpep_pickup_datetime,
       ts + to_minutes(CAST(event_id*7 % 200 - 5 AS BIGINT)) AS tpep_dropoff_datetime,
       CAST(user_id*7 % 266 AS INTEGER) AS PULocationID,
       CAST(event_id % 266 AS INTEGER) AS DOLocationID,
       value/4 AS trip_distance,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id % 11 AS INTEGER) END AS passenger_count,
       value*1.0625 AS total_amount,
       CAST(event_id AS VARCHAR) AS trip_key,
       strftime(ts, '%Y-%m-%d') AS date
FROM events"""

METRICS_EVENTS_SQL = """
SELECT event_type AS name, 'u="' || CAST(user_id % 5 AS VARCHAR) || '"' AS labels,
       ts, CAST(event_id % 97 AS DOUBLE) AS value, CAST(user_id % 5 AS VARCHAR) AS u,
       epoch_us(ts) AS t_us
FROM events"""

FOREIGN_REPORTS_SQL = """
SELECT event_id, CASE event_type
  WHEN 'view' THEN '{"metrics":[{"config":{"type":"DriftedColumnsCount(drift_share=0.5)"},"value":{"count":' || event_id % 10 ||
       ',"share":0.' || event_id % 10 || '}},{"config":{"type":"ValueDrift(column=a)","column":"a","threshold":0.3},"value":0.' ||
       lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') || '},{"config":{"type":"ValueDrift(column=b)","column":"b","method":"js"},"value":"0.' ||
       lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') || '"}]}'
  WHEN 'purchase' THEN '{"metrics":[{"config":{"type":"ValueDrift","column":"a"}},{"config":null},7,{"config":{"type":"ValueDrift"},"value":0.' ||
       lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') || '}]}'
  WHEN 'click' THEN '{"metrics":[]}' WHEN 'signup' THEN props
  WHEN 'error' THEN '{"metrics":[{"config":{"type":' END AS report
FROM events"""
