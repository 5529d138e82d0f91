"""Structured Streaming: incremental trip ingest and hourly demand.

* ``ingest_stream`` — file source → per-batch quality gate → the plain Parquet
  table that the jobs read, partitioned by ``date`` and ``feed`` (the feed file
  a row came from). The checkpoint replaces the reference's JSON cursor. A file
  is never split over micro-batches, so replaying it, by whatever batches,
  replaces its own partitions and nothing else. Rows, checks, column statistics
  and the latest pickup are observed in the write itself.
* ``demand_stream`` — hourly trip counts per zone: partial counts per
  micro-batch, idempotent by batch id, summed when read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators.models import Champion, score
from tripflow.operators.observed import Observed
from tripflow.operators.trips import ZONE_MAX, ZONE_MIN
from tripflow.sources.lake import PlainTable


def feed_stream(spark: SparkSession, feed_dir: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """File source over a feed folder (new files are picked up by the
    checkpointed file log, in modification-time order)."""
    r = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(feed_dir)


def ingest_stream(spark: SparkSession, feed_dir: str, schema, table_dir: str, checkpoint: str,
                  gate_table: str = "bronze_streaming", timeout_s: int | None = None,
                  from_date: str | None = None, on_batch: Callable[[Observed, DataFrame, int], None] | None = None,
                  files_per_trigger: int | None = None, on_pass: Callable[[DataFrame], None] | None = None) -> None:
    """Incremental ingest with a durable cursor (J1, J2, J7): process all
    available feed files (``availableNow``), check every micro-batch while it is
    written, and publish it by ``date`` and ``feed``. A batch that fails its
    checks raises and leaves the table as it was. ``from_date`` with a fresh
    checkpoint replays whole days from that one on (J3), into the same table or
    another. ``on_batch(seen, checks, batch_id)`` gets each batch's observed
    metrics and checks, also of a batch that fails; ``on_pass(rows)`` the rows of
    one that passes, before they are published."""
    table = PlainTable(spark, table_dir)

    def per_batch(batch: DataFrame, batch_id: int):
        seen = Observed(batch.drop("feed"), gate_table, ts_col="tpep_pickup_datetime")

        def gate(staged: DataFrame) -> None:
            if not seen.rows:
                return                          # nothing new: nothing to check or publish
            results = seen.checks(staged)
            if on_batch is not None:
                on_batch(seen, results, batch_id)
            seen.fail()
            if on_pass is not None:
                on_pass(staged)

        table.replace_partitions(seen.watch(batch.withColumn("date", day)), ["date", "feed"], gate)

    day = F.date_format("tpep_pickup_datetime", "yyyy-MM-dd")
    # the file's path below the feed folder, as a name that is safe in a path
    below = F.substring_index(F.col("_metadata.file_path"), f"/{feed_dir.rstrip('/').split('/')[-1]}/", -1)
    src = feed_stream(spark, feed_dir, schema, files_per_trigger).withColumn("feed", F.sha2(below, 256).substr(1, 16))
    if from_date:
        src = src.where(F.to_date("tpep_pickup_datetime") >= F.to_date(F.lit(from_date)))
    q = (src.writeStream
         .foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("ingest_stream did not finish in time")


def demand_stream(spark: SparkSession, source: DataFrame, out_dir: str, checkpoint: str,
                  timeout_s: int | None = None) -> DataFrame:
    """Hourly trip counts per pickup zone from a stream of trips (J5). Each
    micro-batch writes its partial counts to its own folder (a replayed batch
    overwrites its own), and reading sums them, so rows of any lateness count
    and a run may stop and resume at any batch."""
    def per_batch(batch: DataFrame, batch_id: int):
        (hourly_counts(batch).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}"))

    q = (source.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("demand_stream did not finish in time")
    return read_demand(spark, out_dir)


def hourly_counts(trips: DataFrame) -> DataFrame:
    """(zone_id, window_start, trip_count) of trips in valid zones."""
    return (trips.where(F.col("PULocationID").between(ZONE_MIN, ZONE_MAX))
            .groupBy(F.col("PULocationID").alias("zone_id"),
                     F.date_trunc("hour", F.col("tpep_pickup_datetime")).cast("timestamp_ntz").alias("window_start"))
            .agg(F.count(F.lit(1)).alias("trip_count")))


def read_demand(spark: SparkSession, out_dir: str) -> DataFrame:
    """The sums over all batches that ``demand_stream`` has written."""
    parts = spark.read.schema("zone_id int, window_start timestamp_ntz, trip_count long, batch_id long").parquet(out_dir)
    return parts.groupBy("zone_id", "window_start").agg(F.sum("trip_count").alias("trip_count"))


def score_stream(stream_df: DataFrame, resolve_model, out_dir: str, checkpoint: str,
                 out_col: str = "prediction", decimals: int = 2, timeout_s: int | None = None) -> None:
    """Score a stream (I17, I18): every micro-batch first resolves the model
    (a fitted one, or a ``Champion``, whose name and version then stand on each
    row), so a newer champion is used from the next batch on without a restart;
    predictions of batch ``b`` are written to ``batch_id=b`` with overwrite
    (idempotent replay). Without a model the batch fails, and is tried again by
    the next start."""
    def per_batch(batch: DataFrame, batch_id: int):
        model = resolve_model()
        if model is None:
            raise LookupError("no champion to score with")
        scored = (model.score(batch, out_col, decimals) if isinstance(model, Champion)
                  else score(model, batch, out_col, decimals))
        scored.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")

    q = (stream_df.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("score_stream did not finish in time")
