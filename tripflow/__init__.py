"""tripflow: trip-record lakehouse operators expressed as Spark DataFrame plans.

Layout
------
sources/    lake I/O (versioned Parquet tables), fixtures derived from the
            driver tables, table catalogue
functions/  column-expression helpers (durations, weekdays, hash buckets)
operators/  the data operators: trip cleaning, zone/demand aggregates,
            enrichment joins, sampling and splits, data quality, drift,
            feature store, models, metric time-series queries
plans/      partitioning helpers (bounded broadcast, distributed prefix sums,
            time-bucketed series windows) and the end-to-end jobs
streaming/  Structured Streaming ingest and windowed demand
"""

from tripflow.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
