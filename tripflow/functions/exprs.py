"""Scalar expressions used across operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def seconds_between(start, end) -> Column:
    """``end - start`` in seconds (decimal, microsecond precision).

    The difference of two TIMESTAMP_NTZ values is a day-time interval; read
    as seconds it is exact and involves no time zone (no cast to a zoned
    timestamp, so no daylight-saving effects whatever the session zone).
    """
    return (_c(end) - _c(start)).cast("interval second").cast("decimal(20,6)")


def micros_between(start, end) -> Column:
    """``end - start`` in whole microseconds (bigint), zone independent."""
    return (seconds_between(start, end) * F.lit(1_000_000)).cast("long")


def duration_min(pickup, dropoff) -> Column:
    """Fractional minutes between two timestamps (B2)."""
    return seconds_between(pickup, dropoff).cast("double") / F.lit(60.0)


def weekday_monday0(ts) -> Column:
    """Day of week with Monday = 0 (B4). Spark's ``weekday`` already is."""
    return F.weekday(_c(ts))


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 for a TIMESTAMP_NTZ, zone independent."""
    return micros_between(F.expr(_EPOCH_NTZ), _c(ts))


def hash_hex(key, seed: int | str = 42) -> Column:
    """md5 of ``'<seed>|<key>'`` as hex text. Built from a string key so that
    another engine hashing the same text gets the same buckets."""
    return F.md5(F.concat(F.lit(f"{seed}|"), _c(key).cast("string")))


def hash_bucket(key, seed: int | str = 42, buckets: int = 100) -> Column:
    """Deterministic bucket in ``[0, buckets)`` from the first 32 bits of the
    md5 of ``seed|key`` (G4). Independent of partitioning."""
    first32 = F.conv(F.substring(hash_hex(key, seed), 1, 8), 16, 10).cast("long")
    return (first32 % F.lit(buckets)).cast("int")


def row_key(df: DataFrame, cols) -> Column:
    """A key derived from a row's values: md5 over the columns of ``cols``
    that exist, nulls marked. Rows with equal values share a key."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in cols if c in df.columns]))


def default_numeric(c, default: float = 0.0) -> Column:
    """Null (or non-numeric text) to a default after a lookup."""
    return F.coalesce(F.expr(f"try_cast({c} AS DOUBLE)") if isinstance(c, str)
                      else c.cast("double"), F.lit(float(default)))


def select_existing(df: DataFrame, cols) -> DataFrame:
    """Keep only the listed columns that exist."""
    return df.select([c for c in cols if c in df.columns])


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Names of numeric columns (B14), from the schema only (no job)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]
