"""Deterministic splits, exact-size samples and hourly slices.

Nothing here depends on the partitioning of the input: every row's fate is
a function of ``md5(seed|key)``. Exact-size selection never sorts the whole
table and never funnels it through one task: counts by the next hex digits of
the hash (at most 65 536 a round, collected) narrow the boundary down to one
hash, and a filter selects; rows of one key are split by a hash of the whole row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from tripflow.functions import hash_bucket, hash_hex, row_key


def hash_split(df: DataFrame, key: str, test_pct: int = 20, seed: int = 42,
               col: str = "split") -> DataFrame:
    """Add ``split`` = 'test' for hash bucket < ``test_pct`` else 'train'."""
    return df.withColumn(col, F.when(hash_bucket(key, seed, 100) < test_pct, F.lit("test"))
                              .otherwise(F.lit("train")))


def _cut(rows: DataFrame, hashed: Column, n: int | float) -> tuple[str, int, int] | None:
    """(hash, need, count) of the n-th smallest hash among ``rows``: its rows
    are ``count``, of which the first ``need`` belong to the n smallest; None
    without rows. ``n`` may be a fraction of the rows (``0 < n < 1``). Each
    round reads four more hex digits of one bucket, until it has one hash: at
    most eight rounds, whatever the keys."""
    base, prefix, need = rows.select(hashed.alias("_h")), "", n
    while True:
        hist = (base.where(F.startswith(F.col("_h"), F.lit(prefix)))
                .groupBy(F.substring("_h", len(prefix) + 1, 4).alias("_p"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("_h").alias("lo"), F.max("_h").alias("hi"))
                .collect())             # <= 16**4 rows by construction
        if not hist:
            return None
        if 0 < need < 1:
            need = math.ceil(need * sum(r["n"] for r in hist))
        hist.sort(key=lambda r: r["_p"])
        for r in hist:
            if need <= r["n"]:
                break
            need -= r["n"]
        else:                           # more than there are
            need = r["n"]
        if r["lo"] == r["hi"]:
            return r["lo"], need, r["n"]
        prefix += r["_p"]


def _row_hash(df: DataFrame) -> Column:
    """md5 over all columns. Rows share it only if all their values are equal:
    each value is hashed by itself, nulls are marked, nested values count as
    text and as JSON."""
    def one(f):
        c = F.col(f"`{f.name}`")
        text = F.md5(c.cast("string").cast("binary"))
        if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)):
            text = F.concat(text, F.md5(F.to_json(c).cast("binary")))
        return F.coalesce(text, F.lit("~"))
    return F.md5(F.concat_ws("|", *[one(f) for f in df.schema.fields]))


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42, where: Column | None = None,
                when: str = "after_filter") -> DataFrame:
    """Exactly ``min(n, rows)`` rows: the n smallest in ``(md5(seed|key), row
    hash)`` order (G3). ``where`` with ``when='before_filter'`` samples first and
    then filters, as an in-engine ``USING SAMPLE`` next to a WHERE does; the
    default filters first.

    The n-th smallest hash comes from counts by hash digits (see ``_cut``); the
    result is then one filter. Rows that share the boundary key are told apart
    by a hash of the whole row, equal rows by a count: nothing is ranked."""
    if when not in ("after_filter", "before_filter"):
        raise ValueError("when must be 'after_filter' or 'before_filter'")
    src = df.where(where) if (where is not None and when == "after_filter") else df
    out = _smallest(src, n, F.coalesce(hash_hex(key, seed), F.lit("~")))
    if where is not None and when == "before_filter":
        out = out.where(where)
    return out


def _smallest(src: DataFrame, n: int, h: Column) -> DataFrame:
    """The n rows of ``src`` with the smallest (hash, row hash); of equal rows as many as fit."""
    cut = _cut(src, h, n) if n > 0 else None
    if cut is None:
        return src.limit(0)
    at, need, count = cut
    if need == count:
        return src.where(h <= at)
    row = _row_hash(src)
    row_at, need, count = _cut(src.where(h == at), row, need)
    if need == count:
        return src.where((h < at) | ((h == at) & (row <= row_at)))
    copies = src.sparkSession.range(need).crossJoin(F.broadcast(src.where((h == at) & (row == row_at)).limit(1)))
    return src.where((h < at) | ((h == at) & (row < row_at))).unionByName(copies.select(*[f"`{c}`" for c in src.columns]))


def exact_split(df: DataFrame, key: str, test_fraction: float = 0.2, seed: int = 42,
                col: str = "split", total: int | None = None) -> DataFrame:
    """Split with exactly ``ceil(test_fraction * n)`` test rows (the rule of
    the common train/test split helper), chosen by hash order. ``n`` comes
    from the first hash histogram unless ``total`` is given.

    Rows that share the boundary key are told apart by a hash of the whole
    row. Where equal rows are left, they are one row and a count: that many
    numbered copies of it are made, so no task gathers them."""
    if test_fraction >= 1:
        return df.withColumn(col, F.lit("test"))
    n_test = math.ceil(test_fraction * total) if total is not None else test_fraction
    if n_test <= 0:
        return df.withColumn(col, F.lit("train"))
    label = lambda test: F.when(test, F.lit("test")).otherwise(F.lit("train"))
    h = F.coalesce(hash_hex(key, seed), F.lit("~"))         # null keys last
    cut = _cut(df, h, n_test)
    if cut is None:
        return df.withColumn(col, F.lit("train"))
    at, need, count = cut
    if need == count:
        return df.withColumn(col, label(h <= at))
    row = _row_hash(df)
    row_at, need, count = _cut(df.where(h == at), row, need)
    if need == count:
        return df.withColumn(col, label((h < at) | ((h == at) & (row <= row_at))))
    same = (h == at) & (row == row_at)
    others = df.where(~same).withColumn(col, label((h < at) | ((h == at) & (row < row_at))))
    copies = df.sparkSession.range(count).select((F.col("id") < need).alias("_test"))
    copies = copies.crossJoin(F.broadcast(df.where(same).limit(1)))     # one row
    return others.unionByName(copies.withColumn(col, label(F.col("_test"))).select(*[f"`{c}`" for c in others.columns]))


def hour_bounds(virtual_dt: str) -> tuple[Column, Column]:
    """[start, start + 1 hour) of the hour containing ``virtual_dt``."""
    start = F.date_trunc("hour", F.to_timestamp_ntz(F.lit(virtual_dt)))
    return start, F.timestamp_add("HOUR", F.lit(1), start)


def hour_slice(bronze: DataFrame, virtual_dt: str, batch_size: int | None = None,
               ts: str = "tpep_pickup_datetime", key: str = "trip_key",
               partition_col: str | None = None) -> DataFrame:
    """Trips whose pickup falls in the hour of ``virtual_dt``, with the ``date``
    partition value added (C8, G2, J4): the whole hour, or with ``batch_size``
    the first so many in (pickup time, key) order. Without the column ``key``
    the order is by the rows' values. The half-open time range is a plain range
    predicate, so it prunes row groups; on a table partitioned by date,
    ``partition_col`` adds the partition predicate Catalyst cannot derive."""
    start, end = hour_bounds(virtual_dt)
    cond = (F.col(ts) >= start) & (F.col(ts) < end)
    if partition_col:
        cond = cond & (F.col(partition_col) == F.date_format(start, "yyyy-MM-dd"))
    hour = bronze.where(cond)
    if batch_size is not None:
        order = F.col(key) if key in bronze.columns else row_key(bronze, bronze.columns)
        hour = hour.orderBy(ts, order).limit(batch_size)
    return hour.withColumn("date", F.date_format(start, "yyyy-MM-dd"))
