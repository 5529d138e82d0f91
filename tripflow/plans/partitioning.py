"""Partitioning helpers used by the operators.

* ``prefix_sums`` — exact running sums along a global order without an
  unpartitioned window: rows are cut into value ranges (approximate
  quantiles), summed per range, range offsets come from a tiny table, and
  each range is then scanned in its own task.
* ``reliable_checkpoint`` — materialise a reused intermediate in the shared
  checkpoint folder (never a local checkpoint).
* ``written`` — the same as a Parquet table.
"""

from __future__ import annotations

import math
from uuid import uuid4

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


RANGE_TASKS = 200       # tasks that value ranges are dealt to, whatever their size: so many are written without a sort buffer


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise a reused intermediate into the shared checkpoint folder
    (``spark.checkpoint.dir``) and cut its lineage. Unlike a local
    checkpoint it survives the loss of the executors that computed it."""
    from tripflow.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table beside the checkpoints and read it again:
    as ``reliable_checkpoint``, but compressed, with columns that can be left
    unread and a size known to the planner."""
    from tripflow.session import checkpoint_dir
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prefix_sums(df: DataFrame, group_cols: list[str], order_col: str, sum_cols: list[str],
                ranges: int = 256, with_next: bool = False) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum of ``c`` per group ordered by
    ``order_col``) and optionally ``next_<order_col>`` (the next value in the
    group's order, null for the last row).

    ``order_col`` must be unique within a group (callers pre-aggregate by
    value first). Work per task is one value range of one group, so a group
    with a third of all distinct values is still spread over ``ranges`` tasks.
    Groups are few (cut points and offsets, ``ranges`` a group, are broadcast):
    joined by a shuffle on the group, all its values would meet in one task.
    """
    if not group_cols:       # one implicit group: a constant key, never a cross join
        out = prefix_sums(df.withColumn("_g", F.lit(0)), ["_g"], order_col, sum_cols, ranges,
                          with_next)
        return out.drop("_g")
    g = list(group_cols)
    # 1. range cut points per group from approximate quantiles (tiny result)
    probs = [i / ranges for i in range(1, ranges)]
    cuts = df.groupBy(*g).agg(
        F.percentile_approx(order_col, probs, 10000).alias("_cuts"))
    wide = math.isqrt(ranges)
    cuts = cuts.withColumn("_wide", F.filter("_cuts", lambda c, i: (i + 1) % wide == 0))
    # number of cut points strictly below the value = range id (0..ranges-1):
    # counted among every ``wide``-th one, then among those up to the next of these
    below = lambda c: F.size(F.filter(c, lambda x: x < F.col(order_col)))
    ranged = df.join(F.broadcast(cuts), g, "left").withColumn("_lo", below("_wide") * wide)
    ranged = ranged.withColumn("_rng", F.col("_lo") + below(F.slice("_cuts", F.col("_lo") + 1, F.lit(wide - 1)))) \
                   .drop("_cuts", "_wide", "_lo")
    # 2. per-range totals and first value; offsets over ranges (tiny table)
    tot_aggs = [F.sum(c).alias(f"_tot_{c}") for c in sum_cols]
    tot_aggs.append(F.min(order_col).alias("_first"))
    totals = ranged.groupBy(*g, "_rng").agg(*tot_aggs)
    wg = Window.partitionBy(*g).orderBy("_rng")
    offs = totals.select(
        *g, "_rng",
        *[(F.sum(f"_tot_{c}").over(wg.rowsBetween(Window.unboundedPreceding, -1)))
          .alias(f"_off_{c}") for c in sum_cols],
        F.lead("_first").over(wg).alias("_next_first"))
    # 3. local running sums inside each (group, range); add the offsets
    wl = Window.partitionBy(*g, "_rng").orderBy(order_col)
    local = ranged.repartition(min(ranges, RANGE_TASKS), *g, "_rng").select(
        "*", *[F.sum(c).over(wl.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_loc_{c}")
               for c in sum_cols],
        *([F.lead(order_col).over(wl).alias("_next_loc")] if with_next else []))
    out = local.join(F.broadcast(offs), g + ["_rng"], "left")
    cols = [F.col(c) for c in df.columns]
    cols += [(F.col(f"_loc_{c}") + F.coalesce(F.col(f"_off_{c}"), F.lit(0))).alias(f"cum_{c}")
             for c in sum_cols]
    if with_next:
        cols.append(F.coalesce(F.col("_next_loc"), F.col("_next_first")).alias(f"next_{order_col}"))
    return out.select(*cols)
