"""Checks and statistics of a table out of the job that writes it.

``Observed`` adds the rule counts, the column means and deviations and the
latest event time of a frame to that frame as observed metrics: Spark computes
them in the tasks of the write itself, and they are known when it ends. The
rows are read, and the plan above them runs, once. Only a uniqueness rule, which
needs a grouping, reads the key column of what was written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tripflow.functions import numeric_columns
from tripflow.operators.metrics import to_metrics
from tripflow.operators.quality import PUBLISHED, QualityError, checks, published_summary, rule_columns


class Observed:
    """The checks of one write: ``write(seen.watch(df))``, then ``judge()``.

    ``where`` limits the checks, not the write, to some rows; ``ts_col`` is the
    event time whose latest value is kept."""

    def __init__(self, df: DataFrame, table: str, spec: dict | None = None, where: Column | None = None,
                 ts_col: str | None = None):
        self.table, self.spark = table, df.sparkSession
        self._rules = rule_columns(df, table, spec, where)
        self._numbers = numeric_columns(df)
        self._observation = Observation()
        self._failed: list | None = None
        columns = list(self._rules.counts) + [F.count(F.lit(1)).alias("written")]
        for i, c in enumerate(self._numbers):
            x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
            columns += [F.avg(x).alias(f"m_{i}"), F.stddev_samp(x).alias(f"s_{i}")]
        if ts_col:
            columns.append(F.max(F.unix_timestamp(F.col(ts_col).cast("timestamp"))).alias("latest"))
        self._columns = columns

    def watch(self, df: DataFrame) -> DataFrame:
        """``df`` (the frame, or one with more columns) to be written, once."""
        return df.observe(self._observation, *self._columns)

    @property
    def values(self) -> dict:
        """What was observed; waits for the write to end."""
        return self._observation.get

    @property
    def rows(self) -> int:
        return int(self.values["written"])

    def checks(self, written: DataFrame | None = None) -> DataFrame:
        """One row per check, as ``quality.validate`` gives; ``written`` is read
        for unique keys."""
        names = ["rows", *(f"v_{i}" for i in range(len(self._rules.present)))]
        one = self.spark.createDataFrame([tuple(int(self.values[n]) for n in names)],
                                         ", ".join(f"{n} long" for n in names))
        found = checks(one, written if written is not None else one, self.table, self._rules)
        rows = found.collect()                          # one row per rule
        self._failed = [f"{r['check']}({r['column'] or ''}): {r['observed']}" for r in rows if not r["passed"]]
        return self.spark.createDataFrame(rows, found.schema)

    def metrics(self, results: DataFrame) -> DataFrame:
        """``data_quality_*``, ``data_column_mean`` / ``_std`` and, with an event
        time, ``data_freshness_timestamp`` as metric samples."""
        out = to_metrics(published_summary(results), "data_quality_", PUBLISHED, ["table"])
        v = self.values
        stats = [(self.table, c, v[f"m_{i}"], v[f"s_{i}"]) for i, c in enumerate(self._numbers)]
        if stats:
            frame = self.spark.createDataFrame(stats, "table string, column string, mean double, std double")
            out = out.unionByName(to_metrics(frame, "data_column_", ["mean", "std"], ["table", "column"])
                                  .where(F.col("value").isNotNull()))
        if v.get("latest") is not None:
            last = self.spark.createDataFrame([(self.table.replace("_", ".", 1), int(v["latest"]))],
                                              "table string, freshness_timestamp long")
            out = out.unionByName(to_metrics(last, "data_", ["freshness_timestamp"], ["table"]))
        return out

    def fail(self) -> None:
        """Raise if a check (of the last ``checks()``) did not pass."""
        if self._failed:
            raise QualityError(f"data quality check FAILED for {self.table}: {', '.join(self._failed)}")
