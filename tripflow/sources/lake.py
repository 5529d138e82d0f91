"""Versioned Parquet tables in bronze/silver/gold layers.

Layout of a table at ``{root}/{layer}/{name}``::

    data/v=<version>/...parquet        files written by one commit
                                       (optionally partitioned inside)
    _log/v=<version>/part-*.json       one JSON commit record per version

A commit record is written *after* its data, with ``errorifexists`` so two
writers cannot claim the same version; readers only see versions that have
a record. Reading version V takes the last ``overwrite`` (or ``compact``) at
or before V plus the appends after it. Everything goes through Spark's
readers/writers and the Hadoop FileSystem, so the root can be any shared
file system or object store.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = ("version bigint, mode string, ts double, rows bigint, files bigint, "
              "partition_by array<string>, schema string")


def _jpath(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _jpath(spark, path)
    return bool(fs.exists(p))


def _dir_bytes_files(spark: SparkSession, path: str) -> tuple[int, int]:
    fs, p = _jpath(spark, path)
    if not fs.exists(p):
        return 0, 0
    summary = fs.getContentSummary(p)
    return int(summary.getLength()), int(summary.getFileCount())


@dataclass
class Lake:
    """A lake root with bronze/silver/gold tables (A10)."""
    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def table(self, layer: str, name: str) -> "Table":
        return Table(self.spark, self.path(layer, name))

    def plain(self, layer: str, name: str) -> "PlainTable":
        return PlainTable(self.spark, self.path(layer, name))

    def register(self, tables: dict[str, tuple[str, str]]) -> list[str]:
        """Expose tables to SQL under names (A3): ``{view: (layer, name)}``.
        Views are lazy; a query over them prunes columns and pushes filters
        into the Parquet scan."""
        done = []
        for view, (layer, name) in tables.items():
            t = self.table(layer, name)
            if t.exists():
                t.read().createOrReplaceTempView(view)
                done.append(view)
        return done

    def sql(self, text: str, tables: dict[str, tuple[str, str]] | None = None) -> DataFrame:
        """Ad-hoc SQL over registered lake tables (A12); plain paths work too
        with ``parquet.`/path```."""
        if tables:
            self.register(tables)
        return self.spark.sql(text)


class Table:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # -- log --------------------------------------------------------------
    def _log_dir(self) -> str:
        return f"{self.path}/_log"

    def history(self) -> DataFrame:
        """Committed versions ``(version, mode, ts, rows, files, ...)``."""
        if not path_exists(self.spark, self._log_dir()):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return (self.spark.read.schema(LOG_SCHEMA).json(self._log_dir())
                .drop("v").orderBy("version"))

    def exists(self) -> bool:
        """A table exists once it has a committed version."""
        return path_exists(self.spark, self._log_dir()) and self.latest_version() is not None

    def latest_version(self) -> int | None:
        if not path_exists(self.spark, self._log_dir()):
            return None
        r = self.history().agg(F.max("version")).collect()[0][0]
        return None if r is None else int(r)

    def _snapshot_versions(self, version: int | None) -> list[int]:
        h = self.history()
        if version is not None:
            h = h.where(F.col("version") <= version)
        rows = h.select("version", "mode").collect()     # one row per commit
        if not rows:
            raise FileNotFoundError(f"no committed version in {self.path}")
        rows.sort(key=lambda r: r["version"])
        base = max((r["version"] for r in rows if r["mode"] in ("overwrite", "compact")), default=rows[0]["version"])
        return [r["version"] for r in rows if r["version"] >= base]

    # -- read / write -------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        """Current version, or a given one (A2, A4). Partition columns of the
        table come back as columns and filter on them prunes directories."""
        vs = self._snapshot_versions(version)
        paths = [f"{self.path}/data/v={v}" for v in vs]
        return (self.spark.read.option("basePath", f"{self.path}/data").parquet(*paths)
                .drop("v"))

    def write(self, df: DataFrame, mode: str = "append", partition_by: list[str] | None = None,
              schema=None, gate: Callable[[DataFrame], None] | None = None) -> int:
        """Write a new version (A5): ``append`` / ``overwrite`` / ``error``
        (fail if the table exists). ``schema`` enforces types by cast (A6).
        ``gate`` gets the written rows before they are committed; if it raises,
        no version comes about. Rows are counted by the write itself."""
        if mode not in ("append", "overwrite", "error", "compact"):
            raise ValueError(f"unknown mode {mode!r}")
        if mode == "error" and self.exists():
            raise FileExistsError(f"table exists: {self.path}")
        if schema is not None:
            from tripflow.sources.catalog import enforce_schema
            df = enforce_schema(df, schema)
        latest = self.latest_version()
        version = 0 if latest is None else latest + 1
        vdir = f"{self.path}/data/v={version}"
        counted = Observation()
        w = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(vdir)
        rows = int(counted.get["rows"])
        if gate is not None:
            gate(self.spark.read.schema(df.schema).parquet(vdir))
        _, files = _dir_bytes_files(self.spark, vdir)
        rec = {"version": version, "mode": "overwrite" if mode == "error" else mode, "ts": time.time(),
               "rows": rows, "files": files, "partition_by": list(partition_by or []),
               "schema": df.schema.json()}
        (self.spark.createDataFrame([json.dumps(rec)], "string").coalesce(1)
         .write.mode("errorifexists").text(f"{self._log_dir()}/v={version}"))
        return version

    def compact(self, target_file_bytes: int = 128 * 1024 * 1024) -> dict:
        """Rewrite the current snapshot into files of about
        ``target_file_bytes`` as a new version; report files before/after (A7)."""
        vs = self._snapshot_versions(None)
        before_bytes = before_files = 0
        for v in vs:
            b, f = _dir_bytes_files(self.spark, f"{self.path}/data/v={v}")
            before_bytes, before_files = before_bytes + b, before_files + f
        n = max(1, -(-before_bytes // target_file_bytes))
        h = self.history().where(F.col("version") == vs[-1]).select("partition_by").collect()
        part = list(h[0][0] or []) if h else []
        df = self.read()
        df = df.repartition(n, *part) if part else df.repartition(n)
        v = self.write(df, mode="compact", partition_by=part or None)
        after = self.history().where(F.col("version") == v).select("files").collect()[0][0]
        return {"version": v, "files_before": before_files, "files_after": int(after)}


class PlainTable:
    """A folder of partitioned Parquet that any reader can open. Writing
    replaces whole partitions, so writing the same partitions again changes
    nothing: a replay neither adds nor loses rows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def exists(self) -> bool:
        """Whether a partition has been published."""
        fs, p = _jpath(self.spark, self.path)
        return bool(fs.exists(p)) and any(
            f.isDirectory() and not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(p))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def replace_partitions(self, df: DataFrame, partition_by: list[str],
                           gate: Callable[[DataFrame], None] | None = None) -> None:
        """Replace the partitions that ``df`` has rows for. They are written
        beside the table (readers skip names with an underscore), shown to
        ``gate``, and moved into place; if the gate raises, the table stays as
        it was."""
        staged = f"{self.path}/_staged/{uuid.uuid4().hex}"
        try:
            df.write.partitionBy(*partition_by).parquet(staged)
            if gate is not None:
                gate(self.spark.read.schema(df.schema).parquet(staged))
            self._publish(staged, len(partition_by))
        finally:
            fs, p = _jpath(self.spark, staged)
            fs.delete(p, True)

    def _publish(self, staged: str, depth: int) -> None:
        fs, root = _jpath(self.spark, staged)
        level = [root]
        for _ in range(depth):      # the partition folders of this one write
            level = [f.getPath() for d in level for f in fs.listStatus(d)
                     if f.isDirectory() and not f.getPath().getName().startswith(("_", "."))]
        base = root.toUri().getPath().rstrip("/")
        for folder in level:
            _, target = _jpath(self.spark, self.path + folder.toUri().getPath()[len(base):])
            fs.delete(target, True)
            fs.mkdirs(target.getParent())
            if not fs.rename(folder, target):
                raise OSError(f"could not move {folder} to {target}")


def read_months(spark: SparkSession, root: str, months: str,
                pattern: str = "yellow_tripdata_{month}.parquet") -> DataFrame:
    """Read monthly Parquet files given as ``"2024-01,2024-02"`` as one frame
    (A1, B15); columns are matched by name across months."""
    paths = [f"{root.rstrip('/')}/{pattern.format(month=m.strip())}" for m in months.split(",") if m.strip()]
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def export_features(df: DataFrame, path: str, rows_per_file: int = 10_000_000) -> None:
    """Write a feature table for a feature server (A11): one Parquet file up to
    ``rows_per_file`` rows, else as many as needed. The plan above runs with its
    own parallelism; only its finished rows are brought together, dealt evenly."""
    rows = df.count()
    df.repartition(max(1, -(-rows // rows_per_file))).write.mode("overwrite").parquet(path)


def write_drift_report(lake: Lake, report: DataFrame, run_ts: str) -> int:
    """Append a drift report to ``monitoring/drift_reports`` partitioned by
    run date (A16)."""
    out = report.withColumn("run_ts", F.to_timestamp_ntz(F.lit(run_ts))) \
                .withColumn("run_date", F.lit(run_ts[:10]))
    return lake.table("monitoring", "drift_reports").write(out, "append", partition_by=["run_date"])
