"""Rule-based data quality, column statistics and freshness.

A rule set is validated in ONE aggregate job over the table: every rule
becomes a ``count_if`` expression of the same aggregate. Only ``unique``
rules need their own grouping (one partial+final hash aggregate each).
Results are DataFrames, so they can be unioned across tables, appended to a
metrics table, or turned into a failure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tripflow.functions import numeric_columns, seconds_between

# The five rule sets checked by the reference pipeline
# (min_rows; per column nullable / unique / min / max).
RULES = {
    "bronze_raw": {
        "min_rows": 1,
        "columns": {
            "tpep_pickup_datetime": {"nullable": False},
            "tpep_dropoff_datetime": {"nullable": False},
            "PULocationID": {"nullable": False},
            "DOLocationID": {"nullable": False},
            "trip_distance": {"nullable": False},
        },
    },
    "bronze_streaming": {
        "min_rows": 1,
        "columns": {
            "tpep_pickup_datetime": {"nullable": False},
            "PULocationID": {"nullable": False},
            "DOLocationID": {"nullable": False},
            "trip_distance": {"nullable": False},
        },
    },
    "silver_trips": {
        "min_rows": 100,
        "columns": {
            "pickup_zone_id": {"nullable": False, "min": 1, "max": 263},
            "dropoff_zone_id": {"nullable": False, "min": 1, "max": 263},
            "trip_distance": {"nullable": False, "min": 0, "max": 100},
            "duration_min": {"nullable": False, "min": 1, "max": 180},
            "total_amount": {"nullable": False, "min": 1, "max": 500},
            "pickup_hour": {"nullable": False, "min": 0, "max": 23},
        },
    },
    "silver_demand": {
        "min_rows": 100,
        "columns": {
            "zone_id": {"nullable": False, "min": 1, "max": 263},
            "pickup_hour": {"nullable": False, "min": 0, "max": 23},
            "day_of_week": {"nullable": False, "min": 0, "max": 6},
            "trip_count": {"nullable": False, "min": 1},
        },
    },
    "gold_zone_stats": {
        "min_rows": 1,
        "columns": {
            "zone_id": {"nullable": False, "unique": True, "min": 1, "max": 263},
            "event_timestamp": {"nullable": False},
            "zone_avg_fare": {"min": 0},
            "zone_avg_duration_min": {"min": 0},
            "zone_avg_distance": {"min": 0},
            "zone_trip_count": {"min": 0},
        },
    },
}

# Freshness targets of the table catalogue, in seconds, and the
# dashboard's age levels (300 s yellow, 600 s red).
FRESHNESS_SLA_SECONDS = {
    "bronze_raw": 24 * 3600,
    "bronze_streaming": 10 * 60,
    "silver_trips": 3600,
    "silver_demand": 3600,
    "gold_zone_stats": 24 * 3600,
}
AGE_LEVELS = [(300, "yellow"), (600, "red")]

RESULT_COLUMNS = ["table", "check", "column", "rule", "observed", "passed"]


class QualityError(ValueError):
    """Raised by ``validate_or_fail`` when a rule set fails."""


def _is_null(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    if isinstance(dt, (DoubleType, FloatType)):
        return F.col(c).isNull() | F.isnan(c)      # NaN counts as missing, as in pandas
    return F.col(c).isNull()


def _range_violation(rules: dict, c: str) -> Column | None:
    lo, hi = rules.get("min"), rules.get("max")
    conds = []
    if lo is not None:
        conds.append(F.col(c) < F.lit(lo))
    if hi is not None:
        conds.append(F.col(c) > F.lit(hi))
    if not conds:
        return None
    v = conds[0]
    for x in conds[1:]:
        v = v | x
    return v          # null -> null -> not counted: nulls are exempt from range checks


def _rule_text(rules: dict) -> str:
    parts = []
    if not rules.get("nullable", True):
        parts.append("not_null")
    if rules.get("unique"):
        parts.append("unique")
    if "min" in rules or "max" in rules:
        parts.append(f"range[{rules.get('min', '')},{rules.get('max', '')}]")
    return ",".join(parts) or "present"


def duplicate_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row ``(duplicate_rows, duplicate_groups)``: rows that belong to a
    key group of size > 1 (``keep=False`` semantics; nulls group together).
    The per-key count is a partial+final aggregate: a hot key is combined
    map-side, so skew costs nothing extra."""
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return g.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("duplicate_rows"),
                 F.count(F.lit(1)).alias("duplicate_groups"))


def validate(df: DataFrame, table: str, spec: dict | None = None, missing: str = "skip") -> DataFrame:
    """Validate ``df`` against a rule set; one row per check:
    ``(table, check, column, rule, observed, passed)``.

    * ``row_count``: observed = rows, passed = rows >= min_rows
    * ``unique``: composite key, observed = rows in duplicated groups
    * ``column``: one pass/fail per column; observed = violating rows
      (nulls where not nullable + out-of-range values + duplicated rows)

    A rule on a column that is absent is skipped (``missing='skip'``, the
    reference behaviour) or reported as failed (``missing='fail'``).
    An unknown table with no spec passes with only the row count.
    """
    rules = rule_columns(df, table, spec)
    one = df.agg(*rules.counts)     # the single scan for all per-column rules
    return checks(one, df, table, rules, missing)


@dataclass(frozen=True)
class RuleColumns:
    """A rule set on a frame: (column, rules) that apply, those whose column is
    absent, and the aggregates ``rows``, ``v_0``, ``v_1``, ... that count rows
    and each column's violations."""

    spec: dict
    present: list[tuple[str, dict]]
    absent: list[tuple[str, dict]]
    counts: list[Column]


def rule_columns(df: DataFrame, table: str, spec: dict | None = None, where: Column | None = None) -> RuleColumns:
    """The aggregates of a rule set, over the rows of ``where`` (all)."""
    spec = RULES.get(table, {"min_rows": 0, "columns": {}}) if spec is None else spec
    here = F.lit(True) if where is None else where
    counts = [F.count_if(here).alias("rows")]
    present, absent = [], []
    for c, rules in spec.get("columns", {}).items():
        if c not in df.columns:
            absent.append((c, rules))
            continue
        present.append((c, rules))
        v = _is_null(df, c) if not rules.get("nullable", True) else F.lit(False)
        rv = _range_violation(rules, c)
        v = v if rv is None else (v | F.coalesce(rv, F.lit(False)))
        counts.append(F.count_if(here & v).alias(f"v_{len(present) - 1}"))
    return RuleColumns(spec, present, absent, counts)


def checks(one: DataFrame, df: DataFrame, table: str, rules_of: RuleColumns, missing: str = "skip") -> DataFrame:
    """The checks (see ``validate``) from a one-row frame of the rules' counts;
    ``df`` is read for unique keys only."""
    spec, cols, absent, spark = rules_of.spec, rules_of.present, rules_of.absent, one.sparkSession
    min_rows = int(spec.get("min_rows", 0) or 0)
    entries = []
    if min_rows:
        entries.append(F.struct(F.lit("row_count").alias("check"), F.lit(None).cast("string").alias("column"),
                                F.lit(f">={min_rows}").alias("rule"), F.col("rows").alias("observed"),
                                (F.col("rows") >= min_rows).alias("passed")))
    for i, (c, rules) in enumerate(cols):
        entries.append(F.struct(F.lit("column").alias("check"), F.lit(c).alias("column"),
                                F.lit(_rule_text(rules)).alias("rule"), F.col(f"v_{i}").alias("observed"),
                                (F.col(f"v_{i}") == 0).alias("passed")))
    if missing == "fail":
        for c, rules in absent:
            entries.append(F.struct(F.lit("column").alias("check"), F.lit(c).alias("column"),
                                    F.lit("missing").alias("rule"), F.lit(None).cast("long").alias("observed"),
                                    F.lit(False).alias("passed")))
    if not entries:
        return spark.createDataFrame([], "table string, check string, column string, rule string, "
                                         "observed bigint, passed boolean")
    out = one.select(F.explode(F.array(*entries)).alias("e")).select(
        F.lit(table).alias("table"), "e.*")
    # uniqueness needs a grouping per key; merge the duplicate rows into the
    # column's row (column rules) or add a composite-unique row
    extra = []
    for c, rules in cols:
        if rules.get("unique"):
            extra.append(duplicate_rows(df, [c]).select(
                F.lit(table).alias("table"), F.lit("column").alias("check"), F.lit(c).alias("column"),
                F.lit(_rule_text(rules)).alias("rule"), F.col("duplicate_rows").alias("observed"),
                (F.col("duplicate_rows") == 0).alias("passed")))
    for key in spec.get("unique", []):
        extra.append(duplicate_rows(df, list(key)).select(
            F.lit(table).alias("table"), F.lit("unique").alias("check"),
            F.lit(",".join(key)).alias("column"), F.lit("unique").alias("rule"),
            F.col("duplicate_rows").alias("observed"), (F.col("duplicate_rows") == 0).alias("passed")))
    for e in extra:
        out = out.unionByName(e)
    if extra:
        out = out.groupBy("table", "check", "column", "rule").agg(
            F.sum("observed").cast("long").alias("observed"), F.bool_and("passed").alias("passed"))
    return out.select(*RESULT_COLUMNS)


def quality_summary(results: DataFrame) -> DataFrame:
    """Totals per table (E10): success, total_checks, passed, failed, rows."""
    return results.groupBy("table").agg(
        F.bool_and("passed").alias("success"),
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.max(F.when(F.col("check") == "row_count", F.col("observed"))).alias("rows"))


# fixed values: the suffixes under which the dashboards read a table's checks
PUBLISHED = ["passed", "checks_total", "checks_passed", "checks_failed", "rows_total"]


def published_summary(results: DataFrame) -> DataFrame:
    """Totals per table under their published names; ``passed`` is 1 or 0."""
    return quality_summary(results).select(
        "table", F.col("success").cast("int").alias("passed"), F.col("total_checks").alias("checks_total"),
        F.col("passed").alias("checks_passed"), F.col("failed").alias("checks_failed"), F.col("rows").alias("rows_total"))


def validate_or_fail(df: DataFrame, table: str, spec: dict | None = None,
                     fail_on_error: bool = True) -> DataFrame:
    """Validate and raise ``QualityError`` on failure (I4). Collects only the
    per-check result rows (a handful), which are also the result."""
    res = validate(df, table, spec)
    rows = res.collect()
    res = df.sparkSession.createDataFrame(rows, res.schema)
    failed = [r for r in rows if not r["passed"]]
    if failed and fail_on_error:
        msg = ", ".join(f"{r['check']}({r['column'] or ''}): {r['observed']}" for r in failed)
        raise QualityError(f"data quality check FAILED for {table}: {msg}")
    return res


def column_stats(df: DataFrame, table: str, exclude=()) -> DataFrame:
    """Mean and sample standard deviation of every numeric column, NaN
    skipped (E7), one aggregate pass, unpivoted to ``(table, column, mean,
    std)``; values at 4 decimals, the precision the metrics are published at."""
    cols = numeric_columns(df, exclude)
    aggs = []
    for i, c in enumerate(cols):
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
    one = df.agg(*aggs)
    entries = [F.struct(F.lit(c).alias("column"), F.round(f"m{i}", 4).alias("mean"),
                        F.round(f"s{i}", 4).alias("std")) for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*entries)).alias("e")).select(
        F.lit(table).alias("table"), "e.*")


def column_stats_by(df: DataFrame, table: str, period: str, exclude=()) -> DataFrame:
    """``column_stats`` for every value of ``period``: column means over time
    (I19), ``(table, period, column, mean, std)``, one partial aggregate."""
    cols = numeric_columns(df.drop(period), exclude)
    values = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols]
    stats = df.groupBy(F.col(period).alias("period")).agg(
        *[F.avg(x).alias(f"m{i}") for i, x in enumerate(values)],
        *[F.stddev_samp(x).alias(f"s{i}") for i, x in enumerate(values)])
    entries = [F.struct(F.lit(c).alias("column"), F.round(f"m{i}", 6).alias("mean"), F.round(f"s{i}", 6).alias("std"))
               for i, c in enumerate(cols)]
    return stats.select(F.lit(table).alias("table"), "period", F.explode(F.array(*entries)).alias("e")) \
        .select("table", "period", "e.*")


def age_level(age_seconds: Column, levels=AGE_LEVELS) -> Column:
    """green / yellow / red from an age in seconds."""
    out = F.lit("green")
    for thr, name in levels:
        out = F.when(age_seconds >= F.lit(thr), F.lit(name)).otherwise(out)
    return out


def freshness(tables: dict[str, tuple[DataFrame, str]], as_of: str,
              sla: dict[str, int] | None = None) -> DataFrame:
    """Last update, age and SLA state per table.

    ``tables`` maps name → (frame, timestamp column). ``as_of`` replaces the
    wall clock so results are reproducible. Each table contributes one
    aggregate row; the union has one row per table.
    """
    sla = FRESHNESS_SLA_SECONDS if sla is None else sla
    now = F.to_timestamp_ntz(F.lit(as_of))
    parts = []
    for name, (df, ts) in tables.items():
        parts.append(df.agg(F.max(F.col(ts).cast("timestamp_ntz")).alias("last_update"))
                       .select(F.lit(name).alias("table"), "last_update"))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    # whole seconds, truncated (ages are non-negative)
    age = F.floor(seconds_between(F.col("last_update"), now)).cast("long")
    sla_map = F.create_map(*[x for k, v in sla.items() for x in (F.lit(k), F.lit(int(v)))])
    return (u.withColumn("age_seconds", age)
             .withColumn("sla_seconds", F.element_at(sla_map, F.col("table")).cast("long"))
             .withColumn("within_sla", F.col("age_seconds") <= F.col("sla_seconds"))
             .withColumn("level", age_level(F.col("age_seconds")))
             .withColumn("as_of", now))
