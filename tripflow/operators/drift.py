"""Two-sample drift between a reference and a current data set.

Every method starts from per-value counts on both sides (a partial+final
hash aggregate: the data is reduced to distinct values before any shuffle).

* KS statistic and Wasserstein-1 need running sums along the value order.
  They use ``prefix_sums``: value ranges from approximate quantiles, one
  task per range, range offsets from a tiny table — no unpartitioned
  window, so a feature with many distinct values is spread over tasks.
* Jensen–Shannon and chi-square only need the contingency table.

Scores carry the method, threshold and direction: p-value methods drift
when ``score < threshold``; distance methods when ``score >= threshold``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.operators.trips import DISTANCE_OPEN, PASSENGERS, ZONE_MAX, ZONE_MIN
from tripflow.plans.partitioning import prefix_sums, reliable_checkpoint

# The five drift features and the default thresholds per method.
DRIFT_FEATURES = ["trip_distance", "pickup_hour", "pickup_day_of_week",
                  "pickup_month", "passenger_count"]
THRESHOLDS = {"ks": 0.05, "chi2": 0.05, "wasserstein": 0.1, "js": 0.1}
P_VALUE_METHODS = {"ks", "chi2"}
DEFAULT_METHODS = {"trip_distance": "wasserstein", "pickup_hour": "wasserstein", "pickup_day_of_week": "wasserstein",
                   "pickup_month": "js", "passenger_count": "wasserstein"}
DATASET_DRIFT_SHARE = 0.5       # dataset drift when share > 0.5 (strict)
RETRAIN_THRESHOLD = 0.5         # retrain when share >= 0.5
MIN_CURRENT_ROWS = 100
PERIOD_BINS = {"trip_distance": 1.0}
MIN_STD = 0.001                 # floor of the divisor of the normed distance
COUNT_PARTITIONS = 200          # tasks that stored counts are added up in: so many are written without a sort buffer
SMALL_SAMPLE_ROWS = 1000        # automatic choice: small reference -> test statistics
CATEGORICAL_MAX_UNIQUE = 5      # automatic choice: few distinct values -> categorical


def drift_features(df: DataFrame, zone_filter: bool = True, keep=()) -> DataFrame:
    """The five drift features from silver rows, or derived from raw trips
    when they are missing (B10); same filters as the reference loader.
    ``keep`` passes extra columns (e.g. the ``date`` partition) through."""
    from tripflow.functions import weekday_monday0
    if "pickup_hour" not in df.columns:
        pu = F.col("tpep_pickup_datetime")
        cond = F.lit(True)
        if zone_filter:
            cond = F.col("PULocationID").between(ZONE_MIN, ZONE_MAX)
        df = df.where(cond).select(
            "trip_distance", F.hour(pu).alias("pickup_hour"),
            weekday_monday0(pu).alias("pickup_day_of_week"), F.month(pu).alias("pickup_month"),
            "passenger_count", *keep)
    return (df.select(*DRIFT_FEATURES, *keep)
              .where((F.col("trip_distance") > DISTANCE_OPEN[0]) & (F.col("trip_distance") < DISTANCE_OPEN[1])
                     & F.col("passenger_count").between(*PASSENGERS))
              .na.drop())


def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value) rows, nulls and NaN dropped."""
    s = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols
    ])).alias("s")).select("s.*")
    return s.where(F.col("value").isNotNull() & ~F.isnan("value"))


def drift_counts(df: DataFrame, cols: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, feature, value, n): how often each value occurs, per ``by`` (such as
    a day). Counts of parts add up: a table of them answers for any set of days
    without their rows (J6)."""
    rows = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])).alias("s"))
    return (rows.select(*by, "s.*").where(F.col("value").isNotNull() & ~F.isnan("value"))
            .groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("n")))


def value_counts(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, c_ref, c_cur) over the union of observed values."""
    return join_counts(drift_counts(ref, cols), drift_counts(cur, cols))


def join_counts(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """(feature, value, c_ref, c_cur) of two sets of counts (feature, value, n)."""
    r, c = ref.withColumnRenamed("n", "c_ref"), cur.withColumnRenamed("n", "c_cur")
    return (r.join(c, ["feature", "value"], "full")
             .select("feature", "value", F.coalesce("c_ref", F.lit(0)).alias("c_ref"),
                     F.coalesce("c_cur", F.lit(0)).alias("c_cur")))


def add_counts(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """``join_counts`` of stored counts, where a value may have several rows: both
    sides are dealt out once to ``COUNT_PARTITIONS`` tasks and added up there, so
    that a task holds its share of the values and not one map a side and step."""
    none = F.lit(0).cast("long")
    rows = (ref.select("feature", "value", F.col("n").alias("c_ref"), none.alias("c_cur"))
            .unionByName(cur.select("feature", "value", none.alias("c_ref"), F.col("n").alias("c_cur"))))
    return (rows.repartition(COUNT_PARTITIONS, "feature", "value").groupBy("feature", "value")
            .agg(F.sum("c_ref").alias("c_ref"), F.sum("c_cur").alias("c_cur")))


def _totals(vc: DataFrame) -> DataFrame:
    return vc.groupBy("feature").agg(F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"),
                                     F.count(F.lit(1)).alias("n_values"))


def _ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample KS p-value, Kolmogorov series with 100 terms."""
    lam = d * F.sqrt(n * m / (n + m))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
                         lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1)
                         * F.exp(F.lit(-2.0) * k * k * lam * lam))
    p = F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * series)))
    return p


def cdf_scores(ref: DataFrame, cur: DataFrame, cols: list[str], ranges: int = 256) -> DataFrame:
    """Per feature: KS statistic D, its p-value, Wasserstein-1 distance and
    the normed distance (divided by the reference's population std, at
    least ``MIN_STD``, so that a constant reference still gives a score).

    The value-count table is used four times (range cuts, per-feature
    totals, variance, running sums), so it is checkpointed once: it is
    already reduced to one row per distinct value and feature.
    """
    return cdf_scores_of(reliable_checkpoint(value_counts(ref, cur, cols)), ranges)


def cdf_scores_of(vc: DataFrame, ranges: int = 256) -> DataFrame:
    """``cdf_scores`` of checkpointed value counts (feature, value, c_ref, c_cur)."""
    # per feature: sizes and reference mean, then the reference variance
    # (two passes over the counts, numerically safe); one row per feature
    stats = vc.groupBy("feature").agg(
        F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"),
        F.try_divide(F.sum(F.col("c_ref") * F.col("value")), F.sum("c_ref")).alias("_mean"))
    var = (vc.join(F.broadcast(stats), "feature").groupBy("feature")
             .agg(F.try_divide(F.sum(F.col("c_ref") * F.pow(F.col("value") - F.col("_mean"), 2)),
                               F.first("n_ref")).alias("_var")))
    stats = stats.join(var, "feature")
    ps = prefix_sums(vc, ["feature"], "value", ["c_ref", "c_cur"], ranges=ranges, with_next=True)
    ps = ps.join(F.broadcast(stats), "feature")
    fr = F.try_divide(F.col("cum_c_ref"), F.col("n_ref"))      # null when a side is empty
    fc = F.try_divide(F.col("cum_c_cur"), F.col("n_cur"))
    gap = F.abs(fr - fc)
    step = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    out = ps.groupBy("feature").agg(
        F.max(gap).alias("ks_stat"), F.sum(gap * step).alias("wasserstein"),
        F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"), F.first("_var").alias("_var"))
    return out.select(
        "feature", "n_ref", "n_cur", "ks_stat",
        _ks_pvalue(F.col("ks_stat"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double")).alias("ks_pvalue"),
        "wasserstein",
        (F.col("wasserstein") / F.greatest(F.sqrt("_var"), F.lit(MIN_STD))).alias("wasserstein_normed"))


def category_scores(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """Per feature: Jensen–Shannon distance (natural log; zero cells
    skipped) and the chi-square statistic of current counts against
    reference proportions, with degrees of freedom over the union of values.
    A value that the reference lacks makes the statistic infinite."""
    return category_scores_of(value_counts(ref, cur, cols))


def category_scores_of(vc: DataFrame) -> DataFrame:
    """``category_scores`` of value counts (feature, value, c_ref, c_cur)."""
    tot = _totals(vc)
    x = vc.join(F.broadcast(tot), "feature")
    p = F.try_divide(F.col("c_ref"), F.col("n_ref"))
    q = F.try_divide(F.col("c_cur"), F.col("n_cur"))
    m = (p + q) / 2
    term = (F.when(p > 0, p * F.log(p / m)).otherwise(0.0)
            + F.when(q > 0, q * F.log(q / m)).otherwise(0.0))
    e = p * F.col("n_cur")
    chi = F.when(e > 0, F.pow(F.col("c_cur") - e, 2) / e).when(F.col("c_cur") > 0, F.lit(float("inf")))
    return x.groupBy("feature").agg(
        F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"),
        F.sqrt(F.greatest(F.lit(0.0), 0.5 * F.sum(term))).alias("js"),
        F.sum(chi).alias("chi2_stat"),
        (F.count(F.lit(1)) - 1).alias("chi2_dof"))


GAMMA_STEPS = 1_000     # terms of the series and of the continued fraction


def _log_gamma(a: Column) -> Column:
    """ln Γ(a), a > 0: Stirling's series at a + 8, stepped down by Γ(a + 1) = a Γ(a)."""
    z = a + 8
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3))) + 1 / (1260 * F.pow(z, F.lit(5))) - 1 / (1680 * F.pow(z, F.lit(7)))
    up = (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series
    return up - sum((F.log(a + k) for k in range(1, 8)), F.log(a))


def chi2_pvalue(stat: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution: the regularised incomplete
    gamma function Q(dof / 2, stat / 2), as a column expression. Below a + 1 from
    the power series of P, else from the continued fraction of Q (both summed
    within the expression). An infinite statistic has p-value 0; no degree of
    freedom, or no difference, has 1."""
    a, x = dof / F.lit(2.0), stat / F.lit(2.0)
    double = lambda v: F.lit(float(v))
    steps = F.sequence(F.lit(1), F.lit(GAMMA_STEPS))
    front = F.exp(a * F.log(x) - x - _log_gamma(a))
    # P: sum of x^k / (a (a + 1) ... (a + k))
    series = F.aggregate(steps, F.struct((1 / a).alias("term"), (1 / a).alias("sum")),
                         lambda s, k: F.struct((s["term"] * x / (a + k)).alias("term"),
                                               (s["sum"] + s["term"] * x / (a + k)).alias("sum")), lambda s: s["sum"])
    # Q: the fraction's convergents, each from the one before (modified Lentz)
    def convergent(s, k):
        over, b = -k * (k - a), x + 1 - a + 2 * k
        d = 1 / (over * s["d"] + b)
        c = b + over / s["c"]
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))
    start = 1 / (x + 1 - a)
    fraction = F.aggregate(steps, F.struct(double(1e300).alias("c"), start.alias("d"), start.alias("h")), convergent,
                           lambda s: s["h"])
    tail = F.when(x < a + 1, 1 - front * series).otherwise(front * fraction)
    bounded = F.greatest(double(0), F.least(double(1), tail))
    return (F.when(stat.isNull() | dof.isNull(), F.lit(None).cast("double")).when((dof <= 0) | (stat <= 0), double(1))
            .when(stat == double("inf"), double(0)).otherwise(bounded))


def choose_methods(ref: DataFrame, cols: list[str]) -> dict[str, str]:
    """Automatic method per feature from the reference size and distinct
    counts (one small aggregate): numeric → KS for small references, else
    normed Wasserstein; few distinct values → chi-square for small
    references, else Jensen–Shannon."""
    row = ref.agg(F.count(F.lit(1)).alias("n"),
                  *[F.count_distinct(c).alias(f"u{i}") for i, c in enumerate(cols)]).collect()[0]
    small = row["n"] <= SMALL_SAMPLE_ROWS
    out = {}
    for i, c in enumerate(cols):
        cat = row[f"u{i}"] <= CATEGORICAL_MAX_UNIQUE
        out[c] = ("chi2" if small else "js") if cat else ("ks" if small else "wasserstein")
    return out


def drift_report(ref: DataFrame, cur: DataFrame, cols: list[str] | None = None,
                 method: str | dict = DEFAULT_METHODS, thresholds: dict | None = None) -> DataFrame:
    """Per feature ``(feature, method, score, threshold, drifted)``.

    ``method``: one of ks / wasserstein / js / chi2 for all columns, a dict
    per column (others: wasserstein), or ``auto``, which lets the size of the
    reference choose. Returns an empty frame when the current set has
    fewer than 100 rows (C10), checked with ``limit(100).count()``.
    """
    cols = cols or DRIFT_FEATURES
    if cur.limit(MIN_CURRENT_ROWS).count() < MIN_CURRENT_ROWS:
        return _no_report(ref.sparkSession)
    methods = (choose_methods(ref, cols) if method == "auto"
               else {c: method.get(c, "wasserstein") for c in cols} if isinstance(method, dict)
               else {c: method for c in cols})
    cdf_cols = [c for c in cols if methods[c] in ("ks", "wasserstein")]
    cat_cols = [c for c in cols if methods[c] in ("js", "chi2")]
    return _report(cdf_scores(ref, cur, cdf_cols) if cdf_cols else None,
                   category_scores(ref, cur, cat_cols) if cat_cols else None, methods, thresholds)


def report_from_counts(ref: DataFrame, cur: DataFrame, cols: list[str] | None = None,
                       methods: dict | str = DEFAULT_METHODS, thresholds: dict | None = None) -> DataFrame:
    """``drift_report`` of stored counts (feature, value, n; several rows a value
    are added up): it reads counts, not trips (J6). Methods are explicit."""
    cols = cols or DRIFT_FEATURES
    methods = {c: methods if isinstance(methods, str) else methods.get(c, "wasserstein") for c in cols}
    both = reliable_checkpoint(add_counts(ref, cur))
    # every row of the features counts once for each
    rows = both.groupBy("feature").agg(F.sum("c_cur").alias("n")).agg(F.max("n")).first()[0] or 0
    if rows < MIN_CURRENT_ROWS:
        return _no_report(ref.sparkSession)
    pick = lambda names: both.where(F.col("feature").isin(*names))
    cdf_cols = [c for c in cols if methods[c] in ("ks", "wasserstein")]
    cat_cols = [c for c in cols if methods[c] in ("js", "chi2")]
    return _report(cdf_scores_of(pick(cdf_cols)) if cdf_cols else None,
                   category_scores_of(pick(cat_cols)) if cat_cols else None, methods, thresholds)


def _no_report(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "feature string, method string, score double, threshold double, drifted boolean")


def _report(cdf: DataFrame | None, categories: DataFrame | None, methods: dict, thresholds: dict | None) -> DataFrame:
    """The report's rows from the scores of the two kinds of methods."""
    th = {**THRESHOLDS, **(thresholds or {})}
    method = F.element_at(F.create_map(*[x for c, m in methods.items() for x in (F.lit(c), F.lit(m))]), F.col("feature"))
    parts = []
    if cdf is not None:
        parts.append(cdf.select("feature", method.alias("method"),
                                F.when(method == "ks", F.col("ks_pvalue")).otherwise(F.col("wasserstein_normed")).alias("score")))
    if categories is not None:
        score = F.col("js")
        if "chi2" in methods.values():
            score = F.when(method == "js", score).otherwise(chi2_pvalue(F.col("chi2_stat"), F.col("chi2_dof")))
        parts.append(categories.select("feature", method.alias("method"), score.alias("score")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    thr = F.element_at(F.create_map(*[x for k, v in th.items() for x in (F.lit(k), F.lit(float(v)))]),
                       F.col("method"))
    is_p = F.col("method").isin(*P_VALUE_METHODS)
    return out.select("feature", "method", F.round("score", 6).alias("score"), thr.alias("threshold"),
                      F.when(is_p, F.col("score") < thr).otherwise(F.col("score") >= thr).alias("drifted"))


def drift_summary(report: DataFrame) -> DataFrame:
    """Dataset-level drift (E9): columns, drifted columns, share, dataset
    flag (share > 0.5) and retrain flag (share >= 0.5). Without a report (too
    few rows), or with a column that has no score, share and flags are null:
    unknown, not "no drift"."""
    unknown = F.count_if(F.col("drifted").isNull()) > 0
    share = F.when(~unknown, F.avg(F.col("drifted").cast("double")))
    return report.agg(
        F.count(F.lit(1)).alias("number_of_columns"),
        F.count_if("drifted").alias("number_of_drifted_columns"),
        F.round(share, 6).alias("drift_share"),
    ).select("*", (F.col("drift_share") > DATASET_DRIFT_SHARE).alias("dataset_drift"),
             (F.col("drift_share") >= RETRAIN_THRESHOLD).alias("retrain"))


def drift_by_period(ref: DataFrame, cur: DataFrame, period_col: str, cols: list[str],
                    threshold: float = THRESHOLDS["js"], bins: dict | None = None) -> DataFrame:
    """Jensen–Shannon drift of every period of the current data in one job:
    ``(period, feature, score, drifted)``. ``bins`` gives the bin width of
    continuous features (default: whole miles of ``trip_distance``), others
    are compared value by value.

    Reference proportions are one row per (feature, value). The join with
    the per-period counts carries no broadcast hint: AQE measures the
    reference side after its aggregation and broadcasts it only when it is
    below ``spark.sql.adaptive.autoBroadcastJoinThreshold``, otherwise the
    join stays a sort-merge join. Reference values missing from a period add
    ``ln 2 · p`` each, summed as ``ln 2 · (1 - Σ p over present values)``,
    so no (period × reference value) product is built.
    """
    bins = PERIOD_BINS if bins is None else bins
    for c, width in bins.items():
        if c in cols:
            ref, cur = (d.withColumn(c, F.floor(F.col(c) / width) * F.lit(float(width))) for d in (ref, cur))
    r = _long(ref, cols).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c_ref"))
    wf = Window.partitionBy("feature")        # one partition per feature of the counted values
    r = r.select("feature", "value", (F.col("c_ref") / F.sum("c_ref").over(wf)).alias("p"))
    c = (cur.select(F.col(period_col).alias("period"), F.explode(F.array(*[
            F.struct(F.lit(x).alias("feature"), F.col(x).cast("double").alias("value")) for x in cols
        ])).alias("s")).select("period", "s.*")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("period", "feature", "value").agg(F.count(F.lit(1)).alias("c_cur")))
    w = Window.partitionBy("period", "feature")
    c = c.withColumn("q", F.col("c_cur") / F.sum("c_cur").over(w))
    j = c.join(r, ["feature", "value"], "left").fillna(0.0, subset=["p"])
    m = (F.col("p") + F.col("q")) / 2
    term = (F.when(F.col("p") > 0, F.col("p") * F.log(F.col("p") / m)).otherwise(0.0)
            + F.col("q") * F.log(F.col("q") / m))
    s = j.groupBy("period", "feature").agg(F.sum(term).alias("t"), F.sum("p").alias("p_seen"))
    js = F.sqrt(F.greatest(F.lit(0.0), 0.5 * (F.col("t") + F.lit(math.log(2.0))
                                             * F.greatest(F.lit(0.0), 1 - F.col("p_seen")))))
    return s.select("period", "feature", F.round(js, 6).alias("score"),
                    (js >= threshold).alias("drifted"))


def drift_history(by_period: DataFrame) -> DataFrame:
    """Per period: drift share and flags, the series the retrain rule reads."""
    return by_period.groupBy("period").agg(
        F.round(F.avg(F.col("drifted").cast("double")), 6).alias("drift_share"),
        F.count_if("drifted").alias("number_of_drifted_columns"),
        F.count(F.lit(1)).alias("number_of_columns"))


def retrain_decisions(history: DataFrame, ts_col: str = "period", share_col: str = "drift_share",
                      threshold: float = RETRAIN_THRESHOLD, mode: str = "level",
                      partition_cols: tuple = (), poll_interval_s: int | None = None) -> DataFrame:
    """Retrain requests over a drift history.

    ``mode='level'`` requests at every evaluation with share >= threshold
    (the reference sensor's behaviour); ``mode='edge'`` only when the share
    crosses the threshold upward. ``run_number`` is the running count of
    requests (the sensor's cursor). With ``poll_interval_s`` (the sensor
    polls at most every 300 s) level mode counts one request per poll
    while the share stays high: ``ceil(gap to the next drift run / poll
    interval)`` for each run, without generating a row per poll. The
    history holds one row per drift run per monitor, so its windows are
    small.
    """
    if mode not in ("level", "edge"):
        raise ValueError("mode must be 'level' or 'edge'")
    w = Window.partitionBy(*partition_cols).orderBy(ts_col)
    above = F.col(share_col) >= F.lit(threshold)
    prev_above = F.lag(above).over(w)
    fire = above if mode == "level" else (above & F.coalesce(~prev_above, F.lit(True)))
    out = history.withColumn("retrain", fire)
    n = F.col("retrain").cast("long")
    if poll_interval_s is not None and mode == "level":
        t = F.col(ts_col).cast("timestamp_ntz")
        from tripflow.functions import seconds_between
        gap = seconds_between(t, F.lead(t).over(w))
        polls = F.greatest(F.lit(1), F.ceil(gap / F.lit(int(poll_interval_s))))
        n = F.when(F.col("retrain"), F.coalesce(polls, F.lit(1))).otherwise(F.lit(0)).cast("long")
        out = out.withColumn("requests", n)
        n = F.col("requests")
    return out.withColumn("run_number", F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, 0)))


# --- drift report documents (B16) ---------------------------------------------

def to_report_json(by_period: DataFrame, method: str = "js") -> DataFrame:
    """One JSON report per period in the shape of the drift library's
    output: a ``DriftedColumnsCount`` metric (count, share) and one
    ``ValueDrift`` metric per column. Each report gathers the handful of
    per-feature rows of its own period."""
    thr = THRESHOLDS[method]
    per_feature = F.struct(
        F.struct(F.lit("ValueDrift").alias("type"), F.col("feature").alias("column"),
                 F.lit(thr).alias("threshold"), F.lit(method).alias("method")).alias("config"),
        F.col("score").alias("value"))
    g = by_period.groupBy("period").agg(
        F.sort_array(F.collect_list(per_feature)).alias("cols"),
        F.count_if("drifted").alias("n"), F.count(F.lit(1)).alias("k"))
    count_metric = F.struct(
        F.struct(F.lit("DriftedColumnsCount").alias("type")).alias("config"),
        F.struct(F.col("n").alias("count"), F.round(F.col("n") / F.col("k"), 6).alias("share")).alias("value"))
    return g.select("period", F.concat(
        F.lit('{"metrics":['), F.to_json(count_metric), F.lit(","),
        F.regexp_replace(F.to_json(F.col("cols")), r"^\[|\]$", ""), F.lit("]}")).alias("report"))


def parse_drift_report(df: DataFrame, json_col: str = "report", keep=("period",)) -> DataFrame:
    """Summary of each drift report document (B16), one row a document whatever
    it holds: ``status`` (``ok``; ``no_metrics`` where it has no list of metrics,
    or an empty one; ``unparsable``), drifted-column count and share from the
    counter metric, number of per-column metrics and how many are flagged, and
    the dataset flag (share > 0.5). What a document doesn't say is null, not 0.

    Documents are read as VARIANT, so metrics of any shape stand side by side;
    numbers may be given as text. Per-column flags follow the method's direction
    (p-value below threshold, or distance at/above it); without a method the
    score is read as a p-value, without a threshold as against 0.05, as the
    reference does. A column without a score is not flagged."""
    get = lambda v, path, kind: F.try_variant_get(v, path, kind)
    doc = F.try_parse_json(F.col(json_col).cast("string"))
    docs = df.select(*keep, doc.alias("_doc"), get(doc, "$.metrics", "array<variant>").alias("_metrics"))
    is_a = lambda m, name: F.coalesce(F.contains(get(m, "$.config.type", "string"), F.lit(name)), F.lit(False))

    def flagged(m):
        score, limit = get(m, "$.value", "double"), F.coalesce(get(m, "$.config.threshold", "double"), F.lit(0.05))
        distance = F.coalesce(get(m, "$.config.method", "string").isin("wasserstein", "js"), F.lit(False))
        return F.coalesce(F.when(distance, score >= limit).otherwise(score < limit), F.lit(False))
    metrics = F.coalesce("_metrics", F.array().cast("array<variant>"))
    columns = F.filter(metrics, lambda m: is_a(m, "ValueDrift"))
    counter = F.try_element_at(F.filter(metrics, lambda m: is_a(m, "DriftedColumnsCount")), F.lit(1))
    share = get(counter, "$.value.share", "double")
    status = (F.when(F.col("_doc").isNull(), "unparsable").when(F.size(metrics) == 0, "no_metrics").otherwise("ok"))
    return docs.select(
        *keep, get(counter, "$.value.count", "bigint").alias("number_of_drifted_columns"), share.alias("drift_share"),
        F.when(status == "ok", F.size(columns)).cast("long").alias("number_of_columns"),
        F.when(status == "ok", F.size(F.filter(columns, flagged))).cast("long").alias("flagged_columns"),
        (share > DATASET_DRIFT_SHARE).alias("dataset_drift"), status.alias("status"))
