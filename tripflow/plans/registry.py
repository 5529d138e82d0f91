"""Registered queries: one per operator of SURVEY §2 that the driver checks.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables (through the fixtures in ``tripflow.sources``). The
matching DuckDB SQL lives in ``tripflow.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators import features as feat
from tripflow.operators import sampling as smp
from tripflow.operators import trips as trp
from tripflow.sources.fixtures import trips_from_events, trips_from_lineitem

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ---- shared inputs --------------------------------------------------------

def raw(spark, sf):
    return trips_from_lineitem(spark, sf)


def streaming(spark, sf):
    return trips_from_events(spark, sf)


def silver(spark, sf):
    """clean → split; the silver trip table."""
    return smp.hash_split(trp.clean_trips(raw(spark, sf)), "trip_key")


# ---- trips, zone stats, demand -------------------------------------------

@query
def zone_stats(spark, sf):
    return feat.zone_stats(raw(spark, sf))


@query
def zone_stats_global_ts(spark, sf):
    return feat.zone_stats(raw(spark, sf), ts_mode="global")


@query
def clean_trips(spark, sf):
    return trp.clean_trips(raw(spark, sf))


@query
def clean_trips_combined(spark, sf):
    src = trp.load_source(raw(spark, sf), streaming(spark, sf), "combined")
    return trp.clean_trips(src)


@query
def clean_trips_bronze_columns(spark, sf):
    """The combined source with the catalogue's columns only: no key on either
    side, none needed."""
    from tripflow.sources.fixtures import BRONZE_COLUMNS
    src = trp.load_source(raw(spark, sf).select(*BRONZE_COLUMNS),
                          streaming(spark, sf).select(*BRONZE_COLUMNS, "date"), "combined")
    return trp.clean_trips(src).drop("trip_key")


@query
def clean_trips_no_passengers(spark, sf):
    return trp.clean_trips(raw(spark, sf).drop("passenger_count"))


@query
def outlier_report(spark, sf):
    return trp.outlier_report(raw(spark, sf))


@query
def demand(spark, sf):
    return feat.demand(raw(spark, sf))


@query
def demand_merged(spark, sf):
    return feat.merge_demand([feat.demand(raw(spark, sf)), feat.demand(streaming(spark, sf))])


@query
def demand_merged_by_date(spark, sf):
    return feat.merge_demand([feat.demand(raw(spark, sf), keep_date=True),
                              feat.demand(streaming(spark, sf), keep_date=True)], keep_date=True)


@query
def hour_slice(spark, sf):
    return smp.hour_slice(streaming(spark, sf), "2024-01-15 10:00:00", partition_col="date")


@query
def enrich_trips(spark, sf):
    return feat.enrich_trips(silver(spark, sf), feat.zone_stats(raw(spark, sf)))


@query
def enrich_demand(spark, sf):
    return feat.enrich_demand(feat.demand(raw(spark, sf)), feat.zone_stats(raw(spark, sf)))


def _split_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"),
                                   F.sum("pickup_zone_id").alias("zone_sum"),
                                   F.sum("pickup_hour").alias("hour_sum"))


@query
def hash_split_counts(spark, sf):
    return _split_summary(silver(spark, sf))


@query
def exact_split(spark, sf):
    return _split_summary(smp.exact_split(trp.clean_trips(raw(spark, sf)), "trip_key"))


@query
def sample_rows(spark, sf):
    return smp.sample_rows(trp.clean_trips(raw(spark, sf)), 1000, "trip_key")


@query
def sample_rows_before_filter(spark, sf):
    t = trp.clean_trips(raw(spark, sf))
    return smp.sample_rows(t, 1000, "trip_key", where=F.col("pickup_hour") < 12,
                           when="before_filter")


# ---- data quality ------------------------------------------------------------

from tripflow.operators import drift as drf  # noqa: E402
from tripflow.operators import quality as qa  # noqa: E402


def silver_demand(spark, sf):
    return _demand_split(raw(spark, sf))


def _demand_split(bronze):
    d = feat.demand(bronze, keep_date=True)
    key = F.concat_ws("|", F.col("zone_id").cast("string"), F.col("pickup_date").cast("string"),
                      F.col("pickup_hour").cast("string"))
    return smp.hash_split(d.withColumn("demand_key", key), "demand_key").drop("pickup_date", "demand_key")


def _quality_inputs(spark, sf):
    return {
        "bronze_raw": raw(spark, sf),
        "bronze_streaming": streaming(spark, sf),
        "silver_trips": silver(spark, sf),
        "silver_demand": silver_demand(spark, sf),
        "gold_zone_stats": feat.zone_stats(raw(spark, sf)),
    }


def _quality_query(table):
    def q(spark, sf):
        return qa.validate(_quality_inputs(spark, sf)[table], table)
    q.__name__ = f"quality_{table}"
    return q


for _t in qa.RULES:
    QUERIES[f"quality_{_t}"] = _quality_query(_t)


@query
def quality_summary(spark, sf):
    res = None
    for t, df in _quality_inputs(spark, sf).items():
        r = qa.validate(df, t)
        res = r if res is None else res.unionByName(r)
    return qa.quality_summary(res)


@query
def duplicate_count(spark, sf):
    return qa.duplicate_rows(raw(spark, sf), ["PULocationID", "DOLocationID", "tpep_pickup_datetime"])


@query
def column_stats(spark, sf):
    return qa.column_stats(silver(spark, sf), "silver_trips")


@query
def column_means_by_day(spark, sf):
    """Column means over time: mean and standard deviation per day."""
    return qa.column_stats_by(streaming(spark, sf).select("date", "trip_distance", "passenger_count", "total_amount"),
                              "bronze_streaming", "date")


@query
def freshness(spark, sf):
    return qa.freshness({
        "bronze_raw": (raw(spark, sf), "tpep_pickup_datetime"),
        "bronze_streaming": (streaming(spark, sf), "tpep_pickup_datetime"),
        "gold_zone_stats": (feat.zone_stats(raw(spark, sf)), "event_timestamp"),
    }, as_of="2024-02-01 00:00:00")


# ---- drift -------------------------------------------------------------------

DISCRETE = ["pickup_hour", "pickup_day_of_week", "pickup_month", "passenger_count"]


def drift_ref(spark, sf):
    return drf.drift_features(silver(spark, sf).where(F.col("split") == "train"))


def drift_cur(spark, sf):
    return drf.drift_features(streaming(spark, sf))


@query
def drift_ks(spark, sf):
    s = drf.cdf_scores(drift_ref(spark, sf), drift_cur(spark, sf), drf.DRIFT_FEATURES)
    return s.select("feature", "n_ref", "n_cur", F.round("ks_stat", 6).alias("ks_stat"),
                    F.round("ks_pvalue", 6).alias("ks_pvalue"))


@query
def drift_wasserstein(spark, sf):
    s = drf.cdf_scores(drift_ref(spark, sf), drift_cur(spark, sf), drf.DRIFT_FEATURES)
    return s.select("feature", F.round("wasserstein", 6).alias("wasserstein"),
                    F.round("wasserstein_normed", 6).alias("wasserstein_normed"))


@query
def drift_js(spark, sf):
    s = drf.category_scores(drift_ref(spark, sf), drift_cur(spark, sf), DISCRETE)
    return s.select("feature", "n_ref", "n_cur", F.round("js", 6).alias("js"))


@query
def drift_chi2_stat(spark, sf):
    s = drf.category_scores(drift_ref(spark, sf), drift_cur(spark, sf), DISCRETE)
    return s.select("feature", F.round("chi2_stat", 4).alias("chi2_stat"), "chi2_dof")


@query
def drift_summary(spark, sf):
    rep = drf.drift_report(drift_ref(spark, sf), drift_cur(spark, sf), drf.DRIFT_FEATURES,
                           method="wasserstein")
    return drf.drift_summary(rep)


def _daily_history(spark, sf):
    cur = drf.drift_features(streaming(spark, sf), keep=("date",))
    return drf.drift_by_period(drift_ref(spark, sf), cur, "date", drf.DRIFT_FEATURES)


@query
def drift_by_period(spark, sf):
    return _daily_history(spark, sf)


@query
def retrain_decisions(spark, sf):
    return drf.retrain_decisions(drf.drift_history(_daily_history(spark, sf)), mode="level")


@query
def retrain_decisions_edge(spark, sf):
    return drf.retrain_decisions(drf.drift_history(_daily_history(spark, sf)), mode="edge")


# ---- metric time series --------------------------------------------------------

from tripflow.operators import metrics as mt  # noqa: E402
from tripflow.sources.fixtures import metrics_from_events  # noqa: E402

AS_OF = "2024-01-20 12:00:00"


def samples(spark, sf):
    return mt.normalize(metrics_from_events(spark, sf))


@query
def metrics_instant(spark, sf):
    return mt.instant(samples(spark, sf), AS_OF, lookback_s=None).select("name", "labels", "ts", "value")


@query
def metrics_instant_lookback(spark, sf):
    return mt.instant(samples(spark, sf), AS_OF, lookback_s=6 * 3600).select("name", "labels", "ts", "value")


@query
def metrics_range(spark, sf):
    return mt.range_query(samples(spark, sf), "2024-01-10 00:00:00", "2024-01-12 00:00:00", 3600) \
        .select("name", "labels", "step_ts", "value")


@query
def metrics_match(spark, sf):
    m = mt.match_labels(samples(spark, sf), [("__name__", "=~", "view|click"), ("u", "!=", "3")])
    return m.select("name", "labels", "ts", "value")


@query
def metrics_rate(spark, sf):
    return mt.rate(samples(spark, sf), window_s=3600).select("name", "labels", "ts", F.col("value").alias("rate"))


@query
def metrics_irate(spark, sf):
    return mt.irate(samples(spark, sf)).select("name", "labels", "ts", F.col("value").alias("irate"))


@query
def metrics_changes(spark, sf):
    return mt.changes(samples(spark, sf), window_s=1800).select(
        "name", "labels", "ts", F.col("value").cast("long").alias("changes"))


def _by_u(v):
    return v.select(F.element_at("label_map", "u").alias("u"), "value")


@query
def metrics_changed(spark, sf):
    """changes(x[30m]) > 0"""
    return mt.compare(mt.changes(samples(spark, sf), window_s=1800), ">", 0).select("name", "labels", "ts", "value")


@query
def metrics_sum_rate(spark, sf):
    """sum by (u) (rate(x[1h])) at an evaluation time"""
    rate = mt.instant(mt.rate(samples(spark, sf), window_s=3600), AS_OF, lookback_s=None)
    return _by_u(mt.aggregate_by(rate, ["u"], "sum")).withColumn("value", F.round("value", 6))


@query
def metrics_one_minus_avg_rate(spark, sf):
    """1 - avg(rate(x[10d])): a window longer than a bucket, no labels left"""
    rate = mt.instant(mt.rate(samples(spark, sf), window_s=864_000), AS_OF, lookback_s=None)
    return mt.scalar_op(mt.aggregate_by(rate, [], "avg"), "-", 1.0, scalar_left=True) \
        .select("name", "labels", F.round("value", 6).alias("value"))


@query
def metrics_ratio_of_sums(spark, sf):
    """sum by (u) (view) / ignoring (none) count by (u) (all)"""
    v = mt.instant(samples(spark, sf), AS_OF, lookback_s=None)
    views = mt.aggregate_by(mt.match_labels(v, [("__name__", "=", "view"), ("u", "!~", "[89]")]), ["u"], "sum")
    return _by_u(mt.metric_binary_op(views, mt.aggregate_by(v, ["u"], "count"), "/", ignoring=[]))


@query
def metrics_sum_by(spark, sf):
    return _by_u(mt.aggregate_by(mt.instant(samples(spark, sf), AS_OF, lookback_s=None), ["u"], "sum"))


@query
def metrics_binary_op(spark, sf):
    v = mt.instant(samples(spark, sf), AS_OF, lookback_s=None)
    left = v.where(F.col("name") == "view")
    right = v.where(F.col("name") == "click")
    return mt.metric_binary_op(left, right, "/", on=["u"], clamp_min_right=1.0).select("name", "labels", "value")


# range queries: functions evaluated at a dashboard's steps, matched and aggregated time by time

DAY_STEPS = mt.Steps("2024-01-15 00:00:00", "2024-01-16 00:00:00", 240)
WEEK_STEPS = mt.Steps("2024-01-13 00:00:00", "2024-01-20 00:00:00", 3600)
RATE_WINDOW, STALE = 6 * 3600, 2 * 86_400


def _points(v):
    return v.select("name", "labels", "ts", "value")


@query
def metrics_instant_steps(spark, sf):
    return _points(mt.instant(samples(spark, sf), lookback_s=3 * 3600, steps=DAY_STEPS))


@query
def metrics_rate_steps(spark, sf):
    """rate(x[6h]) every 240 s of a day"""
    return _points(mt.rate(samples(spark, sf), RATE_WINDOW, steps=DAY_STEPS, stale_s=STALE))


@query
def metrics_irate_steps(spark, sf):
    """irate(x[12h]) every hour of a week"""
    return _points(mt.irate(samples(spark, sf), steps=WEEK_STEPS, window_s=12 * 3600))


@query
def metrics_changes_steps(spark, sf):
    """changes(x[12h]) > 1 every hour of a week"""
    return _points(mt.compare(mt.changes(samples(spark, sf), 12 * 3600, steps=WEEK_STEPS), ">", 1))


@query
def metrics_sum_rate_steps(spark, sf):
    """sum by (u) (rate(x[6h])) every 240 s of a day"""
    rate = mt.rate(samples(spark, sf), RATE_WINDOW, steps=DAY_STEPS, stale_s=STALE)
    return _points(mt.aggregate_by(rate, ["u"], "sum")).withColumn("value", F.round("value", 6))


@query
def metrics_avg_irate_steps(spark, sf):
    """avg(irate(x[12h])) and its number of series, every hour of a week"""
    v = mt.irate(samples(spark, sf), steps=WEEK_STEPS, window_s=12 * 3600)
    mean, n = mt.aggregate_by(v, [], "avg"), mt.aggregate_by(v, [], "count")
    return mean.select("ts", F.round("value", 8).alias("mean")).join(n.select("ts", F.col("value").alias("series")), "ts")


@query
def metrics_rate_ratio_steps(spark, sf):
    """sum by (u) (rate(view[6h])) / on (u) sum by (u) (rate(x[6h])), every 240 s of a day"""
    rate = mt.rate(samples(spark, sf), RATE_WINDOW, steps=DAY_STEPS, stale_s=STALE)
    views = mt.aggregate_by(mt.match_labels(rate, [("__name__", "=", "view")]), ["u"], "sum")
    return _points(mt.metric_binary_op(views, mt.aggregate_by(rate, ["u"], "sum"), "/", on=["u"]))


@query
def metrics_group_left_steps(spark, sf):
    """max by (u) (x) * on (u) group_left (region) region_info, every hour of a week"""
    from tripflow.sources.fixtures import region_info
    v = mt.aggregate_by(mt.instant(samples(spark, sf), lookback_s=86_400, steps=WEEK_STEPS), ["u"], "max")
    info = mt.instant(mt.normalize(region_info(spark, sf)), lookback_s=90 * 86_400, steps=WEEK_STEPS)
    return _points(mt.metric_binary_op(v, info, "*", on=["u"], group_left=["region"]))


@query
def metrics_scalar_steps(spark, sf):
    """100 * count by (u) (x) / scalar(count(x)), every hour of a week"""
    v = mt.instant(samples(spark, sf), lookback_s=6 * 3600, steps=WEEK_STEPS)
    every = mt.scalar_steps(mt.aggregate_by(v, [], "count"))
    return _points(mt.by_scalar(mt.scalar_op(mt.aggregate_by(v, ["u"], "count"), "*", 100.0), "/", every))


DRIFT_LEVELS = [(0.3, "yellow"), (0.5, "red")]     # fixed values: drift share levels


@query
def status_level(spark, sf):
    h = drf.drift_history(_daily_history(spark, sf))
    return h.select("period", "drift_share", mt.status_level(F.col("drift_share"), DRIFT_LEVELS).alias("level"))


@query
def state_timeline(spark, sf):
    m = samples(spark, sf).withColumn(
        "state", mt.status_level(F.col("value"), [(30.0, "yellow"), (60.0, "red")]))
    return mt.state_timeline(m, "state")


@query
def exposition(spark, sf):
    res = None
    for t, df in _quality_inputs(spark, sf).items():
        r = qa.validate(df, t)
        res = r if res is None else res.unionByName(r)
    m1 = mt.to_metrics(qa.published_summary(res), "data_quality_", qa.PUBLISHED, ["table"])
    m2 = mt.to_metrics(qa.column_stats(silver(spark, sf), "silver_trips"), "data_column_",
                       ["mean", "std"], ["table", "column"])
    return mt.format_exposition(m1.unionByName(m2))


# ---- feature store, models, drift reports -----------------------------------------

from tripflow.operators import models as mdl  # noqa: E402
from tripflow.operators import store as fs  # noqa: E402
from tripflow.plans.partitioning import written  # noqa: E402


@query
def parse_drift_report(spark, sf):
    return drf.parse_drift_report(drf.to_report_json(_daily_history(spark, sf))).drop("status")


def online_table(spark, sf):
    return fs.materialize_incremental(fs.daily_zone_stats(streaming(spark, sf)), fs.ZONE_VIEW,
                                      end="2024-01-20 00:00:00", start="2024-01-10 00:00:00")


@query
def materialize_incremental(spark, sf):
    return online_table(spark, sf)


@query
def online_features(spark, sf):
    req = trp.clean_trips(streaming(spark, sf)).select(
        "trip_key", F.col("pickup_zone_id").alias("zone_id"))
    return fs.get_online_features(req, online_table(spark, sf), fs.ZONE_VIEW, as_of="2024-01-21 00:00:00")


@query
def champions(spark, sf):
    ev = streaming(spark, sf).select(
        F.lit("taxi-duration").alias("model"),
        F.dayofmonth("tpep_pickup_datetime").alias("version"),
        F.abs(F.col("trip_distance") - F.col("total_amount") / 4.25).alias("err"))
    versions = ev.groupBy("model", "version").agg(F.round(F.avg("err"), 4).alias("mae"))
    return mdl.champions(versions)


@query
def regression_metrics(spark, sf):
    t = feat.enrich_trips(silver(spark, sf), feat.zone_stats(raw(spark, sf))).where(F.col("split") == "test")
    return mdl.regression_metrics(t, "duration_min", "pu_zone_avg_duration_min")


# Rows-only checks: a trained model has no SQL twin.

def _bronze(spark, sf):
    """Trips and zone statistics, stored as in the lake: what is derived for a
    trip is a column then, not an expression repeated in each rule."""
    bronze = written(raw(spark, sf))
    return bronze, written(feat.zone_stats(bronze))


def _stored_trips(spark, sf):
    """Enriched silver trips. A fit reads them several times and its scoring
    once more, so the cleaned trips are stored too."""
    bronze, zones = _bronze(spark, sf)
    return feat.enrich_trips(written(smp.hash_split(trp.clean_trips(bronze), "trip_key")), zones)


@query
def score_trips(spark, sf):
    data = _stored_trips(spark, sf)
    model = mdl.train(data.where(F.col("split") == "train"), mdl.TRIP_FEATURES, "duration_min")
    return mdl.score(model, data.where(F.col("split") == "test"), "predicted_duration_min", 2) \
        .select("trip_key", "duration_min", "predicted_duration_min")


@query
def score_fares(spark, sf):
    data = _stored_trips(spark, sf)
    model = mdl.train(data.where(F.col("split") == "train"), mdl.TRIP_FEATURES, "total_amount")
    return mdl.score(model, data.where(F.col("split") == "test"), "predicted_fare", 2) \
        .select("trip_key", "total_amount", "predicted_fare")


@query
def score_demand(spark, sf):
    bronze, zones = _bronze(spark, sf)      # demand is not stored: its shuffle serves all reads of the fit
    data = feat.enrich_demand(_demand_split(bronze), zones).withColumn(
        "trip_count", F.col("trip_count").cast("double"))
    model = mdl.train(data.where(F.col("split") == "train"), mdl.DEMAND_FEATURES, "trip_count")
    return mdl.score(model, data.where(F.col("split") == "test"), "predicted_trips", 1) \
        .select("zone_id", "pickup_hour", "day_of_week", "month", "trip_count", "predicted_trips")


# ---- lake, catalogue, streaming ---------------------------------------------------

import uuid  # noqa: E402

from tripflow.session import checkpoint_dir  # noqa: E402
from tripflow.sources import catalog as cat  # noqa: E402
from tripflow.sources.fixtures import BRONZE_COLUMNS, read_table, trips_of_events  # noqa: E402
from tripflow.streaming import ingest as stm  # noqa: E402


@query
def enforce_schema(spark, sf):
    return cat.enforce_schema(silver_demand(spark, sf), cat.schema_for("silver_demand"))


@query
def adhoc_sql(spark, sf):
    raw(spark, sf).createOrReplaceTempView("bronze_raw")
    return spark.sql("""
        SELECT PULocationID AS zone_id, count(*) AS trips,
               round(avg(total_amount), 2) AS avg_amount
        FROM bronze_raw WHERE trip_distance > 0 GROUP BY PULocationID""")


@query
def demand_stream(spark, sf):
    """Hourly demand of the events-derived trips, read as a stream."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/demand_stream/{uuid.uuid4().hex}"
    schema = read_table(spark, sf, "events").schema
    feed = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    src = trips_of_events(feed).select(*BRONZE_COLUMNS)
    return stm.demand_stream(spark, src, f"{base}/out", f"{base}/ckpt")


# ---- further operator variants ----------------------------------------------------

@query
def zone_stats_train_only(spark, sf):
    """Zone statistics from silver train rows only (no target leakage)."""
    return feat.zone_stats_from_silver(silver(spark, sf), train_only=True)


@query
def metrics_retention(spark, sf):
    return mt.prune_metrics(samples(spark, sf), AS_OF, retention_days=7).select("name", "labels", "ts", "value")


@query
def metrics_compare(spark, sf):
    return mt.compare(mt.instant(samples(spark, sf), AS_OF, lookback_s=None), ">", 48.0) \
        .select("name", "labels", "value")


@query
def metrics_scalar_op(spark, sf):
    return mt.scalar_op(mt.instant(samples(spark, sf), AS_OF, lookback_s=None), "*", 100.0) \
        .select("name", "labels", "value")


@query
def metrics_avg_by(spark, sf):
    v = mt.instant(samples(spark, sf), AS_OF, lookback_s=None)
    a = _by_u(mt.aggregate_by(v, ["u"], "avg")).withColumnRenamed("value", "avg_value")
    c = _by_u(mt.aggregate_by(v, ["u"], "count")).select("u", F.col("value").cast("long").alias("series"))
    return a.join(c, "u")


@query
def parse_props(spark, sf):
    """JSON text column parsing (the drift-report parser's building block)
    on the events' ``props`` documents: parsed field statistics per type."""
    from tripflow.sources.fixtures import read_table
    ev = read_table(spark, sf, "events")
    k = F.from_json("props", "k int")["k"]
    return ev.groupBy("event_type").agg(F.count(k).alias("docs"), F.sum(k).alias("k_sum"),
                                        F.max(k).alias("k_max"))


@query
def drift_report(spark, sf):
    """Per-feature report by the normed Wasserstein distance."""
    return drf.drift_report(drift_ref(spark, sf), drift_cur(spark, sf), drf.DRIFT_FEATURES, method="wasserstein")


# ---- drift from mergeable counts, report documents, lineage, small operators -------------

def _daily_counts(spark, sf):
    return drf.drift_counts(drf.drift_features(streaming(spark, sf), keep=("date",)), drf.DRIFT_FEATURES, by=("date",))


@query
def drift_daily_counts(spark, sf):
    """The table that drift is monitored from: value counts per day and feature."""
    return _daily_counts(spark, sf)


@query
def drift_summary_merged(spark, sf):
    """``drift_summary`` of the daily counts, added up."""
    ref = drf.drift_counts(drift_ref(spark, sf), drf.DRIFT_FEATURES)
    return drf.drift_summary(drf.report_from_counts(ref, _daily_counts(spark, sf), methods="wasserstein"))


@query
def drift_report_recent(spark, sf):
    """The report of the days since the 15th from their counts, each feature by its default method."""
    ref = drf.drift_counts(drift_ref(spark, sf), drf.DRIFT_FEATURES)
    return drf.report_from_counts(ref, _daily_counts(spark, sf).where("date >= '2024-01-15'"))


@query
def drift_chi2_pvalue(spark, sf):
    """Chi-square test of the test rows against the train rows."""
    both = silver(spark, sf)
    s = drf.category_scores(*(drf.drift_features(both.where(F.col("split") == x)) for x in ("train", "test")), DISCRETE)
    return s.select("feature", "chi2_dof", F.round(drf.chi2_pvalue(F.col("chi2_stat"), F.col("chi2_dof")), 6).alias("p_value"))


@query
def parse_foreign_reports(spark, sf):
    """Report documents of all sorts, one row a document."""
    from tripflow.sources.fixtures import foreign_reports
    return drf.parse_drift_report(foreign_reports(spark, sf), keep=("event_id",))


@query
def stale_tables(spark, sf):
    """Late tables and all that is built from them."""
    return cat.stale_tables(freshness(spark, sf))


@query
def validate_tables(spark, sf):
    """Every check of all five tables."""
    res = None
    for t, df in _quality_inputs(spark, sf).items():
        r = qa.validate(df, t)
        res = r if res is None else res.unionByName(r)
    return res


@query
def select_existing(spark, sf):
    from tripflow.functions import select_existing as existing
    return existing(streaming(spark, sf), ["trip_key", "airport_fee", "total_amount", "congestion_surcharge", "date"])


@query
def trips_of_months(spark, sf):
    """Trips per month of a comma list."""
    months = spark.range(1).select(F.explode(F.split(F.lit("1995-03, 1995-04,1996-12"), r",\s*")).alias("month"))
    trips = raw(spark, sf).select(F.date_format("tpep_pickup_datetime", "yyyy-MM").alias("month"))
    return trips.join(F.broadcast(months), "month").groupBy("month").agg(F.count(F.lit(1)).alias("trips"))


@query
def freshness_samples(spark, sf):
    """The latest pickup of each day's batch as Unix time, a metric sample per day."""
    last = streaming(spark, sf).groupBy(F.col("date").alias("table")).agg(
        F.unix_timestamp(F.max("tpep_pickup_datetime").cast("timestamp")).alias("freshness_timestamp"))
    return mt.to_metrics(last, "data_", ["freshness_timestamp"], ["table"]).select(
        "name", mt.labels_key("labels").alias("labels"), "value")
