"""End-to-end jobs over a lake: bronze → silver/gold → features → models,
plus the hourly ingest step, drift monitoring and retraining (SURVEY §3).

Each job is a plain function of a ``Lake``; a scheduler (cron, an
orchestrator, ``spark-submit``) calls them. Nothing is collected except
one-row results, rule results and small registry tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.operators import drift as drf
from tripflow.operators import features as feat
from tripflow.operators import metrics as mt
from tripflow.operators import models as mdl
from tripflow.operators import quality as qa
from tripflow.operators import sampling as smp
from tripflow.operators import store as fs
from tripflow.operators import trips as trp
from tripflow.operators.observed import Observed
from tripflow.sources.lake import Lake, PlainTable, path_exists, read_months, write_drift_report
from tripflow.streaming.ingest import feed_stream, ingest_stream, score_stream

BRONZE_RAW, BRONZE_STREAM = ("bronze", "raw"), ("bronze", "streaming")
SILVER_TRIPS, SILVER_DEMAND = ("silver", "trips"), ("silver", "demand")
GOLD_ZONES, ONLINE = ("gold", "zone_stats"), ("gold", "online_zone_stats")
METRICS, REGISTRY = ("monitoring", "metrics"), ("monitoring", "model_registry")


def _t(lake: Lake, ref):
    return lake.table(*ref)


def _publish(lake: Lake, m: DataFrame) -> None:
    """Append samples to the metrics table, partitioned by day so that
    retention and time-range queries prune whole directories."""
    m = m.withColumn("ts", F.coalesce("ts", F.localtimestamp()))
    _t(lake, METRICS).write(m.withColumn("date", F.date_format("ts", "yyyy-MM-dd")), "append",
                            partition_by=["date"])


def _gated(lake: Lake, ref, df: DataFrame, rules: str, mode: str = "overwrite", where: Column | None = None,
           strict: bool = True) -> int:
    """Write ``df``, checking it in the same pass (the rows of ``where``). The
    checks and column statistics are published whatever they are; if one failed,
    ``strict`` raises before the new version is committed."""
    seen = Observed(df, rules, where=where)

    def gate(written: DataFrame) -> None:
        _publish(lake, seen.metrics(seen.checks(written)))
        if strict:
            seen.fail()
    return _t(lake, ref).write(seen.watch(df), mode, gate=gate)


def load_bronze(lake: Lake, raw: DataFrame, mode: str = "overwrite") -> int:
    """Store raw trips (bronze_raw). They are checked and the checks published;
    trips that fail are stored all the same, silver is where they end."""
    return _gated(lake, BRONZE_RAW, raw, "bronze_raw", mode, strict=False)


def load_months(lake: Lake, root: str, months: str, pattern: str = "yellow_tripdata_{month}.parquet") -> int:
    """Load monthly files given as ``"2024-01,2024-02"`` (A1): each month is
    checked by itself, the first replaces bronze_raw, the others are appended."""
    version = -1
    for k, month in enumerate(m.strip() for m in months.split(",") if m.strip()):
        version = load_bronze(lake, read_months(lake.spark, root, month, pattern), "append" if k else "overwrite")
    return version


def append_trips(lake: Lake, trips: DataFrame, feed: str) -> None:
    """Put a batch of streamed trips into bronze_streaming under a feed's name;
    the same feed again replaces what it brought before."""
    out = trips.withColumn("date", F.date_format("tpep_pickup_datetime", "yyyy-MM-dd")).withColumn("feed", F.lit(feed))
    seen = Observed(trips.drop("date"), "bronze_streaming", ts_col="tpep_pickup_datetime")

    def gate(staged: DataFrame) -> None:
        _publish(lake, seen.metrics(seen.checks(staged)))
        seen.fail()
        _keep_counts(lake, staged)
    _stream(lake).replace_partitions(seen.watch(out), ["date", "feed"], gate)


def ingest_feed(lake: Lake, feed_dir: str, checkpoint: str, schema, from_date: str | None = None,
                files_per_trigger: int | None = None) -> None:
    """Take new feed files into bronze_streaming (J1), the table that drift
    monitoring and the combined source read; every batch publishes its checks,
    column statistics and latest pickup (J7)."""
    ingest_stream(lake.spark, feed_dir, schema, _stream(lake).path, checkpoint, from_date=from_date,
                  files_per_trigger=files_per_trigger,
                  on_batch=lambda seen, results, _: _publish(lake, seen.metrics(results)),
                  on_pass=lambda staged: _keep_counts(lake, staged))


def _keep_counts(lake: Lake, staged: DataFrame) -> None:
    """The value counts of a batch of streamed trips, by its days and feeds, for
    drift (J6). A batch whose trips all fall away still replaces its counts: an
    entry without a feature stands for it."""
    parts = ["date", "feed"]
    counts = drf.drift_counts(drf.drift_features(staged, keep=tuple(parts)), drf.DRIFT_FEATURES, by=tuple(parts))
    marks = staged.select(*parts).distinct().select(*parts, F.lit("").alias("feature"), F.lit(0.0).alias("value"),
                                                    F.lit(0).cast("long").alias("n"))
    _counts(lake).replace_partitions(counts.unionByName(marks), parts)


def _counts(lake: Lake) -> PlainTable:
    return lake.plain("monitoring", "drift_counts")


def _stream(lake: Lake) -> PlainTable:
    return lake.plain(*BRONZE_STREAM)


def _source(lake: Lake, data_source: str) -> DataFrame:
    raw = _t(lake, BRONZE_RAW).read() if _t(lake, BRONZE_RAW).exists() else None
    stream = _stream(lake).read().drop("feed") if _stream(lake).exists() else None
    return trp.load_source(raw, stream, data_source)


def build_silver_trips(lake: Lake, data_source: str = "raw", key: str = "trip_key",
                       exact: bool = False) -> int:
    """Clean, split 80/20 by key hash, gate the train part, overwrite."""
    t = trp.clean_trips(_source(lake, data_source))
    t = smp.exact_split(t, key) if exact else smp.hash_split(t, key)
    return _gated(lake, SILVER_TRIPS, t, "silver_trips", where=F.col("split") == "train")


def build_silver_demand(lake: Lake, data_source: str = "raw", keep_date: bool = False) -> int:
    """Demand per zone/date/hour per source, merged, split, gated."""
    src = _source(lake, data_source)
    parts = [feat.demand(src.where(F.col("date").isNull()) if "date" in src.columns else src, keep_date=True)]
    if "date" in src.columns:
        parts.append(feat.demand(src.where(F.col("date").isNotNull()), keep_date=True))
    d = feat.merge_demand(parts, keep_date=True)
    if not keep_date:
        d = feat.merge_demand([d.drop("pickup_date")], keep_date=False)
        key = F.concat_ws("|", "zone_id", "pickup_hour", "day_of_week", "month")
    else:
        key = F.concat_ws("|", "zone_id", F.col("pickup_date").cast("string"), "pickup_hour")
    d = smp.hash_split(d.withColumn("_k", key), "_k").drop("_k")
    return _gated(lake, SILVER_DEMAND, d, "silver_demand", where=F.col("split") == "train")


def build_gold_zone_stats(lake: Lake, export_path: str | None = None, train_only: bool = False) -> int:
    """Zone statistics from bronze (or from silver train rows with
    ``train_only``), gated, stored; optionally exported as one file."""
    if train_only:
        # silver rows carry no pickup timestamp: stamp the features with the
        # day they were computed (the feature view needs an event time)
        zs = feat.zone_stats_from_silver(_t(lake, SILVER_TRIPS).read())
        zs = zs.withColumn("event_timestamp", F.date_trunc("day", F.localtimestamp()).cast("timestamp_ntz"))
    else:
        zs = feat.zone_stats(_t(lake, BRONZE_RAW).read())
    v = _gated(lake, GOLD_ZONES, zs, "gold_zone_stats")
    if export_path:
        from tripflow.sources.lake import export_features
        export_features(_t(lake, GOLD_ZONES).read(), export_path)
    return v


def materialize(lake: Lake, end: str, start: str | None = None) -> int:
    """Merge the latest zone features up to ``end`` into the online table."""
    online = _t(lake, ONLINE).read() if _t(lake, ONLINE).exists() else None
    out = fs.materialize_incremental(_t(lake, GOLD_ZONES).read(), fs.ZONE_VIEW, end, start, online)
    return _t(lake, ONLINE).write(out, "overwrite")


def ingest_hour(lake: Lake, virtual_dt: str, batch_size: int | None = None) -> int:
    """The trips of one hour (with ``batch_size``, the first so many) from bronze
    raw into bronze streaming, as a feed of that hour's name. -1 without any."""
    batch = smp.hour_slice(_t(lake, BRONZE_RAW).read(), virtual_dt, batch_size)
    if batch.isEmpty():
        return -1
    append_trips(lake, batch.drop("trip_key"), f"hour-{virtual_dt[:13].replace(' ', 'T')}")
    return 0


def validate_lake(lake: Lake) -> DataFrame:
    """Re-check the stored tables on demand (I5): one result frame for all
    five rule sets; absent tables are skipped."""
    tables = {"bronze_raw": BRONZE_RAW, "bronze_streaming": BRONZE_STREAM, "silver_trips": SILVER_TRIPS,
              "silver_demand": SILVER_DEMAND, "gold_zone_stats": GOLD_ZONES}
    out = None
    for name, ref in tables.items():
        t = _stream(lake) if ref == BRONZE_STREAM else _t(lake, ref)
        if t.exists():
            r = qa.validate(t.read(), name)
            out = r if out is None else out.unionByName(r)
    return out


def monitor_drift(lake: Lake, run_ts: str, method: str | dict = drf.DEFAULT_METHODS,
                  since_date: str | None = None) -> DataFrame:
    """Reference = silver train rows, current = streamed trips (pruned to
    ``date >= since_date`` partitions when given, J6); stores the report and
    publishes the summary and each feature's score and flag. With too few rows
    nothing is stored or published. Returns the one-row summary. Streamed trips
    are read as the counts kept of them, unless the method is to be chosen from
    the data."""
    ref = drf.drift_features(_t(lake, SILVER_TRIPS).read().where(F.col("split") == "train"))
    since = F.col("date") >= since_date if since_date else F.lit(True)      # partition pruning
    if method != "auto" and _counts(lake).exists():
        cur = _counts(lake).read().where(since & (F.col("feature") != ""))
        found = drf.report_from_counts(drf.drift_counts(ref, drf.DRIFT_FEATURES), cur, drf.DRIFT_FEATURES, method)
    else:
        found = drf.drift_report(ref, drf.drift_features(_stream(lake).read().where(since)), drf.DRIFT_FEATURES, method)
    rows = found.collect()                      # one row per feature
    rep = lake.spark.createDataFrame(rows, found.schema)
    if not rows:
        return drf.drift_summary(rep)
    write_drift_report(lake, rep, run_ts)
    summ = drf.drift_summary(rep)
    _publish(lake, mt.to_metrics(summ.select(F.col("drift_share"), F.col("number_of_drifted_columns"),
                                             F.col("number_of_columns"),
                                             F.col("dataset_drift").cast("int").alias("dataset_drift")),
                                 "drift_", ["drift_share", "number_of_drifted_columns", "number_of_columns",
                                            "dataset_drift"], []))
    _publish(lake, mt.to_metrics(rep.select("feature", "score", F.col("drifted").cast("int").alias("detected")),
                                 "drift_feature_", ["score", "detected"], ["feature"]))
    return summ


def train_and_register(lake: Lake, target: str = "duration", max_iter: int | None = None,
                       max_train_rows: int | None = mdl.MAX_TRAIN_ROWS,
                       max_test_rows: int | None = mdl.MAX_TEST_ROWS) -> dict:
    """Train one model family, evaluate on the test split, append to the
    registry, publish the model's metrics and report whether it became champion
    (I10, I15, I16, A15). Trip models read exact samples of at most so many
    train and test rows (None: all)."""
    zones = _t(lake, GOLD_ZONES).read()
    if target == "demand":
        data = feat.enrich_demand(_t(lake, SILVER_DEMAND).read(), zones)
        feats, label, dec = mdl.DEMAND_FEATURES, "trip_count", 1
    else:
        data = feat.enrich_trips(_t(lake, SILVER_TRIPS).read(), zones)
        feats, dec = mdl.TRIP_FEATURES, 2
        label = "duration_min" if target == "duration" else "total_amount"
    data = data.withColumn(label, F.col(label).cast("double"))
    train, test = data.where(F.col("split") == "train"), data.where(F.col("split") == "test")
    if target != "demand":
        train = smp.sample_rows(train, max_train_rows, "trip_key") if max_train_rows else train
        test = smp.sample_rows(test, max_test_rows, "trip_key") if max_test_rows else test
    model = mdl.train(train, feats, label, max_iter=max_iter)
    m = mdl.regression_metrics(mdl.score(model, test, decimals=dec), label).collect()[0].asDict()
    train_rows = train.count()
    reg = _t(lake, REGISTRY)
    spark = lake.spark
    # the model first, under the first version that nobody has: saving fails where one stands
    version = (reg.read().where(F.col("model") == target).count() + 1) if reg.exists() else 1
    while path_exists(spark, f"{_models(lake)}/{target}/v={version}"):
        version += 1
    model.save(f"{_models(lake)}/{target}/v={version}")
    row = spark.createDataFrame([(target, version, float(m["mae"] or 0.0), float(m["rmse"] or 0.0),
                                  float(m["r2"] or 0.0), int(m["n"]))],
                                "model string, version int, mae double, rmse double, r2 double, test_rows bigint")
    reg.write(row, "append")
    _t(lake, ("monitoring", "runs")).write(
        mdl.log_run(spark, target, version, {**mdl.GBT_PARAMS, **({"maxIter": max_iter} if max_iter else {})},
                    {k: m[k] for k in ("mae", "rmse", "r2") if m[k] is not None},
                    train_rows), "append")
    _publish(lake, mt.to_metrics(mdl.model_metrics(spark, target, m, train_rows), "model_",
                                 ["mae", "rmse", "r2", "train_rows", "retrain_timestamp"], ["model"])
             .where(F.col("value").isNotNull()))
    champion = mdl.resolve_champion(reg.read(), target)
    return {**m, "version": version, "champion_version": champion}


def _models(lake: Lake) -> str:
    return f"{lake.root.rstrip('/')}/models"


def champions(lake: Lake) -> mdl.Champions:
    """The lake's champions, loaded by version."""
    return mdl.Champions(lambda: _t(lake, REGISTRY).read(), _models(lake))


def score_feed(lake: Lake, feed_dir: str, schema, out_dir: str, checkpoint: str, target: str = "duration",
               files_per_trigger: int | None = None) -> None:
    """Score new feed files with the target's champion (I17, I18): trips are
    cleaned and given the current zone features; each batch asks for the
    champion anew and writes its name and version on every row."""
    clean = trp.clean_trips(feed_stream(lake.spark, feed_dir, schema, files_per_trigger))
    known = champions(lake)
    score_stream(feat.enrich_trips(clean, _t(lake, GOLD_ZONES).read()), lambda: known.get(target), out_dir, checkpoint,
                 {"duration": "predicted_duration_min", "fare": "predicted_fare"}[target])


def retrain(lake: Lake, data_source: str = "combined", max_iter: int | None = None,
            refresh_zone_stats: bool = True) -> list[dict]:
    """Rebuild silver (and by default gold, so the models never join stale
    zone features) and retrain the three model families."""
    build_silver_trips(lake, data_source)
    build_silver_demand(lake, data_source)
    if refresh_zone_stats:
        build_gold_zone_stats(lake)
    return [train_and_register(lake, t, max_iter) for t in ("duration", "fare", "demand")]
