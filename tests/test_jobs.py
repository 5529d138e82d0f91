"""End-to-end jobs on a scratch lake with sf0.001 data."""
from tripflow.plans import jobs
from tripflow.sources.fixtures import trips_from_lineitem
from tripflow.sources.lake import Lake

from conftest import SF0001


def test_pipeline_end_to_end(spark, scratch):
    lake = Lake(spark, scratch)
    jobs.load_bronze(lake, trips_from_lineitem(spark, SF0001))
    jobs.build_silver_trips(lake)
    jobs.build_silver_demand(lake)
    jobs.build_gold_zone_stats(lake, export_path=f"{scratch}/export")
    assert lake.table("gold", "zone_stats").read().count() <= 263
    jobs.materialize(lake, end="2100-01-01 00:00:00")
    assert jobs.ingest_hour(lake, "1995-03-15 10:00:00") >= -1
    r = jobs.train_and_register(lake, "fare", max_iter=5)
    assert r["version"] == 1 and r["champion_version"] == 1
    r2 = jobs.train_and_register(lake, "fare", max_iter=5)
    assert r2["version"] == 2 and r2["champion_version"] in (1, 2)
    assert lake.table("monitoring", "metrics").read().count() > 0
    assert lake.table("monitoring", "runs").read().count() == 2
    res = jobs.validate_lake(lake)
    assert {r["table"] for r in res.collect()} >= {"bronze_raw", "silver_trips", "gold_zone_stats"}


def test_gold_from_train_rows(spark, scratch):
    lake = Lake(spark, scratch)
    jobs.load_bronze(lake, trips_from_lineitem(spark, SF0001))
    jobs.build_silver_trips(lake)
    jobs.build_gold_zone_stats(lake, train_only=True)
    zs = lake.table("gold", "zone_stats").read()
    assert zs.where("event_timestamp IS NULL").count() == 0 and zs.count() <= 263


def test_monitor_drift_job(spark, scratch):
    from tripflow.sources.fixtures import trips_from_events
    lake = Lake(spark, scratch)
    jobs.load_bronze(lake, trips_from_lineitem(spark, SF0001))
    jobs.build_silver_trips(lake)
    ev = trips_from_events(spark, SF0001).drop("trip_key")
    jobs.append_trips(lake, ev, "events")
    summ = jobs.monitor_drift(lake, "2024-02-01 00:00:00", method="wasserstein").collect()[0]
    assert summ["number_of_columns"] == 5 and 0 <= summ["drift_share"] <= 1
    rep = lake.table("monitoring", "drift_reports").read()
    assert rep.count() == 5 and str(rep.select("run_date").distinct().collect()[0][0]) == "2024-02-01"
    later = jobs.monitor_drift(lake, "2024-02-02 00:00:00", since_date="2024-01-15").collect()[0]
    assert later["number_of_columns"] == 5


def test_seven_bronze_columns_and_streamed_trips_reach_the_models(spark, scratch):
    """No key column anywhere: the combined source keeps every streamed trip."""
    from pyspark.sql import functions as F

    from tripflow.operators import trips as trp
    from tripflow.sources.fixtures import BRONZE_COLUMNS, trips_from_events
    lake = Lake(spark, scratch)
    raw = trips_from_lineitem(spark, SF0001).select(*BRONZE_COLUMNS)
    ev = trips_from_events(spark, SF0001).select(*BRONZE_COLUMNS, "date")
    jobs.load_bronze(lake, raw)
    jobs.append_trips(lake, ev, "events")
    jobs.build_silver_trips(lake, "combined")
    silver = lake.table("silver", "trips").read()
    want = trp.clean_trips(raw).count() + trp.clean_trips(ev).count()
    assert silver.count() == want and trp.clean_trips(ev).count() > 0
    assert silver.where("trip_key IS NULL OR split IS NULL").count() == 0
    assert jobs.ingest_hour(lake, "1995-03-15 10:00:00") >= -1
    names = {r["name"] for r in lake.table("monitoring", "metrics").read().select("name").distinct().collect()}
    assert {f"data_quality_{x}" for x in ("passed", "checks_total", "checks_passed", "checks_failed", "rows_total")} <= names
    summ = jobs.monitor_drift(lake, "2024-02-01 00:00:00").collect()[0]
    assert summ["number_of_columns"] == 5
    names = {r["name"] for r in lake.table("monitoring", "metrics").read().select("name").distinct().collect()}
    assert {"drift_feature_score", "drift_feature_detected"} <= names
    passed = lake.table("monitoring", "metrics").read().where(F.col("name") == "data_quality_passed")
    assert {r["value"] for r in passed.collect()} == {1.0}


def _feed(spark, scratch, parts=3):
    """The streamed trips of sf0.001 as feed files, one a third of the days."""
    from tripflow.sources.fixtures import BRONZE_COLUMNS, trips_from_events
    ev = trips_from_events(spark, SF0001).select(*BRONZE_COLUMNS)
    for k in range(parts):
        ev.where(f"dayofmonth(tpep_pickup_datetime) % {parts} = {k}").coalesce(1).write.parquet(f"{scratch}/feed/part={k}")
    return ev


def _metric(lake, name):
    return [r["value"] for r in lake.table("monitoring", "metrics").read().where(f"name = '{name}'").collect()]


def test_feed_to_retrain(spark, scratch):
    """Streamed trips reach drift and the models; replays neither add nor lose rows."""
    from pyspark.sql import functions as F

    from tripflow.operators import trips as trp
    from tripflow.sources.fixtures import BRONZE_COLUMNS
    lake = Lake(spark, scratch)
    raw = trips_from_lineitem(spark, SF0001).select(*BRONZE_COLUMNS)
    jobs.load_bronze(lake, raw)
    ev = _feed(spark, scratch)
    want = sorted(map(str, ev.collect()))
    stored = lambda: sorted(map(str, lake.plain("bronze", "streaming").read().select(*BRONZE_COLUMNS).collect()))
    jobs.ingest_feed(lake, f"{scratch}/feed", f"{scratch}/ckpt", ev.schema, files_per_trigger=1)
    assert stored() == want
    last = ev.agg(F.max(F.unix_timestamp(F.col("tpep_pickup_datetime").cast("timestamp")))).first()[0]
    fresh = _metric(lake, "data_freshness_timestamp")
    assert len(fresh) == 3 and max(fresh) == last
    # the same feed with a fresh checkpoint and other batches, whole and from a day on
    jobs.ingest_feed(lake, f"{scratch}/feed", f"{scratch}/ckpt2", ev.schema)
    assert stored() == want
    jobs.ingest_feed(lake, f"{scratch}/feed", f"{scratch}/ckpt3", ev.schema, from_date="2024-01-20")
    assert stored() == want
    # an older checkpoint with nothing new
    jobs.ingest_feed(lake, f"{scratch}/feed", f"{scratch}/ckpt", ev.schema)
    assert stored() == want
    assert jobs.build_silver_trips(lake, "combined") == 0
    assert lake.table("silver", "trips").read().count() == trp.clean_trips(raw).count() + trp.clean_trips(ev).count()
    jobs.build_gold_zone_stats(lake)
    assert jobs.monitor_drift(lake, "2024-02-01 00:00:00").collect()[0]["number_of_columns"] == 5
    # the kept counts give the report that the trips themselves give
    train = lake.table("silver", "trips").read().where("split = 'train'")
    want_report = jobs.drf.drift_report(jobs.drf.drift_features(train), jobs.drf.drift_features(ev))
    kept = lake.table("monitoring", "drift_reports").read().select(*want_report.columns)
    assert sorted(kept.collect()) == sorted(want_report.collect())
    found = jobs.train_and_register(lake, "duration", max_iter=2, max_train_rows=200, max_test_rows=50)
    assert found["n"] == 50 and _metric(lake, "model_train_rows") == [200.0]
    assert {len(_metric(lake, f"model_{m}")) for m in ("mae", "rmse", "r2", "retrain_timestamp")} == {1}


def test_a_failing_batch_leaves_the_table_as_it_was(spark, scratch):
    import pytest
    lake = Lake(spark, scratch)
    ev = _feed(spark, scratch, parts=1)
    jobs.ingest_feed(lake, f"{scratch}/feed", f"{scratch}/ckpt", ev.schema)
    n = lake.plain("bronze", "streaming").read().count()
    ev.limit(20).selectExpr(*[c if c != "PULocationID" else "CAST(NULL AS INT) AS PULocationID" for c in ev.columns]) \
        .coalesce(1).write.parquet(f"{scratch}/feed/part=9")
    with pytest.raises(Exception, match="data quality check FAILED"):
        jobs.ingest_feed(lake, f"{scratch}/feed", f"{scratch}/ckpt", ev.schema)
    assert lake.plain("bronze", "streaming").read().count() == n
    assert 0.0 in _metric(lake, "data_quality_passed")


def test_observed_checks_equal_a_second_read(spark, scratch):
    from tripflow.operators import quality as qa
    from tripflow.operators.observed import Observed
    lake = Lake(spark, scratch)
    raw = trips_from_lineitem(spark, SF0001)
    seen = Observed(raw, "bronze_raw", ts_col="tpep_pickup_datetime")
    seen.watch(raw).write.parquet(f"{scratch}/raw")
    assert sorted(seen.checks().collect()) == sorted(qa.validate(raw, "bronze_raw").collect())
    stats = {r["column"]: (r["mean"], r["std"]) for r in qa.column_stats(raw, "bronze_raw").collect()}
    got = {}
    for r in seen.metrics(seen.checks()).where("name LIKE 'data_column%'").collect():
        got.setdefault(r["labels"]["column"], {})[r["name"]] = round(r["value"], 4)
    assert {c: (v["data_column_mean"], v["data_column_std"]) for c, v in got.items()} == stats
    # a table without rows is observed too
    none = raw.where("1 = 0")
    empty = Observed(none, "bronze_raw")
    empty.watch(none).write.parquet(f"{scratch}/none")
    assert empty.rows == 0 and [r["passed"] for r in empty.checks().where("check = 'row_count'").collect()] == [False]
    assert lake.plain("bronze", "streaming").exists() is False


def test_champion_changes_between_batches(spark, scratch):
    """The second micro-batch is scored by version 2, registered after the first."""
    from tripflow.operators import models as mdl
    from tripflow.streaming import ingest as stm
    lake = Lake(spark, scratch)
    jobs.load_bronze(lake, trips_from_lineitem(spark, SF0001))
    jobs.build_silver_trips(lake)
    jobs.build_gold_zone_stats(lake)
    assert jobs.train_and_register(lake, "fare", max_iter=1)["champion_version"] == 1
    ev = _feed(spark, scratch, parts=2)
    known, calls = jobs.champions(lake), []

    def resolve():
        if calls:
            assert jobs.train_and_register(lake, "fare", max_iter=8)["champion_version"] == 2
        calls.append(1)
        return known.get("fare")
    assert known.get("demand") is None
    clean = jobs.trp.clean_trips(stm.feed_stream(spark, f"{scratch}/feed", ev.schema, 1))
    stm.score_stream(jobs.feat.enrich_trips(clean, lake.table("gold", "zone_stats").read()), resolve, f"{scratch}/out",
                     f"{scratch}/ckpt", "predicted_fare")
    out = spark.read.parquet(f"{scratch}/out")
    assert {(r["batch_id"], r["model_name"], r["model_version"]) for r in
            out.select("batch_id", "model_name", "model_version").distinct().collect()} == {(0, "fare", 1), (1, "fare", 2)}
    # loaded models score as the saved ones
    second = mdl.Champions(lambda: lake.table("monitoring", "model_registry").read(), f"{scratch}/models").get("fare")
    assert second.version == 2
    jobs.score_feed(lake, f"{scratch}/feed", ev.schema, f"{scratch}/out2", f"{scratch}/ckpt2", "fare")
    scored = spark.read.parquet(f"{scratch}/out2")
    assert scored.count() == out.count() and {r[0] for r in scored.select("model_version").distinct().collect()} == {2}


def test_months_are_loaded_one_by_one(spark, scratch):
    raw = trips_from_lineitem(spark, SF0001)
    for month in ("1995-03", "1995-04"):
        raw.where(f"date_format(tpep_pickup_datetime, 'yyyy-MM') = '{month}'").coalesce(1).write.parquet(
            f"{scratch}/in/yellow_tripdata_{month}.parquet")
    lake = Lake(spark, f"{scratch}/lake")
    for _ in range(2):
        jobs.load_months(lake, f"{scratch}/in", "1995-03, 1995-04")
    want = raw.where("date_format(tpep_pickup_datetime, 'yyyy-MM') IN ('1995-03', '1995-04')").count()
    assert lake.table("bronze", "raw").read().count() == want > 0
    assert len(_metric(lake, "data_quality_rows_total")) == 4
