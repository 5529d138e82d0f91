"""Metric queries against brute force, with small buckets so that series
cross bucket boundaries (exercises the halo and the carried state)."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.operators import metrics as mt

HOUR_US = 3_600_000_000


def _samples(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for s in range(3):
        t = t0
        v = 0.0
        for _ in range(n):
            t += dt.timedelta(seconds=int(rng.integers(1, 900)))
            v = 0.0 if rng.random() < 0.05 else v + float(rng.integers(0, 4))
            rows.append(("m", {"s": str(s)}, t, v))
    df = spark.createDataFrame(rows, "name string, labels map<string,string>, ts timestamp_ntz, value double")
    return mt.normalize(df), rows


def _brute_by_series(rows):
    out = {}
    for name, lab, t, v in rows:
        out.setdefault(lab["s"], []).append((t, v))
    return {k: sorted(v) for k, v in out.items()}


def test_rate_and_changes_brute_force(spark):
    m, rows = _samples(spark)
    w = 1800
    rate = {(r["labels"], r["ts"]): r["value"] for r in mt.rate(m, w, bucket_us=HOUR_US).collect()}
    chg = {(r["labels"], r["ts"]): r["value"] for r in mt.changes(m, w, bucket_us=HOUR_US).collect()}
    for s, pts in _brute_by_series(rows).items():
        key = f's="{s}"'
        for i, (t, v) in enumerate(pts):
            lo = t - dt.timedelta(seconds=w)
            idx = [j for j in range(len(pts)) if lo < pts[j][0] <= t]
            inc = dtt = 0.0
            for j in idx:
                if j == 0:
                    continue
                pv = pts[j - 1][1]
                inc += pts[j][1] - pv if pts[j][1] >= pv else pts[j][1]
                dtt += (pts[j][0] - pts[j - 1][0]).total_seconds()
            want = round(inc / dtt, 6) if dtt > 0 else None
            assert rate[(key, t)] == (pytest.approx(want) if want is not None else None)
            c = sum(1 for j in idx[1:] if pts[j][1] != pts[j - 1][1])
            assert chg[(key, t)] == c


def test_irate_and_timeline(spark):
    m, rows = _samples(spark, n=200)
    ir = {(r["labels"], r["ts"]): r["value"] for r in mt.irate(m, bucket_us=HOUR_US).collect()}
    st = m.withColumn("state", mt.status_level(F.col("value"), [(10.0, "yellow"), (20.0, "red")]))
    runs = mt.state_timeline(st, "state", bucket_us=HOUR_US).collect()
    for s, pts in _brute_by_series(rows).items():
        key = f's="{s}"'
        for i in range(1, len(pts)):
            (t0, v0), (t1, v1) = pts[i - 1], pts[i]
            inc = v1 - v0 if v1 >= v0 else v1
            assert ir[(key, t1)] == pytest.approx(round(inc / (t1 - t0).total_seconds(), 6))
        lv = ["red" if v >= 20 else "yellow" if v >= 10 else "green" for _, v in pts]
        n_runs = 1 + sum(1 for a, b in zip(lv, lv[1:]) if a != b)
        mine = [r for r in runs if r["labels"] == key]
        assert len(mine) == n_runs and sum(r["samples"] for r in mine) == len(pts)


def test_instant_range_match_and_ops(spark):
    m, rows = _samples(spark, n=50)
    v = mt.instant(m, "2024-01-01 06:00:00", lookback_s=None)
    assert v.count() == 3
    assert mt.match_labels(m, [("s", "=~", "0|1")]).select("labels").distinct().count() == 2
    assert mt.match_labels(m, [("missing", "=", "")]).count() == m.count()
    agg = mt.aggregate_by(v, ["s"], "sum").count()
    assert agg == 3
    two = mt.metric_binary_op(v, v, "-", on=["s"]).collect()
    assert all(r["value"] == 0 for r in two)
    rng = mt.range_query(m, "2024-01-01 00:00:00", "2024-01-01 06:00:00", 3600)
    assert rng.where(F.col("step_ts") > F.lit("2024-01-01 06:00:00").cast("timestamp_ntz")).count() == 0


def test_exposition_format(spark):
    df = spark.createDataFrame([("t1", 1, 0.5)], "table string, a bigint, b double")
    lines = [r[0] for r in mt.format_exposition(mt.to_metrics(df, "q_", ["a", "b"], ["table"])).collect()]
    assert sorted(lines) == ['q_a{table="t1"} 1', 'q_b{table="t1"} 0.5000']


def test_scalar_compare(spark):
    m, rows = _samples(spark, n=20)
    v = mt.instant(m, "2024-01-02 00:00:00", lookback_s=None)
    assert mt.compare(v, ">", -1.0).count() == 3 and mt.compare(v, "<", -1.0).count() == 0
    one = v.where(F.col("labels") == 's="0"')
    k = mt.scalar(one)
    assert k == one.collect()[0]["value"]
    assert mt.scalar(v) != mt.scalar(v)          # NaN for more than one element
    assert mt.scalar_op(one, "*", 2.0).collect()[0]["value"] == 2 * k


def test_vectors_compose(spark):
    m, rows = _samples(spark, n=60)
    changed = mt.compare(mt.changes(m, 1800, bucket_us=HOUR_US), ">", 0)
    assert changed.columns == ["name", "labels", "label_map", "ts", "value"]
    assert changed.count() == sum(r["value"] > 0 for r in mt.changes(m, 1800, bucket_us=HOUR_US).collect())
    total = mt.aggregate_by(mt.instant(mt.rate(m, 7200), "2024-01-02 00:00:00", lookback_s=None), [], "count")
    assert [(r.name, r.labels, r.value) for r in total.collect()] == [("", "", 3.0)]
    assert mt.rate(m, 86_400 * 7).count() == len(rows)
    with pytest.raises(ValueError):
        mt.compare(m.drop("value"), ">", 0)


def test_matching_by_ignoring_and_many_to_many(spark):
    v = mt.normalize(spark.createDataFrame(
        [("a", {"x": "1", "y": "p"}, 6.0), ("a", {"x": "2", "y": "p"}, 8.0), ("b", {"x": "1"}, 2.0), ("b", {"x": "2"}, 4.0)],
        "name string, labels map<string,string>, value double").withColumn("ts", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")))
    a, b = v.where("name = 'a'"), v.where("name = 'b'")
    got = mt.metric_binary_op(a, b, "/", ignoring=["y"]).collect()
    assert sorted((r.labels, r.value) for r in got) == [('x="1",y="p"', 3.0), ('x="2",y="p"', 2.0)]
    assert mt.metric_binary_op(a, b, "/", ignoring=[]).count() == 0
    with pytest.raises(Exception, match="several right-hand series"):
        mt.metric_binary_op(a, b, "/", on=["z"]).collect()


def test_label_values_are_escaped(spark):
    df = spark.createDataFrame([({"a": 'x",b="y'},), ({"a": "x", "b": "y"},), ({"a": "1\n2\\"},)], "labels map<string,string>")
    got = [r[0] for r in df.select(mt.labels_key("labels")).collect()]
    assert got == ['a="x\\",b=\\"y"', 'a="x",b="y"', 'a="1\\n2\\\\"']


def _at(samples, t, w):
    lo = t - dt.timedelta(seconds=w)
    return [j for j in range(len(samples)) if lo < samples[j][0] <= t]


@pytest.mark.parametrize("step,window", [(240, 1800), (3600, 900), (600, 600)])
def test_functions_on_steps_against_brute_force(spark, step, window):
    m, rows = _samples(spark, n=60)
    steps = mt.Steps("2024-01-01 01:00:00", "2024-01-01 06:30:00", step)
    t0, t1 = dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 6, 30)
    times = [t0 + dt.timedelta(seconds=k * step) for k in range(int((t1 - t0).total_seconds()) // step + 1)]
    want = {f: {} for f in ("last", "rate", "irate", "changes")}
    for s, pts in _brute_by_series(rows).items():
        for t in times:
            idx = _at(pts, t, window)
            if not idx:
                continue
            at = (f's="{s}"', t)
            inc = [(0.0, 0.0) if j == 0 else (pts[j][1] - pts[j - 1][1] if pts[j][1] >= pts[j - 1][1] else pts[j][1],
                                              (pts[j][0] - pts[j - 1][0]).total_seconds()) for j in idx]
            want["last"][at] = pts[idx[-1]][1]
            if sum(x[1] for x in inc) > 0:
                want["rate"][at] = round(sum(x[0] for x in inc) / sum(x[1] for x in inc), 6)
            if len(idx) > 1:
                want["irate"][at] = round(inc[-1][0] / inc[-1][1], 6)
            want["changes"][at] = sum(pts[j][1] != pts[j - 1][1] for j in idx[1:])
    got = {"last": mt.instant(m, lookback_s=window, steps=steps), "rate": mt.rate(m, window, HOUR_US, steps=steps),
           "irate": mt.irate(m, HOUR_US, steps=steps, window_s=window),
           "changes": mt.changes(m, window, HOUR_US, steps=steps)}
    for f, v in got.items():
        assert v.columns == ["name", "labels", "label_map", "ts", "value"]
        assert {(r.labels, r.ts): r.value for r in v.collect()} == pytest.approx(want[f]), f


def _constant_rate(spark, series=("a",)):
    """Counters that grow by one a second, a sample a minute."""
    t = lambda k: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k)
    return mt.normalize(spark.createDataFrame(
        [("x", {"s": s}, t(k), 60.0 * k) for s in series for k in range(6)],
        "name string, labels map<string,string>, ts timestamp_ntz, value double"))


def test_aggregates_keep_times_apart(spark):
    rate = mt.rate(_constant_rate(spark, "ab"), 300).where("value IS NOT NULL")
    for fn, want in (("sum", 2.0), ("avg", 1.0), ("count", 2.0), ("max", 1.0)):
        got = mt.aggregate_by(rate, [], fn).collect()
        assert len(got) == 5 and {r.value for r in got} == {want}
    # an instant vector's elements meet at its evaluation time, whatever their samples' times
    v = mt.instant(_constant_rate(spark).unionByName(_constant_rate(spark, "b").where("ts < '2024-01-01 00:03:00'")),
                   "2024-01-01 01:00:00", lookback_s=None)
    assert [r.value for r in mt.aggregate_by(v, [], "count").collect()] == [2.0]
    assert mt.range_query(_constant_rate(spark), "2024-01-01 00:00:00", "2024-01-01 00:05:00", 60) \
        .transform(lambda x: mt.aggregate_by(x, [], "sum")).count() == 6


def test_matching_is_aligned_in_time(spark):
    steps = mt.Steps("2024-01-01 00:02:00", "2024-01-01 00:05:00", 60)
    v = mt.instant(_constant_rate(spark, "ab"), lookback_s=60, steps=steps)
    a, b = v.where("labels = 's=\"a\"'"), v.where("labels = 's=\"b\"' AND ts <> '2024-01-01 00:04:00'")
    got = mt.metric_binary_op(a, b, "-", on=[]).collect()
    assert len(got) == 3 and {r.value for r in got} == {0.0}
    with pytest.raises(Exception, match="several right-hand series"):
        mt.metric_binary_op(a, v, "-", on=[]).collect()
    info = mt.aggregate_by(v, ["s"], "count").withColumn("label_map", F.create_map(F.lit("s"), F.lit("a"), F.lit("zone"), F.lit("z1"))) \
        .where("labels = 's=\"a\"'")
    out = mt.metric_binary_op(a, info, "*", on=["s"], group_left=["zone"]).collect()
    assert len(out) == 4 and {r.labels for r in out} == {'s="a",zone="z1"'} and all(r.label_map["zone"] == "z1" for r in out)
    total = mt.scalar_steps(mt.aggregate_by(v, [], "sum"))
    share = mt.by_scalar(a, "/", total).collect()
    assert len(share) == 4 and {r.value for r in share} == {0.5}
    assert all(r.value != r.value for r in mt.by_scalar(a, "/", mt.scalar_steps(v)).collect())      # two elements: NaN
    with pytest.raises(ValueError):
        mt.instant(a, lookback_s=None, steps=steps)


@pytest.mark.parametrize("window,bucket", [(1800, HOUR_US), (7200, HOUR_US), (10_000, HOUR_US), (3 * 86_400, HOUR_US)])
def test_windows_of_any_length_and_rows_at_one_time(spark, window, bucket):
    """Windows shorter and longer than a bucket, several samples at one time, repeated rows."""
    rng = np.random.default_rng(11)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for s in range(2):
        for _ in range(150):
            t = t0 + dt.timedelta(seconds=int(rng.integers(0, 200)) * 1800 // (1 + s * 3))
            rows.append(("m", {"s": str(s)}, t, float(rng.integers(0, 5))))
    rows += rows[::7]
    m = mt.normalize(spark.createDataFrame(rows, "name string, labels map<string,string>, ts timestamp_ntz, value double"))
    got_rate = sorted((r["labels"], r["ts"], r["value"]) for r in mt.rate(m, window, bucket_us=bucket).fillna(-1.0, ["value"]).collect())
    got_chg = sorted((r["labels"], r["ts"], r["value"]) for r in mt.changes(m, window, bucket_us=bucket).collect())
    want_rate, want_chg = [], []
    for s, pts in _brute_by_series(rows).items():
        for t, _ in pts:
            at = [j for j, (u, _) in enumerate(pts) if t - dt.timedelta(seconds=window) < u <= t]
            inc = sum(pts[j][1] - pts[j - 1][1] if pts[j][1] >= pts[j - 1][1] else pts[j][1] for j in at if j)
            step = sum((pts[j][0] - pts[j - 1][0]).total_seconds() for j in at if j)
            want_rate.append((f's="{s}"', t, round(inc / step, 6) if step > 0 else -1.0))
            want_chg.append((f's="{s}"', t, float(sum(pts[j][1] != pts[j - 1][1] for j in at[1:]))))
    assert [x[:2] for x in got_rate] == [x[:2] for x in sorted(want_rate)]
    assert [x[2] for x in got_rate] == pytest.approx([x[2] for x in sorted(want_rate)], abs=2e-6)
    assert got_chg == sorted(want_chg)


def test_range_windows_are_running_aggregates(spark):
    """No frame that moves along with the row: its work would grow with the samples in a window."""
    m, _ = _samples(spark, n=5)
    for v in (mt.rate(m, 864_000), mt.rate(m, 3600), mt.changes(m, 3600)):
        plan = v._jdf.queryExecution().optimizedPlan().toString()
        frames = [line for line in plan.splitlines() if "specifiedwindowframe(RangeFrame" in line and "t_us" in line]
        assert frames and all("RangeFrame, unboundedpreceding$()" in f for f in frames)
