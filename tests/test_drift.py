"""Drift scores against brute force on small samples, and invariants."""
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.operators import drift as drf
from tripflow.plans import partitioning as part


def _brute(ref, cur):
    vals = sorted(set(ref) | set(cur))
    r, c = np.array(sorted(ref)), np.array(sorted(cur))
    fr = np.searchsorted(r, vals, side="right") / len(r)
    fc = np.searchsorted(c, vals, side="right") / len(c)
    d = float(np.max(np.abs(fr - fc)))
    w = float(np.sum(np.abs(fr - fc)[:-1] * np.diff(vals)))
    return d, w, w / float(np.std(r))


def _frames(spark, ref, cur):
    a = spark.createDataFrame([(float(x),) for x in ref], "x double")
    b = spark.createDataFrame([(float(x),) for x in cur], "x double")
    return a, b


def test_ks_and_wasserstein_match_brute_force(spark):
    rng = np.random.default_rng(7)
    ref = np.round(rng.normal(10, 3, 3000), 2)
    cur = np.round(rng.normal(11, 3, 2000), 2)
    a, b = _frames(spark, ref, cur)
    r = drf.cdf_scores(a, b, ["x"], ranges=7).collect()[0]
    d, w, wn = _brute(ref, cur)
    assert r["ks_stat"] == pytest.approx(d, abs=1e-12)
    assert r["wasserstein"] == pytest.approx(w, rel=1e-9)
    assert r["wasserstein_normed"] == pytest.approx(wn, rel=1e-9)
    assert 0 <= r["ks_pvalue"] < 1e-3


def test_self_drift_is_zero(spark):
    x = [1, 2, 2, 3, 5, 8, 8, 8]
    a, _ = _frames(spark, x, x)
    r = drf.cdf_scores(a, a, ["x"]).collect()[0]
    assert r["ks_stat"] == 0 and r["wasserstein"] == 0 and r["ks_pvalue"] == 1.0
    c = drf.category_scores(a, a, ["x"]).collect()[0]
    assert c["js"] == 0 and c["chi2_stat"] == 0


def test_js_and_chi2_brute_force(spark):
    ref = [0] * 50 + [1] * 30 + [2] * 20
    cur = [0] * 10 + [1] * 30 + [3] * 60
    a, b = _frames(spark, ref, cur)
    r = drf.category_scores(a, b, ["x"]).collect()[0]
    p = np.array([0.5, 0.3, 0.2, 0.0]); q = np.array([0.1, 0.3, 0.0, 0.6]); m = (p + q) / 2
    kl = lambda u, v: sum(ui * math.log(ui / vi) for ui, vi in zip(u, v) if ui > 0)
    assert r["js"] == pytest.approx(math.sqrt(0.5 * (kl(p, m) + kl(q, m))), rel=1e-12)
    e = p[:3] * 100
    assert r["chi2_stat"] == float("inf") and r["chi2_dof"] == 3      # 3 is new: infinite evidence
    a, b = _frames(spark, ref, [0] * 10 + [1] * 30)
    r = drf.category_scores(a, b, ["x"]).collect()[0]
    e = p[:3] * 40
    assert r["chi2_stat"] == pytest.approx(float(np.sum((np.array([10, 30, 0]) - e) ** 2 / e)), rel=1e-12)
    assert r["chi2_dof"] == 2


def test_chi2_pvalue_known_values(spark):
    rows = [(3.841458820694124, 1, 0.05), (18.307038053275146, 10, 0.05), (0.0, 3, 1.0), (2.0, 2, math.exp(-1)),
            (float("inf"), 4, 0.0), (None, 4, None), (5.0, 0, 1.0), (1.0, 1, math.erfc(math.sqrt(0.5))),
            (50.0, 1, math.erfc(5.0)), (5000.0, 3, 0.0), (0.001, 1, math.erfc(math.sqrt(0.0005)))]
    # an even number of degrees is a finite sum: e^-x (1 + x + ... + x^(a-1) / (a-1)!)
    for a in (2, 7, 50, 400):
        for ratio in (0.3, 0.9, 1.0, 1.1, 1.6):
            x = a * ratio
            terms = [math.exp(k * math.log(x) - x - math.lgamma(k + 1)) for k in range(a)]
            rows.append((2 * x, 2 * a, math.fsum(terms)))
    df = spark.createDataFrame([(k, s, d) for k, (s, d, _) in enumerate(rows)], "k int, s double, d int")
    got = df.select("k", drf.chi2_pvalue(F.col("s"), F.col("d")).alias("p")).orderBy("k").collect()
    for r, (s, d, want) in zip(got, rows):
        assert r.p == (None if want is None else pytest.approx(want, rel=1e-8, abs=1e-10)), (s, d)


def test_counts_of_parts_add_up(spark):
    rng = np.random.default_rng(1)
    rows = [(f"d{int(rng.integers(0, 4))}", float(rng.integers(0, 30)), int(rng.integers(0, 6))) for _ in range(600)]
    df = spark.createDataFrame(rows, "date string, x double, y int")
    ref, cur = df.where("date = 'd0'"), df.where("date <> 'd0'")
    methods = {"x": "ks", "y": "chi2"}
    want = drf.drift_report(ref, cur, ["x", "y"], methods)
    counts = drf.drift_counts(df, ["x", "y"], by=("date",))
    got = drf.report_from_counts(counts.where("date = 'd0'"), counts.where("date <> 'd0'"), ["x", "y"], methods)
    assert sorted(got.collect()) == sorted(want.collect()) and want.count() == 2
    assert drf.report_from_counts(counts, counts.limit(0), ["x", "y"], methods).count() == 0


def test_reports_of_all_sorts(spark):
    docs = [(1, None), (2, "{"), (3, "[]"), (4, '{"metrics":[]}'), (5, '{"metrics":"x"}'), (6, '{"metrics":[1,null,{"config":5}]}'),
            (7, '{"metrics":[{"config":{"type":"DriftedColumnsCount"},"value":{"count":"2"}}]}'),
            (8, '{"metrics":[{"config":{"type":"ValueDrift"},"value":null},{"config":{"type":"ValueDrift"},"value":"0.01"}]}')]
    out = drf.parse_drift_report(spark.createDataFrame(docs, "id int, report string"), keep=("id",)).collect()
    got = {r.id: (r.status, r.number_of_drifted_columns, r.drift_share, r.number_of_columns, r.flagged_columns, r.dataset_drift) for r in out}
    gone = (None,) * 5
    assert len(out) == 8 and got == {
        1: ("unparsable", *gone), 2: ("unparsable", *gone), 3: ("no_metrics", *gone), 4: ("no_metrics", *gone), 5: ("no_metrics", *gone),
        6: ("ok", None, None, 0, 0, None), 7: ("ok", 2, None, 0, 0, None), 8: ("ok", None, None, 2, 1, None)}


def test_prefix_sums_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [("a" if i % 3 else "b", float(v), int(c)) for i, (v, c) in
            enumerate(zip(rng.permutation(2000), rng.integers(0, 5, 2000)))]
    df = spark.createDataFrame(rows, "g string, v double, c bigint")
    out = part.prefix_sums(df, ["g"], "v", ["c"], ranges=9, with_next=True).collect()
    for g in ("a", "b"):
        mine = sorted((r["v"], r["cum_c"], r["next_v"]) for r in out if r["g"] == g)
        src = sorted((v, c) for gg, v, c in rows if gg == g)
        cum = np.cumsum([c for _, c in src])
        nxt = [v for v, _ in src[1:]] + [None]
        assert [m[1] for m in mine] == list(cum)
        assert [m[2] for m in mine] == nxt


def test_report_directions_and_min_rows(spark):
    a, b = _frames(spark, list(range(200)), list(range(100, 300)))
    rep = {r["feature"]: r for r in drf.drift_report(a, b, ["x"], method="wasserstein").collect()}
    assert rep["x"]["drifted"] and rep["x"]["score"] >= 0.1
    rep = {r["feature"]: r for r in drf.drift_report(a, b, ["x"], method="ks").collect()}
    assert rep["x"]["drifted"] and rep["x"]["score"] < 0.05
    small = b.limit(50)
    assert drf.drift_report(a, small, ["x"]).count() == 0


def test_retrain_modes(spark):
    h = spark.createDataFrame([(1, 0.2), (2, 0.6), (3, 0.7), (4, 0.1), (5, 0.5)], "period int, drift_share double")
    lvl = [r["retrain"] for r in drf.retrain_decisions(h, mode="level").orderBy("period").collect()]
    edge = [r["retrain"] for r in drf.retrain_decisions(h, mode="edge").orderBy("period").collect()]
    assert lvl == [False, True, True, False, True]
    assert edge == [False, True, False, False, True]
    runs = [r["run_number"] for r in drf.retrain_decisions(h).orderBy("period").collect()]
    assert runs == [0, 1, 2, 2, 3]


def test_prefix_sums_without_groups_matches(spark):
    df = spark.createDataFrame([(float(v), 1) for v in range(500)], "v double, c bigint")
    a = part.prefix_sums(df, [], "v", ["c"], ranges=5).orderBy("v").collect()
    b = part.prefix_sums(df, [], "v", ["c"]).orderBy("v").collect()
    assert [r["cum_c"] for r in a] == list(range(1, 501)) == [r["cum_c"] for r in b]


def test_retrain_poll_interval_counts_polls(spark):
    h = spark.createDataFrame([("2024-01-01 00:00:00", 0.6), ("2024-01-01 00:20:00", 0.7),
                               ("2024-01-01 00:30:00", 0.1), ("2024-01-01 01:00:00", 0.9)],
                              "period string, drift_share double")
    out = drf.retrain_decisions(h, poll_interval_s=300).orderBy("period").collect()
    assert [r["requests"] for r in out] == [4, 2, 0, 1]
    assert [r["run_number"] for r in out] == [4, 6, 6, 7]


def test_constant_reference_and_new_category_are_drift(spark):
    ref = spark.createDataFrame([(1.0,)] * 200, "a double")
    cur = spark.createDataFrame([(50.0,)] * 200, "a double")
    for method in ("wasserstein", "chi2", "js", "ks"):
        row = drf.drift_report(ref, cur, ["a"], method).collect()[0]
        assert row["score"] is not None and row["drifted"], method


def test_too_few_rows_are_unknown_not_no_drift(spark):
    few = spark.createDataFrame([(1.0,)] * 5, "a double")
    row = drf.drift_summary(drf.drift_report(few, few, ["a"], "js")).collect()[0]
    assert row["number_of_columns"] == 0 and row["drift_share"] is None and row["retrain"] is None


@pytest.mark.parametrize("repeated", [False, True])
def test_values_of_one_feature_never_meet_in_one_task(spark, repeated):
    """Cut points and offsets are broadcast: nothing is shuffled by the group
    alone, and the default ranges are exact whatever the values."""
    df = spark.range(20_000).select(F.lit("a").alias("g"), (F.pow(F.col("id"), 2) if repeated else F.col("id") * 1.0).alias("v"),
                                    F.lit(2).cast("long").alias("c"))
    if repeated:
        df = df.unionByName(df.select(F.lit("b").alias("g"), (-F.col("v")).alias("v"), "c"))
    out = part.prefix_sums(part.reliable_checkpoint(df), ["g"], "v", ["c"], with_next=True)
    joins = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
    assert joins and all("BroadcastHashJoin" in j for j in joins)
    for _, rows in itertools.groupby(sorted(out.collect(), key=lambda r: (r["g"], r["v"])), key=lambda r: r["g"]):
        rows = list(rows)
        assert [r["cum_c"] for r in rows] == list(range(2, 2 * len(rows) + 2, 2))
        assert [r["next_v"] for r in rows] == [r["v"] for r in rows[1:]] + [None]


def test_counts_are_added_up_in_one_deal(spark):
    """Stored counts with several rows a value, and values of one side only; a
    task adds up its own share of the values, however few partitions a shuffle has."""
    n = 20_000
    ref = spark.range(2 * n).selectExpr("'x' AS feature", f"CAST(id % {n} AS double) AS value", "1L AS n")
    cur = spark.range(n).selectExpr("'x' AS feature", f"CAST(id + {n // 2} AS double) AS value", "3L AS n")
    both = drf.add_counts(ref, cur)
    assert both.rdd.getNumPartitions() == drf.COUNT_PARTITIONS
    most = both.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most < 5 * 1.5 * n / drf.COUNT_PARTITIONS
    got = both.groupBy("c_ref", "c_cur").count().collect()
    assert sorted(map(tuple, got)) == [(0, 3, n // 2), (2, 0, n // 2), (2, 3, n // 2)]
    # the running sums over their ranges are dealt out likewise
    sums = part.prefix_sums(part.reliable_checkpoint(both), ["feature"], "value", ["c_ref"])
    most = sums.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most < 10 * 1.5 * n / part.RANGE_TASKS
