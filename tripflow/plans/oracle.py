"""DuckDB SQL twins of the registered queries (the correctness oracle).

The driver registers the driver tables as DuckDB views; the fixtures are
rebuilt here as CTEs from their SQL twins. Types are cast to the Spark
result types (INTEGER for hour/day/month, BIGINT for sums).
"""

from __future__ import annotations

from tripflow.sources.fixtures import FOREIGN_REPORTS_SQL, METRICS_EVENTS_SQL, TRIPS_EVENTS_SQL, TRIPS_LINEITEM_SQL

ORACLE: dict[str, str] = {}

RAW = f"raw AS ({TRIPS_LINEITEM_SQL})"
STREAM = f"stream AS ({TRIPS_EVENTS_SQL})"
METRICS = f"metrics AS ({METRICS_EVENTS_SQL})"


def _clean(src: str, name: str, zone_filter: bool = True) -> str:
    zone = ("AND pickup_zone_id BETWEEN 1 AND 263 AND dropoff_zone_id BETWEEN 1 AND 263"
            if zone_filter else "")
    return f"""{name} AS (
  SELECT * FROM (
    SELECT PULocationID AS pickup_zone_id, DOLocationID AS dropoff_zone_id, trip_distance,
           CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
           CAST((dayofweek(tpep_pickup_datetime) + 6) % 7 AS INTEGER) AS pickup_day_of_week,
           CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
           passenger_count,
           epoch(tpep_dropoff_datetime - tpep_pickup_datetime) / 60.0 AS duration_min,
           total_amount, trip_key
    FROM {src}) t
  WHERE trip_distance > 0 AND trip_distance < 100
    AND total_amount >= 1 AND total_amount <= 500
    AND duration_min >= 1 AND duration_min <= 180
    {zone}
    AND passenger_count BETWEEN 0 AND 9
    AND trip_key IS NOT NULL)"""


def _zone_stats(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT PULocationID AS zone_id,
         round(avg(total_amount), 2) AS zone_avg_fare,
         round(avg(epoch(tpep_dropoff_datetime - tpep_pickup_datetime) / 60.0), 2) AS zone_avg_duration_min,
         round(avg(trip_distance), 2) AS zone_avg_distance,
         count(*) AS zone_trip_count,
         CAST(CAST(max(tpep_pickup_datetime) AS DATE) AS TIMESTAMP) AS event_timestamp
  FROM {src}
  WHERE trip_distance > 0 AND trip_distance < 100
    AND total_amount > 0 AND total_amount < 500
    AND PULocationID BETWEEN 1 AND 263
    AND epoch(tpep_dropoff_datetime - tpep_pickup_datetime) / 60.0 BETWEEN 1 AND 180
  GROUP BY PULocationID)"""


def _demand(src: str, name: str, keep_date: bool = False) -> str:
    date_col = ", pickup_date" if keep_date else ""
    return f"""{name} AS (
  SELECT zone_id, pickup_hour,
         CAST((dayofweek(pickup_date) + 6) % 7 AS INTEGER) AS day_of_week,
         CAST(month(pickup_date) AS INTEGER) AS month, trip_count{date_col}
  FROM (SELECT PULocationID AS zone_id, CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
               CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour, count(*) AS trip_count
        FROM {src} WHERE PULocationID BETWEEN 1 AND 263
        GROUP BY ALL) a)"""


SPLIT_BUCKET = "CAST(('0x' || substr(md5('42|' || trip_key), 1, 8))::BIGINT % 100 AS INTEGER)"
SILVER = f"""silver AS (
  SELECT *, CASE WHEN {SPLIT_BUCKET} < 20 THEN 'test' ELSE 'train' END AS split FROM clean)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE["zone_stats"] = with_(RAW, _zone_stats("raw", "zs")) + "SELECT * FROM zs ORDER BY zone_id"

ORACLE["zone_stats_global_ts"] = with_(RAW, _zone_stats("raw", "zs")) + """
SELECT zone_id, zone_avg_fare, zone_avg_duration_min, zone_avg_distance, zone_trip_count,
       max(event_timestamp) OVER () AS event_timestamp FROM zs ORDER BY zone_id"""

ORACLE["clean_trips"] = with_(RAW, _clean("raw", "clean")) + "SELECT * FROM clean"

ORACLE["clean_trips_combined"] = with_(
    RAW, STREAM,
    "src AS (SELECT *, NULL::VARCHAR AS date FROM raw UNION ALL SELECT * FROM stream)",
    _clean("src", "clean")) + "SELECT * FROM clean"

_CLEAN_COLUMNS = """pickup_zone_id, dropoff_zone_id, trip_distance, pickup_hour, pickup_day_of_week, pickup_month,
       passenger_count, duration_min, total_amount"""

ORACLE["clean_trips_bronze_columns"] = with_(
    RAW, STREAM,
    "src AS (SELECT * FROM raw UNION ALL SELECT * EXCLUDE (date) FROM stream)",
    _clean("src", "clean")) + f"SELECT {_CLEAN_COLUMNS} FROM clean"

ORACLE["clean_trips_no_passengers"] = with_(
    RAW, "src AS (SELECT * REPLACE (0 AS passenger_count) FROM raw)", _clean("src", "clean")) + \
    "SELECT * REPLACE (CAST(NULL AS INTEGER) AS passenger_count) FROM clean"

ORACLE["outlier_report"] = with_(RAW, """b AS (
  SELECT *, epoch(tpep_dropoff_datetime - tpep_pickup_datetime) / 60.0 AS d,
         coalesce(trip_distance > 0 AND trip_distance < 100, false) AS r_distance,
         coalesce(total_amount BETWEEN 1 AND 500, false) AS r_amount,
         coalesce(epoch(tpep_dropoff_datetime - tpep_pickup_datetime) / 60.0 BETWEEN 1 AND 180, false) AS r_duration,
         coalesce(PULocationID BETWEEN 1 AND 263, false) AS r_pu,
         coalesce(DOLocationID BETWEEN 1 AND 263, false) AS r_do,
         coalesce(passenger_count BETWEEN 0 AND 9, false) AS r_pass
  FROM raw)""") + """
SELECT count(*) AS rows_before,
       count(*) FILTER (WHERE r_distance AND r_amount AND r_duration AND r_pu AND r_do AND r_pass) AS rows_after,
       count(*) FILTER (WHERE NOT r_distance) AS distance_violations,
       count(*) FILTER (WHERE NOT r_amount) AS amount_violations,
       count(*) FILTER (WHERE NOT r_duration) AS duration_violations,
       count(*) FILTER (WHERE NOT r_pu) AS pickup_zone_violations,
       count(*) FILTER (WHERE NOT r_do) AS dropoff_zone_violations,
       count(*) FILTER (WHERE NOT r_pass) AS passengers_violations,
       round(CASE WHEN count(*) > 0 THEN (count(*) - count(*) FILTER (WHERE r_distance AND r_amount
             AND r_duration AND r_pu AND r_do AND r_pass)) * 100.0 / count(*) END, 4) AS pct_removed
FROM b"""

ORACLE["demand"] = with_(RAW, _demand("raw", "d")) + "SELECT * FROM d"

ORACLE["demand_merged"] = with_(RAW, STREAM, _demand("raw", "d1"), _demand("stream", "d2")) + """
SELECT zone_id, pickup_hour, day_of_week, month, CAST(sum(trip_count) AS BIGINT) AS trip_count
FROM (SELECT * FROM d1 UNION ALL SELECT * FROM d2) u GROUP BY ALL"""

ORACLE["demand_merged_by_date"] = with_(
    RAW, STREAM, _demand("raw", "d1", True), _demand("stream", "d2", True)) + """
SELECT zone_id, pickup_date, pickup_hour, day_of_week, month, CAST(sum(trip_count) AS BIGINT) AS trip_count
FROM (SELECT * FROM d1 UNION ALL SELECT * FROM d2) u GROUP BY ALL"""

ORACLE["hour_slice"] = with_(STREAM) + """
SELECT * REPLACE ('2024-01-15' AS date) FROM stream
WHERE tpep_pickup_datetime >= TIMESTAMP '2024-01-15 10:00:00'
  AND tpep_pickup_datetime < TIMESTAMP '2024-01-15 11:00:00' AND date = '2024-01-15'"""

ORACLE["enrich_trips"] = with_(RAW, _clean("raw", "clean"), SILVER, _zone_stats("raw", "zs")) + """
SELECT s.*,
       coalesce(pu.zone_avg_fare, 0) AS pu_zone_avg_fare,
       coalesce(pu.zone_avg_duration_min, 0) AS pu_zone_avg_duration_min,
       coalesce(pu.zone_avg_distance, 0) AS pu_zone_avg_distance,
       coalesce(dz.zone_avg_fare, 0) AS do_zone_avg_fare,
       coalesce(dz.zone_avg_duration_min, 0) AS do_zone_avg_duration_min,
       coalesce(dz.zone_avg_distance, 0) AS do_zone_avg_distance
FROM silver s LEFT JOIN zs pu ON s.pickup_zone_id = pu.zone_id
              LEFT JOIN zs dz ON s.dropoff_zone_id = dz.zone_id"""

ORACLE["enrich_demand"] = with_(RAW, _demand("raw", "d"), _zone_stats("raw", "zs")) + """
SELECT d.*,
       coalesce(z.zone_avg_fare, 0) AS zone_avg_fare,
       coalesce(z.zone_avg_duration_min, 0) AS zone_avg_duration_min,
       coalesce(z.zone_avg_distance, 0) AS zone_avg_distance,
       coalesce(z.zone_trip_count, 0) AS zone_trip_count
FROM d LEFT JOIN zs z ON d.zone_id = z.zone_id"""

_SPLIT_SUMMARY = """
SELECT split, count(*) AS rows, CAST(sum(pickup_zone_id) AS BIGINT) AS zone_sum,
       CAST(sum(pickup_hour) AS BIGINT) AS hour_sum
FROM {src} GROUP BY split"""

ORACLE["hash_split_counts"] = with_(RAW, _clean("raw", "clean"), SILVER) + \
    _SPLIT_SUMMARY.format(src="silver")

ORACLE["exact_split"] = with_(RAW, _clean("raw", "clean"), """ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('42|' || trip_key), trip_key) AS rn,
         count(*) OVER () AS n FROM clean)""", """labelled AS (
  SELECT *, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM ranked)""") + \
    _SPLIT_SUMMARY.format(src="labelled")

ORACLE["sample_rows"] = with_(RAW, _clean("raw", "clean")) + """
SELECT * FROM clean ORDER BY md5('42|' || trip_key), trip_key LIMIT 1000"""

ORACLE["sample_rows_before_filter"] = with_(RAW, _clean("raw", "clean")) + """
SELECT * FROM (SELECT * FROM clean ORDER BY md5('42|' || trip_key), trip_key LIMIT 1000) s
WHERE pickup_hour < 12"""


# ---- data quality ------------------------------------------------------------

from tripflow.operators.quality import RULES  # noqa: E402

ZS = _zone_stats("raw", "zs")
SILVER_DEMAND = _demand("raw", "dd", keep_date=True).replace("dd AS (", "dd0 AS (", 1) + """,
silver_demand AS (
  SELECT zone_id, pickup_hour, day_of_week, month, trip_count,
         CASE WHEN CAST(('0x' || substr(md5('42|' || concat_ws('|', zone_id, pickup_date, pickup_hour)), 1, 8))::BIGINT % 100 AS INTEGER) < 20
              THEN 'test' ELSE 'train' END AS split
  FROM dd0)"""
QUALITY_SOURCES = {
    "bronze_raw": ([RAW], "raw", {}),
    "bronze_streaming": ([STREAM], "stream", {}),
    "silver_trips": ([RAW, _clean("raw", "clean"), SILVER], "silver", {}),
    "silver_demand": ([RAW, SILVER_DEMAND], "silver_demand", {}),
    "gold_zone_stats": ([RAW, ZS], "zs", {}),
}
DOUBLE_COLS = {"trip_distance", "total_amount", "duration_min", "zone_avg_fare",
               "zone_avg_duration_min", "zone_avg_distance"}


def _rule_text(rules):
    parts = []
    if not rules.get("nullable", True):
        parts.append("not_null")
    if rules.get("unique"):
        parts.append("unique")
    if "min" in rules or "max" in rules:
        parts.append(f"range[{rules.get('min', '')},{rules.get('max', '')}]")
    return ",".join(parts) or "present"


def _quality_sql(table):
    ctes, src, _ = QUALITY_SOURCES[table]
    spec = RULES[table]
    sel = [f"""SELECT '{table}' AS "table", 'row_count' AS "check", NULL::VARCHAR AS "column",
       '>={spec['min_rows']}' AS rule, count(*) AS observed, count(*) >= {spec['min_rows']} AS passed FROM {src}"""]
    for c, r in spec["columns"].items():
        conds = []
        if not r.get("nullable", True):
            conds.append(f'"{c}" IS NULL' + (f' OR isnan("{c}")' if c in DOUBLE_COLS else ""))
        if "min" in r:
            conds.append(f'"{c}" < {r["min"]}')
        if "max" in r:
            conds.append(f'"{c}" > {r["max"]}')
        v = f"count(*) FILTER (WHERE {' OR '.join(conds)})" if conds else "CAST(0 AS BIGINT)"
        if r.get("unique"):
            dup = f"""(SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM
                      (SELECT count(*) AS n FROM {src} GROUP BY "{c}" HAVING count(*) > 1) g)"""
            sel.append(f"""SELECT '{table}', 'column', '{c}', '{_rule_text(r)}', {v} + {dup},
       {v} = 0 AND {dup} = 0 FROM {src}""")
        else:
            sel.append(f"""SELECT '{table}', 'column', '{c}', '{_rule_text(r)}', {v}, {v} = 0 FROM {src}""")
    return ctes, "\nUNION ALL\n".join(sel)


for _t in RULES:
    _c, _s = _quality_sql(_t)
    ORACLE[f"quality_{_t}"] = with_(*_c) + _s


def _quality_union():
    ctes = [RAW, STREAM, _clean("raw", "clean"), SILVER, SILVER_DEMAND, ZS]
    body = []
    for t in RULES:
        body.append(f"q_{t} AS ({_quality_sql(t)[1]})")
    return with_(*ctes, *body, "allq AS (" + " UNION ALL ".join(f"SELECT * FROM q_{t}" for t in RULES) + ")")


ORACLE["quality_summary"] = _quality_union() + """
SELECT "table", bool_and(passed) AS success, count(*) AS total_checks,
       count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed,
       max(CASE WHEN "check" = 'row_count' THEN observed END) AS rows
FROM allq GROUP BY "table" """

ORACLE["duplicate_count"] = with_(RAW) + """
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows, count(*) AS duplicate_groups
FROM (SELECT count(*) AS n FROM raw GROUP BY PULocationID, DOLocationID, tpep_pickup_datetime
      HAVING count(*) > 1) g"""

_STAT_COLS = ["pickup_zone_id", "dropoff_zone_id", "trip_distance", "pickup_hour",
              "pickup_day_of_week", "pickup_month", "passenger_count", "duration_min", "total_amount"]
ORACLE["column_stats"] = with_(RAW, _clean("raw", "clean"), SILVER) + "\nUNION ALL\n".join(
    f"""SELECT 'silver_trips' AS "table", '{c}' AS "column", round(avg(CAST({c} AS DOUBLE)), 4) AS mean,
       round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std FROM silver""" for c in _STAT_COLS)

ORACLE["column_means_by_day"] = with_(STREAM) + "\nUNION ALL\n".join(
    f"""SELECT 'bronze_streaming' AS "table", date AS period, '{c}' AS "column", round(avg(CAST({c} AS DOUBLE)), 6) AS mean,
       round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std FROM stream GROUP BY date"""
    for c in ("trip_distance", "passenger_count", "total_amount"))

ORACLE["freshness"] = with_(RAW, STREAM, ZS, """u AS (
  SELECT 'bronze_raw' AS "table", max(tpep_pickup_datetime) AS last_update FROM raw
  UNION ALL SELECT 'bronze_streaming', max(tpep_pickup_datetime) FROM stream
  UNION ALL SELECT 'gold_zone_stats', max(event_timestamp) FROM zs)""", """a AS (
  SELECT *, (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(last_update)) // 1000000 AS age_seconds,
         CAST(CASE "table" WHEN 'bronze_raw' THEN 86400 WHEN 'bronze_streaming' THEN 600
              WHEN 'silver_trips' THEN 3600 WHEN 'silver_demand' THEN 3600
              WHEN 'gold_zone_stats' THEN 86400 END AS BIGINT) AS sla_seconds FROM u)""") + """
SELECT "table", last_update, age_seconds, sla_seconds, age_seconds <= sla_seconds AS within_sla,
       CASE WHEN age_seconds >= 600 THEN 'red' WHEN age_seconds >= 300 THEN 'yellow' ELSE 'green' END AS level,
       TIMESTAMP '2024-02-01 00:00:00' AS as_of
FROM a"""


# ---- drift -------------------------------------------------------------------

FEATS = ["trip_distance", "pickup_hour", "pickup_day_of_week", "pickup_month", "passenger_count"]
DISC = ["pickup_hour", "pickup_day_of_week", "pickup_month", "passenger_count"]
REF = """ref AS (
  SELECT trip_distance, pickup_hour, pickup_day_of_week, pickup_month, passenger_count FROM silver
  WHERE split = 'train' AND trip_distance > 0 AND trip_distance < 100
    AND passenger_count BETWEEN 0 AND 9)"""
CUR = """cur AS (
  SELECT * FROM (
    SELECT trip_distance, CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
           CAST((dayofweek(tpep_pickup_datetime) + 6) % 7 AS INTEGER) AS pickup_day_of_week,
           CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month, passenger_count, date
    FROM stream WHERE PULocationID BETWEEN 1 AND 263) s
  WHERE trip_distance > 0 AND trip_distance < 100 AND passenger_count BETWEEN 0 AND 9
    AND trip_distance IS NOT NULL AND pickup_hour IS NOT NULL AND date IS NOT NULL)"""


def _long(src, name, cols, extra=""):
    return f"{name} AS (" + " UNION ALL ".join(
        f"SELECT {extra}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src} WHERE {c} IS NOT NULL"
        for c in cols) + ")"


def _vc(cols):
    return [_long("ref", "rl", cols), _long("cur", "cl", cols), """vc AS (
  SELECT feature, value, coalesce(r.c, 0) AS c_ref, coalesce(k.c, 0) AS c_cur
  FROM (SELECT feature, value, count(*) AS c FROM rl GROUP BY ALL) r
  FULL OUTER JOIN (SELECT feature, value, count(*) AS c FROM cl GROUP BY ALL) k USING (feature, value))""",
            """tot AS (SELECT feature, CAST(sum(c_ref) AS BIGINT) AS n_ref,
                        CAST(sum(c_cur) AS BIGINT) AS n_cur FROM vc GROUP BY feature)"""]


DRIFT_BASE = [RAW, STREAM, _clean("raw", "clean"), SILVER, REF, CUR]
CDF = """cdf AS (
  SELECT vc.feature, value, n_ref, n_cur,
         abs(sum(c_ref) OVER w / n_ref - sum(c_cur) OVER w / n_cur) AS gap,
         coalesce(lead(value) OVER w2 - value, 0) AS step
  FROM vc JOIN tot USING (feature)
  WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING),
         w2 AS (PARTITION BY feature ORDER BY value))"""
KS = """ks AS (
  SELECT feature, n_ref, n_cur, max(gap) AS d, sum(gap * step) AS w1,
         max(gap) * sqrt(n_ref * n_cur / (n_ref + n_cur)) AS lam
  FROM cdf GROUP BY feature, n_ref, n_cur)"""

ORACLE["drift_ks"] = with_(*DRIFT_BASE, *_vc(FEATS), CDF, KS) + """
SELECT feature, n_ref, n_cur, round(d, 6) AS ks_stat,
       round(CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(
             list_transform(range(1, 101), lambda k: pow(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam))))) END, 6)
       AS ks_pvalue
FROM ks"""

ORACLE["drift_wasserstein"] = with_(*DRIFT_BASE, *_vc(FEATS), CDF, KS,
                                    "sd AS (SELECT feature, stddev_pop(value) AS s FROM rl GROUP BY feature)") + """
SELECT feature, round(w1, 6) AS wasserstein,
       round(w1 / greatest(s, 0.001), 6) AS wasserstein_normed
FROM ks JOIN sd USING (feature)"""

CAT = """cat AS (
  SELECT feature, n_ref, n_cur,
         sqrt(greatest(0.0, 0.5 * sum(
           CASE WHEN c_ref > 0 THEN (c_ref / n_ref) * ln((c_ref / n_ref) / ((c_ref / n_ref + c_cur / n_cur) / 2)) ELSE 0 END
         + CASE WHEN c_cur > 0 THEN (c_cur / n_cur) * ln((c_cur / n_cur) / ((c_ref / n_ref + c_cur / n_cur) / 2)) ELSE 0 END))) AS js,
         sum(CASE WHEN c_ref > 0 THEN pow(c_cur - (c_ref / n_ref) * n_cur, 2) / ((c_ref / n_ref) * n_cur)
                  WHEN c_cur > 0 THEN CAST('Infinity' AS DOUBLE) END) AS chi2_stat,
         count(*) - 1 AS chi2_dof
  FROM vc JOIN tot USING (feature) GROUP BY feature, n_ref, n_cur)"""

ORACLE["drift_js"] = with_(*DRIFT_BASE, *_vc(DISC), CAT) + \
    "SELECT feature, n_ref, n_cur, round(js, 6) AS js FROM cat"

ORACLE["drift_chi2_stat"] = with_(*DRIFT_BASE, *_vc(DISC), CAT) + \
    "SELECT feature, round(chi2_stat, 4) AS chi2_stat, chi2_dof FROM cat"

ORACLE["drift_summary"] = with_(*DRIFT_BASE, *_vc(FEATS), CDF, KS,
                                "sd AS (SELECT feature, stddev_pop(value) AS s FROM rl GROUP BY feature)",
                                """rep AS (SELECT feature, w1 / s >= 0.1 AS drifted FROM ks JOIN sd USING (feature))""") + """
SELECT count(*) AS number_of_columns, count(*) FILTER (WHERE drifted) AS number_of_drifted_columns,
       round(avg(CAST(drifted AS DOUBLE)), 6) AS drift_share,
       round(avg(CAST(drifted AS DOUBLE)), 6) > 0.5 AS dataset_drift,
       round(avg(CAST(drifted AS DOUBLE)), 6) >= 0.5 AS retrain
FROM rep"""

BY_PERIOD = [*DRIFT_BASE, "refb AS (SELECT * REPLACE (floor(trip_distance) AS trip_distance) FROM ref)",
             "curb AS (SELECT * REPLACE (floor(trip_distance) AS trip_distance) FROM cur)",
             _long("refb", "rl", FEATS), _long("curb", "cl", FEATS, extra="date AS period, "),
             """refp AS (SELECT feature, value, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS p
                         FROM rl GROUP BY feature, value)""",
             """curq AS (SELECT period, feature, value,
                                count(*) / sum(count(*)) OVER (PARTITION BY period, feature) AS q
                         FROM cl GROUP BY period, feature, value)""",
             """jp AS (SELECT period, feature, q, coalesce(p, 0) AS p
                       FROM curq LEFT JOIN refp USING (feature, value))""",
             """bp AS (SELECT period, feature,
                  sqrt(greatest(0.0, 0.5 * (sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
                                               + q * ln(q / ((p + q) / 2)))
                                            + ln(2) * greatest(0.0, 1 - sum(p))))) AS js
                  FROM jp GROUP BY period, feature)"""]

ORACLE["drift_by_period"] = with_(*BY_PERIOD) + \
    "SELECT period, feature, round(js, 6) AS score, js >= 0.1 AS drifted FROM bp"

HIST = """hist AS (
  SELECT period, round(avg(CAST(js >= 0.1 AS DOUBLE)), 6) AS drift_share,
         count(*) FILTER (WHERE js >= 0.1) AS number_of_drifted_columns, count(*) AS number_of_columns
  FROM bp GROUP BY period)"""

ORACLE["retrain_decisions"] = with_(*BY_PERIOD, HIST) + """
SELECT *, drift_share >= 0.5 AS retrain,
       CAST(sum(CAST(drift_share >= 0.5 AS BIGINT)) OVER (ORDER BY period ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_number
FROM hist"""

ORACLE["retrain_decisions_edge"] = with_(*BY_PERIOD, HIST, """e AS (
  SELECT *, drift_share >= 0.5 AND coalesce(NOT (lag(drift_share >= 0.5) OVER (ORDER BY period)), true) AS retrain
  FROM hist)""") + """
SELECT *, CAST(sum(CAST(retrain AS BIGINT)) OVER (ORDER BY period ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_number
FROM e"""


# ---- metric time series --------------------------------------------------------

AS_OF = "TIMESTAMP '2024-01-20 12:00:00'"
INC = """inc AS (
  SELECT *, CASE WHEN pv IS NULL THEN NULL WHEN value >= pv THEN value - pv ELSE value END AS inc,
         CAST(t_us - pt AS DOUBLE) AS dt_us,
         CASE WHEN pv IS NULL THEN NULL ELSE CAST(value != pv AS INTEGER) END AS chg
  FROM (SELECT *, lag(value) OVER w AS pv, lag(t_us) OVER w AS pt FROM metrics
        WINDOW w AS (PARTITION BY name, labels ORDER BY t_us, value)) p)"""


def _instant(cond):
    return f"""inst AS (
  SELECT name, labels, u, ts, value FROM (
    SELECT *, row_number() OVER (PARTITION BY name, labels ORDER BY ts DESC, value DESC) AS rn
    FROM metrics WHERE {cond}) r WHERE rn = 1)"""


ORACLE["metrics_instant"] = with_(METRICS, _instant(f"ts <= {AS_OF}")) + \
    "SELECT name, labels, ts, value FROM inst"

ORACLE["metrics_instant_lookback"] = with_(
    METRICS, _instant(f"ts <= {AS_OF} AND ts > {AS_OF} - INTERVAL 6 HOUR")) + \
    "SELECT name, labels, ts, value FROM inst"

ORACLE["metrics_range"] = with_(METRICS, """b AS (
  SELECT *, CAST(ceil((t_us - epoch_us(TIMESTAMP '2024-01-10 00:00:00')) / 3600000000) AS BIGINT) * 3600000000
            + epoch_us(TIMESTAMP '2024-01-10 00:00:00') AS step_us
  FROM metrics
  WHERE t_us > epoch_us(TIMESTAMP '2024-01-10 00:00:00') - 3600000000
    AND t_us <= epoch_us(TIMESTAMP '2024-01-12 00:00:00'))""") + """
SELECT name, labels, make_timestamp(step_us) AS step_ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY name, labels, step_us ORDER BY t_us DESC, value DESC) AS rn FROM b) r
WHERE rn = 1"""

ORACLE["metrics_match"] = with_(METRICS) + """
SELECT name, labels, ts, value FROM metrics
WHERE regexp_full_match(name, 'view|click') AND u != '3'"""

ORACLE["metrics_rate"] = with_(METRICS, INC) + """
SELECT name, labels, ts,
       round(CASE WHEN sum(dt_us) OVER r > 0 THEN sum(inc) OVER r / (sum(dt_us) OVER r / 1e6) END, 6) AS rate
FROM inc WINDOW r AS (PARTITION BY name, labels ORDER BY t_us RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)"""

ORACLE["metrics_irate"] = with_(METRICS, INC) + """
SELECT name, labels, ts, round(CASE WHEN dt_us > 0 THEN inc / (dt_us / 1e6) END, 6) AS irate FROM inc"""

ORACLE["metrics_changes"] = with_(METRICS, INC) + """
SELECT name, labels, ts,
       CAST(sum(coalesce(chg, 0)) OVER r - first_value(coalesce(chg, 0)) OVER r AS BIGINT) AS changes
FROM inc WINDOW r AS (PARTITION BY name, labels ORDER BY t_us RANGE BETWEEN 1799999999 PRECEDING AND CURRENT ROW)"""

ORACLE["metrics_changed"] = with_(METRICS, INC) + """
SELECT * FROM (
  SELECT name, labels, ts, CAST(sum(coalesce(chg, 0)) OVER r - first_value(coalesce(chg, 0)) OVER r AS DOUBLE) AS value
  FROM inc WINDOW r AS (PARTITION BY name, labels ORDER BY t_us RANGE BETWEEN 1799999999 PRECEDING AND CURRENT ROW)) c
WHERE value > 0"""


def _rate_at(window_us: int) -> str:
    return f"""rates AS (
  SELECT name, labels, u, ts,
         round(CASE WHEN sum(dt_us) OVER r > 0 THEN sum(inc) OVER r / (sum(dt_us) OVER r / 1e6) END, 6) AS value
  FROM inc WINDOW r AS (PARTITION BY name, labels ORDER BY t_us RANGE BETWEEN {window_us - 1} PRECEDING AND CURRENT ROW)),
rate_at AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name, labels ORDER BY ts DESC, value DESC NULLS LAST) AS rn
                 FROM rates WHERE ts <= {AS_OF}) q WHERE rn = 1)"""


ORACLE["metrics_sum_rate"] = with_(METRICS, INC, _rate_at(3_600_000_000)) + \
    "SELECT u, round(sum(value), 6) AS value FROM rate_at GROUP BY u"

ORACLE["metrics_one_minus_avg_rate"] = with_(METRICS, INC, _rate_at(864_000_000_000)) + \
    "SELECT '' AS name, '' AS labels, round(1 - avg(value), 6) AS value FROM rate_at"

ORACLE["metrics_ratio_of_sums"] = with_(METRICS, _instant(f"ts <= {AS_OF}")) + """
SELECT u, round(sum(value) FILTER (WHERE name = 'view') / count(value), 6) AS value
FROM inst GROUP BY u HAVING count(*) FILTER (WHERE name = 'view') > 0"""

ORACLE["metrics_sum_by"] = with_(METRICS, _instant(f"ts <= {AS_OF}")) + \
    "SELECT u, sum(value) AS value FROM inst GROUP BY u"

ORACLE["metrics_binary_op"] = with_(METRICS, _instant(f"ts <= {AS_OF}")) + """
SELECT l.name, l.labels, round(CASE WHEN greatest(r.value, 1.0) != 0 THEN l.value / greatest(r.value, 1.0) END, 6) AS value
FROM (SELECT * FROM inst WHERE name = 'view') l JOIN (SELECT * FROM inst WHERE name = 'click') r ON l.u = r.u"""

# ---- range queries: every step joined with the samples of its window

def _grid(first: str, last: str, step: int) -> str:
    return (f"grid AS (SELECT unnest(generate_series(TIMESTAMP '{first}', TIMESTAMP '{last}', "
            f"INTERVAL {step} SECOND)) AS t)")


DAY_GRID = _grid("2024-01-15 00:00:00", "2024-01-16 00:00:00", 240)
WEEK_GRID = _grid("2024-01-13 00:00:00", "2024-01-20 00:00:00", 3600)


def _in_window(src: str, hours: int) -> str:
    return f"FROM {src} m JOIN grid ON m.ts <= t AND m.ts > t - INTERVAL {hours} HOUR"


NEAR_INC = """near AS (
  SELECT * REPLACE (CASE WHEN dt_us <= 2 * 86400 * 1e6 THEN inc END AS inc, CASE WHEN dt_us <= 2 * 86400 * 1e6 THEN dt_us END AS dt_us)
  FROM inc)"""
RATE_STEPS = f"""rate_steps AS (
  SELECT name, labels, u, t AS ts, round(sum(inc) / (sum(dt_us) / 1e6), 6) AS value
  {_in_window('near', 6)} GROUP BY name, labels, u, t HAVING sum(dt_us) > 0)"""
LAST_STEPS = """last_steps AS (
  SELECT name, labels, u, t AS ts, max((t_us, value))[2] AS value %s GROUP BY name, labels, u, t)"""
IRATE_STEPS = f"""two AS (SELECT name, labels, t, max((t_us, m.value, inc, dt_us)) AS s {_in_window('inc', 12)} GROUP BY name, labels, t),
irate_steps AS (
  SELECT name, labels, t AS ts, round(s[3] / (s[4] / 1e6), 6) AS value FROM two
  WHERE s[4] > 0 AND s[1] - s[4] > epoch_us(t - INTERVAL 12 HOUR))"""
_POINTS = "SELECT name, labels, ts, value FROM "

ORACLE["metrics_instant_steps"] = with_(METRICS, DAY_GRID, LAST_STEPS % _in_window("metrics", 3)) + _POINTS + "last_steps"

ORACLE["metrics_rate_steps"] = with_(METRICS, INC, NEAR_INC, DAY_GRID, RATE_STEPS) + _POINTS + "rate_steps"

ORACLE["metrics_irate_steps"] = with_(METRICS, INC, WEEK_GRID, IRATE_STEPS) + _POINTS + "irate_steps"

ORACLE["metrics_changes_steps"] = with_(METRICS, WEEK_GRID, f"""w AS (
  SELECT name, labels, t AS ts, m.value, lag(m.value) OVER (PARTITION BY name, labels, t ORDER BY t_us, m.value) AS pv
  {_in_window('metrics', 12)})""") + """
SELECT name, labels, ts, CAST(count(*) FILTER (WHERE value != pv) AS DOUBLE) AS value
FROM w GROUP BY name, labels, ts HAVING count(*) FILTER (WHERE value != pv) > 1"""

ORACLE["metrics_sum_rate_steps"] = with_(METRICS, INC, NEAR_INC, DAY_GRID, RATE_STEPS) + """
SELECT '' AS name, 'u="' || u || '"' AS labels, ts, round(sum(value), 6) AS value FROM rate_steps GROUP BY u, ts"""

ORACLE["metrics_avg_irate_steps"] = with_(METRICS, INC, WEEK_GRID, IRATE_STEPS) + """
SELECT ts, round(avg(value), 8) AS mean, CAST(count(*) AS DOUBLE) AS series FROM irate_steps GROUP BY ts"""

ORACLE["metrics_rate_ratio_steps"] = with_(METRICS, INC, NEAR_INC, DAY_GRID, RATE_STEPS) + """
SELECT '' AS name, 'u="' || u || '"' AS labels, ts,
       round(CASE WHEN sum(value) != 0 THEN sum(value) FILTER (WHERE name = 'view') / sum(value) END, 6) AS value
FROM rate_steps GROUP BY u, ts HAVING count(*) FILTER (WHERE name = 'view') > 0"""

ORACLE["metrics_group_left_steps"] = with_(METRICS, WEEK_GRID, LAST_STEPS % _in_window("metrics", 24)) + """
SELECT '' AS name, 'region="' || r_name || '",u="' || u || '"' AS labels, ts, max(value) AS value
FROM last_steps JOIN region ON u = CAST(r_regionkey AS VARCHAR) GROUP BY u, r_name, ts"""

ORACLE["metrics_scalar_steps"] = with_(METRICS, WEEK_GRID, LAST_STEPS % _in_window("metrics", 6)) + """
SELECT '' AS name, 'u="' || u || '"' AS labels, ts,
       round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY ts), 6) AS value
FROM last_steps GROUP BY u, ts"""

ORACLE["status_level"] = with_(*BY_PERIOD, HIST) + """
SELECT period, drift_share,
       CASE WHEN drift_share >= 0.5 THEN 'red' WHEN drift_share >= 0.3 THEN 'yellow' ELSE 'green' END AS level
FROM hist"""

ORACLE["state_timeline"] = with_(METRICS, """s AS (
  SELECT *, CASE WHEN value >= 60 THEN 'red' WHEN value >= 30 THEN 'yellow' ELSE 'green' END AS state
  FROM metrics)""", """p AS (
  SELECT *, lag(state) OVER (PARTITION BY name, labels ORDER BY t_us, value) AS ps FROM s)""", """r AS (
  SELECT *, sum(CASE WHEN ps IS NULL OR state != ps THEN 1 ELSE 0 END)
            OVER (PARTITION BY name, labels ORDER BY t_us, value ROWS UNBOUNDED PRECEDING) AS run FROM p)""") + """
SELECT name, labels, first(state) AS state, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS samples
FROM r GROUP BY name, labels, run"""


def _fmt(v):
    return (f"CASE WHEN {v} = floor({v}) THEN CAST(CAST({v} AS BIGINT) AS VARCHAR) "
            f"ELSE printf('%.4f', {v}) END")


ORACLE["exposition"] = _quality_union() + """,
summ AS (
  SELECT "table", CAST(bool_and(passed) AS INTEGER) AS p, count(*) AS t,
         count(*) FILTER (WHERE passed) AS cp, count(*) FILTER (WHERE NOT passed) AS cf,
         max(CASE WHEN "check" = 'row_count' THEN observed END) AS r
  FROM allq GROUP BY "table"),
cs AS (""" + "\nUNION ALL\n".join(
    f"""SELECT 'silver_trips' AS tb, '{c}' AS col, round(avg(CAST({c} AS DOUBLE)), 4) AS mean,
       round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std FROM silver""" for c in _STAT_COLS) + """),
m AS (
  SELECT 'data_quality_passed' AS name, 'table="' || "table" || '"' AS lab, CAST(p AS DOUBLE) AS v FROM summ
  UNION ALL SELECT 'data_quality_checks_total', 'table="' || "table" || '"', t FROM summ
  UNION ALL SELECT 'data_quality_checks_passed', 'table="' || "table" || '"', cp FROM summ
  UNION ALL SELECT 'data_quality_checks_failed', 'table="' || "table" || '"', cf FROM summ
  UNION ALL SELECT 'data_quality_rows_total', 'table="' || "table" || '"', r FROM summ
  UNION ALL SELECT 'data_column_mean', 'column="' || col || '",table="' || tb || '"', mean FROM cs
  UNION ALL SELECT 'data_column_std', 'column="' || col || '",table="' || tb || '"', std FROM cs)
SELECT name || '{' || lab || '} ' || """ + _fmt("v") + """ AS line FROM m
WHERE v IS NOT NULL AND NOT isnan(v)"""


# ---- feature store, models, drift reports -----------------------------------------

ORACLE["parse_drift_report"] = with_(*BY_PERIOD) + """
SELECT period, count(*) FILTER (WHERE js >= 0.1) AS number_of_drifted_columns,
       round(count(*) FILTER (WHERE js >= 0.1) / count(*), 6) AS drift_share,
       count(*) AS number_of_columns,
       count(*) FILTER (WHERE round(js, 6) >= 0.1) AS flagged_columns,
       round(count(*) FILTER (WHERE js >= 0.1) / count(*), 6) > 0.5 AS dataset_drift
FROM bp GROUP BY period"""

DAILY_ZS = """dz AS (
  SELECT PULocationID AS zone_id, CAST(CAST(tpep_pickup_datetime AS DATE) AS TIMESTAMP) AS event_timestamp,
         round(avg(total_amount), 2) AS zone_avg_fare,
         round(avg(epoch(tpep_dropoff_datetime - tpep_pickup_datetime) / 60.0), 2) AS zone_avg_duration_min,
         round(avg(trip_distance), 2) AS zone_avg_distance, count(*) AS zone_trip_count
  FROM stream
  WHERE trip_distance > 0 AND trip_distance < 100 AND total_amount > 0 AND total_amount < 500
    AND PULocationID BETWEEN 1 AND 263
    AND epoch(tpep_dropoff_datetime - tpep_pickup_datetime) / 60.0 BETWEEN 1 AND 180
  GROUP BY ALL)"""
ONLINE = """online AS (
  SELECT zone_id, event_timestamp, zone_avg_fare, zone_avg_duration_min, zone_avg_distance, zone_trip_count
  FROM (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY event_timestamp DESC) AS rn FROM dz
        WHERE event_timestamp <= TIMESTAMP '2024-01-20 00:00:00'
          AND event_timestamp > TIMESTAMP '2024-01-10 00:00:00') r WHERE rn = 1)"""

ORACLE["materialize_incremental"] = with_(STREAM, DAILY_ZS, ONLINE) + "SELECT * FROM online"

ORACLE["online_features"] = with_(STREAM, DAILY_ZS, ONLINE, _clean("stream", "clean")) + """
SELECT c.trip_key, c.pickup_zone_id AS zone_id,
       coalesce(o.zone_avg_fare, 0.0) AS zone_avg_fare,
       coalesce(o.zone_avg_duration_min, 0.0) AS zone_avg_duration_min,
       coalesce(o.zone_avg_distance, 0.0) AS zone_avg_distance,
       coalesce(o.zone_trip_count, 0) AS zone_trip_count,
       o.zone_id IS NOT NULL AS found
FROM clean c LEFT JOIN (SELECT * FROM online
                        WHERE event_timestamp >= TIMESTAMP '2024-01-21 00:00:00' - INTERVAL 90 DAY) o
  ON c.pickup_zone_id = o.zone_id"""

ORACLE["champions"] = with_(STREAM, """v AS (
  SELECT 'taxi-duration' AS model, CAST(dayofmonth(tpep_pickup_datetime) AS INTEGER) AS version,
         round(avg(abs(trip_distance - total_amount / 4.25)), 4) AS mae
  FROM stream GROUP BY ALL)""", """p AS (
  SELECT *, min(mae) OVER (PARTITION BY model ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
  FROM v)""", """q AS (SELECT model, version, mae, best IS NULL OR mae < best AS promoted FROM p)""") + """
SELECT *, last(CASE WHEN promoted THEN version END IGNORE NULLS)
          OVER (PARTITION BY model ORDER BY version ROWS UNBOUNDED PRECEDING) AS champion_version
FROM q"""

ORACLE["regression_metrics"] = with_(RAW, _clean("raw", "clean"), SILVER, _zone_stats("raw", "zs"), """t AS (
  SELECT s.duration_min AS y, coalesce(pu.zone_avg_duration_min, 0) AS p
  FROM silver s LEFT JOIN zs pu ON s.pickup_zone_id = pu.zone_id WHERE s.split = 'test')""") + """
SELECT count(*) AS n, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
       round(1 - sum((y - p) * (y - p)) / sum((y - (SELECT avg(y) FROM t)) * (y - (SELECT avg(y) FROM t))), 6) AS r2
FROM t"""


# ---- lake, catalogue, streaming ---------------------------------------------------

ORACLE["enforce_schema"] = with_(RAW, SILVER_DEMAND) + """
SELECT zone_id, pickup_hour, day_of_week, month, CAST(trip_count AS INTEGER) AS trip_count
FROM silver_demand"""

ORACLE["adhoc_sql"] = with_(RAW) + """
SELECT PULocationID AS zone_id, count(*) AS trips, round(avg(total_amount), 2) AS avg_amount
FROM raw WHERE trip_distance > 0 GROUP BY PULocationID"""

ORACLE["demand_stream"] = with_(STREAM) + """
SELECT PULocationID AS zone_id, date_trunc('hour', tpep_pickup_datetime) AS window_start, count(*) AS trip_count
FROM stream WHERE PULocationID BETWEEN 1 AND 263 GROUP BY ALL"""


# ---- further operator variants ----------------------------------------------------

ORACLE["zone_stats_train_only"] = with_(RAW, _clean("raw", "clean"), SILVER) + """
SELECT pickup_zone_id AS zone_id, round(avg(total_amount), 2) AS zone_avg_fare,
       round(avg(duration_min), 2) AS zone_avg_duration_min, round(avg(trip_distance), 2) AS zone_avg_distance,
       count(*) AS zone_trip_count
FROM silver WHERE split = 'train' GROUP BY pickup_zone_id"""

ORACLE["metrics_retention"] = with_(METRICS) + f"""
SELECT name, labels, ts, value FROM metrics WHERE ts > {AS_OF} - INTERVAL 7 DAY"""

ORACLE["metrics_compare"] = with_(METRICS, _instant(f"ts <= {AS_OF}")) + \
    "SELECT name, labels, value FROM inst WHERE value > 48.0"

ORACLE["metrics_scalar_op"] = with_(METRICS, _instant(f"ts <= {AS_OF}")) + \
    "SELECT name, labels, value * 100.0 AS value FROM inst"

ORACLE["metrics_avg_by"] = with_(METRICS, _instant(f"ts <= {AS_OF}")) + \
    "SELECT u, avg(value) AS avg_value, count(value) AS series FROM inst GROUP BY u"

ORACLE["parse_props"] = """
SELECT event_type, count(k) AS docs, CAST(sum(k) AS BIGINT) AS k_sum, max(k) AS k_max
FROM (SELECT event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) e
GROUP BY event_type"""

ORACLE["drift_report"] = with_(*DRIFT_BASE, *_vc(FEATS), CDF, KS,
                               "sd AS (SELECT feature, stddev_pop(value) AS s FROM rl GROUP BY feature)",
                               """nu AS (SELECT feature, count(DISTINCT value) AS u FROM rl GROUP BY feature)""",
                               CAT.replace("cat AS (", "cat AS (", 1),
                               """m AS (
  SELECT ks.feature, ks.n_ref, nu.u,
         CASE WHEN nu.u <= 5 THEN (CASE WHEN ks.n_ref <= 1000 THEN 'chi2' ELSE 'js' END)
              ELSE (CASE WHEN ks.n_ref <= 1000 THEN 'ks' ELSE 'wasserstein' END) END AS method,
         CASE WHEN ks.lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(list_transform(
              range(1, 101), lambda k: pow(-1.0, k - 1) * exp(-2.0 * k * k * ks.lam * ks.lam))))) END AS ks_p,
         CASE WHEN sd.s > 0 THEN ks.w1 / sd.s END AS wn, cat.js
  FROM ks JOIN sd USING (feature) JOIN nu USING (feature) JOIN cat USING (feature))""") + """
SELECT feature, method,
       round(CASE method WHEN 'ks' THEN ks_p WHEN 'wasserstein' THEN wn WHEN 'js' THEN js END, 6) AS score,
       CAST(CASE method WHEN 'ks' THEN 0.05 WHEN 'chi2' THEN 0.05 ELSE 0.1 END AS DOUBLE) AS threshold,
       CASE method WHEN 'ks' THEN ks_p < 0.05 WHEN 'wasserstein' THEN wn >= 0.1 WHEN 'js' THEN js >= 0.1 END AS drifted
FROM m"""


# ---- drift from mergeable counts, report documents, lineage, small operators

ORACLE["drift_daily_counts"] = with_(STREAM, CUR, _long("cur", "cl", FEATS, extra="date, ")) + \
    "SELECT date, feature, value, count(*) AS n FROM cl GROUP BY ALL"

ORACLE["drift_summary_merged"] = ORACLE["drift_summary"]

ORACLE["drift_report_recent"] = with_(RAW, f"stream AS (SELECT * FROM ({TRIPS_EVENTS_SQL}) WHERE date >= '2024-01-15')",
                                      _clean("raw", "clean"), SILVER, REF, CUR, *_vc(FEATS), CDF, KS, CAT,
                                      "sd AS (SELECT feature, stddev_pop(value) AS s FROM rl GROUP BY feature)") + """
SELECT feature, 'wasserstein' AS method, round(w1 / greatest(s, 0.001), 6) AS score, CAST(0.1 AS DOUBLE) AS threshold,
       w1 / greatest(s, 0.001) >= 0.1 AS drifted
FROM ks JOIN sd USING (feature) WHERE feature != 'pickup_month'
UNION ALL SELECT feature, 'js', round(js, 6), CAST(0.1 AS DOUBLE), js >= 0.1 FROM cat WHERE feature = 'pickup_month'"""

# P(a, x) = sum over n of x^(a + n) e^-x / gamma(a + n + 1)
ORACLE["drift_chi2_pvalue"] = with_(RAW, _clean("raw", "clean"), SILVER, REF,
                                    REF.replace("ref AS", "cur AS").replace("'train'", "'test'"), *_vc(DISC), CAT) + """
SELECT feature, chi2_dof,
       round(CASE WHEN chi2_stat = 'Infinity'::DOUBLE THEN 0.0 WHEN chi2_stat <= 0 OR chi2_dof <= 0 THEN 1.0
             ELSE greatest(0.0, 1 - list_sum(list_transform(range(0, 3000), lambda n:
               exp((chi2_dof / 2 + n) * ln(chi2_stat / 2) - chi2_stat / 2 - lgamma(chi2_dof / 2 + n + 1))))) END, 6) AS p_value
FROM cat"""

ORACLE["parse_foreign_reports"] = f"""
WITH d AS ({FOREIGN_REPORTS_SQL}),
j AS (SELECT event_id, json_valid(report) AS valid, CASE WHEN json_valid(report) THEN json(report) END AS doc FROM d),
m AS (SELECT event_id, unnest(json_extract(doc, '$.metrics[*]')) AS m FROM j WHERE valid),
t AS (
  SELECT event_id, coalesce(m->>'$.config.type', '') AS type, TRY_CAST(m->>'$.value' AS DOUBLE) AS score,
         coalesce(TRY_CAST(m->>'$.config.threshold' AS DOUBLE), 0.05) AS threshold,
         coalesce(m->>'$.config.method', '') IN ('wasserstein', 'js') AS distance,
         TRY_CAST(m->>'$.value.count' AS BIGINT) AS n, TRY_CAST(m->>'$.value.share' AS DOUBLE) AS share FROM m),
g AS (
  SELECT event_id, max(n) FILTER (WHERE contains(type, 'DriftedColumnsCount')) AS n,
         max(share) FILTER (WHERE contains(type, 'DriftedColumnsCount')) AS share,
         count(*) FILTER (WHERE contains(type, 'ValueDrift')) AS k,
         count(*) FILTER (WHERE contains(type, 'ValueDrift') AND CASE WHEN distance THEN score >= threshold ELSE score < threshold END) AS f
  FROM t GROUP BY event_id)
SELECT event_id, n AS number_of_drifted_columns, share AS drift_share, k AS number_of_columns, f AS flagged_columns,
       share > 0.5 AS dataset_drift,
       CASE WHEN NOT valid THEN 'unparsable' WHEN k IS NULL THEN 'no_metrics' ELSE 'ok' END AS status
FROM j LEFT JOIN g USING (event_id)"""

ORACLE["stale_tables"] = f"""
WITH RECURSIVE fresh AS ({ORACLE["freshness"]}),
target(t, sla) AS (VALUES ('bronze_raw', 86400), ('bronze_streaming', 600), ('silver_trips', 3600), ('silver_demand', 3600),
                          ('gold_zone_stats', 86400)),
edge(t, up) AS (VALUES ('silver_trips', 'bronze_raw'), ('silver_trips', 'bronze_streaming'), ('silver_demand', 'bronze_raw'),
                       ('silver_demand', 'bronze_streaming'), ('gold_zone_stats', 'bronze_raw')),
stale AS (
  SELECT t, t AS late, 0 AS depth, sla FROM fresh JOIN target ON "table" = t WHERE NOT within_sla
  UNION ALL
  SELECT edge.t, late, depth + 1, least(stale.sla, target.sla)
  FROM stale JOIN edge ON up = stale.t JOIN target ON target.t = edge.t)
SELECT t AS "table", late AS late_table, CAST(min(depth) AS INTEGER) AS depth, CAST(min(sla) AS BIGINT) AS tightest_sla_seconds
FROM stale GROUP BY t, late"""

ORACLE["validate_tables"] = _quality_union() + "SELECT * FROM allq"

ORACLE["select_existing"] = with_(STREAM) + "SELECT trip_key, total_amount, date FROM stream"

ORACLE["trips_of_months"] = with_(RAW) + """
SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS month, count(*) AS trips FROM raw
WHERE strftime(tpep_pickup_datetime, '%Y-%m') IN ('1995-03', '1995-04', '1996-12') GROUP BY 1"""

ORACLE["freshness_samples"] = with_(STREAM) + """
SELECT 'data_freshness_timestamp' AS name, 'table="' || date || '"' AS labels,
       CAST(epoch_us(max(tpep_pickup_datetime)) // 1000000 AS DOUBLE) AS value
FROM stream GROUP BY date"""
