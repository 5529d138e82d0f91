"""Metric time series: storage shape, exposition and dashboard queries (K, A15, D4).

A metric sample is ``(name, labels map<string,string>, ts, value)``. Series
identity is ``(name, labels)``; because a map cannot be a grouping key, the
labels are carried as a canonical text key (``k1="v1",k2="v2"``, sorted).

Every operator of the query language takes and returns vectors with the
columns ``name, labels, label_map, ts, value``, so they compose. ``instant``,
``rate``, ``irate`` and ``changes`` take ``steps`` and are then evaluated at
each of these times (``ts`` is the evaluation time); without steps the range
functions have a value at each sample. Aggregates, arithmetic and comparisons
apply to any vector and never mix times: ``instant`` at a single time keeps the
sample's time as ``ts`` and the evaluation time as ``at``, by which its elements
meet others.

Evaluation on steps deals each sample to the steps whose window holds it. A
sample's first and last step are the same for all samples of a pane, so panes
are aggregated first and dealt out then; the work is panes times window / step,
however dense the samples are.

Per-series order operators (lag, range windows, islands) never put a whole
series into one task: samples are cut into time buckets (default one day)
per series; the step from the previous bucket comes from a small
(series × bucket) table, and range windows are put together from running
aggregates of time blocks. A series holding a third of all samples is
therefore spread over as many tasks as it has buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions import epoch_micros

DAY_US = 86_400_000_000
SERIES = ["name", "labels"]
VECTOR = [*SERIES, "label_map", "ts"]      # and value


@dataclass(frozen=True)
class Steps:
    """Evaluation times: ``start``, then every ``step_s`` seconds up to ``end``."""

    start: str
    end: str
    step_s: int

    def micros(self) -> tuple[Column, Column, int]:
        at = lambda text: epoch_micros(F.to_timestamp_ntz(F.lit(text)))
        return at(self.start), at(self.end), int(self.step_s) * 1_000_000


def labels_key(labels) -> Column:
    """Canonical text of a label map: sorted ``k="v"`` pairs joined by ','.
    Backslash, quote and newline are escaped in values, so different maps
    have different texts."""
    m = F.col(labels) if isinstance(labels, str) else labels

    def escaped(v):
        for plain, text in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n")):
            v = F.replace(v, F.lit(plain), F.lit(text))
        return v
    pairs = F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit('="'), escaped(e["value"]), F.lit('"')))
    return F.array_join(F.array_sort(pairs), ",")


def normalize(m: DataFrame) -> DataFrame:
    """Samples with text ``labels``, the map as ``label_map`` and ``t_us``.

    A sample without a name or time is not a sample and is dropped here;
    the series key columns are then non-null everywhere, so the self-joins
    of the per-series operators see identical inputs on both sides and
    Spark reuses one shuffle for both."""
    return (m.where(F.col("name").isNotNull() & F.col("ts").isNotNull())
             .select("name", F.coalesce(labels_key("labels"), F.lit("")).alias("labels"),
                     F.col("labels").alias("label_map"),
                     F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("value").cast("double").alias("value"),
                     epoch_micros(F.col("ts").cast("timestamp_ntz")).alias("t_us")))


def label(m: DataFrame, key: str) -> Column:
    """Value of one label, '' when missing (matcher semantics)."""
    return F.coalesce(F.element_at(F.col("label_map"), F.lit(key)), F.lit(""))


def match_labels(m: DataFrame, matchers: list[tuple[str, str, str]]) -> DataFrame:
    """Filter by matchers ``(label, op, value)`` with op in ``= != =~ !~``
    (K3); ``__name__`` addresses the metric name; regexes are fully anchored."""
    cond = F.lit(True)
    for key, op, val in matchers:
        x = F.col("name") if key == "__name__" else label(m, key)
        if op == "=":
            c = x == F.lit(val)
        elif op == "!=":
            c = x != F.lit(val)
        elif op == "=~":
            c = x.rlike(f"^(?:{val})$")
        elif op == "!~":
            c = ~x.rlike(f"^(?:{val})$")
        else:
            raise ValueError(f"unknown matcher op {op!r}")
        cond = cond & c
    return m.where(cond)


def instant(m: DataFrame, as_of: str | None = None, lookback_s: int | None = 300,
            steps: Steps | None = None) -> DataFrame:
    """Latest sample per series at ``as_of`` (K1): ``ts <= as_of`` and, with a
    lookback, ``ts > as_of - lookback``. Ties on time keep the larger value.
    With ``steps`` the same at each of these times, which need a lookback."""
    if steps is not None:
        if lookback_s is None:
            raise ValueError("steps need a lookback: every sample would be dealt to every later step")
        out = _at_steps(m, steps, lookback_s, {"s": (F.max, F.struct("t_us", "value"))})
        return out.select(*VECTOR, F.col("s.value").alias("value"))
    at = F.to_timestamp_ntz(F.lit(as_of))
    cond = F.col("ts") <= at
    if lookback_s is not None:
        cond = cond & (F.col("ts") > F.timestamp_add("SECOND", F.lit(-int(lookback_s)), at))
    last = m.where(cond).groupBy(*SERIES).agg(
        F.max(F.struct("ts", "value")).alias("s"), F.first("label_map").alias("label_map"))
    return last.select(*SERIES, "label_map", F.col("s.ts").alias("ts"), F.col("s.value").alias("value"), at.alias("at"))


def _at_steps(x: DataFrame, steps: Steps, window_s: int, values: dict[str, tuple]) -> DataFrame:
    """(name, labels, label_map, ts and each of ``values``) at each step t, over
    the samples in ``(t - window, t]``; a series without any has no row.
    ``values`` maps a name to (aggregate, column); the aggregate also merges its
    own results (sum, min, max)."""
    start, end, step = steps.micros()
    window = int(window_s) * 1_000_000
    whole = lambda c: ((c - c % F.lit(step)) / F.lit(step)).cast("long")  # noqa: E731 - exact: a multiple
    since = F.timestamp_add("MICROSECOND", F.lit(-window), F.to_timestamp_ntz(F.lit(steps.start)))
    seen = x.where((F.col("ts") > since) & (F.col("ts") <= F.to_timestamp_ntz(F.lit(steps.end))))
    # the first step at or after the sample, the last one before the sample's time plus the window
    first = whole(F.greatest(F.col("t_us") - start, F.lit(0)) + F.lit(step - 1))
    last = F.least(whole(F.col("t_us") + F.lit(window) - start - 1), whole(end - start))
    panes = (seen.groupBy(*SERIES, first.alias("_first"), last.alias("_last"))
             .agg(F.first("label_map").alias("label_map"), *[f(c).alias(n) for n, (f, c) in values.items()])
             .where("_first <= _last"))
    dealt = panes.withColumn("_step", F.explode(F.sequence("_first", "_last")))
    ts = F.timestamp_add("MICROSECOND", F.col("_step") * F.lit(step), F.to_timestamp_ntz(F.lit(steps.start)))
    return (dealt.groupBy(*SERIES, "_step")
            .agg(F.first("label_map").alias("label_map"), *[f(n).alias(n) for n, (f, _) in values.items()])
            .withColumn("ts", ts).drop("_step"))


def range_query(m: DataFrame, start: str, end: str, step_s: int) -> DataFrame:
    """Series over a time range at a fixed step (K2): at each step time t the
    last sample in ``(t - step, t]``. Implemented as a grouping by the step
    that closes each sample (partial aggregation, no per-step product). The
    result is a vector; its time is also there as ``step_ts``."""
    step_us = int(step_s) * 1_000_000
    s_us = epoch_micros(F.to_timestamp_ntz(F.lit(start)))
    e_us = epoch_micros(F.to_timestamp_ntz(F.lit(end)))
    t_step = F.ceil((F.col("t_us") - s_us) / F.lit(step_us)) * F.lit(step_us) + s_us
    x = m.where((F.col("t_us") > s_us - F.lit(step_us)) & (F.col("t_us") <= e_us))
    g = x.groupBy(*SERIES, t_step.alias("step_us")).agg(F.max(F.struct("t_us", "value")).alias("s"),
                                                        F.first("label_map").alias("label_map"))
    ts = F.timestamp_add("MICROSECOND", F.col("step_us"), F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")))
    return g.select(*SERIES, "label_map", ts.alias("ts"), F.col("s.value").alias("value"), ts.alias("step_ts"))


def with_previous(m: DataFrame, cols: list[str], bucket_us: int = DAY_US) -> DataFrame:
    """Add ``prev_t_us`` and ``prev_<c>`` (the previous sample of the same
    series, in (t_us, value) order) without a per-series window: lag inside
    (series, time bucket); the first sample of a bucket takes the last
    sample of the nearest earlier non-empty bucket from a small table.
    The last sample of each bucket is read off the same sorted window
    (``lead`` is null), so no extra aggregate or sort is needed."""
    b = F.floor(F.col("t_us") / F.lit(bucket_us)).cast("long")
    x = m.withColumn("_b", b)
    w = Window.partitionBy(*SERIES, "_b").orderBy("t_us", "value")
    x = x.select("*", F.lag("t_us").over(w).alias("_pt"),
                 *[F.lag(c).over(w).alias(f"_p_{c}") for c in cols],
                 F.lead("t_us").over(w).isNull().alias("_is_last"))
    last = x.where("_is_last").select(*SERIES, "_b", F.col("t_us").alias("_lt"),
                                      *[F.col(c).alias(f"_l_{c}") for c in cols])
    wl = Window.partitionBy(*SERIES).orderBy("_b")     # one row per (series, bucket)
    lastp = last.select(*SERIES, "_b", F.lag("_lt").over(wl).alias("_plt"),
                        *[F.lag(f"_l_{c}").over(wl).alias(f"_pl_{c}") for c in cols])
    x = x.join(lastp, SERIES + ["_b"], "left")
    return x.select(*m.columns,
                    F.coalesce("_pt", "_plt").alias("prev_t_us"),
                    *[F.coalesce(f"_p_{c}", f"_pl_{c}").alias(f"prev_{c}") for c in cols])


def increments(m: DataFrame, bucket_us: int = DAY_US, stale_s: int | None = None) -> DataFrame:
    """Per sample: counter increase since the previous sample (a drop is a
    reset: the whole new value counts), time step in µs, change flag. A
    previous sample more than ``stale_s`` seconds older doesn't count."""
    x = with_previous(m, ["value"], bucket_us)
    if stale_s is not None:
        near = F.col("t_us") - F.col("prev_t_us") <= F.lit(int(stale_s) * 1_000_000)
        x = x.withColumn("prev_value", F.when(near, F.col("prev_value"))).withColumn("prev_t_us", F.when(near, F.col("prev_t_us")))
    inc = F.when(F.col("value") >= F.col("prev_value"), F.col("value") - F.col("prev_value")) \
           .otherwise(F.col("value"))
    return x.select("*",
                    F.when(F.col("prev_value").isNotNull(), inc).alias("inc"),
                    (F.col("t_us") - F.col("prev_t_us")).cast("double").alias("dt_us"),
                    F.when(F.col("prev_value").isNotNull(),
                           (F.col("value") != F.col("prev_value")).cast("int")).alias("chg"))


def _range_window(x: DataFrame, window_s: int, bucket_us: int, values: list[tuple]) -> DataFrame:
    """Add ``_w<i>`` for each (aggregate, column) of ``values``: the aggregate over
    the samples of the series in ``(t - window, t]``, peers of the row included. The
    aggregate also merges its own results (sum, min).

    Time is cut into blocks of which a window spans exactly ``k``. The window is
    then the end of the block k before the row's own, the blocks between, and the
    row's own block up to it: running aggregates, so that the work per sample
    doesn't grow with the samples in a window, and nothing is subtracted."""
    w_us = int(window_s) * 1_000_000
    k = next(n for n in range(-(-w_us // bucket_us), w_us + 1) if w_us % n == 0)
    block = lambda t: F.floor(t / F.lit(w_us // k)).cast("long")
    running = (Window.unboundedPreceding, Window.currentRow)
    # the end of a block: samples later than t - window, which is asked for by a row at that time
    asks = F.array(F.struct(F.col("t_us").alias("at"), F.lit(0).alias("ask")),
                   F.struct((F.col("t_us") - F.lit(w_us)).alias("at"), F.lit(1).alias("ask")))
    both = x.withColumn("_a", F.explode(asks)).withColumn("_b", block(F.col("_a.at")))
    late = Window.partitionBy(*SERIES, "_b").orderBy(F.desc("_a.at"), F.desc("_a.ask")).rowsBetween(*running)
    out = both.select("*", *[f(F.when(F.col("_a.ask") == 0, c)).over(late).alias(f"_e{i}")
                             for i, (f, c) in enumerate(values)]).where("_a.ask = 1").drop("_a")
    # the row's own block
    early = Window.partitionBy(*SERIES, "_b").orderBy("t_us").rangeBetween(*running)
    out = out.withColumn("_b", block(F.col("t_us")))
    out = out.select("*", *[f(c).over(early).alias(f"_o{i}") for i, (f, c) in enumerate(values)])
    parts = ["_e", "_o"]
    if k > 1:                               # blocks between, one row per (series, block)
        blocks = x.groupBy(*SERIES, block(F.col("t_us")).alias("_b")).agg(
            *[f(c).alias(f"_t{i}") for i, (f, c) in enumerate(values)])
        between = Window.partitionBy(*SERIES).orderBy("_b").rangeBetween(1 - k, -1)
        blocks = blocks.select(*SERIES, "_b", *[f(f"_t{i}").over(between).alias(f"_m{i}") for i, (f, _) in enumerate(values)])
        out, parts = out.join(blocks, [*SERIES, "_b"], "left"), ["_e", "_m", "_o"]

    def merged(f, i):
        found = [F.col(f"{p}{i}") for p in parts]
        if f is F.min:
            return F.least(*found)
        return F.when(F.coalesce(*found).isNotNull(), sum((F.coalesce(c, F.lit(0)) for c in found[1:]), F.coalesce(found[0], F.lit(0))))
    return out.select(*x.columns, *[merged(f, i).alias(f"_w{i}") for i, (f, _) in enumerate(values)])


def _recent(m: DataFrame, steps: Steps, window_s: int, stale_s: int | None) -> DataFrame:
    """The samples that can have a part in the steps: with ``stale_s`` older
    ones are not read (the bound is on ``ts``, so it reaches the scan)."""
    m = m.where(F.col("ts") <= F.to_timestamp_ntz(F.lit(steps.end)))
    if stale_s is None:
        return m
    back = F.lit(-int(window_s) - int(stale_s))
    return m.where(F.col("ts") > F.timestamp_add("SECOND", back, F.to_timestamp_ntz(F.lit(steps.start))))


def rate(m: DataFrame, window_s: int = 300, bucket_us: int = DAY_US, steps: Steps | None = None,
         stale_s: int | None = None) -> DataFrame:
    """``rate(x[window])`` (K4): counter increase over the samples in
    ``(t - window, t]`` (each with its step from the previous sample, resets
    corrected) divided by the summed steps; per second, no extrapolation. At
    every sample (null without a step), or at each of ``steps`` (no element
    without one)."""
    if steps is not None:
        x = increments(_recent(m, steps, window_s, stale_s), bucket_us, stale_s)
        r = _at_steps(x, steps, window_s, {"_w0": (F.sum, F.col("inc")), "_w1": (F.sum, F.col("dt_us"))})
        return r.where("_w1 > 0").select(*VECTOR, F.round(F.col("_w0") / (F.col("_w1") / F.lit(1e6)), 6).alias("value"))
    x = increments(m, bucket_us, stale_s)
    r = _range_window(x, window_s, bucket_us, [(F.sum, F.col("inc")), (F.sum, F.col("dt_us"))])
    per_s = F.when(F.col("_w1") > 0, F.col("_w0") / (F.col("_w1") / F.lit(1e6)))
    return r.select(*VECTOR, F.round(per_s, 6).alias("value"))


def irate(m: DataFrame, bucket_us: int = DAY_US, steps: Steps | None = None, window_s: int = 300) -> DataFrame:
    """``irate``: increase between the last two samples per second (K5): at
    every sample, or at each of ``steps`` where both lie in ``(t - window, t]``."""
    if steps is not None:
        x = increments(_recent(m, steps, window_s, window_s), bucket_us)
        r = _at_steps(x, steps, window_s, {"s": (F.max, F.struct("t_us", "value", "inc", "dt_us"))})
        both = (F.col("s.dt_us") > 0) & (F.col("s.t_us") - F.col("s.dt_us") > epoch_micros(F.col("ts")) - F.lit(int(window_s) * 1_000_000))
        return r.where(both).select(*VECTOR, F.round(F.col("s.inc") / (F.col("s.dt_us") / F.lit(1e6)), 6).alias("value"))
    x = increments(m, bucket_us)
    per_s = F.when(F.col("dt_us") > 0, F.col("inc") / (F.col("dt_us") / F.lit(1e6)))
    return x.select(*VECTOR, F.round(per_s, 6).alias("value"))


def changes(m: DataFrame, window_s: int = 300, bucket_us: int = DAY_US, steps: Steps | None = None) -> DataFrame:
    """``changes(x[window])`` (K6): value changes between consecutive samples
    that both lie in ``(t - window, t]``, at every sample or at each of ``steps``."""
    if steps is not None:
        x = increments(_recent(m, steps, window_s, window_s), bucket_us).withColumn("chg0", F.coalesce("chg", F.lit(0)))
        r = _at_steps(x, steps, window_s, {"_n": (F.sum, F.col("chg0")), "_f": (F.min, F.struct("t_us", "value", "chg0"))})
        return r.select(*VECTOR, (F.col("_n") - F.col("_f.chg0")).cast("double").alias("value"))
    x = increments(m, bucket_us).withColumn("chg0", F.coalesce("chg", F.lit(0)))
    first = F.struct("t_us", "value", "prev_t_us", "chg0")      # in the order of ``with_previous``
    r = _range_window(x, window_s, bucket_us, [(F.sum, F.col("chg0")), (F.min, first)])
    return r.select(*VECTOR, (F.col("_w0") - F.col("_w1.chg0")).cast("double").alias("value"))


def _vector(v: DataFrame) -> DataFrame:
    """``v``, if it is a vector; anything else would be read wrongly."""
    missing = [c for c in (*VECTOR, "value") if c not in v.columns]
    if missing:
        raise ValueError(f"not a vector: it lacks {', '.join(missing)}")
    return v


def _time(v: DataFrame) -> Column:
    """The evaluation time of a vector's elements."""
    return F.col("at") if "at" in v.columns else F.col("ts")


def _timed(v: DataFrame) -> list[str]:
    return ["at"] if "at" in v.columns else []


def aggregate_by(v: DataFrame, by: list[str], fn: str = "sum") -> DataFrame:
    """``sum/avg/count/min/max by (labels)`` (K8) over the elements of each
    evaluation time. The result has no name, the labels of ``by`` that aren't
    empty, and the time of its latest element."""
    f = {"sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max}[fn]
    keys = [label(_vector(v), k).alias(f"_k_{i}") for i, k in enumerate(by)]
    out = v.groupBy(*keys, _time(v).alias("_t")).agg(F.max("ts").alias("ts"), f("value").cast("double").alias("value"))
    empty = F.create_map().cast("map<string,string>")
    found = F.create_map(*[x for i, k in enumerate(by) for x in (F.lit(k), F.col(f"_k_{i}"))]) if by else empty
    out = out.withColumn("label_map", F.map_filter(found, lambda _, x: x != "")).withColumnRenamed("_t", "at")
    return out.select(F.lit("").alias("name"), labels_key("label_map").alias("labels"), "label_map", "ts", "value", *_timed(v))


def metric_binary_op(left: DataFrame, right: DataFrame, op: str, on: list[str] | None = None,
                     clamp_min_right: float | None = None, ignoring: list[str] | None = None,
                     group_left: list[str] | None = None) -> DataFrame:
    """Label-matched arithmetic ``left <op> on(keys) group_left right`` (D4,
    K9) at each evaluation time: many left series to one right series per key;
    right-hand ``clamp_min`` optional. ``ignoring`` matches on all labels but
    those (none: on all). The labels in ``group_left`` are taken over from the
    right (an empty one removes the left's). Unmatched left elements drop out;
    several right elements for a key at one time are an error, as in the query
    language."""
    if on is not None and ignoring is not None:
        raise ValueError("on and ignoring exclude each other")

    def key(v):
        if on is not None:
            return F.array(*[label(v, k) for k in on]) if on else F.array(F.lit(""))
        kept = F.map_filter("label_map", lambda k, x: ~k.isin(*(ignoring or [""])) & (x != ""))
        return F.array(labels_key(kept))
    taken = group_left or []
    r = (_vector(right).groupBy(key(right).alias("_key"), _time(right).alias("_time"))
         .agg(F.max("value").alias("_one"), F.count(F.lit(1)).alias("_n"),
              *[F.max(label(right, k)).alias(f"_g{i}") for i, k in enumerate(taken)]))
    many = F.raise_error(F.lit("several right-hand series match one key"))
    r = r.select("_key", "_time", F.when(F.col("_n") > 1, many).otherwise(F.col("_one")).alias("_rv"),
                 *[f"_g{i}" for i in range(len(taken))])
    if clamp_min_right is not None:
        r = r.withColumn("_rv", F.greatest(F.col("_rv"), F.lit(float(clamp_min_right))))
    j = _vector(left).withColumn("_key", key(left)).withColumn("_time", _time(left)).join(r, ["_key", "_time"], "inner")
    ops = {"+": F.col("value") + F.col("_rv"), "-": F.col("value") - F.col("_rv"),
           "*": F.col("value") * F.col("_rv"),
           "/": F.when(F.col("_rv") != 0, F.col("value") / F.col("_rv"))}
    if taken:
        own = F.map_filter("label_map", lambda k, _: ~k.isin(*taken))
        new = F.create_map(*[x for i, k in enumerate(taken) for x in (F.lit(k), F.col(f"_g{i}"))])
        j = j.withColumn("label_map", F.map_concat(own, F.map_filter(new, lambda _, x: x != ""))) \
             .withColumn("labels", labels_key("label_map"))
    return j.select(*VECTOR, F.round(ops[op], 6).alias("value"), *_timed(left))


def compare(v: DataFrame, op: str, threshold: float) -> DataFrame:
    """Comparison filter on a vector, e.g. ``x > 0``, ``changes(y) > 0``."""
    c = F.col("value")
    conds = {">": c > threshold, ">=": c >= threshold, "<": c < threshold, "<=": c <= threshold,
             "==": c == threshold, "!=": c != threshold}
    return _vector(v).where(conds[op])


def scalar(v: DataFrame) -> float:
    """``scalar(v)``: the value of a one-element vector, NaN otherwise (K9).
    At most two rows are fetched to decide."""
    rows = v.select("value").limit(2).collect()
    return float(rows[0][0]) if len(rows) == 1 and rows[0][0] is not None else float("nan")


def scalar_op(v: DataFrame, op: str, k: float, scalar_left: bool = False) -> DataFrame:
    """Arithmetic between a vector and a scalar (K9), e.g. ``100 * x``."""
    a, b = (F.lit(float(k)), F.col("value")) if scalar_left else (F.col("value"), F.lit(float(k)))
    ops = {"+": a + b, "-": a - b, "*": a * b, "/": F.when(b != 0, a / b)}
    return v.withColumn("value", ops[op])


def scalar_steps(v: DataFrame) -> DataFrame:
    """``scalar(v)`` at each evaluation time, (at, scalar): the value of the one
    element, NaN where there are more."""
    one = F.when(F.count(F.lit(1)) == 1, F.max("value")).otherwise(F.lit(float("nan")))
    return _vector(v).groupBy(_time(v).alias("at")).agg(one.alias("scalar"))


def by_scalar(v: DataFrame, op: str, s: DataFrame, scalar_left: bool = False) -> DataFrame:
    """Arithmetic between a vector and a scalar of each evaluation time (K9),
    ``s`` from ``scalar_steps``; where it has none, or a NaN, the value is NaN."""
    at = s.select(F.col("at").alias("_at"), F.col("scalar").alias("_s"))
    j = _vector(v).join(at, _time(v) == F.col("_at"), "left")
    k = F.coalesce("_s", F.lit(float("nan")))
    a, b = (k, F.col("value")) if scalar_left else (F.col("value"), k)
    ops = {"+": a + b, "-": a - b, "*": a * b, "/": F.when(b != 0, a / b)}
    return j.withColumn("value", F.round(ops[op], 6)).drop("_at", "_s")


def status_level(value: Column, levels: list[tuple[float, str]], base: str = "green") -> Column:
    """Threshold levels (K11): ``base`` below the first threshold, then the
    name of the highest threshold reached."""
    out = F.lit(base)
    for thr, name in levels:
        out = F.when(value >= F.lit(thr), F.lit(name)).otherwise(out)
    return out


def state_timeline(m: DataFrame, state_col: str = "state", bucket_us: int = DAY_US) -> DataFrame:
    """Runs of equal state per series (K12): ``(name, labels, state,
    start_ts, end_ts, samples)``. Gaps and islands: a run starts where the
    state differs from the previous sample's; each sample takes the latest
    run start at or before it (a running max, computed per time bucket with
    the earlier buckets' maximum from a small table)."""
    x = with_previous(m, [state_col], bucket_us)
    start = F.when(F.col(f"prev_{state_col}").isNull()
                   | (F.col(state_col) != F.col(f"prev_{state_col}")), F.col("t_us"))
    x = x.withColumn("_start", start).withColumn("_b", F.floor(F.col("t_us") / F.lit(bucket_us)).cast("long"))
    w = Window.partitionBy(*SERIES, "_b").orderBy("t_us", "value").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_run_local", F.max("_start").over(w))
    per_b = x.groupBy(*SERIES, "_b").agg(F.max("_start").alias("_mb"))
    wb = Window.partitionBy(*SERIES).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_b.select(*SERIES, "_b", F.max("_mb").over(wb).alias("_carry"))
    x = x.join(carry, SERIES + ["_b"], "left").withColumn("_run", F.coalesce("_run_local", "_carry"))
    return x.groupBy(*SERIES, "_run").agg(
        F.first(state_col).alias("state"), F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"),
        F.count(F.lit(1)).alias("samples")).drop("_run")


def to_metrics(df: DataFrame, name_prefix: str, value_cols: list[str], label_cols: list[str],
               ts: Column | None = None) -> DataFrame:
    """Turn a result frame into metric samples (A15): one sample per row and
    value column, labels from ``label_cols``."""
    tsc = ts if ts is not None else F.lit(None).cast("timestamp_ntz")
    lab = F.create_map(*[x for c in label_cols for x in (F.lit(c), F.col(c).cast("string"))]) \
        if label_cols else F.create_map().cast("map<string,string>")
    entries = [F.struct(F.lit(f"{name_prefix}{c}").alias("name"), F.col(c).cast("double").alias("value"))
               for c in value_cols]
    return df.select(lab.alias("labels"), tsc.alias("ts"), F.explode(F.array(*entries)).alias("e")) \
             .select(F.col("e.name").alias("name"), "labels", "ts", F.col("e.value").alias("value"))


def format_exposition(m: DataFrame) -> DataFrame:
    """Text exposition lines ``name{k="v",...} value`` (A15); integral
    values print without decimals, others with 4 decimals."""
    lab = labels_key("labels")
    val = F.when(F.col("value") == F.floor("value"), F.col("value").cast("long").cast("string")) \
           .otherwise(F.format_string("%.4f", F.col("value")))
    body = F.when(lab == "", F.col("name")).otherwise(F.concat("name", F.lit("{"), lab, F.lit("}")))
    present = F.col("value").isNotNull() & ~F.isnan("value")      # NaN / null are not published
    return m.where(present).select(F.concat(body, F.lit(" "), val).alias("line"))


def prune_metrics(m: DataFrame, as_of: str, retention_days: int = 30) -> DataFrame:
    """Retention (K13): samples newer than ``as_of - retention``. On a
    metrics table partitioned by ``date`` the same bound is also applied to
    the partition column, so expired days are never listed or read."""
    at = F.to_timestamp_ntz(F.lit(as_of))
    lo = F.timestamp_add("DAY", F.lit(-int(retention_days)), at)
    cond = F.col("ts") > lo
    if "date" in m.columns:
        cond = cond & (F.col("date") >= F.date_format(lo, "yyyy-MM-dd"))
    return m.where(cond)
