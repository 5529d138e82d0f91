"""Exact top-k search by inner product with an impact-ordered index.

Vectors stay where they lie: each task reads its own, ``SHARD`` rows at a time
(fewer if they are wide), and turns them into an index. This holds one posting
(vector, weight) per non-zero component, in segments of one impact and one
component each; the impact is the weight's binary exponent. Queries come to the
vectors, ``QUERY_ITEMS`` components a broadcast, whatever their number.

Segments are added to the queries' scores in order of descending impact. After
each impact, a vector's score is known within the most that its unread postings
can add (the smaller of |rest|2 |q|2 and |rest|max |q|1). A query stops only
when this proves that at most ``STOP`` vectors can still be among its k highest,
or at the index's end; those vectors are scored exactly.

A task keeps its k best for each query, and what a query's k-th score is so far
rules vectors out in the shards that follow. Vectors are searched in waves, each
``GROWTH`` times all before it (by hash); a wave starts with the k-th scores of
those before. What a wave sends on for a query therefore doesn't grow with
the table but for a task's k best, and vectors are never shuffled or copied.

Defined cases: null vectors, and those with a null or non-finite component,
take no part; vectors of differing lengths are filled up with zeros; rows with
the same id and vector count once; several vectors under one query id share one
ranking; a row with the query's id is its own, not a candidate; ties go to the
smaller id; fewer than k candidates give fewer rows; null ids take no part; no
rows give no rows. |256 x| must stay below 2 ** 31 and scores below 2 ** 63.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm.text import table, written
from tripflow.session import checkpoint_dir

K = 5
SCALE = 256
QUERY_STEP = 50             # ids divisible by this are queries
SHARD = 4096                # vectors of an index,
SHARD_ITEMS = 1 << 18       # and components at most, but for a single wider vector
QUERY_BLOCK = 128           # queries scored together
QUERY_ITEMS = 1 << 21       # components of the queries that are broadcast together (16 MB)
WAVE = 65_536               # vectors of the first wave, at most
GROWTH = 8
STOP = 256                  # vectors that may be left to score exactly
CHECKS = 16                 # looks at the bounds, at most, while an index is read
NO_SCORE = -(1 << 63)
FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, x): floor(scale * component) of each usable vector, as long."""
    sound = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                     & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return (vectors.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull()).where(sound)
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(vector_col, lambda c: F.floor(scale * c.cast("double")).cast("long")).alias("x"))
            .dropDuplicates(["vec_id", "x"]))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    size = np.asarray(lists.value_lengths()).astype(np.int64)
    out = np.zeros((len(lists), width), np.int64)
    row = np.repeat(np.arange(len(lists)), size)
    place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    out[row, place] = np.asarray(lists.flatten())
    return out


class ImpactIndex:
    """The postings of a shard's vectors ``x``: sorted arrays ``vec`` and
    ``weight``, cut into segments. A level of ``levels`` is one impact, from the
    highest: its segments (component, from, to) and the length of what is unread
    of each vector after it."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        vec, component = np.nonzero(x)
        weight = x[vec, component].astype(np.float64)
        impact = np.frexp(np.abs(weight))[1]
        order = np.lexsort((vec, component, -impact))
        vec, component, weight, impact = vec[order], component[order], weight[order], impact[order]
        begin = np.flatnonzero((np.diff(component, prepend=-1) != 0) | (np.diff(impact, prepend=1 << 20) != 0))
        end = np.append(begin[1:], len(vec))
        rest, self.levels = np.zeros(len(x)), []
        for level in np.unique(impact):         # what is unread adds up from the lowest
            of = np.flatnonzero(impact[begin] == level)
            segments = zip(component[begin[of]].tolist(), begin[of].tolist(), end[of].tolist(), strict=True)
            self.levels.append((list(segments), np.sqrt(rest)))
            lo, hi = begin[of[0]], end[of[-1]]
            rest += np.bincount(vec[lo:hi], weight[lo:hi] ** 2, len(x))
        self.levels.reverse()
        self.vec, self.weight = vec, weight.astype(np.float32)
        self.slack = np.sqrt(rest) * (x.shape[1] + 8) * 2.0 ** -23     # more than sums of floats are off by


def search(index: ImpactIndex, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int, stop: int = STOP,
           floor: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(query number, vector id, score) of each query's k best, exactly; those
    below the query's ``floor`` may be missing. Until they are scored exactly,
    scores are those of queries of length 1."""
    n, active, out, read, read_until = len(ids), np.arange(len(q)), [], 0, 0
    floor = np.full(len(q), NO_SCORE) if floor is None else floor
    size = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    size[size == 0] = 1
    weight = (q / size[:, None]).T.astype(np.float32)
    score = np.zeros((n, len(q)), np.float32)
    longest = max((hi - lo for level, _ in index.levels for _, lo, hi in level), default=0)
    have, more = (np.empty((longest, len(q)), np.float32) for _ in range(2))
    levels = index.levels or [([], np.zeros(n))]
    for turn, (segments, rest) in enumerate(levels):
        for component, lo, hi in segments:
            vec, old, add = index.vec[lo:hi], have[:hi - lo], more[:hi - lo]
            np.take(score, vec, axis=0, out=old, mode="clip")
            np.multiply(index.weight[lo:hi, None], weight[component], out=add)
            old += add
            score[vec] = old
            read += hi - lo
        last = turn + 1 == len(levels)
        if read - read_until < len(index.vec) / CHECKS and not last:
            continue
        read_until = read
        most = (rest * (1 + 1e-6) + index.slack).astype(np.float32)[:, None]
        own = ids[:, None] == q_ids[active]
        least = floor[active] / size[active]
        least -= np.abs(least) * 1e-6
        new = np.flatnonzero(floor[active] == NO_SCORE)
        if len(new):
            least[new] = -np.inf
            if n >= k:
                low = np.where(own[:, new], -np.inf, score[:, new] - most)
                least[new] = np.partition(low, n - k, axis=0)[n - k]
        possible = (score >= least.astype(np.float32) - most) & ~own
        done = (possible.sum(0) <= max(stop, k)) | last
        for column in np.flatnonzero(done).tolist():
            at = np.flatnonzero(possible[:, column])
            exact = index.x[at] @ q[active[column]]
            best = np.lexsort((ids[at], -exact))[:k]
            best = best[exact[best] >= floor[active[column]]]
            out.append((np.full(len(best), active[column]), ids[at][best], exact[best]))
        if done.all():
            break
        if done.any():
            active, score, weight = active[~done], np.compress(~done, score, 1), np.compress(~done, weight, 1)
            have, more = (np.empty((longest, len(active)), np.float32) for _ in range(2))
    return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*out, strict=True)) if out else \
        tuple(np.zeros((3, 0), np.int64))


def _best(found: list, k: int) -> tuple[np.ndarray, ...]:
    """Each query's k best of several results of ``search``."""
    of, ids, score = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((ids, -score, of))
    of = of[order]
    order = order[np.arange(len(of)) - np.searchsorted(of, of) < k]
    return tuple(np.concatenate(x)[order] for x in zip(*found, strict=True))


def _shards(batches: Iterator[pa.RecordBatch], width: int, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    ids, x = np.zeros(0, np.int64), np.zeros((0, width), np.int64)
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            part = batch.slice(lo, rows)
            ids = np.concatenate([ids, np.asarray(part.column(0))])
            x = np.concatenate([x, _matrix(part.column(1), width)])
            if len(ids) >= rows:
                yield ids[:rows], x[:rows]
                ids, x = ids[rows:], x[rows:]
    if len(ids):
        yield ids, x


def _search_shards(shared, width: int, rows: int, block: int, stop: int, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q, floor = shared.value
        floor, best = floor.copy(), tuple(np.zeros((3, 0), np.int64))
        for ids, x in _shards(batches, width, rows):
            index, found = ImpactIndex(x), [best]
            for lo in range(0, len(q), block):
                part = slice(lo, lo + block)
                of, near, score = search(index, ids, q[part], q_ids[part], k, stop, floor[part])
                found.append((of + lo, near, score))
            best = _best(found, k)
            last = np.flatnonzero(np.arange(len(best[0])) - np.searchsorted(best[0], best[0]) == k - 1)
            floor[best[0][last]] = np.maximum(floor[best[0][last]], best[2][last])
        yield pa.RecordBatch.from_arrays([pa.array(q_ids[best[0]]), pa.array(best[1]), pa.array(best[2])],
                                         names=["query_id", "vec_id", "score"])
    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _floors(best: DataFrame, q_ids: np.ndarray, k: int) -> np.ndarray:
    """The k-th score of each query so far."""
    kth = best.where(F.col("rank") == k).select("query_id", "score").orderBy("query_id").toArrow()
    ids, score = np.asarray(kth.column(0)), np.asarray(kth.column(1))
    if not len(ids):
        return np.full(len(q_ids), NO_SCORE)
    at = np.minimum(np.searchsorted(ids, q_ids), len(ids) - 1)
    return np.where(ids[at] == q_ids, score[at], NO_SCORE)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of ``vectors`` (vec_id, x) for each row
    of ``queries`` (vec_id, x). Both are read several times: give tables."""
    spark = vectors.sparkSession
    (n, wide), (m, wide_q) = (d.agg(F.count(F.lit(1)), F.max(F.size("x"))).first() for d in (vectors, queries))
    if not n or not m:
        return _ranked(spark.createDataFrame([], FOUND), k)
    width = max(wide, wide_q, 1)
    rows, parts = max(1, min(SHARD, SHARD_ITEMS // width)), -(-m // max(1, QUERY_ITEMS // width))
    waves = 1
    while WAVE * GROWTH ** (waves - 1) < n:
        waves += 1
    draw = F.pmod(F.xxhash64("vec_id", "x"), F.lit(GROWTH ** (waves - 1)))
    wave = sum(((draw >= GROWTH ** i).cast("int") for i in range(waves - 1)), F.lit(0))
    path = f"{checkpoint_dir(spark).rstrip('/')}/found-{uuid4().hex}"
    for part in range(parts):
        block = queries.where(F.pmod(F.xxhash64("vec_id", "x"), F.lit(parts)) == part).select("vec_id", "x").toArrow()
        if not block.num_rows:
            continue
        q_ids = np.asarray(block.column(0))
        q = np.concatenate([_matrix(c, width) for c in block.column(1).chunks])
        floor, best = np.full(len(q), NO_SCORE), None
        for turn in range(waves):
            shared = spark.sparkContext.broadcast((q_ids, q, floor))
            found = vectors.where(wave == turn).select("vec_id", "x").mapInArrow(
                _search_shards(shared, width, rows, QUERY_BLOCK, STOP, k), FOUND)
            best = _ranked(found if best is None else best.drop("rank").unionByName(found), k)
            if turn + 1 < waves:
                best = written(best)
                floor = _floors(best, q_ids, k)
        best.write.mode("append").parquet(path)
    return _ranked(spark.read.schema(f"{FOUND}, rank int").parquet(path).drop("rank"), k)


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = written(quantised(table(spark, sf_dir, "embeddings")))
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
d AS (SELECT DISTINCT vec_id, x FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
  FROM d q JOIN d c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
