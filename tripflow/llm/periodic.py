"""Periodic run detection by string synchronising sets.

A run is a longest stretch of consecutive words with smallest period q (words
q apart are identical) and a length of at least ``MIN_EXPONENT`` * q.

* Periods below ``SMALL`` are found directly: longest stretches in which every
  word equals the one q further on.
* For each dyadic scale t = SMALL, 2 SMALL, 4 SMALL, ... the synchronising set
  holds the positions i at which the least hash of the t-word stretches that
  start in i..i+t stands at i or at i+t. Whether i belongs depends on the 2t
  words from i alone, so equal contexts are both in or both out. Each position
  of the set proposes the distance to the next one with the same 2t words, if
  that is in t..2t-1, as a period.
* Stretches that lie within a run of period at most t/4 take no part at scale t
  (a set there would hold a position for each repetition); their periods are
  supplied by the smaller scales and the direct search, which went before.
* A proposal is extended to both sides by binary search over prefix hashes of
  words; what is long enough is a run.

A run of period q in t..2t-1 holds, in the first q of its positions, a position
of the set whose context recurs q further on and no earlier, so none is lost
(words are compared by 64-bit hashes).

Defined cases: a null, empty or blank text has no words and no run; a text of
any length is searched whole; a repeated row is described like any other; an
empty table gives no rows. Only the named columns are read, so other columns,
whatever their names, don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tripflow.llm.text import Block, blocks, joined_sha256, sequence_prefix, span_hash, table

MIN_LENGTH = 6
MIN_EXPONENT = 4
SMALL = 8               # smaller periods are compared directly; a power of two
BATCH_ROWS = 1_000      # rows of a batch that are worked on together

_NONE = np.uint64(2 ** 64 - 1)


def _stretches(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest stretches of True."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _small_periods(value: np.ndarray, row: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, length, period) of all runs of a period below SMALL."""
    found = []
    for q in range(1, SMALL):
        if len(value) <= q:
            break
        lo, hi = _stretches((value[:-q] == value[q:]) & (row[:-q] == row[q:]))
        length = hi - lo + q
        keep = length >= MIN_EXPONENT * q
        lo, length = lo[keep], length[keep]
        for d in range(1, q):       # q is not the smallest period where a divisor is one
            if q % d == 0 and len(lo):
                other = span_hash(prefix, lo, lo + length - d) != span_hash(prefix, lo + d, lo + length)
                lo, length = lo[other], length[other]
        found.append((lo, length, np.full(len(lo), q)))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _reach(equal: Callable[[np.ndarray], np.ndarray], limit: np.ndarray) -> np.ndarray:
    """Per element the largest length up to ``limit`` for which ``equal`` holds."""
    lo, hi = np.zeros(len(limit), np.int64), limit.copy()
    while (lo < hi).any():
        middle = (lo + hi + 1) // 2
        ok = equal(middle)
        lo, hi = np.where(ok, middle, lo), np.where(ok, hi, middle - 1)
    return lo


def _synchronising(at: np.ndarray, left: np.ndarray, t: int, prefix: np.ndarray, periodic: np.ndarray) -> np.ndarray:
    """The positions among ``at`` (of whole rows, in order; ``left`` words from
    there to the row's end) in the set of scale t; ``periodic`` marks stretches
    that take no part."""
    name = np.full(len(at), _NONE)
    there = (left >= t) & ~periodic[at]
    name[there] = span_hash(prefix, at[there], at[there] + t)
    least, width = name, 1
    while width < t:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-1], least[1:])           # of the t + 1 stretches from i
    n = len(least)
    chosen = (least != _NONE) & ((name[:n] == least) | (name[t:t + n] == least)) & (left[:n] >= 2 * t)
    return at[:n][chosen]


def _scale(t: int, row: np.ndarray, first: np.ndarray, prefix: np.ndarray, known: tuple) -> tuple[np.ndarray, ...]:
    """(start, length, period) of all runs of a period in t..2t-1; ``known``
    holds those of all smaller periods."""
    none = tuple(np.zeros(0, np.int64) for _ in range(3))
    long = np.flatnonzero(np.diff(first) >= MIN_EXPONENT * t)
    if not len(long):
        return none
    size = np.diff(first)[long]
    at = np.repeat(first[long] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    left = first[row[at] + 1] - at
    start, length, period = known
    inside = (period * 4 <= t) & (length >= t)
    mark = np.zeros(len(row) + 1, np.int64)
    np.add.at(mark, start[inside], 1)
    np.subtract.at(mark, (start + length - t + 1)[inside], 1)
    i = _synchronising(at, left, t, prefix, np.cumsum(mark[:-1]) > 0)
    context = span_hash(prefix, i, i + 2 * t)
    order = np.argsort(context + row[i].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), kind="stable")
    i, context = i[order], context[order]
    gap = i[1:] - i[:-1]
    proposes = (context[1:] == context[:-1]) & (row[i[1:]] == row[i[:-1]]) & (gap >= t) & (gap < 2 * t)
    i, d = i[:-1][proposes], gap[proposes]
    if not len(i):
        return none
    after = _reach(lambda x: span_hash(prefix, i, i + x) == span_hash(prefix, i + d, i + d + x),
                   first[row[i] + 1] - i - d)
    before = _reach(lambda x: span_hash(prefix, i - x, i) == span_hash(prefix, i + d - x, i + d), i - first[row[i]])
    found = np.unique(np.stack([i - before, before + after + d, d], axis=1), axis=0)
    found = found[found[:, 1] >= MIN_EXPONENT * found[:, 2]]
    return found[:, 0], found[:, 1], found[:, 2]


def find_runs(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, length, period) of all runs of rows of word hashes, by row,
    start and period; row r's words are ``value[first[r]:first[r + 1]]`` and
    ``start`` counts within all of ``value``."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    prefix = sequence_prefix(value)
    known = _small_periods(value, row, prefix)
    longest, t = int(np.diff(first).max(initial=0)), SMALL
    while MIN_EXPONENT * t <= longest:
        known = tuple(np.concatenate(x) for x in zip(known, _scale(t, row, first, prefix, known), strict=True))
        t *= 2
    start, length, period = (x[known[1] >= MIN_LENGTH] for x in known)
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    return row[start], start, length, period


def _words(b: Block) -> tuple[np.ndarray, ...]:
    start, end, first = b.words()
    return start, end, first, span_hash(b.prefix_hash(), start, end)


def _in_batches(docs: DataFrame, text: str, per_block: Callable[[Block, pa.RecordBatch], pa.RecordBatch],
                schema: str) -> DataFrame:
    """``per_block`` of each run of rows; whole texts stay in the worker."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(lo, BATCH_ROWS)
                for b in blocks(part.column(place)):
                    yield per_block(b, part.slice(b.lo, b.rows))

    return docs.mapInArrow(run, schema)


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, period), one row for each run of each row's
    text; start is a word number from 0."""
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, start long, length long, period long"
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = to_arrow_schema(source.select("doc_id").schema).field(0).type

    def per_block(b: Block, rows: pa.RecordBatch) -> pa.RecordBatch:
        _, _, first, value = _words(b)
        row, start, length, period = find_runs(value, first)
        return pa.RecordBatch.from_arrays(
            [rows.column(0).take(pa.array(row)).cast(id_type), pa.array(start - first[row]), pa.array(length),
             pa.array(period)], names=["doc_id", "start", "length", "period"])

    return _in_batches(source, "text", per_block, schema)


def _repeated_tails(first: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """The index of the word that stands at each place once every row with
    seed % 10 = 0 repeats a stretch of its words from a place on (see
    ``collapse``); a negative seed changes nothing."""
    n = np.diff(first)
    g = seed // 10
    on = (seed >= 0) & (seed % 10 == 0) & (n > 0)
    a = np.where(on, g % np.maximum(n, 1), n)
    p = np.where(on, 1 + (n - a) // (3 + g % 8), 1)
    number = np.arange(first[-1]) - np.repeat(first[:-1], n)
    a, p = np.repeat(a, n), np.repeat(p, n)
    return np.repeat(first[:-1], n) + np.where(number >= a, a + (number - a) % p, number)


COLLAPSED = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
             "collapsed_sha256 string")


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id; the number of runs; start, length, period
    and floor(1000 * length / period) of the longest run (ties: smallest start,
    then period; nulls without a run); sha256 of the list of runs; sha256 of the
    words that stay when every word goes that some run has after its first
    period.

    With ``seed_col`` (a long h; null: no change) the words of rows with
    h % 10 = 0 are first replaced: with g = h // 10 and n words, each word
    i >= a by word a + (i - a) % p, where a = g % n, p = 1 + (n - a) // (3 + g % 8).
    """
    seed = F.lit(-1) if seed_col is None else F.coalesce(F.col(seed_col), F.lit(-1))
    source = docs.select(F.col(id_col).alias("doc_id"), seed.cast("long").alias("seed"), F.col(text_col).alias("text"))
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, {COLLAPSED}"
    nothing = sha256(b"").hexdigest()

    def per_block(b: Block, rows: pa.RecordBatch) -> pa.RecordBatch:
        ws, we, first, value = _words(b)
        place = _repeated_tails(first, rows.column(1).to_numpy(zero_copy_only=False))
        ws, we, value = ws[place], we[place], value[place]
        row, start, length, period = find_runs(value, first)
        gone = np.zeros(len(value) + 1, np.int64)
        np.add.at(gone, start + period, 1)
        np.subtract.at(gone, start + length, 1)
        kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
        number = start - first[row]
        # the longest run of each row, and the text of all its runs
        order = np.lexsort((period, start, -length, row))
        best = order[np.concatenate([[True], row[order][1:] != row[order][:-1]])] if len(order) else order
        columns = [pa.nulls(b.rows, pa.int64()).to_pylist() for _ in range(4)]
        for r, *x in zip(row[best].tolist(), number[best].tolist(), length[best].tolist(), period[best].tolist(),
                         (1000 * length[best] // period[best]).tolist(), strict=True):
            for c, v in zip(columns, x, strict=True):
                c[r] = v
        digests = [nothing] * b.rows
        cut = np.searchsorted(row, np.arange(b.rows + 1))
        for r in np.unique(row).tolist():
            one = slice(cut[r], cut[r + 1])
            lines = [f"{s},{n},{q}\n" for s, n, q in zip(number[one].tolist(), length[one].tolist(),
                                                         period[one].tolist(), strict=True)]
            digests[r] = sha256("".join(lines).encode()).hexdigest()
        texts = joined_sha256(b.buf, ws[kept], we[kept], np.searchsorted(kept, first))
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(np.diff(cut), pa.int64()), *(pa.array(c, pa.int64()) for c in columns),
             pa.array(digests, pa.string()), pa.array(texts, pa.string())],
            names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    return _in_batches(source, "text", per_block, schema)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    seeded = docs.withColumn("seed", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    return collapse(seeded, seed_col="seed")
