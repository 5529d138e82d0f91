"""Whole-text helpers shared by the operators of this subpackage.

A text column arrives in Python as Arrow batches. ``blocks`` cuts a batch into
runs of rows of about ``BLOCK_BYTES`` of text, whole rows only, so that the
working arrays (a few machine words per byte) stay small however many rows a
batch holds; a single longer text forms a block of its own. Words and lines
are then found for all rows of a block at once with numpy.

Null and empty texts have no bytes: no words, no lines with a word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.plans.partitioning import reliable_checkpoint, written  # noqa: F401

BLOCK_BYTES = 500_000

# fixed values: white space is these bytes and no others
WHITE_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(WHITE_SPACE)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_RNG = np.random.default_rng(20240607)
_BYTE_VALUE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2 ** 64)
_powers: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage."""
    return reliable_checkpoint(df)


def crc_mod(id_col: str, m: int) -> Column:
    """crc32 of the id's text modulo ``m``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(m)


def label_sample(labels: DataFrame, label: str, folds: int, held_out: int, max_docs: int,
                 id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of at most ``max_docs`` labelled documents outside the
    held-out fold: those with the smallest id hashes. Where rows for one
    document disagree, the smaller label counts."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("label"))
    return (known.where(F.col("label").isNotNull() & (crc_mod("doc_id", folds) != held_out))
            .groupBy("doc_id").agg(F.min("label").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power(base: int, n: int) -> np.ndarray:
    key = str(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        out = np.full(size, np.uint64(base))
        out[0] = 1
        have = np.multiply.accumulate(out)
        if size <= 4 * BLOCK_BYTES:
            _powers[key] = have
    return have[:n]


@dataclass
class Block:
    """Rows ``lo``..``hi`` of a batch: bytes ``buf`` of their texts, row
    offsets ``off`` (rows + 1 values)."""

    lo: int
    hi: int
    buf: np.ndarray
    off: np.ndarray

    @property
    def rows(self) -> int:
        return self.hi - self.lo

    def row_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, position, side="right") - 1

    def lower(self) -> Block:
        """The same with A-Z lower-cased."""
        return Block(self.lo, self.hi, _LOWER[self.buf], self.off)

    def prefix_hash(self) -> np.ndarray:
        n = len(self.buf)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[self.buf] * _power(_BASE, n), out=out[1:])
        return out

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words; per row, the index of its first word
        (rows + 1 values)."""
        return self.runs(~_IS_SPACE[self.buf])

    def runs(self, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``words``, for longest runs of bytes marked in ``solid`` within a row."""
        n = len(self.buf)
        first = np.zeros(n + 1, bool)
        first[self.off] = True
        before = np.ones(n, bool)
        before[1:] = ~solid[:-1]
        start = np.flatnonzero(solid & (before | first[:n]))
        after = np.ones(n, bool)
        after[:-1] = ~solid[1:]
        end = np.flatnonzero(solid & (after | first[1:])) + 1
        return start, end, np.searchsorted(start, self.off)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all lines, split at \\n; first line per row. An
        empty text is one empty line, as a null text is."""
        cut = np.flatnonzero(self.buf == 10)
        start = np.sort(np.concatenate([self.off[:-1], cut + 1]), kind="stable")
        at = np.arange(self.rows) + np.searchsorted(cut, self.off[:-1])
        end = np.empty(len(start), np.int64)
        end[:-1] = start[1:] - 1
        end[at[1:] - 1] = self.off[1:-1]
        if len(end):
            end[-1] = self.off[-1]
        return start, end, np.append(at, len(start))


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, the same wherever it stands."""
    n = int(start.max()) + 1 if len(start) else 0
    h = (prefix[end] - prefix[start]) * _power(_BASE_INVERSE, n)[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def sequence_hash(word: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each index in ``at``."""
    h = np.full(len(at), np.uint64(length))
    for k in range(length):
        h = h * np.uint64(0xFF51AFD7ED558CCD) + word[at + k]
        h ^= h >> np.uint64(29)
    return mix(h)


def sequence_prefix(value: np.ndarray) -> np.ndarray:
    """Prefix for ``span_hash`` over a sequence of 64-bit values (such as the
    hashes of words) instead of bytes."""
    out = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(value * _power(_BASE, len(value)), out=out[1:])
    return out


def joined(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The spans one after another, each followed by one space, and where each
    begins (spans + 1 values)."""
    at = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start + 1, out=at[1:])
    source = np.repeat(start - at[:-1], np.diff(at)) + np.arange(at[-1])
    out = buf[np.minimum(source, max(len(buf) - 1, 0))] if len(source) else np.zeros(0, np.uint8)
    out[at[1:] - 1] = 32
    return out.tobytes(), at


def joined_sha256(buf: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> list[str]:
    """Per row (its spans are ``first[r]``..``first[r + 1]``) the lowercase hex
    sha256 of its spans joined by one space."""
    data, at = joined(buf, start, end)
    data = memoryview(data)
    lo, hi = at[first[:-1]].tolist(), at[first[1:]].tolist()
    return [sha256(data[a:max(a, b - 1)]).hexdigest() for a, b in zip(lo, hi, strict=True)]


def _string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    n, at = len(column), column.offset
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64, n + 1, at * 8)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:   # a null's bytes, if it has any, are not text
        keep = np.repeat(~np.asarray(column.is_null()), np.diff(off))
        size = np.where(np.asarray(column.is_null()), 0, np.diff(off))
        return buf[off[0]:off[-1]][keep], np.concatenate([[0], np.cumsum(size)])
    return buf[off[0]:off[-1]], off - off[0]


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of a string column, in order, all rows once."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    buf, off = _string_parts(column)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, side="right")) - 1)
        hi = min(hi, n)
        yield Block(lo, hi, buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        lo = hi


def text_udf(per_block: Callable[[Block], dict], schema: pa.StructType) -> Callable[[Column], Column]:
    """A column function: struct of ``schema`` for each whole text, from
    ``per_block``, which returns an array (or Arrow array) for each field.

    Marked nondeterministic only so that Catalyst evaluates it once when
    several of its fields are used.
    """

    def whole(column: pa.Array) -> pa.Array:
        parts = []
        for block in blocks(column):
            found = per_block(block)
            parts.append(pa.StructArray.from_arrays(
                [pa.array(found[f.name], type=f.type) for f in schema], fields=list(schema)))
        return pa.concat_arrays(parts) if parts else pa.array([], type=schema)

    from pyspark.sql.pandas.types import from_arrow_type
    whole.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(whole, from_arrow_type(schema)).asNondeterministic()


def fresh(name: str, docs: DataFrame) -> str:
    """``name``, with underscores added until no column of ``docs`` is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def filter_rows(docs: DataFrame, column: str, keep: Callable[[pa.Array], np.ndarray], rows: int = 1_000) -> DataFrame:
    """The rows of ``docs`` for which ``keep`` of a column's values is true.
    Whole rows pass through the worker a batch at a time, so that no texts wait
    on disk beside a column function."""
    place = docs.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                yield part.filter(pa.array(keep(part.column(place))))

    return docs.mapInArrow(run, docs.schema)


def by_block(column: pa.Array, per_block: Callable[[Block], np.ndarray]) -> np.ndarray:
    """The values of ``per_block`` for all rows of a text column."""
    return np.concatenate([np.zeros(0, bool), *(per_block(b) for b in blocks(column))]).astype(bool)
