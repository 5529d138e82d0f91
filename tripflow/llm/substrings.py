"""Substring dedup over a sparse de Bruijn graph of token k-mers.

Edges are the ``EDGE`` consecutive words of one document (its windows), so two
windows are the same edge if and only if their words are equal.

* **Pieces.** Each edge hangs on a node, the least-hashed ``NODE``-word k-mer in
  it (the leftmost of equals), which depends on the edge's words alone. Edges
  that follow one another on the same occurrence of their node form a piece:
  (node, path, document, start, number of edges), where path is the hash of all
  the piece's words. Equal pieces that follow one another (periodic text) are
  one row with their number.
* **Shared nodes.** Only nodes that stand in several documents go further; a
  document's own words, most of a corpus, end here.
* **Compaction.** Pieces with the same node and path are one path, whatever the
  number of documents; a join brings them the smallest document in which the
  path starts. All edges of a piece in a later document also start there, so
  the piece is settled as a whole, and only the path's first occurrence is
  looked at further. A node with a single path doesn't branch: there is nothing
  to compare.
* **Branching nodes.** Where paths with different words share a node, the first
  occurrence of each is read again by its coordinates (document, start) and
  opened into single edges. Edges whose hash is in several documents are kept by
  a join; of these, a join by node and edge finds those that also start in a
  document with a smaller id. This settles where paths begin, part and end.
* **Coverage.** Settled stretches are gathered per document and their words go.

Joins split keys with more than 1/HOT_PARTS of the rows (there are at most
HOT_PARTS of them, so their side is broadcast) from the others.

Defined cases: a row with a null id is no source and keeps all its words; rows
with the same id aren't smaller than one another, so none loses words to
another; windows that recur only within one document stay; a null text has no
words; texts of any length are read whole; an empty table gives no rows. Only
the named columns are read, so other columns, whatever their names, don't
matter. Hashes have 64 bits (node and path together 128).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.text import (
    Block,
    blocks,
    joined_sha256,
    sequence_prefix,
    span_hash,
    table,
    written,
)

EDGE = 50               # words of a window
NODE = 16               # words of a k-mer that pieces hang on
HOT_PARTS = 1_000       # a key is hot beyond this part of the rows
BATCH_ROWS = 1_000

DOC = ["doc_id", "text_key"]        # a text of a document: rows that repeat both are alike


def _values(b: Block) -> tuple[np.ndarray, ...]:
    start, end, first = b.words()
    return start, end, first, span_hash(b.prefix_hash(), start, end)


def _leftmost_least(name: np.ndarray, width: int) -> np.ndarray:
    """For each i with ``width`` names from i on, the place of the least (of equals the first)."""
    least, place, w = name, np.arange(len(name)), 1
    while w < width:
        step = min(w, width - w)
        if len(least) <= step:
            return np.zeros(0, np.int64)
        left = least[:-step] <= least[step:]
        least, place = np.where(left, least[:-step], least[step:]), np.where(left, place[:-step], place[step:])
        w += step
    return place


def _pieces(value: np.ndarray, first: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, edges, node) of the pieces of rows of word hashes, in order."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    n = len(value)
    if n < EDGE:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64))
    at = np.arange(n - NODE + 1)
    name = span_hash(prefix, at, at + NODE)         # those over a row's end are in no window
    place = _leftmost_least(name, EDGE - NODE + 1)
    window = np.flatnonzero(np.arange(len(place)) + EDGE <= first[row[:len(place)] + 1])
    place = place[window]
    # places differ between rows, and between stretches of windows with a gap
    new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else window
    edges = np.diff(np.append(new, len(place)))
    return window[new], edges, name[place[new]]


def _repeats(row: np.ndarray, start: np.ndarray, edges: np.ndarray, path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pieces in order: which differ from the one just before them in the
    text, and how many equal ones each of those stands for."""
    same = ((row[1:] == row[:-1]) & (path[1:] == path[:-1]) & (edges[1:] == edges[:-1])
            & (start[1:] == start[:-1] + edges[:-1]))
    new = np.flatnonzero(np.concatenate([[True], ~same])) if len(row) else row
    return new, np.diff(np.append(new, len(row)))


def _in_batches(source: DataFrame, per_block: Callable[[Block, pa.RecordBatch], dict], schema: str) -> DataFrame:
    place = source.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(lo, BATCH_ROWS)
                for b in blocks(part.column(place)):
                    out = per_block(b, part.slice(b.lo, b.rows))
                    yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return source.mapInArrow(run, schema)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())


def pieces(source: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, edges, times, node, path) of all pieces of
    texts (doc_id, text_key, text); ``times`` equal pieces follow one another."""

    def per_block(b: Block, rows: pa.RecordBatch) -> dict:
        _, _, first, value = _values(b)
        prefix = sequence_prefix(value)
        start, edges, node = _pieces(value, first, prefix)
        row = np.searchsorted(first, start, side="right") - 1
        path = span_hash(prefix, start, start + edges + EDGE - 1)
        new, times = _repeats(row, start, edges, path)
        row, start = row[new], start[new]
        who = pa.array(row)
        return {"doc_id": rows.column(0).take(who), "text_key": rows.column(1).take(who),
                "start": _long(start - first[row]), "edges": pa.array(edges[new], pa.int32()), "times": _long(times),
                "node": _long(node[new]), "path": _long(path[new])}

    return _in_batches(source, per_block,
                       f"doc_id {_id_type(source)}, text_key long, start long, edges int, times long, node long, path long")


def _id_type(source: DataFrame) -> str:
    return source.schema["doc_id"].dataType.simpleString()


def open_edges(source: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, at, edge) of all edges of the pieces at ``places`` (doc_id,
    text_key, place, start, edges), read from the texts again; ``at`` is
    place * EDGE + the edge's number in its piece."""
    wanted = places.groupBy(*DOC).agg(F.collect_list(F.struct("start", "edges", "place")).alias("places"))

    def per_block(b: Block, rows: pa.RecordBatch) -> dict:
        _, _, first, value = _values(b)
        prefix = sequence_prefix(value)
        lists = rows.column(3)
        items = lists.flatten()
        row = np.repeat(np.arange(b.rows), np.asarray(lists.value_lengths()))
        start, edges, place = (np.asarray(items.field(k)) for k in range(3))
        which = np.repeat(np.arange(len(start)), edges)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(edges) - edges, edges)
        at = first[row][which] + start[which] + offset
        return {"doc_id": rows.column(0).take(pa.array(row[which])), "at": _long(place[which] * EDGE + offset),
                "edge": _long(span_hash(prefix, at, at + EDGE))}

    joined = source.join(wanted, DOC).select(*DOC, "text", "places")
    return _in_batches(joined, per_block, f"doc_id {_id_type(source)}, at long, edge long")


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` joined with their groups (one row a key, with its number of rows
    as ``n``). Keys with more than 1/HOT_PARTS of all ``total`` rows are at most
    HOT_PARTS, so that side is broadcast; the others' rows are shuffled."""
    hot = F.col("n") > F.lit(max(total // HOT_PARTS, 1))
    few = F.broadcast(groups.where(hot))
    return (rows.join(few, keys)
            .unionByName(rows.join(few.select(keys), keys, "left_anti").join(groups.where(~hot), keys)))


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, least, n) of the keys whose rows have several doc_ids."""
    return (rows.groupBy(*keys).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count(F.lit(1)).alias("n"))
            .where("least < most").drop("most"))


def repeated_spans(source: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, edges): stretches of windows, by the word of
    the first, that also start in a document with a smaller id. Each such
    window of ``source`` (doc_id, text_key, text) is in at least one."""
    every = written(pieces(source.where("doc_id IS NOT NULL")))
    nodes = written(every.groupBy("node").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), (F.min("path") < F.max("path")).alias("branches"),
        F.count(F.lit(1)).alias("n")).where("least < most").select("node", "branches", "n"))
    found = written(join_groups(every, nodes, ["node"], every.count()).drop("n"))
    paths = written(found.groupBy("node", "path").agg(
        F.min(F.struct("doc_id", "text_key", "start", "edges")).alias("source"), F.max("doc_id").alias("last"),
        F.first("branches").alias("branches"), F.count(F.lit(1)).alias("n")))
    # whole pieces: their path starts in a smaller document
    again = paths.where(F.col("source.doc_id") < F.col("last")).select("node", "path", F.col("source.doc_id").alias("least"), "n")
    whole = (join_groups(found, again, ["node", "path"], found.count()).where("doc_id > least")
             .select(*DOC, "start", (F.col("edges") * F.col("times")).alias("edges")))
    # branching nodes: edges of the first occurrence of each path
    branching = written(paths.where("branches").select(F.monotonically_increasing_id().alias("place"), "node", "path", "source.*"))
    edges = written(open_edges(source, branching))
    same = join_groups(edges.select("at", "edge"), _shared(edges, ["edge"]).drop("least"), ["edge"], edges.count())
    same = written(same.select("edge", F.floor(F.col("at") / EDGE).alias("place"), (F.col("at") % EDGE).alias("offset"))
                   .join(branching.select("place", "doc_id", "node", "path"), "place"))
    earlier = join_groups(same, _shared(same, ["node", "edge"]), ["node", "edge"], same.count()).where("doc_id > least")
    single = earlier.groupBy("doc_id", "node", "path").agg(F.collect_set("offset").alias("offsets"))
    offsets = F.flatten(F.transform(F.sequence(F.lit(0).cast("long"), F.col("times") - 1), lambda k: F.transform(
        "offsets", lambda x: F.col("start") + k * F.col("edges") + x)))
    part = (found.where("branches").join(single, ["doc_id", "node", "path"])      # all occurrences in that document
            .select(*DOC, F.explode(offsets).alias("start"), F.lit(1).cast("long").alias("edges")))
    return whole.unionByName(part)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))


def _with_spans(source: DataFrame) -> DataFrame:
    """``source`` with ``spans``, each text's repeated stretches (null: none)."""
    spans = (repeated_spans(source).groupBy(*DOC)
             .agg(F.collect_list(F.struct("start", "edges")).alias("spans")))
    return source.join(spans, DOC, "left").select("doc_id", "text", "spans")


def _kept(b: Block, first: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Which words of a block's rows are in none of their spans."""
    items = lists.flatten()
    size = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
    row = np.repeat(np.arange(b.rows), size)
    at = first[row] + np.asarray(items.field(0))
    cover = np.zeros(int(first[-1]) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.subtract.at(cover, at + np.asarray(items.field(1)) + EDGE - 1, 1)
    return np.cumsum(cover[:-1]) == 0


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): every row, its words that no repeated window covers joined
    by one space (a text that loses nothing stays as it is; null stays null)."""
    source = keyed(docs, id_col, text_col)

    def per_block(b: Block, rows: pa.RecordBatch) -> dict:
        start, end, first, _ = _values(b)
        keep = _kept(b, first, rows.column(2))
        buf, old, out = b.buf.tobytes(), rows.column(1), []
        for r in range(b.rows):
            words = np.flatnonzero(keep[first[r]:first[r + 1]]) + first[r]
            if len(words) == first[r + 1] - first[r]:
                out.append(old[r].as_py())
            else:
                out.append(b" ".join(buf[start[w]:end[w]] for w in words).decode())
        return {"doc_id": rows.column(0), "text": pa.array(out, pa.string())}

    return _in_batches(_with_spans(source), per_block, f"doc_id {_id_type(source)}, text string")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row."""
    source = keyed(docs, id_col, text_col)

    def per_block(b: Block, rows: pa.RecordBatch) -> dict:
        start, end, first, _ = _values(b)
        keep = np.flatnonzero(_kept(b, first, rows.column(2)))
        cut = np.searchsorted(keep, first)
        return {"doc_id": rows.column(0), "n_words": _long(np.diff(first)), "n_removed": _long(np.diff(first) - np.diff(cut)),
                "kept_sha256": pa.array(joined_sha256(b.buf, start[keep], end[keep], cut), pa.string())}

    return _in_batches(_with_spans(source), per_block,
                       f"doc_id {_id_type(source)}, n_words long, n_removed long, kept_sha256 string")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


ORACLE_SQL = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS k, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
win AS (
  SELECT k, doc_id, i, md5(array_to_string(w[i:i + {EDGE - 1}], ' ')) AS g
  FROM (SELECT k, doc_id, w, unnest(range(1, len(w) - {EDGE - 2})) AS i FROM doc WHERE len(w) >= {EDGE})),
least AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS (
  SELECT DISTINCT k, unnest(range(i, i + {EDGE})) AS p FROM win JOIN least USING (g) WHERE m < doc_id),
word AS (SELECT k, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM doc),
kept AS (SELECT k, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (k, p) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (k)
"""
