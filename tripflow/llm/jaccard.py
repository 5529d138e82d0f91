"""N-gram Jaccard join with set-relation skipping.

A document's set is its distinct word shingles, as 64-bit hashes; equal sets
are one set. Two sets link when their Jaccard similarity is at least 3/4.
Components of linked documents are found exactly, without comparing all
members of a group with each other:

1.  A pass over all texts counts shingles in a sketch of fixed size a task;
    the tasks' sketches are added up. Sets are ordered by the sketch's classes
    (rare first), then by hash. Any order is right; this one keeps passages
    that many texts share out of the index.
2.  Linked sets of sizes x and y share at least ceil(3 (x + y) / 7) shingles,
    so their first quarters share one. The index lists, for each shingle of
    a set's first ``prefix`` shingles, (set, size, position), sorted by size.
3.  Along a list, sets of unfit sizes or positions are skipped: the shingles
    in common are at most min(positions) + 1 + min(what follows). Pairs that
    pass are counted over all lists; as the prefix is a twentieth longer than
    needed, a linked pair must share more than one of its shingles.
4.  A list of more than ``LONG`` sets isn't read pair by pair; it only counts
    where it can hold the first shingle that two linked sets share, and for
    sets that share enough indexed shingles with others at all.
5.  What pairs and long lists connect are clusters. A cluster of at most
    ``CLUSTER_SETS`` sets and ``CLUSTER_ITEMS`` shingles in all goes to one
    task, which compares it.
6.  In larger ones each set is compared with the partner it shares most with
    and with a few leaders of its long lists. Linked sets form groups.
7.  A set's remaining answers derive from its group's: pairs within a group
    are settled, and in a long list only sets outside its main group meet
    others, chunk by chunk. All pairs left are compared, and the groups they
    link are joined.

Defined cases: a text without words has no set, size 0, and is its own
component; fewer words than a shingle make one shingle of all words; copies
and repeated rows share a set; a null id can't name a component (its own is
the smallest id that it reaches, null if there is none); only id and text are
read, whatever other columns are called; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.components import components
from tripflow.llm.text import Block, blocks, filter_rows, fresh, mix, sequence_hash, span_hash, table, written

SHINGLE = 5                 # words
SKETCH_BITS = 20            # the sketch has 2 ** SKETCH_BITS counters
FILTER_BITS = 23            # bits of the filter of candidate sets
LONG = 128                  # sets of a list that are compared pair by pair
LEADERS = 4                 # sets of a longer list that all its sets are compared with
CLUSTER_ITEMS = 4_000_000   # shingles of a cluster that one task compares whole (32 MB)
CLUSTER_SETS = 2048         # sets of such a cluster: their counts in common are a square (16 MB)
ROWS = 256                  # rows of that square that are tested at a time
OUTER, MEMBERS = 512, 2048  # sets of a longer list that one task compares
COLUMNS = 4096              # shingles of a comparison's matrices
NO_ID = -(1 << 63)          # stands for a null id
SKETCH_BLOCK = 256          # counters of a row of the sketch
FLUSH = 400_000             # pairs that a task gathers before it counts them


def prefix_size(n):
    """Shingles of a set of ``n`` that are indexed: n - ceil(3n/4) + 1 and a twentieth of n."""
    return n - (3 * n + 3) // 4 + 1 + n // 20


def shingles(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted by row and hash: rows, hashes, and each
    row's first (rows + 1 values)."""
    b = b.lower()
    start, end, first = b.words()
    word = span_hash(b.prefix_hash(), start, end)
    n_words = np.diff(first)
    row = np.repeat(np.arange(b.rows), n_words)
    at = np.arange(len(word))
    at = at[at + SHINGLE <= first[1:][row]]
    rows, hashes = [row[at]], [sequence_hash(word, at, SHINGLE)]
    for n in range(1, SHINGLE):
        few = np.flatnonzero(n_words == n)
        rows.append(few)
        hashes.append(sequence_hash(word, first[:-1][few], n))
    r, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, r))
    r, h = r[order], h[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    r, h = r[new], h[new]
    return r, h, np.searchsorted(r, np.arange(b.rows + 1))


def set_ids(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit id of each row's set; 0 for an empty one."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(h ^ np.uint64(0xA0761D6478BD642F)))])
    n = np.diff(first)
    ids = mix((sums[first[1:]] - sums[first[:-1]]) + n.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
    return np.where(n > 0, ids, np.uint64(0)).view(np.int64)


def _unseen(ids: np.ndarray, seen: set) -> np.ndarray:
    """Rows with the first occurrence of a non-empty set in this task."""
    out = []
    for k, x in enumerate(ids.tolist()):
        if x and x not in seen:
            seen.add(x)
            out.append(k)
    return np.array(out, np.int64)


def _members(first: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Indices of all shingles of ``rows``, in order."""
    size = first[rows + 1] - first[rows]
    return np.arange(int(size.sum())) + np.repeat(first[rows] - (np.cumsum(size) - size), size)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document (kind 0: id, set, size); per task its sketch (kind 1: block of counters, their counts)."""
    seen: set = set()
    sketch = np.zeros(1 << SKETCH_BITS, np.int64)
    names = ["kind", "doc_id", "set", "n", "counts"]
    for batch in batches:
        doc = batch.column(0)
        for b in blocks(batch.column(1)):
            _, h, first = shingles(b)
            ids = set_ids(h, first)
            mine = h[_members(first, _unseen(ids, seen))]
            np.add.at(sketch, (mine >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(b.rows, np.int32)), doc.slice(b.lo, b.rows).cast(pa.int64()), pa.array(ids),
                 pa.array(np.diff(first)), pa.nulls(b.rows, pa.binary())], names=names)
    counts = np.minimum(sketch, 0xFFFF).astype(np.uint16).reshape(-1, SKETCH_BLOCK)
    used = np.flatnonzero(counts.any(1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(used), np.int32)), pa.nulls(len(used), pa.int64()), pa.array(used),
         pa.nulls(len(used), pa.int64()), pa.array([x.tobytes() for x in counts[used]], pa.binary())], names=names)


def _summed(kind: type) -> Callable:
    """Counts (of type ``kind``) of the blocks that a task reads, added up as they come."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total.setdefault(block, np.zeros(SKETCH_BLOCK, np.int64)).__iadd__(np.frombuffer(counts.as_buffer(), kind))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()),
                                          pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["set", "counts"])
    return run


def _classes(sketch: DataFrame) -> np.ndarray:
    """Order class of each counter: 0 up to LONG shingles more than the mean of
    all counters, or as long as chance explains the excess; then one more for
    each doubling. The driver receives one number a counter."""
    part = sketch.select("set", "counts").mapInArrow(_summed(np.uint16), "set long, counts binary")
    got = part.repartition("set").mapInArrow(_summed(np.int64), "set long, counts binary").toArrow()
    total = np.zeros(((1 << SKETCH_BITS) // SKETCH_BLOCK, SKETCH_BLOCK), np.int64)
    for block, counts in zip(got.column(0).to_pylist(), got.column(1), strict=True):
        total[block] = np.frombuffer(counts.as_buffer(), np.int64)
    total = total.ravel()
    more = total - total.mean()
    return np.where(more > 4 * np.sqrt(total.mean()), np.clip(np.ceil(np.log2(np.maximum(more / LONG, 1))), 0, 31), 0).astype(np.uint8)


def order_key(h: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """A shingle's place in the order of all shingles; also its name in the index."""
    return ((classes[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(58))
            | (h & np.uint64((1 << 58) - 1))).view(np.int64)


def _postings(classes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for b in blocks(batch.column(0)):
                row, h, first = shingles(b)
                ids = set_ids(h, first)
                new = _unseen(ids, seen)
                at = _members(first, new)
                row, key = row[at], order_key(h[at], classes.value)
                order = np.lexsort((key, row))
                key, n = key[order], first[new + 1] - first[new]
                pos = np.arange(len(key)) - np.repeat(np.cumsum(n) - n, n)
                keep = pos < np.repeat(prefix_size(n), n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[keep]), pa.array(np.repeat(ids[new], n)[keep]),
                     pa.array(np.repeat(n, n)[keep].astype(np.int32)), pa.array(pos[keep].astype(np.int32))],
                    names=["token", "set", "n", "pos"])
    return run


def may_link(n1, p1, n2, p2):
    """Whether sets of sizes n1 <= n2 with a shingle in common at positions p1
    and p2 can still link; works on numpy arrays."""
    most = np.minimum(p1, p2) + 1 + np.minimum(n1 - p1, n2 - p2) - 1
    return (4 * n1 >= 3 * n2) & (7 * most >= 3 * (n1 + n2))


class _Pairs:
    """Pairs that a task found in its lists, with the number of lists."""

    names = ["kind", "token", "a", "b", "na", "nb", "pos", "times"]

    def __init__(self) -> None:
        self.parts, self.size, self.members = [], 0, []

    def count(self, ids, n) -> None:
        """Sets of a short list with other sets."""
        self.members.append([ids, n])
        self.size += len(ids)

    def add(self, a, b, na, nb) -> None:
        swap = a > b
        self.parts.append([np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)])
        self.size += len(a)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            a, b, na, nb = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            order = np.lexsort((b, a))
            a, b, na, nb = a[order], b[order], na[order], nb[order]
            new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            times = np.diff(np.append(new, len(a)))
            zero = np.zeros(len(new), np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(zero), pa.array(zero.astype(np.int64)), pa.array(a[new]), pa.array(b[new]), pa.array(na[new]),
                 pa.array(nb[new]), pa.array(zero), pa.array(times.astype(np.int32))], names=self.names)
        if self.members:
            ids, n = (np.concatenate(x) for x in zip(*self.members, strict=True))
            found, first, times = np.unique(ids, return_index=True, return_counts=True)
            zero = np.zeros(len(found), np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(zero + 2), pa.array(zero.astype(np.int64)), pa.array(found), pa.array(zero.astype(np.int64)),
                 pa.array(n[first]), pa.array(zero), pa.array(zero), pa.array(times.astype(np.int32))], names=self.names)
        self.parts, self.size, self.members = [], 0, []


def _long_rows(token, ids, n, pos) -> pa.RecordBatch:
    zero = np.zeros(len(ids), np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(zero + 1), pa.array(token), pa.array(ids), pa.array(zero.astype(np.int64)), pa.array(n), pa.array(zero),
         pa.array(pos), pa.array(zero)], names=_Pairs.names)


def _read_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (token, n, set). Pairs of short lists (kind 0), the
    rows of long lists (kind 1), how many short lists with others a set is in
    (kind 2). Holds one batch and the start of a list."""
    pairs, rest, long_token = _Pairs(), None, None
    for batch in batches:
        cols = [np.asarray(batch.column(k)) for k in range(4)]
        if rest is not None:
            cols = [np.concatenate([x, y]) for x, y in zip(rest, cols, strict=True)]
        token, ids, n, pos = cols
        if long_token is not None and len(token):      # the list goes on from the last batch
            m = int(np.searchsorted(token, long_token, side="right"))
            yield _long_rows(token[:m], ids[:m], n[:m], pos[:m])
            token, ids, n, pos = token[m:], ids[m:], n[m:], pos[m:]
            if len(token):
                long_token = None
        if not len(token):
            rest = None
            continue
        first = int(np.searchsorted(token, token[-1]))     # the last list may go on
        if len(token) - first > 4 * LONG:
            long_token, rest = token[-1], None
            yield _long_rows(token[first:], ids[first:], n[first:], pos[first:])
        else:
            rest = [x[first:] for x in (token, ids, n, pos)]
        yield from _whole_lists(pairs, token[:first], ids[:first], n[:first], pos[:first])
    if rest is not None:
        yield from _whole_lists(pairs, *rest)
    yield from pairs.flush()


def _whole_lists(pairs: _Pairs, token, ids, n, pos) -> Iterator[pa.RecordBatch]:
    if not len(token):
        return
    new = np.ones(len(token), bool)                        # a set that several tasks indexed
    new[1:] = (token[1:] != token[:-1]) | (ids[1:] != ids[:-1])
    token, ids, n, pos = token[new], ids[new], n[new], pos[new]
    begin = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    size = np.diff(np.append(begin, len(token)))
    is_long = np.repeat(size > LONG, size)
    if is_long.any():
        yield _long_rows(token[is_long], ids[is_long], n[is_long], pos[is_long])
    last = np.repeat(begin + size, size)
    at = np.flatnonzero(~is_long & (np.repeat(size, size) > 1))
    pairs.count(ids[at], n[at])
    step = 1
    while len(at):
        at = at[at + step < last[at]]
        at = at[4 * n[at].astype(np.int64) >= 3 * n[at + step]]     # sorted by size: all that follow are too large
        x, y = at, at + step
        fit = may_link(n[x], pos[x], n[y], pos[y])
        pairs.add(ids[x[fit]], ids[y[fit]], n[x[fit]], n[y[fit]])
        step += 1
        if pairs.size > FLUSH:
            yield from pairs.flush()


def _copy_key(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A key of a set in one document, so that one copy of a set can be told from the others."""
    return mix(ids.view(np.uint64) ^ mix(doc.astype(np.int64).view(np.uint64))).view(np.int64)


def _filter_bits(ids: np.ndarray) -> np.ndarray:
    """Two bit numbers for each id."""
    h = mix(ids.view(np.uint64))
    return np.concatenate([h >> np.uint64(64 - FILTER_BITS), h & np.uint64((1 << FILTER_BITS) - 1)]).astype(np.int64)


def _id_filter(ids: DataFrame) -> np.ndarray:
    """A filter of fixed size that every id of ``ids`` passes (with two
    columns: every set and document), gathered in parts of 64 bits."""
    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            key = [np.asarray(batch.column(k)) for k in range(batch.num_columns)]
            mine[_filter_bits(key[0] if len(key) == 1 else _copy_key(*key))] = True
        packed = np.packbits(mine).view(np.int64)
        at = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(packed[at])], names=["at", "bits"])

    got = ids.mapInArrow(bits, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    packed = np.zeros((1 << FILTER_BITS) // 64, np.int64)
    packed[np.asarray(got.column("at"))] = np.asarray(got.column("bits"))
    return packed.view(np.uint8)


def _sets(wanted) -> Callable:
    """(set, items) of the sets that pass the filter, from the document that stands for each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        passes = np.unpackbits(wanted.value).astype(bool)
        for batch in batches:
            doc = np.asarray(batch.column(1).cast(pa.int64()).fill_null(NO_ID))
            for b in blocks(batch.column(0)):
                _, h, first = shingles(b)
                ids = set_ids(h, first)
                ok = passes[_filter_bits(_copy_key(ids, doc[b.lo:b.hi]))].reshape(2, -1).all(0)
                new = _unseen(np.where(ok, ids, 0), seen)
                offsets = np.concatenate([[0], np.cumsum(first[new + 1] - first[new])]).astype(np.int32)
                items = h[_members(first, new)].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[new]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(items))],
                    names=["set", "items"])
    return run


def _compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, na, nb, common) of ``pairs``, exactly."""
    x = sets.select(F.col("set").alias("a"), F.col("items").alias("_x"))
    y = sets.select(F.col("set").alias("b"), F.col("items").alias("_y"))
    return pairs.join(x, "a").join(y, "b").select(
        "a", "b", "na", "nb", F.size(F.array_intersect("_x", "_y")).cast("long").alias("common"))


def _linked(compared: DataFrame) -> DataFrame:
    union = F.col("na") + F.col("nb") - F.col("common")
    return compared.where(100 * F.col("common") >= 75 * union)


def _fit_sizes(n1: Column, n2: Column) -> Column:
    return (4 * n1 >= 3 * n2) & (4 * n2 >= 3 * n1)


def _leader_pairs(entries: DataFrame) -> DataFrame:
    """(a, b, na, nb): each set of a long list with the list's leaders, the
    sets whose hashes are smallest. Lists of one group mostly share leaders."""
    best = [F.min(F.struct(F.xxhash64("set", F.lit(k)).alias("h"), "set", "n")).alias(f"l{k}") for k in range(LEADERS)]
    leaders = entries.groupBy("token").agg(*best).select(
        "token", F.explode(F.array_distinct(F.array(*[F.struct(f"l{k}.set", f"l{k}.n") for k in range(LEADERS)]))).alias("l"))
    met = entries.join(leaders, "token").where((F.col("set") != F.col("l.set")) & _fit_sizes(F.col("n"), F.col("l.n")))
    return met.select(F.col("l.set").alias("a"), F.col("set").alias("b"), F.col("l.n").alias("na"), F.col("n").alias("nb")).distinct()


def _first_shared(entries: DataFrame) -> DataFrame:
    """The entries of long lists that can be the first shingle that a set
    shares with a linked set of the list: all they share, at least
    ceil(3 (n + other n) / 7), then follows from there."""
    least = entries.groupBy("token").agg(F.min("n").alias("_least"))
    other = F.greatest(F.col("_least"), F.ceil(3 * F.col("n") / 4))
    return (entries.join(least, "token").where(7 * (F.col("n") - F.col("pos")) >= 3 * (F.col("n") + other))
            .drop("_least"))


def _common(a: pa.ChunkedArray, b: pa.ChunkedArray) -> np.ndarray:
    """How many items each list of ``a`` has in common with each of ``b``."""
    def flat(column):
        lists = pa.concat_arrays([c for c in column.chunks]) if column.num_chunks != 1 else column.chunk(0)
        return np.asarray(lists.flatten()), np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
    (x, of_x), (y, of_y) = flat(a), flat(b)
    shared = np.intersect1d(x, y)
    out = np.zeros((len(a), len(b)), np.float32)
    for lo in range(0, len(shared), COLUMNS):
        part = shared[lo:lo + COLUMNS]
        left, right = (np.zeros((n, len(part)), np.float32) for n in out.shape)
        for items, of, to in ((x, of_x, left), (y, of_y, right)):
            at = np.minimum(np.searchsorted(part, items), len(part) - 1)
            here = part[at] == items
            to[of[here], at[here]] = 1
        out += left @ right.T
    return out


def _cluster_labels(cluster: pa.Table) -> pa.Table:
    """(node, label): the sets of a cluster that link with others, each with the
    smallest set that it is connected with, from all pairs of the cluster."""
    items, n = cluster.column("items"), np.asarray(cluster.column("n")).astype(np.int64)
    common = _common(items, items)
    linked = np.zeros(common.shape, bool)
    for lo in range(0, len(n), ROWS):
        part = common[lo:lo + ROWS].astype(np.int64)
        linked[lo:lo + ROWS] = 100 * part >= 75 * (n[lo:lo + ROWS, None] + n[None, :] - part)
    ids = np.asarray(cluster.column("set"))
    label, free = ids.copy(), np.ones(len(n), bool)
    for start in np.argsort(ids).tolist():      # a component is first met at its smallest set
        reached = [start] if free[start] else []
        free[start] = False
        while reached:
            new = np.flatnonzero(linked[reached.pop()] & free)
            free[new] = False
            label[new] = ids[start]
            reached += new.tolist()
    np.fill_diagonal(linked, False)
    some = linked.any(axis=1)
    return pa.table([pa.array(ids[some]), pa.array(label[some])], names=["node", "label"])


def _compare_chunks(outer: pa.Table, members: pa.Table) -> pa.Table:
    """(a, b): for each set of ``outer`` one linked set of each other group among ``members``."""
    names = ["a", "b"]
    if not outer.num_rows or not members.num_rows:
        return pa.table([pa.array([], pa.int64())] * 2, names=names)
    na, nb = (np.asarray(t.column("n")).astype(np.int64) for t in (outer, members))
    ga, gb = (np.asarray(t.column("group")) for t in (outer, members))
    common = _common(outer.column("items"), members.column("items"))
    linked = (100 * common >= 75 * (na[:, None] + nb[None, :] - common)) & (ga[:, None] != gb[None, :])
    i, j = np.nonzero(linked)
    _, first = np.unique(np.stack([i, np.unique(gb, return_inverse=True)[1][j]]), axis=1, return_index=True)
    return pa.table([outer.column("set").take(pa.array(i[first])), members.column("set").take(pa.array(j[first]))], names=names)


def _links_of_long_lists(entries: DataFrame, group: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links between different groups of a long list. The sets outside
    a list's main group meet all its sets, in chunks of bounded size. """
    grouped = entries.join(group, "set", "left").withColumn("group", F.coalesce("group", "set"))
    main = (grouped.groupBy("token", "group").agg(F.count(F.lit(1)).alias("k"))
            .groupBy("token").agg(F.max_by("group", F.struct("k", "group")).alias("main"), F.max("k").alias("largest"),
                                  F.sum("k").alias("all"), F.count(F.lit(1)).alias("groups"))
            .where("groups > 1")
            .select("token", "main", F.ceil((F.col("all") - F.col("largest")) / OUTER).alias("outer_chunks"),
                    F.ceil(F.col("all") / MEMBERS).alias("member_chunks")))
    mixed = grouped.join(main, "token").join(sets, "set")
    chunk = lambda n: F.pmod(F.xxhash64("set", F.lit(3)), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    outer = mixed.where("group <> main").withColumn("i", chunk("outer_chunks")).withColumn("j", every("member_chunks"))
    members = mixed.withColumn("j", chunk("member_chunks")).withColumn("i", every("outer_chunks"))
    key, columns = ["token", "i", "j"], ["set", "n", "group", "items"]
    sides = [side.select(*[F.col(c).alias(c) for c in key + columns]).groupBy(*key) for side in (outer, members)]
    return (sides[0].cogroup(sides[1])
            .applyInArrow(_compare_chunks, "a long, b long").distinct())


def _links_of_large_clusters(pairs: DataFrame, entries: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links that join what is linked in the clusters of ``sets`` (set, items)."""
    large = sets.select("set")
    pairs = pairs.join(large.withColumnRenamed("set", "a"), "a", "left_semi").select("a", "b", "na", "nb", "times")
    entries = entries.join(large, "set", "left_semi").select("token", "set", "n", "pos")
    pairs, entries = written(pairs), written(entries)
    # others: each set with its best partner and its lists' leaders
    ends = pairs.select(F.col("a").alias("x"), "*").union(pairs.select(F.col("b").alias("x"), "*"))
    best = (ends.groupBy("x").agg(F.max_by(F.struct("a", "b", "na", "nb"), F.struct("times", "a", "b")).alias("p"))
            .select("p.*").distinct())
    compared = written(_compare(best.union(_leader_pairs(entries)).distinct(), sets))
    near = _linked(compared).select("a", "b")
    group = components(near).select(F.col("node").alias("set"), F.col("label").alias("group"))
    # what their groups do not settle
    left = (pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti")
            .join(group.select(F.col("set").alias("a"), F.col("group").alias("ga")), "a", "left")
            .join(group.select(F.col("set").alias("b"), F.col("group").alias("gb")), "b", "left")
            .where(F.coalesce("ga", "a") != F.coalesce("gb", "b")).select("a", "b", "na", "nb"))
    more = written(_linked(_compare(left, sets)).select("a", "b").union(_links_of_long_lists(entries, group, sets)))
    return near.union(more)


def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, set (the id of
    its shingle set, 0 for an empty one)."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text"))
    profile = written(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
                         .mapInArrow(_profile, "kind int, doc_id long, set long, n long, counts binary"))
    document = profile.where("kind = 0").drop("kind", "counts")
    classes = spark.sparkContext.broadcast(_classes(profile.where("kind = 1")))
    index = (texts.mapInArrow(_postings(classes), "token long, set long, n int, pos int")
             .repartition("token").sortWithinPartitions("token", "n", "set"))
    lists = written(index.mapInArrow(
        _read_lists, "kind int, token long, a long, b long, na int, nb int, pos int, times int"))
    entries = lists.where("kind = 1").select("token", F.col("a").alias("set"), F.col("na").alias("n"), "pos").distinct()
    entries = written(entries)
    in_long = entries.groupBy("set").agg(F.count(F.lit(1)).alias("lists"))
    # pairs that share enough of their prefixes
    need = F.ceil(3 * (F.col("na") + F.col("nb")) / 7) - F.greatest(prefix_rest(F.col("na")), prefix_rest(F.col("nb")))
    counted = lists.where("kind = 0").groupBy("a", "b", "na", "nb").agg(F.sum("times").alias("times"))
    pairs = written(
        counted.join(in_long.select(F.col("set").alias("a"), F.col("lists").alias("la")), "a", "left")
        .join(in_long.select(F.col("set").alias("b"), F.col("lists").alias("lb")), "b", "left")
        .where(F.col("times") + F.least(F.coalesce("la", F.lit(0)), F.coalesce("lb", F.lit(0))) >= need)
        .select("a", "b", "na", "nb", "times"))
    # a set links with nothing unless it shares as many indexed shingles as any pair must
    short = lists.where("kind = 2").groupBy(F.col("a").alias("set")).agg(F.sum("times").alias("short"))
    able = (in_long.join(short, "set", "left").select("set", (F.col("lists") + F.coalesce("short", F.lit(0))).alias("able")))
    entries = entries.join(able, "set").where(F.col("able") > F.floor(F.col("n") / 20)).select("token", "set", "n", "pos")
    entries = written(_first_shared(entries))
    # clusters: what pairs and long lists connect; nothing links two of them
    first = entries.groupBy("token").agg(F.min("set").alias("a"))
    cluster = components(pairs.select("a", "b").union(entries.join(first, "token").select("a", F.col("set").alias("b"))))
    by_set = written(document.where("set <> 0").groupBy("set").agg(F.min("doc_id").alias("smallest"), F.max("n").alias("n")))
    wanted = written(cluster.select(F.col("node").alias("set"), "label").join(by_set, "set"))
    shared = spark.sparkContext.broadcast(_id_filter(
        wanted.select("set", F.coalesce("smallest", F.lit(NO_ID)).alias("doc"))))
    total = wanted.groupBy("label").agg(F.sum("n").alias("_total"), F.count(F.lit(1)).alias("_sets"))
    whole = (F.col("_total") <= CLUSTER_ITEMS) & (F.col("_sets") <= CLUSTER_SETS)
    sets = written(docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("doc"))
                      .mapInArrow(_sets(shared), "set long, items array<long>")
                      .join(wanted.join(total, "label").select("set", "label", "n", whole.alias("whole")), "set")
                      .dropDuplicates(["set"]))
    # a cluster that one task can hold is compared there, and nothing links it with another
    found = (sets.where("whole").select("label", "set", "n", "items").groupBy("label")
             .applyInArrow(_cluster_labels, "node long, label long"))
    large = sets.where("NOT whole").select("set", "items")
    if not large.isEmpty():
        found = found.union(components(_links_of_large_clusters(pairs, entries, large)))
    # smallest document of each set, then of each component
    named = by_set.join(found.select(F.col("node").alias("set"), "label"), "set", "left") \
        .select("set", "smallest", F.coalesce("label", "set").alias("label"))
    named = written(named)
    lowest = named.groupBy("label").agg(F.min("smallest").alias("component_id"))
    named = named.join(lowest, "label").select("set", "component_id")
    return (document.join(named, "set", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("set") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    "set"))


def prefix_rest(n: Column) -> Column:
    """Shingles of a set of ``n`` beyond its prefix (see ``prefix_size``)."""
    return F.ceil(3 * n / 4) - 1 - F.floor(n / 20)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is its component's smallest, with their
    columns, which may have any names. Ids name rows: rows of one id stay or go
    together (all of them go if one of its texts is linked to a smaller id),
    and rows under a null id stay, as nothing names them. A filter of fixed
    size spares most rows that stay the shuffle of the exact anti-join."""
    name = fresh("_dropped", docs)
    dropped = written(join_documents(docs, id_col, text_col).where("component_id <> doc_id")
                         .select(F.col("doc_id").alias(name)).distinct())
    shared = docs.sparkSession.sparkContext.broadcast(_id_filter(dropped))

    def passes(ids: pa.Array) -> np.ndarray:
        found = np.unpackbits(shared.value).astype(bool)[_filter_bits(np.asarray(ids.cast(pa.int64()).fill_null(0)))]
        return found.reshape(2, -1).all(0) & np.asarray(ids.is_valid())

    maybe = filter_rows(docs, id_col, passes).join(dropped, F.col(id_col) == F.col(name), "left_anti")
    return filter_rows(docs, id_col, lambda ids: ~passes(ids)).union(maybe.select(*docs.columns))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
