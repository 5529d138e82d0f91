"""Mixing sources to target weights by Pfair scheduling.

The documents of each source are numbered in hash order and cut into blocks
of ``block_size``. With a target weight of a/P for a source, its block j is
released at slot floor(j P / a) and due by slot ceil((j + 1) P / a); earliest
deadline first fills the slots. After any number of slots each source is
within one block of its share.

Sources of the same weight and the same number of blocks form a class. A class
is scheduled like one source with the weight and the blocks of all its
members, and its members take its slots in turn: a class is less than one
block from its share, so each of m members less than 1/m by that, and at most
1 - 1/m by the turns. That is less than one block again, for any number of
sources. All members of a class are used up together.

Weights are whole numbers of slots in a period of P slots, so one period's
schedule serves all periods, and a block's slot follows from its number alone:
the driver only handles classes x P numbers, however many documents and
sources of a class there are. When a class has less than a period's blocks
left, its last blocks are scheduled slot by slot (P slots at most); then the
others share its slots in proportion to their weights. Every document gets
exactly one slot.

Without given weights a source weighs its number of blocks to the power
``POWER``, so that small sources are raised against large ones and classes
follow from numbers of blocks alone.

Numbering needs no task with a whole source or a whole class: rows are counted
by (source, hash range), and numbered within ranges of about ``RANGE`` rows;
sources within their class likewise. The order within a source follows the
hash of the id, then the id, then the row's other plain columns; it does not
depend on the other sources, nor on the number of ranges.

Defined cases: null sources are one source; a source without a given weight,
or with none above 0, goes last, by the same rules with equal weights; an
infinite weight is an error; ties between deadlines go to the class of larger
weight, then of more blocks; repeated rows each have a place; null ids are
hashed like any other; columns of ``docs`` may have any names, but for ``mix``
those named like its three own columns, which it replaces; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from heapq import heappop, heappush
from math import isinf

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DateType, NumericType, StringType, TimestampNTZType,
                               TimestampType)

from tripflow.llm.text import checkpoint, table

BLOCK_SIZE = 32             # documents
PERIOD = 1000               # slots; at least four for each class
POWER = 0.7                 # of a source's blocks, its weight where none are given
RANGE = 4_000               # rows of a source that are numbered together
ROW_BYTES, BROADCAST_BYTES = 96, 16_000_000
PLAIN = (BinaryType, BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType)
ADDED = ("_block", "_slot", "_position")
PHASES = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("period", pa.int64()),
                            ("slots", pa.list_(pa.int64()))]))


def shares(weights: list[float], period: int) -> list[int]:
    """Whole slots of a period for each weight: largest remainders, at least one each."""
    total = sum(weights)
    exact = [w / total * period for w in weights]
    out = [max(1, int(x)) for x in exact]
    order = sorted(range(len(out)), key=lambda k: (out[k] - exact[k], k))
    k = 0
    while sum(out) < period:
        out[order[k % len(out)]] += 1
        k += 1
    while sum(out) > period:
        out[max(range(len(out)), key=lambda j: (out[j], -j))] -= 1
    return out


def edf_slots(share: list[int], period: int, blocks: list[int] | None = None) -> list[int]:
    """The class of each slot of a period, by earliest deadline among released
    blocks. With ``blocks`` (blocks that each class has left), it stops when
    the first class has none left."""
    future = [(0, s) for s in range(len(share))]            # (release, class), a heap
    ready: list[tuple[int, int]] = []                       # (deadline, class), a heap
    done, out = [0] * len(share), []
    for slot in range(period):
        while future and future[0][0] <= slot:
            s = heappop(future)[1]
            heappush(ready, (-(-(done[s] + 1) * period // share[s]), s))
        s = heappop(ready)[1]
        out.append(s)
        done[s] += 1
        if done[s] < share[s]:
            heappush(future, (done[s] * period // share[s], s))
        if blocks is not None and done[s] == blocks[s]:
            break
    return out


def plan(blocks: list[int], weights: list[float], period: int = PERIOD) -> list[list[tuple]]:
    """For each class its phases (first, last, period, slots): the class's
    block j in first..last has the slot
    slots[(j - first) mod len(slots)] + (j - first) div len(slots) * period."""
    left, first, slot = list(blocks), [0] * len(blocks), 0
    out: list[list[tuple]] = [[] for _ in blocks]
    while any(left):
        live = [s for s in range(len(left)) if left[s] > 0]
        size = max(period, 4 * len(live))
        share = shares([weights[s] for s in live], size)
        whole = min(left[s] // a for s, a in zip(live, share, strict=True))
        order = edf_slots(share, size, None if whole else [left[s] for s in live])
        slots: list[list[int]] = [[] for _ in live]
        for at, k in enumerate(order):
            slots[k].append(slot + at)
        turns = max(whole, 1)
        for s, own in zip(live, slots, strict=True):
            if own:
                out[s].append((first[s], first[s] + turns * len(own) - 1, size, own))
                first[s] += turns * len(own)
                left[s] -= turns * len(own)
        slot += turns * len(order)
    return out


def _slot_of(block: Column) -> Column:
    """The slot of a block by the column ``_phases`` of its class (see ``plan``)."""
    own = F.element_at(F.filter("_phases", lambda p: (p["first"] <= block) & (block <= p["last"])), 1)
    step, n = block - own["first"], F.size(own["slots"])
    return F.element_at(own["slots"], (step % n + 1).cast("int")) + F.floor(step / n) * own["period"]


def _hash(*keys: Column) -> Column:
    """63 bits, not negative: its order and that of its leading bits agree."""
    return F.shiftrightunsigned(F.xxhash64(*keys, F.lit("mix")), 1)


def numbered(rows: DataFrame, groups: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (_group, _hash, ...), with ``_number`` from 0 within their group
    by (_hash, *order), and with the columns of ``groups`` (_group, n, ...),
    one row a group, n rows in it. Groups are not null."""
    known = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    ranges = max(1, -(-(known[1] or 0) // RANGE))
    ranged = rows.withColumn("_range", F.floor(F.shiftright("_hash", 32) * F.lit(ranges) / F.lit(1 << 31)).cast("int"))
    by_range = checkpoint(ranged.groupBy("_group", "_range").agg(F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offset = by_range.select("_group", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    offset = offset.join(groups, "_group")
    if known[0] * ranges * ROW_BYTES <= BROADCAST_BYTES:
        offset = F.broadcast(offset)        # one row per group and range
    within = Window.partitionBy("_group", "_range").orderBy("_hash", *order)
    return (ranged.withColumn("_k", F.row_number().over(within) - 1).join(offset, ["_group", "_range"])
            .withColumn("_number", F.col("_before") + F.col("_k")).drop("_range", "_k", "_before"))


def _handed(spark: SparkSession, rows: list[tuple], **types: pa.DataType) -> DataFrame:
    """The driver's ``rows`` as a table. As Arrow they reach the executors
    without a Python worker, which else stays in their memory."""
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return spark.createDataFrame(pa.table({name: pa.array(list(c), kind)
                                           for (name, kind), c in zip(types.items(), columns, strict=True)}))


def _sources(rows: DataFrame, weights: Mapping[str | None, float] | None, block_size: int) -> DataFrame:
    """(_group, n, _weight, _blocks): every source, its rows, given weight (0 if none above) and blocks."""
    counts = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        counts = counts.withColumn("_weight", F.lit(1.0))
    else:
        if any(isinf(w) for w in weights.values()):
            raise ValueError("an infinite weight")
        given = _handed(rows.sparkSession,
                        [("" if s is None else f"s{s}", float(w) if w > 0 else 0.0) for s, w in weights.items()],
                        _group=pa.string(), _weight=pa.float64())
        counts = counts.join(given, "_group", "left").withColumn("_weight", F.coalesce("_weight", F.lit(0.0)))
    return checkpoint(counts.withColumn("_blocks", F.ceil(F.col("n") / block_size)))


def _schedule(classes: list[tuple[float, int, int]], raised: bool, period: int) -> list[list[tuple]]:
    """The phases of each class (weight of a member, blocks of a member,
    members), those without weight last. ``raised``: weights are blocks to the
    power ``POWER``."""
    out: list[list[tuple]] = [[] for _ in classes]
    slot = 0
    for wanted in (True, False):
        part = [k for k, c in enumerate(classes) if (c[0] > 0) is wanted]
        member = [classes[k][1] ** POWER if raised else classes[k][0] if wanted else 1.0 for k in part]
        blocks = [classes[k][1] * classes[k][2] for k in part]
        found = plan(blocks, [w * classes[k][2] for w, k in zip(member, part, strict=True)], period)
        for k, phases in zip(part, found, strict=True):
            out[k] = [(first, last, size, [slot + x for x in own]) for first, last, size, own in phases]
        slot += sum(blocks)
    return out


def _placed(docs: DataFrame, weights: Mapping[str | None, float] | None, id_col: str, source_col: str,
            block_size: int, period: int) -> DataFrame:
    """(_row, _block, _slot, _position): the rows of ``docs`` as structs, and their places."""
    spark = docs.sparkSession
    plain = [f.name for f in docs.schema.fields if isinstance(f.dataType, PLAIN)]
    of = lambda name: F.col("_row")[name]
    source = of(source_col).cast("string")
    rows = docs.select(F.struct("*").alias("_row")).select(
        "_row", F.coalesce(F.concat(F.lit("s"), source), F.lit("")).alias("_group"),        # null is a source
        _hash(of(id_col)).alias("_hash"), of(id_col).alias("_id"),
        F.xxhash64(*[of(c) for c in plain], F.lit("tie")).alias("_tie"))
    sources = _sources(rows, weights, block_size)
    classes = sorted(((r._weight, r._blocks, r.m) for r in sources.groupBy("_weight", "_blocks")
                      .agg(F.count(F.lit(1)).alias("m")).collect()), key=lambda c: (-c[0], -c[1]))
    schedule = _schedule(classes, weights is None, period)
    # each source's turn within its class
    named = _handed(spark, [(k, w, b, m) for k, (w, b, m) in enumerate(classes)],
                    _class=pa.int64(), _weight=pa.float64(), _blocks=pa.int64(), _members=pa.int64())
    of_class = named.select(F.col("_class").cast("string").alias("_group"), F.col("_members").alias("n"), "_class")
    turns = numbered(sources.join(named, ["_weight", "_blocks"]).select(
        F.col("_class").cast("string").alias("_group"), F.col("_group").alias("_source"), F.col("n").alias("_rows"),
        "_members", _hash(F.col("_group")).alias("_hash")), of_class, ["_source"])
    turns = checkpoint(turns.select(F.col("_source").alias("_group"), F.col("_rows").alias("n"), "_class", "_members",
                                    F.col("_number").alias("_turn")))
    names = [f.name for f in PHASES.value_type]
    phases = _handed(spark, [(k, [dict(zip(names, p, strict=True)) for p in own]) for k, own in enumerate(schedule)],
                     _class=pa.int64(), _phases=PHASES)
    if 8 * sum(len(p[3]) + 4 for own in schedule for p in own) <= BROADCAST_BYTES:
        phases = F.broadcast(phases)        # classes x period numbers; beyond, a join that adaptive planning picks
    block = F.floor(F.col("_number") / block_size)
    return (numbered(rows, turns, ["_id", "_tie"]).join(phases, "_class").withColumn("_block", block)
            .withColumn("_slot", _slot_of(F.col("_block") * F.col("_members") + F.col("_turn")))
            .select("_row", *ADDED[:2], (F.col("_slot") * block_size + F.col("_number") % block_size).alias("_position")))


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, id_col: str = "doc_id",
        source_col: str = "source", block_size: int = BLOCK_SIZE, period: int = PERIOD) -> DataFrame:
    """``docs`` with ``_block`` (its block's number within its source),
    ``_slot`` (the block's) and ``_position`` (the row's place in the mix)."""
    placed = _placed(docs, weights, id_col, source_col, block_size, period)
    return placed.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in ADDED], *ADDED)


def in_mixed_order(docs: DataFrame, weights: Mapping[str | None, float] | None = None, id_col: str = "doc_id",
                   source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, all of them, with their columns, sorted by their place in the mix."""
    placed = _placed(docs, weights, id_col, source_col, BLOCK_SIZE, PERIOD)
    return (placed.repartitionByRange(F.col("_position")).sortWithinPartitions("_position")
            .select(*[F.col("_row")[c].alias(c) for c in docs.columns]))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's block, slot and position; a source weighs its blocks to the power ``POWER``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(docs).select("doc_id", "source", F.col("_block").alias("block"), F.col("_slot").alias("slot"),
                            F.col("_position").alias("position"))
