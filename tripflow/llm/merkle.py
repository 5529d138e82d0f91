"""Merkle manifest of a table: a tree of SHA-256 digests over its rows.

A row's digest (leaf) covers its fields. Leaves of a group (a language) ascend
by key; while a level has several nodes, every ``RUN`` consecutive ones become
their parent (the last run may be shorter, even one node long). The groups'
subroots, in the order of the groups, are joined by the same rule to the root.

* **Building.** Places of leaves come from ranges of (group, key): counts of
  rows by range, then a row number within the range. RUN^HEIGHT
  consecutive leaves are one task's group, whatever the size of the language,
  and become one node; those nodes are built over in the same way until each
  language has one node. Only levels above the blocks are held as a table.
* **Folding.** Each parent keeps a copy of its hash state before each child's
  slot. To put another digest in a slot, that state is copied, and only the
  replacement and the siblings to its right are hashed. Hash states can't leave
  their process, so blocks are rebuilt in the task that folds their leaves; for
  the levels above, the block's row brings the siblings of its path, and the
  state before its slot is made once per block and level.

Defined cases: a null field counts as ``-``; a null group is a group of its
own before all others; null keys come first; rows with the same key ascend by
digest, and equal rows are leaves of their own; a text of any length is hashed
whole; an empty table has no rows, no root. Only the named columns are read, so
other columns, whatever their names, don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm.text import checkpoint, crc_mod, table

RUN = 8                     # children of a parent
HEIGHT = 4                  # levels that one task builds

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Lowercase hex sha256 of all fields: ``-`` for null, else the number of
    UTF-8 bytes, ``:`` and the value's text."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")), F.lit(":"), f.cast("string")), F.lit("-"))
             for f in fields]
    return F.sha2(F.concat(*parts), 256)


def placed(nodes: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``nodes`` with ``_at``, the place (from 0) within its tree by ``order``.

    Rows are dealt to ranges of (tree, order), so neither a large tree nor many
    rows with one key share a task; equal rows are told apart by a row number.
    """
    ranged = checkpoint(nodes.withColumn("_tie", F.monotonically_increasing_id())
                        .repartitionByRange(tree, *order, "_tie").withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(tree).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offset = (ranged.groupBy(tree, "_range").agg(F.count(F.lit(1)).alias("_n"))     # one row a tree and range
              .select(tree, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    within = Window.partitionBy(tree, "_range").orderBy(*order, "_tie")
    return (ranged.withColumn("_k", F.row_number().over(within) - 1).join(offset, [tree, "_range"])
            .withColumn("_at", F.col("_before") + F.col("_k")).drop("_tie", "_range", "_k", "_before"))


class _Parent:
    """A parent node: its children's digests, the hash state before each
    child's slot, and its digest."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: list[str]):
        self.children = "".join(children).encode()
        h, self.states = sha256(), []
        for child in children:
            self.states.append(h.copy())
            h.update(child.encode())
        self.digest = h.hexdigest()

    def fold(self, slot: int, child: str) -> str:
        """The digest with ``child`` in a slot, from the state before it."""
        h = self.states[slot].copy()
        h.update(child.encode())
        h.update(self.children[64 * (slot + 1):])
        return h.hexdigest()

    def siblings(self, slot: int) -> tuple[bytes, bytes]:
        return self.children[:64 * slot], self.children[64 * (slot + 1):]


def _build(digests: list[str], whole: bool, height: int) -> list[list[_Parent]]:
    """The levels of parents over a block, lowest first: until one node is left
    where the block is its ``whole`` tree, else ``height`` of them."""
    levels: list[list[_Parent]] = []
    while len(digests) > 1 if whole else len(levels) < height:
        levels.append([_Parent(digests[k:k + RUN]) for k in range(0, len(digests), RUN)])
        digests = [p.digest for p in levels[-1]]
    return levels


def _block_levels(t: pa.Table, height: int) -> tuple[list[str], list[list[_Parent]]]:
    """The digests of a block's nodes and the levels over them."""
    digests = t.column("digest").to_pylist()
    return digests, _build(digests, t.column("blocks")[0].as_py() == 1, height)


def _block_of(at: Column, height: int) -> Column:
    return F.floor(at / F.lit(RUN ** height))


def _parents(nodes: DataFrame, height: int) -> DataFrame:
    """The nodes over ``nodes`` (tree, at, blocks, digest), one for each block of
    them, with the same columns; ``blocks`` counts the blocks of a node's tree."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("at")
        digests, levels = _block_levels(t, height)
        return pa.table({"tree": t.column("tree").slice(0, 1),
                         "at": pa.array([t.column("at")[0].as_py() // RUN ** height]),
                         "blocks": pa.array([-(-t.column("blocks")[0].as_py() // RUN ** height)]),
                         "digest": pa.array([levels[-1][0].digest if levels else digests[0]])})

    return (nodes.groupBy("tree", _block_of(F.col("at"), height).alias("_block"))
            .applyInArrow(run, "tree string, at long, blocks long, digest string"))


def _paths(nodes: DataFrame, height: int) -> DataFrame:
    """(tree, at, path): the siblings of each of ``nodes`` at each level of its
    block, lowest first."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("at")
        digests, levels = _block_levels(t, height)
        paths = []
        for k in range(len(digests)):
            path = []
            for level in levels:
                left, right = level[k // RUN].siblings(k % RUN)
                path.append({"left": left.decode(), "right": right.decode()})
                k //= RUN
            paths.append(path)
        side = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        return pa.table({"tree": t.column("tree"), "at": t.column("at"), "path": pa.array(paths, side)})

    return (nodes.groupBy("tree", _block_of(F.col("at"), height).alias("_block"))
            .applyInArrow(run, "tree string, at long, path array<struct<left:string,right:string>>"))


def _climb(nodes: DataFrame, height: int) -> DataFrame:
    """(tree, at, path, top): the whole path of each node to its tree's one
    top node, and that node's digest."""
    above = checkpoint(_parents(nodes, height))
    if nodes.where("blocks > 1").isEmpty():
        top = above.select("tree", F.col("digest").alias("top"))
        return checkpoint(_paths(nodes, height).join(top, "tree"))
    up = _climb(above, height).select("tree", F.col("at").alias("_up"), F.col("path").alias("_rest"), "top")
    return checkpoint(_paths(nodes, height).withColumn("_up", _block_of(F.col("at"), height)).join(up, ["tree", "_up"])
                      .select("tree", "at", F.concat("path", "_rest").alias("path"), "top"))


def _numbered(nodes: DataFrame, order: list[str], height: int) -> DataFrame:
    """``nodes`` (tree, digest, ...) with their places and the number of blocks
    of their tree."""
    size = F.ceil(F.count(F.lit(1)) / F.lit(RUN ** height)).alias("blocks")
    return checkpoint(placed(nodes, "tree", order).withColumnRenamed("_at", "at")
                      .join(nodes.groupBy("tree").agg(size), "tree"))


def _fold_block(height: int, proofs: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(leaves: pa.Table, above: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("at")
        _, levels = _block_levels(leaves, height)
        path = above.column("path")[0].as_py()
        upper = [(sha256(step["left"].encode()), step["right"].encode()) for step in path]
        tail = "".join(step["left"] + step["right"] for step in path).encode()
        folded, digests, lists = [], [], []
        for k, new in enumerate(leaves.column("changed").to_pylist()):
            proof, parts = sha256(), []
            for level in levels:
                parent, slot = level[k // RUN], k % RUN
                k //= RUN
                new = parent.fold(slot, new)
                for side in parent.siblings(slot):
                    proof.update(side)
                    if proofs:
                        parts.append(side)
            for state, right in upper:
                h = state.copy()
                h.update(new.encode())
                h.update(right)
                new = h.hexdigest()
            proof.update(tail)
            folded.append(new)
            digests.append(proof.hexdigest())
            if proofs:
                text = b"".join([*parts, tail]).decode()
                lists.append([text[j:j + 64] for j in range(0, len(text), 64)])
        same = lambda c: pa.array([above.column(c)[0].as_py()] * leaves.num_rows, pa.string())
        out = {"id": leaves.column("id"), "leaf": leaves.column("digest"), "subroot": same("subroot"),
               "root": same("root"), "proof_sha256": pa.array(digests, pa.string()),
               "folded_root": pa.array(folded, pa.string())}
        return pa.table(out | ({"proof": pa.array(lists, pa.list_(pa.string()))} if proofs else {}))
    return run


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group_col: str = "lang", id_col: str = "doc_id",
             replaced: dict[str, Column] | None = None, proofs: bool = False, height: int = HEIGHT) -> DataFrame:
    """One row per input row: id (named as ``id_col``), leaf, subroot, root,
    proof_sha256 (of the siblings, level by level to the root, left to right),
    folded_root (the root that the row's leaf gives with these siblings, where
    ``replaced`` columns take the place of fields; else its own) and verified
    (whether that is the root). With ``proofs`` also ``proof``, the siblings."""
    leaf = leaf_digest([F.col(f) for f in fields])
    changed = leaf_digest([(replaced or {}).get(f, F.col(f)) for f in fields])
    # the group's text behind a mark: null comes first and differs from an empty text
    tree = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0"))
    leaves = _numbered(docs.select(tree.alias("tree"), F.col(id_col).alias("id"), leaf.alias("digest"),
                                   changed.alias("changed")), ["id", "digest"], height)
    nodes = ["tree", "at", "blocks", "digest"]
    groups = _climb(checkpoint(_parents(leaves.select(nodes), height)), height)
    subroots = groups.groupBy("tree").agg(F.first("top").alias("subroot"))
    one = F.substring("tree", 1, 0)         # all subroots are one tree
    names = _numbered(subroots.select(one.alias("tree"), F.col("tree").alias("name"),
                                      F.col("subroot").alias("digest")), ["name"], height)
    roots = (_climb(names.select(nodes), height).join(names.select("at", "name", F.col("digest").alias("subroot")), "at")
             .select(F.col("name").alias("tree"), F.col("path").alias("_rest"), "subroot", F.col("top").alias("root")))
    above = groups.join(roots, "tree").select("tree", F.col("at").alias("block"), F.concat("path", "_rest").alias("path"),
                                              "subroot", "root")
    schema = (f"id {docs.schema[id_col].dataType.simpleString()}, leaf string, subroot string, root string, "
              "proof_sha256 string, folded_root string" + (", proof array<string>" if proofs else ""))
    out = (leaves.withColumn("block", _block_of(F.col("at"), height)).groupBy("tree", "block")
           .cogroup(above.groupBy("tree", "block")).applyInArrow(_fold_block(height, proofs), schema))
    return out.withColumn("verified", F.col("folded_root") == F.col("root")).withColumnRenamed("id", id_col)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(crc_mod("doc_id", 3) == 0, F.translate("text", UPPER, UPPER.lower())).otherwise(F.col("text"))
    return manifest(table(spark, sf_dir, "documents"), replaced={"text": tampered})


def _oracle(levels: int = 8) -> str:
    """The tree level by level, ``levels`` of them below the subroots (RUN ** levels
    rows a language) and two above."""
    part = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    fields = [part(f) for f in FIELDS]
    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), "
           "lambda x: ascii(x)::BIGINT)), lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), "
           "lambda a, i: xor(a // 2, 3988292384 * (a % 2)))))")
    out = [f"""doc AS (
  SELECT doc_id, lang, sha256({' || '.join(fields)}) AS leaf,
         sha256({' || '.join(fields[:-1])} || {part(f"CASE WHEN {crc} % 3 = 0 THEN translate(text, '{UPPER}', '{UPPER.lower()}') ELSE text END")}) AS changed
  FROM documents),
row0 AS (
  SELECT row_number() OVER () AS k, *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p
  FROM doc),
n0 AS (SELECT lang, p, leaf AS h FROM row0),
f0 AS (SELECT k, doc_id, lang, p, leaf, changed AS h, '' AS proof FROM row0)"""]

    def level(j: int, old: str, group: str) -> None:
        out.append(f"""s{j} AS (SELECT {group}, count(*) > 1 AS many FROM n{old} GROUP BY {group}),
n{j} AS (
  SELECT {group}, p // 8 AS p, CASE WHEN any_value(many) THEN sha256(string_agg(h, '' ORDER BY p)) ELSE any_value(h) END AS h,
         CASE WHEN any_value(many) THEN list(h ORDER BY p) ELSE [] END AS c
  FROM n{old} JOIN s{j} ON n{old}.{group} IS NOT DISTINCT FROM s{j}.{group} GROUP BY n{old}.{group}, p // 8),
f{j} AS (
  SELECT f.* EXCLUDE (p, h, proof), f.p // 8 AS p,
         CASE WHEN len(c) = 0 THEN f.h ELSE sha256(array_to_string(c[:f.p % 8], '') || f.h || array_to_string(c[f.p % 8 + 2:], '')) END AS h,
         proof || array_to_string(c[:f.p % 8], '') || array_to_string(c[f.p % 8 + 2:], '') AS proof
  FROM f{old} f JOIN n{j} n ON f.{group} IS NOT DISTINCT FROM n.{group} AND f.p // 8 = n.p)""".replace(
            f"SELECT {group}, p // 8", f"SELECT n{old}.{group}, p // 8"))

    for j in range(1, levels + 1):
        level(j, str(j - 1), "lang")
    out.append(f"""top AS (SELECT lang, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS p FROM n{levels}),
n{levels}r AS (SELECT 0 AS g, p, h FROM top),
f{levels}r AS (
  SELECT f.* EXCLUDE (p), 0 AS g, top.p, top.h AS subroot FROM f{levels} f JOIN top ON f.lang IS NOT DISTINCT FROM top.lang)""")
    level(levels + 1, f"{levels}r", "g")
    level(levels + 2, str(levels + 1), "g")
    return "WITH " + ",\n".join(out) + f"""
SELECT doc_id, leaf, subroot, n.h AS root, sha256(proof) AS proof_sha256, f.h AS folded_root, f.h = n.h AS verified
FROM f{levels + 2} f JOIN n{levels + 2} n ON f.g = n.g AND f.p = n.p"""


ORACLE_SQL = _oracle()
