"""Connected components of an edge table: edges are contracted within tasks,
then labels go round until nothing changes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.text import checkpoint

CHUNK = 1_000_000       # edges that a task contracts together


def _contract(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node with the smallest node that these edges connect it with."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    up = list(range(len(nodes)))        # nodes ascend, so the smaller index is the smaller node

    def top(k: int) -> int:
        while up[k] != k:
            up[k] = k = up[up[k]]
        return k

    for x, y in zip(ends[:len(u)].tolist(), ends[len(u):].tolist(), strict=True):
        x, y = top(x), top(y)
        up[max(x, y)] = min(x, y)
    return nodes, nodes[[top(k) for k in range(len(up))]]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's edges, CHUNK at a time, as edges from each node to its smallest."""
    def done(part: list) -> Iterator[pa.RecordBatch]:
        if part:
            node, root = _contract(*(np.concatenate(x) for x in zip(*part, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["u", "v"])

    part, size = [], 0
    for batch in batches:
        part.append([np.asarray(batch.column(k)) for k in range(2)])
        size += batch.num_rows
        if size >= CHUNK:
            yield from done(part)
            part, size = [], 0
    yield from done(part)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of ``edges`` (two long columns); label is
    the smallest node that it is connected with.

    Tasks contract the edges they have to one for each node, then those of
    one node's hash share a task, which contracts them again: long paths
    become short, and several edges of a node one. Each turn then takes the
    smallest label among a node's neighbours and the label of that label, until
    nothing changes. Minima are aggregated before the shuffle, so a node with
    very many edges is one row per task.
    """
    stars = (edges.select(F.col(a).alias("u"), F.col(b).alias("v")).mapInArrow(_stars, "u long, v long")
             .repartition("u").mapInArrow(_stars, "u long, v long"))
    both = checkpoint(
        stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    label = checkpoint(both.groupBy(F.col("u").alias("node"))
                       .agg(F.least(F.col("node"), F.min("v")).alias("label")))
    both = both.where("u <> v")
    while True:
        near = (both.join(label, F.col("v") == F.col("node"))
                .groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near")))
        hooked = label.join(near, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label"))
        root = label.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = checkpoint(hooked.join(root, "label", "left")
                          .select("node", "old", F.least("label", F.coalesce("next", "label")).alias("label")))
        label = step.select("node", "label")
        if step.where("old <> label").isEmpty():
            return label
