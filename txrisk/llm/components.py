"""Connected components of a table of edges: contracted inside tasks first, then by alternating large and small stars.

A task takes a bounded number of edges and replaces them by stars around the smallest vertex of each component it sees. Where one
task has seen all edges, nothing is left to do. Else every round links each vertex to the smallest one it can see; after a number of rounds
that grows with the logarithm of the vertices, each component is a star around its smallest vertex.

A vertex with very many neighbours is reduced to a few edges per task before the rounds; in the rounds, the least neighbour of each
vertex is a table of its own, so a join's hot vertex can be split. Rounds are kept in the shared folder, so lineage stays short; nothing but
a count and a checksum of the edges reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import kept, settled

TASK_EDGES = 200_000


def smallest_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number in the component of each of 0 .. n-1 under the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (vertex, smallest vertex) of the components of a task's edges."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    ends = pa.concat_arrays([b.column(k) for k in range(2) for b in held])
    names = ends.unique()
    names = names.take(pc.sort_indices(names))
    number = pc.index_in(ends, value_set=names).to_numpy()
    root = smallest_linked(len(names), *np.split(number, 2))
    moved = np.flatnonzero(root != np.arange(len(root)))
    yield pa.RecordBatch.from_arrays([names.take(pa.array(moved)), names.take(pa.array(root[moved]))], names=["a", "b"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b) with b < a, in and out."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = kept(both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    joined = both.join(least, F.col("u") == F.col("w"))
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b"))
    return out.where("a != b").distinct()


def components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """(vertex, root) for every vertex of ``edges`` (a, b), in which the order of the two and repeated edges do not matter."""
    return settled(edges.sparkSession, "components", lambda: _components(edges, task_edges))


def _components(edges: DataFrame, task_edges: int) -> DataFrame:
    edges = kept(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    tasks = -(-edges.count() // task_edges)
    if tasks:
        edges = kept(edges.coalesce(tasks).mapInArrow(_contracted, edges.schema), "edges")
    before = None
    while tasks > 1:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
        edges = kept(_star(_star(edges, True), False), "edges")
    roots = edges.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(roots)
