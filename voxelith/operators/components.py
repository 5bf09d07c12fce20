"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelith.sources.scratch import Scratch

MAX_ROUNDS = 60
#: Edges between ranges of so many names are dealt together, and so many edges are contracted at once.
RANGE, CHUNK = 1_024, 1 << 19


def _large_star(edges: DataFrame, scratch: Scratch, rows: int) -> DataFrame:
    """Larger neighbours of a node go to the smallest of its neighbours and itself."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = scratch.store(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), rows)
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, scratch: Scratch, rows: int) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of those. edges: u > v."""
    least = scratch.store(edges.groupBy("u").agg(F.min("v").alias("m")), rows)
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())


def _in_one_task(t: pa.Table) -> pa.Table:
    """Union by the smaller label, with path halving."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for u, v in zip(t.column("u").to_pylist(), t.column("v").to_pylist(), strict=True):
        a, b = find(u), find(v)
        if a != b:
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    return pa.table({"node": pa.array(nodes, pa.int64()), "component": pa.array([find(x) for x in nodes], pa.int64())})


def components(edges: DataFrame, scratch: Scratch, small: int = 0, rows: int | None = None) -> DataFrame:
    """(node, component): the smallest node reachable, for each node with an edge. edges: u, v of type long.

    A step aggregates by node, writes the minima and joins them back, so a node with very many edges is one row on one
    side of a join whose other side Spark can split. Every step is a written table. A graph of at most `small` edges,
    counted first, takes one task instead of those steps. rows: how many edges there are at most, if that is known.
    """
    now = scratch.store(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), rows)
    if small and now.count() <= small:
        return now.groupBy().applyInArrow(_in_one_task, "node long, component long")
    sign = _signature(now)
    for _ in range(MAX_ROUNDS):
        step = Scratch(scratch.spark, "step")
        rows = sign[0]
        after = scratch.store(_small_star(step.store(_large_star(now, step, rows), rows), step, rows), rows)
        step.clear()
        scratch.free(now)
        now, before, sign = after, sign, _signature(after)
        if sign == before:
            break
    else:
        raise RuntimeError("components did not converge")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _stars(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """(node, root) of each node of the edges: the least node that it reaches through them. Roots are hooked to smaller ones and paths halved until nothing moves."""
    ids, back = np.unique(np.concatenate([u, v]), return_inverse=True)
    u, v, parent = back[: len(u)], back[len(u) :], np.arange(len(ids))
    while True:
        a, b = parent[u], parent[v]
        open_ = a != b
        if not open_.any():
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[parent])], names=["node", "root"])
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(parent, above := parent[parent]):
            parent = above


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        held.append([c.to_numpy() for c in batch.columns])
        n += batch.num_rows
        if n >= CHUNK:
            yield _stars(*map(np.concatenate, zip(*held, strict=True)))
            held, n = [], 0
    if n:
        yield _stars(*map(np.concatenate, zip(*held, strict=True)))


def contracted_components(edges: DataFrame, scratch: Scratch, small: int) -> DataFrame:
    """components() of a graph most of whose edges are between near names: those are dealt together and contracted in bounded chunks, a row to a node.

    Nodes that several chunks have tie their roots, and only the graph of those roots goes through the steps. With edges
    between any names that graph is as large as the first one.
    """
    cell = [F.floor(F.col(c) / RANGE).cast("long").alias(f"_{c}") for c in "uv"]
    dealt = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).select("u", "v", *cell).repartition("_u", "_v").sortWithinPartitions("_u", "_v").select("u", "v")
    stars = scratch.store(dealt.mapInArrow(_contracted, "node long, root long"))
    if stars.count() <= small:
        return stars.select(F.col("node").alias("u"), F.col("root").alias("v")).groupBy().applyInArrow(_in_one_task, "node long, component long")
    nodes = scratch.store(stars.groupBy("node").agg(F.min("root").alias("root"), F.max("root").alias("_most")))
    torn = nodes.where("root < _most").select("node", F.col("root").alias("v"))
    ties = stars.join(torn, "node").where("root > v").select(F.col("root").alias("u"), "v")
    roots = components(ties, scratch, small).toDF("root", "component")
    return nodes.join(roots, "root", "left").select("node", F.coalesce("component", "root").alias("component"))
