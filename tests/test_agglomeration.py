"""Boundary features that add up, and merging by them against merging one boundary at a time."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelith.operators import agglomeration
from voxelith.plans import workflows

EDGES = "u long, v long, n long, total long"


def volume(spark, seed: int = 0, shape: tuple[int, int, int] = (5, 6, 7)):
    rnd = np.random.default_rng(seed)
    label, value = rnd.integers(0, 5, shape), rnd.integers(0, 300, shape)
    rows = [(*map(int, p), int(label[p]), int(value[p])) for p in np.ndindex(*shape)]
    return label, value, spark.createDataFrame(rows, "z long, y long, x long, label long, v long")


def faces(label: np.ndarray, value: np.ndarray) -> dict[tuple[int, int], list[int]]:
    out: dict[tuple[int, int], list[int]] = {}
    for axis in range(3):
        near, far = ([np.take(x, r, axis).ravel().tolist() for x in (label, value)] for r in (range(label.shape[axis] - 1), range(1, label.shape[axis])))
        for p, v, q, w in zip(*near, *far, strict=True):
            if p != q and p and q:
                out.setdefault((min(p, q), max(p, q)), []).append(max(v, w))
    return out


def described(values: list[int]) -> tuple:
    return (len(values), sum(values), sum(v * v for v in values), min(values), max(values), *[sum(min(v // 32, 7) == i for v in values) for i in range(8)])


def test_boundary_and_region_features(spark):
    label, value, df = volume(spark)
    got = {(r[0], r[1]): tuple(r)[2:] for r in agglomeration.boundary_features(df, "label", "v").collect()}
    assert got == {k: described(v) for k, v in faces(label, value).items()}
    regions = {r[0]: tuple(r)[1:] for r in agglomeration.region_features(df, "label", "v").collect()}
    assert regions == {i: described(value[label == i].tolist()) for i in range(1, 5)}
    both = agglomeration.described(agglomeration.boundary_features(df, "label", "v")).collect()
    for r in both:
        values = faces(label, value)[r.u, r.v]
        assert r["mean"] == pytest.approx(np.mean(values)) and r.variance == pytest.approx(np.var(values))


def test_parts_add_up(spark):
    _, _, df = volume(spark, 1)
    whole = agglomeration.region_features(df, "label", "v")
    parts = agglomeration.combined(agglomeration.region_features(df, "label", "v", ("z",)).drop("z"), "id")
    assert sorted(map(tuple, parts.select(*whole.columns).collect())) == sorted(map(tuple, whole.collect()))


def one_at_a_time(edges: list[tuple], threshold: float) -> dict[int, int]:
    now: dict[tuple[int, int], list[int]] = {}
    for u, v, n, total in edges:
        e = now.setdefault((min(u, v), max(u, v)), [0, 0])
        e[0], e[1] = e[0] + n, e[1] + total
    body = {x: x for e in now for x in e}
    while now:
        (u, v), (n, total) = min(now.items(), key=lambda e: (e[1][1] / e[1][0], e[0]))
        if total / n > threshold:
            break
        body = {x: u if b == v else b for x, b in body.items()}
        after: dict[tuple[int, int], list[int]] = {}
        for (a, b), (k, t) in now.items():
            a, b = (u if x == v else x for x in (a, b))
            if a != b:
                e = after.setdefault((min(a, b), max(a, b)), [0, 0])
                e[0], e[1] = e[0] + k, e[1] + t
        now = after
    return body


@pytest.mark.parametrize("threshold", [0, 40, 75, 1000])
def test_merging(spark, threshold):
    edges = []
    for seed in range(12):  # graphs apart from each other, of means that differ
        rnd = random.Random(seed)
        edges += [(100 * seed + u, 100 * seed + v, n := rnd.randrange(1, 30), rnd.randrange(0, 100 * n)) for u in range(12) for v in range(u) if rnd.random() < 0.35]
    got = {r.label: r.body for r in agglomeration.agglomerated(spark.createDataFrame(edges, EDGES), threshold).collect()}
    assert got == one_at_a_time(edges, threshold)


def test_edges_of_parts_and_of_nothing(spark):
    halves = spark.createDataFrame([(2, 1, 1, 10), (1, 2, 3, 200), (3, 3, 5, 0)], EDGES)
    assert {r.label: r.body for r in agglomeration.agglomerated(halves, 52.5).collect()} == {1: 1, 2: 1}
    assert {r.label: r.body for r in agglomeration.agglomerated(halves, 52.4).collect()} == {1: 1, 2: 2}
    assert agglomeration.agglomerated(halves.where("false"), 5).count() == 0


def test_workflow_and_voxels(spark):
    label, value, df = volume(spark, 2)
    out = workflows.edge_probabilities(df, "label", intensity="v", threshold=1000)
    assert {r.body for r in out["bodies"].collect()} == {1} and out["vertices"].count() == 4
    got = {(r.u, r.v): r.p for r in out["edges"].collect()}
    assert got == {k: round(1 - sum(v) / (len(v) * 255), 6) for k, v in faces(label, value).items()}
    merged = agglomeration.agglomerate(df, "label", "v", 1000)
    assert merged.columns == df.columns and sorted(r[0] for r in merged.select("label").distinct().collect()) == [0, 1]
    mine = workflows.edge_probabilities(df, "label", lambda e: e.select("u", (F.col("u_n") + F.col("v_n")).alias("size")), "v")["edges"]
    assert mine.count() == len(faces(label, value))
