"""Meshes: closed, welded over chunks, simplified within an error, with normals that point outwards."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelith.operators import meshes, segmentation
from voxelith.plans import workflows


def ball(spark, radius: float = 7.3, n: int = 20):
    at = np.indices((n, n, n)).reshape(3, -1).T
    inside = ((at - n / 2) ** 2).sum(axis=1) <= radius**2
    rows = [(*map(int, p), 3) for p in at[inside]] + [(0, 0, 0, 5), (0, 1, 1, 5), (0, 0, 1, 0)]
    return int(inside.sum()), spark.createDataFrame(rows, "z long, y long, x long, label long")


def edges(t: np.ndarray) -> dict:
    out: dict = {}
    for a, b, c in t.tolist():
        for p, q in ((a, b), (b, c), (c, a)):
            key = (min(p, q), max(p, q))
            out[key] = out.get(key, 0) + (1 if p < q else -1)
    return out


@pytest.mark.parametrize("block", [64, 6])
def test_closed_and_welded(spark, block):
    size, df = ball(spark)
    got = {r.label: r for r in meshes.summary(meshes.triangles(df, "label", block)).collect()}
    # two voxels that share an edge have six faces each and 14 corners, two in common
    assert set(got) == {3, 5} and (got[5].triangles, got[5].vertices, got[5].volume, got[5].open) == (24, 14, 2.0, 0)
    assert got[3].volume == size and got[3].open == 0 and got[3].vertices == got[3].triangles // 2 + 2


@pytest.mark.parametrize("block", [64, 10])
def test_simplified_chunks_still_fit(spark, block):
    size, df = ball(spark)
    df = df.where("label = 3")
    whole = meshes.summary(meshes.triangles(df, "label", block)).first()
    less = meshes.summary(meshes.triangles(df, "label", block, error=1.0)).first()
    assert less.open == 0 and less.triangles < whole.triangles * (0.5 if block == 64 else 0.8) and less.vertices == less.triangles // 2 + 2
    assert abs(less.volume - size) < 0.06 * size
    half = meshes.summary(meshes.triangles(df, "label", block, error=1.0, share=0.8)).first()
    assert whole.triangles * 0.7 < half.triangles < whole.triangles * 0.85 or block == 10


def test_flat_sides_need_two_triangles():
    quads = [("z", s, 0 if s == 0 else 3, y, x) for s in (0, 1) for y in range(4) for x in range(4)] + [(a, s, *((z, 0 if s == 0 else 3, i) if a == "y" else (z, i, 0 if s == 0 else 3))) for a in "yx" for s in (0, 1) for z in range(4) for i in range(4)]
    v, t = meshes.welded(quads)
    v2, t2 = meshes.simplified(v, t, np.zeros(len(v), bool), 1e-6)
    assert len(t2) == 12 and len(v2) == 8 and set(map(tuple, v2.tolist())) == {(a, b, c) for a in (0, 4) for b in (0, 4) for c in (0, 4)}
    assert not any(edges(t2).values()) and float((v2[t2[:, 0]] * meshes.areas(v2, t2)).sum() / 6) == pytest.approx(64)
    locked = (v == 0).any(axis=1)
    v3, t3 = meshes.simplified(v, t, locked, 1e-6)
    assert set(map(tuple, v[locked].tolist())) <= set(map(tuple, v3.tolist())) and not any(edges(t3).values())


def test_error_bounds_how_far_vertices_move():
    rnd = np.random.default_rng(3)
    height = np.cumsum(rnd.integers(-1, 2, 12)) % 4 + 2
    quads = []
    solid = {(z, y, x) for y in range(12) for x in range(12) for z in range(int(height[(x + y) // 2]))}
    for z, y, x in solid:
        for axis, side, p in (("z", 0, (z - 1, y, x)), ("z", 1, (z + 1, y, x)), ("y", 0, (z, y - 1, x)), ("y", 1, (z, y + 1, x)), ("x", 0, (z, y, x - 1)), ("x", 1, (z, y, x + 1))):
            if p not in solid:
                quads.append((axis, side, z, y, x))
    v, t = meshes.welded(quads)
    for error in (0.3, 0.8):
        v2, t2 = meshes.simplified(v, t, np.zeros(len(v), bool), error)
        assert len(t2) < len(t) and not any(edges(t2).values())
        # a vertex is within the error of every plane that it stands for, so of some corner of theirs
        far = np.sqrt(((v2[:, None] - v[None]) ** 2).sum(axis=2)).min(axis=1)
        assert far.max() <= error + 0.5


def test_normals_point_outwards(spark):
    size, df = ball(spark)
    out = meshes.normals(meshes.triangles(df.where("label = 3"), "label", 6)).collect()
    at, n = (np.array([[r[k] for k in keys] for r in out]) for keys in (("z", "y", "x"), ("nz", "ny", "nx")))
    assert len(out) == len(np.unique(at, axis=0)) and np.mean(((at - 10.5) * n).sum(axis=1) > 0) > 0.97
    assert n.sum(axis=0) == pytest.approx([0, 0, 0])


def test_obj(spark):
    _, df = ball(spark)
    rows = meshes.obj_chunks(meshes.triangles(df.where("label = 5"), "label", 64)).collect()
    lines = rows[0].content.decode().split("\n")
    assert len(rows) == 1 and [sum(x.startswith(k + " ") for x in lines) for k in ("v", "vn", "f")] == [14, 14, 24]
    v = np.array([list(map(float, x.split()[1:])) for x in lines if x.startswith("v ")])
    f = np.array([[int(p.split("//")[0]) - 1 for p in x.split()[1:]] for x in lines if x.startswith("f ")])
    assert np.einsum("ij,ij->i", v[f[:, 0]], np.cross(v[f[:, 1]] - v[f[:, 0]], v[f[:, 2]] - v[f[:, 0]])).sum() / 6 == pytest.approx(2)
    n = np.array([list(map(float, x.split()[1:])) for x in lines if x.startswith("vn ")])
    assert np.allclose(np.linalg.norm(n, axis=1), 1)


def test_nothing(spark):
    _, df = ball(spark)
    assert meshes.triangles(df.where("false"), "label").count() == 0 and meshes.summary(meshes.triangles(df.where(F.col("label") == 0), "label")).count() == 0


def test_workflow(spark):
    size, df = ball(spark)
    mapping = spark.createDataFrame([(3, 1), (5, 1)], "label long, body long")
    out = workflows.create_stitched_meshes(df, "label", mapping, block=10, error=0.5, smooth=False)
    got = meshes.summary(out["triangles"]).first()
    assert got.label == 1 and got.open == 0 and abs(got.volume - size - 2) < 0.1 * size
    assert out["obj"].count() == out["triangles"].select("bz", "by", "bx").distinct().count() and out["normals"].count() == got.vertices


def test_welded_by_arrays():
    quads = sorted((a, s, z, y, x) for a in "zyx" for s in (0, 1) for z in (-1, 0) for y in (0, 3) for x in (2, 5))
    at = np.array([q[2:] for q in quads])
    v, t = meshes._welded(np.array(["zyx".index(q[0]) for q in quads]), np.array([q[1] for q in quads]), at)
    for q, (one, two) in zip(quads, t.reshape(-1, 2, 3), strict=True):
        around = meshes.corners(*q)
        k = around.index(min(around))
        a, b, c, d = around[k:] + around[:k]
        assert [tuple(map(int, v[i])) for i in (*one, *two)] == [a, b, c, a, c, d]
    assert len({tuple(p) for p in v.tolist()}) == len(v)


def test_smoothed_by_blocks_of_corners(spark):
    a = np.random.default_rng(3).integers(0, 3, (7, 6, 9))
    df = spark.createDataFrame([(*(c - 3 for c in map(int, p)), int(a[p])) for p in np.ndindex(a.shape)], "z long, y long, x long, v long")
    want = sorted(map(tuple, segmentation.smoothed(segmentation.faces(df, "v")).collect()))
    for block in (1, 4, 32):
        assert sorted(map(tuple, segmentation.smoothed_corners(df, "v", block).collect())) == want
    # voxels are shuffled once, and faces are no rows
    assert segmentation.smoothed_corners(df, "v")._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    quads = spark.createDataFrame([(1, "z", 1, 0, 0, 0)], "label long, axis string, side int, z long, y long, x long")
    assert "Window" not in segmentation.smoothed(quads)._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r)[-3:] for r in segmentation.smoothed(quads).collect()} == {(1.0, 0.5, 0.5)}


@pytest.mark.parametrize(("block", "lot", "error"), [(3, 1, None), (3, 6, None), (8, 64, None), (4, 8, 0.6)])
def test_summary_in_the_tasks_that_make_the_mesh(spark, monkeypatch, block, lot, error):
    monkeypatch.setattr(meshes, "LOT", lot)
    a = np.random.default_rng(4).integers(-1, 3, (9, 8, 11))
    df = spark.createDataFrame([(*(c - 4 for c in map(int, p)), int(a[p])) for p in np.ndindex(a.shape)], "z long, y long, x long, v long")
    mesh = meshes.triangles(df, "v", block, error)
    got = meshes.mesh_summary(df, "v", block, error)
    want = meshes.summary(mesh)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.columns == want.columns
    if error is None:
        assert {(r.label, r.triangles) for r in got.collect()} == {(r.label, 2 * r["count"]) for r in segmentation.faces(df, "v").groupBy("label").count().collect()}
        assert {r.label: r.volume for r in got.collect()} == {k: (a == k).sum() for k in (-1, 1, 2)}
    # voxels are shuffled once, and neither faces, corners nor edges inside a lot are rows
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Generate explode") == 3


def test_corners_by_blocks(spark):
    a = np.random.default_rng(5).integers(-1, 3, (7, 6, 9))
    df = spark.createDataFrame([(*(c - 3 for c in map(int, p)), int(a[p])) for p in np.ndindex(a.shape)], "z long, y long, x long, v long")
    want = sorted(map(tuple, segmentation.face_corners(segmentation.faces(df, "v")).select("label", "vz", "vy", "vx").distinct().collect()))
    for block in (1, 4, 32):
        assert sorted(map(tuple, segmentation.corners(df, "v", block).collect())) == want
    mapping = spark.createDataFrame([(2, 1)], "label long, body long")
    made = workflows.create_meshes(df, "v", mapping, 4, least_body=1 + int((a == -1).sum()), smooth=False)
    assert sorted(map(tuple, made["vertices"].collect())) == [w for w in want if w[0] in (1, 2)]
    # voxels meet the kept segments where they are, not by their label, of which one may have most
    plan = made["vertices"]._jdf.queryExecution().sparkPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
