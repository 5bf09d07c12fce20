"""Operators against literal cases and brute force."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelith.functions import grid
from voxelith.operators import bodies, components, graph, matching, overlap, segmentation, volume
from voxelith.sources import blocks, slices, tables
from voxelith.sources.scratch import Scratch


def voxels(spark, array, value="v"):
    return spark.createDataFrame([(*map(int, p), int(array[p])) for p in np.ndindex(array.shape)], f"z long, y long, x long, {value} long")


def dense(df, shape, value="v"):
    out = np.zeros(shape, np.int64)
    for r in df.collect():
        out[r.z, r.y, r.x] = r[value]
    return out


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_run_lengths(spark):
    picture = [(0, 0, 1), (0, 0, 2), (0, 0, 4), (0, 2, 1), (0, 2, 2), (0, 2, 3), (0, 3, 0), (0, 3, 1), (0, 3, 3), (0, 3, 4), (0, 4, 0), (0, 4, 1), (0, 4, 2), (0, 4, 3), (0, 4, 4)]
    df = spark.createDataFrame(picture + picture[:3], "z long, y long, x long")
    runs = volume.run_lengths(df)
    assert rows(runs) == [(0, 0, 1, 2), (0, 0, 4, 4), (0, 2, 1, 3), (0, 3, 0, 1), (0, 3, 3, 4), (0, 4, 0, 4)]
    assert rows(volume.roi_blocks(runs)) == sorted(picture)


def test_blockwise_boxes(spark):
    out = volume.boxes((0, 10, 10), (1, 100, 100), grid.Grid((1, 30, 40)), spark)
    assert out.count() == 12
    assert out.agg(F.sum((F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0")))).first()[0] == 90 * 90
    offset = volume.boxes((0, 15, 30), (1, 95, 290), grid.Grid((1, 10, 20), (0, 12, 3)), spark)
    assert offset.count() == 9 * 14


def test_downsample_literal(spark):
    rnd = np.random.default_rng(3)
    a = rnd.integers(0, 4, (4, 6, 7))
    out = dense(volume.downsample_mode(voxels(spark, a), 3, "v"), (2, 2, 3))
    for p in np.ndindex(2, 2, 3):
        block = a[tuple(slice(3 * i, 3 * i + 3) for i in p)].ravel()
        counts = np.bincount(block, minlength=4)
        assert out[p] == counts.argmax()
    skipped = dense(volume.downsample_mode(voxels(spark, a), 3, "v", True), (2, 2, 3))
    for p in np.ndindex(2, 2, 3):
        counts = np.bincount(a[tuple(slice(3 * i, 3 * i + 3) for i in p)].ravel(), minlength=4)
        counts[0] = 0
        assert skipped[p] == (counts.argmax() if counts.any() else 0)


def test_halo(spark):
    a = np.arange(6 * 6 * 6).reshape(6, 6, 6) + 1
    out = volume.retile_with_halo(voxels(spark, a), grid.cube(3), 1)
    for r in out.groupBy("bz", "by", "bx").agg(F.count("*").alias("n"), F.min("z").alias("lo"), F.max("z").alias("hi")).collect():
        assert r.n == 4**3 and (r.lo, r.hi) == ((0, 3) if r.bz == 0 else (2, 5))
    assert volume.without_halo(out).count() == a.size
    corner = voxels(spark, a).where("z = 2 AND y = 2 AND x = 2")
    assert volume.retile_with_halo(corner, grid.cube(3), 1).select("bz", "by", "bx").distinct().count() == 1


def test_transpose_translate_upsample(spark):
    a = np.random.default_rng(1).integers(1, 9, (2, 3, 4))
    out = dense(volume.transpose(voxels(spark, a), "xYz", a.shape), (4, 3, 2))
    assert (out == a.transpose(2, 1, 0)[:, ::-1, :]).all()
    assert (dense(volume.upsample(voxels(spark, a), 2), (4, 6, 8)) == a.repeat(2, 0).repeat(2, 1).repeat(2, 2)).all()
    back = volume.translate(volume.translate(voxels(spark, a), (-9, 4, 1)), (9, -4, -1))
    assert (dense(back, a.shape) == a).all()


def test_pyramid_depth():
    assert [grid.pyramid_depth(n) for n in (1, 512, 513, 1024, 5000)] == [0, 0, 1, 1, 4]


def test_block_store(spark, tmp_path):
    a = np.random.default_rng(2).integers(0, 99, (9, 7, 5))
    df = voxels(spark, a).withColumn("scale", F.lit(0)).union(voxels(spark, a[:2]).withColumn("scale", F.lit(1)))
    blocks.write(df, f"file://{tmp_path}/b", "v", 4)
    got = blocks.read(spark, f"file://{tmp_path}/b", "v", 0, ((1, 0, 2), (8, 5, 5)), 4)
    assert (dense(got, a.shape)[1:8, :5, 2:] == a[1:8, :5, 2:]).all() and got.count() == 7 * 5 * 3
    plan = spark.read.parquet(f"file://{tmp_path}/b").where("scale = 1 AND slab = 0 AND bz <= 0").select("bz")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(scale" in plan and "LessThanOrEqual(bz,0)" in plan


def test_slices(spark, tmp_path):
    a = np.random.default_rng(4).integers(0, 256, (3, 5, 6))
    for z, image in enumerate(a):
        if z != 1:
            (tmp_path / f"s-{z:05d}.pgm").write_bytes(slices.encode(image))
    got = slices.read_files(spark, f"file://{tmp_path}/s-*.pgm", "v")
    assert (dense(got, a.shape)[[0, 2]] == a[[0, 2]]).all() and got.count() == 60
    assert rows(slices.with_gaps(got, 0, 3)) == [(0, True), (1, False), (2, True)]


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(3, 1), (1, 3), (2, 5)], "u long, v long")
    tables.write_csv(df, f"file://{tmp_path}/e")
    tables.write_csv(df, f"file://{tmp_path}/e", append=True)
    assert tables.read_edges(spark, f"file://{tmp_path}/e").count() == 6
    assert rows(graph.normalised_edges(tables.read_edges(spark, f"file://{tmp_path}/e"))) == [(1, 3), (2, 5)]


def brute_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)]
    edges = [(u, v) for u, v in edges if u != v]
    df = spark.createDataFrame(edges, "u long, v long")
    assert dict(rows(components.components(df, Scratch(spark, "t")))) == brute_components(edges)
    assert dict(rows(components.components(df, Scratch(spark, "t"), small=1000))) == brute_components(edges)


def test_components_of_nothing(spark):
    assert graph.mapping_from_edges(spark.createDataFrame([], "u long, v long")).count() == 0


def test_connected_voxels(spark):
    a = np.random.default_rng(5).integers(0, 3, (5, 5, 5))
    edges = []
    number = lambda p: (p[0] * 5 + p[1]) * 5 + p[2]
    for p in np.ndindex(a.shape):
        if a[p]:
            edges.append((number(p), number(p)))
            for axis in range(3):
                q = tuple(c + (i == axis) for i, c in enumerate(p))
                if q[axis] < 5 and a[q] == a[p]:
                    edges.append((number(p), number(q)))
    want = brute_components(edges)
    got = {(r.z * 5 + r.y) * 5 + r.x: r.component for r in graph.connected_voxels(voxels(spark, a), "v", a.shape).collect()}
    assert got == want
    for block in (2, 3):
        assert {(r.z * 5 + r.y) * 5 + r.x: r.component for r in graph.connected_voxels(voxels(spark, a), "v", a.shape, block=block).collect()} == want
    parts, names = graph.split_disconnected(voxels(spark, a), "v", a.shape)
    assert parts.count() == (a > 0).sum()
    for r in names.collect():
        if r.part == r.label:
            assert r["size"] == max(s["size"] for s in names.collect() if s.label == r.label)


def test_faces_and_contacts(spark):
    a = np.random.default_rng(6).integers(0, 3, (4, 4, 4))
    want, touching = set(), {}
    for p in np.ndindex(a.shape):
        for axis, name in enumerate("zyx"):
            for side in (0, 1):
                q = tuple(c + (2 * side - 1) * (i == axis) for i, c in enumerate(p))
                other = a[q] if all(0 <= c < 4 for c in q) else 0
                if a[p] and other != a[p]:
                    want.add((a[p], name, side, *p))
                    if side and other:
                        key = tuple(sorted((int(a[p]), int(other))))
                        touching[key] = touching.get(key, 0) + 1
    assert set(map(tuple, segmentation.faces(voxels(spark, a), "v").collect())) == want
    assert {(r.u, r.v): r.weight for r in graph.rag_edges(voxels(spark, a), "v").collect()} == touching


def test_mesh_of_one_voxel(spark):
    one = spark.createDataFrame([(2, 3, 4, 1)], "z long, y long, x long, v long")
    quads = segmentation.faces(one, "v")
    assert quads.count() == 6
    corners = segmentation.face_corners(quads)
    assert {tuple(r) for r in corners.select("vz", "vy", "vx").collect()} == set(itertools.product((2, 3), (3, 4), (4, 5)))
    for r in segmentation.smoothed(quads).collect():  # towards the middle
        assert all(abs(s - m) < abs(v - m) for s, v, m in ((r.sz, r.vz, 2.5), (r.sy, r.vy, 3.5), (r.sx, r.vx, 4.5)))


def test_overlap_metrics(spark):
    rnd = np.random.default_rng(7)
    gt, seg = rnd.integers(0, 5, 400), rnd.integers(0, 4, 400)
    df = spark.createDataFrame(list(zip(gt.tolist(), seg.tolist(), strict=True)), "gt long, seg long")
    over = overlap.overlap(df)
    table = np.zeros((5, 4))
    np.add.at(table, (gt, seg), 1)
    table = table[1:]
    n = table.sum()
    some = table > 0
    t, s = table.sum(1, keepdims=True), table.sum(0, keepdims=True)
    fs = round(float((table * np.log2(np.where(some, t / np.where(some, table, 1), 1))).sum() / n), 4)
    fm = round(float((table * np.log2(np.where(some, s / np.where(some, table, 1), 1))).sum() / n), 4)
    assert tuple(overlap.vi(over).first()) == (fm, fs, round(fm + fs, 4))
    pairs = lambda v: (v * (v - 1) / 2).sum()
    m, sp = round(pairs(table) / pairs(s), 4), round(pairs(table) / pairs(t), 4)
    assert tuple(overlap.rand(over).first()) == (m, sp, round(2 * m * sp / (m + sp), 4))
    none = over.where("gt > 99")
    assert tuple(overlap.vi(none).first()) == (0.0, 0.0, 0.0) and tuple(overlap.rand(none).first()) == (1.0, 1.0, 1.0)


@pytest.mark.parametrize("seed", range(200))
def test_assignment(seed):
    rnd = random.Random(seed)
    value = {i: {100 + j: rnd.randrange(1, 9) for j in range(5) if rnd.random() < 0.6} for i in range(rnd.randrange(1, 6))}
    got = graph.assignment(value)
    assert len(set(got.values())) == len(got) and all(j in value[i] for i, j in got.items())
    every = [c for c in itertools.product(*([None, *row] for row in value.values())) if len([j for j in c if j]) == len({j for j in c if j})]
    assert sum(value[i][j] for i, j in got.items()) == max(sum(row[j] for row, j in zip(value.values(), c, strict=True) if j) for c in every)


def test_match_bodies(spark):
    over = spark.createDataFrame([(1, 10, 50), (1, 11, 40), (2, 10, 45), (3, 12, 5), (4, 12, 6), (5, 0, 9)], "gt long, seg long, n long")
    assert rows(matching.match_bodies(over)) == [(1, 11, 40), (2, 10, 45), (3, 0, 0), (4, 12, 6)]
    wide = spark.createDataFrame([(2**62 + 5, 2**62 + 9, 7), (2**53 + 1, 2**53 + 1, 3), (2**53, 2**53 + 1, 2)], "gt long, seg long, n long")
    assert rows(matching.match_bodies(wide)) == [(2**53, 0, 0), (2**53 + 1, 2**53 + 1, 3), (2**62 + 5, 2**62 + 9, 7)]


def test_edit_distance(spark):
    over = spark.createDataFrame([(1, 10, 100), (2, 10, 40), (1, 11, 30), (2, 12, 25), (2, 13, 20), (3, 12, 5)], "gt long, seg long, n long")
    ops = overlap.edit_operations(over)
    assert {(r.kind, r.n) for r in ops.collect()} == {("split", 40), ("merge", 30), ("merge", 20), ("split", 5)}
    # 220 voxels in all; a merge of 30 or 20 comes before the split of 40, which counts 8
    assert rows(graph.edit_distance(ops, 220, (10, 20, 40))) == [(10, 0, 1), (20, 0, 2), (40, 1, 2)]


def test_stitching(spark):
    counts = spark.createDataFrame([(1, 5, 900), (1, 6, 60), (2, 6, 100), (3, 7, 40), (4, 5, 2000)], "u long, v long, n long")
    assert rows(graph.stitch_pairs(counts, "none")) == []
    assert len(rows(graph.stitch_pairs(counts, "simple"))) == 5
    assert rows(graph.stitch_pairs(counts, "medium")) == [(2, 6), (4, 5)]
    assert rows(graph.stitch_pairs(counts, "conservative")) == []
    assert rows(graph.stitch_pairs(counts, "aggressive")) == [(2, 6), (4, 5)]
    df = spark.createDataFrame([(0, 0, 0, 6), (0, 0, 1, 2), (0, 0, 2, 9)], "z long, y long, x long, v long")
    assert rows(graph.stitched(df, "v", graph.stitch_pairs(counts, "medium")).select("x", "v")) == [(0, 2), (1, 2), (2, 9)]


def test_watershed(spark):
    wall = np.ones((8, 8, 8))
    wall[:, :, :3], wall[:, :, 5:] = 0, 0
    out = segmentation.seeded_watershed(wall, 0.5, 4)
    assert set(np.unique(out)) == {1, 2} and (out[:, :, :3] == 1).all() and (out[:, :, 5:] == 2).all()
    df = voxels(spark, (wall * 10).astype(int))
    got = segmentation.run_step(df, "seeded-watershed", "v", "label", 8, threshold=5.0)
    assert (dense(got, (8, 8, 8), "label") == out).all()
    speck = np.ones((8, 8, 8))
    speck[:, :, :3], speck[:, :, 6:], speck[0, 0, 4] = 0, 0, 0
    assert set(np.unique(segmentation.seeded_watershed(speck, 0.5, 1, min_size=100))) == {1, 3}


def test_components_of_mask():
    a = np.random.default_rng(8).random((6, 6, 6)) < 0.4
    label = segmentation.components_of(a)
    edges = [(0, 0)]
    for p in np.ndindex(a.shape):
        for axis in range(3):
            q = tuple(c + (i == axis) for i, c in enumerate(p))
            if q[axis] < 6 and a[p] and a[q]:
                assert label[p] == label[q]
                edges.append((np.ravel_multi_index(p, a.shape), np.ravel_multi_index(q, a.shape)))
    alone = a.sum() - len({x for e in edges[1:] for x in e})
    assert label.max() == len(set(brute_components(edges[1:]).values())) + alone and ((label > 0) == a).all()


def test_segment_pipeline(spark):
    a = np.full((6, 6, 6), 200)
    a[:, :, 3] = 0
    out = segmentation.segment(voxels(spark, a), "v", 6, [("membranes", {}), ("seeded-watershed", {"threshold": 0.5}), ("keep", {})])
    labels = dense(out.withColumn("label", F.col("label").cast("long")), a.shape, "label")
    assert len(np.unique(labels[:, :, :3])) == 1 and len(np.unique(labels[:, :, 4:])) == 1 and labels[0, 0, 0] != labels[0, 0, 5]
    gaps = segmentation.run_step(voxels(spark, np.where(a == 0, 0, 1)), "empty-regions", "v", "mask", 6, least=10)
    assert (dense(gaps.withColumn("mask", F.col("mask").cast("long")), a.shape, "mask") == (a > 0)).all()


def test_label_index(spark):
    stats = spark.createDataFrame([(1, 0, 0, 64, 5), (2, 0, 0, 64, 7), (2, 64, 0, 0, 1), (9, 0, 0, 0, 3)], "segment_id long, z long, y long, x long, count long")
    mapping = spark.createDataFrame([(1, 1), (2, 1)], "label long, body long")
    index = bodies.label_index(stats, mapping, 64)
    assert {(r.body, r.slab): r.blocks for r in index.collect()} == {(1, 0): {1: {1: 5, 2: 7}, 1 << 42: {2: 1}}, (9, 0): {0: {9: 3}}}
    assert rows(bodies.index_rows(index)) == [(1, 1, 1, 5), (1, 1, 2, 7), (1, 1 << 42, 2, 1), (9, 0, 9, 3)]
    assert rows(bodies.tombstones(mapping)) == [(2, 0)]


def test_erosion_goes_on_from_what_remains(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(9)], "u long, v long")
    assert rows(graph.erode_leaves(path, 2)) == [(i, i + 1) for i in range(2, 7)]


def test_channels(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 5.0]), (2, [0.0, 0.0, 0.0])], "i int, v array<double>")
    out = rows(df.select("i", volume.merged_channels(F.col("v"), [[0, 2], [1]]).alias("m"), volume.normalised_channels(F.col("v")).alias("n")))
    assert out[0][1] == [6.0, 2.0] and out[0][2] == [0.125, 0.25, 0.625] and out[1][2] == [1 / 3] * 3


def test_eligible_pairs(spark):
    counts = spark.createDataFrame([(1, 5, 900), (1, 6, 60), (2, 6, 100)], "u long, v long, n long")
    plane = spark.createDataFrame([(0, 3, 0, 1), (0, 4, 0, 2), (1, 3, 0, 0)], "z long, y long, x long, label long")
    assert rows(graph.on_plane(plane, "label", "y", 3)) == [(1,)]
    assert rows(graph.eligible(counts, graph.on_plane(plane, "label", "y", 3), None, [5])) == [(1, 6, 60)]
    assert rows(graph.eligible(counts)) == rows(counts)


def test_configured_steps(spark):
    config = {"create-supervoxels": {"step": "seeded-watershed", "parameters": {"threshold": 0.5}}, "background-mask": {"step": "empty-regions"}}
    assert segmentation.configured(config) == [("empty-regions", {}), ("seeded-watershed", {"threshold": 0.5})]
    for wrong in ({"other": {"step": "keep"}}, {"predict-voxels": {"step": "none"}}):
        with pytest.raises(ValueError):
            segmentation.configured(wrong)
    gray = np.full((6, 6, 6), 200.0)
    gray[:, :, 3], gray[:3, :, :3] = 10, 0
    out = segmentation.gray_only(gray, 0.2, 5, 50)
    assert (out[:3, :, :3] == 0).all() and len(np.unique(out[3:, :, :3])) == 1 and out[5, 0, 0] != out[0, 0, 5]


def test_factors_and_huge_groups(spark):
    df = spark.createDataFrame([(1000, None), (1000, 10), (10**9, None)], "box long, own long")
    got = [r[0] for r in df.select(bodies.downsample_factor(F.col("box"), 125, 1, F.col("own"))).collect()]
    assert got == [3, 5, 201] and df.select(bodies.downsample_factor(F.col("box"), 1)).where("box = 1000000000").first()[0] is None
    sizes = spark.createDataFrame([(1, 5), (1, 6), (2, 10)], "g long, n long")
    kept, huge = bodies.without_huge(sizes, "g", "n", 10)
    assert rows(kept) == [(2, 10)] and rows(huge) == [(1, 11)]
    assert [r[0] for r in bodies.by_size(spark.createDataFrame([(1, 5), (2, 9), (3, 5)], "segment long, voxel_count long")).collect()] == [2, 1, 3]


def test_index_mismatches(spark):
    schema = "body long, block long, segment_id long, count long"
    actual = [(1, 5, 1, 9), (2, 5, 2, 3), (2, 6, 2, 4), (3, 1, 3, 1), (4, 1, 4, 1), (4, 1, 5, 2)]
    stored = [(1, 5, 1, 9), (2, 5, 2, 3), (4, 1, 4, 1), (4, 1, 5, 3), (9, 9, 9, 9)]
    assert rows(bodies.index_mismatches(spark.createDataFrame(stored, schema), spark.createDataFrame(actual, schema))) == [(2, "mismatch"), (3, "missing"), (4, "mismatch")]


def test_label_pairs_and_padded_parts(spark):
    gt = spark.createDataFrame([(0, 0, x, x % 3) for x in range(6)], "z long, y long, x long, label long")
    seg = spark.createDataFrame([(0, 0, x, 7) for x in range(5)], "z long, y long, x long, label long")
    cells = grid.Grid((4, 4, 4))
    got = {(r.bx, r.x): (r.gt, r.seg, r.in_halo) for r in volume.label_pairs(gt, seg, cells, 1).collect()}
    assert got == {(0, 0): (0, 0, False), (0, 1): (1, 7, False), (0, 2): (2, 7, False), (0, 3): (0, 0, False), (0, 4): (1, 7, True), (1, 3): (0, 0, True), (1, 4): (1, 7, False), (1, 5): (2, 0, False)}
    assert {r.seg for r in volume.label_pairs(gt, None, cells).collect()} == {1}
    part = {r.x: (r.label, r.valid) for r in volume.padded_parts(gt.where("x = 3 OR x = 1"), cells, "label", 2, -1).collect() if (r.z, r.y) == (0, 0)}
    assert part == {0: (-1, False), 1: (1, True), 2: (-1, False), 3: (0, True)}
    assert volume.padded_parts(gt.where("x = 3"), cells, "label", 2).count() == 8


def test_member_texts_hold_whole_bodies(spark):
    mapping = spark.createDataFrame([(x, 1) for x in (1, 9, 10, 25, 107)] + [(30, 30)], "label long, body long")
    assert rows(graph.member_texts(graph.groups(mapping, 10))) == [(1, 5, "1,9,10,25,107"), (30, 1, "30")]


def test_contracted_components(spark, monkeypatch):
    monkeypatch.setattr(components, "RANGE", 8)
    rng = random.Random(5)
    edges = [(a, min(a + rng.randint(0, 3), 399)) for a in range(400) if rng.random() < 0.6] + [(rng.randrange(400), rng.randrange(400)) for _ in range(40)] + [(900, 901), (905, 905)]
    least = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(400):
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    df = spark.createDataFrame(edges * 2, "u long, v long").repartition(5)
    for small in (0, 100_000):
        assert rows(components.contracted_components(df, Scratch(spark, "test"), small)) == sorted(least.items())


def test_near_names_need_no_rounds(spark, monkeypatch):
    monkeypatch.setattr(graph, "SMALL_GRAPH", 100)
    monkeypatch.setattr(components, "MAX_ROUNDS", 0)
    edges = spark.range(3_000).select((F.col("id") * 2).alias("u"), (F.col("id") * 2 + 1).alias("v"))
    assert graph.mapping_from_edges(edges).where("body = label - label % 2").count() == 6_000


@pytest.mark.parametrize("name, block, parameters", [("empty-regions", 4, {"least": 8}), ("membranes", 5, {}), ("empty-regions", 40, {"least": 8})])
def test_steps_run_on_each_block_alone(spark, name, block, parameters):
    rnd = np.random.default_rng(9)
    at = [tuple(map(int, p - 6)) for p in np.argwhere(rnd.random((14, 9, 38)) < 0.7)]  # boxes of blocks differ
    value = {p: int(rnd.integers(0, 2)) for p in at}
    df = spark.createDataFrame([(*p, v) for p, v in value.items()], "z long, y long, x long, v long")
    calls = {}
    for p in at:
        calls.setdefault(tuple(c // block for c in p), []).append(p)
    want = {}
    for b, own in calls.items():
        low = np.min(own, 0)
        array = np.zeros(np.max(own, 0) - low + 1)
        for p in own:
            array[tuple(p - low)] = value[p]
        done = segmentation.STEPS[name](array, **parameters)
        want |= {p: (*b, float(done[tuple(p - low)])) for p in own}
    got = segmentation.run_step(df, name, "v", "out", block, **parameters)
    assert {(r.z, r.y, r.x): (r.bz, r.by, r.bx, r.out) for r in got.collect()} == want


def test_small_blocks_share_a_group(spark):
    df = spark.range(4096).select(F.col("id") % 16, F.floor(F.col("id") / 16) % 16, F.floor(F.col("id") / 256), F.lit(0)).toDF("z", "y", "x", "v")
    assert "gz" in segmentation.run_step(df, "empty-regions", "v", "out", 4)._jdf.queryExecution().optimizedPlan().toString()
    stack = np.zeros((2, 3, 3, 3))
    stack[1, 1] = 1
    both = segmentation.empty_regions(stack, 10)
    assert not both[0].any() and both[1].all()
