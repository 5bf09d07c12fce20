"""Sources, workflows and streams."""

from __future__ import annotations

import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelith.operators import tiles
from voxelith.plans import workflows
from voxelith.sources import blocks, messages, n5, scratch, service, slices, volume_source
from voxelith.streaming import events


def voxels(spark, array, value="label"):
    return spark.createDataFrame([(*map(int, p), int(array[p])) for p in np.ndindex(array.shape)], f"z long, y long, x long, {value} long")


def dense(df, shape, value="label"):
    out = np.zeros(shape, np.int64)
    for r in df.collect():
        out[r.z, r.y, r.x] = r[value]
    return out


@pytest.fixture(scope="module")
def array():
    return np.random.default_rng(1).integers(0, 9, (6, 8, 10))


@pytest.fixture
def dataset(array, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/attributes.json").write_text(json.dumps({"dimensions": [10, 8, 6], "blockSize": [4, 5, 3], "dataType": "uint64", "compression": {"type": "gzip"}}))
    for bz in range(2):
        for by in range(2):
            for bx in range(3):
                part = array[3 * bz : 3 * bz + 3, 5 * by : 5 * by + 5, 4 * bx : 4 * bx + 4].astype(np.uint64)
                folder = tmp_path / f"d/{bx}/{by}"
                folder.mkdir(parents=True, exist_ok=True)
                (folder / str(bz)).write_bytes(n5.encode_block(part))
    return tmp_path


def test_n5(spark, array, dataset):
    assert (dense(n5.read(spark, f"file://{dataset}/d", "label"), array.shape) == array).all()
    part = n5.read(spark, f"file://{dataset}/d", "label", ((1, 2, 3), (4, 8, 9)))
    assert part.count() == 3 * 6 * 6 and (dense(part, array.shape)[1:4, 2:, 3:9] == array[1:4, 2:, 3:9]).all()


def test_configured_volume(spark, array, dataset):
    labels = dataset / "map.csv"
    labels.write_text("orig,new\n3,30\n4,30\n")
    config = {"n5": {"path": f"file://{dataset}", "dataset": "d"}, "geometry": {"bounding-box": [[0, 0, 0], [10, 8, 6]]}, "apply-labelmap": {"path": f"file://{labels}"}, "transpose": "xyZ"}
    want = np.where(np.isin(array, (3, 4)), 30, array).transpose(2, 1, 0)[:, :, ::-1]
    assert (dense(service.load(spark, config), (10, 8, 6)) == want).all()
    fine = service.load(spark, config | {"scale": 1, "transpose": "zyx"})
    assert fine.count() == 3 * 4 * 5
    assert json.loads(service.dumped(config))["scale"] == 0 and service.resolved({"n5": {"path": "a"}}, "/b")["n5"]["path"] == "/b/a"
    for wrong in ({}, {"n5": {}, "table": {}}, {"n5": {}, "transpose": "zzy"}, {"n5": {}, "geometry": {"bounding-box": [[1, 1, 1], [1, 2, 2]]}}):
        with pytest.raises(ValueError):
            service.checked(wrong)


def test_n5_scales(spark, tmp_path):
    """Each scale is read from its own dataset, and only a scale that there is none of is made."""
    fine, coarse = np.arange(64).reshape(4, 4, 4), np.arange(8).reshape(2, 2, 2) + 1000
    for name, a in (("s0", fine), ("s1", coarse)):
        (tmp_path / f"v/{name}/0/0").mkdir(parents=True)
        (tmp_path / f"v/{name}/attributes.json").write_text(json.dumps({"dimensions": [a.shape[0]] * 3, "blockSize": [4, 4, 4], "dataType": "uint64", "compression": {"type": "raw"}}))
        (tmp_path / f"v/{name}/0/0/0").write_bytes(n5.encode_block(a.astype(np.uint64), "raw"))
    config = {"n5": {"path": f"file://{tmp_path}/v", "dataset": "s0"}, "geometry": {"available-scales": [0, 1], "bounding-box": [[0, 0, 0], [4, 4, 4]]}}
    got = service.load(spark, config | {"scale": 1})
    assert got.count() == 8 and (dense(got, (2, 2, 2)) == coarse).all()
    assert (dense(service.load(spark, config), (4, 4, 4)) == fine).all()
    assert service.load(spark, config | {"scale": 2}).count() == 1
    assert n5.read(spark, f"file://{tmp_path}/v/s0", "label", ((4, 4, 4), (9, 9, 9))).count() == 0
    with pytest.raises(ValueError):
        n5.at_scale("volume", 1)


def test_put_into_blocks(spark, array, tmp_path):
    path, df = f"file://{tmp_path}/b", voxels(spark, array).withColumn("scale", F.lit(0))
    blocks.write(df, path, "label", 2)
    want = array.copy()
    some = np.zeros_like(array)
    some[1:4, 3:5, 2:9] = 77
    want[some == 77] = 77
    blocks.write(voxels(spark, some).where("label = 77").withColumn("scale", F.lit(0)), path, "label", 2, whole_blocks=False)
    read = lambda: dense(blocks.read(spark, path, "label", 0, ((0, 0, 0), array.shape), 2), array.shape)
    assert (read() == want).all()
    want[2:4, 0:2, 0:2] = 0  # the block that is put whole has one voxel
    want[3, 1, 1] = 55
    blocks.write(spark.createDataFrame([(3, 1, 1, 55, 0)], "z long, y long, x long, label long, scale int"), path, "label", 2)
    assert (read() == want).all()


def test_computed_blocks(spark, tmp_path):
    seen = []

    def compute(missing):
        seen.append(missing.count())
        return missing.withColumn("v", F.col("bx") * 2)

    wanted = spark.range(6).select(F.lit(0).cast("long").alias("bz"), F.lit(0).cast("long").alias("by"), F.col("id").alias("bx"))
    path = f"file://{tmp_path}/c"
    assert blocks.computed(wanted.where("bx < 4"), compute, path).count() == 4
    assert {(r.bx, r.v) for r in blocks.computed(wanted.where("bx > 1"), compute, path).collect()} == {(i, 2 * i) for i in range(2, 6)}
    assert seen == [4, 2]


def test_checkpoint(spark, tmp_path):
    one, two = spark.range(3), spark.range(5)
    assert scratch.checkpoint(one, f"file://{tmp_path}/c").count() == 3
    assert scratch.checkpoint(two, f"file://{tmp_path}/c").count() == 3
    assert scratch.checkpoint(two, f"file://{tmp_path}/c", rollback=False).count() == 5


def test_released(spark):
    with scratch.released():
        own = scratch.Scratch(spark, "test")
        path = own.store(spark.range(3))._scratch_path
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def filtered_png(image, kind):
    """A PNG whose rows all have one filter."""
    import zlib

    rows, a = [], image.astype(int)
    for y in range(len(a)):
        line = []
        for x in range(a.shape[1]):
            left, above = (a[y, x - 1] if x else 0), (a[y - 1, x] if y else 0)
            corner = a[y - 1, x - 1] if x and y else 0
            p = left + above - corner
            near = min((abs(p - left), 0, left), (abs(p - above), 1, above), (abs(p - corner), 2, corner))[2]
            line.append((a[y, x] - (0, left, above, (left + above) // 2, near)[kind]) % 256)
        rows.append(bytes([kind, *line]))
    plain = slices.encode_png(image)
    head = plain[: plain.index(b"IDAT") - 4]
    return head + slices._chunk(b"IDAT", zlib.compress(b"".join(rows))) + slices._chunk(b"IEND", b"")


def test_slice_stacks(spark, tmp_path):
    a = np.random.default_rng(4).integers(0, 256, (4, 5, 6))
    for kind in range(5):
        assert (slices.decode(filtered_png(a[0], kind)) == a[0]).all()
    with pytest.raises(ValueError):
        slices.decode(b"GIF89a")
    for suffix in ("png", "pgm"):
        pattern = f"{tmp_path}/z{{:05d}}-{suffix}.{suffix}"
        slices.write_files(voxels(spark, a, "v"), pattern, "v", a.shape)
        assert slices.stack_attributes(spark, pattern) == ((0, 0, 0), (4, 5, 6))
        assert (dense(slices.read_stack(spark, pattern, "v"), a.shape, "v") == a).all()
        assert slices.read_stack(spark, pattern.replace("{:05d}", "%05d"), "v", 1, 3).count() == 2 * 30
    config = {"slice-files": {"path": f"{tmp_path}/z{{:05d}}-png.png"}, "value": "v", "geometry": {"bounding-box": [[0, 0, 1], [6, 5, 3]]}}
    assert service.load(spark, config).count() == 2 * 30
    assert slices.split_pattern("a/%04d.png") == ("a/", "{:04d}", ".png") and slices.split_pattern("a/b") == ("a/b/", "{}", "")
    (tmp_path / "z7-png.png").write_bytes(slices.encode_png(a[0]))
    with pytest.raises(ValueError):
        slices.stack_attributes(spark, f"{tmp_path}/z{{:05d}}-png.png")
    with pytest.raises(Exception):  # noqa: B017
        slices.stack_attributes(spark, f"{tmp_path}/none-{{}}.png")
    assert [r[0] for r in spark.range(0, 200, 50).toDF("z").select(slices.slab("z", 64, 10)).collect()] == [-1, 0, 1, 2]


def test_messages(spark):
    mapping = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (5, 4), (9, 9)], "label long, body long")
    sent = messages.merges(mapping)
    assert {(r.target, tuple(r.merged)) for r in sent.collect()} == {(1, (2, 3)), (4, (5,))}
    assert sum(len(r.merged) for r in messages.merges(mapping, 1).collect()) == 3
    back = messages.read(messages.write(sent, "merge"), "merge")
    assert {tuple(r) for r in messages.merged_labels(back).collect()} == {(2, 1), (3, 1), (5, 4)}
    split = spark.createDataFrame([(1, 2, 3, True, b"\x00\xff")], messages.SCHEMAS["split"])
    assert messages.read(messages.write(split, "split"), "split").collect() == split.collect()
    table = {r.label: (r.labels, [round(a, 3) for a in r.affinities]) for r in messages.affinity_table(spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.25)], messages.SCHEMAS["affinity"])).collect()}
    assert table == {1: ([2, 3], [0.5, 0.25]), 2: ([1], [0.5]), 3: ([1], [0.25])}


def test_data_source(spark):
    volume_source.register(spark)
    df = spark.read.format("voxelith").option("shape", "5,6,7").option("block", "4").option("period", "3").load()
    got = dense(df, (5, 6, 7))
    assert df.count() == 5 * 6 * 7 and (got[:, :, 2] == 0).all() and got[4, 5, 6] == 8 and got[0, 0, 0] == 1


def test_volume_source_puts_small_blocks_together():
    reader = volume_source.GridReader({"shape": "416,416,416", "block": "10"})
    parts = reader.partitions()
    assert len(parts) < 300 and parts[0].start == 0 and parts[-1].stop == 42**3
    assert all(a.stop == b.start for a, b in zip(parts, parts[1:], strict=False))


def test_tiles(spark, array):
    got = {(r.plane, r.slice, r.row, r.col): slices.decode(r.image) for r in tiles.cut(voxels(spark, array), "label", 4).collect()}
    assert len([k for k in got if k[0] == "xy"]) == 6 * 2 * 3
    assert (got["xy", 2, 1, 0] == array[2, 4:8, 0:4]).all() and (got["yz", 9, 0, 1] == array[0:4, 4:8, 9]).all()
    assert (got["xz", 7, 1, 2][:2, :2] == array[4:6, 7, 8:10]).all() and not got["xz", 7, 1, 2][2:].any()
    coarse = [r for r in tiles.pyramid(voxels(spark, array), "label", 4, 2, ("xy",)).collect() if r.level == 1]
    assert len(coarse) == 6 * 1 * 2
    one = next(slices.decode(r.image) for r in coarse if (r.slice, r.row, r.col) == (5, 0, 0))
    assert one[1, 2] == int(array[5, 2:4, 4:6].mean())


def test_copy_and_ingest(spark, array):
    df = voxels(spark, array)
    out = workflows.copy_segmentation(df, "label", 4, (0, 0, 0), None, df.where("z < 4"), 1)
    assert out["voxels"].where("scale = 0").count() == array.size
    assert {r.bz for r in out["runs"].collect()} == {1}  # the first blocks are stored already
    packed = workflows.ingest_grayscale(df, "label", 4)["blocks"]
    assert packed.count() == 2 * 2 * 3 and (dense(blocks.unpack(packed, "label").where("z < 6 AND y < 8 AND x < 10"), array.shape) == array).all()
    stats = out["block_stats"]
    mapping = spark.createDataFrame([(2, 1)], "label long, body long")
    indexed = workflows.ingest_label_indices(stats, mapping, 4, 5)
    assert {r.body for r in indexed["index"].collect()} == {1, 3, 4, 5, 6, 7, 8}
    assert indexed["batches"].agg(F.max("batch")).first()[0] >= 1 and set(workflows.ingest_label_indices(stats, mapping, 4, 5, "only")) == {"tombstones", "mappings"}
    errors = workflows.check_segmentation(df, "label", spark.createDataFrame([], "body long, bz long, by long, bx long"), 4)["errors"]
    assert errors.count() == errors.where("missing").count() > 0
    assert workflows.export_slices(df, "label", array.shape)["slices"].count() == 6
    assert workflows.create_pyramid(df, "label", array.shape, depth=2)["voxels"].where("scale = 2").count() == 2 * 2 * 3
    assert len(workflows.WORKFLOWS) == 19


def test_evaluate(spark, array):
    df = voxels(spark, array, "gt").withColumn("seg", (F.col("gt") + (F.col("x") > 7).cast("long")) % 9)
    pts = spark.createDataFrame([(i, i % 8 + 1, i % 7 + 1) for i in range(40)], "point_id long, gt long, seg long")
    pairs = spark.createDataFrame([(i, i + 1) for i in range(39)], "pre long, post long")
    out = workflows.evaluate_segmentation(df, array.shape, 4, 10, pts, pairs)
    for name, frame in out.items():
        assert frame.count() >= (0 if name in ("orphans", "best", "connectivity") else 1), name
    same = workflows.evaluate_segmentation(df.withColumn("seg", F.col("gt")), array.shape, 4, 0)
    assert tuple(same["vi"].first()) == (0.0, 0.0, 0.0) and same["rand"].first().rand == 1.0 and same["edits"].count() == 0


def test_segmentation_across_blocks(spark):
    wall = np.zeros((4, 4, 16))
    wall[:, :, 5] = 1
    df = voxels(spark, (wall * 100).astype(int), "v")
    out = workflows.create_segmentation(df, "v", 8, [("seeded-watershed", {"threshold": 50.0})], "simple", 1)
    label = dense(out["voxels"], wall.shape)
    assert len(np.unique(label[:, :, 6:])) == 1 and len(np.unique(label[:, :, :5])) == 1 and label[0, 0, 0] != label[0, 0, 15]


@pytest.mark.parametrize("pixels", [1, 48, 1 << 17])
def test_tiles_made_together(spark, array, monkeypatch, pixels):
    monkeypatch.setattr(tiles, "LOT_PIXELS", pixels)
    got = {(r.plane, r.slice, r.row, r.col): slices.decode(r.image) for r in tiles.cut(voxels(spark, array), "label", 4, ("xy", "yz")).collect()}
    assert len(got) == 6 * 2 * 3 + 10 * 2 * 2
    assert all((got["xy", z, 1, 0] == array[z, 4:8, :4]).all() for z in range(6)) and all((got["yz", x, 0, 1] == array[:4, 4:8, x]).all() for x in range(10))


def test_segmentation_of_blocks_below_zero(spark):
    wall = np.zeros((4, 4, 24))
    wall[:, :, 13] = 1
    df = voxels(spark, (wall * 100).astype(int), "v").withColumns({"x": F.col("x") - 16, "y": F.col("y") - 2})
    out = workflows.create_segmentation(df, "v", 8, [("seeded-watershed", {"threshold": 50.0})], "simple", 1)
    found = out["voxels"].where("x <> -3").groupBy((F.col("x") > -3).alias("right")).agg(F.count_distinct("label").alias("n"), F.min("label").alias("label")).collect()
    assert [r["n"] for r in found] == [1, 1] and len({r["label"] for r in found}) == 2


def test_streams(spark, tmp_path):
    parts = [[(1, 0, 0, 0, 5)], [(1, 0, 0, 0, 2), (2, 0, 0, 8, 1)]]
    schema = "segment_id long, z long, y long, x long, count long"
    for i, rows in enumerate(parts):
        frame = spark.createDataFrame(rows, schema)
        for _ in range(2):  # a batch that runs again counts once
            events.merge_block_stats(frame, i, f"file://{tmp_path}/stats")
    got = {tuple(r) for r in events.block_stats(spark, f"file://{tmp_path}/stats").collect()}
    assert got == {(1, 0, 0, 0, 7), (2, 0, 0, 8, 1)}
    for i, rows in enumerate([[("a", 1.0), ("b", 2.0)], [("a", 4.0)]]):
        spark.createDataFrame(rows, "k string, v double").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    stream = events.read_stream(spark, f"file://{tmp_path}/in", "k string, v double")
    out = events.finish(events.running_totals(stream, "k", "v"), f"file://{tmp_path}/ckpt", f"file://{tmp_path}/out", ("k",))
    assert {r.k: (r.n, r.total) for r in out.collect()} == {"a": (2, 5.0), "b": (1, 2.0)}


def test_late_rows_are_dropped(spark, tmp_path):
    """A row of a window that the watermark has passed doesn't count; one within it does. Running again changes nothing."""
    schema = "ts timestamp, k string, value double"
    for t, v in (("2024-01-01 00:10:00", 1.0), ("2024-01-01 09:00:00", 2.0), ("2024-01-01 08:30:00", 4.0), ("2024-01-01 00:20:00", 8.0)):
        spark.sql(f"SELECT TIMESTAMP '{t}' AS ts, 'a' AS k, {v}D AS value").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        time.sleep(0.05)
    for _ in range(2):
        counts = events.windowed_counts(events.read_stream(spark, f"file://{tmp_path}/in", schema), "ts", "k", "1 hour", "2 hours")
        out = events.finish(counts, f"file://{tmp_path}/ckpt", f"file://{tmp_path}/out", ("start", "k"))
        assert sorted((r.start.hour, r.n, r.total) for r in out.collect()) == [(0, 1, 1.0), (8, 1, 4.0), (9, 1, 2.0)]
