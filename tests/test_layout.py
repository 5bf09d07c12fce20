"""Partitions of about a size, blocks of chosen bodies, and archives of bounded size."""

from __future__ import annotations

import io
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from voxelith.functions.grid import Grid
from voxelith.operators import layout
from voxelith.sources import blocks


def interleaved(z: int, y: int, x: int) -> int:
    return sum(((v >> k) & 1) << (3 * k + a) for a, v in enumerate((x, y, z)) for k in range(21))


def test_morton(spark):
    rnd = random.Random(1)
    at = [(0, 0, 0), ((1 << 21) - 1,) * 3, *[tuple(rnd.randrange(1 << 21) for _ in range(3)) for _ in range(100)]]
    got = [r[0] for r in spark.createDataFrame(at, "bz long, by long, bx long").coalesce(1).select(layout.morton()).collect()]
    assert got == [interleaved(*p) for p in at]


def test_balanced(spark):
    rnd = random.Random(2)
    cells = {(rnd.randrange(32), rnd.randrange(32), rnd.randrange(32)) for _ in range(1500)} | {(z, y, x) for z in range(9) for y in range(9) for x in range(9)}  # a corner holds most
    df = spark.createDataFrame([(*c, 1) for c in sorted(cells)], "z long, y long, x long, v long")
    out, count = layout.balanced(df, 4, 150)
    assert out.rdd.getNumPartitions() == count
    rows = out.withColumn("p", F.spark_partition_id()).collect()
    assert {(r.z, r.y, r.x) for r in rows} == cells and all(r.p == r.part for r in rows)
    sizes, whole = {}, {}
    for r in rows:
        sizes[r.part] = sizes.get(r.part, 0) + 1
        whole.setdefault((r.bz, r.by, r.bx), set()).add(r.part)
    assert max(sizes.values()) < 150 + 64 and min(v for k, v in sizes.items() if k != count - 1) > 150 - 64 and all(len(p) == 1 for p in whole.values())
    order = sorted(whole, key=lambda b: interleaved(*b))
    assert [min(whole[b]) for b in order] == sorted(min(whole[b]) for b in order)
    part, n = layout.balanced(df, 4, 150, ((0, 0, 0), (4, 4, 4)))
    assert n == 1 and part.count() == 64
    assert layout.balanced(df.where("false"), 4, 150)[1] == 0


def test_bodies_of_a_store(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(blocks, "SLAB", 1)
    rnd = random.Random(3)
    voxels = [(z, y, x, 1 + z // 8 if rnd.random() < 0.9 else 9) for z in range(32) for y in range(8) for x in range(8) if rnd.random() < 0.4]
    df = spark.createDataFrame(voxels, "z long, y long, x long, label long")
    path = f"file://{tmp_path}/store"
    blocks.write(df.withColumn("scale", F.lit(0)), path, "label", 4)
    layout.write_index(layout.body_index(df, "label", 4), f"file://{tmp_path}/index")
    index = spark.read.parquet(f"file://{tmp_path}/index")
    of = lambda *b: spark.createDataFrame([(i,) for i in b], "body long")
    for chosen in ((2,), (1, 4), (9,), (77,), (3, 77)):
        found = layout.read_bodies(spark, path, index, of(*chosen), "label")
        assert sorted(map(tuple, found.collect())) == sorted((v, z, y, x) for z, y, x, v in voxels if v in chosen)
    read = lambda *b: len(layout.read_bodies(spark, path, index, of(*b), "label").inputFiles())
    scans = lambda *b: layout.read_bodies(spark, path, index, of(*b), "label")._jdf.queryExecution().executedPlan().toString()
    assert "slab" in scans(2).split("PartitionFilters")[1].split("]")[0] and read(2) <= read(9)
    mask, box = layout.union_mask(index, of(2, 77))
    assert box[0][0] == 2 and box[1][0] == 4 and {r.bz for r in mask.collect()} == {2, 3}
    assert layout.union_mask(index, of(77))[1] is None
    cells = {(z // 5, (y + 1) // 3, x // 4) for bz, by, bx in {(z // 4, y // 4, x // 4) for z, y, x, v in voxels if v == 2} for z in range(4 * bz, 4 * bz + 4) for y in range(4 * by, 4 * by + 4) for x in range(4 * bx, 4 * bx + 4)}
    got = layout.sparse_boxes(index, of(2), 4, Grid((5, 3, 4), (0, -1, 0)))
    assert {tuple(r) for r in got.collect()} == cells


@pytest.mark.parametrize("limit", [4_000, 1 << 30])
def test_archives(spark, limit):
    rnd = random.Random(4)
    files = [(g, f"{g}-{i}.obj", rnd.randbytes(rnd.randrange(0, 900))) for g in (1, 2) for i in range(5 if g == 2 else 120)] + [(3, "empty", None)]
    out = layout.archives(spark.createDataFrame(files, "group long, name string, content binary").repartition(3), limit).collect()
    found = {}
    for r in out:
        group, part, _ = r.name.split(".")
        with tarfile.open(fileobj=io.BytesIO(r.content)) as tar:
            own = tar.getmembers()
            assert sum(512 + -(-m.size // 512) * 512 for m in own) < limit + 1_600
            for m in own:
                assert (int(group), m.name) not in found
                found[int(group), m.name] = tar.extractfile(m).read()
    assert found == {(g, n): c or b"" for g, n, c in files}
    assert len(out) == len({r.name for r in out}) and (len(out) == 3 if limit > 4_000 else len(out) > 15)


def test_archives_have_partitions_for_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(layout, "BYTES_PER_PARTITION", 20_000, raising=False)
    files = [(g, f"{g}-{i}", b"x" * 1_000) for g in (1, 2) for i in range(150)]
    out = layout.archives(spark.createDataFrame(files, "group long, name string, content binary"), 6_000)
    # 1,536 bytes a file, 460,800 in all
    assert out._jdf.queryExecution().executedPlan().toString().count(", 24), REPARTITION_BY_NUM") == 2
    assert out.rdd.getNumPartitions() == 24
    assert layout.archives(spark.createDataFrame([], "group long, name string, content binary"), 6_000).count() == 0
