"""N5 and slices as data sources: round trips, pushed boxes, and writes that leave all files or none."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual

from voxelith.sources import chunked, n5


def rows(a: np.ndarray) -> list[tuple]:
    return [(*map(int, p), int(a[p])) for p in np.ndindex(*a.shape)]


@pytest.fixture(scope="module")
def dataset(spark, tmp_path_factory):
    a = np.random.default_rng(0).integers(1, 2**40, (10, 13, 21))
    a[:, :, 8:16] = 0
    where = f"file://{tmp_path_factory.mktemp('n5')}/seg/s0"
    df = spark.createDataFrame([r for r in rows(a) if r[3]], "z long, y long, x long, label long")
    chunked.write_n5(df, where, "label", a.shape, block=8)
    return where, a


def test_round_trip(spark, dataset):
    where, a = dataset
    path = where.removeprefix("file://")
    # blocks without any voxel are no files, and nothing is left of what was pending
    assert sorted(os.listdir(path)) == ["0", "2", "attributes.json"]
    for df in (spark.read.format("voxelith-n5").load(where), n5.read(spark, where, "label")):
        assert sorted(map(tuple, df.where("label <> 0").collect())) == [r for r in rows(a) if r[3]]


def test_box_is_pushed(spark, dataset):
    where, a = dataset
    df = spark.read.format("voxelith-n5").option("perPartition", 1).option("value", "v").load(where)
    assert df.rdd.getNumPartitions() == 2 * 2 * 3
    box = df.where("z >= 3 AND z < 8 AND y = 9 AND x > 15 AND v % 2 = 0")
    assert box.rdd.getNumPartitions() == 1
    assert sorted(map(tuple, box.collect())) == [r for r in rows(a) if 3 <= r[0] < 8 and r[1] == 9 and r[2] > 15 and r[3] % 2 == 0]
    assert df.where("z > 50").count() == df.where("z > 5 AND z < 2").count() == 0
    # what isn't a comparison with a number stays Spark's
    either = df.where("z IN (1, 2) AND (y = 1 OR x = 20)")
    assert sorted(map(tuple, either.collect())) == [r for r in rows(a) if r[0] in (1, 2) and (r[1] == 1 or r[2] == 20) and not 8 <= r[2] < 16]


def test_reader_takes_the_box(dataset):
    where, _ = dataset
    reader = chunked.N5Reader({"path": where})
    kept = [In(("z",), (1, 2)), GreaterThan(("label",), 3), LessThan(("x",), None)]
    assert list(reader.pushFilters([GreaterThanOrEqual(("z",), 8), LessThanOrEqual(("y",), 7), EqualTo(("x",), 17), *kept])) == kept
    assert (reader.low, reader.high) == ([8, 0, 17], [10, 8, 18]) and reader.grid() == [range(1, 2), range(0, 1), range(2, 3)]
    assert [(r.start, r.stop) for r in reader.partitions()] == [(0, 1)]


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    a = np.arange(1, 1 + 16**3).reshape(16, 16, 16)
    df = spark.createDataFrame(rows(a), "z long, y long, x long, label long")
    wrong = df.withColumn("label", F.when((F.col("z") == 15) & (F.col("x") == 15), F.raise_error(F.lit("no such voxel")).cast("long")).otherwise(F.col("label")))
    with pytest.raises(Exception, match="no such voxel"):
        chunked.write_n5(wrong, f"file://{tmp_path}/d", "label", a.shape, block=8)
    assert not [f for _, _, names in os.walk(tmp_path) for f in names]
    writer = chunked.FilesWriter({"path": f"file://{tmp_path}/e"})
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"name": ["1/2/3", "top"], "content": [b"a", b"b"]})
    first, again = writer.write(iter([batch])), writer.write(iter([batch]))  # a task that ran twice
    assert first.folder != again.folder
    writer.commit([again, None])
    assert sorted(os.listdir(tmp_path / "e")) == ["1", "top"] and (tmp_path / "e/1/2/3").read_bytes() == b"a"
    writer = chunked.FilesWriter({"path": f"file://{tmp_path}/g"})
    writer.write(iter([batch]))
    writer.abort([None])
    assert not [f for _, _, names in os.walk(tmp_path / "g") for f in names]


@pytest.mark.parametrize("name", ["z{:04d}.png", "slice-%03d.pgm"])
def test_slices(spark, tmp_path, name):
    a = np.random.default_rng(1).integers(0, 256, (6, 5, 7))
    chunked.write_slices(spark.createDataFrame(rows(a), "z long, y long, x long, v long"), f"{tmp_path}/s/{name}", "v", a.shape)
    df = spark.read.format("voxelith-slices").option("value", "v").option("perPartition", 1).load(f"{tmp_path}/s/{name}")
    assert df.rdd.getNumPartitions() == 6 and sorted(map(tuple, df.collect())) == rows(a)
    box = df.where("z BETWEEN 2 AND 3 AND x < 4")
    assert box.rdd.getNumPartitions() == 2 and sorted(map(tuple, box.collect())) == [r for r in rows(a) if 2 <= r[0] <= 3 and r[2] < 4]
    assert df.where("z > 9").count() == 0
