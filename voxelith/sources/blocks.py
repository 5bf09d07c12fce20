"""A block store: dense blocks of a volume as binary rows, by scale and slab, found by their block coordinates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelith.functions.grid import AXES, Grid, cells, inside
from voxelith.sources.scratch import Scratch, released

SCHEMA = "scale int, bz long, by long, bx long, size int, data binary"


def pack(df: DataFrame, value: str, size: int) -> DataFrame:
    """(scale, bz, by, bx, size, data): size^3 longs of each block that has a voxel, row by row; voxels it lacks are 0."""
    keyed = df.select("scale", *cells(Grid((size,) * 3)), *AXES, F.col(value).cast("long").alias("_v"))

    def run(key: tuple, t: pa.Table) -> pa.Table:
        scale, bz, by, bx = (k.as_py() for k in key)
        dense = np.zeros((size,) * 3, "<i8")
        at = tuple(t.column(a).to_numpy() - b * size for a, b in zip(AXES, (bz, by, bx), strict=True))
        dense[at] = t.column("_v").to_numpy()
        return pa.table({"scale": pa.array([scale], pa.int32()), "bz": [bz], "by": [by], "bx": [bx], "size": pa.array([size], pa.int32()), "data": pa.array([dense.tobytes()], pa.binary())})

    return keyed.groupBy("scale", "bz", "by", "bx").applyInArrow(run, SCHEMA)


def unpack(blocks: DataFrame, value: str) -> DataFrame:
    """(scale, z, y, x, value) of every voxel of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n = r["size"]
                z, y, x = np.indices((n, n, n)).reshape(3, -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n**3, r["scale"], np.int32)), pa.array(z + r["bz"] * n), pa.array(y + r["by"] * n), pa.array(x + r["bx"] * n), pa.array(np.frombuffer(r["data"], "<i8"))],
                    names=["scale", *AXES, value],
                )

    return blocks.mapInArrow(run, f"scale int, z long, y long, x long, {value} long")


#: Blocks along z that are rewritten together.
SLAB = 16


def _stored(spark: SparkSession, path: str, packed: DataFrame) -> DataFrame | None:
    """The store's blocks in the slabs that packed touches, or None without a store."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return None
    return spark.read.parquet(path).join(packed.select("scale", "slab").distinct(), ["scale", "slab"], "left_semi")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(..., old, new, mask): new samples where the mask is set, else the old ones."""
    for batch in batches:
        data = []
        for old, new, mask in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("old", "new", "mask")), strict=True):
            if old is None or new is None:
                data.append(old if new is None else new)
            else:
                put = np.unpackbits(np.frombuffer(mask, np.uint8), count=len(new) // 8).astype(bool)
                data.append(np.where(put, np.frombuffer(new, "<i8"), np.frombuffer(old, "<i8")).tobytes())
        yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in ("scale", "bz", "by", "bx", "size", "slab")), pa.array(data, pa.binary())], names=["scale", "bz", "by", "bx", "size", "slab", "data"])


def write(df: DataFrame, path: str, value: str, size: int, whole_blocks: bool = True) -> None:
    """Puts the voxels of df into the store; what it has besides stays.

    A box that begins and ends with blocks replaces each block that it has whole; otherwise (whole_blocks false) only the
    voxels of df change. Slabs of blocks that df touches are written anew and replace the old ones at once, so a box
    costs its slabs, and a write that is lost changes nothing. Sorted by block, so a box reads few row groups.
    """
    spark = df.sparkSession
    packed = pack(df, value, size).withColumn("slab", F.floor(F.col("bz") / SLAB).cast("long"))
    scratch = Scratch(spark, "blocks")
    packed = scratch.store(packed)
    old = _stored(spark, path, packed)
    key = ["scale", "bz", "by", "bx"]
    if old is not None:
        if whole_blocks:
            packed = old.join(packed.select(*key), key, "left_anti").select(*packed.columns).union(packed)
        else:
            mask = pack(df.withColumn("_one", F.lit(1)), "_one", size).select(*key, F.col("data").alias("mask"))
            bits = mask.mapInArrow(_bits, "scale int, bz long, by long, bx long, mask binary")
            joined = old.select(*key, "size", "slab", F.col("data").alias("old")).join(packed.select(*key, F.col("size").alias("_s"), F.col("slab").alias("_l"), F.col("data").alias("new")).join(bits, key), key, "full_outer")
            both = joined.select(*key, F.coalesce("size", "_s").alias("size"), F.coalesce("slab", "_l").alias("slab"), "old", "new", "mask")
            packed = both.mapInArrow(_merge, "scale int, bz long, by long, bx long, size int, slab long, data binary")
        packed = scratch.store(packed)  # what is replaced is read before it is
    ordered = packed.repartitionByRange(*key).sortWithinPartitions(*key)
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("scale", "slab").parquet(path)
    scratch.clear()


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [np.packbits(np.frombuffer(m, "<i8") > 0).tobytes() for m in batch.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(packed, pa.binary())], names=[*batch.schema.names[:4], "mask"])


def computed(wanted: DataFrame, compute: Callable[[DataFrame], DataFrame], path: str, keys: tuple[str, ...] = ("bz", "by", "bx")) -> DataFrame:
    """compute() of the blocks (keys) of wanted that the table at path lacks is appended to it; gives the table's rows of all wanted ones.

    compute: of a frame of keys, a frame with those keys and its results, at least one row a block. A run that is lost
    goes on where it was, as a block is there whole or not at all.
    """
    spark = wanted.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    own = wanted.select(*keys).distinct()
    missing = own.join(spark.read.parquet(path).select(*keys).distinct(), list(keys), "left_anti") if there else own
    with released():
        compute(Scratch(spark, "missing").store(missing)).write.mode("append").parquet(path)
    return spark.read.parquet(path).join(own, list(keys), "left_semi")


def read(spark: SparkSession, path: str, value: str, scale: int, box: tuple, size: int) -> DataFrame:
    """(z, y, x, value) of a box: the blocks that meet it by filters on the scan, then cut to it."""
    (z0, y0, x0), (z1, y1, x1) = box
    ok = (F.col("scale") == scale) & F.col("slab").between(z0 // size // SLAB, (z1 - 1) // size // SLAB)
    for a, lo, hi in (("bz", z0, z1), ("by", y0, y1), ("bx", x0, x1)):
        ok = ok & F.col(a).between(lo // size, (hi - 1) // size)
    return unpack(spark.read.parquet(path).where(ok).select("scale", "bz", "by", "bx", "size", "data"), value).where(inside(box)).drop("scale")
