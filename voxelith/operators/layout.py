"""How volumes and files are laid out for tasks: blocks along a Morton curve in partitions of about a size, blocks of chosen bodies alone, and archives of bounded size."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxelith.functions.grid import AXES, Grid, cells, inside
from voxelith.functions.numbers import running
from voxelith.operators.volume import block_statistics
from voxelith.sources import blocks
from voxelith.sources.scratch import Scratch

#: Bits of a block's coordinate in its place on the curve.
BITS = 21
#: Wanted slabs of a store, whose numbers become a filter.
SLABS = 10_000
#: Bytes of files in one partition, about, where archives are made.
BYTES_PER_PARTITION = 128 << 20


def _spread(c: Column) -> Column:
    """Its bits, two free ones before each."""
    out = c.cast("long").bitwiseAND((1 << BITS) - 1)
    for width in (32, 16, 8, 4, 2):  # halves of what is together move apart
        mask = sum(((1 << width // 2) - 1) << (3 * (width // 2) * k) for k in range(2 * BITS // width + 2)) & ((1 << 63) - 1)
        out = out.bitwiseOR(F.shiftleft(out, width)).bitwiseAND(mask)
    return out


def morton(bz: Column | str = "bz", by: Column | str = "by", bx: Column | str = "bx") -> Column:
    """The place of a block on a Z-order curve: near places are near in all three axes. Coordinates are 0 or more, and of 21 bits."""
    z, y, x = (_spread(F.col(c) if isinstance(c, str) else c) for c in (bz, by, bx))
    return F.shiftleft(z, 2).bitwiseOR(F.shiftleft(y, 1)).bitwiseOR(x)


def balanced(df: DataFrame, block: int, target: int, box: tuple | None = None) -> tuple[DataFrame, int]:
    """(df with bz, by, bx and part, number of parts): blocks in Morton order, so many to a part that it has about `target` voxels.

    A part has less than target plus its last block's voxels, however skewed the volume is. Blocks are counted first, the
    running sum goes over ranges of the curve, and each part is one partition. With a box only what is in it.
    """
    own = (df if box is None else df.where(inside(box))).select("*", *cells(Grid((block,) * 3)))
    counts = own.groupBy("bz", "by", "bx").agg(F.count("*").alias("_n")).withColumn("_place", morton())
    scratch = Scratch(df.sparkSession, "parts")
    parts = scratch.store(running(counts, "_place", "_n", "_before").select("bz", "by", "bx", F.floor(F.col("_before") / target).cast("long").alias("part")))
    last = parts.agg(F.max("part")).first()[0]
    count = 0 if last is None else last + 1
    return own.join(parts, ["bz", "by", "bx"]).repartitionById(max(1, count), F.col("part").cast("int")), count


def body_index(df: DataFrame, value: str, block: int, scale: int = 0) -> DataFrame:
    """(body, scale, slab, bz, by, bx, n): the blocks of a store that each body has voxels in."""
    own = block_statistics(df, value, block)
    at = [F.floor(F.col(a) / block).cast("long").alias(f"b{a}") for a in AXES]
    return own.select(F.col("segment_id").alias("body"), F.lit(scale).alias("scale"), F.floor(F.col("z") / (block * blocks.SLAB)).cast("long").alias("slab"), *at, F.col("count").alias("n"))


def write_index(index: DataFrame, path: str) -> None:
    """Sorted by body, so a body's rows are in few row groups."""
    index.repartitionByRange("body").sortWithinPartitions("body", "bz", "by", "bx").write.mode("overwrite").parquet(path)


def union_mask(index: DataFrame, bodies: DataFrame) -> tuple[DataFrame, tuple | None]:
    """(blocks (bz, by, bx) of any of the bodies (body), their box in blocks with its stop exclusive); bodies that are nowhere are passed over, and the box is None if all are."""
    mask = index.join(bodies.select("body").distinct(), "body", "left_semi").select("bz", "by", "bx").distinct()
    ends = mask.agg(*[F.min(f"b{a}") for a in AXES], *[F.max(f"b{a}") + 1 for a in AXES]).first()
    return mask, None if ends[0] is None else (tuple(ends[:3]), tuple(ends[3:]))


def sparse_boxes(index: DataFrame, bodies: DataFrame, block: int, grid: Grid) -> DataFrame:
    """(bz, by, bx): cells of a grid that meet a block of any of the bodies; a block meets several where cells are smaller or lie across it."""
    mask, _ = union_mask(index, bodies)
    for a in AXES:
        size, origin = grid.size(a), grid.origin(a)
        first, last = (F.floor((F.col(f"b{a}") * block + end - origin) / size).cast("long") for end in (0, block - 1))
        mask = mask.withColumn(f"b{a}", F.explode(F.sequence(first, last)))
    return mask.distinct()


def read_bodies(spark: SparkSession, path: str, index: DataFrame, bodies: DataFrame, value: str) -> DataFrame:
    """(body, z, y, x): the voxels of chosen bodies (body), from those blocks of a store alone that the index has for them.

    The slabs of those blocks, few as a slab has many planes, become a filter that leaves other slabs' files unread; in
    them blocks are found by a join.
    """
    chosen = bodies.select("body").distinct()
    wanted = Scratch(spark, "wanted").store(index.join(chosen, "body", "left_semi").select("scale", "slab", "bz", "by", "bx").distinct())
    slabs = wanted.select("scale", "slab").distinct().limit(SLABS + 1).collect()
    store = spark.read.parquet(path)
    if len(slabs) <= SLABS:  # more of them are found by the join alone
        store = store.where(F.col("scale").isin(sorted({r["scale"] for r in slabs})) & F.col("slab").isin(sorted({r["slab"] for r in slabs})))
    found = blocks.unpack(store.join(wanted, ["scale", "slab", "bz", "by", "bx"], "left_semi").select("scale", "bz", "by", "bx", "size", "data"), value)
    return found.join(chosen.withColumnRenamed("body", value), value, "left_semi").select(F.col(value).alias("body"), *AXES)


def archives(files: DataFrame, limit: int, shards: int = 4096) -> DataFrame:
    """(name, content): tar archives `<group>.<number>.tar` of files (group, name, content), each of about `limit` bytes.

    A group's files go in the order of a hash of their names, and begin a new archive where the last one is full: one has
    less than limit plus its last file. Sums by ranges of the hash come first, so no group is gathered; a task streams
    the files of its archives, one archive at a time. There are partitions for all bytes, as a task sorts its files.
    """
    # of a file: a header, and whole records of 512 bytes
    sized = files.select("group", "name", "content", (512 + F.ceil(F.octet_length("content") / 512.0) * 512).cast("long").alias("_size"), F.md5("name").alias("_h"))
    sized = sized.withColumn("_range", F.pmod(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long"), F.lit(shards)))
    key = ["group", "_range"]
    over = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sums = Scratch(files.sparkSession, "archives").store(sized.groupBy(*key).agg(F.sum("_size").alias("_n")))
    wanted = -(-(sums.agg(F.sum("_n")).first()[0] or 0) // BYTES_PER_PARTITION)
    parts = max(wanted, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    starts = sums.withColumn("_start", F.coalesce(F.sum("_n").over(over("group").orderBy("_range")), F.lit(0))).drop("_n")
    inner = F.coalesce(F.sum("_size").over(over(*key).orderBy("_h", "name")), F.lit(0))
    placed = sized.repartition(parts, *key).withColumn("_inner", inner).join(starts, key).withColumn("_part", F.floor((F.col("_start") + F.col("_inner")) / limit).cast("long"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, raw, tar = None, io.BytesIO(), None

        def closed() -> Iterator[pa.RecordBatch]:
            if now is not None:
                tar.close()
                yield pa.RecordBatch.from_arrays([pa.array([f"{now[0]}.{now[1]}.tar"]), pa.array([raw.getvalue()], pa.binary())], names=["name", "content"])

        for batch in batches:
            for group, part, name, content in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if (group, part) != now:
                    yield from closed()
                    now, raw = (group, part), io.BytesIO()
                    tar = tarfile.open(fileobj=raw, mode="w")  # noqa: SIM115
                about = tarfile.TarInfo(name)
                about.size = len(content)
                tar.addfile(about, io.BytesIO(content))
        yield from closed()

    ordered = placed.select(F.col("group").cast("string").alias("group"), "_part", "name", F.coalesce("content", F.lit(b"")).alias("content")).repartition(parts, "group", "_part").sortWithinPartitions("group", "_part", "name")
    return ordered.mapInArrow(stream, "name string, content binary")
