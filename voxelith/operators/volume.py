"""Grid operators on voxel relations (z, y, x, value columns): retiling, halos, masks, relabeling, scaling, pyramids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelith.functions.grid import AXES, Grid, cell, cells, inside
from voxelith.sources.scratch import Scratch

COORDS = ["z", "y", "x"]


def retile(df: DataFrame, grid: Grid) -> DataFrame:
    """With the cell (bz, by, bx) of each voxel."""
    return df.select("*", *cells(grid))


def retile_with_halo(df: DataFrame, grid: Grid, halo: int) -> DataFrame:
    """Each voxel in its own cell and in those whose halo it lies in; cells that would have nothing but halo are left out.

    A voxel meets at most two cells on an axis (halo < cell), found by arithmetic, so it is one generator and no join.
    """
    out = df
    for a in AXES:
        size, origin = grid.size(a), grid.origin(a)
        own = cell(a, size, origin)
        out = out.withColumn("b" + a, F.explode(F.array_distinct(F.array(own, cell(F.col(a) - halo, size, origin), cell(F.col(a) + halo, size, origin)))))
    is_own = F.lit(True)
    for a in AXES:
        is_own = is_own & (F.col("b" + a) == cell(a, grid.size(a), grid.origin(a)))
    owned = df.select(*cells(grid)).distinct()
    return out.withColumn("in_halo", ~is_own).join(owned, ["bz", "by", "bx"], "left_semi")


def without_halo(df: DataFrame) -> DataFrame:
    return df.where("NOT in_halo").drop("in_halo")


def fill_missing(df: DataFrame, store: DataFrame, value: str) -> DataFrame:
    """Own voxels, and those of the store where there is none."""
    other = store.select(*COORDS, F.col(value).alias("_stored"))
    return df.join(other, COORDS, "full_outer").withColumn(value, F.coalesce(value, "_stored")).drop("_stored")


def mask_fill(df: DataFrame, store: DataFrame, value: str) -> DataFrame:
    """Own voxels, those of value 0 taken from the store."""
    other = store.select(*COORDS, F.col(value).alias("_stored"))
    return df.join(other, COORDS, "left").withColumn(value, F.when(F.col(value) == 0, F.coalesce("_stored", value)).otherwise(F.col(value))).drop("_stored")


def relabel(df: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """mapping: (label, body); labels without a body stay. Spark broadcasts the mapping where it is small."""
    side = mapping.select(F.col("label").alias(column), F.col("body").alias("_body"))
    return df.join(side, column, "left").withColumn(column, F.coalesce("_body", column)).drop("_body")


def translate(df: DataFrame, offset: tuple[int, int, int]) -> DataFrame:
    return df.withColumns({a: F.col(a) + d for a, d in zip(AXES, offset, strict=True)})


def clip(df: DataFrame, box: tuple) -> DataFrame:
    return df.where(inside(box))


def transpose(df: DataFrame, order: str, shape: tuple[int, int, int]) -> DataFrame:
    """order: three of zyx and ZYX for the new z, y, x; a capital is that axis inverted. shape: of the volume as it is."""
    size = dict(zip(AXES, shape, strict=True))
    source = {new: (F.lit(size[old.lower()] - 1) - F.col(old.lower()) if old.isupper() else F.col(old)) for new, old in zip(AXES, order, strict=True)}
    return df.withColumns(source)


def downsample_mode(df: DataFrame, factor: int, value: str, suppress_zero: bool = False) -> DataFrame:
    """The most frequent label of each block, the smallest among equals. suppress_zero: 0 only where there is nothing else."""
    block = [cell(a, factor).alias(a) for a in AXES]
    counted = df.groupBy(*block, value).agg(F.count("*").alias("_n"))
    rank = F.struct((F.col(value) != 0).alias("_some") if suppress_zero else F.lit(True).alias("_some"), "_n", (-F.col(value)).alias("_minus"))
    return counted.groupBy(*COORDS).agg(F.max_by(value, rank).alias(value))


def downsample_mean(df: DataFrame, factor: int, value: str) -> DataFrame:
    """The mean of each block, rounded down."""
    return df.groupBy(*[cell(a, factor).alias(a) for a in AXES]).agg(F.floor(F.avg(value)).cast("long").alias(value))


def downsample_binary(df: DataFrame, factor: int, value: str, shape: tuple[int, int, int], majority: bool = True) -> DataFrame:
    """1 where more than half of a block (cut off at the volume's end) is set, or where any voxel is."""
    size = F.lit(1)
    for a, n in zip(AXES, shape, strict=True):
        size = size * F.least(F.lit(factor), n - F.col(a) * factor)
    sums = df.groupBy(*[cell(a, factor).alias(a) for a in AXES]).agg(F.sum((F.col(value) != 0).cast("long")).alias("_set"))
    hit = F.col("_set") > F.floor(size / 2) if majority else F.col("_set") > 0
    return sums.select(*COORDS, hit.cast("long").alias(value))


def upsample(df: DataFrame, factor: int) -> DataFrame:
    """Nearest repeat: a generator an axis."""
    out = df
    for a in AXES:
        out = out.withColumn(a, F.explode(F.sequence(F.col(a) * factor, F.col(a) * factor + factor - 1)))
    return out


def rescale(df: DataFrame, have: int, want: int, value: str, labels: bool = True) -> DataFrame:
    """From one scale to another, each twice as coarse as the one before."""
    if want == have:
        return df
    if want < have:
        return upsample(df, 1 << (have - want))
    return (downsample_mode if labels else downsample_mean)(df, 1 << (want - have), value)


def pyramid(df: DataFrame, depth: int, value: str, labels: bool = True) -> DataFrame:
    """All scales, each made from the one before, with their number. A scale that another is made from is written first, so none is made twice."""
    level, out, scratch = df.select(*COORDS, value), None, Scratch(df.sparkSession, "pyramid")
    for scale in range(depth + 1):
        if scale:
            level = rescale(level, 0, 1, value, labels)
            level = scratch.store(level) if scale < depth else level
        part = level.withColumn("scale", F.lit(scale))
        out = part if out is None else out.unionByName(part)
    return out


def roi_blocks(runs: DataFrame) -> DataFrame:
    """(z, y, x0, x1) runs, ends included -> (z, y, x) blocks."""
    return runs.select("z", "y", F.explode(F.sequence("x0", "x1")).alias("x")).distinct()


def run_lengths(blocks: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(z, y, x) -> (z, y, x0, x1) runs, ends included: gaps and islands within a row. Repeated blocks count once."""
    w = Window.partitionBy(*keys, "z", "y").orderBy("x")
    island = F.col("x") - F.dense_rank().over(w)
    return blocks.withColumn("_island", island).groupBy(*keys, "z", "y", "_island").agg(F.min("x").alias("x0"), F.max("x").alias("x1")).drop("_island")


def mask(df: DataFrame, roi: DataFrame, size: int, value: str) -> DataFrame:
    """Values outside the blocks (bz, by, bx) of the region become 0."""
    at = retile(df, Grid((size,) * 3))
    marked = roi.select("bz", "by", "bx", F.lit(True).alias("_in")).distinct()
    return at.join(marked, ["bz", "by", "bx"], "left").withColumn(value, F.when(F.col("_in"), F.col(value)).otherwise(F.lit(0))).drop("_in", "bz", "by", "bx")


def drop_empty(df: DataFrame, value: str, keys: tuple[str, ...] = ("bz", "by", "bx")) -> DataFrame:
    """Only the cells that have any voxel other than 0."""
    return df.join(df.where(F.col(value) != 0).select(*keys).distinct(), list(keys), "left_semi")


def padded_parts(df: DataFrame, grid: Grid, value: str, padding: int = 1, blank: int = 0) -> DataFrame:
    """(bz, by, bx, z, y, x, value, valid): each cell as a full box, from the first to the last voxel that it has, widened to multiples of the padding.

    Voxels that df lacks are blank and not valid. A cell without any has no box.
    """
    at = retile(df.select(*AXES, value), grid)
    ends = at.groupBy("bz", "by", "bx").agg(*[F.min(a).alias(a + "0") for a in AXES], *[F.max(a).alias(a + "1") for a in AXES])
    for a in AXES:
        first, last = (F.floor(F.col(a + end) / padding).cast("long") for end in "01")
        ends = ends.withColumn(a, F.explode(F.sequence(first * padding, (last + 1) * padding - 1)))
    found = ends.select("bz", "by", "bx", *AXES).join(at.withColumn("_in", F.lit(True)), ["bz", "by", "bx", *AXES], "left")
    return found.select("bz", "by", "bx", *AXES, F.coalesce(value, F.lit(blank)).alias(value), F.coalesce("_in", F.lit(False)).alias("valid"))


def label_pairs(gt: DataFrame, seg: DataFrame | None, grid: Grid, border: int = 0, value: str = "label") -> DataFrame:
    """(bz, by, bx, z, y, x, gt, seg, in_halo): two labelings by subvolume, with a border of their neighbours' voxels.

    Where the ground truth has nothing, 0, the other labeling counts as 0 too; without another one its labels are all 1.
    """
    own = gt.select(*AXES, F.col(value).alias("gt"))
    if seg is None:
        both = own.withColumn("seg", F.lit(1).cast("long"))
    else:
        both = own.join(seg.select(*AXES, F.col(value).alias("seg")), list(AXES), "left").withColumn("seg", F.when(F.col("gt") == 0, 0).otherwise(F.coalesce("seg", F.lit(0))))
    parts = retile_with_halo(both, grid, border) if border else retile(both, grid).withColumn("in_halo", F.lit(False))
    return parts.select("bz", "by", "bx", *AXES, "gt", "seg", "in_halo")


def boxes(start: tuple, stop: tuple, grid: Grid, spark) -> DataFrame:
    """Cells that meet a box, clipped to it: (bz, by, bx, z0, y0, x0, z1, y1, x1)."""
    out = None
    for a, lo, hi in zip(AXES, start, stop, strict=True):
        size, origin = grid.size(a), grid.origin(a)
        first, last = (lo - origin) // size, (hi - 1 - origin) // size
        axis = spark.range(first, last + 1).select(F.col("id").alias("b" + a), F.greatest(F.lit(lo), F.col("id") * size + origin).alias(a + "0"), F.least(F.lit(hi), (F.col("id") + 1) * size + origin).alias(a + "1"))
        out = axis if out is None else out.join(F.broadcast(axis))  # as many rows as cells on one axis
    return out.select("bz", "by", "bx", "z0", "y0", "x0", "z1", "y1", "x1")


def subvolumes(roi: DataFrame, ratio: int) -> DataFrame:
    """(sv, cz, cy, cx, blocks): subvolumes of ratio^3 blocks that have any block of the region, numbered from 0 in order."""
    found = roi.groupBy(*[cell("b" + a, ratio).alias("c" + a) for a in AXES]).agg(F.count_distinct("bz", "by", "bx").alias("blocks"))
    # by planes of subvolumes, of which there are few, and within each
    planes = found.groupBy("cz").agg(F.count("*").alias("_n"))
    starts = planes.select("cz", F.coalesce(F.sum("_n").over(Window.orderBy("cz").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("cz").orderBy("cy", "cx"))
    return found.withColumn("_k", within).join(starts, "cz").select("cz", "cy", "cx", "blocks", (F.col("_start") + F.col("_k") - 1).cast("long").alias("sv"))


def interior(subvols: DataFrame, ratio: int) -> DataFrame:
    """Those that lie in the region with all their blocks."""
    return subvols.where(F.col("blocks") == ratio**3)


def neighbours(subvols: DataFrame) -> DataFrame:
    """(sv, other) of subvolumes that share a face: each looks its six neighbours' cells up."""
    steps = F.array(*[F.struct(*[F.lit(d if a == axis else 0).alias(a) for a in AXES]) for axis in AXES for d in (-1, 1)])
    want = subvols.withColumn("d", F.explode(steps)).select("sv", *[(F.col("c" + a) + F.col(f"d.{a}")).alias("c" + a) for a in AXES])
    return want.join(subvols.select(F.col("sv").alias("other"), "cz", "cy", "cx"), ["cz", "cy", "cx"]).select("sv", "other")


def labels_at(points: DataFrame, volume: DataFrame, value: str) -> DataFrame:
    """Points with the label of their voxel, 0 where there is none; their other columns stay."""
    return points.join(volume.select(*COORDS, F.col(value).alias("label")), COORDS, "left").withColumn("label", F.coalesce("label", F.lit(0)))


def block_statistics(df: DataFrame, value: str, block: int) -> DataFrame:
    """(segment_id, z, y, x, count): voxels of each label in each block, by the block's start; 0 is left out."""
    return df.where(F.col(value) != 0).groupBy(F.col(value).alias("segment_id"), *[(cell(a, block) * block).alias(a) for a in AXES]).agg(F.count("*").alias("count"))


def block_runs(df: DataFrame, value: str, block: int, existing: DataFrame | None = None) -> DataFrame:
    """(bz, by, x0, x1): runs of blocks along x that have labels and, given those that exist already, differ from them."""
    own = df.where(F.col(value) != 0)
    if existing is not None:
        own = own.join(existing.select(*COORDS, value), [*COORDS, value], "left_anti")
    blocks = own.select(*[cell(a, block).alias(a) for a in AXES]).distinct()
    return run_lengths(blocks).withColumnsRenamed({"z": "bz", "y": "by"})


def sparse_body(df: DataFrame, value: str, bodies: list[int]) -> DataFrame:
    return df.where(F.col(value).isin(bodies)).select(*COORDS)


def body_blocks(df: DataFrame, value: str, bodies: list[int] | None, block: int) -> DataFrame:
    own = df.where(F.col(value) != 0) if bodies is None else df.where(F.col(value).isin(bodies))
    return own.select(F.col(value).alias("body"), *cells(Grid((block,) * 3))).distinct()


def histogram(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy(value).agg(F.count("*").alias("n"))


def destripe(df: DataFrame, value: str, axis: str = "y") -> DataFrame:
    """Each line's mean is moved to that of its slice, so stripes along the other axis go."""
    line, whole = Window.partitionBy("z", axis), Window.partitionBy("z")
    moved = F.col(value) - F.avg(value).over(line) + F.avg(value).over(whole)
    return df.withColumn(value, F.greatest(F.lit(0), F.least(F.lit(255), F.floor(moved + 0.5))).cast("long"))


def merged_channels(values: Column, groups: list[list[int]]) -> Column:
    """An array with the sum of each group of channels."""
    return F.array(*[sum((F.get(values, i) for i in g[1:]), F.get(values, g[0])) for g in groups])


def normalised_channels(values: Column) -> Column:
    """Channels that sum to 1; all 0 becomes the same share for each."""
    total = F.aggregate(values, F.lit(0.0), lambda s, v: s + v)
    return F.when(total == 0, F.transform(values, lambda v: 1.0 / F.size(values))).otherwise(F.transform(values, lambda v: v / total))
