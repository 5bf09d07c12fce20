"""Statistics of segments and bodies, label indexes and their checks, batches and keys of grouped output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelith.functions.grid import AXES, Grid, cell, cells, packed_block
from voxelith.functions.numbers import exact_mean, running

HUNDRED, THOUSAND = 100, 1000
#: Blocks along z that go into one row of a label index.
SLAB = 64


def segment_stats(df: DataFrame, value: str, block: int) -> DataFrame:
    """(segment, voxel_count, box, n_blocks, block_list): one aggregation by block, one by segment."""
    by_block = df.where(F.col(value) != 0).groupBy(F.col(value).alias("segment"), *cells(Grid((block,) * 3))).agg(F.count("*").alias("n"), *[F.min(a).alias(a + "0") for a in AXES], *[(F.max(a) + 1).alias(a + "1") for a in AXES])
    return by_block.groupBy("segment").agg(
        F.sum("n").alias("voxel_count"), *[F.min(a + "0").alias(a + "0") for a in AXES], *[F.max(a + "1").alias(a + "1") for a in AXES],
        F.count("*").alias("n_blocks"), F.sort_array(F.collect_list(packed_block(F.col("bz"), F.col("by"), F.col("bx")))).alias("block_list"),
    )


def body_stats(stats: DataFrame, mapping: DataFrame) -> DataFrame:
    """Segments (segment, voxel_count) with their body and its count and size; unmapped segments are their own body."""
    named = stats.select("segment", "voxel_count").join(mapping.select(F.col("label").alias("segment"), "body"), "segment", "left").withColumn("body", F.coalesce("body", "segment"))
    w = Window.partitionBy("body")
    return named.withColumns({"body_segments": F.count("*").over(w), "body_voxels": F.sum("voxel_count").over(w)})


def keep(stats: DataFrame, least_segment: int = 0, most_segment: int | None = None, least_body: int = 0, most_body: int | None = None, bodies: list[int] | None = None, least_count: int = 0) -> DataFrame:
    """Segments within the bounds: at least the lower ones, at most the upper ones."""
    ok = (F.col("voxel_count") >= least_segment) & (F.col("body_voxels") >= least_body) & (F.col("body_segments") >= least_count)
    if most_segment is not None:
        ok = ok & (F.col("voxel_count") <= most_segment)
    if most_body is not None:
        ok = ok & (F.col("body_voxels") <= most_body)
    if bodies is not None:
        ok = ok & F.col("body").isin(bodies)
    return stats.where(ok)


def downsample_factor(box_voxels: Column, most: int, least_factor: int = 1, limit: Column | None = None) -> Column:
    """1 plus the whole cube root of how often the box holds what can be analysed, at least the minimum; a body's own limit, if it has one, takes the place of `most`.

    Factors of 256 and more cannot be stored and are null.
    """
    per = F.lit(most) if limit is None else F.coalesce(limit, F.lit(most))
    factor = F.greatest(F.lit(least_factor), 1 + F.floor(F.cbrt(box_voxels / per) + 1e-9)).cast("long")
    return F.when(factor < 256, factor)


def without_huge(groups: DataFrame, key: str, size: str, most: int) -> tuple[DataFrame, DataFrame]:
    """(rows of groups whose sizes sum to at most `most`, (key, total) of the others)."""
    totals = groups.groupBy(key).agg(F.sum(size).alias("total"))
    huge = totals.where(F.col("total") > most)
    return groups.join(huge.select(key), key, "left_anti"), huge


def group_of(ident: Column, scheme: str) -> Column:
    """The group of grouped output: by hundreds, thousands, or each identifier by itself."""
    return {"hundreds": F.floor(ident / HUNDRED) * HUNDRED, "thousands": F.floor(ident / THOUSAND) * THOUSAND, "singletons": ident}[scheme].cast("long")


def name_of(ident: Column, scheme: str, suffix: str = "") -> Column:
    """The key under which grouped output is found: the group's number in 16 digits, `<body>` itself for singletons."""
    group = group_of(ident, scheme)
    return F.concat(group.cast("string") if scheme == "singletons" else F.lpad(group.cast("string"), 16, "0"), F.lit(suffix))


def by_size(stats: DataFrame, size: str = "voxel_count", key: str = "segment") -> DataFrame:
    """Largest first, so that what takes longest begins first; the smaller key among equals."""
    return stats.orderBy(F.desc(size), key)


def label_index(stats: DataFrame, mapping: DataFrame, block: int) -> DataFrame:
    """(body, slab, blocks): of block statistics, a map from packed block to a map from supervoxel to count.

    A row has the blocks of one slab along z, so that the largest body's index doesn't have to fit one row.
    """
    named = stats.join(mapping.select(F.col("label").alias("segment_id"), "body"), "segment_id", "left").withColumn("body", F.coalesce("body", "segment_id"))
    at = [(F.floor(F.col(a) / block)).cast("long") for a in AXES]
    inner = named.groupBy("body", F.floor(at[0] / SLAB).cast("long").alias("slab"), packed_block(*at).alias("block")).agg(F.map_from_entries(F.collect_list(F.struct("segment_id", "count"))).alias("counts"))
    return inner.groupBy("body", "slab").agg(F.map_from_entries(F.collect_list(F.struct("block", "counts"))).alias("blocks"))


def body_ids(stats: DataFrame, mapping: DataFrame) -> DataFrame:
    """The body of each row of block statistics."""
    return stats.join(mapping.select(F.col("label").alias("segment_id"), "body"), "segment_id", "left").select(F.coalesce("body", "segment_id").alias("body"))


def index_rows(index: DataFrame) -> DataFrame:
    """The index as rows: (body, block, segment_id, count)."""
    return index.select("body", F.explode("blocks").alias("block", "counts")).select("body", "block", F.explode("counts").alias("segment_id", "count"))


def tombstones(mapping: DataFrame) -> DataFrame:
    """Supervoxels that are not their own body any more, each with an empty index."""
    return mapping.where("label <> body").select(F.col("label").alias("body"), F.lit(0).cast("long").alias("count"))


def mapping_operations(mapping: DataFrame, span: int = 100_000) -> DataFrame:
    """(mapped, original): the supervoxels of each body, as a mapping operation lists them; a body has an operation for each range of so many names."""
    return mapping.groupBy(F.col("body").alias("mapped"), F.floor(F.col("label") / span).alias("_part")).agg(F.sort_array(F.collect_set("label")).alias("original")).drop("_part")


def index_check(stored: DataFrame, actual: DataFrame) -> DataFrame:
    """(body, bz, by, bx, missing): blocks of a body that the index lacks (true) or has in excess (false)."""
    key = ["body", "bz", "by", "bx"]
    both = stored.select(*key, F.lit(1).alias("_s")).join(actual.select(*key, F.lit(1).alias("_a")), key, "full_outer")
    return both.where("_s IS NULL OR _a IS NULL").select(*key, F.col("_s").isNull().alias("missing"))


def index_mismatches(stored: DataFrame, actual: DataFrame) -> DataFrame:
    """(body, state): bodies whose stored index is missing, or is a mismatch: other blocks, supervoxels or counts.

    Both are rows (body, block, segment_id, count). A stored index of a body that is not there any more is no mismatch.
    """
    key = ["body", "block", "segment_id"]
    both = stored.select(*key, F.col("count").alias("_s")).join(actual.select(*key, F.col("count").alias("_a")), key, "full_outer")
    sums = both.groupBy("body").agg(F.count("_s").alias("s"), F.count("_a").alias("a"), F.max((~F.col("_s").eqNullSafe(F.col("_a"))).cast("int")).alias("other"))
    state = F.when(F.col("s") == 0, "missing").when(F.col("other") == 1, "mismatch")
    return sums.where("a > 0").select("body", state.alias("state")).where("state IS NOT NULL")


def batches(df: DataFrame, key: str, rows: int) -> DataFrame:
    """(key, n, batch): consecutive keys in batches that begin at about every `rows` rows; a key is never split."""
    sizes = running(df.groupBy(key).agg(F.count("*").alias("n")), key, "n", "_before")
    return sizes.select(key, "n", F.floor(F.col("_before") / rows).cast("long").alias("batch"))


def object_masks(df: DataFrame, value: str, block: int, least: int, shape: tuple[int, int, int]) -> DataFrame:
    """(bz, by, bx, label, box, n): each label of each block; those below `least` only where they touch the block's faces."""
    edge = F.lit(False)
    for a in AXES:
        edge = edge | (F.col(a) % block == 0) | (F.col(a) % block == block - 1)
    masks = df.where(F.col(value) != 0).groupBy(*cells(Grid((block,) * 3)), F.col(value).alias("label")).agg(F.count("*").alias("n"), *[F.min(a).alias(a + "0") for a in AXES], *[(F.max(a) + 1).alias(a + "1") for a in AXES], F.max(edge).alias("_edge"))
    return masks.where((F.col("n") >= least) | F.col("_edge")).drop("_edge")


def assembled(df: DataFrame, value: str, most: int, least: int) -> DataFrame:
    """(label, factor, z, y, x): each label's voxels at the factor that lets its box fit; dropped if too few remain.

    Boxes and counts are aggregated and joined back, so that no label has to meet in one task.
    """
    own = df.where(F.col(value) != 0).select(F.col(value).alias("label"), *AXES)
    box = F.lit(1).cast("long")
    for a in AXES:
        box = box * (F.max(a) - F.min(a) + 1)
    factors = own.groupBy("label").agg(downsample_factor(box, most).alias("factor"))
    scaled = own.join(factors, "label").select("label", "factor", *[F.floor(F.col(a) / F.col("factor")).cast("long").alias(a) for a in AXES]).distinct()
    kept = scaled.groupBy("label", "factor").agg(F.count("*").alias("_n")).where(F.col("_n") * F.pow("factor", F.lit(3)) >= least).select("label")
    return scaled.join(kept, "label", "left_semi")


def mask_sizes(masks: DataFrame, mapping: DataFrame) -> DataFrame:
    """(body, boxes, voxels): sums of box volumes and voxels of a body's masks."""
    named = masks.join(mapping, "label", "left").withColumn("body", F.coalesce("body", "label"))
    volume = (F.col("z1") - F.col("z0")) * (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))
    return named.groupBy("body").agg(F.sum(volume).alias("boxes"), F.sum("n").alias("voxels"))


def request_stats(requests: DataFrame, start: str, seconds: str, group: str) -> DataFrame:
    """(group, requests, mean_seconds, wall_seconds): of timed requests."""
    at = F.unix_timestamp(start)
    return requests.groupBy(group).agg(F.count("*").alias("requests"), exact_mean(seconds, 4, 6).alias("mean_seconds"), (F.max(at) - F.min(at)).alias("wall_seconds"))
