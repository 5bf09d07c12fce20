"""Contingency of two labelings, and the metric family on top of it.

An overlap frame is (gt, seg, n), or (sv, gt, seg, n) by subvolume. Background of the ground truth is dropped;
background of the other labeling is a body of its own, 0. Rounding to four decimals happens where the metric
definitions have it, in between as well as at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelith.functions.numbers import exact_mean

ROUND = 4


def contingency(df: DataFrame, left: str = "gt", right: str = "seg", keys: tuple[str, ...] = ()) -> DataFrame:
    """Voxels for each pair of labels, background included."""
    return df.groupBy(*keys, left, right).agg(F.count("*").alias("n"))


def overlap(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return contingency(df.where("gt <> 0"), keys=keys)


def remapped(over: DataFrame, mapping: DataFrame, column: str = "seg", keys: tuple[str, ...] = ()) -> DataFrame:
    """Overlaps after bodies of one side are merged by mapping (label, body); unmapped ones stay."""
    side = mapping.select(F.col("label").alias(column), F.col("body").alias("_body"))
    joined = over.join(side, column, "left").withColumn(column, F.coalesce("_body", column))
    return joined.groupBy(*keys, "gt", "seg").agg(F.sum("n").alias("n"))


def _sides(over: DataFrame, threshold: int, keys: tuple[str, ...]) -> DataFrame:
    """With t (size of gt), s (size of seg among kept gt) and total; bodies of gt below the threshold are gone."""
    by = Window.partitionBy(*keys)
    kept = over.withColumn("t", F.sum("n").over(Window.partitionBy(*keys, "gt"))).where(F.col("t") >= threshold)
    kept = kept.withColumn("s", F.sum("n").over(Window.partitionBy(*keys, "seg")))
    return kept if keys == () else kept.withColumn("total", F.sum("n").over(by))


def _bits(n: str, of: str) -> Column:
    return F.col(n) * F.log2(F.col(of) / F.col(n))


def vi(over: DataFrame, threshold: int = 0, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, fm_vi, fs_vi, vi): false merge and false split bits a voxel, and their sum; 0 without kept bodies."""
    sides = over.withColumn("t", F.sum("n").over(Window.partitionBy(*keys, "gt"))).where(F.col("t") >= threshold)
    sides = sides.withColumn("s", F.sum("n").over(Window.partitionBy(*keys, "seg")))
    share = lambda of: F.coalesce(F.round(F.sum(_bits("n", of)) / F.sum("n"), ROUND), F.lit(0.0))
    sums = sides.groupBy(*keys).agg(share("s").alias("fm_vi"), share("t").alias("fs_vi"))
    return sums.withColumn("vi", F.round(F.col("fm_vi") + F.col("fs_vi"), ROUND))


def vi_sparse(over: DataFrame, important: DataFrame, threshold: int = 0) -> DataFrame:
    """(fm_vi, fs_vi, vi) where only important ground-truth bodies (gt) count; the others stay visible on the other side."""
    sized = over.withColumn("t", F.sum("n").over(Window.partitionBy("gt"))).where(F.col("t") >= threshold)
    sized = sized.withColumn("s", F.sum("n").over(Window.partitionBy("seg")))
    own = sized.join(important.select("gt").distinct(), "gt", "left_semi")
    share = lambda e: F.coalesce(F.round(F.sum(e) / F.sum("n"), ROUND), F.lit(0.0))
    sums = own.agg(share(_bits("n", "s")).alias("fm_vi"), share(_bits("n", "t")).alias("fs_vi"))
    return sums.withColumn("vi", F.round(F.col("fm_vi") + F.col("fs_vi"), ROUND))


def vi_bodies(over: DataFrame, threshold: int = 0) -> DataFrame:
    """(side, body, bits, size): a body's share of the bits, by ground-truth body (its fragments) and by the other's (its mergers)."""
    sides = over.withColumn("t", F.sum("n").over(Window.partitionBy("gt"))).where(F.col("t") >= threshold)
    sides = sides.withColumn("s", F.sum("n").over(Window.partitionBy("seg")))
    total = sides.agg(F.sum("n").alias("total"))
    each = lambda side, body, of: sides.groupBy(F.col(body).alias("body")).agg(F.sum(_bits("n", of)).alias("raw"), F.sum("n").alias("size")).withColumn("side", F.lit(side))
    both = each("gt", "gt", "t").union(each("seg", "seg", "s"))
    return both.join(F.broadcast(total)).select("side", "body", F.round(F.col("raw") / F.col("total"), ROUND).alias("bits"), "size")


def top(df: DataFrame, order: str, k: int, keys: tuple[str, ...] = (), ident: str = "body") -> DataFrame:
    """The k largest of each key, the larger identifier first among equals, with their rank."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order), F.desc(ident))
    return df.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def pairs_of(n: Column) -> Column:
    return n * (n - 1) / 2


def rand(over: DataFrame, threshold: int = 0, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, merge, split, rand): shares of pairs that stay together, and their harmonic mean; 1 where there are no pairs."""
    kept = over.withColumn("t", F.sum("n").over(Window.partitionBy(*keys, "gt"))).where(F.col("t") >= threshold)
    # each body's pairs once: on the first row of its window
    first = lambda of, other: F.when(F.row_number().over(Window.partitionBy(*keys, of).orderBy(other)) == 1, F.sum("n").over(Window.partitionBy(*keys, of)))
    marked = kept.withColumn("of_gt", first("gt", "seg")).withColumn("of_seg", first("seg", "gt"))
    sums = marked.groupBy(*keys).agg(*[F.coalesce(F.sum(pairs_of(F.col(c))), F.lit(0.0)).alias(a) for c, a in (("n", "both"), ("of_seg", "in_seg"), ("of_gt", "in_gt"))])
    rate = lambda c: F.when(F.col(c) > 0, F.round(F.col("both") / F.col(c), ROUND)).otherwise(F.lit(1.0))
    rates = sums.select(*keys, rate("in_seg").alias("merge"), rate("in_gt").alias("split"))
    both = F.col("merge") + F.col("split")
    return rates.withColumn("rand", F.when(both > 0, F.round(2 * F.col("merge") * F.col("split") / both, ROUND)).otherwise(F.lit(1.0)))


def over_subvolumes(by_sv: DataFrame, value: str, higher_is_better: bool = False, ignored: DataFrame | None = None) -> DataFrame:
    """(best, best_sv, worst, worst_sv, average) of a value over the subvolumes; the smaller index among equals."""
    df = by_sv if ignored is None else by_sv.join(ignored, "sv", "left_anti")
    least = F.min(F.struct(F.col(value), F.col("sv")))
    most = F.min(F.struct((-F.col(value)).alias("minus"), F.col("sv")))
    sums = df.agg(least.alias("lo"), most.alias("hi"), exact_mean(value, ROUND).alias("average"))
    lo, hi = (F.col(f"lo.{value}"), F.col("lo.sv")), (-F.col("hi.minus"), F.col("hi.sv"))
    best, worst = (hi, lo) if higher_is_better else (lo, hi)
    return sums.select(best[0].alias("best"), best[1].alias("best_sv"), worst[0].alias("worst"), worst[1].alias("worst_sv"), "average")


def _sizes(over: DataFrame, side: str) -> DataFrame:
    return over.groupBy(F.col(side).alias("body")).agg(F.sum("n").alias("size"))


def bodies_to_reach(over: DataFrame, percents: tuple[int, ...] = (50, 75, 90)) -> DataFrame:
    """(percent, gt_bodies, seg_bodies, diff): how many bodies, largest first, hold that share of the ground truth; all if it isn't reached.

    Bodies of one size are alike here, so the running sum goes over the distinct sizes, of which there are few.
    """
    total = over.agg(F.sum("n").alias("total"))

    def reach(side: str) -> DataFrame:
        before = Window.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
        sizes = _sizes(over, side).groupBy("size").agg(F.count("*").alias("k"))
        run = sizes.withColumns({"held": F.coalesce(F.sum(F.col("size") * F.col("k")).over(before), F.lit(0)), "bodies": F.coalesce(F.sum("k").over(before), F.lit(0))})
        run = run.join(F.broadcast(total))  # one row
        more = lambda p: F.greatest(F.lit(0), F.ceil((F.col("total") * p - F.col("held") * 100) / (F.col("size") * 100)))
        return run.agg(*[F.coalesce(F.min(F.when(more(p) <= F.col("k"), F.col("bodies") + more(p))), F.sum("k")).cast("long").alias(f"p{p}") for p in percents])

    stack = "stack({}, {}) AS (percent, {})"
    rows = lambda side: reach(side).selectExpr(stack.format(len(percents), ", ".join(f"{p}, p{p}" for p in percents), f"{side}_bodies"))
    return rows("gt").join(rows("seg"), "percent").withColumn("diff", F.abs(F.col("gt_bodies") - F.col("seg_bodies")))


def best_match(over: DataFrame, threshold: int = 0) -> DataFrame:
    """(gt, seg, overlap, gt_size, seg_size): the body with the largest overlap, if most of that body is in it."""
    sized = over.withColumn("gt_size", F.sum("n").over(Window.partitionBy("gt"))).withColumn("seg_size", F.sum("n").over(Window.partitionBy("seg"))).where(F.col("gt_size") >= threshold)
    best = sized.groupBy("gt", "gt_size").agg(F.max(F.struct("n", (-F.col("seg")).alias("minus"), "seg_size")).alias("b"))
    out = best.select("gt", (-F.col("b.minus")).alias("seg"), F.col("b.n").alias("overlap"), "gt_size", F.col("b.seg_size").alias("seg_size"))
    return out.where(F.col("overlap") > F.floor(F.col("seg_size") / 2))


def body_counts(over: DataFrame, keys: tuple[str, ...] = ("sv",)) -> DataFrame:
    return over.groupBy(*keys).agg(F.count_distinct("gt").alias("gt_bodies"), F.count_distinct("seg").alias("seg_bodies"), F.sum("n").alias("size"))


def largest_bodies(over: DataFrame, percent: int, side: str = "gt") -> DataFrame:
    """(body) of one side, the largest first until they hold a share of the volume; the larger identifier first among equals.

    The running sum goes over the distinct sizes; only bodies of the one size at which the share is reached are ranked.
    """
    before = Window.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    sized = _sizes(over, side)
    runs = sized.groupBy("size").agg(F.count("*").alias("k")).withColumn("held", F.coalesce(F.sum(F.col("size") * F.col("k")).over(before), F.lit(0)))
    runs = runs.join(F.broadcast(over.agg(F.sum("n").alias("total"))))  # one row
    # so many of a size begin before the share is reached
    runs = runs.withColumn("fit", F.expr(f"greatest(0, (total * {percent} - held * 100 + size * 100 - 1) div (size * 100))")).where("fit > 0")
    marked = sized.join(runs.select("size", "k", "fit"), "size")
    whole = marked.where("fit >= k").select("body")
    rank = F.row_number().over(Window.orderBy(F.desc("body")))
    return whole.union(marked.where("fit < k").withColumn("_r", rank).where("_r <= fit").select("body"))


def top_overlaps(over: DataFrame, percent: int = 90, k: int = 10) -> DataFrame:
    """(gt, rank, seg, n): the k largest overlaps of the largest ground-truth bodies that hold a share of the volume."""
    return top(over.join(largest_bodies(over, percent).toDF("gt"), "gt"), "n", k, ("gt",), "seg").select("gt", "rank", "seg", "n")


def orphans(df: DataFrame, side: str, threshold: int, sizes: tuple[int, int, int], keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, body, size) of bodies below the threshold with no voxel on the outer faces of the volume."""
    edge = F.lit(False)
    for a, n in zip(("z", "y", "x"), sizes, strict=True):
        edge = edge | (F.col(a) == 0) | (F.col(a) == n - 1)
    body = df.where(F.col(side) != 0).groupBy(*keys, F.col(side).alias("body")).agg(F.count("*").alias("size"), F.max(edge).alias("edge"))
    return body.where((F.col("size") < threshold) & ~F.col("edge")).select(*keys, "body", "size")


def orphan_counts(df: DataFrame, side: str, threshold: int, sizes: tuple[int, int, int], keys: tuple[str, ...] = ("sv",)) -> DataFrame:
    """(keys, n, voxels): orphans of each subvolume; one without any has none, not no row."""
    found = orphans(df, side, threshold, sizes, keys)
    every = df.select(*keys).distinct().join(found, list(keys), "left")
    return every.groupBy(*keys).agg(F.count("body").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("voxels"))


def worst_merged(over: DataFrame, k: int, threshold: int = 0) -> DataFrame:
    """(rank, seg, bits, size): bodies that merge the most, by their share of the false-merge bits; the larger identifier first among equals."""
    of = vi_bodies(over, threshold).where("side = 'seg'").select(F.col("body").alias("seg"), "bits", "size")
    return top(of.withColumnRenamed("seg", "body"), "bits", k).select("rank", F.col("body").alias("seg"), "bits", "size")


def total_size(over: DataFrame) -> DataFrame:
    """(size, gt_bodies, seg_bodies): voxels that count, and bodies of either side."""
    return over.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("size"), F.count_distinct("gt").alias("gt_bodies"), F.count_distinct("seg").alias("seg_bodies"))


def edit_operations(over: DataFrame) -> DataFrame:
    """(kind, gt, seg, n): overlaps that a correction would move.

    A body belongs to the ground-truth body that it overlaps most (the smaller identifier among equals). What lies in
    another one is to be split off; of the bodies that belong to one, all but the largest are to be merged.
    """
    first = F.row_number().over(Window.partitionBy("seg").orderBy(F.desc("n"), "gt"))
    owned = over.withColumn("owned", first == 1)
    largest = F.row_number().over(Window.partitionBy("gt", "owned").orderBy(F.desc("n"), "seg"))
    marked = owned.withColumn("place", largest)
    return marked.where("NOT owned OR place > 1").select(F.when(F.col("owned"), "merge").otherwise("split").alias("kind"), "gt", "seg", "n")
