"""Features of boundaries between regions, and hierarchical merging of regions by them.

A feature row holds sums that add up (how many, total, squares, least, greatest, a histogram), so features of parts of a
volume, or of edges that become one when regions merge, are combined by adding. All are whole numbers; what is derived
from them, mean or variance, comes last. A trained scorer is the caller's: any function of edges with their features.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelith.functions.grid import AXES
from voxelith.sources.scratch import Scratch

#: Of the histogram of whole values from 0 on; the last bin has all above.
BINS, WIDTH = 8, 32
MAX_ROUNDS = 1_000


def sums(value: Column, bins: int = BINS, width: int = WIDTH) -> list[Column]:
    """The feature columns of a group of values."""
    v = value.cast("long")
    place = F.least(F.floor(v / width), F.lit(bins - 1))
    return [
        F.count(v).alias("n"), F.sum(v).alias("total"), F.sum(v * v).alias("squares"), F.min(v).alias("low"), F.max(v).alias("high"),
        *[F.sum((place == i).cast("long")).alias(f"h{i}") for i in range(bins)],
    ]


def combined(features: DataFrame, *keys: str) -> DataFrame:
    """Rows of the same keys as one: parts of an edge or a region that were found apart."""
    how = {"low": F.min, "high": F.max}
    return features.groupBy(*keys).agg(*[how.get(c, F.sum)(c).alias(c) for c in features.columns if c not in keys])


def boundary_features(df: DataFrame, label: str, value: str, keys: tuple[str, ...] = (), bins: int = BINS, width: int = WIDTH) -> DataFrame:
    """(keys, u, v, features) of each pair of regions that share a face; of two voxels that do, the larger value counts. Label 0 is left out."""
    own, parts = df.where(F.col(label) != 0), []
    for a in AXES:
        w = Window.partitionBy(*keys, *[o for o in AXES if o != a]).orderBy(a)
        met = own.select(*keys, F.col(label).alias("_p"), F.lead(label).over(w).alias("_q"), (F.lead(a).over(w) - F.col(a)).alias("_d"), F.greatest(F.col(value), F.lead(value).over(w)).alias("_v"))
        parts.append(met.where("_d = 1 AND _p <> _q").select(*keys, F.least("_p", "_q").alias("u"), F.greatest("_p", "_q").alias("v"), "_v"))
    return reduce(DataFrame.union, parts).groupBy(*keys, "u", "v").agg(*sums(F.col("_v"), bins, width))


def region_features(df: DataFrame, label: str, value: str, keys: tuple[str, ...] = (), bins: int = BINS, width: int = WIDTH) -> DataFrame:
    """(keys, id, features) of each region's voxels."""
    return df.where(F.col(label) != 0).groupBy(*keys, F.col(label).alias("id")).agg(*sums(F.col(value), bins, width))


def with_ends(edges: DataFrame, regions: DataFrame) -> DataFrame:
    """Edges with the features of both regions, u_... and v_..., for a scorer."""
    side = lambda s: regions.toDF(s, *[f"{s}_{c}" for c in regions.columns[1:]])
    return edges.join(side("u"), "u").join(side("v"), "v")


def described(features: DataFrame) -> DataFrame:
    """features with mean and variance."""
    mean = F.col("total") / F.col("n")
    return features.withColumns({"mean": mean, "variance": F.col("squares") / F.col("n") - mean * mean})


def contracted(edges: DataFrame, joined: DataFrame) -> DataFrame:
    """Edges after regions `gone` have become regions `kept`: those inside a region go, those that now join the same two regions add up."""
    to = lambda s: joined.select(F.col("gone").alias(s), F.col("kept").alias(f"_{s}"))
    named = edges.join(to("u"), "u", "left").join(to("v"), "v", "left").withColumns({"_a": F.coalesce("_u", "u"), "_b": F.coalesce("_v", "v")}).where("_a <> _b")
    rest = [c for c in edges.columns if c not in ("u", "v")]
    return combined(named.select(F.least("_a", "_b").alias("u"), F.greatest("_a", "_b").alias("v"), *rest), "u", "v")


def agglomerated(edges: DataFrame, threshold: float) -> DataFrame:
    """(label, body): regions merged while the mean along a boundary is at most the threshold; a body is its smallest region.

    In a round two regions merge where each is the other's lowest boundary (the smaller names among equals), and the
    boundaries of the new region are those of both, added up. A mean over a union is never below both means, so this is
    the hierarchy that merging the lowest boundary of all, one at a time, gives. Regions without an edge don't appear.
    """
    scratch = Scratch(edges.sparkSession, "agglomerate")
    now = scratch.store(combined(edges.select("u", "v", "n", "total").where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "n", "total"), "u", "v"))
    bodies = scratch.store(now.select(F.explode(F.array("u", "v")).alias("label")).distinct().select("label", F.col("label").alias("body")))
    for _ in range(MAX_ROUNDS):
        turned = now.withColumn("_turn", F.struct((F.col("total") / F.col("n")).alias("mean"), "u", "v"))
        first = turned.select(F.explode(F.array("u", "v")).alias("node"), "_turn").groupBy("node").agg(F.min("_turn").alias("_first"))
        both = turned.where(F.col("_turn.mean") <= threshold).join(first.toDF("u", "_first_u"), "u").join(first.toDF("v", "_first_v"), "v")
        joined = scratch.store(both.where("_turn = _first_u AND _turn = _first_v").select(F.col("u").alias("kept"), F.col("v").alias("gone")))
        if not joined.limit(1).count():
            return bodies
        after = scratch.store(contracted(now, joined))
        named = scratch.store(bodies.join(joined.select(F.col("gone").alias("body"), "kept"), "body", "left").select("label", F.coalesce("kept", "body").alias("body")))
        scratch.free(now, bodies, joined)
        now, bodies = after, named
    raise RuntimeError("agglomeration did not end")


def agglomerate(df: DataFrame, label: str, value: str, threshold: float) -> DataFrame:
    """df with regions merged over boundaries of a low mean value."""
    bodies = agglomerated(boundary_features(df, label, value), threshold)
    return df.join(bodies.toDF(label, "_body"), label, "left").withColumn(label, F.coalesce("_body", label)).select(*df.columns)


def boundary_probability(edges: DataFrame, most: int = 255) -> DataFrame:
    """(u, v, p, n): that two regions are one, by the mean along their boundary alone; in place of a trained scorer."""
    return edges.select("u", "v", F.round(1 - F.col("total") / (F.col("n") * most), 6).alias("p"), "n")
