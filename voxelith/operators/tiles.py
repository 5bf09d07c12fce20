"""Image tiles of the planes of a volume, and their pyramids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelith.sources.slices import encode

#: Of each plane: the axis that numbers its slices, that of its rows and that of its columns.
PLANES = {"xy": ("z", "y", "x"), "xz": ("y", "z", "x"), "yz": ("x", "z", "y")}
#: Of the tiles that are made together, at most, if a tile has not more itself.
LOT_PIXELS = 1 << 17


def pixels(df: DataFrame, value: str, tile: int, planes: tuple[str, ...] = ("xy", "xz", "yz")) -> DataFrame:
    """(plane, slice, row, col, r, c, value): the tile of each voxel in each plane and its place there."""
    out = None
    for p in planes:
        s, r, c = PLANES[p]
        part = df.select(F.lit(p).alias("plane"), F.col(s).alias("slice"), F.floor(F.col(r) / tile).cast("long").alias("row"), F.floor(F.col(c) / tile).cast("long").alias("col"), F.pmod(r, F.lit(tile)).alias("r"), F.pmod(c, F.lit(tile)).alias("c"), F.col(value).alias("value"))
        out = part if out is None else out.union(part)
    return out


def cut(df: DataFrame, value: str, tile: int, planes: tuple[str, ...] = ("xy", "xz", "yz")) -> DataFrame:
    """(plane, slice, row, col, image): complete tiles; pixels without a voxel are 0. Small tiles of near slices are made together."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        slices, of = np.unique(t.column("slice").to_numpy(), return_inverse=True)
        images = np.zeros((len(slices), tile * tile), np.uint8)
        images[of, t.column("at").to_numpy()] = t.column("value").to_numpy()
        row, col = (pa.repeat(k, len(slices)) for k in key[1:])
        return pa.table({"slice": pa.array(slices), "row": row, "col": col, "image": pa.array((encode(i.reshape(tile, tile)) for i in images), pa.binary())})

    out = None
    lot = F.floor(F.col("slice") / max(1, LOT_PIXELS // tile**2)).cast("long").alias("_lot")
    for p in planes:  # one at a time, and of a pixel few bytes, as each is sorted and sent to Python
        own = pixels(df, value, tile, (p,)).select(lot, F.col("slice").cast("long").alias("slice"), "row", "col", (F.col("r") * tile + F.col("c")).cast("int").alias("at"), F.col("value").cast("int").alias("value"))
        part = own.groupBy("_lot", "row", "col").applyInArrow(run, "slice long, row long, col long, image binary").select(F.lit(p).alias("plane"), "slice", "row", "col", "image")
        out = part if out is None else out.union(part)
    return out


def pyramid(df: DataFrame, value: str, tile: int, levels: int, planes: tuple[str, ...] = ("xy", "xz", "yz")) -> DataFrame:
    """Tiles of each level; a level is half as fine within its plane, the mean rounded down, and has the same slices."""
    out = None
    for p in planes:
        s, r, c = PLANES[p]
        level = df.select("z", "y", "x", value)
        for k in range(levels):
            if k:
                level = level.groupBy(F.col(s).alias(s), F.floor(F.col(r) / 2).cast("long").alias(r), F.floor(F.col(c) / 2).cast("long").alias(c)).agg(F.floor(F.avg(value)).cast("long").alias(value)).select("z", "y", "x", value)
            part = cut(level, value, tile, (p,)).withColumn("level", F.lit(k))
            out = part if out is None else out.union(part)
    return out
