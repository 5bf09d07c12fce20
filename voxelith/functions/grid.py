"""Column expressions of the grid algebra. Division is floor division, so negative coordinates are legal."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

AXES = ("z", "y", "x")


@dataclass(frozen=True)
class Grid:
    """Cells of `shape` (z, y, x), one of them starting at `offset`."""

    shape: tuple[int, int, int]
    offset: tuple[int, int, int] = (0, 0, 0)

    def size(self, axis: str) -> int:
        return self.shape[AXES.index(axis)]

    def origin(self, axis: str) -> int:
        return self.offset[AXES.index(axis)]


def cube(n: int) -> Grid:
    return Grid((n, n, n))


def cell(coord: str | Column, size: int, offset: int = 0) -> Column:
    """Index of the cell in which a coordinate lies."""
    c = F.col(coord) if isinstance(coord, str) else coord
    return F.floor((c - F.lit(offset)) / F.lit(float(size))).cast("long")


def cells(grid: Grid, prefix: str = "b") -> list[Column]:
    """bz, by, bx of the columns z, y, x."""
    return [cell(a, grid.size(a), grid.origin(a)).alias(prefix + a) for a in AXES]


def corner(coord: str | Column, size: int, offset: int = 0) -> Column:
    """Start of the cell in which a coordinate lies."""
    return cell(coord, size, offset) * size + offset


def packed_block(bz: Column, by: Column, bx: Column) -> Column:
    """A block index in one long: 21 bits a coordinate, as label indexes name blocks."""
    return F.shiftleft(bz.cast("long"), 42).bitwiseOR(F.shiftleft(by.cast("long"), 21)).bitwiseOR(bx.cast("long"))


def unpacked_block(block: Column) -> list[Column]:
    low = (1 << 21) - 1
    return [F.shiftright(block, 42).alias("bz"), F.shiftright(block, 21).bitwiseAND(low).alias("by"), block.bitwiseAND(low).alias("bx")]


def inside(box: tuple[tuple[int, int, int], tuple[int, int, int]]) -> Column:
    """Whether z, y, x lie in a box; its stop is exclusive."""
    (z0, y0, x0), (z1, y1, x1) = box
    return (F.col("z") >= z0) & (F.col("z") < z1) & (F.col("y") >= y0) & (F.col("y") < y1) & (F.col("x") >= x0) & (F.col("x") < x1)


def xyz_box(box_xyz: list[list[int]]) -> tuple[tuple[int, int, int], tuple[int, int, int]]:
    """A configuration's box, [[x0, y0, z0], [x1, y1, z1]], in ZYX order."""
    start, stop = box_xyz
    return tuple(start[::-1]), tuple(stop[::-1])


def overlap_length(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))


def default_entry(value: Column, default: Column) -> Column:
    """-1 in a box stands for the default."""
    return F.coalesce(F.nullif(value, F.lit(-1)), default)


def pyramid_depth(max_dim: int) -> int:
    """Levels until the longest side fits 512."""
    depth = 0
    while max_dim > 512 << depth:
        depth += 1
    return depth
