"""The segmentation pipeline: steps are functions on dense blocks, found by name and run a block to a group."""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxelith.functions.grid import AXES, Grid, cell, cells

STEPS: dict[str, Callable[..., np.ndarray]] = {}
#: Those that take a stack of blocks too, the stack's axis first.
STACKED: set[str] = set()
#: Small blocks of a cube of about this side are one group.
LOT = 32
#: The stages of a segmentation, in order; a configuration names a step for each, or leaves it out.
KINDS = ("background-mask", "predict-voxels", "create-supervoxels", "agglomerate-supervoxels")


def step(name: str, stacked: bool = False) -> Callable:
    """Registers a function (values, **parameters) -> values of the same shape, dense and in order z, y, x."""

    def put(f: Callable) -> Callable:
        STEPS[name] = f
        if stacked:
            STACKED.add(name)
        return f

    return put


def run_step(df: DataFrame, name: str, value: str, out: str, block: int, **parameters) -> DataFrame:
    """(z, y, x, value) -> with out, from the named step on each block's array; voxels that a block lacks are 0 there.

    An array is as large as the box of its block's voxels. Blocks near each other come in one group, and a step that takes
    stacks gets those of one shape together.
    """
    f = STEPS[name]
    each = f if name in STACKED else lambda stack, **p: np.stack([np.asarray(f(b, **p), np.float64) for b in stack])
    keyed = df.select(*AXES, F.col(value).cast("double").alias(value), *cells(Grid((block * max(1, LOT // block),) * 3), "g"))

    def apply(t: pa.Table) -> pa.Table:
        at = [t.column(a).to_numpy().astype(np.int64) for a in AXES]
        order = np.lexsort([a // block for a in at[::-1]])
        at = [a[order] for a in at]
        of = [a // block for a in at]
        values = t.column(value).to_numpy()[order]
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([o[1:] != o[:-1] for o in of])
        first, number = np.flatnonzero(new), np.cumsum(new) - 1
        low = [np.minimum.reduceat(a, first) for a in at]
        place = [a - lo[number] for a, lo in zip(at, low, strict=True)]
        shapes, kind = np.unique(np.stack([np.maximum.reduceat(p, first) + 1 for p in place], 1), axis=0, return_inverse=True)
        got, kind = np.empty(len(order)), kind.ravel()
        for i, shape in enumerate(shapes):
            rows = np.flatnonzero(kind[number] == i)
            nth = np.cumsum(kind == i) - 1
            dense = np.zeros((nth[-1] + 1, *shape))
            where = (nth[number[rows]], *(p[rows] for p in place))
            dense[where] = values[rows]
            got[rows] = np.asarray(each(dense, **parameters), np.float64)[where]
        return pa.table([*at, *of, got], names=[*AXES, "bz", "by", "bx", out])

    return keyed.groupBy("gz", "gy", "gx").applyInArrow(apply, f"z long, y long, x long, bz long, by long, bx long, {out} double")


def run_keyed(df: DataFrame, steps: list[tuple[str, dict]], value: str) -> DataFrame:
    """Steps on blocks that are keyed already (bz, by, bx, in_halo), halo included: with label, a whole number."""
    keyed = df.select("z", "y", "x", "bz", "by", "bx", "in_halo", F.col(value).cast("double").alias("_in"))

    def apply(t: pa.Table) -> pa.Table:
        at = [t.column(a).to_numpy() for a in AXES]
        place = tuple(a - a.min() for a in at)
        dense = np.zeros([int(p.max()) + 1 for p in place])
        dense[place] = t.column("_in").to_numpy()
        for name, parameters in steps:
            dense = np.asarray(STEPS[name](dense, **parameters), np.float64)
        kept = {c: t.column(c) for c in ("z", "y", "x", "bz", "by", "bx", "in_halo")}
        return pa.table({**kept, "label": pa.array(dense[place].astype(np.int64))})

    return keyed.groupBy("bz", "by", "bx").applyInArrow(apply, "z long, y long, x long, bz long, by long, bx long, in_halo boolean, label long")


def segment(df: DataFrame, value: str, block: int, steps: list[tuple[str, dict]]) -> DataFrame:
    """The steps one after the other, each on what the one before gave."""
    for i, (name, parameters) in enumerate(steps):
        df = run_step(df.select(*AXES, F.col(value if i == 0 else "label").alias("_in")), name, "_in", "label", block, **parameters)
    return df


def configured(config: dict[str, dict]) -> list[tuple[str, dict]]:
    """The steps of a configuration {stage: {"step": name, "parameters": {...}}}, in order of the stages."""
    if unknown := set(config) - set(KINDS):
        raise ValueError(f"no stage {sorted(unknown)}; there are {KINDS}")
    if missing := {c["step"] for c in config.values()} - set(STEPS):
        raise ValueError(f"no step {sorted(missing)}; there are {sorted(STEPS)}")
    return [(config[k]["step"], config[k].get("parameters", {})) for k in KINDS if k in config]


def precomputed(df: DataFrame, stored: DataFrame, value: str) -> DataFrame:
    """df with value from a segmentation or prediction that is stored already; 0 where it has nothing."""
    known = stored.select(*AXES, F.col(value).alias("_known"))
    return df.join(known, list(AXES), "left").withColumn(value, F.coalesce("_known", F.lit(0))).drop("_known")


def membrane_predictions(df: DataFrame, value: str, block: int) -> DataFrame:
    """(z, y, x, p): 1 less the value's place between the least and the largest of its block."""
    keyed = df.select("*", *cells(Grid((block,) * 3)))
    w = Window.partitionBy("bz", "by", "bx")
    low, high = F.min(value).over(w), F.max(value).over(w)
    return keyed.select(*AXES, F.round(1.0 - F.coalesce((F.col(value) - low) / F.nullif(high - low, F.lit(0)), F.lit(0.0)), 6).alias("p"))


def components_of(mask: np.ndarray) -> np.ndarray:
    """Face-connected components of a mask, or of each of a stack, numbered from 1 in order of their first voxel: least labels spread along lines until nothing moves."""
    label = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    while True:
        before = label.copy()
        for axis in range(max(0, label.ndim - 3), label.ndim):
            for flip in (False, True):
                view = np.moveaxis(np.flip(label, axis) if flip else label, axis, 0)
                for i in range(1, len(view)):
                    both = (view[i] > 0) & (view[i - 1] > 0)
                    np.minimum(view[i], view[i - 1], out=view[i], where=both)
        if (label == before).all():
            break
    found = np.unique(label[label > 0])
    return np.where(label > 0, np.searchsorted(found, label) + 1, 0)


@step("seeded-watershed")
def seeded_watershed(boundary: np.ndarray, threshold: float = 0.5, seed_size: int = 4, min_size: int = 0) -> np.ndarray:
    """Floods from components of low boundary values, lowest first; segments below min_size give way to their neighbours."""
    seeds = components_of(boundary <= threshold)
    size = np.bincount(seeds.ravel())
    seeds = np.where(size[seeds] >= seed_size, seeds, 0)

    def flood(label: np.ndarray) -> np.ndarray:
        label, n, queue = label.copy(), 0, []
        for p in zip(*np.nonzero(label), strict=True):
            queue.append((boundary[p], n, p))
            n += 1
        heapq.heapify(queue)
        while queue:
            _, _, p = heapq.heappop(queue)
            for axis in range(3):
                for d in (-1, 1):
                    q = list(p)
                    q[axis] += d
                    q = tuple(q)
                    if 0 <= q[axis] < label.shape[axis] and not label[q]:
                        label[q] = label[p]
                        heapq.heappush(queue, (boundary[q], n, q))
                        n += 1
        return label

    out = flood(seeds)
    size = np.bincount(out.ravel())
    if min_size and (size[1:] < min_size).any() and (size[1:] >= min_size).any():
        out = flood(np.where(size[out] >= min_size, out, 0))
    return out


@step("empty-regions", stacked=True)
def empty_regions(values: np.ndarray, least: int = 100) -> np.ndarray:
    """1 except in components of zeros of at least so many voxels."""
    zero = components_of(values == 0)
    return ~((zero > 0) & (np.bincount(zero.ravel())[zero] >= least))


@step("membranes")
def membranes(values: np.ndarray) -> np.ndarray:
    low, high = values.min(), values.max()
    return 1 - (values - low) / (high - low) if high > low else np.ones_like(values)


@step("gray-only")
def gray_only(values: np.ndarray, threshold: float = 0.2, seed_size: int = 5, least: int = 100) -> np.ndarray:
    """The whole pipeline on grey values alone: large empty regions are masked, dark is membrane, and seeds flood the rest."""
    mask = empty_regions(values, least)
    boundary = np.where(mask, membranes(values), np.inf)
    return np.where(mask, seeded_watershed(np.where(mask, boundary, 2.0), threshold, seed_size), 0)


@step("keep")
def keep(values: np.ndarray) -> np.ndarray:
    """No agglomeration."""
    return values


def preserve_bodies(new: DataFrame, old: DataFrame, bodies: list[int], value: str) -> DataFrame:
    """New labels with chosen bodies of the old labeling pasted back; new labels that clash with those move past the largest."""
    kept = old.where(F.col(value).isin(bodies)).select(*AXES, F.col(value).alias("_kept"))
    top = new.agg(F.greatest(F.max(value), F.lit(max(bodies, default=0))).alias("_top"))
    moved = new.join(F.broadcast(top)).withColumn(value, F.when(F.col(value).isin(bodies), F.col(value) + F.col("_top")).otherwise(F.col(value))).drop("_top")
    return moved.join(kept, list(AXES), "full_outer").select(*AXES, F.coalesce("_kept", value).alias(value))


def faces(df: DataFrame, value: str) -> DataFrame:
    """(label, axis, side, z, y, x): the outer faces of each label's voxels, a quad of the mesh each.

    A voxel's side is inner if the next voxel of its line touches it and has the same label.
    """
    own = df.where(F.col(value) != 0)
    out = None
    for a in AXES:
        w = Window.partitionBy(value, *[o for o in AXES if o != a]).orderBy(a)
        part = own.withColumns({"_next": F.lead(a).over(w) - F.col(a), "_before": F.col(a) - F.lag(a).over(w)})
        sides = F.filter(F.array(F.when(F.coalesce("_before", F.lit(0)) != 1, F.lit(0)), F.when(F.coalesce("_next", F.lit(0)) != 1, F.lit(1))), lambda s: s.isNotNull())
        part = part.select(F.col(value).alias("label"), F.lit(a).alias("axis"), F.explode(sides).alias("side"), *AXES)
        out = part if out is None else out.union(part)
    return out


def face_corners(quads: DataFrame) -> DataFrame:
    """The four corners (vz, vy, vx) of each face."""
    at = lambda a: F.when(F.col("axis") == a, F.col(a) + F.col("side"))
    one, two = F.explode(F.array(F.lit(0), F.lit(1))).alias("i"), F.explode(F.array(F.lit(0), F.lit(1))).alias("j")
    spread = quads.select("*", one).select("*", two)
    vz = F.coalesce(at("z"), F.col("z") + F.col("i"))
    vy = F.coalesce(at("y"), F.col("y") + F.when(F.col("axis") == "z", F.col("i")).otherwise(F.col("j")))
    vx = F.coalesce(at("x"), F.col("x") + F.col("j"))
    return spread.select("label", "axis", "side", "z", "y", "x", vz.alias("vz"), vy.alias("vy"), vx.alias("vx"))


def smoothed(quads: DataFrame) -> DataFrame:
    """(label, vz, vy, vx, sz, sy, sx): each corner moved to the mean of the corners it shares a face with (one round)."""
    # the mean of a face's corners is its middle
    middle = lambda a: F.when(F.col("axis") == a, F.col(a) + F.col("side")).otherwise(F.col(a) + 0.5)
    return face_corners(quads).groupBy("label", "vz", "vy", "vx").agg(*[F.round(F.avg(middle(a)), 4).alias(f"s{a}") for a in AXES])


def _faces_at_corners() -> tuple[np.ndarray, np.ndarray]:
    """(number of faces, their middles' summed offsets z, y, x), by which of the eight voxels around a corner have a label: a bit each, 4 z + 2 y + x."""
    count, offset = np.zeros(256, np.int64), np.zeros((3, 256))
    for mask in range(256):
        for at in np.ndindex(2, 2, 2):
            for axis in range(3):
                other = tuple(1 - c if i == axis else c for i, c in enumerate(at))
                here, there = (mask >> (4 * z + 2 * y + x) & 1 for z, y, x in (at, other))
                if here and not there:
                    count[mask] += 1
                    for i in set(range(3)) - {axis}:
                        offset[i, mask] += at[i] - 0.5
    return count, offset


AT_CORNERS = _faces_at_corners()


def smoothed_corners(df: DataFrame, value: str, block: int = 32) -> DataFrame:
    """smoothed(faces()) of the voxels, by blocks of corners."""
    return _corners(df, value, block, True)


def corners(df: DataFrame, value: str, block: int = 32) -> DataFrame:
    """The different (label, vz, vy, vx) of face_corners(faces()) of the voxels, by blocks of corners."""
    return _corners(df, value, block, False)


def _corners(df: DataFrame, value: str, block: int, smooth: bool) -> DataFrame:
    """A voxel goes to the blocks that its eight corners are in, and no row is made for a face."""
    own = df.where(F.col(value) != 0).select(F.col(value).cast("long").alias("label"), *[F.col(a).cast("long").alias(a) for a in AXES])
    for a in AXES:
        own = own.withColumn(f"b{a}", F.explode(F.array_distinct(F.array(cell(a, block), cell(F.col(a) + 1, block)))))

    def apply(key: tuple, t: pa.Table) -> pa.Table:
        low = [k.as_py() * block for k in key]
        at = [t.column(a).to_numpy() - lo for a, lo in zip(AXES, low, strict=True)]
        names, label = np.unique(t.column("label").to_numpy(), return_inverse=True)
        codes, bits = [], []
        for d in np.ndindex(2, 2, 2):
            c = [v + i for v, i in zip(at, d, strict=True)]
            inner = np.logical_and.reduce([(v >= 0) & (v < block) for v in c])
            codes.append((((label * block + c[0]) * block + c[1]) * block + c[2])[inner])
            bits.append(np.full(len(codes[-1]), 1 << (7 - (4 * d[0] + 2 * d[1] + d[2])), np.uint8))
        code, of = np.unique(np.concatenate(codes), return_inverse=True)
        mask = np.zeros(len(code), np.uint8)
        np.bitwise_or.at(mask, of, np.concatenate(bits))
        count = AT_CORNERS[0][mask]
        code, mask, count = code[count > 0], mask[count > 0], count[count > 0]
        name, *v = np.unravel_index(code, (len(names), block, block, block))
        v = [c + lo for c, lo in zip(v, low, strict=True)]
        if not smooth:
            return pa.table([names[name], *v], names=["label", *(f"v{a}" for a in AXES)])
        # whole numbers of 24ths at most, which have no ties at four decimals
        moved = [np.rint((c * count + AT_CORNERS[1][i, mask]) / count * 1e4) / 1e4 for i, c in enumerate(v)]
        return pa.table([names[name], *v, *moved], names=["label", *(f"v{a}" for a in AXES), *(f"s{a}" for a in AXES)])

    return own.groupBy("bz", "by", "bx").applyInArrow(apply, "label long, vz long, vy long, vx long" + ", sz double, sy double, sx double" * smooth)
