"""Triangle meshes of bodies: welded, simplified by quadric errors, with normals, as obj text.

A mesh is made a chunk at a time: the surface of a body inside one block of voxels. Its corners lie on the lattice, so
chunks of a body fit each other exactly, and what lies on the border of a block is never moved: simplified chunks still
fit. So no body has to meet in one task, however large; normals at shared vertices are sums over all chunks.

Triangles are rows (label, bz, by, bx, a, b, c) of corners (z, y, x) whose order turns counter-clockwise seen from outside.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from voxelith.functions.grid import AXES, cell

CORNER = "struct<z:double,y:double,x:double>"
KEYS = ("label", "bz", "by", "bx")
#: Blocks are meshed by lots, cubes of them at least so wide, as fewer voxels then are copied to the lots beside them.
LOT = 64
#: A collapse may not turn a triangle by more than the angle of this cosine.
LEAST_TURN = 0.2


def corners(axis: str, side: int, z: int, y: int, x: int) -> list[tuple[int, int, int]]:
    """Of a face of the voxel: a, b, c, d around it, counter-clockwise seen from outside."""
    at, k = [z, y, x], AXES.index(axis)
    i, j = (k + 1) % 3, (k + 2) % 3
    at[k] += side
    around = [(0, 0), (1, 0), (1, 1), (0, 1)]
    out = []
    # in the order z, y, x the axes turn the other way than in x, y, z
    for u, v in around if not side else around[::-1]:
        p = list(at)
        p[i] += u
        p[j] += v
        out.append(tuple(p))
    return out


def welded(quads: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, triangles): two triangles a face (axis, side, z, y, x), split from its corner nearest to the origin, and every corner once."""
    axis, side, *at = zip(*quads, strict=True) if quads else ((),) * 5
    return _welded(np.array([AXES.index(a) for a in axis], np.int64), np.array(side, np.int64), np.array(at, np.int64).reshape(3, -1).T)


def _welded(axis: np.ndarray, side: np.ndarray, at: np.ndarray, ordered: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """welded() of arrays; vertices are numbered as they come, or ordered by z, y, x."""
    corner = np.repeat(at[:, None, :], 4, axis=1)
    rows = np.arange(len(at))
    corner[rows, :, axis] += side[:, None]
    # around the face from its least corner, the other way on the other side
    one, two = np.array([0, 1, 1, 0]), np.array([0, 0, 1, 1])
    corner[rows, :, (axis + 1) % 3] += np.where(side[:, None] == 0, one, two)
    corner[rows, :, (axis + 2) % 3] += np.where(side[:, None] == 0, two, one)
    flat = corner.reshape(-1, 3)
    low = at.min(axis=0, initial=0)
    size = at.max(axis=0, initial=0) - low + 2
    key = (flat[:, 0] - low[0]) * (size[1] * size[2]) + (flat[:, 1] - low[1]) * size[2] + (flat[:, 2] - low[2])
    if ordered:
        keys, face = np.unique(key, return_inverse=True)
        return np.stack(np.unravel_index(keys, size), axis=1) + low.astype(float), face.reshape(-1, 4)[:, [0, 1, 2, 0, 2, 3]].reshape(-1, 3)
    _, first, back = np.unique(key, return_index=True, return_inverse=True)
    order = np.argsort(first)
    number = np.empty(len(first), np.int64)
    number[order] = np.arange(len(first))
    face = number[back].reshape(-1, 4)
    return flat[first[order]].astype(float), face[:, [0, 1, 2, 0, 2, 3]].reshape(-1, 3)


def areas(v: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Of each triangle the vector of its normal, as long as twice its area; x, y, z turn in that order, so z, y, x the other way."""
    return -np.cross(v[t[:, 1]] - v[t[:, 0]], v[t[:, 2]] - v[t[:, 0]])


def simplified(v: np.ndarray, t: np.ndarray, locked: np.ndarray, error: float, share: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, triangles) after edges are collapsed, the least quadric error first, while that is at most error squared and more than a share of the triangles is left.

    A locked vertex stays; so does one whose neighbourhood is no disc. A collapse may not turn a triangle over, nor close
    anything but the two triangles at the edge, so a closed surface stays closed.
    """
    v, alive = v.copy(), np.ones(len(t), bool)
    triangles = [tuple(x) for x in t.tolist()]
    of: list[set[int]] = [set() for _ in v]
    for i, tri in enumerate(triangles):
        for p in tri:
            of[p].add(i)
    normal = areas(v, t)
    length = np.linalg.norm(normal, axis=1, keepdims=True)
    unit = np.divide(normal, length, out=np.zeros_like(normal), where=length > 0)
    plane = np.concatenate([unit, -(unit * v[t[:, 0]]).sum(axis=1, keepdims=True)], axis=1)
    quadric = np.zeros((len(v), 4, 4))
    for k in range(3):
        np.add.at(quadric, t[:, k], plane[:, :, None] * plane[:, None, :])
    around = lambda p: {q for i in of[p] for q in triangles[i]} - {p}
    # on a disc, each neighbour is in two of the triangles
    whole = lambda p: all(sum(q in triangles[i] for i in of[p]) == 2 for q in around(p)) and len(around(p)) == len(of[p])
    fixed = [bool(locked[p]) or not whole(p) for p in range(len(v))]
    version = [0] * len(v)

    def proposal(p: int, q: int) -> tuple | None:
        """To which place an edge collapses: an end that is fixed, else the better one of both ends and the middle."""
        if fixed[p] and fixed[q]:
            return None
        both = quadric[p] + quadric[q]
        places = [v[p]] if fixed[p] else [v[q]] if fixed[q] else [v[p], v[q], (v[p] + v[q]) / 2]
        cost, k = min((max(0.0, float(h @ both @ h)), k) for k, h in enumerate(np.r_[x, 1.0] for x in places))
        return (cost, p, q, version[p], version[q], tuple(places[k])) if cost <= error * error else None

    heap = [x for p in range(len(v)) for q in around(p) if p < q and (x := proposal(p, q))]
    heapq.heapify(heap)
    left, least = len(triangles), share * len(triangles)
    while heap and left > least:
        _, p, q, at_p, at_q, place = heapq.heappop(heap)
        if version[p] != at_p or version[q] != at_q or not of[p] or not of[q]:
            continue
        if fixed[q]:
            p, q = q, p
        gone = of[p] & of[q]
        if len(gone) != 2 or len(around(p) & around(q)) != 2:
            continue
        new, ok = np.array(place), True
        for r, others in ((p, of[p] - gone), (q, of[q] - gone)):
            for i in others:
                before = v[list(triangles[i])]
                after = np.array([new if x == r else v[x] for x in triangles[i]])
                n, m = np.cross(before[1] - before[0], before[2] - before[0]), np.cross(after[1] - after[0], after[2] - after[0])
                size = np.linalg.norm(n) * np.linalg.norm(m)
                ok = ok and size > 1e-12 and float(n @ m) > LEAST_TURN * size
        if not ok:
            continue
        for i in gone:
            alive[i] = False
            for x in triangles[i]:
                of[x].discard(i)
        for i in of[q]:
            triangles[i] = tuple(p if x == q else x for x in triangles[i])
        of[p] |= of[q]
        of[q] = set()
        v[p], quadric[p], left = new, quadric[p] + quadric[q], left - 2
        version[p] += 1
        version[q] += 1
        for r in around(p):
            if x := proposal(min(p, r), max(p, r)):
                heapq.heappush(heap, x)
    kept = np.array([tri for tri, ok in zip(triangles, alive, strict=True) if ok], np.int64).reshape(-1, 3)
    used, back = np.unique(kept, return_inverse=True)
    return v[used], back.reshape(-1, 3)


def _lots(df: DataFrame, label: str, lot: int) -> GroupedData:
    """Voxels of all bodies but 0 by lots (gz, gy, gx), each with the voxels that touch it from outside."""
    own = df.where(F.col(label) != 0).select(F.col(label).cast("long").alias("label"), *[F.col(a).cast("long").alias(a) for a in AXES])
    for a in AXES:
        own = own.withColumn(f"g{a}", F.explode(F.array_distinct(F.array(cell(F.col(a) - 1, lot), cell(a, lot), cell(F.col(a) + 1, lot)))))
    return own.groupBy("gz", "gy", "gx")


def _chunks(t: pa.Table, low: np.ndarray, lot: int, block: int, error: float | None, share: float, ordered: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(label, block, vertices, triangles) of each body in each block of a lot that begins at `low`."""
    at = np.stack([t.column(a).to_numpy() for a in AXES], axis=1) - low + 1
    names, label = np.unique(t.column("label").to_numpy(), return_inverse=True)
    # a voxel's number; the next one of its label on an axis is a fixed step away, as the lot has a margin
    shape = (len(names), *(lot + 2,) * 3)
    number = np.unique(np.ravel_multi_index((label, *at.T), shape))
    label, *at = np.unravel_index(number, shape)
    at = np.stack(at, axis=1) - 1
    own = ((at >= 0) & (at < lot)).all(axis=1)
    rows, axes, sides = [], [], []
    for k in (2, 1, 0):  # x, y, z by name
        step = (lot + 2) ** (2 - k)
        after = np.searchsorted(number, number + step)
        after[after == len(number)] = 0
        touched = number[after] == number + step
        before = np.zeros(len(number), bool)
        before[after[touched]] = True
        for side, inner in enumerate((before, touched)):
            rows.append(np.flatnonzero(own & ~inner))
            axes.append(np.full(len(rows[-1]), k))
            sides.append(np.full(len(rows[-1]), side))
    row, axis, side = np.concatenate(rows), np.concatenate(axes), np.concatenate(sides)
    per = lot // block
    chunk = np.ravel_multi_index((label[row], *(at[row] // block).T), (len(names), per, per, per))
    order = np.argsort(chunk, kind="stable")
    row, axis, side, chunk = row[order], axis[order], side[order], chunk[order]
    starts = np.flatnonzero(np.diff(chunk, prepend=-1))
    for i, j in zip(starts, np.append(starts, len(chunk))[1:], strict=True):
        name, *b = np.unravel_index(chunk[i], (len(names), per, per, per))
        v, tri = _welded(axis[i:j], side[i:j], at[row[i:j]] + low, ordered and error is None)
        first = low + np.array(b) * block
        if error is not None:
            v, tri = simplified(v, tri, ((v <= first) | (v >= first + block)).any(axis=1), error, share)
            if ordered:
                v, tri = _ordered(v, tri)
        yield int(names[name]), first // block, v, tri


def _ordered(v: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A mesh with each place once, by z, y, x."""
    order = np.lexsort(v.T[::-1])
    v = v[order]
    new = np.r_[True, (v[1:] != v[:-1]).any(axis=1)][: len(v)]
    number = np.empty(len(v), np.int64)
    number[order] = np.cumsum(new) - 1
    return v[new], number[t]


def _points(at: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(at[:, i]) for i in range(3)], names=list(AXES))


def triangles(df: DataFrame, label: str, block: int = 64, error: float | None = None, share: float = 0.0) -> DataFrame:
    """(label, bz, by, bx, a, b, c) of the surfaces of all bodies but 0, by blocks of voxels; with an error simplified up to it, in voxels, with vertices on borders of blocks in place."""
    lot = block * max(1, LOT // block)

    def apply(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.array([k.as_py() * lot for k in key])
        for name, b, v, t in _chunks(pa.Table.from_batches(batches), low, lot, block, error, share):
            yield pa.record_batch({**{n: pa.repeat(pa.scalar(int(k), pa.int64()), len(t)) for n, k in zip(KEYS, (name, *b), strict=True)}, **{p: _points(v[t[:, k]]) for k, p in enumerate("abc")}})

    return _lots(df, label, lot).applyInArrow(apply, f"label long, bz long, by long, bx long, a {CORNER}, b {CORNER}, c {CORNER}")


def _unmet(t: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(p, q, way): of a mesh of n vertices the edges, p before q, that as many triangles don't run both ways, and how many more run from p to q."""
    p, q = t.ravel(), t[:, [1, 2, 0]].ravel()
    code = np.sort((np.minimum(p, q) * n + np.maximum(p, q)) * 2 + (p < q))
    edge = code >> 1
    first = np.flatnonzero(np.diff(edge, prepend=-1))
    way = np.add.reduceat(2 * (code & 1) - 1, first)
    edge, way = edge[first][way != 0], way[way != 0]
    return edge // n, edge % n, way


def _summed(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows and the sum of their n."""
    order = np.lexsort(rows.T[::-1])
    rows, n = rows[order], n[order]
    first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)][: len(rows)])
    return rows[first], np.add.reduceat(n, first) if len(n) else n


def mesh_summary(df: DataFrame, label: str, block: int = 64, error: float | None = None, share: float = 0.0) -> DataFrame:
    """summary() of triangles(), which are counted in the task that makes them. Of a lot of blocks only vertices on its borders and edges that are not met in it become rows."""
    lot = block * max(1, LOT // block)
    point = pa.struct([(a, pa.float64()) for a in AXES])
    parts = pa.schema([("label", pa.int64()), ("a", point), ("b", point), ("way", pa.int64()), ("triangles", pa.int64()), ("six", pa.float64()), ("inner", pa.int64())])

    def apply(key: tuple, table: pa.Table) -> pa.Table:
        low = np.array([k.as_py() * lot for k in key])
        names: dict[int, int] = {}
        sums, points, edges = [], [np.empty((0, 4))], [np.empty((0, 8))]
        for name, b, v, t in _chunks(table, low, lot, block, error, share, True):
            k = names.setdefault(name, len(names))
            first = b * block
            border = ((v <= first) | (v >= first + block)).any(axis=1)
            points.append(np.c_[np.full(border.sum(), k), v[border]])
            p, q, way = _unmet(t, len(v))
            edges.append(np.c_[np.full(len(p), k), v[p], v[q], way])
            sums.append((k, len(t), float((v[t[:, 0]] * areas(v, t)).sum()), len(v) - int(border.sum())))
        # blocks of the lot share some of them
        at, _ = _summed(p := np.concatenate(points), np.ones(len(p)))
        outer = ((at[:, 1:] <= low) | (at[:, 1:] >= low + lot)).any(axis=1)
        sums += [(int(k), 0, 0.0, int(n)) for k, n in enumerate(np.bincount(at[~outer, 0].astype(int), minlength=len(names)))]
        at = at[outer]
        edge, way = _summed((e := np.concatenate(edges))[:, :7], e[:, 7])
        edge, way = edge[way != 0], way[way != 0].astype(np.int64)
        of = np.array(list(names), np.int64)
        k, n, six, inner = np.array(sums).reshape(-1, 4).T

        def part(k: np.ndarray, **columns) -> pa.Table:
            label = pa.array(of[k.astype(int)])
            return pa.table([label if f.name == "label" else columns.get(f.name, pa.nulls(len(label), f.type)) for f in parts], schema=parts)

        return pa.concat_tables([part(k, triangles=n.astype(int), six=six, inner=inner.astype(int)), part(at[:, 0], a=_points(at[:, 1:])), part(edge[:, 0], a=_points(edge[:, 1:4]), b=_points(edge[:, 4:]), way=way)])

    rows = _lots(df, label, lot).applyInArrow(apply, f"label long, a {CORNER}, b {CORNER}, way long, triangles long, six double, inner long")
    # a row without a is a sum over a lot, one without b a vertex, others are edges
    once = rows.groupBy("label", "a", "b").agg(*[F.sum(c).alias(c) for c in ("way", "triangles", "six", "inner")])
    return once.groupBy("label").agg(
        F.sum("triangles").alias("triangles"), (F.sum("inner") + F.count(F.when(F.col("b").isNull(), F.col("a")))).alias("vertices"),
        F.round(F.sum("six") / 6, 6).alias("volume"), F.coalesce(F.sum(F.abs("way")), F.lit(0)).alias("open"),
    )


def _normal() -> dict[str, F.Column]:
    d = lambda p, k: F.col(f"{p}.{k}") - F.col(f"a.{k}")
    turn = lambda i, j: d("b", j) * d("c", i) - d("b", i) * d("c", j)
    return {"nz": turn("y", "x"), "ny": turn("x", "z"), "nx": turn("z", "y")}


def summary(mesh: DataFrame) -> DataFrame:
    """(label, triangles, vertices, volume, open): of each body; open counts edges that are not met by one that runs the other way."""
    det = sum(F.col(f"a.{k}") * n for k, n in zip(AXES, _normal().values(), strict=True))
    sums = mesh.groupBy("label").agg(F.count("*").alias("triangles"), F.round(F.sum(det) / 6, 6).alias("volume"))
    points = mesh.select("label", F.explode(F.array("a", "b", "c")).alias("p")).distinct().groupBy("label").agg(F.count("*").alias("vertices"))
    ends = mesh.select("label", F.explode(F.array(*[F.struct(F.col(p).alias("p"), F.col(q).alias("q")) for p, q in ("ab", "bc", "ca")])).alias("e")).select("label", F.least("e.p", "e.q").alias("p"), F.greatest("e.p", "e.q").alias("q"), F.when(F.col("e.p") < F.col("e.q"), 1).otherwise(-1).alias("way"))
    unmet = ends.groupBy("label", "p", "q").agg(F.abs(F.sum("way")).alias("way")).groupBy("label").agg(F.sum("way").alias("open"))
    return sums.join(points, "label").join(unmet, "label").select("label", "triangles", "vertices", "volume", "open")


def normals(mesh: DataFrame) -> DataFrame:
    """(label, z, y, x, nz, ny, nx): at each vertex of a body the sum of its triangles' normals, each as long as twice the area, over all chunks."""
    spread = mesh.withColumns(_normal()).select("label", F.explode(F.array("a", "b", "c")).alias("p"), "nz", "ny", "nx")
    return spread.groupBy("label", "p").agg(*[F.sum(f"n{a}").alias(f"n{a}") for a in AXES]).select("label", *[F.col(f"p.{a}").alias(a) for a in AXES], *[f"n{a}" for a in AXES])


def obj(v: np.ndarray, t: np.ndarray) -> bytes:
    """Vertices with unit normals, x first, and triangles by number from 1."""
    n = np.zeros_like(v)
    for k in range(3):
        np.add.at(n, t[:, k], areas(v, t))
    size = np.linalg.norm(n, axis=1, keepdims=True)
    n = np.divide(n, size, out=np.zeros_like(n), where=size > 0)
    line = lambda kind, p: f"{kind} {p[2]:.7g} {p[1]:.7g} {p[0]:.7g}"
    return "\n".join([*(line("v", p) for p in v), *(line("vn", p) for p in n), *("f " + " ".join(f"{i + 1}//{i + 1}" for i in x) for x in t)]).encode() + b"\n"


def obj_chunks(mesh: DataFrame) -> DataFrame:
    """(label, bz, by, bx, content): each chunk as obj text."""

    def text(key: tuple, table: pa.Table) -> pa.Table:
        corner = [np.stack([np.asarray(table.column(c).combine_chunks().field(a)) for a in AXES], axis=1) for c in "abc"]
        v, back = np.unique(np.concatenate(corner), axis=0, return_inverse=True)
        return pa.table({**{n: [k.as_py()] for n, k in zip(KEYS, key, strict=True)}, "content": pa.array([obj(v, back.reshape(3, -1).T)], pa.binary())})

    return mesh.groupBy(*KEYS).applyInArrow(text, "label long, bz long, by long, bx long, content binary")
