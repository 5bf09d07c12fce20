"""Merge graphs, region adjacency, components of voxels, stitching and comparison of mappings."""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxelith.functions.grid import AXES
from voxelith.functions.numbers import running
from voxelith.operators.components import components, contracted_components
from voxelith.sources.scratch import Scratch

#: First identifier of bodies that come from splits.
SPLIT_BASE = 1 << 51


#: Edges up to which one task finds the components.
SMALL_GRAPH = 100_000


def normalised_edges(df: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """The smaller end first, repeated edges once."""
    return df.select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v"), *[c for c in df.columns if c not in (u, v)]).dropDuplicates(["u", "v"])


def mapping_from_edges(edges: DataFrame, keep_identities: bool = True) -> DataFrame:
    """(label, body): the body is the smallest label of its component."""
    found = contracted_components(edges.select(F.col("u").cast("long"), F.col("v").cast("long")), Scratch(edges.sparkSession, "cc"), SMALL_GRAPH).toDF("label", "body")
    return found if keep_identities else found.where("label <> body")


#: Labels of one row of groups(): a body's labels of one range of names.
SPAN = 100_000


def groups(mapping: DataFrame, span: int = SPAN) -> DataFrame:
    """(body, part, members), members in order. A row has the labels from part * span on, so many at most, as the largest body doesn't have to fit one row."""
    return mapping.groupBy("body", F.floor(F.col("label") / span).cast("long").alias("part")).agg(F.sort_array(F.collect_set("label")).alias("members"))


def mapping_from_groups(grouped: DataFrame) -> DataFrame:
    return grouped.select(F.explode("members").alias("label"), "body")


def member_texts(grouped: DataFrame) -> DataFrame:
    """(body, n, members) of groups(): a row for each body, with all its labels in order as a text. Rows of a body meet as texts, so what is held is about as long as the result."""
    texts = grouped.select("body", "part", F.size("members").cast("long").alias("n"), F.array_join(F.col("members").cast("array<string>"), ",").alias("text"))
    parts = F.array_sort(F.collect_list(F.struct("part", "text")))
    return texts.groupBy("body").agg(F.sum("n").alias("n"), F.array_join(parts.getField("text"), ",").alias("members"))


def degrees(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


def leaves(edges: DataFrame) -> DataFrame:
    return degrees(edges).where("degree = 1").select("node")


def erode_leaves(edges: DataFrame, rounds: int) -> DataFrame:
    """Without the edges that touch a leaf, so many times, each time of the edges that remain."""
    for _ in range(rounds):
        ends = leaves(edges)
        edges = edges.join(ends.select(F.col("node").alias("u")), "u", "left_anti").join(ends.select(F.col("node").alias("v")), "v", "left_anti").select("u", "v")
    return edges


def edges_of(edges: DataFrame, mapping: DataFrame, label: int) -> DataFrame:
    """The edges of the component that holds a label."""
    body = mapping.where(F.col("label") == label).select("body")
    members = mapping.join(body, "body", "left_semi").select(F.col("label").alias("u"))
    return edges.join(members, "u", "left_semi").select("u", "v")


def compare_mappings(old: DataFrame, new: DataFrame) -> DataFrame:
    """(body, change) of bodies dropped, added, of another size, or of the same size with other members. Members are matched, not gathered."""
    side = lambda m, n: m.select("body", "label", F.lit(1).alias(n))
    both = side(old, "a").join(side(new, "b"), ["body", "label"], "full_outer")
    sums = both.groupBy("body").agg(F.count("a").alias("a"), F.count("b").alias("b"), F.count(F.col("a") + F.col("b")).alias("shared"))
    change = F.when(F.col("b") == 0, "dropped").when(F.col("a") == 0, "added").when(F.col("a") != F.col("b"), "size").when(F.col("shared") != F.col("a"), "content")
    return sums.select("body", change.alias("change")).where("change IS NOT NULL")


def comparison_table(old: DataFrame, new: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """(sv, old, new, both, size): the component of each supervoxel in two merge graphs and in that of their common edges.

    Supervoxels without an edge are alone; sizes: (sv, size), 0 where it has none.
    """
    common = old.select("u", "v").intersect(new.select("u", "v"))
    svs = reduce(DataFrame.union, [e.select(F.explode(F.array("u", "v")).alias("sv")) for e in (old, new)]).distinct()
    out = svs
    for name, e in (("old", old), ("new", new), ("both", common)):
        out = out.join(mapping_from_edges(e).toDF("sv", name), "sv", "left").withColumn(name, F.coalesce(name, "sv"))
    if sizes is None:
        return out.withColumn("size", F.lit(1).cast("long"))
    return out.join(sizes, "sv", "left").withColumn("size", F.coalesce("size", F.lit(0)).cast("long"))


def component_table(table: DataFrame) -> DataFrame:
    """(both, old, new, voxels) of each common component."""
    return table.groupBy("both").agg(F.min("old").alias("old"), F.min("new").alias("new"), F.sum("size").alias("voxels"))


def split_merge_stats(parts: DataFrame) -> DataFrame:
    """(kind, body, n_components, voxels, largest, remaining): old bodies in several parts (splits), new ones made of several (merges)."""
    side = lambda kind, body: parts.groupBy(F.col(body).alias("body")).agg(F.count("*").alias("n_components"), F.sum("voxels").alias("voxels"), F.max("voxels").alias("largest")).where("n_components > 1").select(F.lit(kind).alias("kind"), "*", (F.col("voxels") - F.col("largest")).alias("remaining"))
    return side("split", "old").union(side("merge", "new"))


def size_buckets(df: DataFrame, size: str, bounds: tuple[int, ...]) -> DataFrame:
    """(bucket, bodies, voxels): up to the first bound, then from each bound to below the next, then all. A size equal to the first bound counts in both, as the published table has it."""
    parts = [("0", F.col(size) <= bounds[0])]
    parts += [(str(a), (F.col(size) >= a) & (F.col(size) < b)) for a, b in zip(bounds, bounds[1:], strict=False)]
    parts += [(str(bounds[-1]), F.col(size) >= bounds[-1]), ("total", F.lit(True))]
    row = F.explode(F.array(*[F.struct(F.lit(n).alias("bucket"), ok.alias("ok")) for n, ok in parts]))
    spread = df.select(F.col(size).alias("_s"), row.alias("r")).groupBy("r.bucket").agg(F.sum(F.col("r.ok").cast("long")).alias("bodies"), F.coalesce(F.sum(F.when(F.col("r.ok"), F.col("_s"))), F.lit(0)).alias("voxels"))
    return spread


def contacts(df: DataFrame, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """(u, v, axis): each pair of voxels that share a face and differ in label, background left out; with keys of one subvolume.

    The neighbour on an axis is the next voxel of its line, so a window along the line finds it without a self-join.
    """
    own = df.where(F.col(value) != 0)
    out = None
    for a in AXES:
        w = Window.partitionBy(*keys, *[o for o in AXES if o != a]).orderBy(a)
        part = own.select(F.col(value).alias("p"), F.lead(value).over(w).alias("q"), (F.lead(a).over(w) - F.col(a)).alias("d")).where("d = 1 AND p <> q")
        part = part.select(F.least("p", "q").alias("u"), F.greatest("p", "q").alias("v"), F.lit(a).alias("axis"))
        out = part if out is None else out.union(part)
    return out


def rag_edges(df: DataFrame, value: str) -> DataFrame:
    return contacts(df, value).groupBy("u", "v").agg(F.count("*").alias("weight"))


def rag_vertices(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col(value) != 0).groupBy(F.col(value).alias("id")).agg(F.count("*").alias("size"))


def edge_features(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with the sizes of both ends, null where a node is missing."""
    return edges.join(nodes.toDF("u", "u_size"), "u", "left").join(nodes.toDF("v", "v_size"), "v", "left").select("u", "v", "weight", "u_size", "v_size")


def voxel_id(shape: tuple[int, int, int]):
    return (F.col("z") * shape[1] + F.col("y")) * shape[2] + F.col("x")


def _in_block(values: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least id of each face-connected component of equal values; ids spread along lines until nothing moves."""
    least = np.where(values != 0, ids, 0)
    while True:
        before = least.copy()
        for axis in range(3):
            for flip in (False, True):
                view, value = (np.moveaxis(np.flip(x, axis) if flip else x, axis, 0) for x in (least, values))
                for i in range(1, len(view)):
                    np.minimum(view[i], view[i - 1], out=view[i], where=(value[i] == value[i - 1]) & (value[i] != 0))
        if (least == before).all():
            return least


def connected_voxels(df: DataFrame, value: str, shape: tuple[int, int, int], keys: tuple[str, ...] = (), block: int = 32) -> DataFrame:
    """With the component (its smallest voxel's number) of face-connected voxels of equal label, within the keys; 0 is left out.

    Components are found within blocks first; after that only the faces between blocks count, and the graph has a node
    for each component of a block, not for each voxel.
    """
    own = df.where(F.col(value) != 0)
    cell = [f"_{a}" for a in AXES]
    numbered = own.withColumn("_id", voxel_id(shape)).withColumns({f"_{a}": F.floor(F.col(a) / block).cast("long") for a in AXES})

    def inner(table: pa.Table) -> pa.Table:
        at = [table.column(a).to_numpy() for a in AXES]
        place = tuple(a - a.min() for a in at)
        values, ids = (np.zeros([int(p.max()) + 1 for p in place], np.int64) for _ in range(2))
        values[place], ids[place] = table.column(value).to_numpy(), table.column("_id").to_numpy()
        return table.append_column("_part", pa.array(_in_block(values, ids)[place]))

    schema = T.StructType([*[T.StructField(f.name, T.LongType()) if f.name == value else f for f in numbered.schema], T.StructField("_part", T.LongType())])
    scratch = Scratch(df.sparkSession, "voxels")
    parts = scratch.store(numbered.withColumn(value, F.col(value).cast("long")).groupBy(*keys, *cell).applyInArrow(inner, schema))
    pairs = None
    for a in AXES:
        w = Window.partitionBy(*keys, value, *[o for o in AXES if o != a]).orderBy(a)
        edge = parts.where((F.pmod(a, F.lit(block)) == 0) | (F.pmod(a, F.lit(block)) == block - 1))
        met = edge.select(F.col("_part").alias("u"), F.lead("_part").over(w).alias("v"), (F.lead(a).over(w) - F.col(a)).alias("d")).where("d = 1 AND u <> v").select("u", "v").distinct()
        pairs = met if pairs is None else pairs.union(met)
    found = components(pairs, scratch, SMALL_GRAPH).toDF("_part", "component")
    return parts.join(found, "_part", "left").withColumn("component", F.coalesce("component", "_part")).drop("_id", "_part", *cell)


def split_disconnected(df: DataFrame, value: str, shape: tuple[int, int, int], base: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(voxels with their part, parts (part, label, size)): the largest part of a label keeps it (the first among equals), the others get new labels.

    New labels go on after the largest one, or from `base` (SPLIT_BASE keeps clear of labels that are made elsewhere).
    """
    parts = connected_voxels(df, value, shape)
    sizes = parts.groupBy(value, "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy(value).agg(F.max(F.struct("size", (-F.col("component")).alias("_minus"))).alias("_l")).select(value, (-F.col("_l._minus")).alias("_kept"))
    top = sizes.agg((F.max(value) + 1).alias("_top")) if base is None else df.sparkSession.range(1).select(F.lit(base).alias("_top"))
    ranked = sizes.join(largest, value)
    moved = ranked.where("component <> _kept").withColumn("_span", F.floor(F.col("component") / SPAN).cast("long"))
    # numbers go by ranges of components, as a label can have very many parts
    spans = moved.groupBy(value, "_span").agg(F.count("*").alias("_k"))
    before = F.coalesce(F.sum("_k").over(Window.partitionBy(value).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = running(moved.groupBy(value).agg(F.count("*").alias("_k")), value, "_k", "_before").select(value, "_before")
    starts = spans.withColumn("_inner", before).join(starts, value).select(value, "_span", (F.col("_before") + F.col("_inner")).alias("_start"))
    within = F.row_number().over(Window.partitionBy(value, "_span").orderBy("component")) - 1
    moved = moved.withColumn("_n", within).join(starts, [value, "_span"]).join(F.broadcast(top)).select(value, "component", (F.col("_top") + F.col("_start") + F.col("_n")).alias("part"), "size")
    kept = ranked.where("component = _kept").select(value, "component", F.col(value).alias("part"), "size")
    names = kept.union(moved)
    voxels = parts.join(names.select(value, "component", "part"), [value, "component"]).select(*AXES, value, "part")
    return voxels, names.select("part", F.col(value).alias("label"), "size")


def stitch_offsets(df: DataFrame, value: str, sv: str = "sv") -> DataFrame:
    """(sv, offset): what to add to a subvolume's labels so that they are unique overall. Subvolumes are numbered by whole numbers."""
    return running(df.groupBy(sv).agg(F.max(value).alias("_top")), sv, "_top", "offset").select(sv, F.col("offset").cast("long").alias("offset"))


def overlap_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """(u, v, n): labels of two subvolumes' voxels at the same place; (z, y, x, label) each, background left out."""
    both = left.where("label <> 0").select(*AXES, F.col("label").alias("u")).join(right.where("label <> 0").select(*AXES, F.col("label").alias("v")), list(AXES))
    return both.groupBy("u", "v").agg(F.count("*").alias("n"))


def stitch_pairs(counts: DataFrame, mode: str, least: int = 50, share: float = 0.9, liberal: int = 1000) -> DataFrame:
    """(u, v): which overlapping labels are the same body.

    Each side's candidate is the other side's label of the largest overlap, above `least`. `simple` takes every overlap.
    `medium` asks that each is the other's candidate; `conservative` also that the overlap is `share` of either's
    total; `aggressive` takes a one-sided candidate if it has more than that share and more than `liberal` voxels.
    """
    if mode == "none":
        return counts.where(F.lit(False)).select("u", "v")
    if mode == "simple":
        return counts.select("u", "v")
    sized = counts.withColumns({"u_total": F.sum("n").over(Window.partitionBy("u")), "v_total": F.sum("n").over(Window.partitionBy("v"))})
    first = lambda own, other: F.row_number().over(Window.partitionBy(own).orderBy(F.desc("n"), other)) == 1
    best = sized.withColumns({"u_best": first("u", "v"), "v_best": first("v", "u")}).where(F.col("n") > least)
    mutual = F.col("u_best") & F.col("v_best")
    if mode == "conservative":
        mutual = mutual & (F.col("n") / F.col("u_total") >= share) & (F.col("n") / F.col("v_total") >= share)
    if mode == "aggressive":
        alone = lambda side: F.col(f"{side}_best") & (F.col("n") / F.col(f"{side}_total") > share) & (F.col("n") > liberal)
        mutual = mutual | alone("u") | alone("v")
    return best.where(mutual).select("u", "v")


def on_plane(df: DataFrame, value: str, axis: str, plane: int) -> DataFrame:
    """(label) with a voxel on a plane: of two subvolumes that touch along an axis, only labels on the centre plane of what they share are stitched."""
    return df.where((F.col(axis) == plane) & (F.col(value) != 0)).select(F.col(value).alias("label")).distinct()


def eligible(counts: DataFrame, left: DataFrame | None = None, right: DataFrame | None = None, preserved: list[int] | None = None) -> DataFrame:
    """counts (u, v, n) of labels that may be stitched: listed on their side (label), and no body that is preserved."""
    out = counts
    for side, labels in (("u", left), ("v", right)):
        out = out if labels is None else out.join(labels.select(F.col("label").alias(side)), side, "left_semi")
    return out.select("u", "v", "n") if not preserved else out.where(~F.col("u").isin(preserved) & ~F.col("v").isin(preserved)).select("u", "v", "n")


def stitched(df: DataFrame, value: str, pairs: DataFrame) -> DataFrame:
    """Labels merged over all pairs, each by the smallest of its component."""
    named = mapping_from_edges(pairs)
    return df.join(named.toDF(value, "_body"), value, "left").withColumn(value, F.coalesce("_body", value)).drop("_body")


def assignment(value: dict[int, dict[int, int]]) -> dict[int, int]:
    """Each left node's right one, so that no right node is taken twice and the sum of values is the largest; a left node may go without.

    Shortest augmenting paths over the pairs that there are, with potentials: a path ends at the first free right node,
    or where some left node on it is better off without.
    """
    u = {i: -max(row.values(), default=0) for i, row in value.items()}
    v: dict[int, int] = {}
    left_of: dict[int, int] = {}
    right_of: dict[int, int] = {}
    for start in value:
        far, before, done, queue, i, so_far = {}, {}, {}, [], start, 0
        seen = {start: 0}
        best, single = -u[start], start  # the cost of leaving a node of the path single
        end = None
        while True:
            for j, gain in value[i].items():
                if j not in done:
                    d = so_far - gain - u[i] - v.get(j, 0)
                    if d < far.get(j, float("inf")):
                        far[j], before[j] = d, i
                        heapq.heappush(queue, (d, j))
            while queue and (queue[0][1] in done or queue[0][0] > far[queue[0][1]]):
                heapq.heappop(queue)
            if not queue or queue[0][0] >= best:
                so_far = best
                break
            so_far, j = heapq.heappop(queue)
            done[j] = so_far
            if j not in left_of:
                end = j
                break
            i = left_of[j]
            seen[i] = so_far
            if so_far - u[i] < best:
                best, single = so_far - u[i], i
        for i, d in seen.items():
            u[i] += so_far - d
        for j, d in done.items():
            v[j] = v.get(j, 0) - (so_far - d)
        if end is None:  # the node goes without, and those before it on the path move up
            end = right_of.pop(single, None)
            if end is None:
                continue
        while True:
            i = before[end]
            left_of[end] = i
            end, right_of[i] = right_of.get(i), end
            if i == start:
                break
    return right_of


def connections(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """(pre, post) point pairs with the labels of both ends. points: (point_id, gt, seg)."""
    ends = lambda side: points.select(F.col("point_id").alias(side), F.col("gt").alias(f"{side}_gt"), F.col("seg").alias(f"{side}_seg"))
    return pairs.join(ends("pre"), "pre").join(ends("post"), "post")


def connectivity(conns: DataFrame, matches: DataFrame) -> DataFrame:
    """(pre_gt, post_gt, n, matched): connections between matched bodies, and how many of them the other labeling has too."""
    m = matches.where("seg <> 0").select("gt", "seg")
    one = m.toDF("pre_gt", "pre_match")
    two = m.toDF("post_gt", "post_match")
    hit = (F.col("pre_seg") == F.col("pre_match")) & (F.col("post_seg") == F.col("post_match"))
    return conns.join(one, "pre_gt").join(two, "post_gt").groupBy("pre_gt", "post_gt").agg(F.count("*").alias("n"), F.sum(hit.cast("long")).alias("matched"))


def connectivity_summary(table: DataFrame, conns: DataFrame, thresholds: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """(threshold, recall, precision): of connections with at least so many synapses."""
    seg = conns.where("pre_seg <> 0 AND post_seg <> 0").groupBy("pre_seg", "post_seg").agg(F.count("*").alias("n"))
    t = F.explode(F.array(*[F.lit(x) for x in thresholds])).alias("threshold")
    found = seg.select(t, "n").groupBy("threshold").agg(F.sum((F.col("n") >= F.col("threshold")).cast("long")).alias("seg_pairs"))
    of = table.select(t, "n", "matched").groupBy("threshold").agg(F.sum((F.col("n") >= F.col("threshold")).cast("long")).alias("gt_pairs"), F.sum(((F.col("n") >= F.col("threshold")) & (F.col("matched") >= F.col("threshold"))).cast("long")).alias("both"))
    share = lambda of: F.when(F.col(of) > 0, F.round(F.col("both") / F.col(of), 4)).otherwise(F.lit(0.0))
    return of.join(found, "threshold").select("threshold", share("gt_pairs").alias("recall"), share("seg_pairs").alias("precision"))


def autapses(conns: DataFrame) -> DataFrame:
    """(gt, seg, diff): connections of a body with itself in either labeling."""
    own = lambda s: F.sum(((F.col(f"pre_{s}") == F.col(f"post_{s}")) & (F.col(f"pre_{s}") != 0)).cast("long"))
    return conns.agg(own("gt").alias("gt"), own("seg").alias("seg")).withColumn("diff", F.col("seg") - F.col("gt"))


def edit_distance(ops: DataFrame, total: int, percents: tuple[int, ...] = (50, 75, 90), split_cost: int = 5) -> DataFrame:
    """(percent, splits, merges): operations until that share of what lies wrong is right, the most useful first; a split counts a fifth.

    Operations of one kind and size are alike, so the running sum goes over the distinct sizes, of which there are few; of
    the one at which a share is reached so many are taken as it needs.
    """
    runs = ops.groupBy("kind", "n").agg(F.count("*").alias("k"))
    use = F.when(F.col("kind") == "split", F.col("n")).otherwise(F.col("n") * split_cost)
    before = Window.orderBy(F.desc(use), "kind").rowsBetween(Window.unboundedPreceding, -1)  # of equals the merge
    runs = runs.withColumn("held", F.coalesce(F.sum(F.col("n") * F.col("k")).over(before), F.lit(0)))
    need = lambda p: F.expr(f"greatest(0, least(k, ({int(total)} * {p} - held * 100 + n * 100 - 1) div (n * 100)))")
    sums = runs.agg(*[F.coalesce(F.sum(F.when(F.col("kind") == kind, need(p))), F.lit(0)).cast("long").alias(f"{kind}{p}") for p in percents for kind in ("split", "merge")])
    return sums.selectExpr(f"stack({len(percents)}, {', '.join(f'{p}, split{p}, merge{p}' for p in percents)}) AS (percent, splits, merges)")
