"""The named workflows, each a composition of operators: DataFrames in, named DataFrames out.

Nothing here loops over slabs, batches or bricks: Spark's partitions, spills and retries take their place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelith.functions.grid import Grid, packed_block, pyramid_depth
from voxelith.operators import agglomeration, bodies, evaluation, graph, matching, meshes, overlap, segmentation, tiles, volume
from voxelith.sources.scratch import Scratch

Frames = dict[str, DataFrame]
WORKFLOWS: dict[str, Callable[..., Frames]] = {}

#: Added to coordinates of blocks, so that those below 0 keep their order in a packed number.
HALF = 1 << 20


def workflow(f: Callable[..., Frames]) -> Callable[..., Frames]:
    WORKFLOWS[f.__name__] = f
    return f


@workflow
def copy_segmentation(df: DataFrame, value: str, block: int = 64, offset: tuple = (0, 0, 0), mapping: DataFrame | None = None, store: DataFrame | None = None, depth: int = 0) -> Frames:
    """Relabel, move, fill from what is stored, and make the pyramid, with block statistics and the runs of blocks to write."""
    moved = volume.translate(df.select("z", "y", "x", value), offset)
    moved = moved if mapping is None else volume.relabel(moved, mapping, value)
    full = moved if store is None else volume.fill_missing(moved, store, value)
    return {"voxels": volume.pyramid(full, depth, value), "block_stats": volume.block_statistics(full, value, block), "runs": volume.block_runs(full, value, block, store)}


@workflow
def evaluate_segmentation(df: DataFrame, shape: tuple[int, int, int], subvolume: int, threshold: int = 1000, points: DataFrame | None = None, pairs: DataFrame | None = None) -> Frames:
    """All metrics over one overlap frame, which is written first: of the volume, of its subvolumes and of its bodies; with points also of connections.

    summarystats, subvolumes, bodystats, bodydebug and types are the sections of the record.
    """
    cell = [F.floor(F.col(a) / subvolume).cast("long") for a in ("z", "y", "x")]
    by_sv = Scratch(df.sparkSession, "evaluate").store(overlap.overlap(df.withColumn("sv", (cell[0] * 1_000_000 + cell[1]) * 1_000_000 + cell[2]), ("sv",)))
    over = by_sv.groupBy("gt", "seg").agg(F.sum("n").alias("n"))
    out = {
        "vi": overlap.vi(over, threshold), "rand": overlap.rand(over, threshold), "vi_by_subvolume": overlap.vi(by_sv, 0, ("sv",)), "rand_by_subvolume": overlap.rand(by_sv, 0, ("sv",)),
        "bodies": overlap.vi_bodies(over, threshold), "histogram": overlap.bodies_to_reach(over), "best": overlap.best_match(over, threshold), "counts": overlap.body_counts(by_sv),
        **evaluation.record(evaluation.Evaluation(evaluation.labelled(by_sv, evaluation.Comparison(evaluation.VOXELS)), {evaluation.VOXELS: threshold})),
        "top_overlaps": overlap.top_overlaps(over), "orphans": overlap.orphans(df, "seg", threshold, shape), "edits": overlap.edit_operations(over),
    }
    if points is not None and pairs is not None:
        conns = graph.connections(pairs, points)
        table = graph.connectivity(conns, matching.match_bodies(over, threshold))
        out |= {"connectivity": table, "connectivity_summary": graph.connectivity_summary(table, conns), "autapses": graph.autapses(conns)}
    return out


@workflow
def compute_graph(df: DataFrame, value: str) -> Frames:
    return {"vertices": graph.rag_vertices(df, value), "edges": graph.rag_edges(df, value)}


@workflow
def edge_probabilities(df: DataFrame, value: str, score: Callable[[DataFrame], DataFrame] | None = None, intensity: str | None = None, threshold: float | None = None) -> Frames:
    """score: a function of edges with the features of both ends; the model itself is the caller's.

    With an intensity, edges and regions have its features along boundaries and inside, and without a score the mean along
    a boundary gives the probability; with a threshold also (label, body) of regions merged by those means.
    """
    if intensity is None:
        return {"edges": score(graph.edge_features(graph.rag_edges(df, value), graph.rag_vertices(df, value)))}
    scratch = Scratch(df.sparkSession, "edges")
    edges, regions = (scratch.store(f(df, value, intensity)) for f in (agglomeration.boundary_features, agglomeration.region_features))
    out = {"edges": (score or agglomeration.boundary_probability)(agglomeration.with_ends(edges, regions)), "vertices": regions}
    return out if threshold is None else out | {"bodies": agglomeration.agglomerated(edges, threshold)}


@workflow
def connected_components(df: DataFrame, value: str, shape: tuple[int, int, int]) -> Frames:
    """One pass over the whole volume, so there is nothing to stitch between chunks."""
    voxels, parts = graph.split_disconnected(df, value, shape)
    return {"voxels": voxels, "parts": parts}


@workflow
def create_segmentation(df: DataFrame, value: str, block: int, steps: list[tuple[str, dict]], mode: str = "medium", halo: int = 1, shape: tuple[int, int, int] | None = None) -> Frames:
    """Segments blocks with a halo, makes labels unique by offsets, and merges those that overlap in halos."""
    haloed = volume.retile_with_halo(df.select("z", "y", "x", value), Grid((block,) * 3), halo)
    first = segmentation.run_keyed(haloed, steps, value)
    # three plans read it, and the steps run once
    first = Scratch(df.sparkSession, "blocks").store(first)
    named = first.withColumn("sv", packed_block(*[F.col("b" + a) + HALF for a in ("z", "y", "x")]))
    offsets = graph.stitch_offsets(named, "label")
    unique = named.join(offsets, "sv").withColumn("label", F.when(F.col("label") > 0, F.col("label") + F.col("offset")).otherwise(F.lit(0))).drop("offset")
    own = unique.where("NOT in_halo").select("z", "y", "x", "label")
    counts = graph.overlap_counts(own, unique.where("in_halo").select("z", "y", "x", "label"))
    pairs = graph.stitch_pairs(counts, mode, least=0 if mode == "simple" else 50)
    return {"voxels": graph.stitched(own, "label", pairs), "pairs": pairs}


@workflow
def create_meshes(df: DataFrame, value: str, mapping: DataFrame, block: int = 64, least_segment: int = 0, least_body: int = 0, scheme: str = "singletons", smooth: bool = True) -> Frames:
    """Face meshes of the segments of kept bodies, with the group that each is written in."""
    # the voxels are read for the sizes and again for the meshes; of the table of kept segments Spark knows the size, so it broadcasts a small one
    scratch = Scratch(df.sparkSession, "meshes")
    own = scratch.store(df.where(F.col(value) != 0).select("z", "y", "x", value))
    kept = scratch.store(bodies.keep(bodies.body_stats(bodies.segment_stats(own, value, block), mapping), least_segment, None, least_body))
    chosen = own.join(kept.select(F.col("segment").alias(value), "body"), value)
    quads = segmentation.faces(chosen, value)
    groups = kept.select("segment", "body", bodies.group_of(F.col("body"), scheme).alias("group"))
    return {"groups": groups, "faces": quads, "vertices": segmentation.smoothed_corners(chosen, value) if smooth else segmentation.corners(chosen, value)}


@workflow
def create_stitched_meshes(df: DataFrame, value: str, mapping: DataFrame, block: int = 64, error: float | None = None, share: float = 0.0, **options) -> Frames:
    """create_meshes, whose faces come from the whole volume's neighbours, and triangle meshes of the kept bodies by blocks that fit without seams.

    triangles are simplified up to an error, in voxels; normals are of their vertices over all blocks, obj is the text of each block.
    """
    out = create_meshes(df, value, mapping, block, **options)
    named = df.join(out["groups"].select(F.col("segment").alias(value), "body"), value).select("z", "y", "x", "body")
    mesh = meshes.triangles(named, "body", block, error, share)
    return out | {"triangles": mesh, "normals": meshes.normals(mesh), "obj": meshes.obj_chunks(mesh)}


@workflow
def create_skeleton_masks(df: DataFrame, value: str, mapping: DataFrame, most: int, least: int = 0) -> Frames:
    """The masks that a skeletoniser takes, at the factor at which each fits. Skeletons themselves need an outside algorithm."""
    named = volume.relabel(df, mapping, value)
    return {"masks": bodies.assembled(named, value, most, least)}


@workflow
def sample_points(points: DataFrame, df: DataFrame, value: str, scale: int = 0) -> Frames:
    """Points (in full resolution) with the label at a scale; their other columns stay."""
    at = points.withColumns({f"_{a}": F.col(a) for a in ("z", "y", "x")}).withColumns({a: F.floor(F.col(a) / (1 << scale)).cast("long") for a in ("z", "y", "x")})
    got = volume.labels_at(at, df, value)
    return {"points": got.withColumns({a: F.col(f"_{a}") for a in ("z", "y", "x")}).drop("_z", "_y", "_x")}


@workflow
def check_segmentation(df: DataFrame, value: str, stored: DataFrame, block: int = 64) -> Frames:
    """Blocks that the index of a body lacks or has in excess."""
    return {"errors": bodies.index_check(stored, volume.body_blocks(df, value, None, block))}


@workflow
def ingest_label_indices(stats: DataFrame, mapping: DataFrame, block: int = 64, batch_rows: int = 1_000_000, with_tombstones: str = "include") -> Frames:
    """Indexes, tombstones, mapping operations and the batches in which bodies are sent. with_tombstones: include, exclude or only."""
    if with_tombstones not in ("include", "exclude", "only"):
        raise ValueError(with_tombstones)
    out = {} if with_tombstones == "only" else {"index": bodies.label_index(stats, mapping, block), "batches": bodies.batches(bodies.body_ids(stats, mapping), "body", batch_rows)}
    out |= {} if with_tombstones == "exclude" else {"tombstones": bodies.tombstones(mapping)}
    return out | {"mappings": bodies.mapping_operations(mapping)}


@workflow
def convert_grayscale(df: DataFrame, value: str, shape: tuple[int, int, int], destripe: bool = False, depth: int | None = None) -> Frames:
    clean = volume.destripe(df, value) if destripe else df
    return {"voxels": volume.pyramid(clean, pyramid_depth(max(shape)) if depth is None else depth, value, labels=False)}


@workflow
def export_slices(df: DataFrame, value: str, shape: tuple[int, int, int]) -> Frames:
    from voxelith.sources import slices

    return {"slices": slices.images(df, value, shape)}


@workflow
def ingest_volume(df: DataFrame, value: str, shape: tuple[int, int, int], tile: int = 512, labels: bool = False) -> Frames:
    """Slices to a pyramid of blocks and to tiles of all three planes."""
    levels = volume.pyramid(df, pyramid_depth(max(shape)), value, labels)
    return {"voxels": levels, "tiles": tiles.cut(df, value, tile)}


@workflow
def ingest_grayscale(df: DataFrame, value: str, block: int = 64) -> Frames:
    from voxelith.sources import blocks

    return {"blocks": blocks.pack(df.withColumn("scale", F.lit(0)), value, block)}


@workflow
def create_pyramid(df: DataFrame, value: str, shape: tuple[int, int, int], labels: bool = True, depth: int | None = None) -> Frames:
    return {"voxels": volume.pyramid(df, pyramid_depth(max(shape)) if depth is None else depth, value, labels)}


@workflow
def create_tiles(df: DataFrame, value: str, tile: int = 512, levels: int = 1, planes: tuple[str, ...] = ("xy", "xz", "yz")) -> Frames:
    return {"tiles": tiles.pyramid(df, value, tile, levels, planes)}


@workflow
def benchmark_requests(requests: DataFrame, start: str, seconds: str, group: str, warm_up_until: str | None = None) -> Frames:
    """Statistics of timed requests after a warm-up."""
    kept = requests if warm_up_until is None else requests.where(F.col(start) >= F.lit(warm_up_until).cast("timestamp_ntz"))
    return {"stats": bodies.request_stats(kept, start, seconds, group)}
