"""The synapse graph between pairs of labels, counted a subvolume at a time and put together as subvolumes are.

A subvolume knows its own points only. A connection with both ends inside is counted there; of one with a single end
inside that end is left over: going out with the label of its start, or coming in with the label of its end. Where
subvolumes are merged, what goes out meets what comes in at the same point, and the rest stays left over. Parts can be
counted at different times, stored, and merged in any grouping: once all are together, the counts are those of a join
over all points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelith.sources.scratch import Scratch


@dataclass(frozen=True)
class Graph:
    """edges (sv, pre_gt, pre_seg, post_gt, post_seg, n); going_out (sv, post, pre_gt, pre_seg, n); coming_in (sv, post, post_gt, post_seg, n)."""

    edges: DataFrame
    going_out: DataFrame
    coming_in: DataFrame

    def union(self, other: Graph) -> Graph:
        """Of other subvolumes."""
        return Graph(self.edges.union(other.edges), self.going_out.union(other.going_out), self.coming_in.union(other.coming_in))

    def stored(self, scratch: Scratch) -> Graph:
        return Graph(*(scratch.store(f) for f in (self.edges, self.going_out, self.coming_in)))

    def bodies(self) -> DataFrame:
        """(pre_gt, pre_seg, post_gt, post_seg, n) of everything that is counted so far."""
        return self.edges.groupBy("pre_gt", "pre_seg", "post_gt", "post_seg").agg(F.sum("n").alias("n"))


EDGE = ("sv", "pre_gt", "pre_seg", "post_gt", "post_seg")
OUT = ("sv", "post", "pre_gt", "pre_seg")
IN = ("sv", "post", "post_gt", "post_seg")


def _summed(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("n").cast("long").alias("n"))


def graph_of(points: DataFrame, pairs: DataFrame) -> Graph:
    """The parts of subvolumes. points: (point_id, sv, gt, seg), of any of the subvolumes; pairs: (pre, post), of points anywhere.

    A start may have many ends, and an end many starts. Points without ground truth, 0 or null, take part in nothing, but
    those in a subvolume are known to be there. Repeated pairs count each; a pair with a null end is none.
    """
    scratch = Scratch(points.sparkSession, "synapse-parts")
    one, pairs = F.lit(1).cast("long").alias("n"), pairs.select("pre", "post").where("pre IS NOT NULL AND post IS NOT NULL")
    side = lambda s: points.select("sv", F.col("point_id").alias(s), F.col("gt").alias(f"{s}_gt"), F.col("seg").alias(f"{s}_seg"), F.lit(True).alias(f"{s}_there"))
    # two of the parts come from it
    begun = scratch.store(pairs.join(side("pre").where("pre_gt <> 0"), "pre").join(side("post"), ["sv", "post"], "left").select(*EDGE, "post", "post_there"))
    ended = pairs.join(side("post").where("post_gt <> 0"), "post").join(side("pre").select("sv", "pre"), ["sv", "pre"], "left_anti")
    return Graph(
        _summed(begun.where("post_gt <> 0").select(*EDGE, one), EDGE),
        _summed(begun.where("post_there IS NULL").select(*OUT, one), OUT),
        _summed(ended.select(*IN, one), IN),
    )


def merged(graph: Graph, to: Column) -> Graph:
    """The same of larger subvolumes: to is the new number, of sv. What goes out of one part and comes in at another is an edge now."""
    new = to.cast("long").alias("sv")
    edges, out, into = (f.select(new, *f.columns[1:]) for f in (graph.edges, graph.going_out, graph.coming_in))
    scratch = Scratch(edges.sparkSession, "synapse-merge")
    into = scratch.store(_summed(into, IN))
    # a point has one label, so a row has one partner at most; those without one stay left over
    met = scratch.store(_summed(out, OUT).join(into.drop("n").withColumn("_there", F.lit(True)), ["sv", "post"], "left"))
    inside = met.where("_there").groupBy("sv", "post").agg(F.sum("n").alias("_met"))
    return Graph(
        _summed(edges.union(met.where("_there").select(*EDGE, "n")), EDGE),
        met.where("_there IS NULL").select(*OUT, "n"),
        # what came in there from inside is the sum over all starts
        into.join(inside, ["sv", "post"], "left").withColumn("n", F.col("n") - F.coalesce("_met", F.lit(0))).where("n > 0").select(*IN, "n"),
    )
