"""One-to-one matching of bodies with the largest total overlap, without one task that sees a whole component.

Three exact steps. Pairs that no other choice of their two bodies can beat together are settled round by round, which
takes apart most of a graph. What remains falls into components; small ones are solved by augmenting paths, each in a
task. Larger ones go to an auction: bodies bid for partners, prices rise, and every round is a few joins.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxelith.operators.components import components
from voxelith.operators.graph import SMALL_GRAPH, assignment, mapping_from_edges
from voxelith.sources.scratch import Scratch

#: Rounds of settling; what they leave is solved by the other steps.
SETTLING = 20
#: By which the least raise of a bid shrinks from one phase of the auction to the next.
SHRINK = 5
MAX_BIDS = 20_000
#: Values and prices of the auction.
EXACT = "decimal(38,0)"
#: Pairs up to which a component is solved in one task.
SMALL_COMPONENT = 20_000


def dominant(pairs: DataFrame) -> DataFrame:
    """The pairs (gt, seg, n) that some best matching has: each is its bodies' first choice (the smaller identifier among equals), and its overlap is at least the sum of their second ones.

    Whatever a matching without such a pair gives its two bodies is no more than that sum, so they can be exchanged for it.
    """

    def choices(own: str, other: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(own).orderBy(F.desc("n"), other))
        first_two = pairs.select(own, other, "n", rank.alias("_r")).where("_r <= 2")
        one = lambda r, c: F.max(F.when(F.col("_r") == r, F.col(c)))
        return first_two.groupBy(own).agg(one(1, other).alias(f"{own}_first"), F.coalesce(one(2, "n"), F.lit(0)).alias(f"{own}_second"))

    both = pairs.join(choices("gt", "seg"), "gt").join(choices("seg", "gt"), "seg")
    return both.where("gt_first = seg AND seg_first = gt AND n >= gt_second + seg_second").select("gt", "seg", "n")


def settled(pairs: DataFrame, scratch: Scratch, rounds: int = SETTLING) -> tuple[DataFrame, DataFrame]:
    """(pairs that are settled, pairs whose bodies are both still free), after rounds of dominant() on what the last one left."""
    left, done = pairs, None
    for _ in range(rounds):
        found = scratch.store(dominant(left))
        if not found.limit(1).count():
            break
        done = found if done is None else done.union(found)
        rest = scratch.store(left.join(found.select("gt"), "gt", "left_anti").join(found.select("seg"), "seg", "left_anti").select("gt", "seg", "n"))
        if left is not pairs:
            scratch.free(left)
        left = rest
        if not left.limit(1).count():
            break
    return (pairs.where("false") if done is None else done), left


def _augmented(t: pa.Table) -> pa.Table:
    value: dict[int, dict[int, int]] = {}
    for g, s, n in sorted(zip(*(t.column(c).to_pylist() for c in ("gt", "seg", "n")), strict=True)):
        value.setdefault(g, {})[s] = n
    got = sorted(assignment(value).items())
    return pa.table({"gt": pa.array([g for g, _ in got], pa.int64()), "seg": pa.array([s for _, s in got], pa.int64()), "n": pa.array([value[g][s] for g, s in got], pa.int64())})


def auction(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """(gt, seg, n): a best matching of pairs by bids and prices; any of several best ones.

    Every body also has a stand-in of its own to be matched with, so that all bodies are in a perfect matching: (gt, seg)
    goes with (stand-in of seg, stand-in of gt). Bids raise prices by the bidder's margin and a least raise, which
    shrinks from phase to phase; overlaps are scaled so that in the last one it is too small to matter. A round costs a
    join of the free bidders with their pairs and the prices, and one aggregate over each side.
    """
    stats = pairs.agg(F.count_distinct("gt"), F.count_distinct("seg"), F.max("n")).first()
    if not stats[0]:
        return pairs.where("false")
    bidders = stats[0] + stats[1]
    scale = bidders + 1
    worth = lambda c: (c.cast(EXACT) * F.lit(scale).cast(EXACT)).cast(EXACT)
    # bidders: bodies of gt as they are, stand-ins of seg as -1 - seg; what is bid for: seg as it is, stand-ins of gt as -1 - gt
    none = F.lit(0).cast(EXACT)
    edges = scratch.store(
        pairs.select(F.col("gt").alias("i"), F.col("seg").alias("j"), worth(F.col("n")).alias("a"))
        .union(pairs.select(F.bitwise_not("seg"), F.bitwise_not("gt"), none))
        .union(pairs.select("gt", F.bitwise_not("gt"), none).distinct())
        .union(pairs.select(F.bitwise_not("seg"), "seg", none).distinct())
    )
    everyone = scratch.store(edges.select("i").distinct())
    prices = scratch.store(edges.select("j").distinct().select("j", none.alias("p"), F.lit(None).cast("long").alias("i")))
    raise_by, bids = max(1, stats[2] * scale // SHRINK), 0
    while True:
        while True:
            free = everyone.join(prices.where("i IS NOT NULL").select("i"), "i", "left_anti")
            gain = edges.join(free, "i").join(prices.select("j", "p"), "j").select("i", "j", "p", (F.col("a") - F.col("p")).cast(EXACT).alias("v"))
            rank = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("v"), "j"))
            two = gain.withColumn("_r", rank).where("_r <= 2").groupBy("i").agg(F.max_by(F.struct("j", "p", "v"), -F.col("_r")).alias("one"), F.min("v").alias("second"))
            bid = (F.col("one.p") + F.col("one.v") - F.col("second") + F.lit(raise_by).cast(EXACT)).cast(EXACT)
            won = scratch.store(two.select(F.col("one.j").alias("j"), bid.alias("b"), "i").groupBy("j").agg(F.max(F.struct("b", "i")).alias("w")))
            if not won.limit(1).count():
                break
            bids += 1
            if bids > MAX_BIDS:
                raise RuntimeError("the auction did not end")
            after = scratch.store(prices.join(won, "j", "left").select("j", F.coalesce("w.b", "p").alias("p"), F.coalesce("w.i", "i").alias("i")))
            scratch.free(prices, won)
            prices = after
        if raise_by == 1:
            break
        # all are free again, at the prices so far
        raise_by = max(1, raise_by // SHRINK)
        prices = scratch.store(prices.select("j", "p", F.lit(None).cast("long").alias("i")))
    return pairs.join(prices.where("i >= 0 AND j >= 0").select(F.col("i").alias("gt"), F.col("j").alias("seg")), ["gt", "seg"]).select("gt", "seg", "n")


def matched(pairs: DataFrame, small: int = SMALL_COMPONENT, rounds: int = SETTLING) -> DataFrame:
    """(gt, seg, n): pairs of a one-to-one matching with the largest sum of n; identifiers are 0 or more, n positive.

    small: pairs up to which a component that settling leaves is solved in one task; beyond it is auctioned.
    """
    scratch = Scratch(pairs.sparkSession, "match")
    done, left = settled(scratch.store(pairs.select("gt", "seg", "n").where("n > 0")), scratch, rounds)
    if not left.limit(1).count():
        return done
    # the other side's bodies are negative nodes: -1 - seg
    found = components(left.select(F.col("gt").alias("u"), F.bitwise_not("seg").alias("v")), scratch, SMALL_GRAPH).toDF("gt", "body")
    placed = scratch.store(left.join(found, "gt"))
    sizes = placed.groupBy("body").agg(F.count("*").alias("_pairs"))
    few = placed.join(sizes.where(F.col("_pairs") <= small), "body", "left_semi").groupBy("body").applyInArrow(_augmented, "gt long, seg long, n long")
    out = done.union(few)
    many = placed.join(sizes.where(F.col("_pairs") > small), "body", "left_semi").select("gt", "seg", "n")
    return out.union(auction(scratch.store(many), scratch)) if many.limit(1).count() else out


def match_bodies(over: DataFrame, threshold: int = 0, partners: int = 3, small: int = SMALL_COMPONENT) -> DataFrame:
    """(gt, seg, n): one-to-one matches with the largest total overlap, among bodies that each body's top partners connect.

    Bodies of gt below the threshold and background are left out. Of each gt the `partners` largest overlaps (the larger
    seg among equals) make the groups; within a group all overlaps count. A body without a match has seg 0 and n 0.
    """
    scratch = Scratch(over.sparkSession, "bodies")
    size = F.sum("n").over(Window.partitionBy("gt"))
    kept = scratch.store(over.where("seg <> 0").withColumn("_t", size).where(F.col("_t") >= threshold).select("gt", "seg", "n"))
    top = kept.withColumn("_r", F.row_number().over(Window.partitionBy("gt").orderBy(F.desc("n"), F.desc("seg")))).where(F.col("_r") <= partners)
    group = mapping_from_edges(top.select(F.col("gt").alias("u"), F.bitwise_not("seg").alias("v")))
    sides = (group.where(f"label {op} 0").select((F.col("label") if op == ">=" else F.bitwise_not("label")).alias(c), F.col("body").alias(f"{c}_group")) for op, c in ((">=", "gt"), ("<", "seg")))
    pairs = kept
    for side, c in zip(sides, ("gt", "seg"), strict=True):
        pairs = pairs.join(side, c)
    found = matched(pairs.where("gt_group = seg_group"), small)
    every = kept.select("gt").distinct()
    return every.join(found, "gt", "left").select("gt", F.coalesce("seg", F.lit(0)).alias("seg"), F.coalesce("n", F.lit(0)).alias("n"))
