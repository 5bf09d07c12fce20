"""The synapse graph merged over several levels against a join over all points."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from voxelith.operators import synapses
from voxelith.sources.scratch import Scratch

POINTS, PAIRS = "point_id long, sv long, gt long, seg long", "pre long, post long"


def case(seed: int, n: int = 120, subvolumes: int = 8) -> tuple[list[tuple], list[tuple]]:
    rnd = random.Random(seed)
    points = [(i, rnd.randrange(subvolumes), rnd.choice([0, 1, 2, 3, None]), rnd.randrange(4)) for i in range(n)]
    pairs = [(rnd.randrange(n + 5), rnd.randrange(n + 5)) for _ in range(3 * n)] + [(rnd.randrange(n), 7) for _ in range(40)] + [(None, 3), (3, None)]
    return points, pairs + pairs[:9]


def joined(points: list[tuple], pairs: list[tuple], level: int) -> Counter:
    at = {p[0]: p for p in points if p[2]}
    return Counter((at[a][1] >> level, at[a][2], at[a][3], at[b][2], at[b][3]) for a, b in pairs if a in at and b in at and at[a][1] >> level == at[b][1] >> level)


def counts(df) -> dict:
    return {tuple(r)[:-1]: tuple(r)[-1] for r in df.collect()}


def test_levels(spark):
    points, pairs = case(1)
    p, e = spark.createDataFrame(points, POINTS), spark.createDataFrame(pairs, PAIRS)
    # parts of the subvolumes, counted by themselves
    scratch = Scratch(spark, "test")
    now = synapses.graph_of(p.where("sv < 3"), e).union(synapses.graph_of(p.where("sv >= 3"), e)).stored(scratch)
    for level in range(4):
        assert counts(now.edges) == joined(points, pairs, level)
        now = synapses.merged(now, F.floor(F.col("sv") / 2)).stored(scratch)
    labelled = {x[0] for x in points if x[2]}
    # left over for good: ends that are nowhere or without ground truth in another part, and starts like that
    assert sum(counts(now.going_out).values()) <= sum(a in labelled and b not in labelled for a, b in pairs if a is not None and b is not None)
    assert not any(k[1] in labelled for k in counts(now.going_out))
    assert counts(now.bodies()) == {k[1:]: n for k, n in joined(points, pairs, 3).items()}


def test_any_grouping_gives_the_same(spark):
    points, pairs = case(2)
    p, e = spark.createDataFrame(points, POINTS), spark.createDataFrame(pairs, PAIRS)
    first = synapses.graph_of(p, e).stored(Scratch(spark, "test"))
    at_once = synapses.merged(first, F.lit(0))
    by_steps = synapses.merged(synapses.merged(synapses.merged(first, F.when(F.col("sv") < 5, 0).otherwise(F.col("sv"))), F.col("sv") % 3), F.lit(0))
    for a, b in zip((at_once.edges, at_once.going_out, at_once.coming_in), (by_steps.edges, by_steps.going_out, by_steps.coming_in), strict=True):
        assert counts(a) == counts(b)
    assert counts(at_once.edges) == joined(points, pairs, 3)


def test_without_points(spark):
    p, e = spark.createDataFrame([], POINTS), spark.createDataFrame([(1, 2)], PAIRS)
    g = synapses.merged(synapses.graph_of(p, e), F.lit(0))
    assert g.edges.count() == g.going_out.count() == g.coming_in.count() == 0


def test_parts_do_not_repeat_the_joins(spark):
    """Of points and pairs, and of what is left over, each join is made and written once; the parts are read from it."""
    points, pairs = case(3)
    first = synapses.graph_of(spark.createDataFrame(points, POINTS), spark.createDataFrame(pairs, PAIRS))
    merged = synapses.merged(first.stored(Scratch(spark, "test")), F.lit(0))
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join")
    assert [joins(f) for f in (first.edges, first.going_out)] == [0, 0]
    assert [joins(f) for f in (merged.edges, merged.going_out, merged.coming_in)] == [0, 0, 1]
    assert counts(merged.edges) == joined(points, pairs, 3)
