"""One-to-one matching: settled pairs, solved components and the auction against exact solutions of the same graphs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from voxelith.operators import graph, matching, overlap
from voxelith.plans import catalog
from voxelith.sources import fixtures as fx
from voxelith.sources.scratch import Scratch

SCHEMA = "gt long, seg long, n long"


def small_graphs(count: int, seed: int) -> list[tuple[int, int, int]]:
    """Disjoint graphs with many ties, of up to five bodies a side."""
    rnd = random.Random(seed)
    return [(100 * c + i, 100 * c + j, rnd.randrange(1, 7)) for c in range(count) for i in range(1, rnd.randrange(2, 7)) for j in range(1, 6) if rnd.random() < 0.6]


def one_component(n: int, seed: int) -> list[tuple[int, int, int]]:
    """A connected graph in which most bodies compete for a few others."""
    rnd = random.Random(seed)
    pairs = {(i, i % (n // 2)): rnd.randrange(20, 60) for i in range(n)} | {(i, (i + 1) % (n // 2)): rnd.randrange(20, 60) for i in range(n)} | {(i, 0): rnd.randrange(1, 90) for i in range(0, n, 3)}
    return [(g, s, w) for (g, s), w in pairs.items()]


def best(pairs: list[tuple[int, int, int]]) -> int:
    value: dict[int, dict[int, int]] = {}
    for g, s, n in sorted(pairs):
        value.setdefault(g, {})[s] = n
    return sum(value[g][s] for g, s in graph.assignment(value).items())


def holds(found: list, pairs: list[tuple[int, int, int]]) -> int:
    """That found is a matching of pairs; its sum."""
    found = [tuple(r) for r in found]
    assert set(found) <= set(pairs) and len({g for g, _, _ in found}) == len({s for _, s, _ in found}) == len(found)
    return sum(n for _, _, n in found)


@pytest.mark.parametrize("rounds", [0, 20])
def test_components_by_themselves(spark, rounds):
    pairs = small_graphs(40, 1) + one_component(40, 2)
    found = matching.matched(spark.createDataFrame(pairs, SCHEMA), rounds=rounds).collect()
    assert holds(found, pairs) == best(pairs)


@pytest.mark.parametrize("pairs", [small_graphs(4, 3), one_component(10, 4)], ids=["many", "one"])
def test_auction(spark, pairs):
    df = spark.createDataFrame(pairs, SCHEMA)
    scratch = Scratch(spark, "test")
    assert holds(matching.auction(df, scratch).collect(), pairs) == best(pairs)
    assert matching.auction(df.where("false"), scratch).count() == 0


def test_a_component_that_settling_leaves_goes_to_the_auction(spark):
    pairs = one_component(8, 5)
    found = matching.matched(spark.createDataFrame(pairs, SCHEMA), small=3, rounds=1).collect()
    assert holds(found, pairs) == best(pairs)


def test_settled_pairs_belong_to_a_best_matching(spark):
    pairs = small_graphs(60, 6)
    done, left = matching.settled(spark.createDataFrame(pairs, SCHEMA), Scratch(spark, "test"))
    found, rest = [tuple(r) for r in done.collect()], [tuple(r) for r in left.collect()]
    assert found and holds(found, pairs) + best(rest) == best(pairs)
    assert not {g for g, _, _ in rest} & {g for g, _, _ in found} and not {s for _, s, _ in rest} & {s for _, s, _ in found}


def test_match_bodies_counts_all_overlaps_within_a_group(spark):
    # body 1 has four partners; the fourth is no top one, but in the group through body 2
    over = [(1, 10, 9), (1, 11, 9), (1, 12, 9), (1, 13, 1), (2, 13, 5), (2, 10, 1), (3, 10, 20), (3, 11, 20), (3, 12, 20), (4, 10, 20), (4, 11, 20), (4, 12, 20), (5, 10, 20), (5, 11, 20), (5, 12, 20), (6, 99, 2), (7, 0, 50)]
    got = sorted(tuple(r) for r in matching.match_bodies(spark.createDataFrame(over, SCHEMA)).collect())
    assert sum(n for _, _, n in got) == 67 and [g for g, _, _ in got] == [1, 2, 3, 4, 5, 6] and got[0] == (1, 0, 0) and got[1] == (2, 13, 5)
    assert matching.match_bodies(spark.createDataFrame(over, SCHEMA), threshold=7).where("gt IN (2, 6)").count() == 0
    assert matching.match_bodies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rounds_of_settling_are_enough_for_the_fixture(spark):
    pairs = overlap.overlap(fx.voxels(spark, "/root/testdata/sf0.001")).where("seg <> 0").select("gt", "seg", F.col("n").cast("long"))
    assert matching.settled(pairs, Scratch(spark, "test"), 10)[1].count() == 0
    assert "done9" in catalog.SQL["hungarian_match"] and "done10" not in catalog.SQL["hungarian_match"]
