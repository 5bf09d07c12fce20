"""Evaluation records: each section against plain values, the rules of subvolumes, and JSON there and back."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelith.operators import evaluation as ev
from voxelith.operators import overlap


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def over(spark):
    table = [(1, 1, 10, 6), (1, 1, 11, 2), (1, 2, 10, 3), (2, 2, 12, 9), (2, 3, 12, 1), (3, 4, 13, 5)]
    return spark.createDataFrame(table, "sv long, gt long, seg long, n long")


def test_sections(spark, over):
    both = ev.labelled(over, ev.Comparison(ev.VOXELS)).union(ev.labelled(over.where("sv = 2"), ev.Comparison(ev.SYNAPSE, "points")))
    flags = spark.createDataFrame([(1, False), (2, False), (3, True)], "sv long, ignore boolean")
    e = ev.Evaluation(both, {ev.VOXELS: 2, ev.SYNAPSE: 0}, flags, display=2)
    out = ev.record(e)
    assert e.types == ["synapse:points", "voxels:labels"] and set(out) == {"summarystats", "subvolumes", "bodystats", "bodydebug", "types"}
    summary = {(r.typename, r.name): r.val for r in out["summarystats"].collect()}
    whole = over.groupBy("gt", "seg").agg(F.sum("n").alias("n"))
    vi = overlap.vi(whole, 2).first()
    assert (summary["voxels:labels", "FM-VI"], summary["voxels:labels", "FS-VI"], summary["voxels:labels", "VI"]) == tuple(vi)
    assert summary["voxels:labels", "TOTAL-SIZE"] == 26 and summary["synapse:points", "TOTAL-SIZE"] == 10
    assert ("voxels:labels", "ED-SPLITS-50") in summary and ("synapse:points", "ED-SPLITS-50") not in summary
    by_sv = {r.sv: r.vi for r in overlap.vi(over, 0, ("sv",)).collect()}
    assert summary["voxels:labels", "S-WRST-VI"] == max(by_sv[1], by_sv[2]) and summary["voxels:labels", "S-BEST-VI"] == min(by_sv[1], by_sv[2])  # the third is ignored
    parts = {(r.typename, r.sv, r.name): (r.val, r.ignore) for r in out["subvolumes"].collect()}
    assert parts["voxels:labels", 3, "VI"] == (by_sv[3], True) and parts["voxels:labels", 1, "VI"] == (by_sv[1], False)
    bodies = [r for r in out["bodystats"].collect() if r.name == "Worst GT" and r.typename == "voxels:labels"]
    assert len(bodies) == 2 and bodies[0].isgt and bodies[0].largest2smallest and bodies[0].vals[0] >= bodies[1].vals[0]
    assert {r.body for r in out["bodydebug"].collect() if r.typename == "voxels:labels"} <= {1, 2, 3, 4}
    with pytest.raises(ValueError):
        ev.record(e, ["vi", "none"])


def test_own_statistic(spark, over):
    @ev.stat("rows")
    class Rows(ev.Stat):
        kinds = (ev.VOXELS,)

        def summary(self, e, typename):
            return e.whole(typename).agg(F.count("*").alias("n")).select(F.lit("ROWS").alias("name"), F.lit(True).alias("higher_better"), F.lit(typename).alias("typename"), F.col("n").cast("double").alias("val"), F.lit("").alias("description"))

    try:
        out = ev.record(ev.Evaluation(ev.labelled(over, ev.Comparison(ev.VOXELS))), ["rows"])
        assert [r.val for r in out["summarystats"].collect()] == [6.0] and out["subvolumes"].count() == 0
    finally:
        del ev.STATS["rows"]


def test_json(spark, over, tmp_path):
    sections = ev.record(ev.Evaluation(ev.labelled(over, ev.Comparison(ev.VOXELS)), {}), ["vi", "count"])
    ev.write_record(sections, f"file://{tmp_path}/r")
    for name, schema in (("summarystats", ev.SUMMARY), ("bodystats", ev.BODIES), ("subvolumes", ev.SUBVOLUMES)):
        lines = spark.read.text(f"file://{tmp_path}/r/{name}")
        assert rows(ev.from_json(lines, schema)) == rows(sections[name])
    one = json.loads(spark.read.text(f"file://{tmp_path}/r/summarystats").first()[0])
    assert set(one) == {"name", "higher-better", "typename", "val", "description"}


def test_ignored_and_merged(spark, over):
    sizes = spark.createDataFrame([(1, 20), (2, 20), (3, 20), (4, 20)], "sv long, size long")
    assert rows(ev.ignored_subvolumes(over, sizes, 50.0)) == [(1, False), (2, False), (3, True), (4, True)]
    assert rows(ev.ignored_subvolumes(over, sizes, 0.0)) == [(i, False) for i in (1, 2, 3, 4)]
    few = spark.createDataFrame([(2,)], "gt long")
    assert rows(ev.ignored_subvolumes(over, sizes, 1.0, few)) == [(1, False), (2, False), (3, True), (4, True)]
    flags = spark.createDataFrame([(1, True), (2, False), (3, True)], "sv long, ignore boolean")
    edge = spark.createDataFrame([(1, 7), (2, 7), (2, 8), (3, 9)], "sv long, body long")
    table, kept, bodies = ev.merged(ev.labelled(over, ev.Comparison(ev.VOXELS)), flags, edge, F.floor(F.col("sv") / 3))
    assert rows(kept) == [(0, False), (1, True)] and rows(bodies) == [(0, 7), (0, 8), (1, 9)]
    assert table.where("sv = 0").agg(F.sum("n")).first()[0] == 21


def test_boundaries(spark):
    a = np.zeros((4, 4, 4), int) + 5
    a[1:3, 1:3, 1:3] = 6
    a[0, 0, 0] = 7
    df = spark.createDataFrame([(*map(int, p), int(a[p])) for p in np.ndindex(a.shape)], "z long, y long, x long, v long")
    assert rows(ev.boundary_bodies(df, "v", df)) == [(5,), (7,)]
    left = ev.eroded(df, "v", 1)
    assert {(r.z, r.y, r.x) for r in left.collect()} == {p for p in np.ndindex(a.shape) if all(a[tuple(c + d * (i == k) for k, c in enumerate(p))] == a[p] for i in range(3) for d in (-1, 1) if 0 <= p[i] + d < 4)}


def test_orphan_counts(spark):
    df = spark.createDataFrame([(0, 1, 1, 1, 3), (0, 1, 1, 2, 3), (0, 0, 1, 1, 4), (1, 0, 0, 0, 5)], "sv long, z long, y long, x long, seg long")
    assert rows(overlap.orphan_counts(df, "seg", 10, (4, 4, 4))) == [(0, 1, 2), (1, 0, 0)]


def test_largest_bodies(spark):
    over = spark.createDataFrame([(b, 1, n) for b, n in ((1, 10), (2, 10), (3, 10), (4, 5), (5, 5), (6, 1))], "gt long, seg long, n long")
    ranked = [3, 2, 1, 5, 4, 6]
    sizes = [10, 10, 10, 5, 5, 1]
    for percent in (1, 24, 25, 50, 73, 74, 90, 99, 100):
        want = {b for i, b in enumerate(ranked) if sum(sizes[:i]) * 100 < 41 * percent}
        assert {r.body for r in overlap.largest_bodies(over, percent).collect()} == want, percent
