"""Lloyd's rounds against plain Python."""

from __future__ import annotations

import hashlib
import math
import random

import pytest

from voxelith.llm import clustering

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance int"


def rows(n: int = 300, seed: int = 5) -> list[tuple]:
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(64)] for _ in range(9)]
    out = [(i, [float(f"{c + rnd.gauss(0, 0.3):.4f}") for c in rnd.choice(centres)], 0, "clash", 1) for i in range(n)]
    hot = [0.5] * 64
    return out + [(1000 + i, hot, 0, None, None) for i in range(n // 2)]


def odd() -> list[tuple]:
    v = [0.25] * 64
    swap = lambda x: [*v[:10], x, *v[11:]]
    return [
        (1, None, 0, "", 0), (2, [], 0, "", 0), (3, v[:63], 0, "", 0), (4, [*v, 0.0], 0, "", 0), (5, swap(None), 0, "", 0), (6, swap(math.nan), 0, "", 0),
        (7, swap(math.inf), 0, "", 0), (8, swap(-math.inf), 0, "", 0), (None, swap(3.0), 0, "", 0), (None, swap(2.0), 0, "", 0), (9, swap(-0.001), 0, "", 0), (9, swap(1.0), 0, "", 0), (9, swap(1.0), 0, "", 0), ((1 << 60) + 1, v, 0, "", 0),
    ]


def plain(vectors: list[tuple]) -> list[tuple]:
    own = [(r[0], [math.floor(64 * x) for x in r[1]], r[1]) for r in vectors if r[1] is not None and len(r[1]) == 64 and all(x is not None and math.isfinite(x) for x in r[1])]
    first = sorted(own, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[2]))
    centroids = [r[1] for r in first[:16]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    nearest = lambda v: min((far(v, c), k) for k, c in enumerate(centroids))
    for _ in range(3):
        of = [nearest(v)[1] for _, v, _ in own]
        for k in range(len(centroids)):
            mine = [r[1] for r, c in zip(own, of, strict=True) if c == k]
            if mine:
                centroids[k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v, _ in own]
    inertia = {k: sum(d for _, c, d in found if c == k) for k in range(len(centroids))}
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in found), key=repr)


@pytest.mark.parametrize("case", ["many", "odd", "few", "both"])
def test_lloyd(spark, case):
    vectors = {"many": rows(), "odd": odd(), "few": rows(6), "both": rows(80, 6) + odd()}[case]
    df = spark.createDataFrame(vectors, SCHEMA).repartition(4)
    got = clustering.lloyd(df)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"]
    # arrays of floats come back as the doubles that they stand for
    expected = plain([tuple(r) for r in spark.createDataFrame(vectors, SCHEMA).collect()])
    assert sorted((tuple(r)[:6] for r in got.collect()), key=repr) == expected
    assert all(r.centroid_sha256 == hashlib.sha256(",".join(map(str, r.centroid)).encode()).hexdigest() for r in got.collect())


def test_without_vectors(spark):
    assert clustering.lloyd(spark.createDataFrame([], SCHEMA)).count() == 0
    assert clustering.lloyd(spark.createDataFrame(odd()[:8], SCHEMA)).count() == 0


def test_too_large_for_longs(spark):
    with pytest.raises(Exception, match="need not fit a long"):
        clustering.lloyd(spark.createDataFrame([(1, [3.0e6] * 64, 0, "", 0)], SCHEMA)).count()


def test_ties_take_the_smaller_cluster():
    import numpy as np

    cluster, distance = clustering.nearest(np.array([[1, 1], [5, 5]]), np.array([[0, 0], [2, 2], [0, 2]]))
    assert cluster.tolist() == [0, 1] and distance.tolist() == [2, 18]
