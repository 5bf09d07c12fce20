"""Centroid clustering: plain Lloyd over whole numbers.

Every component x becomes floor(scale * x), so distances, sums and means are whole numbers: results do not
depend on how the vectors are partitioned. In a round each partition takes the broadcast centroids, assigns
its vectors in NumPy, and gives one row of sums for each centroid that it met; groupBy adds those. Only the
centroids, k rows, come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, short_batches

DIMENSIONS = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
SEED = 1
#: Whole components up to which a squared distance of up to 128 of them fits a long.
LARGEST = 1 << 27


def kept(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int) -> DataFrame:
    """(_id, _v) of the vectors that have all their components: none is null, NaN or infinite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    own = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    return short_batches(own).where((F.size("_v") == dimensions) & F.forall("_v", finite))


def whole(v: pd.Series, dimensions: int, scale: int) -> np.ndarray:
    x = np.floor(scale * np.stack(v)) if len(v) else np.zeros((0, dimensions))
    if (np.abs(x) > LARGEST).any():
        raise ArithmeticError(f"components beyond {LARGEST} after scaling: their squared distances need not fit a long")
    return x.astype(np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each row; the smaller number among equals."""
    far = np.empty((len(x), len(centroids)), np.int64)
    for k, c in enumerate(centroids):
        d = x - c
        far[:, k] = np.einsum("ij,ij->i", d, d)
    cluster = far.argmin(axis=1) if len(centroids) else np.zeros(0, np.int64)
    return cluster, far[np.arange(len(x)), cluster]


def hashed(key: Column, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"), 256)


def initial(vectors: DataFrame, clusters: int, scale: int, seed: int) -> np.ndarray:
    """The vectors of the smallest hashes of seed and identifier, those without identifier last; of repeated identifiers the smaller vector first."""
    order = [F.col("_h").asc_nulls_last(), F.col("_v").asc()]
    first = vectors.withColumn("_h", hashed(F.col("_id"), seed)).orderBy(*order).limit(clusters).select("_v").collect()
    return np.array([np.floor(scale * np.array(r["_v"], np.float64)) for r in first]).astype(np.int64)


def moved(vectors: DataFrame, centroids: Broadcast, scale: int) -> np.ndarray:
    """The centroids after one round: the componentwise mean, rounded down, of their vectors; one without vectors stays."""
    count, dimensions = centroids.value.shape
    sums = [f"s{i}" for i in range(dimensions)]

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = np.zeros(count, np.int64), np.zeros((count, dimensions), np.int64)
        for frame in frames:
            x = whole(frame["_v"], dimensions, scale)
            cluster, _ = nearest(x, centroids.value)
            order = np.argsort(cluster, kind="stable")
            met, starts = np.unique(cluster[order], return_index=True)
            if len(met):
                total[met] += np.add.reduceat(x[order], starts, axis=0)
            n += np.bincount(cluster, minlength=count)
        met = np.flatnonzero(n)
        yield pd.DataFrame({"cluster": met, "n": n[met]} | {s: total[met, i] for i, s in enumerate(sums)})

    rows = vectors.select("_v").mapInPandas(partial, "cluster long, n long, " + ", ".join(f"{s} long" for s in sums))
    after = centroids.value.copy()
    for r in rows.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums]).collect():  # one row a cluster
        after[r["cluster"]] = [r[s] // r["n"] for s in sums]
    return after


def assigned(vectors: DataFrame, centroids: Broadcast, scale: int) -> DataFrame:
    """(_id, cluster, distance) of each vector."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cluster, distance = nearest(whole(frame["_v"], centroids.value.shape[1], scale), centroids.value)
            yield pd.DataFrame({"_id": frame["_id"], "_null": frame["_null"], "cluster": cluster.astype(np.int32), "distance": distance})

    # pandas would make a column of whole numbers with nulls one of doubles
    own = vectors.select(F.coalesce("_id", F.lit(0)).alias("_id"), F.col("_id").isNull().alias("_null"), "_v")
    return own.mapInPandas(run, "_id long, _null boolean, cluster int, distance long").select(F.when(~F.col("_null"), F.col("_id")).alias("_id"), "cluster", "distance")


def lloyd(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED,
) -> DataFrame:
    """One row per kept vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid.

    Vectors of another length, or with a null, NaN or infinite component, are not kept. A null identifier is kept and
    is the last to become an initial centroid; rows that repeat an identifier are vectors of their own, of which the
    smaller components come first there. Of equally near centroids the smaller number is taken. With fewer vectors
    than clusters each is a centroid; an empty table gives an empty result. Components beyond 2^27 after scaling end
    the job with an error, as distances need not fit a long then. No column but the two is read.
    """
    spark = vectors.sparkSession
    own = kept(vectors, id_col, vector_col, dimensions)
    centroids = initial(own, clusters, scale, seed).reshape(-1, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        shared = spark.sparkContext.broadcast(centroids)
        centroids = moved(own, shared, scale)
        shared.unpersist()
    found = Scratch(spark, "lloyd").store(assigned(own, spark.sparkContext.broadcast(centroids), scale))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    names = spark.createDataFrame([(i, d, c) for i, (d, c) in enumerate(zip(digest, centroids.tolist(), strict=True))], "cluster int, centroid_sha256 string, centroid array<long>")
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # one row a cluster, as names
    every = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    out = found.join(F.broadcast(sums.join(F.broadcast(names), "cluster").crossJoin(F.broadcast(every))), "cluster")
    return out.select(F.col("_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")


def sql(dimensions: int = DIMENSIONS, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> str:
    """The same over a table `embeddings`, a common table expression for each round."""
    assign = """near{0} AS MATERIALIZED (
  SELECT rid, arg_min(k, d * {2} + k) AS k, min(d) AS d FROM (
    SELECT rid, k, CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(v, c)]) AS BIGINT) AS d FROM vectors, {1}) GROUP BY rid)"""
    move = """sums{0} AS (
  SELECT k, i, sum(v[i]) AS s, count(*) AS n FROM near{0} JOIN vectors USING (rid), range(1, {2} + 1) t(i) GROUP BY k, i),
mean{0} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM sums{0} GROUP BY k),
centroids{0} AS MATERIALIZED (SELECT k, coalesce(m.c, o.c) AS c FROM {1} o LEFT JOIN mean{0} m USING (k))"""
    steps, now = [], "centroids"
    for r in range(1, rounds + 1):
        steps += [assign.format(r, now, clusters), move.format(r, now, dimensions)]
        now = f"centroids{r}"
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE len(embedding) = {dimensions} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {dimensions}),
centroids AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS INTEGER) AS k, v AS c
  FROM (SELECT v, sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h FROM vectors ORDER BY h NULLS LAST, v LIMIT {clusters})),
{", ".join(steps)}{", " if steps else ""}
{assign.format("", now, clusters)}
SELECT vec_id, CAST(n.k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY n.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near n JOIN vectors USING (rid) JOIN {now} f ON f.k = n.k
"""
