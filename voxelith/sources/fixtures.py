"""Volumes, graphs and points derived from the driver's tables, as DataFrames and as SQL common table expressions.

Volumes grow with lineitem: about half as many voxels as cells, in a cube whose side is a multiple of 8. A third of the
voxels belong to one body, and a third of the merge graph's nodes to a few.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Voxels of one shuffle partition, about: a task sorts them, or holds as many groups.
ROWS_PER_PARTITION = 2_000_000


def spread(spark: SparkSession, rows: int) -> None:
    """The session's shuffles have partitions for so many rows at least, as a task's memory grows with its rows; Spark puts small partitions together again."""
    name = "spark.sql.shuffle.partitions"
    wanted = -(-rows // ROWS_PER_PARTITION)
    if wanted > int(spark.conf.get(name)):
        spark.conf.set(name, str(wanted))


def side(spark: SparkSession, sf_dir: str) -> int:
    """Of the cube: the count comes from the file's footer."""
    n = 8 * math.ceil(round((2 * table(spark, sf_dir, "lineitem").count()) ** (1 / 3), 6) / 8)
    spread(spark, n**3)
    return n


def shape(spark: SparkSession, sf_dir: str) -> tuple[int, int, int]:
    return (side(spark, sf_dir),) * 3


def _line(column: str, n: int) -> Column:
    return F.floor(F.col(column) / float(n)).cast("long") % n


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(z, y, x, gt, seg), two labelings of a sparse cube; 0 is background.

    Body 1 of gt has a third of the voxels. seg follows gt in most places, with bodies 1 and 2 merged, and has bodies of
    its own elsewhere.
    """
    n = side(spark, sf_dir)
    cells = (
        table(spark, sf_dir, "lineitem")
        .groupBy((F.col("l_orderkey") % n).alias("z"), _line("l_orderkey", n).alias("y"), ((F.col("l_linenumber") - 1 + 8 * F.col("l_suppkey")) % n).cast("long").alias("x"))
        .agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    )
    named = cells.withColumn("gt", F.when(F.col("p") % 7 == 0, 0).when(F.col("p") % 3 == 0, 1).otherwise(2 + F.col("p") % F.lit(n // 2)))
    seg = F.when(F.col("s") % 9 == 0, 0).when((F.col("s") % 4 == 1) | (F.col("gt") == 0), 3 + F.col("s") % 9).when(F.col("gt") <= 2, 1).otherwise(F.col("gt"))
    return named.select("z", "y", "x", F.col("gt").cast("long").alias("gt"), seg.cast("long").alias("seg"))


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(z, y, x, label) of the full cube: gt of the voxels, folded into 1 to 8, and 0 where it has none. A third of them are one label; all labels are shattered."""
    n = side(spark, sf_dir)
    cells = spark.range(n**3).select(F.floor(F.col("id") / float(n * n)).cast("long").alias("z"), (F.floor(F.col("id") / float(n)) % n).cast("long").alias("y"), (F.col("id") % n).alias("x"))
    label = F.when(F.col("gt") > 0, 1 + (F.col("gt") - 1) % 8).otherwise(0).cast("long")
    return cells.join(voxels(spark, sf_dir).select("z", "y", "x", "gt"), ["z", "y", "x"], "left").select("z", "y", "x", label.alias("label"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(u, v) with u < v, a merge graph over all orders: every third one is tied to one of four hubs, the others to some of their own class and sixty."""
    k = F.col("l_orderkey")
    q = F.when(k % 3 == 0, 3 + 3 * (F.col("l_suppkey") % 4)).otherwise(F.floor(k / 60.0) * 60 + 3 * (F.col("l_partkey") % 20) + k % 3)
    raw = table(spark, sf_dir, "lineitem").select(k.alias("p"), q.cast("long").alias("q"))
    return raw.where("p <> q").select(F.least("p", "q").alias("u"), F.greatest("p", "q").alias("v")).distinct()


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(point_id, z, y, x)."""
    n = side(spark, sf_dir)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("point_id"), (F.col("o_orderkey") % n).alias("z"), _line("o_orderkey", n).alias("y"), (F.col("o_custkey") % n).alias("x"))


def synapses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pre, post), each point with the one that has the next identifier."""
    p = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pre"))
    return p.join(p.select(F.col("pre").alias("post")), F.col("post") == F.col("pre") + 1)


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(label, body) for the small labels that suppliers' numbers give, 1 to 8, pairs of consecutive ones under the smaller."""
    label = (1 + F.col("l_suppkey") % 8).cast("long")
    return table(spark, sf_dir, "lineitem").select(label.alias("label")).distinct().select("label", (F.col("label") - (F.col("label") + 1) % 2).alias("body"))


#: The same relations for SQL. Each but `side_` and `mapping` takes the cube's side n from side_.
CTE = {
    "side_": "side_ AS (SELECT 8 * CAST(ceil(round(cbrt(2.0 * count(*)), 6) / 8) AS BIGINT) AS n FROM lineitem)",
    "voxels": """cells_ AS (
  SELECT l_orderkey % n AS z, CAST(floor(l_orderkey / CAST(n AS DOUBLE)) AS BIGINT) % n AS y, CAST((l_linenumber - 1 + 8 * l_suppkey) % n AS BIGINT) AS x,
         min(l_partkey) AS p, min(l_suppkey) AS s, n
  FROM lineitem, side_ GROUP BY 1, 2, 3, n),
named_ AS (SELECT *, CAST(CASE WHEN p % 7 = 0 THEN 0 WHEN p % 3 = 0 THEN 1 ELSE 2 + p % (n // 2) END AS BIGINT) AS gt FROM cells_),
voxels AS (SELECT z, y, x, gt, CAST(CASE WHEN s % 9 = 0 THEN 0 WHEN s % 4 = 1 OR gt = 0 THEN 3 + s % 9 WHEN gt <= 2 THEN 1 ELSE gt END AS BIGINT) AS seg FROM named_)""",
    "dense": """dense AS (
  SELECT z, y, x, CASE WHEN gt > 0 THEN 1 + (gt - 1) % 8 ELSE 0 END AS label
  FROM side_, unnest(range(n)) a(z), unnest(range(n)) b(y), unnest(range(n)) c(x) LEFT JOIN (SELECT z AS vz, y AS vy, x AS vx, gt FROM voxels) ON vz = z AND vy = y AND vx = x)""",
    "edges": """edges AS (
  SELECT DISTINCT least(p, q) AS u, greatest(p, q) AS v
  FROM (SELECT l_orderkey AS p, CASE WHEN l_orderkey % 3 = 0 THEN 3 + 3 * (l_suppkey % 4) ELSE CAST(floor(l_orderkey / 60.0) AS BIGINT) * 60 + 3 * (l_partkey % 20) + l_orderkey % 3 END AS q FROM lineitem) WHERE p <> q)""",
    "points": """points AS (
  SELECT o_orderkey AS point_id, o_orderkey % n AS z, CAST(floor(o_orderkey / CAST(n AS DOUBLE)) AS BIGINT) % n AS y, o_custkey % n AS x FROM orders, side_)""",
    "synapses": """synapses AS (SELECT a.o_orderkey AS pre, b.o_orderkey AS post FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1)""",
    "mapping": """mapping AS (SELECT label, label - (label + 1) % 2 AS body FROM (SELECT DISTINCT 1 + l_suppkey % 8 AS label FROM lineitem))""",
}


def with_(*names: str, more: str = "") -> str:
    """A WITH clause of fixtures; more: further expressions. The dense volume needs the voxels."""
    names = ("voxels", *names) if "dense" in names and "voxels" not in names else names
    return "WITH RECURSIVE " + ",\n".join([CTE["side_"], *(CTE[n] for n in names), *([more] if more else [])]) + "\n"
