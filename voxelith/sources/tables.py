"""Tables in and out: CSV with or without header, merge graphs, and appended statistics."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """Compressed files are read too; columns beyond the schema's are ignored."""
    return spark.read.csv(path, schema=schema, header=header)


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").csv(path, header=True)


def read_edges(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """The first two columns of a label-map or edge file as (u, v)."""
    return spark.read.csv(path, schema="u long, v long", header=header)


def append_stats(df: DataFrame, path: str, sorted_by: list[str] | None = None) -> None:
    """Appends to a Parquet table of statistics, each file in order of the given columns."""
    (df.sortWithinPartitions(*sorted_by) if sorted_by else df).write.mode("append").parquet(path)


def write_sorted(df: DataFrame, path: str, by: list[str]) -> None:
    """df as a table that is in order as a whole, from its first file's first row to its last file's last; the order is recorded beside the files."""
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
    order = df.sparkSession.createDataFrame([(json.dumps(by),)], "value string").coalesce(1)
    order.write.mode("overwrite").text(f"{path}/_order")  # readers of tables pass over names that begin so


def sorted_by(spark: SparkSession, path: str) -> list[str]:
    """The columns that a written table is in order of."""
    return json.loads(spark.read.text(f"{path}/_order").first()[0])


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a written table with their place in it (row), from 0: files are in order of their names, and only their counts meet."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    files = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    starts = files.select("_file", F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    return rows.join(starts, "_file").withColumn("row", F.col("_start") + F.col("_at")).drop("_file", "_at", "_start")


def write_graph(vertices: DataFrame, edges: DataFrame, path: str) -> None:
    """Both tables of a region graph; writing again replaces them."""
    vertices.write.mode("overwrite").parquet(f"{path}/vertices")
    edges.write.mode("overwrite").parquet(f"{path}/edges")


def key_values(df: DataFrame, key: str, value: str, path: str) -> None:
    """(key string, value binary): meshes, skeletons or statistics by name."""
    df.selectExpr(f"CAST({key} AS STRING) AS key", f"CAST({value} AS BINARY) AS value").write.mode("overwrite").parquet(path)
