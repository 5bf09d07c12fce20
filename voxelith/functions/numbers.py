"""Means, sums and running sums that do not depend on the order in which rows come, and do not gather all rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys of one range of running().
SPAN = 1024


def exact_mean(value: str | Column, decimals: int = 4, unit: int = 4) -> Column:
    """The mean rounded half up, from whole sums: of values that have `unit` decimals at most it is exact, ties too."""
    v = F.col(value) if isinstance(value, str) else value
    total, n = F.sum(F.round(v * 10.0**unit).cast("long")), F.count(v)
    step = n * 10 ** (unit - decimals)
    return F.floor((2 * total + step) / (2 * step)) / 10.0**decimals


def exact_sum(values: str | Column) -> Column:
    """Of an array of longs, which can sum to more than a long holds."""
    return F.aggregate(values, F.lit(0).cast("decimal(38,0)"), lambda a, b: (a + b).cast("decimal(38,0)"))


def running(sizes: DataFrame, key: str, size: str, before: str) -> DataFrame:
    """sizes with the sum of all rows of a smaller key. Keys are whole numbers, one row each.

    Sums by ranges of keys come first, so the running sum over all is over ranges and that over keys within one.
    """
    spanned = sizes.withColumn("_span", F.floor(F.col(key) / SPAN).cast("long"))
    spans = spanned.groupBy("_span").agg(F.sum(size).alias("_n"))
    spans = spans.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inner = F.coalesce(F.sum(size).over(Window.partitionBy("_span").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return spanned.join(spans, "_span").withColumn(before, inner + F.col("_start")).drop("_span", "_start")
