"""Messages of label operations as rows: what a log of merges, splits and affinities holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The fields of each message.
SCHEMAS = {
    "merge": "mutid long, target long, merged array<long>",
    "mapping": "mutid long, mapped long, original array<long>",
    "split": "mutid long, target long, newlabel long, coarse boolean, rles binary",
    "completed": "mutid long, stage string",
    "affinity": "label1 long, label2 long, value float",
    "affinities": "label long, labels array<long>, affinities array<float>",
}


def read(lines: DataFrame, kind: str) -> DataFrame:
    """Messages of one kind from JSON lines (value); binary fields are in base 64. Fields that a line lacks are null."""
    fields = SCHEMAS[kind].replace("binary", "string")
    out = lines.select(F.from_json("value", fields).alias("m")).select("m.*")
    return out.withColumn("rles", F.unbase64("rles")) if kind == "split" else out


def write(messages: DataFrame, kind: str) -> DataFrame:
    """(value): JSON lines that read() takes."""
    names = [c.split()[0] for c in SCHEMAS[kind].split(", ")]
    return messages.select(F.to_json(F.struct(*[F.base64(c).alias(c) if c == "rles" else F.col(c) for c in names])).alias("value"))


def merges(mapping: DataFrame, batch: int = 100_000) -> DataFrame:
    """A merge of each body's other labels into it; a body of very many labels has several messages of up to about `batch` of them.

    mapping: (label, body). Message numbers are the bodies' own, so that running again gives the same ones.
    """
    own = mapping.where("label <> body")
    sizes = own.groupBy("body").agg(F.ceil(F.count("*") / batch).alias("parts"))
    part = F.pmod(F.xxhash64("label"), F.col("parts"))
    sums = own.join(sizes, "body").groupBy("body", part.alias("part")).agg(F.sort_array(F.collect_list("label")).alias("merged"))
    return sums.select(F.col("body").alias("mutid"), F.col("body").alias("target"), "merged")


def merged_labels(messages: DataFrame) -> DataFrame:
    """(label, body) of merge messages."""
    return messages.select(F.explode("merged").alias("label"), F.col("target").alias("body"))


def affinity_table(pairs: DataFrame, span: int = 100_000) -> DataFrame:
    """(label, labels, affinities): each label's partners, in order; pairs: (label1, label2, value). A label has a row for each range of so many names that its partners are in."""
    both = pairs.select(F.col("label1").alias("label"), F.col("label2").alias("other"), "value").union(pairs.select("label2", "label1", "value"))
    rows = both.groupBy("label", F.floor(F.col("other") / span).alias("_part")).agg(F.sort_array(F.collect_list(F.struct("other", "value"))).alias("of"))
    return rows.select("label", F.col("of.other").alias("labels"), F.col("of.value").alias("affinities"))
