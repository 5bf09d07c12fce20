"""Exact dedup by content sort.

Sampled splitters range-partition the normalised texts, Spark's external sort places equals adjacent, and
one pass over each sorted partition compares each text in full with its neighbour. The document identifier
is part of the sort key, so a group that holds a third of all rows is cut over many partitions; only the
first and last run of each partition can go on next door, and those (two rows a partition at most) are
put together afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, normalised, partitions, short_batches, small, stateless

#: Characters of a text in a splitter.
SPLITTER_CHARS = 48

_ADDED = T.StructType([
    T.StructField("keep_id", T.LongType()),
    T.StructField("group_size", T.LongType()),
    T.StructField("text_sha256", T.StringType()),
    T.StructField("_first", T.BooleanType()),
    T.StructField("_edge", T.BooleanType()),
])


def _runs(carried: pa.Schema, only_first: bool):
    """Function for mapInArrow over sorted rows (carried columns, _id, _norm): closes a run of equal texts at the first other text."""

    def close(rows: list[pa.RecordBatch], raw: bytes, edge: bool) -> Iterator[pa.RecordBatch]:
        n = sum(b.num_rows for b in rows)
        keep = rows[0].column(rows[0].schema.get_field_index("_id"))[0]
        sha = hashlib.sha256(raw).hexdigest()
        first = True
        for b in rows[:1] if only_first else rows:
            b = b.slice(0, 1) if only_first else b
            k = b.num_rows
            flags = np.zeros(k, bool)
            flags[0] = first
            first = False
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(len(carried))]
                + [pa.array([keep.as_py()] * k, pa.int64()), pa.array(np.full(k, n)), pa.array([sha] * k), pa.array(flags), pa.array(np.full(k, edge))],
                names=[*carried.names, *_ADDED.names],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stateless()
        open_rows: list[pa.RecordBatch] = []
        raw: bytes | None = None
        first_run = True
        out: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            text = batch.column(batch.schema.get_field_index("_norm"))
            light = batch.select([*carried.names, "_id"])
            same = np.zeros(batch.num_rows, bool)
            same[1:] = pc.equal(text.slice(1), text.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            same[0] = raw is not None and text[0].as_buffer().to_pybytes() == raw
            starts = np.flatnonzero(~same)
            bounds = [0, *starts.tolist(), batch.num_rows] if same[0] else [*starts.tolist(), batch.num_rows]
            for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                if a == b:
                    continue
                if not (k == 0 and same[0]):
                    if raw is not None:
                        out += close(open_rows, raw, first_run)
                        first_run = False
                    open_rows, raw = [], text[a].as_buffer().to_pybytes()
                part = light.slice(a, b - a)
                if only_first and open_rows:  # rows after the first only count
                    part = part.select(["_id"])
                # a slice of its own, so that a long run doesn't hold the batches it came from
                open_rows.append(pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in part.columns], names=part.schema.names))
                if len(out) >= 2000:
                    yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                    out = []
        if raw is not None:
            out += close(open_rows, raw, True)
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    return run


def _sorted_runs(df: DataFrame, id_col: str, text_col: str, carried: list[str], only_first: bool) -> tuple[DataFrame, int]:
    from pyspark.sql.pandas.types import to_arrow_schema

    source = short_batches(df).select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{id_col}`").cast("long").alias("_id"), normalised(F.col(f"`{text_col}`")).alias("_norm"))
    n = partitions(df)
    # the splitters are sampled from keys of a bounded length, since the sample goes to the driver: what a text begins
    # with, then a hash that parts texts with the same beginning, then the identifier that parts equal texts
    source = source.withColumns({"_begin": F.substring("_norm", 1, SPLITTER_CHARS), "_hash": F.xxhash64("_norm")})
    by_id = F.col("_id").asc_nulls_last()
    ranged = source.repartitionByRange(n, "_begin", "_hash", by_id).sortWithinPartitions("_begin", "_hash", "_norm", by_id).drop("_begin", "_hash")
    schema = T.StructType([*[f for f in source.schema if f.name in carried], *_ADDED])
    inner = to_arrow_schema(T.StructType([f for f in source.schema if f.name in carried]))
    return ranged.mapInArrow(_runs(inner, only_first), schema), n


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """One row per row of df: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of [\\x20\\x09-\\x0D] is one space; null counts as empty. The
    smallest identifier of a group stays; null identifiers sort last (keep_id is null only if all are). Of
    rows that repeat an identifier and a text, exactly one is kept. Other columns are not read. An empty
    table gives an empty result.
    """
    scratch = scratch or Scratch(df.sparkSession, "exact")
    runs, n = _sorted_runs(df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), id_col, text_col, [id_col], False)
    local = scratch.store(runs)
    spread = local.where("_edge and _first").groupBy("text_sha256").agg(F.min("keep_id").alias("_keep"), F.sum("group_size").alias("_size"))
    joined = local.join(small(spread, 2 * n), "text_sha256", "left")
    keep = F.when(F.col("_edge"), F.col("_keep")).otherwise(F.col("keep_id"))
    return joined.select(
        F.col(id_col),
        keep.alias("keep_id"),
        F.when(F.col("_edge"), F.col("_size")).otherwise(F.col("group_size")).alias("group_size"),
        (F.col("_first") & F.col(id_col).eqNullSafe(keep)).alias("kept"),
        "text_sha256",
    )


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """The rows that stay, with all columns of df: one of each group of equal texts, that of the smallest identifier.

    Null counts as an empty text and a null identifier as the largest; of rows that repeat both, one stays; an empty
    table gives an empty result. Columns may have any names.
    """
    scratch = scratch or Scratch(df.sparkSession, "exact")
    names = [f"c{i}" for i in range(len(df.columns))]  # whatever the columns are called, they can't clash with those added
    flat = df.toDF(*names)
    runs, n = _sorted_runs(flat, names[df.columns.index(id_col)], names[df.columns.index(text_col)], names, True)
    heads = scratch.store(runs)
    spread = heads.where("_edge").groupBy("text_sha256").agg(F.min("keep_id").alias("_keep"))
    joined = heads.join(small(spread, 2 * n), "text_sha256", "left")
    return joined.where(~F.col("_edge") | F.col("keep_id").eqNullSafe(F.col("_keep"))).select(*names).toDF(*df.columns)
