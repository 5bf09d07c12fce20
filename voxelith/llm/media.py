"""Media columns: payloads as progressive JPEG files in a table, read back from it to bytes, coefficients and RGB tensors."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import progressive_jpeg as pj
from .common import Scratch, short_batches, stateless

#: Bytes of media that go to the JVM at once.
BATCH_BYTES = 8_000_000


def padded(raw: bytes) -> bytes:
    """Spaces up to a positive multiple of 192 bytes."""
    return raw + b" " * (max(1, -(-len(raw) // pj.UNIT)) * pj.UNIT - len(raw))


def stored(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): the text in UTF-8, null as empty, padded and stored as the coefficients of a progressive JPEG file."""
    own = short_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stateless()
        for batch in batches:
            ids, sizes, media, held = [], [], [], 0

            def out() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

            for i, t in zip(batch.column(0), batch.column(1), strict=True):
                raw = t.as_buffer().to_pybytes()
                ids.append(i.as_py())
                sizes.append(len(raw))
                media.append(pj.encode(padded(raw)))
                held += len(media[-1])
                if held >= BATCH_BYTES:
                    yield out()
                    ids, sizes, media, held = [], [], [], 0
            if ids:
                yield out()

    return own.mapInArrow(run, "doc_id long, n_bytes long, media binary")


def payload(image: pj.Image) -> bytes:
    """What stored() put into the file, from its coefficients."""
    n = int(image.comment.split()[1])
    return pj.payload_bytes([c.coefficients[: c.rows, : c.cols, 1 : 1 + pj.PER_BLOCK].reshape(-1, pj.PER_BLOCK) for c in image.components], n)


def feature(rgb: np.ndarray) -> str:
    """Size, mean of each channel (rounded down) and crc32 of the tensor."""
    h, w, _ = rgb.shape
    means = rgb.reshape(-1, 3).sum(axis=0, dtype=np.int64) // (h * w)
    return f"{h}x{w}:{','.join(map(str, means.tolist()))}:{zlib.crc32(rgb):08x}"


_DIGESTS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, height int, width int, rgb binary"


def digests(media: DataFrame) -> DataFrame:
    """Reads each file of stored() back: digests of its payload and of the file, its RGB tensor (height, width, rgb in rows of three bytes a pixel) and features of that."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary())
    names = [c.split()[0] for c in _DIGESTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        rows, held = [], 0
        for batch in batches:
            for i, n, m in zip(*(batch.column(k) for k in range(3)), strict=True):
                raw = m.as_buffer().to_pybytes()
                image = pj.decode(raw)
                data, rgb = payload(image), pj.pixels(image)
                rows.append((i.as_py(), n.as_py(), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), len(raw), hashlib.sha256(raw).hexdigest(), feature(rgb), *rgb.shape[:2], rgb.tobytes()))
                held += rgb.nbytes
                if held >= BATCH_BYTES:
                    yield out()
                    rows, held = [], 0
        if rows:
            yield out()

    return media.mapInArrow(run, _DIGESTS)


def tensors(media: DataFrame, media_col: str = "media") -> DataFrame:
    """df with height, width and rgb (row-major bytes, three a pixel) of each progressive JPEG; nulls of a null file. Other columns are kept."""
    others = [f.name for f in media.schema if f.name != media_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # a tensor is four times its file: one at a time
                row = batch.slice(k, 1)
                m = row.column(row.schema.get_field_index(media_col))[0].as_py()
                rgb = None if m is None else pj.pixels(pj.decode(m))
                shape = [None, None] if rgb is None else [*rgb.shape[:2]]
                yield pa.RecordBatch.from_arrays(
                    [*(row.column(row.schema.get_field_index(c)) for c in others), pa.array(shape[:1], pa.int32()), pa.array(shape[1:], pa.int32()), pa.array([None if rgb is None else rgb.tobytes()], pa.binary())],
                    names=[*others, "height", "width", "rgb"],
                )

    from pyspark.sql import types as T

    kept = [f for f in media.schema if f.name in others]
    return media.mapInArrow(run, T.StructType([*kept, T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()), T.StructField("rgb", T.BinaryType())]))


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """One row per row of df, of what digests() reads from the written table of stored() files.

    Null and empty texts give 192 spaces. Equal texts give equal values. Repeated rows give repeated results; an
    empty table gives an empty result. Only the two columns are read.
    """
    scratch = scratch or Scratch(df.sparkSession, "media")
    out = digests(scratch.store(stored(df, id_col, text_col), codec="zstd"))
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)
