"""Slice files: one 8-bit grey image a z, portable graymap or PNG, found by the number in their name."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER = re.compile(rb"P5\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+(\d+)\s")
PNG = b"\x89PNG\r\n\x1a\n"


def encode(image: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % image.shape[::-1] + image.astype(np.uint8).tobytes()


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(image: np.ndarray) -> bytes:
    rows = np.zeros((image.shape[0], image.shape[1] + 1), np.uint8)  # filter 0 before each row
    rows[:, 1:] = image
    head = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], 8, 0, 0, 0, 0)
    return PNG + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes())) + _chunk(b"IEND", b"")


def decode_png(raw: bytes) -> np.ndarray:
    """8-bit grey images that aren't interlaced, with any row filters."""
    at, body, head = len(PNG), b"", None
    while at < len(raw):
        n, kind = struct.unpack(">I4s", raw[at : at + 8])
        part = raw[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body += part
        at += n + 12
    if head is None or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not an 8-bit grey PNG without interlacing")
    w, h = head[:2]
    rows = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, w + 1)
    out, above = np.zeros((h, w), np.uint8), np.zeros(w, np.int64)
    for y in range(h):
        kind, line = int(rows[y, 0]), rows[y, 1:].astype(np.int64)
        if kind == 1:
            line = np.cumsum(line)
        elif kind == 2:
            line = line + above
        elif kind in (3, 4):
            left = corner = 0
            for x in range(w):
                if kind == 3:
                    guess = (left + above[x]) // 2
                else:
                    p = left + above[x] - corner
                    guess = min((abs(p - left), 0, left), (abs(p - above[x]), 1, above[x]), (abs(p - corner), 2, corner))[2]
                left = line[x] = (line[x] + guess) & 255
                corner = above[x]
        above = line & 255
        out[y] = above
    return out


def decode(raw: bytes) -> np.ndarray:
    if raw.startswith(PNG):
        return decode_png(raw)
    m = HEADER.match(raw)
    if not m or int(m[3]) > 255:
        raise ValueError("neither an 8-bit portable graymap nor a PNG")
    w, h = int(m[1]), int(m[2])
    return np.frombuffer(raw, np.uint8, w * h, m.end()).reshape(h, w)


def images(df: DataFrame, value: str, shape: tuple[int, int, int], png: bool = False) -> DataFrame:
    """(z, image): complete slices; pixels that df lacks are 0."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        image = np.zeros(shape[1:], np.uint8)
        image[t.column("y").to_numpy(), t.column("x").to_numpy()] = t.column("_v").to_numpy()
        return pa.table({"z": [key[0].as_py()], "image": pa.array([encode_png(image) if png else encode(image)], pa.binary())})

    return df.select("z", "y", "x", F.col(value).alias("_v")).groupBy("z").applyInArrow(run, "z long, image binary")


def write(df: DataFrame, path: str, value: str, shape: tuple[int, int, int]) -> None:
    images(df, value, shape).write.mode("overwrite").parquet(path)


def write_files(df: DataFrame, pattern: str, value: str, shape: tuple[int, int, int]) -> None:
    """A file for each complete slice, named by the pattern (`.../z{:05d}.png` or `.pgm`), in any store that pyarrow opens; files appear when all are written."""
    from voxelith.sources import chunked

    chunked.write_slices(df, pattern, value, shape)


def _pixels(value: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for z, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                image = decode(raw)
                y, x = np.indices(image.shape).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(image.size, z)), pa.array(y), pa.array(x), pa.array(image.reshape(-1).astype(np.int64))], names=["z", "y", "x", value])

    return run


def read(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(z, y, x, value) of stored slices."""
    return spark.read.parquet(path).select("z", "image").mapInArrow(_pixels(value), f"z long, y long, x long, {value} long")


def split_pattern(pattern: str) -> tuple[str, str, str]:
    """(what comes before the number, its format as str.format takes it, what comes after), of `{:05d}`, `{}` or `%05d`; of another one a `*` or nothing stands for any number."""
    if m := re.fullmatch(r"(.*)(\{[^}]*\})(.*)", pattern):
        return m[1], m[2], m[3]
    if m := re.fullmatch(r"(.*)%(0?\d*)d(.*)", pattern):
        return m[1], "{:" + m[2] + "d}", m[3]
    if "*" in pattern:
        prefix, suffix = pattern.split("*", 1)
        return prefix, "{}", suffix
    return pattern.rstrip("/") + "/", "{}", ""


def _files(spark: SparkSession, pattern: str) -> DataFrame:
    """(z, path, content) of the files that a pattern or folder names."""
    prefix, _, suffix = split_pattern(pattern)
    files = spark.read.format("binaryFile").load(f"{prefix}*{suffix}")
    number = F.regexp_extract("path", r"(\d+)" + re.escape(suffix) + "$", 1) if suffix else F.regexp_extract("path", r"(\d+)\D*$", 1)
    return files.select(F.try_to_number(number, F.lit("9" * 18)).cast("long").alias("z"), "path", "content").where("z IS NOT NULL")


def stack_attributes(spark: SparkSession, pattern: str) -> tuple[tuple[int, int, int], tuple[int, int, int]]:
    """The box (start, stop) of a stack of slices: the numbers in their names, and the shape of the first one there is.

    Names have to be of one length: without leading zeros their order would not be that of their numbers.
    """
    files = _files(spark, pattern).select("z", F.length("path").alias("n"))
    r = files.agg(F.min("z").alias("first"), F.max("z").alias("last"), F.count_distinct("n").alias("lengths")).first()
    if r["first"] is None:
        raise FileNotFoundError(f"no slices match {pattern}")
    if r["lengths"] > 1:
        raise ValueError(f"slice numbers of {pattern} are not padded with zeros")
    h, w = decode(_files(spark, pattern).where(F.col("z") == r["first"]).first()["content"]).shape
    return (r["first"], 0, 0), (r["last"] + 1, h, w)


def read_files(spark: SparkSession, pattern: str, value: str) -> DataFrame:
    """(z, y, x, value) of image files; z is the last number in the name. Missing slices have no rows."""
    return read_stack(spark, pattern, value)


def read_stack(spark: SparkSession, pattern: str, value: str, first: int | None = None, stop: int | None = None) -> DataFrame:
    """(z, y, x, value) of the slices of a folder or pattern, from `first` to before `stop`; other files are listed and not read."""
    files = _files(spark, pattern)
    files = files if first is None else files.where(F.col("z") >= first)
    files = files if stop is None else files.where(F.col("z") < stop)
    return files.select("z", "content").mapInArrow(_pixels(value), f"z long, y long, x long, {value} long")


def slab(z: str = "z", width: int = 64, origin: int = 0) -> F.Column:
    """The number of the slab of slices that a z is in; slabs begin at multiples of their width from the origin."""
    return F.floor((F.col(z) - origin) / width).cast("long")


def with_gaps(df: DataFrame, first: int, stop: int) -> DataFrame:
    """(z, present): each slice number of a range, and whether there is such a slice."""
    every = df.sparkSession.range(first, stop).toDF("z")
    return every.join(df.select("z").distinct().withColumn("_in", F.lit(True)), "z", "left").select("z", F.coalesce("_in", F.lit(False)).alias("present"))
