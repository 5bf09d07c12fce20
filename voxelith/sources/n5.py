"""N5 datasets: attributes.json beside a folder of blocks, read in parallel and written back.

A block's file is <x>/<y>/<z> under the dataset; it begins with mode, number of axes and size (big-endian), then its
samples in x-fastest order, raw or gzip. Blocks are found by Spark's binaryFile source, so any store that Spark reads
will do; missing blocks are 0 and have no rows. A box is a pattern of block paths, so other blocks are not even listed.
Scales are datasets beside each other, whose names end in the scale's digit.
"""

from __future__ import annotations

import gzip
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelith.functions.grid import AXES, inside


def attributes(spark: SparkSession, dataset: str) -> dict:
    text = spark.read.text(f"{dataset}/attributes.json", wholetext=True).first()
    return json.loads(text[0])


def decode_block(raw: bytes, dtype: str, compression: str) -> np.ndarray:
    """z, y, x array of a block."""
    mode, axes = struct.unpack(">HH", raw[:4])
    size = struct.unpack(f">{axes}I", raw[4 : 4 + 4 * axes])
    start = 4 + 4 * axes + (4 if mode == 1 else 0)
    body = raw[start:]
    if compression == "gzip":
        body = gzip.decompress(body)
    elif compression != "raw":
        raise ValueError(f"compression {compression} is not supported")
    return np.frombuffer(body, np.dtype(dtype).newbyteorder(">"), int(np.prod(size))).reshape(size[::-1])


def encode_block(block: np.ndarray, compression: str = "gzip") -> bytes:
    body = block.astype(block.dtype.newbyteorder(">")).tobytes()
    return struct.pack(">HH3I", 0, 3, *block.shape[::-1]) + (gzip.compress(body) if compression == "gzip" else body)


def at_scale(dataset: str, scale: int) -> str:
    """The dataset of a scale, from the name of scale 0, which ends in 0 if there are others."""
    if not scale:
        return dataset
    if not 0 < scale < 10 or not dataset.endswith("0"):
        raise ValueError(f"{dataset} has no scale {scale}")
    return f"{dataset[:-1]}{scale}"


def _files(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, content) of the files that match; none if none do."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path):
        return spark.createDataFrame([], "path string, content binary")
    return spark.read.format("binaryFile").load(pattern).select("path", "content")


def read(spark: SparkSession, dataset: str, value: str, box: tuple | None = None) -> DataFrame:
    """(z, y, x, value) of the dataset's blocks, or of those that meet a box, cut to it."""
    about = attributes(spark, dataset)
    size, dtype = about["blockSize"], about["dataType"]
    kind = about.get("compression", {}).get("type", "raw") if isinstance(about.get("compression"), dict) else about.get("compressionType", "raw")
    ends = [(0, n) for n in about["dimensions"][::-1]] if box is None else list(zip(*box, strict=True))
    axes = [range(max(0, lo) // s, max(0, hi - 1) // s + 1) for s, (lo, hi) in zip(size, ends[::-1], strict=True)]
    files = _files(spark, "/".join([dataset, *("{" + ",".join(map(str, a)) + "}" if box is not None else "*" for a in axes)]))
    at = [F.regexp_extract("path", r"/(\d+)/(\d+)/(\d+)$", i).cast("long").alias(n) for i, n in ((3, "bz"), (2, "by"), (1, "bx"))]
    found = files.select(*at, "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                block = decode_block(r["content"], dtype, kind)
                z, y, x = np.indices(block.shape).reshape(3, -1)
                yield pa.RecordBatch.from_arrays([pa.array(z + r["bz"] * size[2]), pa.array(y + r["by"] * size[1]), pa.array(x + r["bx"] * size[0]), pa.array(block.reshape(-1).astype(np.int64))], names=[*AXES, value])

    out = found.mapInArrow(run, f"z long, y long, x long, {value} long")
    return out if box is None else out.where(inside(box))
