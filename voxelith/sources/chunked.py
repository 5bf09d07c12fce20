"""N5 datasets and stacks of slices through the Python Data Source API, and a sink of files that commits them together.

    n5 = chunked.register(spark).read.format("voxelith-n5").load("file:///data/seg/s0")
    n5.where("z >= 64 AND z < 128 AND x < 512")

Conditions on z, y and x are pushed into the reader as a box. Partitions of an N5 dataset are ranges of the box's blocks,
numbered by arithmetic from its attributes: nothing is listed, and other blocks' files are never asked for. Any store that
pyarrow opens by its address will do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from voxelith.functions.grid import AXES, Grid, cells
from voxelith.sources import n5, slices

#: Blocks, or slices, that one partition reads.
PER_PARTITION = 64
#: Where files are until all tasks are done.
PENDING = "_pending"


def opened(address: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(address.rstrip("/"))


def content(store: fs.FileSystem, path: str) -> bytes | None:
    """None if there is no such file."""
    try:
        with store.open_input_file(path) as f:
            return f.read()
    except FileNotFoundError:
        return None


@dataclass
class Run(InputPartition):
    """Blocks or slices by number."""

    start: int
    stop: int


class BoxReader(DataSourceReader):
    """Takes the conditions that compare z, y or x with a number as a box."""

    def __init__(self, options: dict, low: list[int], high: list[int]):
        self.address = options["path"]
        self.value = options.get("value", "label")
        self.per = int(options.get("perpartition", PER_PARTITION))  # options come in lower case
        self.low, self.high = low, high

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            number = getattr(f, "value", None)
            if not isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) or f.attribute[0] not in AXES or len(f.attribute) != 1 or not isinstance(number, int):
                yield f
                continue
            a = AXES.index(f.attribute[0])
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                self.low[a] = max(self.low[a], number + isinstance(f, GreaterThan))
            if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                self.high[a] = min(self.high[a], number + (not isinstance(f, LessThan)))

    def runs(self, count: int) -> list[Run]:
        # without any there is still one, as an empty list stands for a reader without partitions
        return [Run(a, min(count, a + self.per)) for a in range(0, max(count, 1), self.per)]

    def voxels(self, start: tuple[int, int, int], block: np.ndarray) -> Iterator[pa.RecordBatch]:
        """What of a block is in the box."""
        lo = [max(b, s) - s for b, s in zip(self.low, start, strict=True)]
        hi = [max(i, min(b, s + n) - s) for i, b, s, n in zip(lo, self.high, start, block.shape, strict=True)]
        part = block[tuple(map(slice, lo, hi))]
        if part.size:
            places = [p + s + i for p, s, i in zip(np.indices(part.shape).reshape(3, -1), start, lo, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (*places, part.reshape(-1))], names=[*AXES, self.value])


class N5Reader(BoxReader):
    def __init__(self, options: dict):
        store, path = opened(options["path"])
        raw = content(store, f"{path}/attributes.json")
        if raw is None:
            raise FileNotFoundError(f"no attributes.json in {options['path']}")
        about = json.loads(raw)
        kind = about.get("compression")
        self.kind = kind.get("type", "raw") if isinstance(kind, dict) else about.get("compressionType", "raw")
        self.dtype, self.block = about["dataType"], about["blockSize"][::-1]
        super().__init__(options, [0, 0, 0], list(about["dimensions"][::-1]))

    def grid(self) -> list[range]:
        """Of the box's blocks, along z, y and x."""
        return [range(lo // b, -(-hi // b)) if hi > lo else range(0) for lo, hi, b in zip(self.low, self.high, self.block, strict=True)]

    def partitions(self) -> list[InputPartition]:
        return self.runs(int(np.prod([len(r) for r in self.grid()])))

    def read(self, run: Run) -> Iterator[pa.RecordBatch]:
        store, path = opened(self.address)
        grid = self.grid()
        for number in range(run.start, run.stop):
            at = [r[int(i)] for r, i in zip(grid, np.unravel_index(number, [len(r) for r in grid]), strict=True)]
            raw = content(store, f"{path}/{at[2]}/{at[1]}/{at[0]}")
            if raw is not None:
                yield from self.voxels(tuple(i * b for i, b in zip(at, self.block, strict=True)), n5.decode_block(raw, self.dtype, self.kind))


class SlicesReader(BoxReader):
    """Slices are listed once, by the folder; those outside of the box are not read."""

    def __init__(self, options: dict):
        super().__init__(options, [-(1 << 62)] * 3, [1 << 62] * 3)

    def numbered(self) -> list[tuple[int, str]]:
        prefix, number, suffix = slices.split_pattern(self.address)
        store, path = opened(prefix.rpartition("/")[0])
        name, found = prefix.rpartition("/")[2], []
        for f in store.get_file_info(fs.FileSelector(path)):
            digits = f.base_name[len(name) : len(f.base_name) - len(suffix)]
            if f.base_name.startswith(name) and f.base_name.endswith(suffix) and digits.isdecimal() and self.low[0] <= int(digits) < self.high[0]:
                found.append((int(digits), f.path))
        return sorted(found)

    def partitions(self) -> list[InputPartition]:
        self.found = self.numbered()
        return [Slices(self.found[r.start : r.stop]) for r in self.runs(len(self.found))]

    def read(self, part: Slices) -> Iterator[pa.RecordBatch]:
        store, _ = opened(slices.split_pattern(self.address)[0].rpartition("/")[0])
        for z, path in part.files:
            raw = content(store, path)
            if raw is not None:
                yield from self.voxels((z, 0, 0), slices.decode(raw)[None])


@dataclass
class Slices(InputPartition):
    files: list[tuple[int, str]]


class N5Source(DataSource):
    @classmethod
    def name(cls) -> str:
        return "voxelith-n5"

    def schema(self) -> str:
        return f"z long, y long, x long, `{self.options.get('value', 'label')}` long"

    def reader(self, schema) -> DataSourceReader:
        return N5Reader(dict(self.options))


class SlicesSource(N5Source):
    @classmethod
    def name(cls) -> str:
        return "voxelith-slices"

    def reader(self, schema) -> DataSourceReader:
        return SlicesReader(dict(self.options))


@dataclass
class Written(WriterCommitMessage):
    folder: str
    names: list[str]


class FilesWriter(DataSourceArrowWriter):
    """Rows (name, content) become files under an address. Tasks write into folders of their own; commit moves the files of those that count to their names, abort leaves none."""

    def __init__(self, options: dict):
        self.address, self.job = options["path"], uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, path = opened(self.address)
        folder, names, made = f"{path}/{PENDING}/{self.job}/{uuid.uuid4().hex}", [], set()
        for batch in iterator:
            for name, raw in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist(), strict=True):
                parent = f"{folder}/{name}".rpartition("/")[0]
                if parent not in made:
                    store.create_dir(parent)
                    made.add(parent)
                with store.open_output_stream(f"{folder}/{name}") as f:
                    f.write(raw)
                names.append(name)
        return Written(folder, names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, path = opened(self.address)
        made = set()
        for m in filter(None, messages):
            for name in m.names:
                parent = f"{path}/{name}".rpartition("/")[0]
                if parent not in made:
                    store.create_dir(parent)
                    made.add(parent)
                store.move(f"{m.folder}/{name}", f"{path}/{name}")
        self.clear(store, path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.clear(*opened(self.address))

    def clear(self, store: fs.FileSystem, path: str) -> None:
        own = f"{path}/{PENDING}"
        if store.get_file_info(f"{own}/{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{own}/{self.job}")
        if store.get_file_info(own).type == fs.FileType.Directory and not store.get_file_info(fs.FileSelector(own)):
            store.delete_dir(own)


class Files(DataSource):
    @classmethod
    def name(cls) -> str:
        return "voxelith-files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return FilesWriter(dict(self.options))


def register(spark: SparkSession) -> SparkSession:
    """spark, once it knows the sources and hands conditions on to Python ones."""
    for source in (N5Source, SlicesSource, Files):
        spark.dataSource.register(source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def write_n5(df: DataFrame, address: str, value: str, shape: tuple[int, int, int], block: int = 64, dtype: str = "uint64", compression: str = "gzip") -> None:
    """df (z, y, x, value) as blocks of a dataset; voxels that it lacks are 0, blocks without any are left out. All files appear when all are written."""
    about = {"dimensions": list(shape[::-1]), "blockSize": [block] * 3, "dataType": dtype, "compression": {"type": compression}}
    keyed = df.select(*AXES, F.col(value).cast("long").alias("_v"), *cells(Grid((block,) * 3)))

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        at = [k.as_py() for k in key]
        size = [min(block, n - i * block) for n, i in zip(shape, at, strict=True)]
        out = np.zeros(size, dtype)
        out[tuple(table.column(a).to_numpy() - i * block for a, i in zip(AXES, at, strict=True))] = table.column("_v").to_numpy()
        return pa.table({"name": [f"{at[2]}/{at[1]}/{at[0]}"], "content": pa.array([n5.encode_block(out, compression)], pa.binary())})

    spark = register(df.sparkSession)
    head = spark.createDataFrame([("attributes.json", json.dumps(about).encode())], "name string, content binary")
    packed = keyed.groupBy("bz", "by", "bx").applyInArrow(pack, "name string, content binary")
    head.union(packed).write.format("voxelith-files").mode("append").save(address)


def write_slices(df: DataFrame, pattern: str, value: str, shape: tuple[int, int, int]) -> None:
    """df as an image for each complete slice, named by the pattern (`.../z{:05d}.png` or `.pgm`)."""
    prefix, number, suffix = slices.split_pattern(pattern)
    folder, _, name = prefix.rpartition("/")
    named = lambda z: F.format_string(name.replace("%", "%%") + number.replace("{:", "%").replace("{}", "%d").replace("}", "") + suffix.replace("%", "%%"), z)
    images = slices.images(df, value, shape, suffix.lower().endswith(".png"))
    register(df.sparkSession)
    images.select(named(F.col("z")).alias("name"), F.col("image").alias("content")).write.format("voxelith-files").mode("append").save(folder)
