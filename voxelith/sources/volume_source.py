"""`spark.read.format("voxelith")`: analytic test volumes through the Python Data Source API, a run of blocks to a partition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


#: Voxels of one partition, about: blocks can be small, and a task has its price.
PER_PARTITION = 1 << 18


class Cells(InputPartition):
    """Blocks by number, in z, y, x order."""

    def __init__(self, start: int, stop: int):
        self.start, self.stop = start, stop


class GridSource(DataSource):
    """An analytic volume, a run of blocks to a partition: options shape ("z,y,x"), block, and period of the planes of 0 along x.

    Labels are the octant plus 1.
    """

    @classmethod
    def name(cls) -> str:
        return "voxelith"

    def schema(self) -> str:
        return "z long, y long, x long, label long"

    def reader(self, schema) -> DataSourceReader:
        return GridReader(self.options)


class GridReader(DataSourceReader):
    def __init__(self, options: dict):
        self.shape = [int(n) for n in options.get("shape", "24,24,24").split(",")]
        self.block = int(options.get("block", "12"))
        self.period = int(options.get("period", "8"))

    def grid(self) -> list[int]:
        """Blocks along z, y and x."""
        return [-(-n // self.block) for n in self.shape]

    def partitions(self) -> list[InputPartition]:
        count, run = int(np.prod(self.grid())), max(1, PER_PARTITION // self.block**3)
        return [Cells(a, min(count, a + run)) for a in range(0, count, run)]

    def read(self, cells: Cells) -> Iterator[pa.RecordBatch]:
        half = [n // 2 for n in self.shape]
        for number in range(cells.start, cells.stop):
            start = [int(c) * self.block for c in np.unravel_index(number, self.grid())]
            size = [min(self.block, n - s) for n, s in zip(self.shape, start, strict=True)]
            z, y, x = (a + s for a, s in zip(np.indices(size).reshape(3, -1), start, strict=True))
            label = np.where(x % self.period == self.period - 1, 0, 1 + 4 * (z >= half[0]) + 2 * (y >= half[1]) + (x >= half[2]))
            yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)) for v in (z, y, x, label)], names=["z", "y", "x", "label"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GridSource)
