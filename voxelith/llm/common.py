"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelith.sources.scratch import Scratch, released

__all__ = ["BROADCAST_ROWS", "SPACE", "WORD", "Scratch", "Shared", "normalised", "partitions", "released", "short_batches", "small", "stateless", "table", "word_count", "worker_state"]

#: White space of the query contracts; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows up to which a side whose count has been taken is broadcast.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Documents that go to a Python worker at once. Spark's own bound of 10,000 rows holds tens of MB of text several times over,
#: in the executor's process and in the worker's.
BATCH_ROWS = 1_000


def short_batches(df: DataFrame) -> DataFrame:
    """df, once its session sends Python no more than BATCH_ROWS rows at once; a lower bound of the session's own stays."""
    name, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


class Shared:
    """A broadcast as a key of worker_state: equal if it is the same one, in whichever task it was unpickled."""

    def __init__(self, broadcast):
        self.broadcast, self.key = broadcast, uuid.uuid4().hex

    @property
    def value(self):
        return self.broadcast.value

    def __hash__(self) -> int:
        return hash(self.key)

    def __eq__(self, other) -> bool:
        return isinstance(other, Shared) and self.key == other.key


_state: list = [None, None]


def worker_state(key: tuple, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps for its later tasks: the state of one operator at a time; that of another gives way first."""
    if _state[0] != key:
        _state[:] = None, None
        release()
        _state[:] = key, make()
    return _state[1]


def stateless() -> None:
    """For operators that keep nothing: what another one kept goes."""
    if _state[0] is not None:
        _state[:] = None, None
    release()


def release() -> None:
    """Gives memory that Python has freed back to the system, where the C library can."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
    pa.default_memory_pool().release_unused()


#: Bytes of input for each partition of a sort of whole texts, and partitions at most: each adds to the sample that the
#: driver takes for the splitters. Beyond them partitions get larger, and the external sort spills.
SORT_BYTES, SORT_PARTITIONS = 256 << 20, 20_000
#: Spark's estimate for what it knows nothing about is larger.
UNKNOWN_SIZE = 1 << 53


def partitions(df: DataFrame) -> int:
    """Partitions of a sort of df: by its size as Spark estimates it, the session's number at least."""
    least = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return least if size > UNKNOWN_SIZE else max(least, min(SORT_PARTITIONS, -(-size // SORT_BYTES)))


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a side of a counted or proven size; a larger one stays a shuffled join."""
    return F.broadcast(df) if rows <= limit else df


def normalised(text: str | Column) -> Column:
    """Null as empty, each run of white space as one space."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), SPACE, " ")


def word_count(text: str | Column) -> Column:
    return F.regexp_count(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WORD)).cast("long")
