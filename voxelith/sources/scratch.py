"""Tables that cut lineage: written to the folder that driver and executors share, and reread."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Of each local application without a folder of its own: the one that it has here.
_own: dict[str, str] = {}
#: Those not cleared yet, in order.
_made: list[Scratch] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset, a temporary folder in local mode; a cluster has to name one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        if context.applicationId not in _own:
            _own[context.applicationId] = f"file://{tempfile.mkdtemp(prefix='voxelith-')}"
        where = _own[context.applicationId]
    return where.rstrip("/")


#: Of tables of a known size.
ROWS_PER_FILE = 10_000


class Scratch:
    """Written tables of one call of an operator. They stay until clear(), a closing released() block, or the end of the program."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        _made.append(self)

    def store(self, df: DataFrame, rows: int | None = None, codec: str | None = None) -> DataFrame:
        """rows: about how many there are at most, where that is known; then a small table is not spread over many files. codec: instead of the session's."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        if rows is not None:
            df = df.coalesce(1 + rows // ROWS_PER_FILE)
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def clear(self) -> None:
        """Everything that was stored here goes."""
        if self.n:
            self._delete(self.root)
        with contextlib.suppress(ValueError):
            _made.remove(self)

    def _delete(self, where: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def free(self, *frames: DataFrame) -> None:
        for df in frames:
            self._delete(df._scratch_path)


def checkpoint(df: DataFrame, path: str, rollback: bool = True) -> DataFrame:
    """df written to path and reread; with rollback, what a complete earlier run has written there is taken instead."""
    spark = df.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not rollback or not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def released(*kept: Scratch) -> Iterator[None]:
    """What operators store inside goes at the end, but for `kept`; what is still needed has to be written or counted by then."""
    before = set(map(id, _made)) | set(map(id, kept))
    try:
        yield
    finally:
        for s in [s for s in _made if id(s) not in before]:
            s.clear()


@atexit.register
def _at_end() -> None:
    for s in list(_made):
        with contextlib.suppress(Exception):  # the session may be gone
            if s.spark.sparkContext._jsc is not None:
                s.clear()
