"""Shared small helpers: scratch tables in the shared folder, column checks, batches."""

from __future__ import annotations

import contextlib
import ctypes
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.session import checkpoint_dir


class Scratch:
    """Written tables under the shared checkpoint folder, which cut lineage and
    survive lost executors.  ``drop`` removes a table no later step reads."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        self.n = 0

    def path(self) -> str:
        self.n += 1
        return f"{self.root}/{self.n}"

    def write(self, df: DataFrame) -> "Written":
        path = self.path()
        df.write.parquet(path)
        return Written(self.spark, path)


#: Rows of a table of a few numbers that may be broadcast: about 64 MB at most.
BROADCAST_ROWS = 2_000_000


class Written:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def small(self) -> DataFrame:
        """The table (of a few fixed-width columns) with a broadcast hint if its counted rows
        allow it, so that a join leaves the texts where they are; else as it is, for a
        shuffled join."""
        return F.broadcast(self.df) if self.df.count() <= BROADCAST_ROWS else self.df

    @property
    def df(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def drop(self) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        at.getFileSystem(conf).delete(at, True)


BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
TRACEBACK_CONF = "spark.sql.execution.pyspark.udf.simplifiedTraceback.enabled"


def reach_workers(spark: SparkSession) -> None:
    """Sets the session up for Arrow functions over texts, and lets Python workers import
    this package where it was not installed or shipped (``--py-files``) but lies beside
    the driver's script, as in tests."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    # Rows reach Python in batches by bytes; texts are long, so these are kept small.
    spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    # It is part of the environment of map functions' workers but not of those of grouped ones, so an executor
    # that runs both would keep two sets of workers, each with its own caches.
    spark.conf.set(TRACEBACK_CONF, "false")
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def narrow(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text alone, under fixed names: other columns, whatever they are
    called, don't reach the operator."""
    reach_workers(docs.sparkSession)
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], after: Callable[[], None] | None = None):
    """The mapInArrow function, which at the end of a task calls ``after`` and gives freed
    memory back to the system: workers live on between tasks, and an executor's memory
    limit counts what their allocators keep."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            if after:
                after()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):      # another C library than glibc
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return whole


def byte_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Row slices whose texts hold about ``limit`` bytes together, in order."""
    import numpy as np
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, lo = np.cumsum(sizes), 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi
