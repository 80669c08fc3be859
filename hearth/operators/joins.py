"""J1/J2 building block: joins against fitted (small) tables.

A fitted table (group statistics, vocabularies, cut points) is materialised
once and its row count checked.  Only when it is within ``max_rows`` is it
broadcast, which leaves the big side unshuffled; beyond the bound the join is
a plain shuffle join and AQE's skew-join splitting protects hot keys.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.constants import BROADCAST_MAX_ROWS


def materialise(df: DataFrame) -> tuple[DataFrame, int]:
    """Persist a fitted table (recomputable from lineage on executor loss)."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    return df, df.count()


def bounded(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``small`` with a broadcast hint if its checked size allows it.  A table
    over the bound is released again and joined by shuffle (AQE splits skew)."""
    kept, n = materialise(small)
    if n <= max_rows:
        return F.broadcast(kept)
    kept.unpersist()
    return small


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    return big.join(bounded(small, max_rows), on, how)


_TABLES: list[str] = []


def drop_tables(spark: SparkSession) -> None:
    """Deletes the tables that ``cut_lineage`` has written so far; for the end of a job,
    when no frame that reads them is used again."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    while _TABLES:
        path = spark._jvm.org.apache.hadoop.fs.Path(_TABLES.pop())
        path.getFileSystem(conf).delete(path, True)


def drop_table(df: DataFrame) -> None:
    """Deletes the table that ``cut_lineage`` wrote for ``df``, when no frame that reads it is used again."""
    if (path := getattr(df, "_table", None)) in _TABLES:
        _TABLES.remove(path)
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
        free_shuffles(spark)


def free_shuffles(spark: SparkSession) -> None:
    """Has the driver collect its garbage now: Spark deletes the shuffle files of a finished job when the job's
    objects are collected, which a driver with memory to spare puts off while the disk fills."""
    spark._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise an intermediate table reused by several later steps as a
    parquet table in the shared ``spark.checkpoint.dir``: it survives executor
    loss (unlike a local checkpoint), later actions read it instead of
    recomputing the upstream plan, and, being columnar, each later pass reads
    only the columns it needs."""
    import os
    import uuid
    from hearth.session import checkpoint_dir
    path = os.path.join(checkpoint_dir(df.sparkSession), f"table-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    _TABLES.append(path)
    out = df.sparkSession.read.parquet(path)
    out._table = path
    return out
