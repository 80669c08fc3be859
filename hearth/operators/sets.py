"""Union of splits, key-tuple overlap between splits, schema differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.constants import OVERLAP_KEY, OVERLAP_MAX_SHARE


def union_splits(*frames: DataFrame) -> DataFrame:
    """G1: ``concat(ignore_index=True)`` = unionByName (columns matched by name)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def split_overlap(df: DataFrame, keys: Sequence[str] = OVERLAP_KEY, split: str = "split",
                  pairs: Sequence[tuple[str, str]] = (("train", "val"), ("train", "test"), ("val", "test")),
                  bound: float = OVERLAP_MAX_SHARE) -> DataFrame:
    """Distinct key tuples shared by two splits, as a share of the LEFT
    split's distinct tuples.  One shuffle on the key for all pairs: each
    distinct tuple learns which splits it occurs in."""
    names = sorted({s for p in pairs for s in p})
    tuples = df.groupBy(*keys).agg(*[F.max((F.col(split) == s).cast("int")).alias(f"_in_{s}")
                                     for s in names])
    aggs = [F.sum(f"_in_{s}").alias(f"_n_{s}") for s in names]
    aggs += [F.sum(F.col(f"_in_{a}") * F.col(f"_in_{b}")).alias(f"_o_{a}_{b}") for a, b in pairs]
    wide = tuples.agg(*aggs)
    rows = [F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"),
                     F.col(f"_n_{a}").alias("left_tuples"), F.col(f"_o_{a}_{b}").alias("overlap"))
            for a, b in pairs]
    out = wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
    share = F.try_divide(F.col("overlap").cast("double"), F.col("left_tuples").cast("double"))
    return out.withColumn("share", share).withColumn("ok", F.col("share") < bound)


def schema_diff(spark: SparkSession, left: DataFrame, right: DataFrame) -> DataFrame:
    """(column, side, position) for columns missing on either side, plus an
    'order' row when both sides have the same columns in a different order."""
    lc, rc = left.columns, right.columns
    rows = [(c, "left_only", lc.index(c)) for c in lc if c not in rc]
    rows += [(c, "right_only", rc.index(c)) for c in rc if c not in lc]
    if not rows and lc != rc:
        rows.append(("*", "order_differs", -1))
    return spark.createDataFrame(rows, "column STRING, side STRING, position INT")
