"""Deterministic splits, folds, strata and samples.

All assignments are functions of the row key (md5), so they need no shuffle,
are stable under repartitioning and reproduce identically when a task is
recomputed after executor loss.  The exact-quota split ranks rows inside each
stratum with the distributed rank operator (no per-stratum window).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.constants import N_FOLDS, RANDOM_STATE, SPLIT_RATIOS
from hearth.functions.features import quartile_of
from hearth.functions.hashing import bucket32, bucket60, unit_hash
from hearth.operators.joins import join_small
from hearth.operators.ranks import quantiles, value_ranks


def _split_of(u, ratios: Sequence[float]):
    train, val, _ = ratios
    return (F.when(u < F.lit(train), "train")
            .when(u < F.lit(train + val), "val").otherwise("test"))


def hash_split(df: DataFrame, keys: Sequence[str], ratios: Sequence[float] = SPLIT_RATIOS,
               seed: int = RANDOM_STATE, name: str = "split") -> DataFrame:
    """Each row goes to train/val/test by the uniform hash of its key."""
    return df.withColumn(name, _split_of(unit_hash(keys, seed), ratios))


def fold_assign(df: DataFrame, keys: Sequence[str], k: int = N_FOLDS,
                seed: int | None = RANDOM_STATE, name: str = "fold") -> DataFrame:
    """M3: every row in exactly one of k folds."""
    return df.withColumn(name, F.pmod(bucket32(keys, seed), F.lit(k)).cast("int"))


def target_cuts(df: DataFrame, target: str = "Rent") -> DataFrame:
    """The three quartile cut points of the target as one row (exact)."""
    q = quantiles(df, [], target, [0.25, 0.5, 0.75], ["c25", "c50", "c75"])
    return q.select(F.array("c25", "c50", "c75").alias("_cuts"))


def strata(df: DataFrame, location: str = "Location", target: str = "Rent",
           min_location_rows: int = 10) -> DataFrame:
    """Stratum = location frequency class x target quartile.  Locations with fewer
    than ``min_location_rows`` rows share one 'rare' class."""
    counts = df.groupBy(location).agg(F.count("*").alias("_loc_rows"))
    out = join_small(df, counts, location, "left")
    out = attach_one_row(out, target_cuts(df, target))
    loc_class = F.when(F.col("_loc_rows") >= min_location_rows, F.col(location)).otherwise("__rare__")
    q = quartile_of(F.col(target), F.col("_cuts"))
    return out.withColumn("stratum", F.concat_ws("#", loc_class, q.cast("string"))) \
              .drop("_loc_rows", "_cuts")


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a fitted one-row table (an aggregate without grouping, so its
    size is 1 by construction) to every row: broadcast equi-join on a constant."""
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one", "left")
            .drop("_one"))


def quota_split(df: DataFrame, keys: Sequence[str], stratum: str = "stratum",
                ratios: Sequence[float] = SPLIT_RATIOS, seed: int = RANDOM_STATE,
                name: str = "split") -> DataFrame:
    """M1 exact quotas: inside each stratum, rows ordered by key hash; position
    share = (rows with a smaller hash) / stratum rows decides the split."""
    h = df.withColumn("_h", bucket60(keys, seed))
    ranks = value_ranks(h, [stratum], "_h").select(stratum, "_h", "below", "n")
    # One rank row per distinct hash, i.e. about one per input row: a table that
    # grows with the data is never broadcast or persisted; a shuffle join on
    # (stratum, hash) spreads evenly because the hash does.
    out = h.join(ranks, [stratum, "_h"], "left")
    return out.withColumn(name, _split_of(F.col("below") / F.col("n"), ratios)) \
              .drop("_h", "below", "n")


def seeded_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = RANDOM_STATE) -> DataFrame:
    """N rows with the smallest key hash (distributed top-n, no shuffle of rows)."""
    h = bucket32(keys, seed)
    return df.withColumn("_h", h).orderBy("_h", *keys).limit(n).drop("_h")
