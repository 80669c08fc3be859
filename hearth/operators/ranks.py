"""Distributed exact ranks and quantiles within groups.

Built-in ``percentile``/``median`` and ``Window.partitionBy(group)`` both put a
whole group into one task; with one location holding a third of all rows that
task would hold a third of the data.  Here a group never meets one task:

1. pre-aggregate to distinct ``(group, value) -> cnt`` (shuffle on group AND
   value, so a hot group spreads over all partitions; map-side combine first);
2. range-partition the distinct values by ``(group, value)`` and write them with
   the number of their partition as their slice: slices are ranges of values, as
   many as the table's size asks for, however wide one group is;
3. running counts inside each ``(group, slice)`` window, plus offsets from the
   table of counts per group and slice (at most groups + slices rows).

The result is exact: ``below`` is the weight of strictly smaller values in the
group, ``n`` the group's total weight.  Quantiles then need no join: each
distinct value knows whether it covers the target ranks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearth.constants import BROADCAST_MAX_ROWS
from hearth.operators.joins import cut_lineage

_ALL = "_all"


def _group_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    if keys:
        return df, list(keys)
    return df.withColumn(_ALL, F.lit(0)), [_ALL]


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None,
                slices: int | None = None) -> DataFrame:
    """Distinct ``(keys..., value, cnt, below, n)``; NULL values are not ranked.

    ``weight`` (default 1 per row) lets callers add zero-weight probe values,
    e.g. request rows ranked against a reference table.  ``slices`` forces the
    number of range partitions, which otherwise follows the session's settings.
    """
    df, gk = _group_keys(df.filter(F.col(value).isNotNull()), keys)
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    vc = df.groupBy(*gk, value).agg(F.sum(w).alias("cnt"))
    vc = vc.repartitionByRange(slices, *gk, value) if slices else vc.repartitionByRange(*gk, value)
    # Written, so that a repeated task can't deal the values out differently.
    vc = cut_lineage(vc.withColumn("_slice", F.spark_partition_id()))
    by_group = Window.partitionBy(*gk)
    offsets = vc.groupBy(*gk, "_slice").agg(F.sum("cnt").alias("_slice_cnt"))
    offsets = cut_lineage(offsets.select(
        *gk, "_slice",
        (F.sum("_slice_cnt").over(by_group.orderBy("_slice")) - F.col("_slice_cnt")).alias("_offset"),
        F.sum("_slice_cnt").over(by_group).alias("n")))
    in_slice = Window.partitionBy(*gk, "_slice").orderBy(value)
    vc = vc.withColumn("_below", F.sum("cnt").over(in_slice) - F.col("cnt"))
    # Fixed-width rows, counted; group names can be long strings, so far under the bound for rows.
    out = _join_on_groups(vc, offsets, gk, extra=["_slice"], broadcast=offsets.count() <= BROADCAST_MAX_ROWS // 10).select(
        *gk, value, "cnt", (F.col("_offset") + F.col("_below")).alias("below"), "n")
    return out if keys else out.drop(_ALL)


def _join_on_groups(left: DataFrame, right: DataFrame, gk: Sequence[str], extra: Sequence[str] = (),
                    broadcast: bool = False) -> DataFrame:
    """Inner join on the group keys with NULL-safe equality (a NULL group is a
    group, as in SQL GROUP BY) plus plain equality on ``extra`` columns.
    ``broadcast`` only when the caller has counted the right side's size."""
    ren = {k: f"_r_{k}" for k in [*gk, *extra]}
    r = right.withColumnsRenamed(ren)
    cond = [F.col(k).eqNullSafe(F.col(ren[k])) for k in gk] + [F.col(k) == F.col(ren[k]) for k in extra]
    return left.join(F.broadcast(r) if broadcast else r, cond).drop(*ren.values())


def _interp(lo_v: Column, hi_v: Column, frac: Column) -> Column:
    return lo_v + (hi_v - lo_v) * frac


def quantiles_from_ranks(ranks: DataFrame, keys: Sequence[str], value: str,
                         probs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """Linear-interpolation quantiles (``quantile_cont``) per group, one aggregate."""
    names = list(names) if names else [f"q{int(round(p * 100)):02d}" for p in probs]
    ranks, gk = _group_keys(ranks, keys)
    n1 = F.col("n") - 1
    aggs, finals = [], []
    for p, name in zip(probs, names):
        pos = n1 * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        covers = lambda r: (F.col("below") <= r) & (r < F.col("below") + F.col("cnt"))
        aggs += [F.max(F.when(covers(lo), F.col(value))).alias(f"_{name}_lo"),
                 F.max(F.when(covers(hi), F.col(value))).alias(f"_{name}_hi"),
                 F.max(pos - lo).alias(f"_{name}_f")]
        finals.append(_interp(F.col(f"_{name}_lo").cast("double"), F.col(f"_{name}_hi").cast("double"),
                              F.col(f"_{name}_f")).alias(name))
    out = ranks.groupBy(*gk).agg(F.max("n").alias("n"), *aggs).select(*gk, "n", *finals)
    return out if keys else out.drop(_ALL)


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
              names: Sequence[str] | None = None, slices: int | None = None,
              exact: bool = True, accuracy: int = 10000, weight: str | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles by default; ``exact=False`` uses the
    bounded-memory ``percentile_approx`` sketch in one aggregate instead."""
    if exact:
        return quantiles_from_ranks(value_ranks(df, keys, value, weight, slices), keys, value, probs, names)
    names = list(names) if names else [f"q{int(round(p * 100)):02d}" for p in probs]
    df, gk = _group_keys(df.filter(F.col(value).isNotNull()), keys)
    q = F.percentile_approx(F.col(value).cast("double"), list(probs), accuracy)
    out = df.groupBy(*gk).agg(F.count("*").alias("n"), q.alias("_q"))
    out = out.select(*gk, "n", *[F.col("_q").getItem(i).alias(n) for i, n in enumerate(names)])
    return out if keys else out.drop(_ALL)


# Stored rank index ------------------------------------------------------------
#: Distinct values of a block of the index.
BLOCK_VALUES = 64


@dataclass
class RankIndex:
    """Ranks of a reference table, written once and looked up by any batch.

    ``values(_g, _v, _below)``: each distinct value and the rows below it.  ``tops(_g, _n, _starts)``: a
    group's rows and the first value of each of its blocks.  ``blocks(_g, _block, _vs, _after)``: the values of
    a block in order and the rows up to and with each.  A value that the reference holds is found by
    equality; another one finds its block among the starts and its place in the block, both as-of: the largest
    value below it.  Neither ranks the batch nor shuffles its distinct values.

    Tables whose counted rows fit the bound carry a broadcast hint, so a lookup leaves the batch where it is;
    beyond it the joins shuffle on (group, value) and (group, block), which a hot group can't fill alone."""

    values: DataFrame
    tops: DataFrame
    blocks: DataFrame

    def lookup(self, df: DataFrame, group: str, value: str, below: str = "below", n: str = "n") -> DataFrame:
        """``df`` with the reference rows of its group below its value, and all of them; both NULL for a
        group that the reference lacks, ``below`` NULL for a NULL value."""
        x = F.col(value).cast("double")
        out = df.join(self.tops, F.col(group) == F.col("_g"), "left").drop("_g")
        out = out.join(self.values, (F.col(group) == F.col("_g")) & (x == F.col("_v")), "left").drop("_g", "_v")
        block = F.size(F.filter("_starts", lambda s: s < x)) - 1
        # known values look up no block
        out = out.withColumn("_at", F.when(F.col("_below").isNull() & F.col("_starts").isNotNull() & x.isNotNull(), block)).drop("_starts")
        out = out.join(self.blocks, (F.col(group) == F.col("_g")) & (F.col("_at") == F.col("_block")), "left").drop("_g", "_block")
        place = F.size(F.filter("_vs", lambda v: v < x))
        found = F.when(F.col("_at") < 0, F.lit(0).cast("bigint")).otherwise(F.col("_after")[place - 1])
        return out.withColumns({below: F.coalesce("_below", found), n: F.col("_n")}).drop("_below", "_at", "_vs", "_after", "_n")

    def write(self, path: str) -> None:
        for name in ("values", "tops", "blocks"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, path: str, max_rows: int = BROADCAST_MAX_ROWS) -> "RankIndex":
        return cls(*(hinted(spark.read.parquet(f"{path}/{name}"), max_rows) for name in ("values", "tops", "blocks")))


def hinted(table: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """A written table with a broadcast hint if its counted rows allow it; rows that hold blocks count for
    their values."""
    each = BLOCK_VALUES if "_vs" in table.columns else 1
    return F.broadcast(table) if table.count() * each <= max_rows else table


def rank_index(hist: DataFrame, group: str = "_loc", value: str = "_area", weight: str = "cnt",
               max_rows: int = BROADCAST_MAX_ROWS, rows: int | None = None) -> RankIndex:
    """Index of ``hist(group, value, weight)``, whose (group, value) pairs are distinct; ``rows``: how many, if
    they are counted already.  Histograms of up to ``max_rows`` rows are counted up in one window a group, and
    their tables, no larger than they are, carry broadcast hints; larger ones go by ``value_ranks``, in
    ranges, and their tables are written and counted."""
    hist = hist.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(
        F.col(group).alias("_g"), F.col(value).cast("double").alias("_v"), F.col(weight).cast("bigint").alias("_w"))
    if rows is None:
        hist = cut_lineage(hist)
        rows = hist.count()
    if rows <= max_rows:
        keep = hint = F.broadcast
        whole, upto = Window.partitionBy("_g"), Window.partitionBy("_g").orderBy("_v")
        ranks = hist.select("_g", "_v", (F.sum("_w").over(upto) - F.col("_w")).alias("_below"), "_w",
                            F.sum("_w").over(whole).alias("_n"), (F.row_number().over(upto) - 1).alias("_pos"))
    else:
        keep, hint = lambda t: hinted(cut_lineage(t), max_rows), lambda t: hinted(t, max_rows)
        places = value_ranks(hist, ["_g"], "_v").select("_g", "_v", F.col("below").alias("_pos"))
        ranks = cut_lineage(value_ranks(hist, ["_g"], "_v", "_w").withColumnsRenamed({"below": "_below", "cnt": "_w", "n": "_n"})
                            .join(places, ["_g", "_v"]))
    ranks = ranks.withColumn("_block", F.floor(F.col("_pos") / BLOCK_VALUES).cast("int"))
    each = F.array_sort(F.collect_list(F.struct("_v", (F.col("_below") + F.col("_w")).alias("_after"))))     # BLOCK_VALUES of them
    blocks = ranks.groupBy("_g", "_block").agg(each.alias("_rows"), F.max("_n").alias("_n")).select(
        "_g", "_block", F.col("_rows._v").alias("_vs"), F.col("_rows._after").alias("_after"), "_n")
    tops = blocks.groupBy("_g").agg(F.max("_n").alias("_n"), F.array_sort(F.collect_list(F.col("_vs")[0])).alias("_starts"))
    return RankIndex(hint(ranks.select("_g", "_v", "_below")), keep(tops), keep(blocks.drop("_n")))
