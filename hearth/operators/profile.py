"""Data profiles and audit aggregates.

Each operator is one (or a few) aggregate passes with partial aggregation;
quantiles use the distributed exact operator of ``hearth.operators.ranks``.
Wide-to-long reshapes use ``unpivot`` so every column is profiled in the same
aggregate instead of one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.constants import BASELINE_QUANTILES, LOW_SIGNAL_MIN, MULTICOLLINEARITY_MAX, SHARE_BOUNDS
from hearth.functions.features import safe_corr
from hearth.operators.joins import cut_lineage
from hearth.operators.ranks import quantiles


def melt(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = (),
         var: str = "column", val: str = "value") -> DataFrame:
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]) \
             .unpivot(list(ids), list(cols), var, val)


# A3 --------------------------------------------------------------------------
def target_summary(df: DataFrame, target: str = "Rent") -> DataFrame:
    moments = df.agg(F.count(target).alias("n"), F.avg(target).alias("mean"),
                     F.min(target).alias("min"), F.max(target).alias("max"))
    med = quantiles(df, [], target, [0.5], ["median"]).drop("n")
    return moments.withColumn("_k", F.lit(1)).join(
        F.broadcast(med.withColumn("_k", F.lit(1))), "_k", "left").drop("_k")


# A4 --------------------------------------------------------------------------
def category_cardinality(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-null values per column, long form (column, n_unique)."""
    f = F.approx_count_distinct if approx else F.countDistinct
    wide = df.agg(*[f(c).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "n_unique")


# A5 / Q8 ---------------------------------------------------------------------
def null_counts(df: DataFrame, cols: Sequence[str] | None = None, keep_zero: bool = False) -> DataFrame:
    """Null count per column in one aggregate; only columns with nulls unless keep_zero."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    out = wide.unpivot([], cols, "column", "nulls")
    return out if keep_zero else out.where("nulls > 0")


def non_finite_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q8: NULL, NaN and +/-inf per numeric column."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count_if(x.isNull()).alias(f"{c}__null"),
                 F.count_if(F.isnan(x)).alias(f"{c}__nan"),
                 F.count_if(F.abs(x) == F.lit(float("inf"))).alias(f"{c}__inf")]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__null").alias("nulls"),
                 F.col(f"{c}__nan").alias("nans"), F.col(f"{c}__inf").alias("infs"))
        for c in cols])).alias("s")).select("s.*")


# A9 --------------------------------------------------------------------------
def baseline_profile(df: DataFrame, cols: Sequence[str],
                     probs: Sequence[float] = BASELINE_QUANTILES, by: Sequence[str] = ()) -> DataFrame:
    """mean, std, min, max and linear-interpolation quantiles per column (and
    per ``by`` group, e.g. split, so several profiles come from one pass)."""
    keys = [*by, "column"]
    names = [f"q{int(round(p * 100))}" for p in probs]
    q = quantiles(melt(df, cols, by), keys, "value", probs, names).drop("n")
    return moment_profile(df, cols, by).join(q, keys, "left")


def moment_profile(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """mean, std, min, max per column (and ``by`` group) from one wide aggregate."""
    stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.groupBy(*by).agg(*[f(F.col(c).cast("double")).alias(f"{c}__{n}") for c in cols for n, f in stats.items()])
    return wide.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{n}").alias(n) for n in stats]) for c in cols])))


# A10 / A11 -------------------------------------------------------------------
def split_shares(df: DataFrame, split: str = "split", bounds: dict = SHARE_BOUNDS) -> DataFrame:
    """Rows and share of each split, and whether the share is within its bounds
    (null for a split without bounds)."""
    counts = df.groupBy(split).agg(F.count("*").alias("rows"))
    total = F.sum("rows").over(_whole())
    within = F.lit(None).cast("boolean")
    for name, (lo, hi) in bounds.items():
        within = F.when(F.col(split) == name, F.col("share").between(lo, hi)).otherwise(within)
    return counts.withColumn("share", F.col("rows") / total).withColumn("within_bounds", within)


def stratum_shares(df: DataFrame, stratum: str = "stratum", split: str = "split") -> DataFrame:
    """Rows of each stratum and the share of each split within it: the report of
    a stratified split."""
    names = ("train", "val", "test")
    out = df.groupBy(stratum).agg(F.count("*").alias("rows"), *[
        F.count_if(F.col(split) == n).alias(f"{n}_rows") for n in names])
    return out.withColumns({f"{n}_share": F.col(f"{n}_rows") / F.col("rows") for n in names})


def _whole():
    from pyspark.sql import Window
    # Over the per-split count rows (3 rows), not over data rows.
    return Window.partitionBy(F.lit(0))


def split_mean_ratio(df: DataFrame, target: str = "Rent", split: str = "split",
                     base: str = "train", tolerance: float = 0.10) -> DataFrame:
    means = df.groupBy(split).agg(F.avg(target).alias("mean"))
    base_mean = F.max(F.when(F.col(split) == base, F.col("mean"))).over(_whole())
    ratio = F.col("mean") / base_mean
    return means.withColumn("ratio_to_train", ratio).withColumn(
        "within_tolerance", (F.col("ratio_to_train") >= 1 - tolerance) & (F.col("ratio_to_train") <= 1 + tolerance))


# A12-A15 ---------------------------------------------------------------------
def feature_target_corr(df: DataFrame, features: Sequence[str], target: str = "Rent",
                        low_signal: float = LOW_SIGNAL_MIN) -> DataFrame:
    wide = df.agg(*[safe_corr(f, target).alias(f) for f in features])
    out = wide.unpivot([], list(features), "feature", "corr")
    return out.withColumn("low_signal", F.abs("corr") < low_signal)


def pairwise_corr(df: DataFrame, features: Sequence[str],
                  bound: float = MULTICOLLINEARITY_MAX) -> DataFrame:
    """All feature pairs (a < b in list order), each over the rows where both are known, from two aggregates.

    The first has each column's known rows, mean and range.  The second sums the columns, shifted by their
    means, and their products once for all pairs of columns without NULLs; pairs with one that has some are summed
    over their own rows.  A pair with a constant column has no correlation."""
    x = {c: F.col(c).cast("double") for c in features}
    head = df.agg(F.count("*").alias("n"), *[f(x[c]).alias(f"{c}__{n}") for c in features
                                             for n, f in (("k", F.count), ("m", F.avg), ("lo", F.min), ("hi", F.max))]).first()
    whole = [c for c in features if head[f"{c}__k"] == head["n"]]
    shifted = {c: x[c] - F.lit(head[f"{c}__m"]) for c in whole}
    sums = [F.sum(shifted[c]).alias(f"s_{c}") for c in whole]
    sums += [F.sum(shifted[a] * shifted[b]).alias(f"s_{a}__{b}") for i, a in enumerate(whole) for b in whole[i:]]
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1:]]
    odd = [(a, b) for a, b in pairs if a not in shifted or b not in shifted]
    sums += [safe_corr(F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))).alias(f"c_{a}__{b}") for a, b in odd]
    n = F.lit(float(head["n"]))

    def moment(a: str, b: str):
        return F.col(f"s_{a}__{b}") - F.col(f"s_{a}") * F.col(f"s_{b}") / n

    def corr(a: str, b: str):
        if (a, b) in odd:
            return F.col(f"c_{a}__{b}")
        varies = all(head[f"{c}__lo"] is not None and head[f"{c}__lo"] < head[f"{c}__hi"] for c in (a, b))
        return moment(a, b) / F.sqrt(moment(a, a) * moment(b, b)) if varies else F.lit(None).cast("double")

    out = df.agg(*sums).select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), corr(a, b).alias("corr")) for a, b in pairs])))
    return out.withColumn("above_bound", F.abs("corr") >= bound)


def samples_per_feature(df: DataFrame, n_features: int) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn(
        "samples_per_feature", F.col("rows") / F.lit(float(n_features)))


# A16 -------------------------------------------------------------------------
def feature_collision(df: DataFrame, features: Sequence[str], target: str = "Rent") -> DataFrame:
    """Rows repeating an earlier row's features AND target ("duplicates"), and
    rows whose feature tuple occurs with more than one target value."""
    by_target = df.groupBy(*features, target).agg(F.count("*").alias("_c"))
    by_feat = by_target.groupBy(*features).agg(
        F.sum("_c").alias("_rows"), F.count("*").alias("_targets"),
        F.sum(F.col("_c") - 1).alias("_dups"))
    return by_feat.agg(
        F.sum("_rows").alias("rows"),
        F.count("*").alias("feature_tuples"),
        F.sum("_dups").alias("duplicate_rows"),
        F.sum(F.when(F.col("_targets") > 1, F.col("_rows")).otherwise(0)).alias("conflicting_rows"),
        F.count_if(F.col("_targets") > 1).alias("conflicting_tuples"))


# A17 -------------------------------------------------------------------------
def contamination_check(df: DataFrame, group: str = "Location", value: str = "Area_in_sqft",
                        split: str = "split") -> DataFrame:
    """Per group: median over all rows vs over train rows vs over test rows.
    A feature built from the combined median proves test rows leaked."""
    counts = cut_lineage(df.groupBy(group, value, split).agg(F.count("*").alias("_c")))
    whole = counts.groupBy(group, value).agg(F.sum("_c").alias("_c")).withColumn(split, F.lit("all"))
    q = quantiles(counts.unionByName(whole), [group, split], value, [0.5], ["median"], weight="_c").drop("n")
    return q.groupBy(group).pivot(split, ["all", "train", "val", "test"]).agg(F.first("median")) \
            .withColumnsRenamed({"all": "median_all", "train": "median_train",
                                 "val": "median_val", "test": "median_test"})
