"""Q6-Q13: data contracts and audits as DataFrames of check results.

Row-level checks are one aggregate pass (``count_if`` per rule); schema-level
checks read only metadata.  ``audit_report`` unions everything into
(check, status, detail) rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearth.constants import DRIFT_THRESHOLD, FEATURE_RANGES, FORBIDDEN_COLUMNS


def forbidden_columns(spark: SparkSession, df: DataFrame,
                      forbidden: Sequence[str] = FORBIDDEN_COLUMNS) -> DataFrame:
    """Q6: each forbidden (target-derived) column and whether it is present."""
    return spark.createDataFrame([(c, c in df.columns) for c in forbidden],
                                 "column STRING, present BOOLEAN")


def range_rules(df: DataFrame, rules: Sequence[tuple] = FEATURE_RANGES) -> DataFrame:
    """Q7: per rule (column, min, max) the number of violating rows, one pass.
    A NULL value is not a violation here (null checks are separate)."""
    aggs, meta = [], []
    for i, (c, lo, hi) in enumerate(rules):
        x = F.col(c).cast("double")
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (x < F.lit(float(lo)))
        if hi is not None:
            bad = bad | (x > F.lit(float(hi)))
        aggs.append(F.count_if(bad).alias(f"_r{i}"))
        meta.append((i, c, lo, hi))
    wide = df.agg(F.count("*").alias("_rows"), *aggs)
    rows = [F.struct(F.lit(c).alias("column"),
                     F.lit(None if lo is None else float(lo)).cast("double").alias("min"),
                     F.lit(None if hi is None else float(hi)).cast("double").alias("max"),
                     F.col(f"_r{i}").alias("violations"), F.col("_rows").alias("rows"))
            for i, c, lo, hi in meta]
    out = wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
    return out.withColumn("passed", F.col("violations") == 0)


def validation_rules(df: DataFrame, rules: Sequence[tuple]) -> DataFrame:
    """Q7 with hard and expected bounds: (column, hard_min, hard_max, exp_min, exp_max)."""
    aggs = []
    for c, hmin, hmax, emin, emax in rules:
        x = F.col(c).cast("double")
        aggs.append(F.count_if((x < hmin) | (x > hmax)).alias(f"{c}__hard"))
        exp = F.lit(False)
        if emin is not None:
            exp = exp | (x < emin)
        if emax is not None:
            exp = exp | (x > emax)
        aggs.append(F.count_if(exp).alias(f"{c}__expected"))
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__hard").alias("hard_violations"),
                 F.col(f"{c}__expected").alias("outside_expected"))
        for c, *_ in rules])).alias("s")).select("s.*")


def formula_check(df: DataFrame, formulas: dict[str, Column], rtol: float = 1e-5) -> DataFrame:
    """Q9: rows where a stored feature differs from its re-derived value."""
    aggs = []
    for name, expected in formulas.items():
        a = F.col(name).cast("double")
        e = expected.cast("double")
        bad = (F.abs(a - e) > F.lit(rtol) * F.abs(e)) | (a.isNull() != e.isNull())
        aggs.append(F.count_if(bad).alias(name))
    wide = df.agg(*aggs)
    return wide.unpivot([], list(formulas), "feature", "mismatches")


def type_conformance(spark: SparkSession, df: DataFrame, numeric: Sequence[str],
                     categorical: Sequence[str]) -> DataFrame:
    """Q10: declared role vs actual Spark type."""
    types = dict(df.dtypes)
    num = {"int", "bigint", "double", "float", "smallint", "tinyint"}
    rows = []
    for c in numeric:
        t = types.get(c)
        rows.append((c, "numeric", t, t is not None and (t in num or t.startswith("decimal"))))
    for c in categorical:
        t = types.get(c)
        rows.append((c, "string", t, t == "string"))
    return spark.createDataFrame(rows, "column STRING, expected STRING, actual STRING, ok BOOLEAN")


def drift_check(baseline: DataFrame, current: DataFrame,
                threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Q13: standardised mean shift of each column against the baseline profile
    (both from ``moment_profile`` or ``baseline_profile``)."""
    b = baseline.select("column", F.col("mean").alias("base_mean"), F.col("std").alias("base_std"))
    c = current.select("column", F.col("mean").alias("current_mean"))
    shift = F.try_divide(F.abs(F.col("current_mean") - F.col("base_mean")), F.col("base_std"))
    return b.join(c, "column").withColumn("shift", shift) \
            .withColumn("drift", F.coalesce(F.col("shift") > threshold, F.lit(False)))


def audit_report(checks: Sequence[DataFrame]) -> DataFrame:
    """Q12: union of (check, status, detail) rows."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def psi(base: DataFrame, current: DataFrame, cols: Sequence[str], eps: float = 1e-4) -> DataFrame:
    """Q13 option: population stability index per column over the baseline's
    quartile bins: sum((cur - base) * ln(cur / base)) of bin shares, shares
    floored at ``eps``.  NULL values are a bin of their own.  Cut points are exact baseline quartiles; the cut table
    has one row per column (fixed size), so it is broadcast."""
    from hearth.operators.profile import melt
    from hearth.operators.ranks import quantiles
    cuts = quantiles(melt(base, cols), ["column"], "value", [0.25, 0.5, 0.75], ["c1", "c2", "c3"]).drop("n")

    def shares(df: DataFrame, side: str) -> DataFrame:
        b = melt(df, cols).join(F.broadcast(cuts), "column").select(
            "column", F.coalesce(F.lit(1) + (F.col("value") > F.col("c1")).cast("int") + (F.col("value") > F.col("c2")).cast("int")
                                 + (F.col("value") > F.col("c3")).cast("int"), F.lit(0)).alias("bin"))
        c = b.groupBy("column", "bin").agg(F.count("*").alias("_n"))
        # over the <= 4 bin rows of each column, not over data rows
        return c.select("column", "bin", (F.col("_n") / F.sum("_n").over(Window.partitionBy("column"))).alias(side))

    j = shares(base, "base_share").join(shares(current, "current_share"), ["column", "bin"], "full")
    bs = F.greatest(F.coalesce("base_share", F.lit(0.0)), F.lit(eps))
    cs = F.greatest(F.coalesce("current_share", F.lit(0.0)), F.lit(eps))
    return j.groupBy("column").agg(F.sum((cs - bs) * F.log(cs / bs)).alias("psi"))
