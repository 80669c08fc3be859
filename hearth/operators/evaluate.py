"""Evaluation of predictions, in one aggregate pass.

Predictions of several models sit side by side as columns; one wide aggregate
has every model's metrics per group, laid out as a row per model afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from hearth.constants import ACCEPTED_RANGES, CORR_MIN, PERFORMANCE_TARGETS, R2_MIN
from hearth.functions.features import safe_corr


METRICS = ["n", "mae", "rmse", "r2", "mape", "corr", "missing"]


def metric_aggs(target: str = "Rent", prediction: str = "prediction") -> list:
    """All figures over the rows where target and prediction are known; ``missing`` counts the others."""
    y, p = F.col(target).cast("double"), F.col(prediction).cast("double")
    known, e = p.isNotNull() & y.isNotNull(), p - y
    y, p = F.when(known, y), F.when(known, p)
    sst = F.var_pop(y) * F.count(y)
    return [
        F.count(y).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.when(F.max(y) > F.min(y), sst))).alias("r2"),
        (F.avg(F.abs(F.try_divide(e, y))) * 100).alias("mape"),
        safe_corr(p, y).alias("corr"),
        F.count_if(~known).alias("missing"),
    ]


def metrics(df: DataFrame, preds: Sequence[str], target: str = "Rent",
            by: Sequence[str] = ("split",)) -> DataFrame:
    """Q1/Q2/Q4: n, MAE, RMSE, R2, MAPE and prediction-actual correlation per
    model and group."""
    return _stacked_metrics(df.groupBy(*by), preds, target, by)


def _stacked_metrics(grouped: GroupedData, preds: Sequence[str], target: str, keys: Sequence[str]) -> DataFrame:
    """One wide aggregate for all models, laid out as a row per model."""
    names = METRICS
    wide = grouped.agg(*[a.alias(f"{p}__{n}") for p in preds for n, a in zip(names, metric_aggs(target, p))])
    return wide.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(p).alias("model"), *[F.col(f"{p}__{n}").alias(n) for n in names]) for p in preds])))


def segment_metrics(df: DataFrame, preds: Sequence[str], segments: Sequence[str],
                    target: str = "Rent", split: str = "split") -> DataFrame:
    """Q3: metrics per segment value for each segment column (long form), from one
    grouping-sets aggregate."""
    names = METRICS
    wide = df.groupingSets([[split, s] for s in segments], split, *segments).agg(
        F.grouping_id().alias("_gid"), *[a.alias(f"{p}__{n}") for p in preds for n, a in zip(names, metric_aggs(target, p))])
    kind, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, s in enumerate(segments):
        # grouping_id has a bit for each key that is aggregated away; the last key is the lowest
        mine = (1 << len(segments)) - 1 - (1 << (len(segments) - 1 - i))
        kind = F.when(F.col("_gid") == mine, s).otherwise(kind)
        value = F.when(F.col("_gid") == mine, F.col(s).cast("string")).otherwise(value)
    return wide.select(split, kind.alias("segment_kind"), value.alias("segment"), F.inline(F.array(*[
        F.struct(F.lit(p).alias("model"), *[F.col(f"{p}__{n}").alias(n) for n in names]) for p in preds])))


def best_model(m: DataFrame, metric: str = "mae", order: str = "ordinal") -> DataFrame:
    """Argmin of the metric, first model in list order on ties."""
    return m.orderBy(F.col(metric).asc_nulls_last(), F.col(order)).limit(1)


def top_segments(seg: DataFrame, n: int = 10, metric: str = "mae") -> DataFrame:
    """The n segments with the lowest metric (distributed top-n)."""
    return seg.orderBy(F.col(metric).asc_nulls_last(), "segment_kind", "segment").limit(n)


def acceptance(spark: SparkSession, values: DataFrame,
               targets: Sequence[tuple[str, float, str]] = PERFORMANCE_TARGETS,
               ranges: Sequence[tuple[str, float, float]] = ACCEPTED_RANGES) -> DataFrame:
    """Q5: (metric, value) against its target (``passed``) and against the range
    accepted of a re-training (``in_range``)."""
    t = spark.createDataFrame(list(targets), "metric STRING, bound DOUBLE, direction STRING")
    ok = F.when(F.col("direction") == "max", F.col("value") <= F.col("bound")) \
          .otherwise(F.col("value") >= F.col("bound"))
    span = spark.createDataFrame(list(ranges), "metric STRING, range_min DOUBLE, range_max DOUBLE")
    return (values.join(F.broadcast(t), "metric").join(F.broadcast(span), "metric", "left").withColumn("passed", ok)
            .withColumn("in_range", F.col("value").between(F.col("range_min"), F.col("range_max"))))


def meets_floors(m: DataFrame, r2_min: float = R2_MIN, corr_min: float = CORR_MIN) -> DataFrame:
    """Whether each row's R2 and correlation reach their floors; unknown ones don't."""
    return m.withColumns({"r2_ok": F.coalesce(F.col("r2") >= r2_min, F.lit(False)),
                          "corr_ok": F.coalesce(F.col("corr") >= corr_min, F.lit(False))})


def error_band_summary(df: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """F16 aggregated: rows, mean error % per band (input from error_columns)."""
    return df.groupBy(*by, "band").agg(F.count("*").alias("rows"),
                                       F.avg("error_pct").alias("mean_error_pct"))


def rank_models(m: DataFrame, order: Sequence[str]) -> DataFrame:
    """Attach each model's list position (for first-wins tie breaking)."""
    pos = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("model"))
    return m.withColumn("ordinal", pos.cast("int"))


def improvement_row(m: DataFrame, base_models: Sequence[str], ensemble: str,
                    split: str = "test") -> DataFrame:
    """best base model (first on ties) vs the ensemble on one split."""
    mm = rank_models(m.where(F.col("split") == split), base_models + [ensemble])
    base = best_model(mm.where(F.col("model") != ensemble)).select(
        F.col("model").alias("best_base_model"), F.col("mae").alias("best_base_mae"))
    ens = mm.where(F.col("model") == ensemble).select(F.col("mae").alias("ensemble_mae"))
    j = base.withColumn("_k", F.lit(1)).join(ens.withColumn("_k", F.lit(1)), "_k").drop("_k")
    imp = F.col("best_base_mae") - F.col("ensemble_mae")
    return j.withColumns({
        "improvement": imp,
        "improvement_pct": F.try_divide(imp * 100.0, F.col("best_base_mae")),
        "verdict": F.when(imp > 0, "IMPROVED").when(imp < 0, "WORSE").otherwise("EQUAL"),
    })

