"""E1 one-hot (fit on train, sorted categories, first dropped, unknown -> zeros)
and E2 smoothed target encoding (plain, out-of-fold and ordered).

The vocabulary is a small fitted table (distinct values per column); the
encoded form is either sparse long rows ``(row..., encoded_column)`` (SQL
checkable, one row per non-zero) or a Spark ML vector for model training.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.constants import CATEGORICAL_FEATURES, RANDOM_STATE, TARGET_SMOOTHING
from hearth.functions.hashing import bucket60
from hearth.operators.joins import bounded, cut_lineage, join_small
from hearth.operators.ranks import value_ranks


# E1 --------------------------------------------------------------------------
def melt_categories(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value) for every categorical column in ONE scan."""
    return df.select(*keep, *[F.col(c).cast("string").alias(c) for c in cols]) \
             .unpivot(list(keep), list(cols), "column", "value")


def fit_vocabulary(train: DataFrame, cols: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """(column, value, position): sorted distinct non-null values per column,
    position 0 is the dropped first category.  Size = total distinct values."""
    vals = melt_categories(train, cols).where(F.col("value").isNotNull()).distinct()
    # Ranks over ranges of values, so that a wide column's vocabulary is no single task.
    return bounded(value_ranks(vals, ["column"], "value").select("column", "value", F.col("below").cast("int").alias("position")))


def encoded_names(vocab: DataFrame) -> DataFrame:
    """Encoded column order = numeric features, then ``<col>_<value>`` for
    every non-first category, in vocabulary order."""
    return vocab.where("position > 0").select(
        "column", "value", "position", F.concat_ws("_", "column", "value").alias("encoded_column"))


def one_hot_long(df: DataFrame, vocab: DataFrame, keys: Sequence[str],
                 cols: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Sparse one-hot: one row ``(keys..., encoded_column)`` per value 1."""
    melted = melt_categories(df, cols, keys)
    names = encoded_names(vocab)
    return melted.join(names, ["column", "value"]).select(*keys, "encoded_column")


def one_hot_pipeline(cols: Sequence[str] = CATEGORICAL_FEATURES) -> Pipeline:
    """ML form: StringIndexer(alphabetDesc, keep) + OneHotEncoder(dropLast)
    keeps the alphabetically first category in the last slot and sends unknown
    values to the 'keep' slot, which is beyond the vector; slicing the last
    slot off gives drop='first' + handle_unknown='ignore'."""
    return Pipeline(stages=[
        StringIndexer(inputCols=list(cols), outputCols=[f"{c}_idx" for c in cols],
                      stringOrderType="alphabetDesc", handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_ohe_full" for c in cols],
                      dropLast=True, handleInvalid="keep"),
    ])


def one_hot_vectors(model: PipelineModel, df: DataFrame,
                    cols: Sequence[str] = CATEGORICAL_FEATURES) -> tuple[DataFrame, list[str]]:
    """Apply a fitted ``one_hot_pipeline`` and slice off the first-category slot.
    Returns the frame and the names of the vector columns to assemble (a column
    with a single category carries no information and yields none)."""
    out = model.transform(df)
    indexer = model.stages[0]
    vec_cols = []
    for c, labels in zip(cols, indexer.labelsArray):
        width = len(labels)              # known categories; the unknown slot is dropped
        if width > 1:
            out = VectorSlicer(inputCol=f"{c}_ohe_full", outputCol=f"{c}_ohe",
                               indices=list(range(width - 1))).transform(out)
            vec_cols.append(f"{c}_ohe")
    return out.drop(*[f"{c}_idx" for c in cols], *[f"{c}_ohe_full" for c in cols]), vec_cols


def assemble(df: DataFrame, numeric: Sequence[str], vec_cols: Sequence[str],
             out: str = "features") -> DataFrame:
    """Numeric columns + one-hot vectors in model order -> one vector column."""
    return VectorAssembler(inputCols=[*numeric, *vec_cols], outputCol=out,
                           handleInvalid="keep").transform(df)


# E2 --------------------------------------------------------------------------
#: Rows of a range of ``target_encode_ordered``, about: what a task sorts and keeps for its windows.
RANGE_ROWS = 1 << 17


def fit_target_encoding(train: DataFrame, cols: Sequence[str] = CATEGORICAL_FEATURES,
                        target: str = "Rent", smoothing: float = TARGET_SMOOTHING) -> tuple[DataFrame, float]:
    """(column, value, encoding) with m-estimate (n*mean + m*prior)/(n + m).  Without
    any target the prior and all encodings are NULL."""
    prior = train.agg(F.avg(target)).first()[0]
    stats = melt_categories(train, cols, [target]).groupBy("column", "value").agg(
        F.count(target).alias("n"), F.avg(target).alias("mean"))
    enc = (F.col("n") * F.col("mean") + F.lit(None if prior is None else smoothing * prior).cast("double")) / (F.col("n") + F.lit(smoothing))
    return bounded(stats.where("value IS NOT NULL").select("column", "value", enc.alias("encoding"))), prior


def apply_target_encoding(df: DataFrame, table: DataFrame, prior: float,
                          cols: Sequence[str] = CATEGORICAL_FEATURES, suffix: str = "_te") -> DataFrame:
    """Unseen or missing category -> prior."""
    out = df
    for c in cols:
        t = table.where(F.col("column") == c).select(F.col("value").alias(f"_v_{c}"),
                                                     F.col("encoding").alias(f"{c}{suffix}"))
        out = out.join(t, F.col(c).cast("string") == F.col(f"_v_{c}"), "left").drop(f"_v_{c}")
        out = out.withColumn(f"{c}{suffix}", F.coalesce(F.col(f"{c}{suffix}"), F.lit(prior).cast("double")))
    return out


def target_encode_oof(df: DataFrame, fold: str = "fold", cols: Sequence[str] = CATEGORICAL_FEATURES,
                      target: str = "Rent", smoothing: float = TARGET_SMOOTHING,
                      suffix: str = "_te") -> DataFrame:
    """Out-of-fold encoding of training rows: each row's encoding uses only the
    other folds.  ONE aggregate over (column, value, fold) for all columns;
    out-of-fold sums are total minus own fold, so no k separate fits."""
    folds = df.groupBy(fold).agg(F.count(target).alias("_fn"), F.sum(target).alias("_fs"))
    tot = df.agg(F.count(target).alias("_tn"), F.sum(target).alias("_ts"))
    prior_t = bounded(_prior_by_fold(folds, tot, fold))
    out = join_small(df, prior_t, fold, "left")
    by = melt_categories(df, cols, [fold, target]).groupBy("column", "value", fold).agg(
        F.count(target).alias("_fold_n"), F.sum(target).alias("_fold_s"))
    # one row per (column, value, fold): at most k rows per window partition
    per_value = Window.partitionBy("column", "value")
    oof = bounded(by.select(
        "column", "value", fold,
        (F.sum("_fold_n").over(per_value) - F.col("_fold_n")).alias("_on"),
        (F.sum("_fold_s").over(per_value) - F.col("_fold_s")).alias("_os")))
    for c in cols:
        t = oof.where(F.col("column") == c).select(
            F.col("value").alias(f"_v_{c}"), F.col(fold).alias(f"_f_{c}"), "_on", "_os")
        out = out.join(t, (F.col(c).cast("string") == F.col(f"_v_{c}")) & (F.col(fold) == F.col(f"_f_{c}")), "left")
        enc = F.when(F.coalesce(F.col("_on"), F.lit(0)) > 0,
                     (F.col("_os") + F.lit(smoothing) * F.col("_oof_prior")) / (F.col("_on") + F.lit(smoothing))) \
               .otherwise(F.col("_oof_prior"))
        out = out.withColumn(f"{c}{suffix}", enc).drop(f"_v_{c}", f"_f_{c}", "_on", "_os")
    return out.drop("_oof_prior")


def target_encode_ordered(df: DataFrame, keys: Sequence[str], cols: Sequence[str] = CATEGORICAL_FEATURES, target: str = "Rent",
                          smoothing: float = TARGET_SMOOTHING, seed: int = RANDOM_STATE, start: float = 0.0,
                          slices: int | None = None, suffix: str = "_ots") -> DataFrame:
    """Ordered target statistics: each row's encoding uses only the rows before it in the order of a
    key hash (then the key), so no row sees its own target:

        (sum of the value's targets before + smoothing * mean of all targets before) / (their number + smoothing)

    with ``start`` as the mean before any target is known.  NULL is a value; NULL targets count for nothing.

    Rows are dealt to ranges of the hash, written with the range's number: ``slices`` of them, or as many as the
    counted rows ask for at ``RANGE_ROWS`` each, so that a task's sorts and windows stay the same size on larger tables.  A
    row's sums are those within its range (windows over (range, value), which a hot value can't outgrow) plus those of all
    earlier ranges, which come from one pre-aggregated table with a row for each (range, column, value)."""
    n, total = F.count(F.col(target)), F.sum(F.col(target).cast("double"))
    # Written before it is counted, sampled for the ranges and dealt out.
    ordered = cut_lineage(df.withColumn("_h", bucket60(keys, seed)))
    slices = slices or max(df.sparkSession.sparkContext.defaultParallelism, -(-ordered.count() // RANGE_ROWS))
    ordered = cut_lineage(ordered.repartitionByRange(slices, "_h", *keys).withColumn("_slice", F.spark_partition_id()))
    by_slice = melt_categories(ordered, cols, ["_slice", target]).groupBy("_slice", "column", "value").agg(n.alias("_n"), total.alias("_s"))
    whole = ordered.groupBy("_slice").agg(n.alias("_n"), total.alias("_s"))

    def before(table: DataFrame, *by: str) -> DataFrame:
        """What earlier ranges hold of a value: as many rows as ranges in each window."""
        earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        return table.select("_slice", *by, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_bn"),
                            F.coalesce(F.sum("_s").over(earlier), F.lit(0.0)).alias("_bs"))

    # a value that a range lacks needs no row for it
    fitted = cut_lineage(before(by_slice, "column", "value"))
    out = ordered.repartitionById(slices, F.col("_slice"))                   # a task a range
    order = [F.col("_h"), *[F.col(k) for k in keys]]

    def within(*by: str) -> tuple:
        w = Window.partitionBy("_slice", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.count(target).over(w), F.coalesce(F.sum(F.col(target).cast("double")).over(w), F.lit(0.0))

    for i, c in enumerate([None, *cols]):
        own_n, own_s = within(*([c] if c else []))
        out = out.withColumns({f"_n{i}": own_n, f"_s{i}": own_s})
    out = out.join(F.broadcast(before(whole.withColumn("_one", F.lit(1)), "_one").drop("_one")), "_slice")      # a row a range
    known = F.col("_n0") + F.col("_bn")
    out = out.withColumn("_prior", F.when(known > 0, (F.col("_s0") + F.col("_bs")) / known).otherwise(F.lit(float(start)))).drop("_bn", "_bs")
    for i, c in enumerate(cols, 1):
        t = fitted.where(F.col("column") == c).select(F.col("_slice").alias("_fs"), F.col("value").alias("_fv"), "_bn", "_bs")
        out = join_small(out, t, (F.col("_slice") == F.col("_fs")) & F.col(c).cast("string").eqNullSafe(F.col("_fv")))
        enc = (F.col(f"_s{i}") + F.col("_bs") + F.lit(float(smoothing)) * F.col("_prior")) / (F.col(f"_n{i}") + F.col("_bn") + F.lit(float(smoothing)))
        out = out.withColumn(f"{c}{suffix}", enc).drop("_fs", "_fv", "_bn", "_bs")
    return out.drop("_h", "_slice", "_prior", *[f"_{x}{i}" for x in "ns" for i in range(len(cols) + 1)])


def _prior_by_fold(folds: DataFrame, tot: DataFrame, fold: str) -> DataFrame:
    """Out-of-fold prior per fold: (total - fold) sum / count.  ``tot`` is a
    one-row aggregate attached by a broadcast equi-join on a constant."""
    t = tot.withColumn("_one", F.lit(1))
    j = folds.withColumn("_one", F.lit(1)).join(F.broadcast(t), "_one").drop("_one")
    return j.select(fold, F.try_divide(F.col("_ts") - F.col("_fs"),
                                       (F.col("_tn") - F.col("_fn")).cast("double")).alias("_oof_prior"))
