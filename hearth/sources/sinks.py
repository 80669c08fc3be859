"""Manifests, table writes, run metadata, model bundles, prediction log.

Everything is written with the DataFrame writer (parquet/JSON, overwrite or
append) into folders the caller names; on a cluster those are shared storage.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.constants import FORBIDDEN_COLUMNS


# S2 --------------------------------------------------------------------------
def read_manifest(spark: SparkSession, path: str) -> list[str]:
    """Feature manifest in any of its three shapes: a JSON list, an object with
    ``all_features``, or an object with ``feature_cols`` (default: empty)."""
    text = spark.read.text(path, wholetext=True)
    as_list = F.from_json("value", "array<string>")
    as_all = F.from_json("value", "struct<all_features: array<string>>").getField("all_features")
    as_cols = F.from_json("value", "struct<feature_cols: array<string>>").getField("feature_cols")
    first_char = F.substring(F.ltrim("value"), 1, 1)
    cols = F.when(first_char == "[", as_list).otherwise(
        F.coalesce(as_all, as_cols, F.array().cast("array<string>")))
    row = text.select(cols.alias("features")).first()      # one small config document
    return list(row["features"] or []) if row else []


# S3 --------------------------------------------------------------------------
def write_splits(df: DataFrame, path: str, split: str = "split", mode: str = "overwrite") -> None:
    """One table partitioned by split, so reading one split prunes the others."""
    df.write.mode(mode).partitionBy(split).parquet(path)


def read_split(spark: SparkSession, path: str, name: str, split: str = "split") -> DataFrame:
    return spark.read.parquet(path).where(F.col(split) == name)


# S4 --------------------------------------------------------------------------
def run_metadata(counts: DataFrame, features: Sequence[str], removed: Sequence[str],
                 metrics: dict | None = None, split: str = "split",
                 improvement: dict | None = None, overlap: DataFrame | None = None,
                 forbidden: Sequence[str] = FORBIDDEN_COLUMNS) -> DataFrame:
    """One row: stamp, feature list, removed list, row counts per split, flags,
    metrics and the improvement over the best base model, built by one
    aggregate over the per-split counts.  ``no_leakage`` holds if no feature is a
    target-derived column and all rows of ``overlap`` (``sets.split_overlap``) are ok;
    without that table it is null."""
    clean = not set(features) & set(forbidden)
    flag = F.lit(None).cast("boolean") if overlap is None else F.lit(clean and overlap.where("not ok").limit(1).count() == 0)
    agg = counts.agg(*[F.sum(F.when(F.col(split) == s, F.col("rows")).otherwise(0)).alias(f"{s}_rows")
                       for s in ("train", "val", "test")])
    now = F.current_timestamp()
    out = agg.select(
        F.date_format(now, "yyyyMMdd_HHmmss").alias("timestamp"),
        F.lit(len(features)).alias("total_features"),
        F.array(*[F.lit(f) for f in features]).alias("features"),
        F.array(*[F.lit(f) for f in removed]).cast("array<string>").alias("removed_features"),
        "train_rows", "val_rows", "test_rows",
        flag.alias("no_leakage"),
        F.create_map(*[x for k, v in (metrics or {}).items() for x in (F.lit(k), F.lit(float(v)))])
         .cast("map<string,double>").alias("metrics"),
        F.struct(*[F.lit(v).alias(k) for k, v in (improvement or {"best_base_model": None}).items()])
         .alias("improvement_over_best_base"))
    return out


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


# S5 --------------------------------------------------------------------------
STATS_TABLES = ("loc", "loc_type", "furn", "typ")


def save_stacked(model, path: str) -> None:
    """Encoder and base models as Spark ML directories, statistics and feature
    importances as parquet, ridge + scalars as one JSON document."""
    model.encoder.model.write().overwrite().save(os.path.join(path, "encoder"))
    for name, m in model.base.items():
        m.write().overwrite().save(os.path.join(path, "base", name))
    s = model.stats
    _save_stats(s, path)
    meta = {"ridge": {"alpha": model.ridge.alpha, "intercept": model.ridge.intercept,
                      "coef": model.ridge.coef, "xs": model.ridge.xs},
            "global_mean": s.global_mean, "cols": s.cols, "numeric": model.encoder.numeric,
            "base": {n: type(m).__name__ for n, m in model.base.items()}}
    spark = s.loc.sparkSession
    from hearth.plans.stacking import feature_importances
    feature_importances(model, spark).write.mode("overwrite").parquet(os.path.join(path, "importances"))
    spark.createDataFrame([(json.dumps(meta),)], "meta STRING").coalesce(1) \
         .write.mode("overwrite").text(os.path.join(path, "meta"))


def save_boosted(model, path: str) -> None:
    """A ``BoostedStack``: statistics and importances as parquet, learners, ridge and scalars as
    one JSON document."""
    s, spark = model.stats, model.stats.loc.sparkSession
    _save_stats(s, path)
    model.boosted.importances(spark).write.mode("overwrite").parquet(os.path.join(path, "importances"))
    r = model.ridge
    meta = {"ridge": {"alpha": r.alpha, "intercept": r.intercept, "coef": r.coef, "xs": r.xs}, "global_mean": s.global_mean, "cols": s.cols,
            "boosted": json.loads(model.boosted.to_json())}
    spark.createDataFrame([(json.dumps(meta),)], "meta STRING").coalesce(1).write.mode("overwrite").text(os.path.join(path, "meta"))


def load_boosted(spark: SparkSession, path: str):
    from hearth.plans.boosting import Boosted
    from hearth.plans.stacking import BoostedStack, Ridge
    meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()["value"])
    r = meta["ridge"]
    return BoostedStack(_load_stats(spark, path, meta), Boosted.from_json(json.dumps(meta["boosted"])),
                        Ridge(r["alpha"], r["intercept"], r["coef"], r["xs"]))


def _save_stats(stats, path: str) -> None:
    for name in STATS_TABLES:
        getattr(stats, name).write.mode("overwrite").parquet(os.path.join(path, "stats", name))
    stats.areas.write(os.path.join(path, "stats", "areas"))


def _load_stats(spark: SparkSession, path: str, meta: dict):
    from hearth.operators.ranks import RankIndex, hinted
    from hearth.operators.stats import ListingStats
    tables = [hinted(spark.read.parquet(os.path.join(path, "stats", n))) for n in STATS_TABLES]
    return ListingStats(*tables, RankIndex.read(spark, os.path.join(path, "stats", "areas")), meta["global_mean"], meta["cols"])


def save_stacked_versions(model, root: str, stamp: str) -> tuple[str, str]:
    """The bundle under ``root/<stamp>`` and again under ``root/latest``; ``root/stamp`` then names the
    stamp, for readers that take the bundle from its own folder."""
    save = save_boosted if hasattr(model, "boosted") else save_stacked
    stamped, latest = os.path.join(root, stamp), os.path.join(root, "latest")
    save(model, stamped)
    save(model, latest)
    spark = model.stats.loc.sparkSession
    spark.createDataFrame([(stamp,)], "stamp STRING").coalesce(1).write.mode("append").text(os.path.join(root, "stamp"))
    return stamped, latest


def latest_stamp(spark: SparkSession, root: str) -> str:
    """The stamp of the newest bundle (stamps sort by time; a line is added for each bundle)."""
    return spark.read.text(os.path.join(root, "stamp")).agg(F.max("value")).first()[0]


def load_stacked(spark: SparkSession, path: str):
    from hearth.plans.stacking import Encoder, Ridge, StackedModel
    meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()["value"])
    kinds = {"GBTRegressionModel": GBTRegressionModel, "RandomForestRegressionModel": RandomForestRegressionModel}
    base = {n: kinds[k].load(os.path.join(path, "base", n)) for n, k in meta["base"].items()}
    stats = _load_stats(spark, path, meta)
    r = meta["ridge"]
    return StackedModel(stats, Encoder(PipelineModel.load(os.path.join(path, "encoder")), meta["numeric"]),
                        base, Ridge(r["alpha"], r["intercept"], r["coef"], r["xs"]))


# S6 --------------------------------------------------------------------------
def write_column_order(names: DataFrame, path: str) -> None:
    names.coalesce(1).write.mode("overwrite").json(path)


# S7 --------------------------------------------------------------------------
def prediction_log(scored: DataFrame, features: Sequence[str], prediction: str = "prediction") -> DataFrame:
    """Scored requests as log rows: timestamp, prediction and the inputs."""
    return scored.select(F.current_timestamp().alias("timestamp"),
                         F.col(prediction).alias("prediction"), *features)


RUN, BATCH = "log_run", "log_batch"


def append_log(log: DataFrame, path: str, run: str, batch: int = 0) -> None:
    """Adds a batch of rows under the name of its run and its number.  A batch that is written again, by a
    repeated job or a stream that starts over, replaces itself: its folder changes hands once the new
    files are whole, and other batches stay as they are."""
    (log.withColumns({RUN: F.lit(run), BATCH: F.lit(batch)}).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(RUN, BATCH).parquet(path))


def read_log(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """The rows of all runs, or of one (the folders of the others aren't read)."""
    log = spark.read.parquet(path)
    return (log if run is None else log.where(F.col(RUN).cast("string") == run)).drop(RUN, BATCH)


def log_stream(scored: DataFrame, path: str, run: str, checkpoint: str, **trigger) -> None:
    """Takes in a stream of log rows to its end (``availableNow``, unless ``trigger`` says otherwise): each
    micro-batch is one batch of the log, so one that is run again after a failure isn't added twice."""
    query = (scored.writeStream.foreachBatch(lambda batch, number: append_log(batch, path, run, number))
             .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
    query.awaitTermination()
