"""Base learners, out-of-fold stacking, ridge meta-learner, scoring.

* ``train_boosted`` has the tuned boosters in full (``plans/boosting.py``): the learners
  and the fits of all their folds grow in the same passes over one binned table.
* ``train_stacked`` has Spark ML tree ensembles (distributed training) at the settings
  that those have a counterpart for; tree count and depth are parameters for other sizes.
* The feature joins run once: the training table is written with keys, folds,
  label and vector only, and every fit reads that table.
* Out-of-fold meta-features: for each fold, the three learners are fitted on
  the other folds and chained over the held-out rows, each adding its own
  prediction column; the k held-out frames are unioned.  No row ids and no
  joins are needed to line predictions up.
* The ridge meta-learner is solved from sums of products: one aggregate per
  fold over the (small, 3-column) meta table, then a 4x4 solve per
  (alpha, fold) on the driver (a fixed-size system, not data).  Cross-
  validated MAE for every alpha is one column of ONE scoring aggregate with a
  broadcast coefficient table of k rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.constants import (CATEGORICAL_FEATURES, N_FOLDS, NUMERIC_FEATURES, RANDOM_STATE, RIDGE_ALPHAS,
                              TARGET, TUNED_PARAMS)
from hearth.operators import encode as enc
from hearth.operators.joins import cut_lineage, drop_table
from hearth.operators.split import fold_assign
from hearth.operators.stats import ListingStats, fit_listing_stats, listing_features
from hearth.plans import boosting


# M4 --------------------------------------------------------------------------
def base_learners(trees: int | None = None, max_depth: int | None = None, label: str = TARGET,
                  features: str = "features", tuned: dict = TUNED_PARAMS, validation: str | None = None) -> dict:
    """Three diverse tree ensembles at the tuned settings, where Spark ML has an
    equivalent (trees -> maxIter/numTrees, depth -> maxDepth, learning rate ->
    stepSize, subsample -> subsamplingRate, column sampling ->
    featureSubsetStrategy, min child weight / leaf size -> minInstancesPerNode,
    gamma -> minInfoGain).  ``trees`` and ``max_depth`` replace the tuned ones.  With
    ``validation``, the name of a boolean column, boosting stops early once the error on
    the rows where it is true no longer falls; those rows aren't trained on."""
    a, b, c = tuned["XGBoost"], tuned["LightGBM"], tuned["CatBoost"]
    common = dict(labelCol=label, featuresCol=features, seed=RANDOM_STATE)
    learners = {
        "gbt_deep": GBTRegressor(
            maxIter=trees or a["n_estimators"], maxDepth=max_depth or a["max_depth"],
            stepSize=a["learning_rate"], subsamplingRate=a["subsample"],
            featureSubsetStrategy=str(a["colsample_bytree"]), minInfoGain=a["gamma"],
            minInstancesPerNode=int(a["min_child_weight"]), predictionCol="pred_gbt_deep", **common),
        "gbt_shallow": GBTRegressor(
            maxIter=trees or b["n_estimators"], maxDepth=max_depth or b["max_depth"],
            stepSize=b["learning_rate"], subsamplingRate=b["subsample"],
            featureSubsetStrategy=str(b["colsample_bytree"]),
            minInstancesPerNode=int(b["min_child_weight"]), predictionCol="pred_gbt_shallow", **common),
        "forest": RandomForestRegressor(
            numTrees=trees or c["iterations"], maxDepth=max_depth or c["depth"],
            subsamplingRate=c["subsample"], featureSubsetStrategy=str(c["colsample_bylevel"]),
            minInstancesPerNode=int(c["min_data_in_leaf"]), predictionCol="pred_forest", **common),
    }
    if validation:
        for name in ("gbt_deep", "gbt_shallow"):
            learners[name].setParams(validationIndicatorCol=validation)
    return learners


def feature_importances(model: "StackedModel", spark: SparkSession) -> DataFrame:
    """``model, position, importance``: each base learner's importance of each slot of the
    feature vector (a row per model and slot, bounded by the encoder's width)."""
    rows = [(name, i, float(v)) for name, m in model.base.items() for i, v in enumerate(m.featureImportances.toArray())]
    return spark.createDataFrame(rows, "model STRING, position INT, importance DOUBLE")


# Feature matrix (E1 + J4) -----------------------------------------------------
@dataclass
class Encoder:
    model: PipelineModel
    numeric: list

    def transform(self, df: DataFrame) -> DataFrame:
        out, vec_cols = enc.one_hot_vectors(self.model, df)
        return enc.assemble(out, self.numeric, vec_cols)


def fit_encoder(train: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES) -> Encoder:
    return Encoder(enc.one_hot_pipeline().fit(train), list(numeric))


# M5 --------------------------------------------------------------------------
def fit_all(jobs: list, parallelism: int) -> list:
    """Fit independent (estimator, frame) pairs from a small driver thread pool;
    Spark runs their jobs concurrently on the cluster."""
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(lambda j: j[0].fit(j[1]), jobs))


def oof_meta_features(train: DataFrame, learners: dict, fold: str = "fold",
                      folds: int = N_FOLDS, parallelism: int = 4) -> DataFrame:
    """Out-of-fold predictions of every learner for every training row."""
    jobs = [(est, train.where(F.col(fold) != i)) for i in range(folds) for est in learners.values()]
    models = iter(fit_all(jobs, parallelism))
    parts = []
    for i in range(folds):
        held = train.where(F.col(fold) == i)
        for _ in learners:
            held = next(models).transform(held)
        parts.append(held.drop("features"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return cut_lineage(out)


# M6 / M7 ---------------------------------------------------------------------
def moment_sums(meta: DataFrame, xs: Sequence[str], y: str = TARGET, by: str | None = "fold",
                shift: dict | None = None) -> DataFrame:
    """Per group: n and sums of (shifted) x_j, y, x_j*x_k, x_j*y — one aggregate
    over the rows where all of them are known."""
    sh = shift or {}
    meta = meta.dropna(subset=[*xs, y])
    v = {c: F.col(c).cast("double") - F.lit(float(sh.get(c, 0.0))) for c in [*xs, y]}
    aggs = [F.count("*").alias("n")]
    aggs += [F.sum(v[c]).alias(f"s_{c}") for c in [*xs, y]]
    for i, a in enumerate(xs):
        for b in xs[i:]:
            aggs.append(F.sum(v[a] * v[b]).alias(f"s_{a}__{b}"))
        aggs.append(F.sum(v[a] * v[y]).alias(f"s_{a}__{y}"))
    return (meta.groupBy(by) if by else meta).agg(*aggs)


def _solve(row: dict, xs: Sequence[str], y: str, alpha: float) -> tuple[float, np.ndarray]:
    """Ridge with unpenalised intercept from (shifted) sums; returns (b, w) in
    shifted coordinates: yhat - sy = b + w . (x - sx)."""
    n = row["n"]
    k = len(xs)
    mx = np.array([row[f"s_{c}"] / n for c in xs])
    my = row[f"s_{y}"] / n
    sxx = np.empty((k, k))
    for i, a in enumerate(xs):
        for j, b in enumerate(xs):
            key = f"s_{a}__{b}" if i <= j else f"s_{b}__{a}"
            sxx[i, j] = row[key] - n * mx[i] * mx[j]
    sxy = np.array([row[f"s_{c}__{y}"] - n * mx[i] * my for i, c in enumerate(xs)])
    w = np.linalg.solve(sxx + alpha * np.eye(k), sxy)
    return float(my - mx @ w), w


@dataclass
class Ridge:
    alpha: float
    intercept: float
    coef: list
    xs: list
    cv_mae: dict = field(default_factory=dict)

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        e = F.lit(self.intercept)
        for c, w in zip(self.xs, self.coef):
            e = e + F.lit(float(w)) * F.col(c)
        return df.withColumn(out, e)


def fit_ridge(meta: DataFrame, xs: Sequence[str], y: str = TARGET, alphas: Sequence[float] = RIDGE_ALPHAS,
              cv_fold: str = "cv_fold") -> Ridge:
    """M7: alpha by k-fold CV MAE (mean of per-fold MAE; first alpha wins ties),
    then M6 on all rows.  ``meta`` must carry ``cv_fold``."""
    spark = meta.sparkSession
    xs = list(xs)
    meta = meta.dropna(subset=[*xs, y])
    centre = meta.agg(*[F.avg(c).alias(c) for c in [*xs, y]]).first().asDict()
    per_fold = {r[cv_fold]: r.asDict() for r in moment_sums(meta, xs, y, cv_fold, centre).collect()}
    total = {k: sum(r[k] for r in per_fold.values()) for k in next(iter(per_fold.values())) if k != cv_fold}
    coef_rows = []
    for f, fr in per_fold.items():
        rest, row = {k: total[k] - fr[k] for k in total}, [int(f)]
        for a in alphas:
            b, w = _solve(rest, xs, y, a)
            # back to raw coordinates: yhat = (sy + b - w.sx) + w.x
            row.append([centre[y] + b - float(np.dot(w, [centre[c] for c in xs])), *[float(v) for v in w]])
        coef_rows.append(row)
    schema = f"{cv_fold} INT, " + ", ".join(f"_a{j} ARRAY<DOUBLE>" for j in range(len(alphas)))
    scored = meta.join(F.broadcast(spark.createDataFrame(coef_rows, schema)), cv_fold)      # k rows

    def error(j: int):
        pred = F.col(f"_a{j}")[0]
        for i, c in enumerate(xs):
            pred = pred + F.col(f"_a{j}")[i + 1] * F.col(c)
        return F.avg(F.abs(pred - F.col(y)))

    cv = (scored.groupBy(cv_fold).agg(*[error(j).alias(f"m{j}") for j in range(len(alphas))])
          .agg(*[F.avg(f"m{j}").alias(f"m{j}") for j in range(len(alphas))]).first())
    cv_mae = {float(a): cv[f"m{j}"] for j, a in enumerate(alphas)}
    best = None
    for a in alphas:                                    # strict <: first wins ties
        if best is None or cv_mae[float(a)] < cv_mae[float(best)]:
            best = a
    b, w = _solve(total, xs, y, best)
    b_raw = centre[y] + b - float(np.dot(w, [centre[c] for c in xs]))
    return Ridge(float(best), b_raw, [float(v) for v in w], xs, cv_mae)


# M9 / M10 ----------------------------------------------------------------------
@dataclass
class StackedModel:
    stats: ListingStats
    encoder: Encoder
    base: dict            # name -> fitted model
    ridge: Ridge

    def score(self, requests: DataFrame) -> DataFrame:
        """Raw request rows (Location, Type, Furnishing, Beds, Baths, Area) ->
        features -> encoded vector -> base predictions -> ridge prediction."""
        x = self.encoder.transform(listing_features(requests, self.stats))
        for m in self.base.values():
            x = m.transform(x)
        return self.ridge.predict(x)


def train_stacked(df: DataFrame, keys: Sequence[str], split: str = "split", trees: int | None = None,
                  max_depth: int | None = None, folds: int = N_FOLDS, alphas: Sequence[float] = RIDGE_ALPHAS,
                  fold_seed: int = RANDOM_STATE + 1) -> tuple[StackedModel, DataFrame]:
    """Whole training run on the train split; returns the model and the OOF table."""
    train_raw = df.where(F.col(split) == "train")
    stats = fit_listing_stats(train_raw)
    train = listing_features(train_raw, stats)
    encoder = fit_encoder(train)
    train = fold_assign(encoder.transform(train), keys, folds, fold_seed)
    train = fold_assign(train, keys, folds, fold_seed + 1, name="cv_fold")
    train = cut_lineage(train.select(*keys, "fold", "cv_fold", TARGET, "features"))
    learners = base_learners(trees, max_depth)
    meta = oof_meta_features(train, learners, folds=folds)
    xs = [est.getPredictionCol() for est in learners.values()]
    ridge = fit_ridge(meta, xs, alphas=alphas)
    base = dict(zip(learners, fit_all([(est, train) for est in learners.values()], len(learners))))
    return StackedModel(stats, encoder, base, ridge), meta


@dataclass
class BoostedStack:
    """Statistics, boosted learners and the ridge over their predictions."""
    stats: ListingStats
    boosted: boosting.Boosted
    ridge: Ridge

    def score(self, requests: DataFrame) -> DataFrame:
        """Raw request rows -> features -> predictions of the learners -> ridge prediction."""
        return self.ridge.predict(self.boosted.predict(listing_features(requests, self.stats)))


def train_boosted(df: DataFrame, keys: Sequence[str], split: str = "split", learners: dict | None = None,
                  folds: int = N_FOLDS, alphas: Sequence[float] = RIDGE_ALPHAS, fold_seed: int = RANDOM_STATE + 1,
                  **bins) -> tuple[BoostedStack, DataFrame]:
    """Whole training run on the train split with the boosted learners (default: the tuned ones); returns
    the model and the OOF table (keys, ``fold, cv_fold``, the label, a prediction a learner)."""
    learners = learners or boosting.tuned_learners()
    train_raw = df.where(F.col(split) == "train")
    stats = fit_listing_stats(train_raw)
    train = cut_lineage(fold_assign(listing_features(train_raw, stats), keys, folds, fold_seed).select(
        *keys, "fold", TARGET, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES))
    packed = boosting.pack(train, boosting.fit_binner(train.where(F.col("fold") != boosting.VALIDATION), **bins), keys)
    drop_table(train)
    boosted, done, models = boosting.fit_packed(packed, learners, range(folds))
    names = {n: f"pred_{n}" for n in learners}
    meta = fold_assign(boosting.out_of_fold(done, models, names).withColumnRenamed("label", TARGET), keys, folds, fold_seed + 1, name="cv_fold")
    meta = cut_lineage(meta)
    for table in (packed.blocks, done.blocks):
        drop_table(table)
    return BoostedStack(stats, boosted, fit_ridge(meta, list(names.values()), alphas=alphas)), meta
