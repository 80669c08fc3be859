"""Ridge from sums vs closed form, models on generated data with a known signal,
streaming vs batch, sinks, and the driver contract."""

import json
import math
import os
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from hearth.functions.hashing import unit_hash
from hearth.plans import stacking


def _ridge_closed_form(X, y, alpha):
    xm, ym = X.mean(0), y.mean()
    Xc, yc = X - xm, y - ym
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(X.shape[1]), Xc.T @ yc)
    return ym - xm @ w, w


def test_ridge_from_sums_matches_closed_form(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(50000, 8000, (400, 3))
    y = X @ np.array([0.5, 0.3, 0.2]) + rng.normal(0, 1000, 400)
    pdf = pd.DataFrame(X, columns=["p1", "p2", "p3"]).assign(Rent=y, cv_fold=np.arange(400) % 5)
    r = stacking.fit_ridge(spark.createDataFrame(pdf), ["p1", "p2", "p3"], alphas=[100.0])
    b, w = _ridge_closed_form(X, y, 100.0)
    assert np.allclose(r.coef, w, rtol=1e-6) and math.isclose(r.intercept, b, rel_tol=1e-6)
    # CV: every alpha gets a score; the chosen one is the argmin, first on ties
    r2 = stacking.fit_ridge(spark.createDataFrame(pdf), ["p1", "p2", "p3"])
    assert set(r2.cv_mae) == {0.1, 1.0, 10.0, 100.0}
    assert r2.cv_mae[r2.alpha] == min(r2.cv_mae.values())


def _generated_listings(spark, n=3000):
    """Listings with a known signal: rent = f(area, beds, location) + hash noise."""
    df = spark.range(n).select(
        F.col("id").alias("k"),
        F.element_at(F.array(*[F.lit(x) for x in "ABCDE"]), (F.col("id") % 5 + 1).cast("int")).alias("Location"),
        F.when(F.col("id") % 3 == 0, "VH").otherwise("AP").alias("Type"),
        F.when(F.col("id") % 2 == 0, "Furnished").otherwise("Unfurnished").alias("Furnishing"),
        (F.col("id") % 5).cast("int").alias("Beds"),
        (F.col("id") % 4 + 1).cast("int").alias("Baths"),
        (400 + (F.col("id") * 37) % 3000).cast("double").alias("Area_in_sqft"))
    loc_premium = F.element_at(F.array(*[F.lit(x) for x in [1.0, 1.3, 0.8, 1.1, 1.6]]), (F.col("k") % 5 + 1).cast("int"))
    noise = (unit_hash(["k"], 1) - 0.5) * 4000
    return df.withColumn("Rent", (20000 + 40 * F.col("Area_in_sqft") + 5000 * F.col("Beds")) * loc_premium + noise)


def test_stacked_model_learns_known_signal(spark):
    df = _generated_listings(spark).withColumn(
        "split", F.when(unit_hash(["k"], 42) < 0.7, "train").otherwise("test"))
    model, meta = stacking.train_stacked(df, ["k"], trees=10, max_depth=4, folds=3)
    assert meta.count() == df.where("split = 'train'").count()       # every train row has OOF preds
    scored = model.score(df.where("split = 'test'"))
    y = np.array([r.Rent for r in scored.select("Rent").collect()])
    p = np.array([r.prediction for r in scored.select("prediction").collect()])
    r2 = 1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2)
    assert r2 >= 0.70 and np.corrcoef(y, p)[0, 1] >= 0.85
    # deterministic predictions
    p2 = np.array([r.prediction for r in model.score(df.where("split = 'test'")).select("prediction").collect()])
    assert np.array_equal(np.sort(p), np.sort(p2))
    # bundle round trip
    root = tempfile.mkdtemp(prefix="hearth-model-")
    from hearth.sources.sinks import load_stacked, save_stacked_versions
    stamped, latest = save_stacked_versions(model, root, "20250101_000000")
    assert os.path.isdir(stamped) and os.path.isdir(latest)
    importances = spark.read.parquet(os.path.join(latest, "importances")).groupBy("model").agg(F.sum("importance").alias("s")).collect()
    assert {r.model for r in importances} == {"gbt_deep", "gbt_shallow", "forest"} and all(abs(r.s - 1) < 1e-6 for r in importances)
    loaded = load_stacked(spark, latest)
    p3 = np.array([r.prediction for r in loaded.score(df.where("split = 'test'")).select("prediction").collect()])
    assert np.allclose(np.sort(p), np.sort(p3))


def test_stream_equals_batch_and_resumes(spark, sf_dir):
    """Files out of time order, one at a time, in two runs: the summary is the batch one."""
    from hearth.sources.tables import read_table
    from hearth.streaming import hourly
    events = read_table(spark, sf_dir, "events")
    root = tempfile.mkdtemp(prefix="hearth-stream-")
    ordered = events.withColumn("part", F.ntile(6).over(Window.partitionBy(F.lit(1)).orderBy("ts")))
    write = lambda n: ordered.where(F.col("part") == n).drop("part").coalesce(1).write.mode("append").parquet(f"{root}/in")
    summary = lambda df: {(r.window_start, r.event_type): (r.requests, round(r.mean_prediction, 6), r.min_prediction, r.max_prediction)
                          for r in df.collect()}
    run = lambda: hourly.hourly_stream(spark, f"{root}/in", events.schema, f"{root}/state", max_files_per_trigger=1)
    for n in (5, 2, 6):
        write(n)
    assert summary(run()) == summary(hourly.hourly_summary(ordered.where("part in (2, 5, 6)").drop("part")))
    for n in (1, 4, 3):
        write(n)
    assert summary(run()) == summary(run()) == summary(hourly.hourly_summary(events))


def test_learners_take_the_tuned_values():
    from hearth.constants import TUNED_PARAMS
    from hearth.plans.stacking import base_learners
    got = base_learners()
    for name, key, trees, depth, leaf, columns in (
            ("gbt_deep", "XGBoost", "n_estimators", "max_depth", "min_child_weight", "colsample_bytree"),
            ("gbt_shallow", "LightGBM", "n_estimators", "max_depth", "min_child_weight", "colsample_bytree"),
            ("forest", "CatBoost", "iterations", "depth", "min_data_in_leaf", "colsample_bylevel")):
        est, want = got[name], TUNED_PARAMS[key]
        value = lambda p: est.getOrDefault(p)
        assert value("numTrees" if name == "forest" else "maxIter") == want[trees] == 500
        assert value("maxDepth") == want[depth] and value("minInstancesPerNode") == want[leaf]
        assert value("subsamplingRate") == want["subsample"] and value("featureSubsetStrategy") == str(want[columns])
        if name != "forest":
            assert value("stepSize") == want["learning_rate"] == 0.05
    assert got["gbt_deep"].getMinInfoGain() == TUNED_PARAMS["XGBoost"]["gamma"]
    assert base_learners(3, 2)["forest"].getNumTrees() == 3
    assert base_learners(validation="held")["gbt_deep"].getValidationIndicatorCol() == "held"


def test_ridge_skips_incomplete_rows(spark):
    from hearth.plans.stacking import fit_ridge, moment_sums
    rows = [(float(i), float(i * i % 7), 2.0 * i + 1 + (i * i % 7), i % 5) for i in range(40)]
    df = spark.createDataFrame(rows + [(None, 1.0, 5.0, 0), (3.0, None, 7.0, 1), (3.0, 3.0, None, 2)], "a DOUBLE, b DOUBLE, Rent DOUBLE, cv_fold INT")
    whole = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, Rent DOUBLE, cv_fold INT")
    assert moment_sums(df, ["a", "b"], by=None).first().n == 40
    got, want = fit_ridge(df, ["a", "b"]), fit_ridge(whole, ["a", "b"])
    assert got.alpha == want.alpha and np.allclose(got.coef, want.coef) and np.isclose(got.intercept, want.intercept)


def test_run_metadata_computes_leakage(spark):
    from hearth.sources.sinks import run_metadata
    counts = spark.createDataFrame([("train", 3), ("val", 1)], "split STRING, rows BIGINT")
    overlap = spark.createDataFrame([(True,), (True,)], "ok BOOLEAN")
    assert run_metadata(counts, ["Beds"], [], overlap=overlap).first().no_leakage is True
    assert run_metadata(counts, ["Rent_category"], [], overlap=overlap).first().no_leakage is False
    assert run_metadata(counts, ["Beds"], [], overlap=overlap.union(spark.createDataFrame([(False,)], "ok BOOLEAN"))).first().no_leakage is False
    assert run_metadata(counts, ["Beds"], []).first().no_leakage is None


def test_manifest_shapes(spark):
    d = tempfile.mkdtemp(prefix="hearth-manifest-")
    from hearth.sources.sinks import read_manifest
    cases = {"list.json": ["a", "b"], "all.json": {"all_features": ["c"], "x": 1},
             "cols.json": {"feature_cols": ["d"]}, "none.json": {"other": 1}}
    for name, body in cases.items():
        with open(os.path.join(d, name), "w") as f:
            json.dump(body, f, indent=2)
    got = {n: read_manifest(spark, os.path.join(d, n)) for n in cases}
    assert got == {"list.json": ["a", "b"], "all.json": ["c"], "cols.json": ["d"], "none.json": []}


def test_write_splits_partition_pruning(spark, listing_rows):
    from hearth.sources.sinks import read_split, write_splits
    path = os.path.join(tempfile.mkdtemp(prefix="hearth-splits-"), "t")
    write_splits(listing_rows, path)
    test = read_split(spark, path, "test")
    assert test.count() == 2
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString()


def test_entry_contract(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0 and "property_rank_in_location" in df.columns
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)


def test_log_holds_each_batch_once(spark, sf_dir, tmp_path):
    """Repeated batches replace themselves, other runs and batches stay; a stream that starts over adds nothing."""
    from hearth.sources.sinks import append_log, log_stream, prediction_log, read_log
    from hearth.sources.tables import read_table
    rows = lambda lo, hi: prediction_log(spark.range(lo, hi).select((F.col("id") * 1.5).alias("prediction"), F.col("id").alias("Beds")), ["Beds"])
    path = str(tmp_path / "log")
    for run, batch, lo, hi in (("a", 0, 0, 10), ("a", 1, 10, 25), ("b", 0, 100, 104), ("a", 1, 10, 25), ("a", 0, 0, 10), ("b", 0, 100, 104)):
        append_log(rows(lo, hi), path, run, batch)
    assert sorted(r.Beds for r in read_log(spark, path).collect()) == [*range(25), *range(100, 104)]
    assert sorted(r.Beds for r in read_log(spark, path, "b").collect()) == [*range(100, 104)]
    assert read_log(spark, path).columns == ["timestamp", "prediction", "Beds"]
    append_log(rows(50, 53), path, "a", 1)                              # the batch's new content
    assert sorted(r.Beds for r in read_log(spark, path, "a").collect()) == [*range(10), *range(50, 53)]
    # one stream, run again from the start after its checkpoint is lost, and once more without new files
    events = read_table(spark, sf_dir, "events").repartition(3)
    events.write.parquet(str(tmp_path / "in"))
    stream = lambda: (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
                      .select(F.current_timestamp().alias("timestamp"), F.col("value").alias("prediction"), "event_id" if "event_id" in events.columns else "event_type"))
    for checkpoint in ("one", "two", "two"):
        log_stream(stream(), str(tmp_path / "streamed"), "s", str(tmp_path / checkpoint))
    got, want = (sorted(r[0] for r in df.collect()) for df in (read_log(spark, str(tmp_path / "streamed"), "s").select("prediction"), events.select("value")))
    assert got == want
