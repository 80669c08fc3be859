"""Profiles (A3-A17), sets (G1-G3), evaluation (Q1-Q5, W4, F17) and audits (Q6-Q13)."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hearth.operators import audit as au
from hearth.operators import evaluate as ev
from hearth.operators import profile as pf
from hearth.operators import sets


def test_baseline_profile_matches_pandas(listing_rows):
    pdf = listing_rows.toPandas()
    got = {r.column: r for r in pf.baseline_profile(listing_rows, ["Area_in_sqft", "Rent"]).collect()}
    for c in ["Area_in_sqft", "Rent"]:
        s = pdf[c]
        r = got[c]
        assert np.allclose([r.mean, r.std, r.min, r.max, r.q25, r.q50, r.q75],
                           [s.mean(), s.std(), s.min(), s.max(), s.quantile(.25), s.quantile(.5), s.quantile(.75)])


def test_null_counts_keep_only_positive(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a INT, b STRING")
    assert {r.column: r.nulls for r in pf.null_counts(df).collect()} == {"a": 1, "b": 2}
    df2 = spark.createDataFrame([(1,)], "a INT")
    assert pf.null_counts(df2).count() == 0


def test_non_finite(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (None,)], "x DOUBLE")
    r = pf.non_finite_counts(df, ["x"]).first()
    assert (r.nulls, r.nans, r.infs) == (1, 1, 1)


def test_feature_collision(spark):
    rows = [("a", 1, 10.0), ("a", 1, 10.0), ("a", 1, 11.0), ("b", 2, 5.0), ("c", 3, 1.0), ("c", 3, 1.0)]
    df = spark.createDataFrame(rows, "f STRING, g INT, Rent DOUBLE")
    r = pf.feature_collision(df, ["f", "g"]).first()
    assert (r.rows, r.feature_tuples, r.duplicate_rows, r.conflicting_rows, r.conflicting_tuples) == (6, 3, 2, 3, 1)


def test_pairwise_and_target_corr(spark):
    pdf = pd.DataFrame({"a": np.arange(50.0), "b": np.arange(50.0) ** 2, "c": np.ones(50), "Rent": np.arange(50.0) * 3})
    df = spark.createDataFrame(pdf)
    got = {(r.feature_a, r.feature_b): r.corr for r in pf.pairwise_corr(df, ["a", "b", "c"]).collect()}
    assert math.isclose(got[("a", "b")], np.corrcoef(pdf.a, pdf.b)[0, 1])
    assert got[("a", "c")] is None                        # constant column: undefined, not an error
    t = {r.feature: r for r in pf.feature_target_corr(df, ["a", "c"]).collect()}
    assert math.isclose(t["a"].corr, 1.0) and not t["a"].low_signal


def test_split_overlap_shares_of_left(spark):
    rows = [("x", "train"), ("y", "train"), ("x", "val"), ("z", "val"), ("z", "test"), ("x", "test")]
    df = spark.createDataFrame(rows, "k STRING, split STRING")
    got = {(r.left, r.right): (r.left_tuples, r.overlap, r.share) for r in sets.split_overlap(df, ["k"]).collect()}
    assert got[("train", "val")] == (2, 1, 0.5)
    assert got[("val", "test")] == (2, 2, 1.0)


def test_schema_diff(spark):
    a = spark.createDataFrame([(1, 2)], "x INT, y INT")
    b = spark.createDataFrame([(1, 2)], "y INT, z INT")
    got = {(r.column, r.side) for r in sets.schema_diff(spark, a, b).collect()}
    assert got == {("x", "left_only"), ("z", "right_only")}
    c = spark.createDataFrame([(1, 2)], "y INT, x INT")
    assert [r.side for r in sets.schema_diff(spark, a, c).collect()] == ["order_differs"]


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(1)
    y = rng.uniform(1e4, 1e5, 200)
    p = y + rng.normal(0, 5e3, 200)
    df = spark.createDataFrame(pd.DataFrame({"Rent": y, "m1": p, "split": "test"}))
    r = ev.metrics(df, ["m1"]).first()
    assert math.isclose(r.mae, np.mean(np.abs(p - y)))
    assert math.isclose(r.rmse, np.sqrt(np.mean((p - y) ** 2)))
    assert math.isclose(r.r2, 1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))
    assert math.isclose(r.corr, np.corrcoef(y, p)[0, 1])
    assert math.isclose(r.mape, np.mean(np.abs((p - y) / y)) * 100)


def test_best_model_first_on_ties_and_improvement(spark):
    m = spark.createDataFrame([("b1", "test", 5.0), ("b2", "test", 5.0), ("ens", "test", 6.0)],
                              "model STRING, split STRING, mae DOUBLE")
    best = ev.best_model(ev.rank_models(m.where("model != 'ens'"), ["b1", "b2"])).first()
    assert best.model == "b1"
    imp = ev.improvement_row(m, ["b1", "b2"], "ens").first()
    assert imp.best_base_model == "b1" and imp.improvement == -1.0 and imp.verdict == "WORSE"
    assert math.isclose(imp.improvement_pct, -20.0)


def test_acceptance(spark):
    vals = spark.createDataFrame([("test_mae", 14000.0), ("test_r2", 0.8)], "metric STRING, value DOUBLE")
    got = {r.metric: r.passed for r in ev.acceptance(spark, vals).collect()}
    assert got == {"test_mae": True, "test_r2": False}


def test_range_rules_and_drift(spark):
    df = spark.createDataFrame([(0, 1.0), (11, 2.0), (5, None)], "Beds INT, x DOUBLE")
    got = {r.column: (r.violations, r.passed) for r in au.range_rules(df, [("Beds", 0, 10), ("x", None, 1.5)]).collect()}
    assert got == {"Beds": (1, False), "x": (1, False)}
    base = spark.createDataFrame([("a", 10.0, 2.0)], "column STRING, mean DOUBLE, std DOUBLE")
    cur = spark.createDataFrame([("a", 10.5, 1.0)], "column STRING, mean DOUBLE, std DOUBLE")
    r = au.drift_check(base, cur).first()
    assert r.shift == 0.25 and r.drift


def test_forbidden_and_formula(spark):
    df = spark.createDataFrame([(1.0, 1.0)], "Rent_per_sqft DOUBLE, log_area DOUBLE")
    got = {r.column: r.present for r in au.forbidden_columns(spark, df).collect()}
    assert got["Rent_per_sqft"] and not got["Rent_category"]
    bad = au.formula_check(df, {"log_area": F.log1p(F.lit(1.0))}).first()
    assert bad.mismatches == 1


def test_split_shares_and_mean_ratio(listing_rows):
    shares = {r.split: (r.rows, r.share) for r in pf.split_shares(listing_rows).collect()}
    assert shares["train"] == (9, 9 / 12) and shares["val"] == (1, 1 / 12)
    ratio = {r.split: r for r in pf.split_mean_ratio(listing_rows).collect()}
    train_mean = np.mean([r.Rent for r in listing_rows.collect() if r.split == "train"])
    assert math.isclose(ratio["val"].ratio_to_train, 75000.0 / train_mean)
    assert ratio["train"].within_tolerance and not ratio["test"].within_tolerance


def test_cardinality_and_target_summary(listing_rows):
    card = {r.column: r.n_unique for r in pf.category_cardinality(listing_rows, ["Location", "Furnishing"]).collect()}
    assert card == {"Location": 5, "Furnishing": 3}
    s = pf.target_summary(listing_rows).first()
    rents = [r.Rent for r in listing_rows.collect()]
    assert s.n == 12 and s.min == 0.0 and s.max == 999999.0 and s.median == float(np.median(rents))
    assert math.isclose(s.mean, np.mean(rents))


def test_correlations_use_the_rows_where_both_are_known(spark):
    rows = [(1.0, 2.0, None), (2.0, 1.0, 5.0), (3.0, 5.0, None), (4.0, None, 1.0), (5.0, 6.0, 4.0), (6.0, 5.5, 9.0)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE")
    got = {(r.feature_a, r.feature_b): r.corr for r in pf.pairwise_corr(df, ["a", "b", "c"]).collect()}
    for (x, y), value in got.items():
        i, j = "abc".index(x), "abc".index(y)
        known = [(r[i], r[j]) for r in rows if None not in (r[i], r[j])]
        assert math.isclose(value, np.corrcoef(*zip(*known))[0, 1])


def test_shares_bounds_and_strata(spark):
    df = spark.createDataFrame([("s", "train")] * 14 + [("s", "val")] * 2 + [("t", "test")] * 4 + [("t", "odd")], "stratum STRING, split STRING")
    got = {r.split: (r.rows, r.within_bounds) for r in pf.split_shares(df).collect()}
    assert got == {"train": (14, True), "val": (2, False), "test": (4, True), "odd": (1, None)}
    strata = {r.stratum: (r.rows, r.train_share, r.val_share, r.test_share) for r in pf.stratum_shares(df).collect()}
    assert strata["s"] == (16, 14 / 16, 2 / 16, 0.0) and strata["t"] == (5, 0.0, 0.0, 0.8)


def test_metrics_cover_rows_where_both_are_known(spark):
    from hearth.operators.evaluate import metrics, segment_metrics
    rows = [("test", "a", 10.0, 12.0), ("test", "a", 20.0, 19.0), ("test", "a", 40.0, 37.0)]
    odd = [("test", "a", 500.0, None), ("test", "a", None, 3.0), ("test", "a", None, None)]
    frame = lambda x: spark.createDataFrame(x, "split STRING, Type STRING, Rent DOUBLE, p DOUBLE")
    whole, holes = (metrics(frame(x), ["p"]).first().asDict() for x in (rows, rows + odd))
    assert whole["missing"] == 0 and holes["missing"] == 3 and holes["n"] == 3
    assert all(abs(holes[k] - whole[k]) < 1e-12 for k in ("mae", "rmse", "r2", "mape", "corr"))
    assert abs(segment_metrics(frame(rows + odd), ["p"], ["Type"]).first().r2 - whole["r2"]) < 1e-12
    none = metrics(frame(odd), ["p"]).first()
    assert (none.n, none.missing, none.mae, none.r2, none.corr) == (0, 3, None, None, None)


def test_psi_of_equal_tables_with_nulls_is_zero(spark):
    from hearth.operators.audit import psi
    rows = [(float(i) if i % 10 else None, float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE")
    assert {r["column"]: round(r["psi"], 9) for r in psi(df, df, ["a", "b"]).collect()} == {"a": 0.0, "b": 0.0}
    shifted = spark.createDataFrame([(None if i % 2 else a, b) for i, (a, b) in enumerate(rows)], "a DOUBLE, b DOUBLE")
    got = {r["column"]: r["psi"] for r in psi(df, shifted, ["a", "b"]).collect()}
    assert got["a"] > 0.5 and abs(got["b"]) < 1e-9
