"""Distributed exact ranks/quantiles against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.operators.ranks import quantiles, value_ranks


def _data(spark, seed=7, n=3000):
    rng = np.random.default_rng(seed)
    groups = rng.choice(["hot", "a", "b", "c"], size=n, p=[0.6, 0.2, 0.15, 0.05])
    vals = np.round(rng.gamma(2.0, 50.0, size=n), 0)       # many ties
    return spark.createDataFrame([(str(g), float(v)) for g, v in zip(groups, vals)], "g STRING, v DOUBLE"), groups, vals


@pytest.mark.parametrize("slices", [1, 4, 32])
def test_value_ranks_exact(spark, slices):
    df, groups, vals = _data(spark)
    got = {(r.g, r.v): (r.cnt, r.below, r.n) for r in value_ranks(df, ["g"], "v", slices=slices).collect()}
    for g in set(groups):
        x = vals[groups == g]
        for v in np.unique(x):
            assert got[(g, float(v))] == ((x == v).sum(), (x < v).sum(), len(x))


def test_weighted_probes(spark):
    df = spark.createDataFrame([("a", 1.0, 2), ("a", 3.0, 1), ("a", 2.0, 0), ("a", 0.5, 0)],
                               "g STRING, v DOUBLE, w BIGINT")
    got = {r.v: (r.below, r.n) for r in value_ranks(df, ["g"], "v", weight="w").collect()}
    assert got == {0.5: (0, 3), 1.0: (0, 3), 2.0: (2, 3), 3.0: (2, 3)}


@pytest.mark.parametrize("probs", [[0.25, 0.5, 0.75], [0.0, 1.0, 0.1]])
def test_quantiles_match_linear_interpolation(spark, probs):
    df, groups, vals = _data(spark, seed=3)
    rows = {r.g: r for r in quantiles(df, ["g"], "v", probs, [f"p{i}" for i in range(len(probs))]).collect()}
    for g in set(groups):
        expect = np.quantile(vals[groups == g], probs)
        assert np.allclose([rows[g][f"p{i}"] for i in range(len(probs))], expect)


def test_global_median_and_single_row(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (20.0,), (40.0,)], "v DOUBLE")
    r = quantiles(df, [], "v", [0.25, 0.5], ["q25", "q50"]).first()
    assert r.q25 == 17.5 and r.q50 == 20.0
    one = spark.createDataFrame([("x", 5.0)], "g STRING, v DOUBLE")
    assert quantiles(one, ["g"], "v", [0.5], ["m"]).first().m == 5.0


def test_nulls_not_ranked(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 2.0)], "g STRING, v DOUBLE")
    got = sorted((r.v, r.below, r.n) for r in value_ranks(df, ["g"], "v").collect())
    assert got == [(1.0, 0, 2), (2.0, 1, 2)]


def test_one_hot_group_in_small_slices(spark):
    """A single group far wider than a slice: ranges of values, none with more than its share."""
    n, slices = 20_000, 50
    df = spark.range(n).select(F.lit("hot").alias("g"), (F.col("id") * 7919 % n).cast("double").alias("v"))
    got = value_ranks(df, ["g"], "v", slices=slices)
    assert got.where("below != v or n != 20000 or cnt != 1").count() == 0 and got.count() == n
    placed = df.repartitionByRange(slices, "g", "v").groupBy(F.spark_partition_id()).count()
    assert placed.agg(F.max("count")).first()[0] < 3 * n / slices


def test_string_values_are_ranked(spark):
    df = spark.createDataFrame([("c", "b"), ("c", "a"), ("d", "z"), ("c", "é")], "g STRING, v STRING")
    got = sorted((r.g, r.v, r.below) for r in value_ranks(df, ["g"], "v", slices=3).collect())
    assert got == [("c", "a", 0), ("c", "b", 1), ("c", "é", 2), ("d", "z", 0)]


@pytest.mark.parametrize("slices", [1, 3])
def test_null_group_is_a_group(spark, slices):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0), (None, 2.0)], "g STRING, v DOUBLE")
    got = sorted(((r.g or "-"), r.v, r.below, r.n) for r in value_ranks(df, ["g"], "v", slices=slices).collect())
    assert got == [("-", 1.0, 0, 3), ("-", 2.0, 1, 3), ("-", 3.0, 2, 3), ("a", 2.0, 0, 1)]
    q = {r.g: r.m for r in quantiles(df, ["g"], "v", [0.5], ["m"], slices=slices).collect()}
    assert q == {None: 2.0, "a": 2.0}


@pytest.mark.parametrize("max_rows", [2_000_000, 0])
def test_rank_index_as_of_lookup(spark, tmp_path, max_rows, monkeypatch):
    """Known and unknown values, below, between and above all; groups of one block and of many; a stored index."""
    from hearth.operators import ranks
    monkeypatch.setattr(ranks, "BLOCK_VALUES", 7)
    df, groups, vals = _data(spark)
    hist = df.groupBy("g", "v").agg(F.count("*").alias("cnt")).union(spark.createDataFrame([(None, 1.0, 3), ("a", None, 4)], "g STRING, v DOUBLE, cnt BIGINT"))
    index = ranks.rank_index(hist, "g", "v", max_rows=max_rows)
    probes = sorted({float(x) + d for x in list(vals[:200]) + [vals.min(), vals.max()] for d in (-0.5, 0.0, 0.25)})
    batch = [(i, g, v) for i, (g, v) in enumerate([(g, v) for g in ("hot", "a", "b", "c", "new", None) for v in probes + [None]])]
    rows = spark.createDataFrame(batch, "i INT, g STRING, v DOUBLE").repartition(5)
    index.write(str(tmp_path / "index"))
    for stored in (index, ranks.RankIndex.read(spark, str(tmp_path / "index"), max_rows)):
        got = stored.lookup(rows, "g", "v").collect()
        assert len(got) == len(batch) and set(got[0].asDict()) == {"i", "g", "v", "below", "n"}
        for r in got:
            x = vals[groups == r.g]
            assert r.n == (len(x) or None) and r.below == (int((x < r.v).sum()) if len(x) and r.v is not None else None), r
    if max_rows:
        plan = index.lookup(rows, "g", "v")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning(g" not in plan
