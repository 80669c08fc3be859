"""Boosted trees against a plain numpy version that sees all rows at once."""

from __future__ import annotations

import os
import tempfile
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hearth.constants import TUNED_PARAMS
from hearth.plans import boosting as bo

NUM, CAT = ["x1", "x2", "x3"], ["c1", "c2"]


# A plain version ---------------------------------------------------------------
def gain_of(g, left, p):
    def s(part):
        t = np.sign(part.sum()) * max(abs(part.sum()) - p.reg_alpha, 0)
        return t * t / (len(part) + p.reg_lambda)
    return (s(g[left]) + s(g[~left]) - s(g)) / 2


def splits_of(codes, first, widths, columns, units):
    """(feature, bin, goes left) of every allowed split, in order."""
    start = 0
    for f, w in enumerate(widths):
        for b in range(w):
            if units[start + b] >= 0 and units[start + b] in columns:
                yield f, b, (codes[f] != b) if f >= first else (codes[f] <= b)
        start += w


def plain_tree(codes, g, rows, first, widths, units, p, rng):
    """Leaf of each row as {node: mask of all rows} and the leaves' values."""
    every = np.arange(units.max() + 1)
    sample = lambda of, share: of if share >= 1 else np.sort(rng.choice(of, max(1, round(share * len(of))), replace=False))
    tree_columns = sample(every, p.colsample_bytree)
    least, all_rows = max(p.min_child_weight, 1), np.ones(codes.shape[1], bool)

    def best(mask, columns):
        found, own = None, mask & rows
        for f, b, left in splits_of(codes, first, widths, columns, units):
            n = (left & own).sum()
            if n >= least and own.sum() - n >= least:
                gain = gain_of(g[own], left[own], p) - p.gamma
                if found is None or gain > found[0]:
                    found = gain, left
        return found

    if p.growth == "leaf":
        leaves = [(best(all_rows, tree_columns), 0, all_rows)]
        while len(leaves) < (p.num_leaves or 10**9):
            open_ = [x for x in leaves if x[0] and x[0][0] > 0 and x[1] < p.max_depth]
            if not open_:
                break
            top = max(open_, key=lambda x: x[0][0])
            leaves = [x for x in leaves if x is not top]
            for side in (top[0][1], ~top[0][1]):
                leaves.append((best(top[2] & side, tree_columns), top[1] + 1, top[2] & side))
        masks = [x[2] for x in leaves]
    else:
        masks, open_ = [], [all_rows]
        for _ in range(p.max_depth):
            columns, grown = set(sample(tree_columns, p.colsample_bylevel).tolist()), []
            if p.growth == "symmetric":
                top = None
                for f, b, left in splits_of(codes, first, widths, columns, units):
                    ok = [m for m in open_ if least <= (left & m & rows).sum() <= (m & rows).sum() - least]
                    gain = sum(gain_of(g[m & rows], left[m & rows], p) for m in ok) - p.gamma
                    if ok and (top is None or gain > top[0]):
                        top = gain, left, ok
                if not top or top[0] <= 0:
                    break
                for m in open_:
                    grown += [m & top[1], m & ~top[1]] if any(m is x for x in top[2]) else [m]
            else:
                for m in open_:
                    found = best(m, columns)
                    if found and found[0] > 0:
                        grown += [m & found[1], m & ~found[1]]
                    else:
                        masks.append(m)
            open_ = grown
            if not open_:
                break
        masks += open_
    out = np.zeros(codes.shape[1])
    for m in masks:
        own = g[m & rows]
        if len(own):
            out[m] = -p.learning_rate * np.sign(own.sum()) * max(abs(own.sum()) - p.reg_alpha, 0) / (len(own) + p.reg_lambda)
    return out


def plain_boost(codes, y, train, noise, binner, p, index):
    base = float(f"{y[train].mean():.9g}")
    pred = np.full(len(y), base)
    for t in range(p.trees):
        rows = train
        if p.subsample < 1:
            rows = train & bo.drawn(noise, p.subsample, (p.seed * 1_000_003 + t) * 0x9E3779B97F4A7C15 % (1 << 64))
        pred = pred + plain_tree(codes, pred - y, rows, binner.first_category, binner.widths, bo._units(binner), p, np.random.default_rng([p.seed, index, t]))
    return pred


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 1500
    x = pd.DataFrame({"k": np.arange(n) * 3 + 1, "x1": rng.normal(size=n), "x2": rng.integers(0, 6, n).astype(float), "x3": rng.exponential(size=n),
                      "c1": rng.choice(list("abcdefg"), n), "c2": rng.choice(["u", "v"], n), "fold": rng.integers(-1, 3, n)})
    x.loc[::50, "x3"] = np.nan
    x.loc[::70, "c1"] = None
    x["Rent"] = 50 * x.x1 + 20 * (x.x2 > 2) * x.x3.fillna(1) + 30 * (x.c1 == "c") - 12 * (x.c2 == "v") + rng.normal(size=n)
    df = spark.createDataFrame(x.astype({"c1": object}).where(x.notna(), None).astype({"k": int, "fold": int}),
                               "k long, x1 double, x2 double, x3 double, c1 string, c2 string, fold int, Rent double")
    binner = bo.fit_binner(df.where("fold != -1"), NUM, CAT, max_bins=12)
    packed = bo.pack(df.repartition(5), binner, ["k"])
    import pyarrow as pa
    rows = df.withColumn("noise", F.xxhash64("k")).orderBy("k").toPandas()
    kinds = [pa.float64()] * 3 + [pa.string()] * 2
    codes = binner.codes([pa.array(rows[c], k, from_pandas=True) for c, k in zip(NUM + CAT, kinds)], "<u2").astype(int)
    return df, binner, packed, rows, codes


def predictions(done):
    got = done.unpacked(lambda block, preds: {f"p{i}": p for i, p in enumerate(preds)},
                        ", ".join(f"p{i} double" for i in range(done.models))).orderBy("k").toPandas()
    return got[[f"p{i}" for i in range(done.models)]].to_numpy().T


SAMPLED = dict(subsample=0.8, colsample_bytree=0.7, min_child_weight=7, reg_alpha=3.0, reg_lambda=2.0, learning_rate=0.3, trees=4)
CASES = {
    "plain": bo.Params(trees=3, max_depth=3, learning_rate=0.5),
    "depth": bo.Params(growth="depth", max_depth=5, gamma=40.0, colsample_bylevel=0.8, **SAMPLED),
    "leaf": bo.Params(growth="leaf", max_depth=6, num_leaves=9, **SAMPLED),
    "leaf_many": bo.Params(growth="leaf", max_depth=4, num_leaves=100, trees=2),
    "symmetric": bo.Params(growth="symmetric", max_depth=5, colsample_bylevel=0.8, **SAMPLED),
    "stump": bo.Params(trees=2, max_depth=1, min_child_weight=400),
}


def test_trees_equal_the_plain_version(table):
    """All growths, penalties, samples and leaf limits, all rows (validation rows too)."""
    _, binner, packed, rows, codes = table
    models = [bo.Model(n, p) for n, p in CASES.items()]
    got = predictions(bo.grow(packed, models))
    y, noise = rows.Rent.to_numpy(), rows.noise.to_numpy().astype(np.int64).view(np.uint64)
    train = (rows.fold != -1).to_numpy()
    for i, (name, p) in enumerate(CASES.items()):
        want = plain_boost(codes, y, train, noise, binner, p, i)
        assert np.allclose(got[i], want, rtol=1e-7, atol=1e-5), name
        assert np.isclose(np.abs(got[i] - y)[~train].mean(), np.abs(want - y)[~train].mean(), rtol=1e-7)
    leaves = [sum(f < 0 for f in t.feature) for t in models[2].trees]
    reachable = [sum(f >= 0 for f in t.feature) + 1 for t in models[2].trees]
    assert all(n <= 9 for n in reachable) and max(reachable) == 9 and all(a >= b for a, b in zip(leaves, reachable))
    assert all(m >= 7 for t in models[1].trees for m in t.rows)


def test_folds_at_once_equal_separate_fits(table):
    df, binner, packed, rows, codes = table
    learners = {"depth": replace(CASES["depth"], trees=2, colsample_bytree=1.0, colsample_bylevel=1.0), "symmetric": replace(CASES["symmetric"], trees=2, colsample_bytree=1.0, colsample_bylevel=1.0)}
    boosted, done, models = bo.fit(df, learners, ["k"], fold="fold", folds=range(3), binner=binner)
    names = {n: f"pred_{n}" for n in learners}
    oof = bo.out_of_fold(done, models, names).orderBy("k").toPandas()
    assert len(oof) == (rows.fold != -1).sum() and set(oof.columns) == {"k", "fold", "label", "pred_depth", "pred_symmetric"}
    for n, folds in (("depth", (0, 2)), ("symmetric", (1,))):
        p = learners[n]
        for k in folds:
            alone = [bo.Model(n, p)]
            other = bo.pack(df.withColumn("fold", F.when(F.col("fold") == k, bo.VALIDATION).otherwise(F.col("fold"))), binner, ["k"])
            want = predictions(bo.grow(other, alone))[0][(rows.fold == k).to_numpy()]
            assert np.allclose(oof[oof.fold == k][f"pred_{n}"], want, rtol=1e-9)


def test_scoring_and_bundle_give_the_predictions_of_the_table(spark, table):
    df, binner, packed, rows, _ = table
    models = [bo.Model(n, replace(CASES[n], trees=2)) for n in ("depth", "leaf", "symmetric")]
    got = predictions(bo.grow(packed, models))
    boosted = bo.Boosted(binner, models)
    for b in (boosted, bo.Boosted.from_json(boosted.to_json())):
        scored = b.predict(df.withColumn("pred_other", F.lit(1))).orderBy("k").toPandas()
        assert np.allclose(scored[["pred_depth", "pred_leaf", "pred_symmetric"]].to_numpy().T, got) and "x1" in scored and "pred_other" in scored
    odd = spark.createDataFrame([(None, None, float("nan"), "never seen", None)], "x1 double, x2 double, x3 double, c1 string, c2 string")
    assert np.isfinite([v for v in boosted.predict(odd).select("pred_depth", "pred_leaf", "pred_symmetric").first()]).all()
    assert boosted.predict(odd.limit(0)).count() == 0
    used = boosted.importances(spark).toPandas()
    assert len(used) == 15 and used[(used.model == "depth") & (used.feature == "x1")].gain.iloc[0] == used[used.model == "depth"].gain.max()


def test_tuned_values_all_have_a_counterpart():
    learners = bo.tuned_learners()
    for name, source in (("depthwise", "XGBoost"), ("leafwise", "LightGBM"), ("symmetric", "CatBoost")):
        values = list(TUNED_PARAMS[source].values())
        own = [getattr(learners[name], f) for f in learners[name].__dataclass_fields__]
        assert all(v in own for v in values)
    assert learners["leafwise"].num_leaves == 100 and learners["depthwise"].reg_alpha == 1.0
    with pytest.raises(TypeError):
        bo.tuned_learners(tuned={**TUNED_PARAMS, "XGBoost": {"unheard_of": 1}})


def test_halving_finds_the_best_of_the_full_grid(table):
    _, _, packed, _, _ = table
    grid = {f"{d}-{r}": bo.Params(trees=6, max_depth=d, learning_rate=r) for d in (1, 3) for r in (0.01, 0.1, 0.4)}
    full = [bo.Model(n, p) for n, p in grid.items()]
    table_errors = {r["model"]: r["abs_sum"] / r["n"] for r in bo.errors(bo.grow(packed, full)).collect()}
    found = bo.halving_search(packed, grid, rungs=(2, 4))
    best = next(r for r in found if r["rank"] == 1)
    assert best["name"] == list(grid)[min(table_errors, key=table_errors.get)]
    assert np.isclose(best["val_mae"], min(table_errors.values())) and best["trees"] == 6
    assert sorted(r["trees"] for r in found) == [2, 2, 2, 4, 6, 6] and sorted(r["rank"] for r in found) == [1, 2, 3, 4, 5, 6]


def test_one_class_tables_and_missing_labels(spark):
    rows = [(i, 1.0, None, None, "a", None, 0, 5.0) for i in range(20)] + [(99, 1.0, 2.0, 3.0, "b", "u", 0, None)]
    df = spark.createDataFrame(rows, "k long, x1 double, x2 double, x3 double, c1 string, c2 string, fold int, Rent double")
    binner = bo.fit_binner(df, NUM, CAT)
    model = bo.Model("m", bo.Params(trees=2))
    done = bo.grow(bo.pack(df, binner, ["k"]), [model])
    assert predictions(done).tolist() == [[5.0] * 20] and all(t.feature == [-1] for t in model.trees)
    with pytest.raises(ValueError, match="too many categories"):
        original, bo.MAX_CATEGORIES = bo.MAX_CATEGORIES, 1
        try:
            bo.fit_binner(df, NUM, CAT)
        finally:
            bo.MAX_CATEGORIES = original


def test_stack_of_tuned_learners_learns_a_known_signal(spark):
    from hearth.functions.hashing import unit_hash
    from hearth.plans.stacking import train_boosted
    from hearth.sources.sinks import load_boosted, save_stacked_versions
    from tests.test_stacking_stream_io import _generated_listings
    df = _generated_listings(spark).withColumn("split", F.when(unit_hash(["k"], 42) < 0.7, "train").otherwise("test"))
    learners = {n: replace(p, learning_rate=0.4) for n, p in bo.tuned_learners(trees=8, max_depth=4).items()}
    model, meta = train_boosted(df, ["k"], learners=learners, folds=2)
    assert meta.count() == df.where("split = 'train'").count()
    test = df.where("split = 'test'")
    scored = model.score(test).select("k", "Rent", "prediction").orderBy("k").toPandas()
    assert np.corrcoef(scored.Rent, scored.prediction)[0, 1] >= 0.97
    assert 1 - ((scored.Rent - scored.prediction) ** 2).sum() / ((scored.Rent - scored.Rent.mean()) ** 2).sum() >= 0.93
    _, latest = save_stacked_versions(model, tempfile.mkdtemp(prefix="hearth-model-"), "20250101_000000")
    again = load_boosted(spark, latest).score(test).select("k", "prediction").orderBy("k").toPandas()
    assert np.allclose(scored.prediction, again.prediction)
    # as a stream: equal row for row; a newer bundle takes over at the next batch; a repeated batch replaces itself
    from hearth.sources.sinks import read_log
    from hearth.streaming.scoring import score_stream
    root, work = os.path.dirname(latest), tempfile.mkdtemp(prefix="hearth-stream-")
    inputs = test.drop("Rent", "split")
    schema = inputs.schema
    part = lambda i: inputs.where(F.col("k") % 2 == i).coalesce(1).write.mode("append").parquet(f"{work}/in")
    run = lambda state: score_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/in"), root, f"{work}/log", "s",
                                     f"{work}/{state}", ["k", "Area_in_sqft"])
    logged = lambda: {r.k: r.prediction for r in read_log(spark, f"{work}/log").collect()}
    part(0)
    run("state")
    want = dict(zip(scored.k, scored.prediction))
    first = logged()
    assert set(first) == {k for k in want if k % 2 == 0} and all(np.isclose(first[k], want[k]) for k in first)
    other = replace(model, ridge=replace(model.ridge, intercept=model.ridge.intercept + 1e6))
    save_stacked_versions(other, root, "20250102_000000")
    part(1)
    run("state")
    assert read_log(spark, f"{work}/log").count() == len(want)
    assert all(np.isclose(v, want[k] + (1e6 if k % 2 else 0)) for k, v in logged().items())
    run("lost")                                                          # from the start, by the newer bundle
    assert read_log(spark, f"{work}/log").count() == len(want) and all(np.isclose(v, want[k] + 1e6) for k, v in logged().items())


def test_a_run_keeps_its_table_on_disk_in_small_blocks(spark):
    df = spark.range(34_000).select("id", (F.col("id") % 50).cast("double").alias("x1"), (F.col("id") % 7).cast("double").alias("Rent"))
    held = lambda: {i.id(): (i.memSize(), i.diskSize()) for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    before, during = held(), []

    def after(trees, found):
        during.extend(size for i, size in held().items() if i not in before)
        return set()

    models = [bo.Model(f"m{i}", bo.Params(trees=2, max_depth=2)) for i in range(18)]
    done = bo.grow(bo.pack(df, bo.fit_binner(df, ["x1"], []), ["id"], fold=None), models, after, [2])
    assert any(disk for _, disk in during) and not any(memory for memory, _ in during)
    sizes = done.blocks.agg(F.sum("n").alias("n"), F.max(F.length("preds")).alias("most")).first()
    assert sizes["n"] == 34_000 and sizes["most"] < 1 << 20


def test_of_two_sisters_the_one_with_fewer_rows_is_summed(table, monkeypatch):
    """And gradients are all that a pass reads; what a run returns is in no written predictions."""
    _, binner, packed, rows, codes = table
    passes, level_splits = [], bo.level_splits

    def seen(gradients, order, binner, grown, *rest):
        passes.append({i: (len(g.now), g.slots) for i, g in grown.items()})
        return level_splits(gradients, order, binner, grown, *rest)

    monkeypatch.setattr(bo, "level_splits", seen)
    models = [bo.Model(n, replace(CASES[n], trees=2)) for n in ("depth", "leaf", "leaf_many", "symmetric")]
    done = bo.grow(packed, models)
    below = [x for p in passes for x in p.values() if x != (1, 1)]
    assert len(below) > 20 and all(2 * summed <= open_ for open_, summed in below)
    assert done.blocks.agg(F.max(F.length("preds"))).first()[0] == 0


def test_large_gradients_chunks_and_cuts_give_the_same_trees(table, monkeypatch):
    """Sums of gradients and rows that don't fit one integer, many chunks a task, features in groups of several
    sizes and trees deeper than the levels by place."""
    _, _, packed, _, _ = table
    cases = [replace(CASES["depth"], trees=3, max_depth=8, min_child_weight=2), replace(CASES["leaf"], trees=3, num_leaves=40), replace(CASES["symmetric"], trees=3)]
    grown = lambda: (m := [bo.Model(str(i), p) for i, p in enumerate(cases)], predictions(bo.grow(packed, m)))
    models, want = grown()
    for name, value in (("CHUNK_ROWS", 100), ("JOINT_CELLS", 30), ("TOP_LEVELS", 2), ("CUT_TREES", 1)):
        monkeypatch.setattr(bo, name, value)
    again, got = grown()
    assert [m.trees for m in again] == [m.trees for m in models] and np.array_equal(got, want)


def test_sums_of_any_size_are_exact():
    rng = np.random.default_rng(5)
    n, widths = 3000, [7, 40, 3]
    codes = np.stack([rng.integers(0, w, n) for w in widths]).astype("u1")
    use = rng.random(n) < 0.8
    for reach in (3, 2**30, 2**50):
        gradient = np.where(use, rng.integers(-reach, reach, n), 0)
        for slots, arrays in ((1, bo.Tree().arrays()), (2, (np.array([1, -1, -1]), np.array([20, 0, 0]), np.array([1, 0, 0]), np.zeros(3)))):
            grown = bo._Grown(arrays, np.array([0] if slots == 1 else [-1, 0, 1]), slots, *np.zeros((3, slots), int))
            sums = bo._Sums({4: grown}, [4], widths, 3)
            sums.add(codes, gradient[None], use[None])
            node = np.zeros(n, int) if slots == 1 else (codes[1] > 20).astype(int)
            start = 0
            for f, w in enumerate(widths):
                for table, values in ((sums.sums[4], gradient.tolist()), (sums.counts[4], use.tolist())):
                    want = [[0] * w for _ in range(slots)]
                    for at, code, v in zip(node.tolist(), codes[f].tolist(), values):
                        want[at][code] += v
                    assert table[:, start:start + w].tolist() == want
                start += w


def test_a_search_leaves_no_table_of_all_rows(spark, sf_dir):
    from hearth.operators import joins
    from hearth.plans.catalog import q_grid_search
    before = set(joins._TABLES)
    assert q_grid_search(spark, sf_dir, {"symmetric": {"max_depth": [2, 3]}}, (2,)).count() == 2
    left = [spark.read.parquet(t) for t in joins._TABLES if t not in before]
    assert left and not any({"l_orderkey", "codes"} & set(t.columns) for t in left)
