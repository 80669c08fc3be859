"""Operators 11 to 13 against plain versions, with the odd cases every operator must take."""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hearth.llm.filter_audit import FILTERS, audit, document_failures, filter_interactions, kernel_map
from hearth.llm.topk_search import BLOCK_ROWS, Block, best_of, top_k
from hearth.llm.whitening import whiten

LABELS = "doc_id long, quality int, toxic int"


# 11 --------------------------------------------------------------------------
def plain_audit(docs: list[tuple], labels: list[tuple]) -> set[tuple]:
    """Walks every document through every order."""
    smallest: dict[str, int] = {}
    for k, text, _ in docs:
        if k is not None:
            smallest[text or ""] = min(k, smallest.get(text or "", k))
    good, toxic = ({k for k, q, t in labels if k is not None and (q, t)[i] == 1} for i in (0, 1))
    rows = []
    for k, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {f for f, bad in zip(FILTERS, (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            bool(re.search(r"[#$%&*|]", text)), k is not None and k > smallest[text])) if bad}
        rows.append((source or "", fails, k in good, k in toxic))
    out = set()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        table, total = [], Counter()
        for order in itertools.permutations(FILTERS):
            left = own
            for step, f in enumerate(order, 1):
                gone, rest = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                failing = [r for r in own if f in r[1]]
                total[f] += len(gone)
                table.append((part, "".join(order), step, len(rest), len(gone), len(failing) - len(gone),
                              sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone), f))
                left = rest
        out |= {(*t[:-1], total[t[-1]]) for t in table}
    return out


@pytest.fixture(scope="module")
def audited(spark):
    long = " ".join(f"w{i}" for i in range(60))
    texts = [long, long, None, "", "\t \n", "SHOUT " * 60, "same " * 60, "a # b", long + " | x", long.upper(), "x" * 100_000, "É" * 60,
             "word " * 200_000, long, long]
    docs = [(i, t, ["a", "b", None, ""][i % 4]) for i, t in enumerate(texts)]
    docs += [(3, long, "a"), (0, long, "a"), (0, long, "a"), (None, long, "b"), (None, "", None), (99, "", "only")]
    labels = [(0, 1, 0), (1, 0, 1), (1, 1, None), (1, 1, 1), (5, 0, 1), (None, 1, 1), (8, None, None), (777, 1, 1)]
    return docs, labels


def test_audit_equals_a_walk_through_all_orders(spark, audited):
    docs, labels = audited
    frame = spark.createDataFrame([(*d, i, "x", True) for i, d in enumerate(docs)],
                                  "doc_id long, text string, source string, n long, part string, A boolean").repartition(3)
    got = [tuple(r) for r in audit(frame, spark.createDataFrame(labels, LABELS)).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_audit(docs, labels)


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], LABELS)
    assert audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, None, None)], docs.schema)
    rows = audit(one, labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""} and all(r.good_lost == r.toxic_lost == 0 for r in rows)
    assert document_failures(one, labels).first().asDict() | {"doc_id": 0} == {
        "doc_id": 0, "part": "", "A": True, "B": False, "C": False, "D": False, "E": False, "good": False, "toxic": False}


@settings(max_examples=40, deadline=None)
@given(st.integers(2, 5).flatmap(lambda n: st.tuples(st.just(n), st.lists(st.integers(-50, 50), min_size=1 << n, max_size=1 << n))))
def test_kernel_solution_is_the_mean_over_orders(game):
    n, value = game
    value = [0, *value[1:]]
    want = [Fraction(0)] * n
    for order in itertools.permutations(range(n)):
        s = 0
        for i in order:
            want[i] += Fraction(value[s | 1 << i] - value[s], math.factorial(n))
            s |= 1 << i
    assert [sum(c * v for c, v in zip(row, value)) for row in kernel_map(n)] == want


def test_interactions_of_other_filters(spark):
    rows = spark.createDataFrame([("p", True, True, False), ("p", False, True, True), ("p", False, False, False), ("q", False, False, True)],
                                 "part string, x boolean, y boolean, z boolean")
    got = {(r.part, r.filter_order, r.step): r for r in filter_interactions(rows, ["x", "y", "z"]).collect()}
    assert len(got) == 2 * 6 * 3
    r = got["p", "yxz", 2]
    assert (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) == (1, 0, 1, 0, 3)
    assert got["q", "xyz", 3].removed == 1 and got["q", "xyz", 3].shapley == 6


# 12 --------------------------------------------------------------------------
def vectors(n: int, d: int, seed: int = 0) -> list[list[float]]:
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) @ rng.normal(size=(d, d))).tolist()


def plain_whitening(rows: list[list[float]], components: int) -> tuple:
    x = np.floor(64 * np.array(rows)).astype(np.int64) + 1_000_000
    distinct = np.unique(x, axis=0)
    n, total = len(distinct), distinct.sum(axis=0)
    centred = (n * distinct - total) / n
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1], axes[:, ::-1]
    k = min(components, int((e > e[0] * len(e) * np.finfo(float).eps).sum()))
    return n, ((n * x - total) ** 2).sum(axis=1), ((n * x - total) / n) @ axes[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


@pytest.mark.parametrize("n, d", [(300, 24), (30, 5)])
def test_whitening_equals_numpy(spark, n, d):
    rows = vectors(n, d)
    rows += [rows[3]] * n                                           # a vector that holds half of all rows counts once
    got = whiten(spark.createDataFrame([(i, v, i, "x") for i, v in enumerate(rows)],
                                       "vec_id long, embedding array<float>, n long, x string").repartition(7)).toPandas()
    real = np.array(rows, np.float32).astype(float).tolist()
    distinct, deviation, white, explained = plain_whitening(real, 16)
    assert len(got) == len(rows) * white.shape[1] and set(got.n) == {distinct} == {n}
    table = got.pivot_table(index="vec_id", columns="component", values="whitened").to_numpy()
    sign = np.sign((table * white).sum(axis=0))
    assert np.allclose(table, white * sign, atol=1e-8)
    assert got.drop_duplicates("vec_id").sort_values("vec_id").deviation.tolist() == deviation.tolist()
    assert np.allclose(got.drop_duplicates("component").sort_values("component").explained, explained, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and 0 <= got.identity_error.iloc[0] < 1e-8


def test_whitening_over_several_row_and_column_blocks(spark, monkeypatch):
    from hearth.llm import whitening
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    monkeypatch.setattr(whitening, "BLOCK_COLS", 7)
    monkeypatch.setattr(whitening, "BLOCKS_A_TASK", 2)
    rows = vectors(150, 20, 3)
    got = whiten(spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>").repartition(5), components=20).toPandas()
    _, _, white, _ = plain_whitening(rows, 20)
    table = got.pivot_table(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.allclose(np.abs(table), np.abs(white), atol=1e-6)


def test_whitening_drops_and_degenerate_tables(spark):
    kind = "vec_id long, embedding array<double>"
    good = vectors(40, 3, 1)
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 0.0]), (104, [float("inf"), 0.0, 1.0]), (105, [1.0, 2.0])]
    rows = [*enumerate(good), (None, good[0]), (7, good[7]), *odd]
    got = whiten(spark.createDataFrame(rows, kind)).toPandas()
    assert len(got) == 42 * 3 and set(got.vec_id.dropna().astype(int)) == set(range(40)) and got.vec_id.isna().sum() == 3
    assert set(got.n) == {40}
    for few in ([], odd[:5], [(1, [1.0, 2.0])] * 4):
        assert whiten(spark.createDataFrame(few, kind)).count() == 0
    flat = whiten(spark.createDataFrame([(i, [float(i), 5.0, 2.0 * i]) for i in range(10)], kind)).toPandas()
    assert set(flat.component) == {1} and np.allclose(flat.explained, 1)


# 13 --------------------------------------------------------------------------
def plain_top(rows: list[tuple], asked: list[tuple], k: int) -> set[tuple]:
    def ints(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * x) for x in v]

    docs = [(i, w) for i, v in rows if i is not None and (w := ints(v)) is not None]
    questions: dict[int, list[int]] = {}
    for i, v in asked:
        if i is not None and (w := ints(v)) is not None:
            questions[i] = min(w, questions.get(i, w))
    out = set()
    for q, w in questions.items():
        found = sorted((-sum(a * b for a, b in zip(w, x)), i) for i, x in docs if i != q)
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(found[:k], 1)}
    return out


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-3, 4, 12) / 7 * (rng.random(12) < 0.4)).tolist()) for i in range(400)]       # sparse, many ties
    rows += [(1000 + i, rows[9][1]) for i in range(300)]                                           # a third are copies
    rows += [(2000, None), (2001, []), (2002, [1.0, None]), (2003, [float("nan")] * 12), (2004, [float("-inf")] * 12), (2005, [1.0, -2.0]),
             (None, [9.0] * 12), (30, [5.0] * 12), (30, [4.0] * 12), (40, rows[40][1])]
    frame = spark.createDataFrame([(*r, "a", 1) for r in rows], "vec_id long, embedding array<double>, id string, score int").repartition(9)
    for k, size in ((5, 64), (1, BLOCK_ROWS), (3, 7)):
        got = [tuple(r) for r in top_k(frame, frame.where("vec_id % 10 = 0"), k, block_rows=size, query_rows=13).collect()]
        assert len(got) == len(set(got)) and set(got) == plain_top(rows, [r for r in rows if r[0] is not None and r[0] % 10 == 0], k)


def test_top_k_with_few_candidates_and_large_weights(spark):
    kind = "vec_id long, embedding array<double>"
    two = spark.createDataFrame([(0, [1e5, 2e5]), (1, [1e6, -1e6])], kind)
    assert {tuple(r) for r in top_k(two, two, 5).collect()} == plain_top([(0, [1e5, 2e5]), (1, [1e6, -1e6])], [(0, [1e5, 2e5]), (1, [1e6, -1e6])], 5)
    one = two.where("vec_id = 0")
    none = two.limit(0)
    assert top_k(one, one, 5).count() == top_k(none, none, 5).count() == top_k(none, one, 5).count() == top_k(one, none, 5).count() == 0
    assert top_k(two, one, 5).count() == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 0, 1, -1, 300, -70_000, 3_000_000_000]), min_size=4, max_size=4), min_size=1, max_size=30), st.integers(1, 6))
def test_blocks_of_any_weights(rows, k):
    ids = np.arange(len(rows), dtype=np.int64)[::-1] * 3
    raw = Block.pack(ids, np.full(len(rows), 4), np.array(rows, np.int64).ravel())
    block = Block.read(*(raw[n] for n in ("ids", "kind", "ends", "places", "weights", "peak")))
    for query, found, score in best_of(block, block, k):
        w = rows[ids.tolist().index(query)]
        want = sorted((-sum(a * b for a, b in zip(w, x)), i) for i, x in zip(ids.tolist(), rows) if i != query)[:k]
        assert sorted((-int(s), int(i)) for s, i in zip(score, found)) == want
