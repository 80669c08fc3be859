"""Operators 10, 5 and 3 against plain versions."""

from __future__ import annotations

import re

import numpy as np
import pytest

from hearth.llm.components import components
from hearth.llm.common import Scratch
from hearth.llm.decontaminate import contained_items, drop_contaminated
from hearth.llm.ngram_join import link_block, ngram_components, one_per_group
from hearth.llm.substring_dedup import dedup_passages
from tests.llm.conftest import odd_rows, prose


def words(text, lower=False):
    text = text or ""
    if lower:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall("[^\x20\x09-\x0d]+", text)


def shingles(text, k=5):
    w = words(text, True)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def plain_components(rows):
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and None not in (rows[i][0], rows[j][0]) and 100 * common >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((key, len(sets[i]), None if key is None else key if not sets[i] else min(group)))
    return out


def by_text(rows):
    return sorted(rows, key=str)


def test_components_match_plain_version(odd):
    got = [tuple(r) for r in ngram_components(odd).collect()]
    assert by_text(got) == by_text(plain_components(odd_rows()))


@pytest.mark.parametrize("block_bytes", [400, 32 << 20])
def test_many_near_copies_in_small_blocks(spark, block_bytes):
    """A large group of near copies, dealt into chunks, with texts that only some of them join."""
    rng, rows = np.random.default_rng(3), []
    base = prose(9, 100).split()
    for i in range(60):
        copy = list(base)
        for at in rng.choice(100, rng.integers(0, 6), replace=False):
            copy[at] = f"edit{i}x{at}"
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, prose(20 + i, 50)) for i in range(10)]
    got = ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=block_bytes).collect()
    assert by_text([tuple(r) for r in got]) == by_text(plain_components(rows))


def test_short_near_copies(spark):
    """Pairs of 7 to 15 words that differ in one, with few shared n-grams that may all lie
    outside the first fragment."""
    rng, rows = np.random.default_rng(5), []
    for i in range(300):
        base = [f"w{i}x{j}" for j in range(7 + i % 9)]
        other = base + ["more"] if i % 3 == 0 else ["more"] + base if i % 3 == 1 else list(base)
        if i % 3 == 2:
            other[rng.choice([0, 1, -2, -1])] = "changed"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_components(rows)
    assert len({c for *_, c in want}) < 500
    assert by_text([tuple(r) for r in ngram_components(docs).collect()]) == by_text(want)
    assert sorted(r.doc_id for r in one_per_group(docs).collect()) == sorted({c for *_, c in want})


def test_empty_tables(empty):
    assert ngram_components(empty).collect() == []
    assert one_per_group(empty).collect() == []
    assert dedup_passages(empty).collect() == []


def test_one_row_of_each_group_stays(odd):
    kept = one_per_group(odd)
    assert kept.columns == odd.columns
    keys = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    # 2, 3 follow 1; 9 follows 8; equal rows of 11 are one; the null key and wordless texts stay
    assert [k for null, k in keys if not null] == [1, 4, 5, 6, 7, 8, 10, 11, 11, 12, 13, 14, 15]
    assert sum(null for null, _ in keys) == 1


def test_link_block_counts_whole_sets():
    a, b, c = (np.arange(lo, lo + 8, dtype=np.uint64) for lo in (0, 1, 100))
    assert link_block(np.array([5, 6, 7]), [a, b, c], 75) == [(6, 5)]
    assert link_block(np.array([5, 6, 7]), [a, b, c], 78) == []
    assert link_block(np.array([5, 6, 7]), [a, b, c], 75, np.array([False, False, True])) == []


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(91, 90)], "a long, b long")
    labels = {r.node: r.label for r in components(edges, Scratch(spark)).collect()}
    assert labels == {**{i: 0 for i in range(41)}, 90: 90, 91: 90}


def plain_dedup(rows, window=50):
    first = {}
    for key, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            if key is not None:
                first[tuple(w[i:i + window])] = min(key, first.get(tuple(w[i:i + window]), key))
    out = []
    for key, text in rows:
        w = words(text)
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if key is not None and first[tuple(w[i:i + window])] < key:
                keep[i:i + window] = [False] * window
        kept = [x for x, k in zip(w, keep) if k]
        out.append((key, len(w), len(w) - len(kept), " ".join(kept)))
    return out


def test_passages_match_plain_version(odd):
    got = [tuple(r) for r in dedup_passages(odd).collect()]
    assert by_text(got) == by_text(plain_dedup(odd_rows()))


def test_runs_periods_and_edges_of_passages(spark):
    """Passages of 49, 50 and 51 words, runs of one word, periodic texts, repeats within a text."""
    p = prose(40, 51).split()
    rows = [(1, " ".join(p)), (2, "q " + " ".join(p[:49]) + " z"), (3, "q " + " ".join(p[:50]) + " z"), (4, " ".join(["u"] * 3 + p)),
            (5, "la " * 70), (6, "x " + "la " * 60 + "y"), (7, "do re " * 40), (8, "re do " * 40), (9, "a b c " * 30 + "la " * 49),
            (10, " ".join(p) + " mid " + " ".join(p)), (11, prose(41, 60) + " " + prose(41, 60)), (12, "la " * 45 + " ".join(p[:30])),
            (13, "k " + "la " * 45 + " ".join(p[:30]))]
    got = dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert by_text([tuple(r) for r in got]) == by_text(plain_dedup(rows))


def plain_contained(docs, items):
    def norm(text):
        return shingles(re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]", " ", text or ""))

    out = []
    for d, text in docs:
        have = norm(text)
        for i, item in items:
            want = norm(item)
            if want and len(want & have) >= 0.75 * len(want):
                out.append((d, i, len(want & have), len(want)))
    return out


@pytest.fixture(scope="module")
def items(spark):
    some = prose(2, 80).split()
    rows = [(1, " ".join(some[5:40])), (2, " ".join(some[10:45]).title() + "!!"), (3, "two words"), (4, None), (5, ""), (6, prose(77, 40)),
            (7, " ".join(some[20:27])), (8, " ".join(some[:30] + prose(78, 6).split())), (1, " ".join(some[5:40])), (9, prose(1, 120))]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block_bytes", [600, 8 << 20])
def test_contained_items_match_plain_version(odd, items, block_bytes):
    got = [tuple(r)[:4] for r in contained_items(odd, items[1], block_bytes=block_bytes).collect()]
    assert by_text(got) == by_text(plain_contained(odd_rows(), items[0]))


def test_contaminated_rows_go(odd, items, empty):
    kept = drop_contaminated(odd, items[1])
    bad = {k for k, *_ in plain_contained(odd_rows(), items[0])}
    assert kept.columns == odd.columns
    assert by_text([r.doc_id for r in kept.collect()]) == by_text([k for k, _ in odd_rows() if k not in bad])
    assert drop_contaminated(odd, items[1].limit(0)).count() == odd.count()
    assert contained_items(odd, items[1].limit(0)).collect() == contained_items(empty, items[1]).collect() == []
