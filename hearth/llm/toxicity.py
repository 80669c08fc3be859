"""Operator 6: toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts (P) and texts whose label isn't looked at (U) train a sparse linear
classifier in numpy.  With the class prior p of U, the risk is

    p * R_P(+1) + max(0, R_U(-1) - p * R_P(-1))

for the logistic loss; where the second term turns negative, the step climbs it instead,
so that the classifier can't gain from fitting U as all negative.  Features are the presence
of words and of the first 3 to 8 bytes of words, hashed to 2^18 cells.

P and U are bounded samples of labelled rows, taken by a hash of their key (at most
``max_positive`` and ``max_unlabelled``); the class prior counts all labelled rows, and every
whole text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import narrow, reach_workers, tidied
from hearth.llm.wordhash import Words, chunks, separators

CELLS = 1 << 18
PREFIXES = (3, 4, 5, 6, 7, 8)
MAX_POSITIVE = 3_000
MAX_UNLABELLED = 6_000
#: Features kept for training: those whose shares in P and U differ by so many standard
#: errors, at most so many, the surest first.
SURE = 3.0
FEATURES = 4_096
STEPS = 300
RATE = 0.05
DECAY = 2e-4
_U = np.uint64


def cells(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, cell) of each kind of feature."""
    yield np.arange(len(words.name)), (words.name % _U(CELLS)).astype(np.int64)
    for size in PREFIXES:
        at, name = words.prefixes(size)
        yield at, (name % _U(CELLS)).astype(np.int64)


@dataclass
class Classifier:
    """Weights by cell (0 for most) and the intercept."""

    weight: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = []
        for _, words in chunks(texts, True, separators(True)):
            n = len(words.bounds) - 1
            doc, pairs = np.repeat(np.arange(n), np.diff(words.bounds)), []
            for at, cell in cells(words):
                used = np.flatnonzero(self.weight[cell])
                pairs.append(doc[at[used]] * CELLS + cell[used])
            found = np.unique(np.concatenate(pairs))
            z = np.bincount(found // CELLS, weights=self.weight[found % CELLS], minlength=n) + self.bias
            out.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
        return np.concatenate(out) if out else np.empty(0)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct cells of each sampled text."""
    for batch in batches:
        sets: list[bytes] = []
        for _, words in chunks(batch.column(1), True, separators(True)):
            n = len(words.bounds) - 1
            doc = np.repeat(np.arange(n), np.diff(words.bounds))
            found = np.unique(np.concatenate([doc[at] * CELLS + cell for at, cell in cells(words)]))
            ends = np.searchsorted(found, np.arange(n + 1) * CELLS)
            sets += [(found[a:b] % CELLS).astype("<u4").tobytes() for a, b in zip(ends[:-1], ends[1:])]
        yield pa.record_batch({"positive": batch.column(0), "cells": pa.array(sets, pa.binary())})


def fit_pu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
           steps: int = STEPS, rate: float = RATE, decay: float = DECAY, features: int = FEATURES, least: float = SURE) -> Classifier:
    """Fits the classifier to sets of cells.  Without positive or unlabelled sets it gives the
    prior to every text."""
    weight = np.zeros(CELLS)
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    start = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return Classifier(weight, start)
    hits = [np.bincount(np.concatenate(x), minlength=CELLS) for x in (positive, unlabelled)]
    share = [(h + 0.5) / (len(x) + 1) for h, x in zip(hits, (positive, unlabelled))]
    spread = np.sqrt(share[0] * (1 - share[0]) / len(positive) + share[1] * (1 - share[1]) / len(unlabelled))
    sure = np.abs(share[0] - share[1]) / spread
    sure[hits[0] + hits[1] < 3] = 0
    chosen = np.argsort(-sure, kind="stable")[:features]
    chosen = np.sort(chosen[sure[chosen] >= least])
    slot = np.full(CELLS, -1)
    slot[chosen] = np.arange(len(chosen))

    def rows(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        col = slot[np.concatenate(sets)]
        return of[col >= 0], col[col >= 0], len(sets)

    data = rows(positive), rows(unlabelled)
    w, b, m, v = np.zeros(len(chosen)), start, np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, steps + 1):
        z = [np.bincount(r, weights=w[c], minlength=n) + b for r, c, n in data]
        s = [1 / (1 + np.exp(-np.clip(x, -500, 500))) for x in z]

        def slope(i: int, per_row: np.ndarray) -> np.ndarray:
            r, c, n = data[i]
            return np.append(np.bincount(c, weights=per_row[r], minlength=len(w)), per_row.sum()) / n

        below = np.logaddexp(0, z[1]).mean() - prior * np.logaddexp(0, z[0]).mean()
        negative = slope(1, s[1]) - prior * slope(0, s[0])
        grad = prior * slope(0, s[0] - 1) + negative if below >= 0 else -negative
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - rate * decay * 10, 0)
    weight[chosen] = w
    return Classifier(weight, float(b))


def train(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Classifier:
    """A classifier from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``; a key with several
    labels counts as toxic if one says so, null labels and keys don't count."""
    known = (labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg((F.max("toxic") > 0).alias("toxic")))
    prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    by = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = (known.where("toxic").orderBy(*by).limit(max_positive).select("doc_id", F.lit(True).alias("positive"))
              .union(known.orderBy(*by).limit(max_unlabelled).select("doc_id", F.lit(False).alias("positive"))))
    # at most max_positive + max_unlabelled rows of two small columns
    rows = docs.join(F.broadcast(sample), "doc_id").select("positive", "text").mapInArrow(tidied(_sets), "positive boolean, cells binary").collect()
    sets = {flag: [np.frombuffer(r.cells, "<u4") for r in rows if r.positive == flag] for flag in (True, False)}
    return fit_pu(sets[True], sets[False], prior)


def _crc_fold(key: str) -> F.Column:
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(5))


def toxicity(docs: DataFrame, labels: DataFrame, **sizes: int) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``.

    Labels of held-out keys (crc32 of the key's text, modulo 5, is 0) aren't learnt from.  Null
    and empty texts get the score of a text without words; a null key is not held out.
    """
    docs = narrow(docs)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels.where(_crc_fold("doc_id") != 0), **sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"doc_id": batch.column(0), "score": pa.array(model.value.scores(batch.column(1)))})

    return docs.mapInArrow(tidied(run), "doc_id long, score double").select(
        "doc_id", F.coalesce(_crc_fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5, **sizes: int) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score under ``limit``."""
    reach_workers(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(narrow(docs), labels.where(_crc_fold("doc_id") != 0), **sizes))
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.value.scores(batch.column(text)) < limit))

    return docs.mapInArrow(tidied(run), docs.schema)
