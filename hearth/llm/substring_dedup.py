"""Operator 5: removal of repeated passages of at least ``window`` words, by recompression.

*Parse.*  Every word gets its global 64-bit name.  A round splits all names into a left
and a right half by a hash of the name and round, and replaces each neighbouring pair
(left, right) by the name of the pair, the same in every text and task.  Neighbours that
are equal, as in runs, lie on one side and stay.  After three rounds a symbol covers at
most eight words, and a passage's symbols are the same wherever it stands, but for seven
words at either end (1 + 2 + 4: a round can lose one symbol there).

*Reveal.*  Each window of 50 words takes the smallest symbol that starts in its interior
and ends there (the first of several), which depends on the window's words only.  Windows
in a row that take the same symbol form a segment, one row.  It is named by the symbol with
the words beside it that all windows around it have (22 words in all), and by all its words.
A symbol so named that only one document has reveals no repeat and is dropped.

*Verify.*  Equal segments are one class; documents after the class's first have all its
windows removed.  Of each class only the first document's windows are compared, by the
name of their 50 words, with those of other classes of the symbol.

All groupings pre-aggregate minima, so a passage that a third of all rows share is no
large group; nothing is capped or sampled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import byte_slices, narrow, tidied, Scratch
from hearth.llm.wordhash import _POWERS, Words, chunks, mix, named_runs, separators

WINDOW = 50
ROUNDS = 3
_U = np.uint64
_NONE = _U(2**64 - 1)
#: Low bits that hold a word's position where symbols are compared.
_PLACE = 28


def symbols(words: Words, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(first word, name) of the symbols after ``rounds`` rounds; none crosses a text's end."""
    at, name = np.arange(len(words.name)), words.name
    head = np.zeros(len(at) + 1, dtype=bool)
    head[words.bounds] = True
    head = head[:-1]
    for r in range(rounds):
        if len(name) < 2:
            break
        right = (mix(name ^ _U(0xA5A5A5A5 + r)) >> _U(63)).astype(bool)
        pair = ~right[:-1] & right[1:] & ~head[1:]
        name = name.copy()
        first = np.flatnonzero(pair)
        name[first] = mix(name[first] * _U(0x9E3779B97F4A7C15) + name[first + 1] * _U(0xC2B2AE3D27D4EB4F) + _U(r + 1))
        keep = np.concatenate([[True], ~pair])
        at, name, head = at[keep], name[keep], head[keep]
    return at, name


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """``out[i] = min(x[i:i + width])``."""
    out, have = x, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def segments(words: Words, window: int, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """(text, first window, number of windows, symbol, name of all words) of each segment."""
    lost, longest = 2**rounds - 1, 2**rounds
    n = len(words.name)
    if n < window:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, _U),) * 2
    at, name = symbols(words, rounds)
    value = np.full(n, _NONE)
    value[at] = mix(name) >> _U(_PLACE) << _U(_PLACE) | at.astype(_U)
    starts = window - 2 * lost - longest + 1
    chosen = _sliding_min(value[lost:], starts)[:n - window + 1]
    around = named_runs(words.name, window - starts + 1)
    doc = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
    valid = np.flatnonzero(doc[:n - window + 1] == doc[window - 1:])
    pick = around[(chosen[valid] & _U((1 << _PLACE) - 1)).astype(np.int64) - lost]
    new = np.ones(len(valid), dtype=bool)
    new[1:] = (pick[1:] != pick[:-1]) | (valid[1:] != valid[:-1] + 1) | (doc[valid[1:]] != doc[valid[:-1]])
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(valid)))
    lo = valid[first]
    up, down = _POWERS.upto(n + 1)
    total = np.concatenate([np.zeros(1, _U), np.cumsum(words.name * up[:n])])
    whole = mix((total[lo + many + window - 1] - total[lo]) * down[lo] + many.astype(_U))
    return doc[lo], lo - words.bounds[doc[lo]], many, pick[first], whole


def _joined(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    kept = np.flatnonzero(keep)
    size = words.end[kept] - words.start[kept] + 1
    ends = np.cumsum(size)
    where = np.repeat(words.start[kept] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
    out = np.append(words.data, np.uint8(32))[where]
    out[ends - 1] = 32
    bounds = np.searchsorted(kept, words.bounds)
    stop = np.concatenate([[0], ends])[bounds]
    offset, pieces, raw = [0], [], out
    for a, b in zip(stop[:-1], stop[1:]):
        pieces.append(raw[a:b - 1] if b > a else raw[:0])
        offset.append(offset[-1] + max(0, int(b - a) - 1))
    flat = np.concatenate(pieces) if pieces else raw[:0]
    return pa.LargeStringArray.from_buffers(len(pieces), pa.py_buffer(np.array(offset, np.int64)), pa.py_buffer(flat)).cast(pa.string())


def repeated_spans(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, row, spans``: word spans (lo, n) of ``docs(doc_id, row, text)`` that windows
    also found in a document with a smaller id cover; ``row`` tells texts of one id apart."""
    scratch = Scratch(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in chunks(batch.column(2), False, separators()):
                doc, lo, many, pick, whole = segments(words, window, rounds)
                at = pa.array(doc + row)
                yield pa.record_batch({
                    "sym": pa.array(pick.view(np.int64)), "seg": pa.array(whole.view(np.int64)),
                    "doc_id": batch.column(0).take(at), "row": batch.column(1).take(at),
                    "lo": pa.array(lo.astype(np.int32)), "n": pa.array(many.astype(np.int32))})

    ids = docs.where("doc_id is not null")
    every = scratch.write(ids.mapInArrow(tidied(find), "sym long, seg long, doc_id long, row long, lo int, n int"))
    shared = every.df.groupBy("sym").agg(F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest")) \
        .where("lowest < highest").select("sym")
    seen = scratch.write(every.df.join(shared, "sym"))
    every.drop()
    classes = scratch.write(seen.df.groupBy("sym", "seg").agg(F.min("doc_id").alias("first")))
    mixed = classes.df.groupBy("sym").count().where("count > 1").select("sym", F.lit(True).alias("mixed"))
    told = seen.df.join(classes.df.join(mixed, "sym", "left"), ["sym", "seg"])
    told = scratch.write(told.where("doc_id > first or mixed").select(
        "doc_id", "row", "lo", "n", (F.col("doc_id") > F.col("first")).alias("whole")))
    seen.drop()
    classes.drop()

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(3).to_pylist()
            for row, words in chunks(batch.column(2), False, separators()):
                name = named_runs(words.name, window)
                for i, b in enumerate(words.bounds[:-1]):
                    own = parts[row + i]
                    pos = np.unique(np.concatenate([np.arange(p["lo"], p["lo"] + p["n"]) for p in own]))
                    n = len(pos)
                    yield pa.record_batch({
                        "w": pa.array(name[b + pos].view(np.int64)), "doc_id": pa.array(np.full(n, batch.column(0)[row + i].as_py())),
                        "row": pa.array(np.full(n, batch.column(1)[row + i].as_py())), "lo": pa.array(pos.astype(np.int32))})

    open_ = told.df.where("not whole").groupBy("doc_id", "row").agg(F.collect_list(F.struct("lo", "n")).alias("parts"))
    windows = scratch.write(ids.join(open_, ["doc_id", "row"]).select("doc_id", "row", "text", "parts")
                            .mapInArrow(tidied(_merged(spell)), "w long, doc_id long, row long, lo int"))
    lowest = windows.df.groupBy("w").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")) \
        .where("first < last").select("w", "first")
    late = windows.df.join(lowest, "w").where("doc_id > first").select("doc_id", "row", "lo", F.lit(1).alias("n"))
    spans = told.df.where("whole").select("doc_id", "row", "lo", "n").union(late)
    spans = spans.select("doc_id", "row", "lo", (F.col("n") + (window - 1)).alias("n"))
    return scratch.write(spans.groupBy("doc_id", "row").agg(F.collect_list(F.struct("lo", "n")).alias("spans"))).df


def _merged(fn, rows: int = 200_000):
    """Joins the small batches that ``fn`` gives into batches of about ``rows`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in fn(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
        if n:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return run


def dedup_passages(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the words of each text that no repeated window
    covers, joined by one space.

    A window is repeated if its words also start in a document with a smaller key; windows
    are judged on the input.  Words are runs of anything but white space, unchanged.  A null
    or blank text has no words; a text under ``window`` words loses none.  Rows with a null
    key neither lose words nor make others lose them; rows of the same key, equal or not,
    don't remove each other's.
    """
    docs = narrow(docs, key, text)
    docs = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
    spans = repeated_spans(docs, window, rounds)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(2).to_pylist()
            for part_lo, words in chunks(batch.column(1), False, separators()):
                size = np.diff(words.bounds)
                keep = np.ones(len(words.name), dtype=bool)
                for i, b in enumerate(words.bounds[:-1]):
                    for p in spans[part_lo + i] or ():
                        keep[b + p["lo"]:b + p["lo"] + p["n"]] = False
                kept = np.concatenate([[0], np.cumsum(keep)])[words.bounds]
                rows = slice(part_lo, part_lo + len(size))
                yield pa.record_batch({
                    "doc_id": batch.column(0)[rows], "n_words": pa.array(size.astype(np.int64)),
                    "n_removed": pa.array(size - np.diff(kept)), "kept": _joined(words, keep)})

    return docs.join(spans, ["doc_id", "row"], "left").select("doc_id", "text", "spans").mapInArrow(
        tidied(cut), "doc_id long, n_words long, n_removed long, kept string")
