"""Operator 3: benchmark items inside long documents, by size-partitioned MinHash containment search.

Items are partitioned by size: an item of L shingles belongs to the class of the next
power of two B >= L.  For each class a document is cut into blocks of B shingles, so that
an item's share of a block doesn't depend on the document's length, and each block is
described by the minima of ``hashes`` hash functions.  An item is a candidate for a
document if it has a minimum in common with one of its blocks (bands of one row).  An item
that a document holds to 0.75 meets a block with a Jaccard similarity of 0.17 at least, so
48 functions miss it with a chance under 1 in 7,000; one held whole, under 1 in a million.
Items of up to 8 shingles are looked up by all of their shingles instead, and miss nothing.

A candidate is verified by exact containment: the share of the item's distinct shingles
that the whole document holds.

Words are lower-cased (A-Z) runs of anything but white space and ASCII punctuation, so
that changed case and added marks don't hide a passage.  Items are indexed in blocks of
``block_bytes`` of text, each broadcast; the documents are read once a block and never
shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import narrow, reach_workers, tidied
from hearth.llm.wordhash import chunks, mix, separators

K = 5
CONTAINED = 0.75
HASHES = 48
#: Up to so many shingles, an item is looked up by each of them.
SHORT = 8
BLOCK_BYTES = 8 << 20
_U = np.uint64


class _Values:
    """A set of (64-bit value, item) pairs with a fast test for most absent values."""

    def __init__(self, value: np.ndarray, item: np.ndarray) -> None:
        order = np.argsort(value, kind="stable")
        self.value, self.item = value[order], item[order]
        self.some = np.zeros(1 << 16, dtype=bool)
        self.some[(self.value & _U(0xFFFF)).astype(np.int64)] = True

    def find(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``asked``, item) of all matches."""
        at = np.flatnonzero(self.some[(asked & _U(0xFFFF)).astype(np.int64)])
        lo = np.searchsorted(self.value, asked[at], "left")
        many = np.searchsorted(self.value, asked[at], "right") - lo
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(at, many), self.item[np.repeat(lo, many) + step]


class ItemIndex:
    """Signatures of a block of items, by size class."""

    def __init__(self, ids: list[int], texts: list[str], k: int, contained: float, hashes: int) -> None:
        self.ids, self.k, self.contained = ids, k, contained
        seeds = mix(np.arange(1, 2 * hashes + 1, dtype=_U))
        self.mul, self.add = seeds[:hashes] | _U(1), seeds[hashes:]
        self.sets: list[np.ndarray] = []
        size: list[int] = []
        for _, words in chunks(pa.array(texts, pa.string()), True, separators(True)):
            names, b = words.shingles(k)
            self.sets += [np.unique(names[b[i]:b[i + 1]]) for i in range(len(b) - 1)]
            size += np.diff(b).tolist()
        self.classes: dict[int, list[_Values]] = {}
        by_class: dict[int, list[int]] = {}
        for i, n in enumerate(size):
            if n:
                by_class.setdefault(0 if n <= SHORT else 1 << (n - 1).bit_length(), []).append(i)
        for block, items in sorted(by_class.items()):
            if block == 0:
                self.classes[0] = [_Values(np.concatenate([self.sets[i] for i in items]),
                                           np.repeat(items, [len(self.sets[i]) for i in items]))]
            else:
                self.classes[block] = [_Values(np.array([(self.sets[i] * m + a).min() for i in items], _U), np.array(items))
                                       for m, a in zip(self.mul, self.add)]

    def search(self, texts: pa.Array) -> list[tuple[int, int, int]]:
        """(row, item, distinct shingles in common) of each item a text holds."""
        out: list[tuple[int, int, int]] = []
        for lo, words in chunks(texts, True, separators(True)):
            names, b = words.shingles(self.k)
            if not len(names):
                continue
            size = np.diff(b)
            pairs: list[np.ndarray] = []

            def note(doc: np.ndarray, item: np.ndarray) -> None:
                if len(doc):
                    pairs.append(np.unique(doc.astype(np.int64) << 32 | item))

            doc_of = np.repeat(np.arange(len(size)), size)
            if 0 in self.classes:
                at, item = self.classes[0][0].find(names)
                note(doc_of[at], item)
            blocks = [c for c in self.classes if c]
            cuts = {}
            for c in blocks:
                n = -(-size // c)
                first = np.repeat(b[:-1], n) + c * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
                cuts[c] = first, doc_of[first]
            for j, (m, a) in enumerate(zip(self.mul, self.add)) if blocks else ():
                value = names * m + a
                for c in blocks:
                    first, doc = cuts[c]
                    at, item = self.classes[c][j].find(np.minimum.reduceat(value, first))
                    note(doc[at], item)
            if pairs:
                found = np.unique(np.concatenate(pairs))
                for doc in np.unique(found >> 32):
                    own = np.unique(names[b[doc]:b[doc + 1]])
                    for item in (found[found >> 32 == doc] & 0xFFFFFFFF).tolist():
                        wanted = self.sets[item]
                        at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
                        shared = int((own[at] == wanted).sum())
                        if shared >= self.contained * len(wanted):
                            out.append((lo + int(doc), item, shared))
        return out


def item_blocks(items: DataFrame, k: int, contained: float, hashes: int, block_bytes: int) -> Iterator[ItemIndex]:
    """Indexes of the items, ``block_bytes`` of text each; the driver holds one block at a time."""
    ids: list[int] = []
    texts: list[str] = []
    size = 0
    for row in items.where("text is not null").toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1].encode()) + 8
        if size >= block_bytes:
            yield ItemIndex(ids, texts, k, contained, hashes)
            ids, texts, size = [], [], 0
    if ids:
        yield ItemIndex(ids, texts, k, contained, hashes)


def contained_items(docs: DataFrame, items: DataFrame, k: int = K, contained: float = CONTAINED, hashes: int = HASHES,
                    block_bytes: int = BLOCK_BYTES, key: str = "doc_id", text: str = "text",
                    item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, n_shared, n_item, containment`` of each document and each item that
    it holds to ``contained`` or more.

    Null and blank texts hold nothing and are held by nothing.  A text of 1 to k - 1 words has
    one shingle, its whole sequence, so such an item is found only in an equal document.
    Repeated rows of either side give a row each; null keys are kept.
    """
    docs = narrow(docs, key, text)
    spark, found = docs.sparkSession, None
    items = items.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    out = "doc_id long, item_id long, n_shared long, n_item long"
    for index in item_blocks(items, k, contained, hashes, block_bytes):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                hits = index.search(batch.column(1))
                yield pa.record_batch({
                    "doc_id": batch.column(0).take(pa.array([h[0] for h in hits], pa.int64())),
                    "item_id": pa.array([index.ids[h[1]] for h in hits], pa.int64()),
                    "n_shared": pa.array([h[2] for h in hits], pa.int64()),
                    "n_item": pa.array([len(index.sets[h[1]]) for h in hits], pa.int64())})

        part = docs.mapInArrow(tidied(run), out)
        found = part if found is None else found.union(part)
    found = spark.createDataFrame([], out) if found is None else found
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def drop_contaminated(docs: DataFrame, items: DataFrame, k: int = K, contained: float = CONTAINED, hashes: int = HASHES,
                      block_bytes: int = BLOCK_BYTES, text: str = "text", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item to ``contained`` or more."""
    spark = docs.sparkSession
    reach_workers(spark)
    rest, at = docs, docs.columns.index(text)
    items = items.select(F.lit(0).alias("item_id"), F.col(item_text).alias("text"))
    for index in item_blocks(items, k, contained, hashes, block_bytes):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[h[0] for h in shared.value.search(batch.column(at))]] = False
                yield batch.filter(pa.array(keep))

        rest = rest.mapInArrow(tidied(run), docs.schema)
    return rest
