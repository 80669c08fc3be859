"""Operator 8: token-id files with a minimal perfect hash index of document keys.

A shard is a range of keys in ascending order, in two files:

* ``shard-N.ids``: the ids of its documents in a row, each document's followed by the end
  id, as little-endian unsigned integers of 2 or 4 bytes, by the size of the vocabulary.
* ``shard-N.idx``: a JSON line that names the arrays that follow it.  ``bits`` and ``ranks``
  are the levels of the minimal perfect hash, ``prints`` a 32-bit fingerprint of each
  slot's key, ``first`` and ``many`` the slot's records (several for a repeated key), and
  ``at`` the position of each record's first id.

A lookup hashes the key to its slot, compares the fingerprint and reads one stretch of
the payload.  An attempt of a task writes to a name of its own and returns that name once both
files are whole, so a lost or doubled attempt leaves files that no list names, and nothing
that is listed is ever renamed or deleted.

Texts become ids before anything is shuffled: a row is two or four bytes a token when it moves.
"""

from __future__ import annotations

import functools
import json
import os
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.byte_bpe import byte_chars
from hearth.llm.common import byte_slices, narrow, tidied, Scratch
from hearth.llm.units import SLICE_BYTES, UnitCache, units
from hearth.llm.wordhash import mix

_U = np.uint64
#: Stands for a null key, as the smallest number.
NULL_KEY = -(1 << 63)
LEVEL_LOAD = 2.0
READ_BYTES = 8 << 20
#: Matches whose ids a worker keeps, in each of two generations.
KEPT_MATCHES = 250_000


class PerfectHash:
    """key -> slot in 0..n-1, one slot a key.  Level after level, keys that are alone in
    their cell of a bit array set it; the others go on to the next, smaller array.  A key's
    slot is the number of set bits before its own."""

    def __init__(self, bits: list[np.ndarray]) -> None:
        self.bits = bits
        self.base = np.concatenate([[0], np.cumsum([int(np.unpackbits(b).sum()) for b in bits])]).astype(np.int64)
        self.before = [np.concatenate([[0], np.cumsum(np.unpackbits(b, bitorder="little"))]) for b in bits]

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        left, bits = mix(keys.view(_U)), []
        while len(left):
            size = max(64, int(len(left) * LEVEL_LOAD) + 7) // 8 * 8
            cell = cls._cell(left, len(bits), size)
            alone = np.bincount(cell, minlength=size) == 1
            bits.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[cell]]
        return cls(bits)

    @staticmethod
    def _cell(hashed: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(hashed + _U((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % _U(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for some keys that were not built in (the others get the
        slot of another key, whose fingerprint tells)."""
        hashed, out = mix(keys.view(_U)), np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, before in enumerate(self.before):
            cell = self._cell(hashed[todo], level, len(before) - 1)
            hit = before[cell + 1] > before[cell]
            out[todo[hit]] = self.base[level] + before[cell[hit]]
            todo = todo[~hit]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.view(_U) ^ _U(0x5851F42D4C957F2D)) >> _U(32)).astype(np.uint32)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


#: ASCII and Latin letters up to U+017F but the one whose lower case is two characters: all of them are
#: letters to any version of Unicode, and lower case changes them one by one.
_LATIN = "a-zß-öø-įıĳ-ž"
_PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7eÀ-ÖØ-öø-įı-ž]*")


def plain_matches(spec: dict) -> re.Pattern | None:
    """The splitting pattern of a tokenizers file for lower-cased text of ``_PLAIN`` characters, if that
    is all that the file does to it before its model: composing, single spaces, lower case, and
    matches that are encoded each on its own."""
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    first, *rest = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    regular = first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed" and len(rest) == 1 and \
        rest[0]["type"] == "ByteLevel" and not rest[0].get("use_regex") and not rest[0].get("add_prefix_space")
    if not regular or spec["model"]["type"] != "BPE" or [n["type"] for n in steps] != ["NFC", "Replace", "Lowercase"] \
            or (steps[1]["pattern"].get("Regex"), steps[1]["content"]) != (r"\s+", " "):
        return None
    pattern = first["pattern"].get("Regex") or ""
    if re.search(r"\\", re.sub(r"\[[^\]]*\]", "", pattern)) or re.search(r"\\(?!p\{[LN]\}|s)", pattern):
        return None                                         # other classes, or classes outside of brackets
    for name, members in ((r"\p{L}", _LATIN), (r"\p{N}", "0-9"), (r"\s", r"\t\n\r\x20")):
        pattern = pattern.replace(name, members)
    return re.compile(pattern)


class Encoder:
    """Raw ids of whole texts by a tokenizers file that drops white space.

    Texts of plain characters are cut into the matches of the file's own pattern, and its model is asked for
    each new match once; the others go by units to the library as a whole."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        from hearth.llm.token_counts import cuts_at_spaces

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.kind = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.words = [t["content"] for t in spec.get("added_tokens") or ()]
        self.matches = plain_matches(spec)
        self.cuts = cuts_at_spaces(spec) and (spec["pre_tokenizer"].get("pretokenizers") or [{}])[0].get("behavior") == "Removed"
        self.units, self.parts = UnitCache(self._whole), UnitCache(self._modelled, KEPT_MATCHES)

    def _raw(self, ids: list[list[int]]) -> list[bytes]:
        flat = np.array([i for x in ids for i in x], self.kind).tobytes()
        ends = np.cumsum([0, *map(len, ids)]) * self.kind.itemsize
        return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return self._raw([e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)])

    def _modelled(self, matches: list[str]) -> list[bytes]:
        """Ids of matches, written by the usual byte table, from the model alone."""
        chars, tokenize = byte_chars(), self.tok.model.tokenize
        return self._raw([[t.id for t in tokenize(m if m.isascii() else "".join(chars[b] for b in m.encode()))] for m in matches])

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [bool(self.matches) and not any(w in t for w in self.words) and _PLAIN.fullmatch(t) is not None for t in texts]
        cut = [self.matches.findall(t.lower()) if p else units(t) if self.cuts else [t] for t, p in zip(texts, plain)]
        known = self.parts.holding(set().union(*(c for c, p in zip(cut, plain) if p)))
        other = self.units.holding(set().union(*(c for c, p in zip(cut, plain) if not p)))
        return [b"".join(map((known if p else other).__getitem__, c)) for c, p in zip(cut, plain)]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, tokenizer: str, end_id: int, bounds: np.ndarray) -> DataFrame:
    """``shard, doc_id, ids`` of each row of ``docs(doc_id, text)``: how many of the ascending ``bounds`` are
    below its key, and its raw ids with the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(tokenizer)
        end = np.array([end_id], made.kind).tobytes()
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                ids = [x + end for x in made.encode([t or "" for t in part.column(1).to_pylist()])]
                yield pa.record_batch({"shard": pa.array(np.searchsorted(bounds, part.column(0).to_numpy()), pa.int32()),
                                       "doc_id": part.column(0), "ids": pa.array(ids, pa.binary())})

    return docs.mapInArrow(tidied(run, lambda: encoder(tokenizer).units.clear()), "shard int, doc_id long, ids binary")


def write_shard(batches: Iterator[pa.RecordBatch], folder: str, shard: int, kind: np.dtype) -> Iterator[pa.RecordBatch]:
    """Writes the rows ``doc_id, ids``, in order of key, as one shard, and then gives its line of the list."""
    name, out = f"shard-{shard}-{uuid.uuid4().hex}", None
    keys, sizes = [], []
    for batch in batches:
        if out is None:
            files, at = _open(folder)
            files.create_dir(at, recursive=True)
            out = files.open_output_stream(f"{at}/{name}.ids")
        ids = batch.column(1).cast(pa.binary())
        ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1]
        out.write(ids.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])))
        keys.append(batch.column(0).to_numpy())
        sizes.append(np.diff(ends).astype(np.int64) // kind.itemsize)
    if out is None:
        return
    out.close()
    every, size = np.concatenate(keys), np.concatenate(sizes)
    unique, first, many = np.unique(every, return_index=True, return_counts=True)
    mph = PerfectHash.build(unique)
    slot = np.argsort(mph.slots(unique))
    arrays = {**{f"bits{i}": b for i, b in enumerate(mph.bits)}, "prints": fingerprints(unique[slot]),
              "first": first[slot].astype(np.int64), "many": many[slot].astype(np.int64),
              "at": np.concatenate([[0], np.cumsum(size)]).astype(np.int64)}
    head = {"width": kind.itemsize, "arrays": [[n, a.dtype.str, len(a)] for n, a in arrays.items()]}
    with files.open_output_stream(f"{at}/{name}.idx") as index:
        index.write(json.dumps(head).encode() + b"\n" + b"".join(a.tobytes() for a in arrays.values()))
    yield pa.record_batch({"shard": [shard], "name": [name], "docs": [len(every)], "ids": [int(size.sum())],
                           "lowest": [int(every[0])], "highest": [int(every[-1])]})


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end_id: int, scratch: Scratch,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the shards of all rows under ``folder`` and returns their list:
    ``shard, name, docs, ids, lowest, highest``, one row each.

    Rows are in ascending order of key (null first), rows of one key in that of their
    raw ids.  Null and empty texts are the end id alone.  An empty table has no shard.
    """
    rows = narrow(docs, key, text).select(F.coalesce("doc_id", F.lit(NULL_KEY)).alias("doc_id"), "text")
    # the ranges come from the keys alone, so that texts are read and encoded once
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / count for i in range(1, count)] or [1.0]).alias("cuts")).first()["cuts"]
    bounds, kind = np.unique(np.array(cuts or [], np.int64)), encoder(tokenizer).kind
    run: Callable = lambda batches: write_shard(batches, folder, TaskContext.get().partitionId(), kind)
    spread = encode(rows, tokenizer, end_id, bounds).repartitionById(len(bounds) + 1, "shard").sortWithinPartitions("doc_id", "ids")
    return scratch.write(spread.drop("shard").mapInArrow(
        tidied(run), "shard long, name string, docs long, ids long, lowest long, highest long")).df


class Shard:
    """One shard, opened for lookups."""

    def __init__(self, folder: str, name: str) -> None:
        self.files, at = _open(folder)
        raw = self.files.open_input_stream(f"{at}/{name}.idx").read()
        line, _, body = raw.partition(b"\n")
        head, pos, self.arrays = json.loads(line), 0, {}
        for array, kind, n in head["arrays"]:
            self.arrays[array] = np.frombuffer(body, kind, n, pos)
            pos += np.dtype(kind).itemsize * n
        self.kind = np.dtype(f"<u{head['width']}")
        self.mph = PerfectHash([a for n, a in self.arrays.items() if n.startswith("bits")])
        self.payload = self.files.open_input_file(f"{at}/{name}.ids")

    def records(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``keys``, record) for each record of the keys the shard holds."""
        slot = self.mph.slots(keys)
        ok = np.flatnonzero(slot >= 0)
        ok = ok[self.arrays["prints"][slot[ok]] == fingerprints(keys[ok])]
        many = self.arrays["many"][slot[ok]]
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(ok, many), np.repeat(self.arrays["first"][slot[ok]], many) + step

    def read(self, records: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """(positions in ``records``, their ids), in stretches of the payload of about READ_BYTES."""
        start, stop = self.arrays["at"][records], self.arrays["at"][records + 1]
        order, size, lo = np.argsort(start, kind="stable"), self.kind.itemsize, 0
        while lo < len(order):
            a = start[order[lo]]
            hi = max(lo + 1, int(np.searchsorted(start[order], a + READ_BYTES // size)))
            some = order[lo:hi]
            data = np.frombuffer(self.payload.read_at(int(stop[some].max() - a) * size, int(a) * size), self.kind)
            yield some, [data[s - a:e - a] for s, e in zip(start[some], stop[some])]
            lo = hi


def read_documents(keys: DataFrame, folder: str, shards: DataFrame, ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if asked, ``ids`` of the records of the
    given keys (``doc_id``); keys that no shard holds give no row.  ``start`` counts the ids of
    all records before.  A task handles the keys of whole shards."""
    listed = sorted(shards.collect(), key=lambda r: r.shard)      # one row a shard
    highest = np.array([r.highest for r in listed], np.int64)
    number, name = [r.shard for r in listed], {r.shard: r.name for r in listed}
    before = dict(zip(number, np.concatenate([[0], np.cumsum([r.ids for r in listed])]).tolist()))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(highest, batch.column(0).to_numpy())
            known = at < len(highest)
            yield pa.record_batch({"shard": pa.array(np.array(number, np.int64)[at[known]]), "doc_id": batch.column(0).filter(pa.array(known))})

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[int, Shard] = {}
        for batch in batches:
            where, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for n in np.unique(where).tolist():
                if n not in opened:
                    opened = {n: Shard(folder, name[n])}
                own = key[where == n]
                pos, rec = opened[n].records(own)
                start = opened[n].arrays["at"]
                for some, found in opened[n].read(rec):
                    raw = [x.astype("<u4").tobytes() for x in found]
                    out = {"doc_id": pa.array(own[pos[some]]), "start": pa.array(start[rec[some]] + before[n]),
                           "n_tokens": pa.array([len(x) for x in found], pa.int64()),
                           "ids_crc32": pa.array([zlib.crc32(x) for x in raw], pa.int64())}
                    yield pa.record_batch(out | ({"ids": pa.array(raw, pa.binary())} if ids else {}))

    keys = keys.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)).alias("doc_id")).distinct()
    if not listed:
        keys = keys.where("false")
    found = (keys.mapInArrow(tidied(route), "shard long, doc_id long").repartition("shard").sortWithinPartitions("shard", "doc_id")
             .mapInArrow(tidied(look), "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids))
    return found.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(NULL_KEY), F.col("doc_id")))


def digests(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Writes all rows and reads them back by key: ``doc_id, start, n_tokens, ids_crc32``."""
    scratch = Scratch(docs.sparkSession)
    folder = scratch.path()
    shards = write_shards(docs, tokenizer, folder, end_id, scratch)
    return read_documents(docs.select("doc_id"), folder, shards, ids=False)
