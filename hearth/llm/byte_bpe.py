"""Operator 7: byte-level BPE from a rank file: encoding, offsets and decoding.

The rank file (base64 token, rank) becomes a model of the tokenizers library: bytes are
written as printable characters by the usual byte table, every pair of entries whose
concatenation is an entry is a merge with the priority of that entry's rank, and a match
that is an entry as a whole is taken whole.  Ids travel as little-endian unsigned 32-bit
binaries, four bytes a token.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hearth.llm.common import byte_slices, narrow, tidied
from hearth.llm.units import SLICE_BYTES, UnitCache, bundles, units


#: Units whose ids a worker keeps, in each of two generations.
KEPT_UNITS = 200_000


def byte_chars() -> list[str]:
    """The character that stands for each byte: printable Latin-1 as itself, the rest in
    order from code point 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


@functools.lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def build(path: str, pattern: str):
    """The tokenizers model of a rank file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, chars = read_ranks(path), byte_chars()
    spell = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = [(spell[t[:i]], spell[t[i:]]) for t in sorted(ranks, key=ranks.__getitem__)
              for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    tok = Tokenizer(models.BPE({spell[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
    tok.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tok


@functools.lru_cache(maxsize=2)
def _caches(path: str, pattern: str) -> tuple[UnitCache, UnitCache]:
    tok = build(path, pattern)
    size = _spelling(path)[2]

    def first(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

    def later(texts: list[str]) -> list[bytes]:
        """Units with their spaces, joined; the lengths of the tokens show where each ends."""
        ranges, out = bundles(texts), []
        joined = ["".join(" " + t for t in texts[lo:hi]) for lo, hi in ranges]
        for (lo, hi), e in zip(ranges, tok.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends = np.cumsum([len(t.encode()) + 1 for t in texts[lo:hi]])
            at = np.searchsorted(np.cumsum(size[ids]), ends) + 1
            raw = ids.tobytes()
            out += [raw[4 * a:4 * b] for a, b in zip([0, *at[:-1].tolist()], at.tolist())]
        return out

    # A later unit may be joined to the next only if a cut between them is safe.
    def safely(texts: list[str]) -> list[bytes]:
        odd = {t for t in texts if not t or t != t.strip()}
        known = dict(zip(odd, first([" " + t for t in odd]))) | dict(zip(even := [t for t in texts if t not in odd], later(even)))
        return [known[t] for t in texts]

    return UnitCache(first, KEPT_UNITS), UnitCache(safely, KEPT_UNITS)


@functools.lru_cache(maxsize=2)
def _spelling(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all entries in a row, and each id's start and length there, read back from
    the characters by the reversed byte table."""
    ranks, back = read_ranks(path), {c: b for b, c in enumerate(byte_chars())}
    chars = byte_chars()
    start, size = np.zeros(max(ranks.values()) + 1, np.int64), np.zeros(max(ranks.values()) + 1, np.int64)
    flat = bytearray()
    for token, i in ranks.items():
        start[i], size[i] = len(flat), len(token)
        flat += bytes(back[c] for c in "".join(chars[b] for b in token))
    return np.frombuffer(bytes(flat), np.uint8), start, size


def token_bytes(ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a sequence of ids and the length of each token's."""
    flat, start, size = _spelling(path)
    lens = size[ids]
    ends = np.cumsum(lens)
    return flat[np.repeat(start[ids] - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)], lens


def char_offsets(ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Code point span (start, end) of each token in the decoded text.  A token that holds
    part of a character spans the whole character, as do the tokens with its other parts."""
    data, lens = token_bytes(ids, path)
    ends = np.cumsum(lens)
    # characters started up to and with each byte
    begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return np.maximum(begun[ends - lens + 1] - 1, 0), begun[ends]


def digest(data: bytes | memoryview) -> str:
    return hashlib.sha256(data).hexdigest()


def _decoded(ids: pa.Array, ranks: str) -> pa.Array:
    """The bytes that each binary of ids stands for; none for a null."""
    raw = [x or b"" for x in ids.to_pylist()]
    lens = np.array([len(x) // 4 for x in raw], np.int64)
    data, size = token_bytes(np.frombuffer(b"".join(raw), "<u4"), ranks)
    ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(lens)])]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lens), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def encode(docs: DataFrame, ranks: str, pattern: str, ids: bool = True, offsets: bool = False, hashes: bool = False,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` and what is asked for: ``ids``; ``starts, ends``, code point spans; and
    ``ids_sha256, decoded_sha256``, digests of the ids and of the bytes they decode to (both made where
    the ids are, so neither travels for that).

    Each match of ``pattern`` is encoded on its own, without special tokens; strings that
    look like them are ordinary text.  Null and empty texts have no ids; repeated rows and
    null keys are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, later = _caches(ranks, pattern)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                cut = [units(t or "") for t in part.column(1).to_pylist()]
                first = head.holding({u[0] for u in cut})
                known = later.holding(set().union(*(u[1:] for u in cut)))
                raw = [first[u[0]] + b"".join(map(known.__getitem__, u[1:])) for u in cut]
                out = {"doc_id": part.column(0), "n_tokens": pa.array([len(x) // 4 for x in raw], pa.int64())}
                if ids:
                    out["ids"] = pa.array(raw, pa.binary())
                if offsets:
                    spans = [char_offsets(np.frombuffer(x, "<u4"), ranks) for x in raw]
                    out |= {n: pa.array([s[j] for s in spans], pa.list_(pa.int64())) for j, n in enumerate(("starts", "ends"))}
                if hashes:
                    out["ids_sha256"] = pa.array(map(digest, raw), pa.string())
                    out["decoded_sha256"] = pa.array([digest(token_bytes(np.frombuffer(x, "<u4"), ranks)[0]) for x in raw], pa.string())
                yield pa.record_batch(out)

    def forget() -> None:
        for cache in _caches(ranks, pattern):
            cache.clear()

    return narrow(docs, key, text).mapInArrow(
        tidied(run, forget), "doc_id long, n_tokens long" + ", ids binary" * ids + ", starts array<long>, ends array<long>" * offsets
        + ", ids_sha256 string, decoded_sha256 string" * hashes)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """The input of ``doc_id, n_tokens, ids`` with ``decoded``, the bytes of the ids.  Characters
    that tokens split are whole again once their tokens stand in a row; ids of a cut-off
    sequence may end within one, so the result is binary.  Null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "ids", SLICE_BYTES):
                yield pa.record_batch({"doc_id": part.column(0), "n_tokens": part.column(1), "ids": part.column(2),
                                       "decoded": _decoded(part.column(2), ranks)})

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        tidied(run), "doc_id long, n_tokens long, ids binary, decoded binary")


def digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row."""
    return encode(docs, ranks, pattern, ids=False, hashes=True)
