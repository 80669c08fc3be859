"""Operator 1: token counts of whole texts, in Arrow batches that return lengths only.

Batches are sliced by bytes; long texts are cut at single spaces between letters, after the
vocabulary has shown that no entry reaches past one; the library counts the parts and their
lengths are summed.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import byte_slices, narrow, tidied
from hearth.llm.units import SLICE_BYTES

OVER = 4096
#: Longer texts are counted in parts of about so many characters.
SEGMENT_CHARS = 1 << 15
#: A single space between ASCII, Latin, Cyrillic, kana, Han or Hangul letters or digits: characters that no
#: normalisation joins to a space, and never the mark that stands for one.
_PLAIN = "0-9A-Za-zÀ-ÖØ-öø-ʯЀ-ҁҊ-ԯぁ-ゖァ-ヺ一-鿿가-힣"
_SAFE_CUT = re.compile(f"(?<=[{_PLAIN}]) (?=[{_PLAIN}])")


def cuts_at_spaces(spec: dict) -> bool:
    """Whether a tokenizers file starts a new match at a space between visible characters:
    byte-level splitting without an added prefix space, or matches that exclude white space."""
    if any(" " in t["content"] or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens") or ()):
        return False
    pre = spec.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers") or [pre]
    head = steps[0]
    if head.get("type") == "ByteLevel":
        return bool(head.get("use_regex")) and not head.get("add_prefix_space")
    pattern = (head.get("pattern") or {}).get("Regex", "")
    return head.get("type") == "Split" and head.get("invert") and head.get("behavior") == "Removed" and r"[^\s" in pattern \
        and r"\s" not in pattern.replace(r"[^\s", "") and " " not in pattern


@functools.lru_cache(maxsize=4)
def _counter(path: str) -> tuple[Callable[[list[str]], list[int]], str, bool]:
    """What counts the tokens of a list of texts; what stands before a later segment for the space
    it was cut at; whether texts may be cut."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)

        def count(texts: list[str]) -> list[int]:
            return [len(x) for x in sp.encode(texts, num_threads=1)]

        # A later segment gets from the library the prefix that stands for its space; no entry may go on past a space.
        inner = any("▁" in sp.id_to_piece(i).lstrip("▁") for i in range(sp.get_piece_size()))
        return count, "", not inner and count(["a b", " a"]) == [sum(count(["a", "b"])), count(["▁a"])[0]]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    with open(path, encoding="utf-8") as f:
        safe = cuts_at_spaces(json.load(f))
    return lambda texts: [len(e) for e in tok.encode_batch_fast(texts, add_special_tokens=False)], " ", safe


def segments(text: str, limit: int) -> list[str]:
    """The text, or if it is longer than ``limit`` characters its parts of about that length, cut at
    single spaces between plain letters or digits.  A text without such places stays whole."""
    out, lo = [], 0
    while len(text) - lo > limit:
        cut = _SAFE_CUT.search(text, lo + limit - 1)
        if not cut:
            break
        out.append(text[lo:cut.start()])
        lo = cut.end()
    return [*out, text[lo:]]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = OVER, segment_chars: int = SEGMENT_CHARS, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row, in any order.

    ``tokenizer`` is a file of the tokenizers (.json) or sentencepiece (.model) library on
    every worker.  Null and empty texts have 0 bytes and the library's count of an empty
    text; repeated rows are counted each; a null key is kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, space, safe = _counter(tokenizer)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                cut = [segments(t or "", segment_chars) if safe else [t or ""] for t in part.column(1).to_pylist()]
                # short and long segments in one call: the slice bounds their bytes
                counts = np.array(count([(space if i else "") + s for c in cut for i, s in enumerate(c)]), np.int64)
                ends = np.cumsum([len(c) for c in cut])
                total = np.add.reduceat(counts, np.concatenate([[0], ends[:-1]]))
                yield pa.record_batch({"doc_id": part.column(0), "n_bytes": part.column(2), "n_tokens": pa.array(total)})

    return (narrow(docs, key, text).withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
            .mapInArrow(tidied(run), "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
