"""Texts as units that a tokenizer can treat on their own, and a bounded cache of what it gave.

A text is cut at a space that has a visible character on either side.  The tokenizers
used here never let a token reach over such a cut: it ends one match of the splitting
pattern and starts another, or no vocabulary entry continues past a word's start.  So the
ids of a text are those of its units in order, texts of any length cost memory in
proportion to a slice, and a unit that occurs again isn't encoded again.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import Any

_CUT = re.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
#: Units a worker keeps, in each of two generations.
CACHE_UNITS = 400_000
#: Bytes of text treated together.
SLICE_BYTES = 2 << 20
#: Characters of units given to a library at once.
CALL_CHARS = 1 << 20
#: Characters of the texts that several units are joined to, as one call for each costs more than its work.
JOIN_CHARS = 1 << 13


def units(text: str) -> list[str]:
    """The units of a text without the spaces between them; [""] for an empty text."""
    # Spaces and line ends alone, one at a time and between visible characters: the usual case.  Any other
    # white space could stand for a gap that a surplus space then hides from the count.
    if len(text.split()) == text.count(" ") + text.count("\n") + 1 and not any(c in text for c in _OTHER_SPACE):
        return text.split(" ")
    return _CUT.split(text)


def bundles(texts: list[str], limit: int = JOIN_CHARS) -> list[tuple[int, int]]:
    """Ranges (lo, hi) of consecutive texts of about ``limit`` characters together."""
    out, lo, chars = [], 0, 0
    for i, t in enumerate(texts):
        chars += len(t) + 1
        if chars >= limit:
            out.append((lo, i + 1))
            lo, chars = i + 1, 0
    if lo < len(texts):
        out.append((lo, len(texts)))
    return out


class UnitCache:
    """unit -> value, for whatever ``encode(list of units)`` gives; the units not used
    since the last change of generation are forgotten when one is full."""

    def __init__(self, encode: Callable[[list[str]], list[Any]], size: int = CACHE_UNITS) -> None:
        self.encode, self.size = encode, size
        self.now: dict[str, Any] = {}
        self.before: dict[str, Any] = {}

    def clear(self) -> None:
        self.now, self.before = {}, {}

    def holding(self, wanted: set[str]) -> dict[str, Any]:
        """A dict with at least the wanted units."""
        if len(self.now) > self.size:
            self.before, self.now = self.now, {}
        missing = []
        for u in wanted.difference(self.now):
            if (v := self.before.get(u)) is not None:
                self.now[u] = v
            else:
                missing.append(u)
        lo = 0
        while lo < len(missing):
            hi, chars = lo, 0
            while hi < len(missing) and (hi == lo or chars < CALL_CHARS):
                chars += len(missing[hi]) + 1
                hi += 1
            part = missing[lo:hi]
            self.now.update(zip(part, self.encode(part)))
            lo = hi
        return self.now
