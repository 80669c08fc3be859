"""Operator 2: personal data, and information-theoretic sanitisation of what reveals it.

Base spans are e-mail addresses, IP addresses, card and phone numbers by fixed patterns.
Each distinct value is a protected entity c.  Over the whole corpus, counted in distinct
texts, a term t (a word near an occurrence of c) reveals it to the degree

    PMI(c; t) / IC(c),  PMI = log2(n(c,t) N / (n(c) n(t))),  IC = log2(N / n(c))

which is 1 if all texts with t have c beside it.  Terms at ``remove_at`` or above are
removed, those at ``generalise_at`` or above replaced by their kind, in every text.
Evidence must be independent: texts of ``least`` different classes, where near copies (by
their whole word n-grams, as operator 10 links them) are one class, so that copies of one
text prove nothing, but a line that different texts share does.

Term tables are broadcast in blocks of counted size; all counts pre-aggregate.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearth.llm.common import BROADCAST_ROWS, free_name, narrow, reach_workers, tidied, Scratch, Written
from hearth.llm.ngram_join import ngram_components
from hearth.llm.wordhash import Words, chunks, separators

KINDS = ("email", "ip", "card", "phone")
ADDED = ("removed", "generalised")
REACH = 8
LEAST = 3
REMOVE_AT = 0.95
GENERALISE_AT = 0.85
_U = np.uint64

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile(r"[0-9]")
# A run of digits that no address starts with is passed over as a whole.
_IP = re.compile(r"[0-9]++(\.[0-9]++\.[0-9]++\.[0-9]++)?+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    out: list[tuple[str, int, int]] = []
    at, last = text.find("@"), 0
    while at >= 0:
        # the local part reaches back to the first character that can't be in one, the
        # last address or the last @
        start = at
        while start > last and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append(("email", start, domain.end()))
            last = domain.end()
        else:
            last = at + 1
        at = text.find("@", max(at + 1, last))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if m[1] and all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


def _entity(kind: str, value: str) -> int:
    """A 64-bit name of a protected value."""
    plain = value.lower() if kind == "email" else value if kind == "ip" else _digits(value)
    for _, words in chunks(pa.array([f"{kind}:{plain}"]), False, np.zeros(256, bool)):
        return int(words.name[0].astype(np.int64))
    raise AssertionError


def _byte_spans(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Byte positions of spans, each stretch of the text encoded once."""
    marks = sorted({p for _, a, b in spans for p in (a, b)})
    at, byte, last = {}, 0, 0
    for p in marks:
        byte += len(text[last:p].encode())
        at[p], last = byte, p
    return [(at[a], at[b]) for _, a, b in spans]


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entity, term, text) for each term near a base span."""
    for batch in batches:
        texts, copies = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        spans = {i: s for i, t in enumerate(texts) if t and (s := base_spans(t))}
        if not spans:
            continue
        at = sorted(spans)
        rows: list[tuple[np.ndarray, ...]] = []
        for lo, words in chunks(pa.array([texts[i] for i in at], pa.large_string()), True, separators(True)):
            offset = np.concatenate([[0], np.cumsum([len(texts[i].encode()) for i in at[lo:lo + len(words.bounds) - 1]])])
            inside = np.zeros(len(words.name), bool)
            placed = []
            for d in range(len(words.bounds) - 1):
                i = at[lo + d]
                for (kind, a, b), (x, y) in zip(spans[i], _byte_spans(texts[i], spans[i])):
                    left = int(np.searchsorted(words.end, offset[d] + x, "right"))
                    right = int(np.searchsorted(words.start, offset[d] + y, "left"))
                    inside[left:right] = True
                    placed.append((i, _entity(kind, texts[i][a:b]), max(words.bounds[d], left - REACH), left, right,
                                   min(words.bounds[d + 1], right + REACH)))
            for i, entity, a, left, right, b in placed:
                near = np.concatenate([np.arange(a, left), np.arange(right, b)]).astype(np.int64)
                if not len(near):
                    continue
                term = np.unique(words.name[near[~inside[near]]])
                n = len(term)
                rows.append((np.full(n, entity), term.view(np.int64), np.full(n, copies[i])))
        if rows:
            cols = [np.concatenate(c) for c in zip(*rows)]
            yield pa.record_batch(dict(zip(("entity", "term", "copy"), map(pa.array, cols))))


class _TermBlock:
    """A sorted block of terms with a fast test for most others."""

    def __init__(self, terms: np.ndarray, degree: np.ndarray) -> None:
        order = np.argsort(terms)
        self.terms, self.degree = terms[order], degree[order]
        self.some = np.zeros(1 << 16, bool)
        self.some[(self.terms & _U(0xFFFF)).astype(np.int64)] = True

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word, place in the block) of each term found."""
        if not len(self.terms):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(self.some[(words.name & _U(0xFFFF)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.terms, words.name[at]), len(self.terms) - 1)
        hit = self.terms[place] == words.name[at]
        return at[hit], place[hit]


def _blocks(table: DataFrame, rows: int) -> Iterator[_TermBlock]:
    """Blocks of ``table(term, degree)``; the driver holds one at a time."""
    terms: list[int] = []
    degree: list[float] = []
    for row in table.toLocalIterator():
        terms.append(row[0])
        degree.append(row[1])
        if len(terms) >= rows:
            yield _TermBlock(np.array(terms, np.int64).view(_U), np.array(degree))
            terms, degree = [], []
    if terms:
        yield _TermBlock(np.array(terms, np.int64).view(_U), np.array(degree))


def _independent(texts: DataFrame, pairs: DataFrame, evidence: Written, least: int) -> DataFrame:
    """``pairs`` whose ``evidence(entity, term, copy)`` has texts of ``least`` classes; near
    copies are of one class."""
    own = Scratch(texts.sparkSession).write(evidence.df.select("copy").distinct())
    classes = ngram_components(texts.join(own.small(), "copy"), key="copy").select(
        F.col("doc_id").alias("copy"), F.col("component_id").alias("class")).distinct()
    enough = evidence.df.join(classes, "copy").select("entity", "term", "class").distinct() \
        .groupBy("entity", "term").agg(F.count("*").alias("classes")).where(F.col("classes") >= least)
    return pairs.join(enough.select("entity", "term"), ["entity", "term"])


def revealing_terms(texts: DataFrame, least: int = LEAST, at: float = GENERALISE_AT, block_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``term, degree``: the names of the terms of ``texts(text)`` that reveal a protected
    entity to ``at`` or more, with the largest degree."""
    spark, scratch = texts.sparkSession, Scratch(texts.sparkSession)
    reach_workers(spark)
    texts = texts.where("text is not null").select("text", F.xxhash64("text").alias("copy"))
    seen = scratch.write(texts.mapInArrow(tidied(_evidence), "entity long, term long, copy long").distinct())
    own = seen.df.select("entity", "copy").distinct().groupBy("entity").agg(F.count("*").alias("n_c"))
    pairs = seen.df.groupBy("entity", "term").agg(F.count("*").alias("n_ct")).where(F.col("n_ct") >= least)
    total = texts.agg(F.count_distinct("copy")).first()[0]

    def degree(n_t: str) -> F.Column:
        pmi = F.log2(F.col("n_ct") * F.lit(float(total)) / (F.col("n_c") * F.col(n_t)))
        return pmi / F.log2(F.lit(float(total)) / F.col("n_c"))

    # The texts that have the term near any entity are some of those that have it at all, so
    # this bounds the degree from above: common words leave before they are counted everywhere.
    near = seen.df.select("term", "copy").distinct().groupBy("term").agg(F.count("*").alias("n_near"))
    pairs = pairs.join(own, "entity").where(F.col("n_c") < total).join(near, "term").where(degree("n_near") >= at)
    likely = scratch.write(pairs)
    if not likely.df.limit(1).count():
        return spark.createDataFrame([], "term long, degree double")
    pairs = scratch.write(_independent(texts, likely.df, scratch.write(
        seen.df.join(likely.df.select("entity", "term"), ["entity", "term"])), least))
    seen.drop()
    counted = None
    for block in _blocks(pairs.df.select("term", F.lit(0.0)).distinct(), block_rows):
        shared = spark.sparkContext.broadcast(block)

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                copies = batch.column(1).to_numpy()
                for lo, words in chunks(batch.column(0), True, separators(True)):
                    word, place = shared.value.find(words)
                    doc = np.searchsorted(words.bounds, word, "right") - 1
                    pair = np.unique(np.stack([doc, place]), axis=1)
                    yield pa.record_batch({"term": pa.array(shared.value.terms[pair[1]].view(np.int64)), "copy": pa.array(copies[lo + pair[0]])})

        # a term is in one block alone; what is written frees the block
        part = scratch.write(texts.mapInArrow(tidied(count), "term long, copy long").distinct()
                             .groupBy("term").agg(F.count("*").alias("n_t")))
        shared.destroy()
        counted = part.df if counted is None else counted.union(part.df)
    if counted is None:
        return spark.createDataFrame([], "term long, degree double")
    return scratch.write(pairs.df.join(counted, "term").groupBy("term").agg(F.max(degree("n_t")).alias("degree"))
                         .where(F.col("degree") >= at)).df


def _added(words: Words, d: int, word: np.ndarray, degree: np.ndarray, remove_at: float) -> list[tuple[str, int, int]]:
    """Code point spans of the revealing terms of text ``d`` of a chunk."""
    lo = words.text_start(d)
    begun = np.concatenate([[0], np.cumsum((words.data[lo:words.text_start(d + 1)] & 0xC0) != 0x80)])
    return [(ADDED[0] if g >= remove_at else ADDED[1], int(begun[words.start[w] - lo]), int(begun[words.end[w] - lo]))
            for w, g in zip(word, degree)]


def _replaced(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping spans, the first and
    longest stands for all."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            if kind == ADDED[0]:
                mark = "[REMOVED]"
            elif kind == ADDED[1]:
                mark = "[NAME]" if text[a:b][0].isupper() else "[WORD]"
            else:
                mark = f"[{kind.upper()}]"
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


SPANS = "array<struct<kind:string,start:long,end:long>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _marked(docs: DataFrame, terms: DataFrame, remove_at: float, block_rows: int,
            finish: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """What ``finish`` gives for batches of ``docs`` (a key of any type, ``text``) and ``found``: spans of the
    terms in the text.  With several blocks, each but the last is written, so that one is held at a time.

    The last block is marked in the function that finishes: one after the other, each task would need two
    Python workers at once, which live on and keep the caches of later steps twice."""
    scratch, before, shared, last = Scratch(docs.sparkSession), None, None, None
    marked = docs.withColumn("found", F.lit(None).cast(SPANS))
    out = marked.schema
    for block in _blocks(terms, block_rows):
        if last:
            written = scratch.write(marked.mapInArrow(tidied(last), out))
            shared.destroy()
            if before:
                before.drop()
            marked, before = written.df, written
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def mark(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [list(x or ()) for x in batch.column(2).to_pylist()]
                for lo, words in chunks(batch.column(1), True, separators(True)):
                    word, place = shared.value.find(words)
                    doc = np.searchsorted(words.bounds, word, "right") - 1
                    for d in np.unique(doc):
                        own = doc == d
                        found[lo + d] += [dict(zip(("kind", "start", "end"), s)) for s in _added(
                            words, d, word[own], shared.value.degree[place[own]], remove_at)]
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found, _SPAN_TYPE)], names=out.names)

        last = mark

    def run(batches: Iterator[pa.RecordBatch], last=last) -> Iterator[pa.RecordBatch]:
        yield from finish(last(batches) if last else batches)

    return marked.mapInArrow(tidied(run), schema)


def _all_spans(text: str | None, found: list[dict] | None) -> list[tuple[str, int, int]]:
    """Base spans, and those of ``found`` that lie outside them."""
    own = base_spans(text or "")
    extra = sorted({(s["kind"], s["start"], s["end"]) for s in found or ()}, key=lambda s: (ADDED.index(s[0]), s[1]))
    return own + [s for s in extra if not any(a < s[2] and s[1] < b for _, a, b in own)]


def find_personal_data(docs: DataFrame, texts: bool = True, least: int = LEAST, generalise_at: float = GENERALISE_AT,
                       remove_at: float = REMOVE_AT, block_rows: int = BROADCAST_ROWS,
                       key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, spans`` and, if asked, ``text`` (sanitised) of each row.

    Spans are in code points, end exclusive, by kind (base kinds first) and start; terms inside
    base spans aren't added.  Null texts stay null and have no spans; repeated rows and null
    keys are kept; copies of a text count once in the statistics.
    """
    docs = narrow(docs, key, text)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, clean = [], []
            found = batch.column(2).to_pylist() if batch.column(2).null_count < batch.num_rows else [None] * batch.num_rows
            for t, more in zip(batch.column(1).to_pylist(), found):
                own = _all_spans(t, more)
                spans.append([dict(zip(("kind", "start", "end"), s)) for s in own])
                if texts:
                    clean.append(None if t is None else _replaced(t, own) if own else t)
            yield pa.record_batch({"doc_id": batch.column(0), "spans": pa.array(spans, _SPAN_TYPE)} | (
                {"text": pa.array(clean, pa.string())} if texts else {}))

    return _marked(docs, revealing_terms(docs.select("text"), least, generalise_at, block_rows), remove_at, block_rows,
                   finish, f"doc_id long, spans {SPANS}" + ", text string" * texts)


def digests(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""
    found = find_personal_data(docs, texts=False)
    text = "concat(x.kind, ':', x.start, ':', x.end)"
    base = " or ".join(f"x.kind = '{k}'" for k in KINDS)
    return found.select(
        "doc_id", *(F.expr(f"cast(size(filter(spans, x -> x.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.expr(f"array_join(transform(filter(spans, x -> {base}), x -> {text}), ',')"), 256).alias("base_sha256"),
        F.expr(f"array_join(transform(spans, x -> {text}), ',')").alias("spans"))


def sanitise(docs: DataFrame, block_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with sanitised texts, all other columns as they are, but for ``n_chars``, which
    follows the text where it is there."""
    reach_workers(docs.sparkSession)
    row = free_name(docs, "row_as_key")
    others = [c for c in docs.columns if c != "text"]
    # the other columns travel as the key, so that rows keep together without a join
    keyed = docs.select(F.struct(*others).alias(row), "text")
    clean = _keyed(keyed, row, block_rows)
    length = {"n_chars": F.when(F.col("text").isNotNull(), F.length("text")).cast(dict(docs.dtypes)["n_chars"])} if "n_chars" in others else {}
    return clean.select(*(F.col("text") if c == "text" else F.col(f"{row}.`{c}`").alias(c) for c in docs.columns)).withColumns(length)


def _keyed(docs: DataFrame, row: str, block_rows: int) -> DataFrame:
    """Sanitised texts beside an untouched column."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            found = batch.column(2).to_pylist() if batch.column(2).null_count < batch.num_rows else [None] * batch.num_rows
            for t, more in zip(batch.column(1).to_pylist(), found):
                own = _all_spans(t, more)
                out.append(t if not own else _replaced(t, own))
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], names=[row, "text"])

    return _marked(docs, revealing_terms(docs.select("text"), block_rows=block_rows), REMOVE_AT, block_rows, clean, docs.schema)
