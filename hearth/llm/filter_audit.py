"""Operator 11: what filters remove together, and what each adds in every order.

Each row fails some of n filters.  A coalition is a set of filters; its value is the number
of rows that fail at least one of them.  All 2^n values of a part are tabulated from one
aggregate over (part, failed filters).  The rest is arithmetic on that table:

* A filter that follows the coalition S removes value(S + filter) - value(S) rows.
* Shapley values solve a constrained least squares problem: the additive game nearest to
  the values, with the Shapley kernel's weights (n - 1) / (C(n, s) s (n - s)) and the
  efficiency constraint that the parts sum to the value of all filters.  The normal
  equations are solved in rationals, once for each coalition's unit value, so the solution
  is an exact linear map; times n! it has integer entries, and Spark applies it.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import Scratch

WORDS = r"[^\x20\x09-\x0D]+"
FILTERS = ("A", "B", "C", "D", "E")


def kernel_map(n: int) -> list[list[Fraction]]:
    """``m[i][s]``: how much the value of coalition ``s`` (bits are members) adds to the Shapley
    value of player ``i``: the efficiency-constrained solution of the kernel-weighted normal
    equations

        sum_s w(s) z(s) z(s)' phi + lambda 1 = sum_s w(s) z(s) value(s),   1' phi = value(all)

    with one right-hand side for each coalition."""
    every = (1 << n) - 1
    weight = {s: Fraction(n - 1, math.comb(n, k) * k * (n - k)) for s in range(1, every) for k in (s.bit_count(),)}
    member = [[s >> i & 1 for s in range(every + 1)] for i in range(n)]
    rows = []
    for i in range(n):
        left = [sum((w for s, w in weight.items() if member[i][s] and member[j][s]), Fraction(0)) for j in range(n)]
        rows.append([*left, Fraction(1), *[weight.get(s, Fraction(0)) * member[i][s] for s in range(every + 1)]])
    rows.append([*[Fraction(1)] * n, Fraction(0), *[Fraction(s == every) for s in range(every + 1)]])
    for at in range(n + 1):                                    # Gauss-Jordan with exact pivots
        pivot = next(r for r in range(at, n + 1) if rows[r][at])
        rows[at], rows[pivot] = rows[pivot], rows[at]
        rows[at] = [x / rows[at][at] for x in rows[at]]
        for r in range(n + 1):
            if r != at and rows[r][at]:
                f = rows[r][at]
                rows[r] = [x - f * y for x, y in zip(rows[r], rows[at])]
    return [rows[i][n + 1:] for i in range(n)]


def coalition_values(rows: DataFrame, filters: Sequence[str], part: str, flags: Sequence[str]) -> DataFrame:
    """``part, total, v``: an array with, for each coalition in the order of its bits, the number
    of rows that fail any of its filters (``removed``) and how many of them have each flag.

    ``rows`` has a boolean column for each filter and flag.  Rows are counted by what they fail
    before anything else, so a hot part is a few rows by the time it is shuffled."""
    failed = sum((F.col(f).cast("int") * (1 << i) for i, f in enumerate(filters)), F.lit(0))
    cells = (rows.select(F.col(part), failed.alias("_failed"), *flags).groupBy(part, "_failed")
             .agg(F.count("*").alias("removed"), *[F.count_if(f).alias(f) for f in flags]))
    each = cells.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit((1 << len(filters)) - 1))))
    hit = F.col("_failed").bitwiseAND(F.col("_s")) != 0
    table = each.groupBy(part, "_s").agg(
        F.sum("removed").alias("_total"), *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in ("removed", *flags)])
    # 2^n rows a part
    return table.groupBy(part).agg(F.max("_total").alias("total"), F.array_sort(F.collect_list(F.struct("_s", "removed", *flags))).alias("v"))


def filter_interactions(rows: DataFrame, filters: Sequence[str], part: str = "part", flags: Sequence[str] = ()) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails``, ``<flag>_lost`` for each
    flag and ``shapley``: a row for each part, order of all filters and step of that order.

    ``rows`` has a boolean column for each filter (whether the row fails it) and flag, without
    nulls.  ``redundant`` counts rows that fail the step's filter and went before,
    ``unique_fails`` those that fail no other, ``shapley`` what the filter removes at any step, summed
    over all n! orders.  The rows of a key that stands twice count twice; an empty table has no part.
    The result has n! * n rows a part, so it is meant for a handful of filters."""
    n, every = len(filters), (1 << len(filters)) - 1
    exact = [[x * math.factorial(n) for x in row] for row in kernel_map(n)]
    assert all(x.denominator == 1 for row in exact for x in row)
    dot = "aggregate(zip_with(v.removed, array({}), (a, b) -> a * b), 0L, (s, x) -> s + x)"
    shapley = F.expr(f"array({', '.join(dot.format(', '.join(f'{int(x)}L' for x in row)) for row in exact)})")
    steps = [{"filter_order": "".join(filters[i] for i in order), "step": k + 1, "i": order[k], "before": before, "after": before | 1 << order[k]}
             for order in itertools.permutations(range(n)) for k in range(n) for before in (sum(1 << i for i in order[:k]),)]
    step = F.explode(F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, i: int, before: int, after: int>>"))

    def value(s: Column | int, name: str = "removed") -> Column:
        return F.col("v")[s][name]

    alone = F.array(*[value(1 << i) for i in range(n)])
    only = F.array(*[value(every) - value(every ^ 1 << i) for i in range(n)])
    wide = (coalition_values(rows, filters, part, flags).select(part, "total", "v", shapley.alias("_shapley"), alone.alias("_alone"), only.alias("_only"))
            .withColumn("_at", step).select("*", "_at.*"))
    gained = value(F.col("after")) - value(F.col("before"))
    return wide.select(
        part, "filter_order", "step", (F.col("total") - value(F.col("after"))).alias("kept"), gained.alias("removed"),
        (F.col("_alone")[F.col("i")] - gained).alias("redundant"), F.col("_only")[F.col("i")].alias("unique_fails"),
        *[(value(F.col("after"), f) - value(F.col("before"), f)).alias(f"{f}_lost") for f in flags],
        F.col("_shapley")[F.col("i")].alias("shapley"))


def document_failures(docs: DataFrame, labels: DataFrame, min_words: int = 50, min_distinct: int = 65, max_capitals: int = 5,
                      marks: str = "#$%&*|") -> DataFrame:
    """``doc_id, part, A, B, C, D, E, good, toxic`` of each row of ``docs(doc_id, text, source)``: which
    filters its whole text fails, and its labels.

    A: under ``min_words`` words; B: less than ``min_distinct`` percent distinct words; C: over
    ``max_capitals`` percent of code points are ``[A-Z]``; D: holds one of ``marks``; E: a row with a
    smaller key anywhere in the table has the same text.  Null texts are empty ones, null sources the
    part ``''``.  A null key has no smaller one; rows that repeat key and text don't fail E by each other.  A key
    with several labels has every flag that one of them gives.

    Texts are read once; what is left of a row is a digest of its text, a few flags and its part.  The
    smallest key of a text joins on text and key, so that thousands of copies don't meet in one task."""
    scratch = Scratch(docs.sparkSession)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
    words = text.withColumn("words", F.regexp_extract_all("text", F.lit(WORDS), F.lit(0)))
    kept = F.length(F.regexp_replace("text", "[A-Z]+", ""))
    seen = scratch.write(words.select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
        (F.size("words") < min_words).alias("A"),
        (100 * F.size(F.array_distinct("words")) < min_distinct * F.size("words")).alias("B"),
        (100 * (F.length("text") - kept) > max_capitals * F.length("text")).alias("C"),
        (F.length("text") > F.length(F.translate("text", marks, ""))).alias("D"))).df
    first = seen.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("_first", F.lit(True))
    flags = (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    return (seen.join(first, ["digest", "doc_id"], "left").join(flags, "doc_id", "left")
            .select("doc_id", "part", "A", "B", "C", "D", (F.col("doc_id").isNotNull() & F.col("_first").isNull()).alias("E"),
                    *[F.coalesce(f, F.lit(False)).alias(f) for f in ("good", "toxic")]))


def audit(docs: DataFrame, labels: DataFrame, **limits: int) -> DataFrame:
    """The interactions of the five document filters in every part (``document_failures`` and
    ``filter_interactions`` state what nulls, ties and repeated rows give)."""
    rows = document_failures(docs, labels, **limits)
    return filter_interactions(rows, FILTERS, "part", ("good", "toxic"))
