"""Small texts with the odd cases every operator must take: nulls, empty and blank texts,
ties, repeated rows, a null key, and columns whose names clash with the operators' own."""

from __future__ import annotations

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """``n`` words that another seed hardly shares."""
    return " ".join(f"{WORDS[(seed * 7 + i * i + i) % len(WORDS)]}{(seed * 31 + i) % 997}" for i in range(n))


def odd_rows() -> list[tuple]:
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    return [
        (1, base), (2, base), (3, " ".join(near)), (4, prose(2, 80)), (5, None), (6, ""), (7, " \t\n "),
        (8, "two words"), (9, "two words"), (10, prose(3, 60) + " " + " ".join(base.split()[10:75])),
        (11, prose(4, 30)), (11, prose(4, 30)), (11, prose(5, 90)), (None, base), (12, "x" * 20_000),
        (13, "a " * 30_000), (14, prose(6, 40) + "\n" + prose(2, 80).upper()), (15, "one two three four five"),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(k, t, "cls", i, "row", 7) for i, (k, t) in enumerate(odd_rows())]
    return spark.createDataFrame(rows, "doc_id long, text string, cls string, n_tokens long, row string, n_chars long").repartition(5)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
