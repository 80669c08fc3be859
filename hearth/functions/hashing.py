"""Deterministic row hashing for splits, folds and samples.

``bucket32`` is the first 32 bits of md5 over the '|'-joined key columns and a
seed, as BIGINT in [0, 2^32).  It depends only on the row's key, so it is
stable under repartitioning and recomputation after executor loss, needs no
shuffle, and the same value is computed by the SQL oracle:
``CAST(('0x' || substr(md5(key), 1, 8)) AS BIGINT)``.
Hash integer/string keys only (double -> string text differs across engines).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def key_string(keys: Sequence[str], seed: int | None = None) -> Column:
    parts = [F.col(k).cast("string") for k in keys]
    if seed is not None:
        parts.append(F.lit(str(seed)))
    return F.concat_ws("|", *parts)


def bucket32(keys: Sequence[str], seed: int | None = None) -> Column:
    return F.conv(F.substring(F.md5(key_string(keys, seed)), 1, 8), 16, 10).cast("bigint")


def bucket60(keys: Sequence[str], seed: int | None = None) -> Column:
    """60 bits of the same digest: ranks by it have no ties at any table size."""
    return F.conv(F.substring(F.md5(key_string(keys, seed)), 1, 15), 16, 10).cast("bigint")


def unit_hash(keys: Sequence[str], seed: int | None = None) -> Column:
    """Uniform value in [0, 1)."""
    return bucket32(keys, seed) / F.lit(TWO_32)


def sql_bucket32(keys: Sequence[str], seed: int | None = None, digits: int = 8) -> str:
    """The same hash in DuckDB SQL (``digits=15``: ``bucket60``)."""
    parts = [f"CAST({k} AS VARCHAR)" for k in keys]
    if seed is not None:
        parts.append(f"'{seed}'")
    return f"CAST(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, {digits})) AS BIGINT)"
