"""Projections, column-order contracts and small filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.constants import TARGET


def select_features(df: DataFrame, features: Sequence[str], target: str = TARGET) -> DataFrame:
    """Keep ``[target] + features`` in that order (fails on a missing column)."""
    return reorder(df, [target, *features])


def split_xy(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, str]:
    """Features without the target, plus the label column name."""
    return df.drop(target), target


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P3."""
    return df.drop(*cols)


def reorder(df: DataFrame, ordered: Sequence[str]) -> DataFrame:
    """Exact model column order; a missing column is an error, not a NULL."""
    missing = [c for c in ordered if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*ordered)


def category_filter(df: DataFrame, **equals) -> DataFrame:
    """P5: AND of category equalities, e.g. ``category_filter(df, Location='X', Type='Y')``."""
    cond = F.lit(True)
    for c, v in equals.items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.filter(cond)


def request_frame(spark: SparkSession, rows: Sequence[dict], schema: T.StructType) -> DataFrame:
    """Request dictionaries -> a schema-checked batch DataFrame."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def removed_columns(spark: SparkSession, all_cols: Sequence[str], keep: Sequence[str],
                    show: int = 10) -> DataFrame:
    """Columns dropped by a manifest projection, sorted; the first ``show``
    plus an 'and n more' row.  Input is a column list (schema metadata)."""
    removed = sorted(set(all_cols) - set(keep))
    rows = [(i, c) for i, c in enumerate(removed[:show])]
    if len(removed) > show:
        rows.append((show, f"... and {len(removed) - show} more"))
    return spark.createDataFrame(rows, "position INT, column STRING")
