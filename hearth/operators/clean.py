"""Raw listing normalisation, coercion and outlier cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.constants import CLEANING_BOUNDS
from hearth.functions.features import ratio

RAW_TO_MODEL = {"bedrooms": "Beds", "bathrooms": "Baths", "size": "Area_in_sqft",
                "location": "Location", "property_type": "Type", "furnished": "Furnishing"}


def coerce_numeric(df: DataFrame, cols: Sequence[str], to: str = "double") -> DataFrame:
    """Bad text -> NULL (``try_cast``), like ``to_numeric(errors='coerce')``."""
    return df.withColumns({c: F.col(c).cast("string").try_cast(to) for c in cols})


def bedrooms_value(c: Column) -> Column:
    """'Studio' -> 0, other text -> integer or NULL."""
    s = F.trim(c.cast("string"))
    return F.when(F.lower(s) == "studio", F.lit(0)).otherwise(s.try_cast("int"))


def normalise_raw(df: DataFrame, monthly_price: str = "price") -> DataFrame:
    """Raw listing -> modelling columns; monthly price -> annual Rent (x12)."""
    out = df.withColumn("bedrooms", bedrooms_value(F.col("bedrooms")))
    out = out.withColumn("Rent", F.col(monthly_price).cast("double") * 12)
    present = {k: v for k, v in RAW_TO_MODEL.items() if k in out.columns}
    return out.withColumnsRenamed(present)


def cleaning_condition(price: str = "price", size: str = "size", bedrooms: str = "bedrooms",
                       bathrooms: str = "bathrooms", bounds: dict | None = None) -> Column:
    b = {**CLEANING_BOUNDS, **(bounds or {})}
    pps = ratio(price, size)
    return (F.col(price).between(b["price_min"], b["price_max"])
            & F.col(size).between(b["size_min"], b["size_max"])
            & pps.between(b["price_per_sqft_min"], b["price_per_sqft_max"])
            & (F.col(bedrooms) <= b["bedrooms_max"])
            & (F.col(bathrooms) <= b["bathrooms_max"]))


def clean_range(df: DataFrame, **kw) -> DataFrame:
    """Keep rows inside every cleaning bound (NULL fails the bound)."""
    return df.filter(F.coalesce(cleaning_condition(**kw), F.lit(False)))
