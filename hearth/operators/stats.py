"""M2 SPLIT -> CALCULATE -> APPLY: group statistics fitted on training rows and
applied to any split or request batch (A1, A2, A6, A7, A8, J1-J3, W1, F7, F9-F12).

``fit_listing_stats`` runs ONE aggregate over the training rows, from which the five target
means (location, location x type, furnishing, type, global), the location area moments
and the per-location rank index of areas are rolled up.  The fitted tables are written and
size-checked; ``apply_listing_stats`` only ever sees those tables, never training rows, so
val/test/request targets cannot leak into features.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.constants import (BROADCAST_MAX_ROWS, COMPARISON_LABELS, DEGENERATE_PREMIUM, UNKNOWN_RANK,
                              UNKNOWN_REGION_MEAN)
from hearth.functions.features import ratio
from hearth.operators.joins import cut_lineage, join_small
from hearth.operators.ranks import RankIndex, hinted, quantiles, rank_index


@dataclass
class ListingStats:
    """Fitted statistics; every table is small (one row per category/group)."""
    loc: DataFrame          # loc, loc_n, loc_mean_area, loc_std_area, loc_mean_rent
    loc_type: DataFrame     # loc, type, lt_mean_rent
    furn: DataFrame         # furn, furn_mean_rent
    typ: DataFrame          # type, type_mean_rent
    areas: RankIndex        # ranks of the training areas per location
    global_mean: float | None
    cols: dict


def fit_listing_stats(train: DataFrame, loc: str = "Location", typ: str = "Type",
                      furn: str = "Furnishing", area: str = "Area_in_sqft",
                      target: str = "Rent", max_rows: int = BROADCAST_MAX_ROWS) -> ListingStats:
    """ONE pass over the training rows: counts and sums of the target by (location, type, furnishing) and
    by (location, area).  The five target-mean levels, the area moments and the rank index are all rolled
    up from that table, which is written (it has a row for each combination, not for each listing)."""
    g = cut_lineage(train.groupingSets([[loc, typ, furn], [loc, area]], loc, typ, furn, area).agg(
        F.grouping_id().alias("_gid"), F.count("*").alias("_n"), F.count(target).alias("_k"), F.sum(F.col(target).cast("double")).alias("_s")))
    # grouping_id bits follow (loc, typ, furn, area) = (8, 4, 2, 1); 1 = aggregated away.
    by_type = g.where("_gid = 1").select(F.col(loc).alias("_loc"), F.col(typ).alias("_typ"), F.col(furn).alias("_furn"), "_k", "_s")
    by_area = g.where("_gid = 6").select(F.col(loc).alias("_loc"), F.col(area).alias("_area"), F.col(area).cast("double").alias("_a"), "_n", "_k", "_s")
    mean = F.try_divide(F.sum("_s"), F.sum("_k"))
    total = by_type.agg(mean.alias("m")).first()["m"]
    w = F.when(F.col("_a").isNotNull(), F.col("_n"))
    areas, sums = F.sum(w), F.sum(w * F.col("_a"))
    spread = F.greatest(F.sum(w * F.col("_a") * F.col("_a")) - sums * sums / areas, F.lit(0.0))
    std = F.when(areas > 1, F.when(F.max("_a") > F.min("_a"), F.sqrt(spread / (areas - 1))).otherwise(F.lit(0.0)))

    rows = g.count()

    def fitted(t: DataFrame) -> DataFrame:
        """A table rolled up from ``g``, so no larger: broadcast from there if that is within the bound."""
        return F.broadcast(t) if rows <= max_rows else hinted(cut_lineage(t), max_rows)

    loc_t = fitted(by_area.groupBy("_loc").agg(
        F.sum("_n").alias("loc_n"), F.try_divide(sums, areas).alias("loc_mean_area"), std.alias("loc_std_area"), mean.alias("loc_mean_rent")))
    return ListingStats(
        loc_t, fitted(by_type.groupBy("_loc", "_typ").agg(mean.alias("lt_mean_rent"))),
        fitted(by_type.groupBy("_furn").agg(mean.alias("furn_mean_rent"))), fitted(by_type.groupBy("_typ").agg(mean.alias("type_mean_rent"))),
        rank_index(by_area.withColumnRenamed("_n", "cnt"), max_rows=max_rows, rows=rows), total, dict(loc=loc, typ=typ, furn=furn, area=area, target=target))


def area_rank_share(df: DataFrame, stats: ListingStats) -> DataFrame:
    """W1 against the stored rank index: share of training rows of the same location with a strictly
    smaller area; UNKNOWN_RANK for unseen locations, 0 for a NULL area in a known one (no area
    compares smaller)."""
    c = stats.cols
    out = stats.areas.lookup(df, c["loc"], c["area"], "_rows_below", "_rn")
    out = out.join(stats.loc.select("_loc", "loc_n"), F.col(c["loc"]) == F.col("_loc"), "left")
    share = (F.when(F.col("loc_n").isNotNull() & F.col(c["area"]).isNull(), F.lit(0.0))
             .when(F.col("_rn") > 0, F.col("_rows_below") / F.col("_rn")).otherwise(F.lit(UNKNOWN_RANK)))
    return out.withColumn("property_rank_in_location", share).drop("_loc", "loc_n", "_rows_below", "_rn")


def premium(mean: Column, global_mean: float | None, unknown: float) -> Column:
    if global_mean is None or global_mean <= 0:
        return F.lit(DEGENERATE_PREMIUM)
    return F.coalesce(mean / F.lit(global_mean), F.lit(unknown))


def apply_listing_stats(df: DataFrame, stats: ListingStats,
                        unknown_premium: float = DEGENERATE_PREMIUM) -> DataFrame:
    """Adds property_rank_in_location, area_deviation_from_location and the three
    premiums with the fallback chain (location x type -> location -> unknown)."""
    c = stats.cols
    loc, typ, furn, area = F.col(c["loc"]), F.col(c["typ"]), F.col(c["furn"]), F.col(c["area"])
    out = area_rank_share(df, stats)
    # Fitted tables carry their size-checked broadcast decision from fit time.
    out = out.join(stats.loc, loc == F.col("_loc"), "left").drop("_loc")
    out = out.join(stats.loc_type, (loc == F.col("_loc")) & (typ == F.col("_typ")),
                   "left").drop("_loc", "_typ")
    out = out.join(stats.furn, furn == F.col("_furn"), "left").drop("_furn")
    out = out.join(stats.typ, typ == F.col("_typ"), "left").drop("_typ")
    deviation = F.when(F.col("loc_std_area") > 0,
                       (area - F.col("loc_mean_area")) / F.col("loc_std_area")).otherwise(F.lit(0.0))
    lt = F.when(F.col("lt_mean_rent").isNull() | (F.col("lt_mean_rent") == 0),
                F.col("loc_mean_rent")).otherwise(F.col("lt_mean_rent"))
    g = stats.global_mean
    out = out.withColumns({
        "area_deviation_from_location": deviation,
        "location_type_premium": premium(lt, g, unknown_premium),
        "furnishing_type_premium": premium(F.col("furn_mean_rent"), g, unknown_premium),
        "type_room_premium": premium(F.col("type_mean_rent"), g, unknown_premium),
    })
    return out.drop("loc_n", "loc_mean_area", "loc_std_area", "loc_mean_rent",
                    "lt_mean_rent", "furn_mean_rent", "type_mean_rent")


def listing_features(df: DataFrame, stats: ListingStats, beds: str = "Beds",
                     baths: str = "Baths") -> DataFrame:
    """The 11 numeric model features for any batch of listings/requests."""
    area = stats.cols["area"]
    out = df.withColumns({
        "log_area": F.log1p(F.col(area).cast("double")),
        "bath_bed_ratio": ratio(baths, F.col(beds) + 1),
        "area_per_bedroom": ratio(area, F.col(beds) + 1),
    })
    return apply_listing_stats(out, stats)


# A1 / A2 / J1 ---------------------------------------------------------------
def region_features(df: DataFrame, region: str = "address_region", price: str = "price",
                    max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """region_price_mean/median/std per region joined back (left); groups
    without a value (e.g. a one-row std) are filled with the global value.
    A row without a region gets the global values, too.  The table is read once
    into counts of (region, price); medians of both levels come from those."""
    counts = cut_lineage(df.groupBy(F.col(region).alias("_r"), F.col(price).alias("_p")).agg(F.count("*").alias("_c")))
    mom = df.rollup(region).agg(F.grouping_id().alias("_gid"), F.avg(price).alias("_m"), F.stddev_samp(price).alias("_s"))
    known = counts.where("_r is not null")
    med = quantiles(known, ["_r"], "_p", [0.5], ["_md"], weight="_c").drop("n")
    whole = counts.groupBy("_p").agg(F.sum("_c").alias("_c"))
    g = mom.where("_gid > 0").first()
    gm = quantiles(whole, [], "_p", [0.5], ["_md"], weight="_c").first()
    g = {"_m": g["_m"], "_s": g["_s"], "_md": gm["_md"] if gm else None} if g else None
    per = (mom.where(F.col(region).isNotNull()).select(F.col(region).alias("_r"), "_m", "_s").join(med, "_r", "left")
           .select(F.col("_r").alias(region), F.col("_m").alias("region_price_mean"),
                   F.col("_md").alias("region_price_median"), F.col("_s").alias("region_price_std")))
    out = join_small(df, per, region, "left", max_rows)
    return out.withColumns({
        "region_price_mean": F.coalesce("region_price_mean", F.lit(g["_m"] if g else None)),
        "region_price_median": F.coalesce("region_price_median", F.lit(g["_md"] if g else None)),
        "region_price_std": F.coalesce("region_price_std", F.lit(g["_s"] if g else None)),
    })


# J2 --------------------------------------------------------------------------
def region_lookup(df: DataFrame, region_means: DataFrame, region: str = "location",
                  means_key: str = "region", means_value: str = "region_price_mean",
                  default: float = UNKNOWN_REGION_MEAN,
                  max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Lookup with a default for unknown regions (broadcast left join + coalesce)."""
    m = region_means.select(F.col(means_key).alias("_rk"), F.col(means_value).alias("_rv"))
    out = join_small(df, m, F.col(region) == F.col("_rk"), "left", max_rows)
    return out.withColumn("region_price_mean", F.coalesce("_rv", F.lit(default))).drop("_rk", "_rv")


# F12 -------------------------------------------------------------------------
def v62_features(requests: DataFrame, region_means: DataFrame, bedrooms: str = "bedrooms",
                 bathrooms: str = "bathrooms", size: str = "size", location: str = "location",
                 flags: list[str] | None = None) -> DataFrame:
    """The 13-feature request row, for a whole batch of requests."""
    from hearth.constants import V62_FLAGS
    flags = flags if flags is not None else V62_FLAGS
    out = region_lookup(requests, region_means, location)
    log_size = F.log1p(F.col(size).cast("double"))
    cols = {
        "log_size": log_size,
        "total_rooms": F.col(bedrooms) + F.col(bathrooms),
        "price_per_sqft_est": ratio("region_price_mean", size),
        "bed_size_interaction": F.col(bedrooms) * log_size,
    }
    for f in flags:
        cols[f] = (F.coalesce(F.col(f).cast("boolean"), F.lit(False)).cast("int")
                   if f in requests.columns else F.lit(0))
    return out.withColumns(cols)


# A8 --------------------------------------------------------------------------
def market_comparison(scored: DataFrame, stats: ListingStats, prediction: str = "prediction",
                      max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """(row..., Category, Price): location average, type average, prediction."""
    c = stats.cols
    out = scored.join(stats.loc.select("_loc", "loc_mean_rent"),
                      F.col(c["loc"]) == F.col("_loc"), "left").drop("_loc")
    out = out.join(stats.typ, F.col(c["typ"]) == F.col("_typ"), "left").drop("_typ")
    keep = [x for x in scored.columns if x != prediction]
    a, b, p = (F.lit(x) for x in COMPARISON_LABELS)
    return out.select(*keep, F.inline(F.array(
        F.struct(a.alias("Category"), F.col("loc_mean_rent").alias("Price")),
        F.struct(b.alias("Category"), F.col("type_mean_rent").alias("Price")),
        F.struct(p.alias("Category"), F.col(prediction).cast("double").alias("Price")))))
