"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the given tables (through the listing view or directly) and
runs over the whole of them.  Floating outputs whose value can differ in the
last bits between engines (aggregates, whose summation order differs, and
transcendental functions) are rounded to ``ROUND`` places on both sides;
plain IEEE arithmetic (+ - * /) is left exact, since rounding it would only
add decimal ties.
"""

from __future__ import annotations

import itertools
import os
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.constants import (ALL_FEATURES, CATEGORICAL_FEATURES as CATEGORICAL, FEATURE_RANGES,
                              N_FOLDS, NUMERIC_FEATURES, PREDICTION_RANGE, ROUND, TARGET, VALIDATION_RULES)
from hearth.functions import features as fx
from hearth.operators import audit as au
from hearth.operators import clean, project, sets
from hearth.operators import encode as enc
from hearth.operators import evaluate as ev
from hearth.operators import profile as pf
from hearth.operators import split as sp
from hearth.operators import stats as st
from hearth.operators.joins import cut_lineage, drop_table
from hearth.operators.split import hash_split
from hearth.operators.stats import fit_listing_stats, listing_features as add_listing_features
from hearth.plans import boosting, stacking
from hearth.session import checkpoint_dir
from hearth.sources import sinks
from hearth.sources.tables import LISTING_KEY, listings, read_csv_table, read_table
from hearth.streaming import hourly, scoring

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def r(c, places: int = ROUND):
    return F.round(F.col(c).cast("double"), places) if isinstance(c, str) else F.round(c, places)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def split_listings(spark: SparkSession, sf_dir: str, materialise: bool = False, **kw) -> DataFrame:
    """The listing view with the default hash split column.  ``materialise``
    writes it once as parquet for flows that pass over it several times
    (fit on train, rank probes, apply), as a stored split table would be."""
    df = hash_split(listings(spark, sf_dir, **kw), LISTING_KEY)
    return cut_lineage(df) if materialise else df


def featured_listings(spark: SparkSession, sf_dir: str, materialise: bool = False) -> DataFrame:
    """Split -> fit statistics on train rows -> apply to every row (M2).

    ``materialise`` writes the feature table once (reliable checkpoint) for
    queries that make several passes over it, instead of recomputing the
    scan, joins and feature joins for every pass."""
    df = split_listings(spark, sf_dir, materialise=True)       # read to fit and again to apply
    stats = fit_listing_stats(df.filter(F.col("split") == "train"))
    out = add_listing_features(df, stats)
    return cut_lineage(out) if materialise else out


DERIVED = [c for c in NUMERIC_FEATURES if c not in ("Beds", "Baths", "Area_in_sqft")]


@query("listing_features")
def q_listing_features(spark, sf_dir):
    out = featured_listings(spark, sf_dir)
    return out.select(*LISTING_KEY, "split", "Location", "Type", "Furnishing", "Beds", "Baths",
                      "Area_in_sqft", *[r(c).alias(c) for c in DERIVED], "Rent")


# ---------------------------------------------------------------------------
# Projections, cleaning, scalar features
# ---------------------------------------------------------------------------


@query("feature_select")
def q_feature_select(spark, sf_dir):
    """P1 + P4: the manifest projection ['Rent'] + 14 features, in order."""
    out = project.select_features(featured_listings(spark, sf_dir), ALL_FEATURES, TARGET)
    return out.select(*[r(c).alias(c) if c in DERIVED else F.col(c) for c in out.columns])


def raw_listings(spark, sf_dir):
    """Raw-shaped listings: monthly price, text bedrooms ('Studio' for 0)."""
    df = listings(spark, sf_dir)
    beds = F.when(F.col("Beds") == 0, F.lit("Studio")).otherwise(F.col("Beds").cast("string"))
    return df.select(*LISTING_KEY, (F.col("Rent") / 12).alias("price"), beds.alias("bedrooms"),
                     F.col("Baths").alias("bathrooms"), F.col("Area_in_sqft").alias("size"),
                     F.col("Location").alias("location"), F.col("Type").alias("property_type"),
                     F.col("Furnishing").alias("furnished"))


@query("raw_normalise")
def q_raw_normalise(spark, sf_dir):
    """P7 + P8: text prices coerced, 'Studio' -> 0, raw -> model names, monthly -> annual."""
    raw = raw_listings(spark, sf_dir).withColumn("price", F.col("price").cast("string"))
    out = clean.normalise_raw(clean.coerce_numeric(raw, ["price"]))
    return out.select(*LISTING_KEY, "Beds", "Baths", "Area_in_sqft", "Location", "Type",
                      "Furnishing", r("Rent").alias("Rent"))


@query("clean_range")
def q_clean_range(spark, sf_dir):
    """Rows inside every cleaning bound (annual rent as the price)."""
    df = listings(spark, sf_dir).select(
        *LISTING_KEY, F.col("Rent").alias("price"), F.col("Area_in_sqft").alias("size"),
        F.col("Beds").alias("bedrooms"), F.col("Baths").alias("bathrooms"))
    return clean.clean_range(df)


@query("log_features")
def q_log_features(spark, sf_dir):
    out = fx.log_features(listings(spark, sf_dir), ["Area_in_sqft", "Rent", "Beds"])
    return out.select(*LISTING_KEY, *[r(c).alias(c) for c in ("log_Area_in_sqft", "log_Rent", "log_Beds")])


@query("interaction_features")
def q_interaction_features(spark, sf_dir):
    out = fx.interaction_features(listings(spark, sf_dir), [("Beds", "Baths"), ("Beds", "Area_in_sqft")])
    return out.select(*LISTING_KEY, "Beds_Baths_interaction",
                      r("Beds_Area_in_sqft_interaction").alias("Beds_Area_in_sqft_interaction"))


@query("room_ratios")
def q_room_ratios(spark, sf_dir):
    out = fx.room_ratios(listings(spark, sf_dir))
    return out.select(*LISTING_KEY, r("bath_bed_ratio").alias("bath_bed_ratio"),
                      r("area_per_bedroom").alias("area_per_bedroom"))


@query("property_features")
def q_property_features(spark, sf_dir):
    df = listings(spark, sf_dir).select(
        *LISTING_KEY, F.col("Beds").alias("bedrooms"), F.col("Baths").alias("bathrooms"),
        F.col("Area_in_sqft").alias("size"), F.col("Rent").alias("price"))
    out = fx.property_features(df)
    return out.select(*LISTING_KEY, "total_rooms", "price_per_sqft",
                      r("bed_size_interaction").alias("bed_size_interaction"))


POWER = ["area_squared", "area_cubed", "area_fourth_power", "beds_squared", "beds_cubed",
         "baths_squared", "baths_cubed", "room_count", "room_count_squared", "room_count_cubed",
         "room_count_fourth", "beds_log", "baths_log"]


@query("power_features")
def q_power_features(spark, sf_dir):
    out = fx.power_features(listings(spark, sf_dir))
    return out.select(*LISTING_KEY, *[r(c).alias(c) for c in POWER])


@query("amenity_features")
def q_amenity_features(spark, sf_dir):
    """F8/A18 on lineitem flags: discount and tax present, parking missing."""
    li = read_table(spark, sf_dir, "lineitem").select(
        *LISTING_KEY, F.col("l_discount").alias("amenity_Discount"), F.col("l_tax").alias("amenity_Tax"))
    out = fx.amenity_features(li, ["amenity_Discount", "amenity_Tax", "amenity_Parking"])
    return out.select(*LISTING_KEY, "has_discount", "has_tax", "has_parking", "amenity_count")


@query("leaky_features")
def q_leaky_features(spark, sf_dir):
    """F14 + W2: Rent_per_sqft and the target quartile with exact cut points."""
    from hearth.operators.split import attach_one_row, target_cuts
    df = listings(spark, sf_dir)
    out = attach_one_row(df, target_cuts(df))
    out = fx.leaky_features(out, F.col("_cuts"))
    return out.select(*LISTING_KEY, "Rent_per_sqft", "Rent_category")


@query("monthly_display")
def q_monthly_display(spark, sf_dir):
    """F15 + F18: monthly rent, '{:,.0f}' display text and the run-stamp format."""
    df = listings(spark, sf_dir, with_date=True)
    return df.select(*LISTING_KEY, r(fx.monthly("Rent")).alias("monthly_rent"),
                     fx.display_amount("Rent").alias("rent_display"),
                     fx.stamp("Posted_date").alias("stamp"))


# ---------------------------------------------------------------------------
# Group statistics and lookups
# ---------------------------------------------------------------------------


@query("region_stats")
def q_region_stats(spark, sf_dir):
    """A1 + A2 + J1 in-table: per-location mean/median/std of rent joined back."""
    out = st.region_features(cut_lineage(listings(spark, sf_dir)), region="Location", price="Rent")
    return out.select(*LISTING_KEY, "Location", *[r(c).alias(c) for c in
                      ("region_price_mean", "region_price_median", "region_price_std")])


def customer_requests(spark, sf_dir):
    """Request batch derived from the customer table (location = nation name)."""
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    c = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")  # 25 rows, fixed
    return c.select(
        "c_custkey",
        F.pmod("c_custkey", F.lit(7)).cast("int").alias("bedrooms"),
        (F.pmod("c_custkey", F.lit(4)) + 1).cast("int").alias("bathrooms"),
        (F.pmod("c_custkey", F.lit(50)) * 100 + 300).cast("double").alias("size"),
        F.col("n_name").alias("location"),
        (F.col("c_acctbal") > 5000).alias("has_pool"),
        (F.col("c_mktsegment") == "BUILDING").alias("has_gym"))


def train_region_means(spark, sf_dir):
    tr = split_listings(spark, sf_dir).filter(F.col("split") == "train")
    return tr.groupBy(F.col("Location").alias("region")).agg(F.avg("Rent").alias("region_price_mean"))


@query("region_lookup_default")
def q_region_lookup_default(spark, sf_dir):
    """Train region means looked up per request; unknown -> 100000."""
    out = st.region_lookup(customer_requests(spark, sf_dir), train_region_means(spark, sf_dir))
    return out.select("c_custkey", "location", r("region_price_mean").alias("region_price_mean"))


V62 = ["bedrooms", "bathrooms", "size", "region_price_mean", "log_size", "total_rooms",
       "price_per_sqft_est", "has_water_view", "has_parking", "has_pool", "has_gym",
       "has_balcony", "bed_size_interaction"]


@query("v62_features")
def q_v62_features(spark, sf_dir):
    """F12 for a whole request batch."""
    out = st.v62_features(customer_requests(spark, sf_dir), train_region_means(spark, sf_dir))
    return out.select("c_custkey", *[r(c).alias(c) if c in ("size", "region_price_mean", "log_size",
                                     "price_per_sqft_est", "bed_size_interaction") else F.col(c)
                                     for c in V62])


@query("market_means")
def q_market_means(spark, sf_dir):
    """The five market means from ONE grouping-sets pass over train rows."""
    tr = split_listings(spark, sf_dir).filter(F.col("split") == "train")
    g = (tr.groupingSets([["Location", "Type"], ["Location"], ["Furnishing"], ["Type"], []],
                         "Location", "Type", "Furnishing")
         .agg(F.grouping_id().alias("gid"), F.count("*").alias("n"), F.avg("Rent").alias("mean_rent")))
    level = (F.when(F.col("gid") == 1, "location_type").when(F.col("gid") == 3, "location")
             .when(F.col("gid") == 6, "furnishing").when(F.col("gid") == 5, "type").otherwise("global"))
    return g.select(level.alias("level"), "Location", "Type", "Furnishing", "n",
                    r("mean_rent").alias("mean_rent"))


def scored_listings(spark, sf_dir):
    """Listings with deterministic stand-in predictions from train statistics:
    location x type mean (-> location mean -> global), type mean, global mean,
    and their average as the 'blend'."""
    df = split_listings(spark, sf_dir)
    s = st.fit_listing_stats(df.filter(F.col("split") == "train"))
    out = (df.join(s.loc.select("_loc", "loc_mean_rent"), F.col("Location") == F.col("_loc"), "left")
             .drop("_loc")
             .join(s.loc_type, (F.col("Location") == F.col("_loc")) & (F.col("Type") == F.col("_typ")), "left")
             .drop("_loc", "_typ")
             .join(s.typ, F.col("Type") == F.col("_typ"), "left").drop("_typ")
             .join(s.furn, F.col("Furnishing") == F.col("_furn"), "left").drop("_furn"))
    g = F.lit(s.global_mean)
    lt = F.when(F.col("lt_mean_rent").isNull() | (F.col("lt_mean_rent") == 0), F.col("loc_mean_rent")) \
          .otherwise(F.col("lt_mean_rent"))
    out = out.withColumns({
        "pred_location_type": F.coalesce(lt, g),
        "pred_type": F.coalesce(F.col("type_mean_rent"), g),
        "pred_global": g.cast("double"),
        "pred_furnishing": F.coalesce(F.col("furn_mean_rent"), g),
    })
    out = out.withColumn("pred_blend", (F.col("pred_location_type") + F.col("pred_type")
                                        + F.col("pred_global")) / 3)
    return out.drop("loc_mean_rent", "lt_mean_rent", "type_mean_rent", "furn_mean_rent"), s


@query("market_comparison")
def q_market_comparison(spark, sf_dir):
    """Location average, type average and the prediction per row."""
    scored, s = scored_listings(spark, sf_dir)
    rows = scored.select(*LISTING_KEY, "Location", "Type", F.col("pred_blend").alias("prediction"))
    out = st.market_comparison(rows, s)
    return out.select(*LISTING_KEY, "Category", r("Price").alias("Price"))


@query("location_rank")
def q_location_rank(spark, sf_dir):
    """W1 in-table: share of the location's rows with a strictly smaller area."""
    from hearth.operators.joins import join_small
    from hearth.operators.ranks import value_ranks
    df = listings(spark, sf_dir)
    ranks = value_ranks(df, ["Location"], "Area_in_sqft").select(
        "Location", "Area_in_sqft", (F.col("below") / F.col("n")).alias("property_rank_in_location"))
    out = join_small(df, ranks, ["Location", "Area_in_sqft"], "left")
    return out.select(*LISTING_KEY, "Location", "Area_in_sqft",
                      r("property_rank_in_location").alias("property_rank_in_location"))


@query("rank_vs_reference")
def q_rank_vs_reference(spark, sf_dir):
    """W1 for requests: customer requests ranked against train listing areas."""
    df = split_listings(spark, sf_dir)
    s = st.fit_listing_stats(df.filter(F.col("split") == "train"))
    req = customer_requests(spark, sf_dir).select(
        "c_custkey", F.col("location").alias("Location"), F.col("size").alias("Area_in_sqft"))
    out = st.area_rank_share(req, s)
    return out.select("c_custkey", "Location", "Area_in_sqft",
                      r("property_rank_in_location").alias("property_rank_in_location"))


@query("category_values")
def q_category_values(spark, sf_dir):
    """Sorted distinct values of each categorical column (with position)."""
    from hearth.operators.encode import fit_vocabulary
    return fit_vocabulary(listings(spark, sf_dir))


# ---------------------------------------------------------------------------
# Profiles and audit aggregates
# ---------------------------------------------------------------------------

COLLISION_FEATURES = ["Location", "Type", "Furnishing", "Beds", "Baths", "Area_in_sqft"]
LISTING_COLUMNS = [*LISTING_KEY, "Location", "Type", "Furnishing", "Beds", "Baths", "Area_in_sqft", "Rent"]


def train_features(spark, sf_dir, materialise: bool = False):
    return featured_listings(spark, sf_dir, materialise).where(F.col("split") == "train")


@query("target_summary")
def q_target_summary(spark, sf_dir):
    out = pf.target_summary(listings(spark, sf_dir))
    return out.select("n", r("mean").alias("mean"), r("median").alias("median"), "min", "max")


@query("category_cardinality")
def q_category_cardinality(spark, sf_dir):
    return pf.category_cardinality(listings(spark, sf_dir), ["Location", "Type", "Furnishing"])


@query("null_counts")
def q_null_counts(spark, sf_dir):
    return pf.null_counts(listings(spark, sf_dir), LISTING_COLUMNS, keep_zero=True)


@query("non_finite_counts")
def q_non_finite_counts(spark, sf_dir):
    return pf.non_finite_counts(featured_listings(spark, sf_dir), NUMERIC_FEATURES)


@query("baseline_profile")
def q_baseline_profile(spark, sf_dir):
    out = pf.baseline_profile(train_features(spark, sf_dir, materialise=True), NUMERIC_FEATURES)
    return out.select("column", *[r(c).alias(c) for c in ("mean", "std", "min", "max", "q25", "q50", "q75")])


@query("split_shares")
def q_split_shares(spark, sf_dir):
    return pf.split_shares(split_listings(spark, sf_dir))


@query("split_mean_ratio")
def q_split_mean_ratio(spark, sf_dir):
    out = pf.split_mean_ratio(split_listings(spark, sf_dir))
    return out.select("split", r("mean").alias("mean"), r("ratio_to_train").alias("ratio_to_train"),
                      "within_tolerance")


@query("split_union")
def q_split_union(spark, sf_dir):
    """G1: train and test unioned by name (the serving table), rows per split."""
    df = split_listings(spark, sf_dir)
    both = sets.union_splits(df.where("split = 'train'"), df.where("split = 'test'"))
    return both.groupBy("split").agg(F.count("*").alias("rows"), r(F.avg("Rent")).alias("mean_rent"))


@query("split_overlap")
def q_split_overlap(spark, sf_dir):
    out = sets.split_overlap(split_listings(spark, sf_dir))
    return out.select("left", "right", "left_tuples", "overlap", r("share").alias("share"), "ok")


@query("feature_target_corr")
def q_feature_target_corr(spark, sf_dir):
    out = pf.feature_target_corr(train_features(spark, sf_dir), NUMERIC_FEATURES)
    return out.select("feature", r("corr").alias("corr"), "low_signal")


@query("pairwise_corr")
def q_pairwise_corr(spark, sf_dir):
    out = pf.pairwise_corr(train_features(spark, sf_dir, materialise=True), NUMERIC_FEATURES)
    return out.select("feature_a", "feature_b", r("corr").alias("corr"), "above_bound")


@query("top_correlated")
def q_top_correlated(spark, sf_dir):
    """The three features most correlated with the target."""
    out = pf.feature_target_corr(train_features(spark, sf_dir), NUMERIC_FEATURES)
    return out.orderBy(F.col("corr").desc(), "feature").limit(3).select("feature", r("corr").alias("corr"))


@query("samples_per_feature")
def q_samples_per_feature(spark, sf_dir):
    return pf.samples_per_feature(split_listings(spark, sf_dir).where("split = 'train'"), len(ALL_FEATURES))


@query("feature_collision")
def q_feature_collision(spark, sf_dir):
    return pf.feature_collision(listings(spark, sf_dir), COLLISION_FEATURES)


@query("contamination_check")
def q_contamination_check(spark, sf_dir):
    out = pf.contamination_check(split_listings(spark, sf_dir))
    return out.select("Location", *[r(c).alias(c) for c in
                      ("median_all", "median_train", "median_val", "median_test")])


# ---------------------------------------------------------------------------
# Splits, folds, samples, encodings
# ---------------------------------------------------------------------------

FOLD_SEED = 43   # folds hash with their own seed, independent of the split hash


@query("split_assign")
def q_split_assign(spark, sf_dir):
    """M1 + W2: strata (location class x target quartile), exact quotas per stratum."""
    df = sp.strata(cut_lineage(listings(spark, sf_dir)))
    out = sp.quota_split(df, LISTING_KEY)
    return out.select(*LISTING_KEY, "stratum", "split")


@query("stratum_shares")
def q_stratum_shares(spark, sf_dir):
    """M1: rows and split shares of each stratum of the exact-quota split."""
    df = sp.strata(cut_lineage(listings(spark, sf_dir)))
    out = pf.stratum_shares(sp.quota_split(df, LISTING_KEY))
    return out.select("stratum", "rows", *[c for n in ("train", "val", "test") for c in (f"{n}_rows", r(f"{n}_share").alias(f"{n}_share"))])


@query("split_tables")
def q_split_tables(spark, sf_dir):
    """S3: split tables written once; each split read back alone (the others are pruned)."""
    path = scratch_path(spark, "splits")
    sinks.write_splits(split_listings(spark, sf_dir), path)
    parts = [sinks.read_split(spark, path, n).groupBy("split").agg(
        F.count("*").alias("rows"), r(F.avg("Rent")).alias("mean_rent")) for n in ("train", "val", "test")]
    return parts[0].union(parts[1]).union(parts[2])


@query("csv_round_trip")
def q_csv_round_trip(spark, sf_dir):
    """S1 for CSV: the customer table written with a header and read with its schema."""
    path = scratch_path(spark, "csv")
    df = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    df.write.option("header", "true").csv(path)
    return read_csv_table(spark, path, df.schema)


@query("category_filter")
def q_category_filter(spark, sf_dir):
    """P5: the listings of one location and furnishing."""
    out = project.category_filter(listings(spark, sf_dir), Location="FRANCE", Furnishing="O")
    return out.select(*LISTING_KEY, "Type", "Rent")


@query("model_inputs")
def q_model_inputs(spark, sf_dir):
    """P2 + P3: listings without their keys, features apart from the target."""
    x, target = project.split_xy(project.drop_columns(listings(spark, sf_dir), LISTING_KEY))
    assert target not in x.columns
    return x


@query("fold_assign")
def q_fold_assign(spark, sf_dir):
    """M3 on the orders table (unique key)."""
    return sp.fold_assign(read_table(spark, sf_dir, "orders").select("o_orderkey"),
                          ["o_orderkey"], seed=FOLD_SEED)


@query("seeded_sample")
def q_seeded_sample(spark, sf_dir):
    """A 100-row seeded sample of the listing table (the sample is the feature)."""
    return sp.seeded_sample(listings(spark, sf_dir), LISTING_KEY, 100).select(*LISTING_KEY)


@query("one_hot")
def q_one_hot(spark, sf_dir):
    """E1 sparse: vocabulary fitted on train rows; every row's non-zero slots."""
    df = split_listings(spark, sf_dir, materialise=True)
    vocab = enc.fit_vocabulary(df.where("split = 'train'"))
    return enc.one_hot_long(df, vocab, LISTING_KEY)


@query("encoded_columns")
def q_encoded_columns(spark, sf_dir):
    """Encoded column names in model order (numeric first)."""
    df = split_listings(spark, sf_dir)
    names = enc.encoded_names(enc.fit_vocabulary(df.where("split = 'train'")))
    order = F.array_position(F.array(*[F.lit(c) for c in ("Location", "Type", "Furnishing")]), F.col("column"))
    return names.select("encoded_column", order.cast("int").alias("column_order"), "position")


@query("target_encode")
def q_target_encode(spark, sf_dir):
    """Smoothed target encoding fitted on train, applied to all rows."""
    df = split_listings(spark, sf_dir, materialise=True)
    table, prior = enc.fit_target_encoding(df.where("split = 'train'"))
    out = enc.apply_target_encoding(df, table, prior)
    return out.select(*LISTING_KEY, *[r(f"{c}_te").alias(f"{c}_te") for c in ("Location", "Type", "Furnishing")])


@query("target_encode_oof")
def q_target_encode_oof(spark, sf_dir):
    """E2 out-of-fold on train rows."""
    tr = sp.fold_assign(split_listings(spark, sf_dir, materialise=True).where("split = 'train'"), LISTING_KEY, seed=FOLD_SEED)
    out = enc.target_encode_oof(tr)
    return out.select(*LISTING_KEY, "fold",
                      *[r(f"{c}_te").alias(f"{c}_te") for c in ("Location", "Type", "Furnishing")])


# ---------------------------------------------------------------------------
# Evaluation and audits
# ---------------------------------------------------------------------------

BASE_MODELS = ["pred_location_type", "pred_type", "pred_furnishing", "pred_global"]
ENSEMBLE = "pred_blend"
METRIC_COLS = ["mae", "rmse", "r2", "mape", "corr"]


def scored(spark, sf_dir):
    return scored_listings(spark, sf_dir)[0]


@query("metrics_overall")
def q_metrics_overall(spark, sf_dir):
    """Q1 + Q2 + Q4: every stand-in model x split in one aggregate."""
    m = ev.metrics(scored(spark, sf_dir), BASE_MODELS + [ENSEMBLE])
    m = ev.meets_floors(m)
    return m.select("model", "split", "n", "missing", *[r(c).alias(c) for c in METRIC_COLS], "r2_ok", "corr_ok")


def segments(spark, sf_dir):
    return ev.segment_metrics(scored(spark, sf_dir), BASE_MODELS + [ENSEMBLE], ["Type", "Location"])


@query("metrics_by_segment")
def q_metrics_by_segment(spark, sf_dir):
    """Q3: metrics per Type and per Location."""
    return segments(spark, sf_dir).select("model", "split", "segment_kind", "segment", "n",
                                          *[r(c).alias(c) for c in METRIC_COLS])


@query("top_segments")
def q_top_segments(spark, sf_dir):
    """The ten best segments (lowest MAE) of the ensemble on test rows."""
    seg = segments(spark, sf_dir).where(f"model = '{ENSEMBLE}' AND split = 'test'")
    return ev.top_segments(seg, 10).select("segment_kind", "segment", "n", r("mae").alias("mae"))


def test_metrics(spark, sf_dir):
    m = ev.metrics(scored(spark, sf_dir), BASE_MODELS + [ENSEMBLE])
    return ev.rank_models(m, BASE_MODELS + [ENSEMBLE])


@query("best_model")
def q_best_model(spark, sf_dir):
    """Base model with the lowest test MAE (first in list order on ties)."""
    m = test_metrics(spark, sf_dir).where(f"split = 'test' AND model != '{ENSEMBLE}'")
    return ev.best_model(m).select("model", r("mae").alias("mae"))


@query("improvement")
def q_improvement(spark, sf_dir):
    """ensemble vs best base model on test rows."""
    m = ev.metrics(scored(spark, sf_dir), BASE_MODELS + [ENSEMBLE])
    out = ev.improvement_row(m, BASE_MODELS, ENSEMBLE)
    return out.select("best_base_model", *[r(c).alias(c) for c in
                      ("best_base_mae", "ensemble_mae", "improvement", "improvement_pct")], "verdict")


@query("acceptance")
def q_acceptance(spark, sf_dir):
    """Q5: ensemble metrics against the performance targets."""
    m = ev.metrics(scored(spark, sf_dir), [ENSEMBLE])
    vals = m.select(F.explode(F.array(
        F.struct(F.concat(F.col("split"), F.lit("_mae")).alias("metric"), F.col("mae").alias("value")),
        F.struct(F.concat(F.col("split"), F.lit("_r2")).alias("metric"), F.col("r2").alias("value")),
        F.struct(F.concat(F.col("split"), F.lit("_rmse")).alias("metric"), F.col("rmse").alias("value")),
    )).alias("s")).select("s.*")
    out = ev.acceptance(spark, vals)
    return out.select("metric", r("value").alias("value"), "bound", "direction", "passed", "range_min", "range_max", "in_range")


@query("error_bands")
def q_error_bands(spark, sf_dir):
    """F16: absolute error, error % and EXCELLENT/GOOD/WARNING band, per split."""
    e = fx.error_columns(scored(spark, sf_dir).withColumnRenamed(ENSEMBLE, "prediction"))
    out = ev.error_band_summary(e)
    return out.select("split", "band", "rows", r("mean_error_pct").alias("mean_error_pct"))


@query("prediction_sanity")
def q_prediction_sanity(spark, sf_dir):
    """Q11: predictions inside the sanity range and finite."""
    lo, hi = PREDICTION_RANGE
    rows = scored(spark, sf_dir)
    out = au.range_rules(rows, [(c, lo, hi) for c in BASE_MODELS + [ENSEMBLE]])
    nf = pf.non_finite_counts(rows, BASE_MODELS + [ENSEMBLE])
    return out.join(nf, "column").select("column", "violations", "rows", "nulls", "nans", "infs")


@query("range_rules")
def q_range_rules(spark, sf_dir):
    """Q7 on the modelling table."""
    return au.range_rules(featured_listings(spark, sf_dir), FEATURE_RANGES)


@query("validation_rules")
def q_validation_rules(spark, sf_dir):
    """Q7 hard/expected bounds on the raw-shaped table (annual rent as price)."""
    df = listings(spark, sf_dir).select(
        F.col("Rent").alias("price"), F.col("Area_in_sqft").alias("size"),
        F.col("Beds").alias("bedrooms"), F.col("Baths").alias("bathrooms"),
        fx.ratio("Rent", "Area_in_sqft").alias("price_per_sqft"))
    return au.validation_rules(df, VALIDATION_RULES)


@query("formula_check")
def q_formula_check(spark, sf_dir):
    """Q9: the features of a stored table re-derived, rtol 1e-5."""
    df = featured_listings(spark, sf_dir, materialise=True)
    return au.formula_check(df, {
        "log_area": F.log1p(F.col("Area_in_sqft")),
        "bath_bed_ratio": F.col("Baths") / (F.col("Beds") + 1),
        "area_per_bedroom": F.col("Area_in_sqft") / (F.col("Beds") + 1),
    })


@query("drift_check")
def q_drift_check(spark, sf_dir):
    """Q13: test-split feature means against the train baseline profile."""
    df = featured_listings(spark, sf_dir).where("split IN ('train', 'test')")
    prof = pf.moment_profile(df, NUMERIC_FEATURES, by=["split"])      # both profiles, one aggregate
    out = au.drift_check(prof.where("split = 'train'").drop("split"), prof.where("split = 'test'").drop("split"))
    return out.select("column", *[r(c).alias(c) for c in ("base_mean", "base_std", "current_mean", "shift")],
                      "drift")


@query("drift_psi")
def q_drift_psi(spark, sf_dir):
    """Q13 (PSI form): test-split feature distribution vs train quartile bins."""
    df = featured_listings(spark, sf_dir, materialise=True)
    out = au.psi(df.where("split = 'train'"), df.where("split = 'test'"), NUMERIC_FEATURES)
    return out.select("column", r("psi").alias("psi"))


@query("audit_report")
def q_audit_report(spark, sf_dir):
    """Q12: (check, status, value) rows: missing values, category values that the
    fitted encoder doesn't know, width of the fitted encoder, share of rows with a
    prediction error above 10 %."""
    df = featured_listings(spark, sf_dir)
    nulls = pf.null_counts(df, ALL_FEATURES + [TARGET], keep_zero=True).agg(
        F.sum("nulls").cast("double").alias("value")).select(
        F.lit("missing_values").alias("check"),
        F.when(F.col("value") > 0, "FAIL").otherwise("PASS").alias("status"), "value")
    rows = split_listings(spark, sf_dir)
    vocab = enc.fit_vocabulary(rows.where("split = 'train'"))
    values = enc.melt_categories(rows, CATEGORICAL).where("value is not null").distinct()
    mismatch = values.join(vocab, ["column", "value"], "left_anti").agg(F.count("*").cast("double").alias("value")).select(
        F.lit("unknown_categories").alias("check"), F.when(F.col("value") > 0, "WARN").otherwise("PASS").alias("status"), "value")
    width = vocab.where("position > 0").agg((F.count("*") + len(NUMERIC_FEATURES)).cast("double").alias("value")).select(
        F.lit("encoder_width").alias("check"),
        F.when(F.col("value") > len(NUMERIC_FEATURES), "PASS").otherwise("FAIL").alias("status"), "value")
    e = fx.error_columns(scored(spark, sf_dir).withColumnRenamed(ENSEMBLE, "prediction"))
    high = e.agg((F.avg((F.col("error_pct") > 10).cast("double"))).alias("value")).select(
        F.lit("high_error_share").alias("check"),
        F.when(F.col("value") > 0, "WARN").otherwise("PASS").alias("status"), r("value").alias("value"))
    return au.audit_report([nulls, mismatch, width, high])


# ---------------------------------------------------------------------------
# Prediction log
# ---------------------------------------------------------------------------


@query("prediction_hourly")
def q_prediction_hourly(spark, sf_dir):
    """Q14 batch: the events table as a prediction log, per hour and type."""
    out = hourly.hourly_summary(read_table(spark, sf_dir, "events"))
    return out.select("window_start", "event_type", "requests",
                      *[r(c).alias(c) for c in ("mean_prediction", "min_prediction", "max_prediction")])


@query("prediction_hourly_stream")
def q_prediction_hourly_stream(spark, sf_dir):
    """Q14 stream: the same summary via Structured Streaming."""
    path = os.path.join(sf_dir, "events*.parquet")
    schema = read_table(spark, sf_dir, "events").schema
    out = hourly.hourly_stream(spark, path, schema, scratch_path(spark, "hourly"))
    return out.select("window_start", "event_type", "requests",
                      *[r(c).alias(c) for c in ("mean_prediction", "min_prediction", "max_prediction")])


# ---------------------------------------------------------------------------
# Modelling (M4-M10, M6 sums) and run artefacts
# ---------------------------------------------------------------------------

META_XS = ["pred_location_type", "pred_type", "pred_furnishing"]


def stand_in_meta(spark, sf_dir):
    """Train rows with the stand-in predictions as meta-features and folds."""
    tr = scored(spark, sf_dir).where("split = 'train'")
    tr = sp.fold_assign(tr, LISTING_KEY, seed=FOLD_SEED, name="fold")
    return sp.fold_assign(tr, LISTING_KEY, seed=FOLD_SEED + 1, name="cv_fold")


@query("ridge_sums")
def q_ridge_sums(spark, sf_dir):
    """M6 sufficient statistics per fold: n and means of x, y, x*x', x*y, with
    rents in thousands (so the compared products stay within double precision)."""
    meta = stand_in_meta(spark, sf_dir).select(
        "fold", *[(F.col(c) / 1000).alias(c) for c in META_XS + [TARGET]])
    sums = stacking.moment_sums(meta, META_XS, TARGET, "fold")
    means = [r(F.col(c) / F.col("n")).alias(c.replace("s_", "mean_", 1)) for c in sums.columns if c.startswith("s_")]
    return sums.select("fold", "n", *means)


@query("ridge_fit")
def q_ridge_fit(spark, sf_dir):
    """M7 + M6: alpha by CV MAE, coefficients on all train rows (stand-in meta).
    Long form: (section, name, value, chosen) for cv scores and coefficients; rents are
    rounded to 3 places."""
    rd_ = stacking.fit_ridge(stand_in_meta(spark, sf_dir), META_XS)
    rows = [("cv_mae", f"alpha={a}", round(float(m), 3), float(a) == rd_.alpha) for a, m in sorted(rd_.cv_mae.items())]
    rows += [("coef", "intercept", round(rd_.intercept, 3), True)]
    rows += [("coef", x, round(float(w), ROUND), True) for x, w in zip(rd_.xs, rd_.coef)]
    return spark.createDataFrame(rows, "section STRING, name STRING, value DOUBLE, chosen BOOLEAN")


#: The training queries grow fewer and shallower trees than the tuned settings, which remain the
#: defaults of ``boosting.tuned_learners``; all other tuned values hold.
QUERY_TREES, QUERY_DEPTH = 10, 5


def _learners() -> dict:
    return boosting.tuned_learners(trees=QUERY_TREES, max_depth=QUERY_DEPTH)


def _stacked(spark, sf_dir):
    return stacking.train_boosted(split_listings(spark, sf_dir, materialise=True), LISTING_KEY, learners=_learners())


@query("oof_stack")
def q_oof_stack(spark, sf_dir):
    """M5: out-of-fold predictions of the three boosted learners (train rows), with QUERY_TREES trees
    of QUERY_DEPTH; all folds of all learners grow in the same passes."""
    _, meta = _stacked(spark, sf_dir)
    return meta.select(*LISTING_KEY, "fold", TARGET, *[f"pred_{n}" for n in _learners()])


@query("stacked_metrics")
def q_stacked_metrics(spark, sf_dir):
    """M9 + Q1: boosted learners (QUERY_TREES trees of QUERY_DEPTH) and the stacked ridge on val/test rows."""
    df = split_listings(spark, sf_dir, materialise=True)
    model, _ = stacking.train_boosted(df, LISTING_KEY, learners=_learners())
    out = model.score(df.where("split != 'train'"))
    return ev.metrics(out, [*model.ridge.xs, "prediction"])


@query("batch_score")
def q_batch_score(spark, sf_dir):
    """All raw request rows (customers) scored end to end by a model with QUERY_TREES
    trees of QUERY_DEPTH; types and furnishings it doesn't know are allowed."""
    model, _ = _stacked(spark, sf_dir)
    out = model.score(model_requests(customer_requests(spark, sf_dir)))
    return out.select("c_custkey", "Location", "Type", "Furnishing", "prediction",
                      (F.col("prediction") / 12).alias("monthly_prediction"))


def model_requests(requests):
    """Request rows in the model's columns."""
    return requests.select(
        "c_custkey", F.col("location").alias("Location"),
        F.when(F.col("has_gym"), "STANDARD POLISHED TIN").otherwise("OTHER").alias("Type"),
        F.when(F.col("has_pool"), "F").otherwise("O").alias("Furnishing"),
        F.col("bedrooms").alias("Beds"), F.col("bathrooms").alias("Baths"), F.col("size").alias("Area_in_sqft"))


@query("score_stream")
def q_score_stream(spark, sf_dir):
    """M10 + S5 + S7: the requests of ``batch_score`` as a stream of files, scored by a saved bundle
    and logged once each."""
    model, _ = _stacked(spark, sf_dir)
    root, work = scratch_path(spark, "bundles"), scratch_path(spark, "stream")
    sinks.save_stacked_versions(model, root, "20250101_000000")
    requests = model_requests(customer_requests(spark, sf_dir))
    requests.write.parquet(f"{work}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{work}/in").schema).parquet(f"{work}/in")
    scoring.score_stream(stream, root, f"{work}/log", "requests", f"{work}/state", ["c_custkey", "Location", "Type", "Furnishing"])
    return sinks.read_log(spark, f"{work}/log", "requests").select(
        "c_custkey", "Location", "Type", "Furnishing", "prediction", (F.col("prediction") / 12).alias("monthly_prediction"))


#: Grid of the search query: settings of each learner that are tried, on top of the tuned ones.
GRID = {"depthwise": {"max_depth": [3, 5], "learning_rate": [0.05, 0.3]}, "leafwise": {"max_depth": [5], "num_leaves": [8, 24]},
        "symmetric": {"max_depth": [3, 5]}}
RUNGS = (2, 5)


@query("grid_search")
def q_grid_search(spark, sf_dir, grid=GRID, rungs=RUNGS):
    """M8: every learner's grid (QUERY_TREES trees) grown together on one binned table; after each
    number of trees in RUNGS the better half by MAE on the val split goes on."""
    listed = split_listings(spark, sf_dir, materialise=True)
    df = add_listing_features(listed, fit_listing_stats(listed.where(F.col("split") == "train"))).where("split in ('train', 'val')")
    df = cut_lineage(df.select(*LISTING_KEY, TARGET, *ALL_FEATURES, F.when(F.col("split") == "val", boosting.VALIDATION).otherwise(0).alias("fold")))
    drop_table(listed)
    tuned, candidates = _learners(), {}
    for learner, settings in grid.items():
        for values in itertools.product(*settings.values()):
            tried = dict(zip(settings, values))
            candidates[f"{learner}: {', '.join(f'{k}={v}' for k, v in tried.items())}"] = replace(tuned[learner], **tried)
    binner = boosting.fit_binner(df.where(F.col("fold") == 0))
    packed = boosting.pack(df, binner, LISTING_KEY)
    drop_table(df)
    found = boosting.halving_search(packed, candidates, rungs)
    drop_table(packed.blocks)
    rows = [(*r["name"].split(": ", 1), r["trees"], float(r["val_mae"]), r["rank"]) for r in found]
    return spark.createDataFrame(rows, "learner STRING, parameters STRING, trees INT, val_mae DOUBLE, rank INT")


@query("root_splits")
def q_root_splits(spark, sf_dir):
    """M4 + M5: the best first split by each of five columns, with the tuned penalties, of the model of all
    train rows (held_out -1) and of each fold's; the gain as what it takes off the root mean square."""
    tr = split_listings(spark, sf_dir).where("split = 'train'")
    tr = cut_lineage(sp.fold_assign(tr, LISTING_KEY, seed=FOLD_SEED).select(*LISTING_KEY, "fold", TARGET, "Beds", "Baths", *CATEGORICAL))
    params = _learners()["depthwise"]
    models = [boosting.Model("m", params, k) for k in (None, *range(N_FOLDS))]
    binner = boosting.fit_binner(tr, ["Beds", "Baths"])
    out = boosting.root_splits(boosting.pack(tr, binner, LISTING_KEY), models)
    return out.select(F.coalesce("held_out", F.lit(-1)).alias("held_out"), "feature", "split_at", r(F.sqrt(2 * F.col("gain") / (F.col("left_rows") + F.col("right_rows")))).alias("rms_gain"),
                      "left_rows", "right_rows")


@query("target_encode_ordered")
def q_target_encode_ordered(spark, sf_dir):
    """E2 ordered: statistics of the train rows before each one, along a hash of its key."""
    tr = split_listings(spark, sf_dir).where("split = 'train'")
    out = enc.target_encode_ordered(tr, LISTING_KEY, seed=FOLD_SEED)
    # running sums of floats in another order: three places
    return out.select(*LISTING_KEY, *[r(f"{c}_ots", 3).alias(f"{c}_ots") for c in CATEGORICAL])


@query("run_metadata")
def q_run_metadata(spark, sf_dir):
    """One run-metadata row (counts per split, manifest, removed columns, metrics)."""
    run_metadata = sinks.run_metadata
    df = featured_listings(spark, sf_dir)
    counts = df.groupBy("split").agg(F.count("*").alias("rows"))
    removed = sorted(set(df.columns) - set([TARGET] + ALL_FEATURES))
    allm = ev.metrics(scored(spark, sf_dir), BASE_MODELS + [ENSEMBLE])
    m = allm.where(f"split = 'test' AND model = '{ENSEMBLE}'").first()
    imp = ev.improvement_row(allm, BASE_MODELS, ENSEMBLE).first().asDict()
    return run_metadata(counts, ALL_FEATURES, removed, {"test_mae": m["mae"], "test_r2": m["r2"]},
                        improvement=imp, overlap=sets.split_overlap(split_listings(spark, sf_dir)))


@query("prediction_log")
def q_prediction_log(spark, sf_dir):
    """Scored rows (stand-in ensemble) appended to a prediction log, a batch a split, the first batch
    twice as after a failure, and read back."""
    sc = cut_lineage(scored(spark, sf_dir).withColumnRenamed(ENSEMBLE, "prediction"))
    path = scratch_path(spark, "log")
    for number, split in enumerate(("train", "val", "test", "train")):
        own = sinks.prediction_log(sc.where(F.col("split") == split), ["Location", "Type", "Area_in_sqft", "Beds"])
        sinks.append_log(own, path, "run-1", number % 3)
    return sinks.read_log(spark, path, "run-1").select(r("prediction").alias("prediction"), "Location", "Type", "Area_in_sqft", "Beds")
