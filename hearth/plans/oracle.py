"""DuckDB SQL for every oracle-checkable query in ``hearth.plans.catalog``.

The SQL is written independently of the Spark plans (plain joins, GROUP BY,
window functions and quantile_cont), over the pre-registered views of the
given tables.
"""

from __future__ import annotations

from hearth.constants import ROUND
from hearth.functions.hashing import sql_bucket32
from hearth.sources.tables import LISTING_KEY, LISTINGS_SQL

ORACLE: dict[str, str] = {}

H = sql_bucket32(LISTING_KEY, 42)
H60 = sql_bucket32(LISTING_KEY, 42, 15)

SPLIT_SQL = f"""
split_rows AS (
  SELECT *, CASE WHEN {H} / 4294967296.0 < 0.7 THEN 'train'
                 WHEN {H} / 4294967296.0 < 0.85 THEN 'val' ELSE 'test' END AS split
  FROM listings
),
tr AS (SELECT * FROM split_rows WHERE split = 'train')"""

STATS_SQL = """
g AS (SELECT avg(Rent) AS gm FROM tr),
loc AS (SELECT Location, count(*) AS n, avg(Area_in_sqft) AS ma,
               stddev_samp(Area_in_sqft) AS sa, avg(Rent) AS mr FROM tr GROUP BY Location),
lt AS (SELECT Location, Type, avg(Rent) AS mr FROM tr GROUP BY Location, Type),
fu AS (SELECT Furnishing, avg(Rent) AS mr FROM tr GROUP BY Furnishing),
ty AS (SELECT Type, avg(Rent) AS mr FROM tr GROUP BY Type),
hist AS (SELECT Location, Area_in_sqft, count(*) AS c FROM tr GROUP BY Location, Area_in_sqft),
probe AS (SELECT DISTINCT Location, Area_in_sqft FROM split_rows),
rk AS (SELECT p.Location, p.Area_in_sqft, coalesce(sum(h.c), 0) AS below
       FROM probe p LEFT JOIN hist h
         ON h.Location = p.Location AND h.Area_in_sqft < p.Area_in_sqft
       GROUP BY p.Location, p.Area_in_sqft),
feat AS (
  SELECT s.*,
    ln(1 + s.Area_in_sqft) AS log_area,
    CASE WHEN loc.n > 0 THEN rk.below / loc.n ELSE 0.5 END AS property_rank_in_location,
    CASE WHEN loc.sa > 0 THEN (s.Area_in_sqft - loc.ma) / loc.sa ELSE 0.0 END
      AS area_deviation_from_location,
    CASE WHEN g.gm > 0 THEN coalesce(
      (CASE WHEN lt.mr IS NULL OR lt.mr = 0 THEN loc.mr ELSE lt.mr END) / g.gm, 1.0)
      ELSE 1.0 END AS location_type_premium,
    CASE WHEN g.gm > 0 THEN coalesce(fu.mr / g.gm, 1.0) ELSE 1.0 END AS furnishing_type_premium,
    s.Baths / (s.Beds + 1) AS bath_bed_ratio,
    s.Area_in_sqft / (s.Beds + 1) AS area_per_bedroom,
    CASE WHEN g.gm > 0 THEN coalesce(ty.mr / g.gm, 1.0) ELSE 1.0 END AS type_room_premium
  FROM split_rows s
  CROSS JOIN g
  LEFT JOIN loc ON loc.Location = s.Location
  LEFT JOIN lt ON lt.Location = s.Location AND lt.Type = s.Type
  LEFT JOIN fu ON fu.Furnishing = s.Furnishing
  LEFT JOIN ty ON ty.Type = s.Type
  LEFT JOIN rk ON rk.Location = s.Location AND rk.Area_in_sqft = s.Area_in_sqft
)"""

BASE = f"WITH {LISTINGS_SQL},{SPLIT_SQL}"
FEAT = f"{BASE},{STATS_SQL}"

KEYS = ", ".join(LISTING_KEY)
DERIVED = ["log_area", "property_rank_in_location", "area_deviation_from_location",
           "location_type_premium", "furnishing_type_premium", "bath_bed_ratio",
           "area_per_bedroom", "type_room_premium"]


def rd(expr: str, alias: str | None = None, places: int = ROUND) -> str:
    # "+ 0.0" turns a rounded -0.0 into 0.0, as Spark's decimal rounding gives.
    return f"round(CAST({expr} AS DOUBLE), {places}) + 0.0 AS {alias or expr}"


ORACLE["listing_features"] = f"""{FEAT}
SELECT {KEYS}, split, Location, Type, Furnishing, Beds, Baths, Area_in_sqft,
       {', '.join(rd(c) for c in DERIVED)}, Rent
FROM feat"""


def keyed(select: str, src: str = "listings") -> str:
    return f"{BASE}\nSELECT {KEYS}, {select} FROM {src}"


ORACLE["feature_select"] = f"""{FEAT}
SELECT Rent, Beds, Baths, Area_in_sqft, {', '.join(rd(c) for c in DERIVED[:5])},
       {', '.join(rd(c) for c in DERIVED[5:])}, Location, Type, Furnishing
FROM feat"""

ORACLE["raw_normalise"] = f"""{BASE},
raw AS (SELECT {KEYS}, Rent / 12 AS price,
               CASE WHEN Beds = 0 THEN 'Studio' ELSE CAST(Beds AS VARCHAR) END AS bedrooms,
               Baths AS bathrooms, Area_in_sqft AS size, Location AS location,
               Type AS property_type, Furnishing AS furnished FROM listings)
SELECT {KEYS},
       CASE WHEN lower(trim(bedrooms)) = 'studio' THEN 0 ELSE TRY_CAST(trim(bedrooms) AS INTEGER) END AS Beds,
       bathrooms AS Baths, size AS Area_in_sqft, location AS Location, property_type AS Type,
       furnished AS Furnishing, {rd('price * 12', 'Rent')}
FROM raw"""

ORACLE["clean_range"] = f"""{BASE}
SELECT {KEYS}, Rent AS price, Area_in_sqft AS size, Beds AS bedrooms, Baths AS bathrooms
FROM listings
WHERE Rent BETWEEN 25000 AND 450000 AND Area_in_sqft BETWEEN 250 AND 5000
  AND Rent / Area_in_sqft BETWEEN 40 AND 300 AND Beds <= 6 AND Baths <= 8"""

ORACLE["log_features"] = keyed(", ".join([rd("ln(1 + Area_in_sqft)", "log_Area_in_sqft"),
                                          rd("ln(1 + Rent)", "log_Rent"), rd("ln(1 + Beds)", "log_Beds")]))

ORACLE["interaction_features"] = keyed(
    "Beds * Baths AS Beds_Baths_interaction, " + rd("Beds * Area_in_sqft", "Beds_Area_in_sqft_interaction"))

ORACLE["room_ratios"] = keyed(rd("Baths / (Beds + 1)", "bath_bed_ratio") + ", "
                              + rd("Area_in_sqft / (Beds + 1)", "area_per_bedroom"))

ORACLE["property_features"] = keyed("Beds + Baths AS total_rooms, Rent / Area_in_sqft AS price_per_sqft"
                                    + ", " + rd("Beds * ln(1 + Area_in_sqft)", "bed_size_interaction"))

ORACLE["power_features"] = keyed(", ".join([
    rd("pow(Area_in_sqft, 2)", "area_squared"), rd("pow(Area_in_sqft, 3)", "area_cubed"),
    rd("pow(Area_in_sqft, 4)", "area_fourth_power"), rd("pow(Beds, 2)", "beds_squared"),
    rd("pow(Beds, 3)", "beds_cubed"), rd("pow(Baths, 2)", "baths_squared"), rd("pow(Baths, 3)", "baths_cubed"),
    rd("Beds + Baths", "room_count"), rd("pow(Beds + Baths, 2)", "room_count_squared"),
    rd("pow(Beds + Baths, 3)", "room_count_cubed"), rd("pow(Beds + Baths, 4)", "room_count_fourth"),
    rd("ln(1 + Beds)", "beds_log"), rd("ln(1 + Baths)", "baths_log")]))

ORACLE["amenity_features"] = f"""
SELECT {KEYS}, CAST(l_discount > 0 AS INTEGER) AS has_discount, CAST(l_tax > 0 AS INTEGER) AS has_tax,
       0 AS has_parking, CAST(l_discount > 0 AS INTEGER) + CAST(l_tax > 0 AS INTEGER) AS amenity_count
FROM lineitem"""

ORACLE["leaky_features"] = f"""{BASE},
cuts AS (SELECT quantile_cont(Rent, 0.25) AS c25, quantile_cont(Rent, 0.5) AS c50,
                quantile_cont(Rent, 0.75) AS c75 FROM listings)
SELECT {KEYS}, Rent / Area_in_sqft AS Rent_per_sqft,
       1 + CAST(Rent > c25 AS INTEGER) + CAST(Rent > c50 AS INTEGER) + CAST(Rent > c75 AS INTEGER)
         AS Rent_category
FROM listings CROSS JOIN cuts"""

ORACLE["monthly_display"] = keyed(rd("Rent / 12", "monthly_rent")
                                  + ", format('{:,.0f}', Rent) AS rent_display"
                                  + ", strftime(Posted_date, '%Y%m%d_%H%M%S') AS stamp")

ORACLE["region_stats"] = f"""{BASE},
rs AS (SELECT Location, avg(Rent) AS m, quantile_cont(Rent, 0.5) AS md, stddev_samp(Rent) AS sd
       FROM listings GROUP BY Location),
gs AS (SELECT avg(Rent) AS gm, quantile_cont(Rent, 0.5) AS gmd, stddev_samp(Rent) AS gsd FROM listings)
SELECT {', '.join('l.' + k for k in LISTING_KEY)}, l.Location,
       {rd('coalesce(rs.m, gs.gm)', 'region_price_mean')},
       {rd('coalesce(rs.md, gs.gmd)', 'region_price_median')},
       {rd('coalesce(rs.sd, gs.gsd)', 'region_price_std')}
FROM listings l LEFT JOIN rs ON rs.Location = l.Location CROSS JOIN gs"""

REQ_SQL = """
req AS (SELECT c_custkey, CAST(c_custkey % 7 AS INTEGER) AS bedrooms,
               CAST(c_custkey % 4 + 1 AS INTEGER) AS bathrooms,
               CAST(c_custkey % 50 * 100 + 300 AS DOUBLE) AS size, n_name AS location,
               c_acctbal > 5000 AS has_pool, c_mktsegment = 'BUILDING' AS has_gym
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
rm AS (SELECT Location AS region, avg(Rent) AS region_price_mean FROM tr GROUP BY Location),
reqm AS (SELECT req.*, coalesce(rm.region_price_mean, 100000) AS rpm
         FROM req LEFT JOIN rm ON req.location = rm.region)"""

ORACLE["region_lookup_default"] = f"""{BASE},{REQ_SQL}
SELECT c_custkey, location, {rd('rpm', 'region_price_mean')} FROM reqm"""

ORACLE["v62_features"] = f"""{BASE},{REQ_SQL}
SELECT c_custkey, bedrooms, bathrooms, {rd('size')}, {rd('rpm', 'region_price_mean')},
       {rd('ln(1 + size)', 'log_size')}, bedrooms + bathrooms AS total_rooms,
       {rd('rpm / size', 'price_per_sqft_est')}, 0 AS has_water_view, 0 AS has_parking,
       CAST(has_pool AS INTEGER) AS has_pool, CAST(has_gym AS INTEGER) AS has_gym,
       0 AS has_balcony, {rd('bedrooms * ln(1 + size)', 'bed_size_interaction')}
FROM reqm"""

ORACLE["market_means"] = f"""{BASE}
SELECT 'location_type' AS level, Location, Type, CAST(NULL AS VARCHAR) AS Furnishing,
       count(*) AS n, {rd('avg(Rent)', 'mean_rent')} FROM tr GROUP BY Location, Type
UNION ALL
SELECT 'location', Location, NULL, NULL, count(*), round(avg(Rent), {ROUND}) + 0.0 FROM tr GROUP BY Location
UNION ALL
SELECT 'furnishing', NULL, NULL, Furnishing, count(*), round(avg(Rent), {ROUND}) + 0.0 FROM tr GROUP BY Furnishing
UNION ALL
SELECT 'type', NULL, Type, NULL, count(*), round(avg(Rent), {ROUND}) + 0.0 FROM tr GROUP BY Type
UNION ALL
SELECT 'global', NULL, NULL, NULL, count(*), round(avg(Rent), {ROUND}) + 0.0 FROM tr"""

SCORED_SQL = """
sc AS (
  SELECT s.*, loc.mr AS loc_mr, ty.mr AS ty_mr,
    coalesce(CASE WHEN lt.mr IS NULL OR lt.mr = 0 THEN loc.mr ELSE lt.mr END, g.gm) AS pred_location_type,
    coalesce(ty.mr, g.gm) AS pred_type, g.gm AS pred_global
  FROM split_rows s CROSS JOIN g
  LEFT JOIN loc ON loc.Location = s.Location
  LEFT JOIN lt ON lt.Location = s.Location AND lt.Type = s.Type
  LEFT JOIN ty ON ty.Type = s.Type
),
scored AS (SELECT *, (pred_location_type + pred_type + pred_global) / 3 AS pred_blend FROM sc)"""

ORACLE["market_comparison"] = f"""{FEAT},{SCORED_SQL}
SELECT {KEYS}, 'Location Average' AS Category, {rd('loc_mr', 'Price')} FROM scored
UNION ALL
SELECT {KEYS}, 'Property Type Average', round(ty_mr, {ROUND}) + 0.0 FROM scored
UNION ALL
SELECT {KEYS}, 'Your Prediction', round(pred_blend, {ROUND}) + 0.0 FROM scored"""

ORACLE["location_rank"] = f"""{BASE},
h AS (SELECT Location, Area_in_sqft, count(*) AS c FROM listings GROUP BY Location, Area_in_sqft),
cum AS (SELECT Location, Area_in_sqft,
               coalesce(sum(c) OVER (PARTITION BY Location ORDER BY Area_in_sqft
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
               sum(c) OVER (PARTITION BY Location) AS n FROM h)
SELECT {', '.join('l.' + k for k in LISTING_KEY)}, l.Location, l.Area_in_sqft,
       {rd('cum.below / cum.n', 'property_rank_in_location')}
FROM listings l JOIN cum ON cum.Location = l.Location AND cum.Area_in_sqft = l.Area_in_sqft"""

ORACLE["rank_vs_reference"] = f"""{FEAT},{REQ_SQL},
b AS (SELECT r.c_custkey, sum(h.c) AS below FROM req r
      JOIN hist h ON h.Location = r.location AND h.Area_in_sqft < r.size GROUP BY r.c_custkey)
SELECT r.c_custkey, r.location AS Location, r.size AS Area_in_sqft,
       {rd('CASE WHEN loc.n > 0 THEN coalesce(b.below, 0) / loc.n ELSE 0.5 END', 'property_rank_in_location')}
FROM req r LEFT JOIN loc ON loc.Location = r.location LEFT JOIN b ON b.c_custkey = r.c_custkey"""

ORACLE["category_values"] = f"""{BASE},
v AS (SELECT DISTINCT 'Location' AS "column", Location AS value FROM listings
      UNION SELECT DISTINCT 'Type', Type FROM listings
      UNION SELECT DISTINCT 'Furnishing', Furnishing FROM listings)
SELECT "column", value,
       CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER) AS position
FROM v"""


NUMERIC = ["Beds", "Baths", "Area_in_sqft", *DERIVED]
CATS = ["Location", "Type", "Furnishing"]
LISTING_COLUMNS = [*LISTING_KEY, "Location", "Type", "Furnishing", "Beds", "Baths", "Area_in_sqft", "Rent"]
COLLISION = ["Location", "Type", "Furnishing", "Beds", "Baths", "Area_in_sqft"]
TRF = "(SELECT * FROM feat WHERE split = 'train')"


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


ORACLE["target_summary"] = f"""{BASE}
SELECT count(Rent) AS n, {rd('avg(Rent)', 'mean')}, {rd('quantile_cont(Rent, 0.5)', 'median')},
       min(Rent) AS min, max(Rent) AS max FROM listings"""

ORACLE["category_cardinality"] = BASE + "\n" + union(
    [f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM listings" for c in CATS])

ORACLE["null_counts"] = BASE + "\n" + union(
    [f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM listings"
     for c in LISTING_COLUMNS])

ORACLE["non_finite_counts"] = FEAT + "\n" + union(
    [f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS nulls, "
     f"CAST(count_if(isnan({c})) AS BIGINT) AS nans, CAST(count_if(isinf({c})) AS BIGINT) AS infs FROM feat" for c in NUMERIC])

ORACLE["baseline_profile"] = FEAT + "\n" + union(
    [f"SELECT '{c}' AS \"column\", {rd(f'avg({c})', 'mean')}, {rd(f'stddev_samp({c})', 'std')}, "
     f"{rd(f'min({c})', 'min')}, {rd(f'max({c})', 'max')}, {rd(f'quantile_cont({c}, 0.25)', 'q25')}, "
     f"{rd(f'quantile_cont({c}, 0.5)', 'q50')}, {rd(f'quantile_cont({c}, 0.75)', 'q75')} FROM {TRF}"
     for c in NUMERIC])

ORACLE["split_shares"] = f"""{BASE}
SELECT split, count(*) AS rows, count(*) / sum(count(*)) OVER () AS share,
       CASE split WHEN 'train' THEN count(*) / sum(count(*)) OVER () BETWEEN 0.60 AND 0.75
                  WHEN 'val' THEN count(*) / sum(count(*)) OVER () BETWEEN 0.10 AND 0.20
                  WHEN 'test' THEN count(*) / sum(count(*)) OVER () BETWEEN 0.15 AND 0.25 END AS within_bounds
FROM split_rows GROUP BY split"""

ORACLE["split_tables"] = f"""{BASE}
SELECT split, count(*) AS rows, {rd('avg(Rent)', 'mean_rent')} FROM split_rows GROUP BY split"""

ORACLE["csv_round_trip"] = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"

ORACLE["category_filter"] = f"""{BASE}
SELECT {KEYS}, Type, Rent FROM listings WHERE Location = 'FRANCE' AND Furnishing = 'O'"""

ORACLE["model_inputs"] = f"""{BASE}
SELECT Location, Type, Furnishing, Beds, Baths, Area_in_sqft FROM listings"""

ORACLE["split_mean_ratio"] = f"""{BASE},
m AS (SELECT split, avg(Rent) AS mean FROM split_rows GROUP BY split),
b AS (SELECT mean AS bm FROM m WHERE split = 'train')
SELECT split, {rd('mean')}, {rd('mean / bm', 'ratio_to_train')},
       mean / bm >= 0.9 AND mean / bm <= 1.1 AS within_tolerance FROM m CROSS JOIN b"""

ORACLE["split_union"] = f"""{BASE}
SELECT split, count(*) AS rows, {rd('avg(Rent)', 'mean_rent')} FROM split_rows
WHERE split IN ('train', 'test') GROUP BY split"""

OV = ", ".join(["Location", "Type", "Beds", "Baths", "Area_in_sqft", "Rent"])
ORACLE["split_overlap"] = f"""{BASE},
t AS (SELECT {OV}, max(CAST(split = 'train' AS INTEGER)) AS a, max(CAST(split = 'val' AS INTEGER)) AS v,
             max(CAST(split = 'test' AS INTEGER)) AS te FROM split_rows GROUP BY {OV}),
w AS (SELECT sum(a) AS na, sum(v) AS nv, sum(te) AS nte, sum(a * v) AS oav, sum(a * te) AS oat,
             sum(v * te) AS ovt FROM t),
p AS (SELECT 'train' AS "left", 'val' AS "right", na AS lt, oav AS ov FROM w
      UNION ALL SELECT 'train', 'test', na, oat FROM w
      UNION ALL SELECT 'val', 'test', nv, ovt FROM w)
SELECT "left", "right", CAST(lt AS BIGINT) AS left_tuples, CAST(ov AS BIGINT) AS overlap,
       {rd('ov / lt', 'share')}, ov / lt < 0.3 AS ok FROM p"""

ORACLE["feature_target_corr"] = FEAT + "\n" + union(
    [f"SELECT '{c}' AS feature, {rd(f'corr({c}, Rent)', 'corr')}, abs(corr({c}, Rent)) < 0.1 AS low_signal "
     f"FROM {TRF}" for c in NUMERIC])

PAIRS = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:]]
ORACLE["pairwise_corr"] = FEAT + "\n" + union(
    [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {rd(f'corr({a}, {b})', 'corr')}, "
     f"abs(corr({a}, {b})) >= 0.9 AS above_bound FROM {TRF}" for a, b in PAIRS])

ORACLE["top_correlated"] = FEAT + ",\nc AS (" + union(
    [f"SELECT '{c}' AS feature, corr({c}, Rent) AS corr FROM {TRF}" for c in NUMERIC]) + \
    f")\nSELECT feature, {rd('corr')} FROM c ORDER BY corr DESC, feature LIMIT 3"

ORACLE["samples_per_feature"] = f"""{BASE}
SELECT count(*) AS rows, count(*) / 14.0 AS samples_per_feature FROM tr"""

CF = ", ".join(COLLISION)
ORACLE["feature_collision"] = f"""{BASE},
bt AS (SELECT {CF}, Rent, count(*) AS c FROM listings GROUP BY {CF}, Rent),
bf AS (SELECT {CF}, sum(c) AS r, count(*) AS targets, sum(c - 1) AS d FROM bt GROUP BY {CF})
SELECT CAST(sum(r) AS BIGINT) AS rows, count(*) AS feature_tuples, CAST(sum(d) AS BIGINT) AS duplicate_rows,
       CAST(sum(CASE WHEN targets > 1 THEN r ELSE 0 END) AS BIGINT) AS conflicting_rows,
       CAST(count_if(targets > 1) AS BIGINT) AS conflicting_tuples FROM bf"""

ORACLE["contamination_check"] = f"""{BASE}
SELECT Location, {rd('quantile_cont(Area_in_sqft, 0.5)', 'median_all')},
       {rd("quantile_cont(Area_in_sqft, 0.5) FILTER (WHERE split = 'train')", 'median_train')},
       {rd("quantile_cont(Area_in_sqft, 0.5) FILTER (WHERE split = 'val')", 'median_val')},
       {rd("quantile_cont(Area_in_sqft, 0.5) FILTER (WHERE split = 'test')", 'median_test')}
FROM split_rows GROUP BY Location"""

ORACLE["split_assign"] = f"""{BASE},
lc AS (SELECT Location, count(*) AS n FROM listings GROUP BY Location),
cuts AS (SELECT quantile_cont(Rent, 0.25) AS c25, quantile_cont(Rent, 0.5) AS c50,
                quantile_cont(Rent, 0.75) AS c75 FROM listings),
st AS (SELECT l.*, concat_ws('#', CASE WHEN lc.n >= 10 THEN l.Location ELSE '__rare__' END,
              CAST(1 + CAST(Rent > c25 AS INTEGER) + CAST(Rent > c50 AS INTEGER) + CAST(Rent > c75 AS INTEGER)
                   AS VARCHAR)) AS stratum, {H60} AS h
       FROM listings l JOIN lc ON lc.Location = l.Location CROSS JOIN cuts),
rk AS (SELECT *, (rank() OVER (PARTITION BY stratum ORDER BY h) - 1)
                 / count(*) OVER (PARTITION BY stratum) AS pos FROM st)
SELECT {KEYS}, stratum, CASE WHEN pos < 0.7 THEN 'train' WHEN pos < {0.7 + 0.15!r} THEN 'val'
                             ELSE 'test' END AS split FROM rk"""

ORACLE["stratum_shares"] = f"""{BASE},
lc AS (SELECT Location, count(*) AS n FROM listings GROUP BY Location),
cuts AS (SELECT quantile_cont(Rent, 0.25) AS c25, quantile_cont(Rent, 0.5) AS c50,
                quantile_cont(Rent, 0.75) AS c75 FROM listings),
st AS (SELECT l.*, concat_ws('#', CASE WHEN lc.n >= 10 THEN l.Location ELSE '__rare__' END,
              CAST(1 + CAST(Rent > c25 AS INTEGER) + CAST(Rent > c50 AS INTEGER) + CAST(Rent > c75 AS INTEGER)
                   AS VARCHAR)) AS stratum, {H60} AS h
       FROM listings l JOIN lc ON lc.Location = l.Location CROSS JOIN cuts),
rk AS (SELECT *, (rank() OVER (PARTITION BY stratum ORDER BY h) - 1)
                 / count(*) OVER (PARTITION BY stratum) AS pos FROM st),
a AS (SELECT stratum, CASE WHEN pos < 0.7 THEN 'train' WHEN pos < {0.7 + 0.15!r} THEN 'val' ELSE 'test' END AS split FROM rk)
SELECT stratum, count(*) AS rows, CAST(count_if(split = 'train') AS BIGINT) AS train_rows,
       CAST(count_if(split = 'val') AS BIGINT) AS val_rows, CAST(count_if(split = 'test') AS BIGINT) AS test_rows,
       {rd("count_if(split = 'train') / count(*)", 'train_share')}, {rd("count_if(split = 'val') / count(*)", 'val_share')},
       {rd("count_if(split = 'test') / count(*)", 'test_share')}
FROM a GROUP BY stratum"""

HF = sql_bucket32(["o_orderkey"], 43)
ORACLE["fold_assign"] = f"SELECT o_orderkey, CAST({HF} % 5 AS INTEGER) AS fold FROM orders"

ORACLE["seeded_sample"] = f"""{BASE}
SELECT {KEYS} FROM listings ORDER BY {H}, {KEYS} LIMIT 100"""

VOCAB_SQL = """
vocab AS (SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS position
          FROM (SELECT DISTINCT 'Location' AS "column", Location AS value FROM tr
                UNION SELECT DISTINCT 'Type', Type FROM tr
                UNION SELECT DISTINCT 'Furnishing', Furnishing FROM tr))"""

ORACLE["one_hot"] = f"""{BASE},{VOCAB_SQL},
melt AS (SELECT {KEYS}, 'Location' AS "column", Location AS value FROM split_rows
         UNION ALL SELECT {KEYS}, 'Type', Type FROM split_rows
         UNION ALL SELECT {KEYS}, 'Furnishing', Furnishing FROM split_rows)
SELECT {', '.join('m.' + k for k in LISTING_KEY)}, m."column" || '_' || m.value AS encoded_column
FROM melt m JOIN vocab v ON v."column" = m."column" AND v.value = m.value WHERE v.position > 0"""

ORACLE["encoded_columns"] = f"""{BASE},{VOCAB_SQL}
SELECT "column" || '_' || value AS encoded_column,
       CAST(CASE "column" WHEN 'Location' THEN 1 WHEN 'Type' THEN 2 ELSE 3 END AS INTEGER) AS column_order,
       CAST(position AS INTEGER) AS position
FROM vocab WHERE position > 0"""


def te_sql(src: str, c: str) -> str:
    return (f"te_{c} AS (SELECT {c} AS v, (count(Rent) * avg(Rent) + 10.0 * (SELECT avg(Rent) FROM tr))"
            f" / (count(Rent) + 10.0) AS e FROM {src} GROUP BY {c})")


ORACLE["target_encode"] = f"""{BASE},
{',\n'.join(te_sql('tr', c) for c in CATS)}
SELECT {', '.join('s.' + k for k in LISTING_KEY)},
       {', '.join(rd(f'coalesce(te_{c}.e, (SELECT avg(Rent) FROM tr))', f'{c}_te') for c in CATS)}
FROM split_rows s {' '.join(f'LEFT JOIN te_{c} ON te_{c}.v = s.{c}' for c in CATS)}"""

HFOLD = sql_bucket32(LISTING_KEY, 43)


def oof_sql(c: str) -> str:
    return f"""by_{c} AS (SELECT {c} AS v, fold, count(Rent) AS n, sum(Rent) AS s FROM trf GROUP BY {c}, fold),
tot_{c} AS (SELECT v, sum(n) AS nn, sum(s) AS ss FROM by_{c} GROUP BY v),
oof_{c} AS (SELECT b.v, b.fold, t.nn - b.n AS o_n, t.ss - b.s AS o_s FROM by_{c} b JOIN tot_{c} t ON t.v = b.v)"""


ORACLE["target_encode_oof"] = f"""{BASE},
trf AS (SELECT *, CAST({HFOLD} % 5 AS INTEGER) AS fold FROM tr),
tot AS (SELECT count(Rent) AS tn, sum(Rent) AS ts FROM trf),
fp AS (SELECT fold, (max(tot.ts) - sum(Rent)) / (max(tot.tn) - count(Rent)) AS prior
       FROM trf CROSS JOIN tot GROUP BY fold),
{',\n'.join(oof_sql(c) for c in CATS)}
SELECT {', '.join('r.' + k for k in LISTING_KEY)}, r.fold,
       {', '.join(rd(f'CASE WHEN coalesce(oof_{c}.o_n, 0) > 0 THEN (oof_{c}.o_s + 10.0 * fp.prior) / (oof_{c}.o_n + 10.0) ELSE fp.prior END', f'{c}_te') for c in CATS)}
FROM trf r JOIN fp ON fp.fold = r.fold
{' '.join(f'LEFT JOIN oof_{c} ON oof_{c}.v = r.{c} AND oof_{c}.fold = r.fold' for c in CATS)}"""


MODELS = ["pred_location_type", "pred_type", "pred_furnishing", "pred_global", "pred_blend"]
SCORED2_SQL = SCORED_SQL.replace("coalesce(ty.mr, g.gm) AS pred_type, g.gm AS pred_global",
                                 "coalesce(ty.mr, g.gm) AS pred_type, g.gm AS pred_global, "
                                 "coalesce(fu.mr, g.gm) AS pred_furnishing") \
                        .replace("LEFT JOIN ty ON ty.Type = s.Type\n)",
                                 "LEFT JOIN ty ON ty.Type = s.Type\n  LEFT JOIN fu ON fu.Furnishing = s.Furnishing\n)")
SC = f"{FEAT},{SCORED2_SQL}"
LONG_SQL = ",\nlong AS (" + union(
    [f"SELECT '{m}' AS model, split, Type, Location, Rent, CAST({m} AS DOUBLE) AS prediction FROM scored"
     for m in MODELS]) + ")"


def metric_sql(p: str = "prediction", y: str = "Rent") -> str:
    return (f"count(*) AS n, count(*) FILTER (WHERE {p} IS NULL OR {y} IS NULL) AS missing, {rd(f'avg(abs({p} - {y}))', 'mae')}, "
            f"{rd(f'sqrt(avg(({p} - {y}) * ({p} - {y})))', 'rmse')}, "
            f"{rd(f'CASE WHEN max({y}) > min({y}) THEN 1 - sum(({p} - {y}) * ({p} - {y})) / (var_pop({y}) * count(*)) END', 'r2')}, "
            f"{rd(f'avg(abs(({p} - {y}) / {y})) * 100', 'mape')}, "
            f"{rd(f'CASE WHEN min({p}) < max({p}) AND min({y}) < max({y}) THEN corr({p}, {y}) END', 'corr')}")


ORACLE["metrics_overall"] = f"""{SC}{LONG_SQL}
SELECT model, split, {metric_sql()},
       coalesce(CASE WHEN max(Rent) > min(Rent) THEN 1 - sum((prediction - Rent) * (prediction - Rent))
                / (var_pop(Rent) * count(*)) END >= 0.70, false) AS r2_ok,
       coalesce(CASE WHEN min(prediction) < max(prediction) AND min(Rent) < max(Rent)
                THEN corr(prediction, Rent) END >= 0.85, false) AS corr_ok
FROM long GROUP BY model, split"""

SEG_SQL = f"""{SC}{LONG_SQL},
seg AS (SELECT model, split, 'Type' AS segment_kind, Type AS segment, Rent, prediction FROM long
        UNION ALL SELECT model, split, 'Location', Location, Rent, prediction FROM long),
segm AS (SELECT model, split, segment_kind, segment, {metric_sql()},
                avg(abs(prediction - Rent)) AS raw_mae FROM seg GROUP BY model, split, segment_kind, segment)"""

ORACLE["metrics_by_segment"] = f"""{SEG_SQL}
SELECT model, split, segment_kind, segment, n, mae, rmse, r2, mape, corr FROM segm"""

ORACLE["top_segments"] = f"""{SEG_SQL}
SELECT segment_kind, segment, n, mae FROM segm WHERE model = 'pred_blend' AND split = 'test'
ORDER BY raw_mae, segment_kind, segment LIMIT 10"""

MT_SQL = f"""{SC}{LONG_SQL},
mt AS (SELECT model, split, avg(abs(prediction - Rent)) AS mae,
              sqrt(avg((prediction - Rent) * (prediction - Rent))) AS rmse,
              CASE WHEN max(Rent) > min(Rent) THEN 1 - sum((prediction - Rent) * (prediction - Rent))
                   / (var_pop(Rent) * count(*)) END AS r2,
              list_position({MODELS!r}, model) AS ordinal
       FROM long GROUP BY model, split)"""

ORACLE["best_model"] = f"""{MT_SQL}
SELECT model, {rd('mae')} FROM mt WHERE split = 'test' AND model != 'pred_blend'
ORDER BY mae, ordinal LIMIT 1"""

ORACLE["improvement"] = f"""{MT_SQL},
b AS (SELECT model AS best_base_model, mae AS bm FROM mt WHERE split = 'test' AND model != 'pred_blend'
      ORDER BY mae, ordinal LIMIT 1),
e AS (SELECT mae AS em FROM mt WHERE split = 'test' AND model = 'pred_blend')
SELECT best_base_model, {rd('bm', 'best_base_mae')}, {rd('em', 'ensemble_mae')},
       {rd('bm - em', 'improvement')}, {rd('(bm - em) * 100.0 / bm', 'improvement_pct')},
       CASE WHEN bm - em > 0 THEN 'IMPROVED' WHEN bm - em < 0 THEN 'WORSE' ELSE 'EQUAL' END AS verdict
FROM b CROSS JOIN e"""

ORACLE["acceptance"] = f"""{MT_SQL},
v AS (SELECT split || '_mae' AS metric, mae AS value FROM mt WHERE model = 'pred_blend'
      UNION ALL SELECT split || '_r2', r2 FROM mt WHERE model = 'pred_blend'
      UNION ALL SELECT split || '_rmse', rmse FROM mt WHERE model = 'pred_blend'),
t AS (SELECT * FROM (VALUES ('test_mae', 15000.0, 'max'), ('test_r2', 0.85, 'min'),
                            ('test_rmse', 25000.0, 'max'), ('val_mae', 15500.0, 'max'))
      AS t(metric, bound, direction)),
a AS (SELECT * FROM (VALUES ('test_r2', 0.935, 0.940), ('test_mae', 5400.0, 5650.0), ('test_rmse', 25800.0, 26400.0),
                            ('val_mae', 5800.0, 6050.0)) AS a(metric, range_min, range_max))
SELECT v.metric, {rd('v.value', 'value')}, CAST(t.bound AS DOUBLE) AS bound, t.direction,
       CASE WHEN t.direction = 'max' THEN v.value <= t.bound ELSE v.value >= t.bound END AS passed,
       CAST(a.range_min AS DOUBLE) AS range_min, CAST(a.range_max AS DOUBLE) AS range_max,
       v.value BETWEEN a.range_min AND a.range_max AS in_range
FROM v JOIN t ON t.metric = v.metric LEFT JOIN a ON a.metric = v.metric"""

ERR_SQL = """
err AS (SELECT split, abs(pred_blend - Rent) * 100.0 / Rent AS error_pct FROM scored),
band AS (SELECT split, error_pct, CASE WHEN error_pct < 5 THEN 'EXCELLENT' WHEN error_pct < 10 THEN 'GOOD'
                                       ELSE 'WARNING' END AS band FROM err)"""

ORACLE["error_bands"] = f"""{SC},{ERR_SQL}
SELECT split, band, count(*) AS rows, {rd('avg(error_pct)', 'mean_error_pct')} FROM band GROUP BY split, band"""

ORACLE["prediction_sanity"] = SC + "\n" + union(
    [f"SELECT '{m}' AS \"column\", CAST(count_if({m} < 10000 OR {m} > 1000000) AS BIGINT) AS violations, "
     f"count(*) AS rows, CAST(count_if({m} IS NULL) AS BIGINT) AS nulls, "
     f"CAST(count_if(isnan({m})) AS BIGINT) AS nans, CAST(count_if(isinf({m})) AS BIGINT) AS infs FROM scored"
     for m in MODELS])

RANGES = [("Beds", 0, 10), ("Baths", 1, 10), ("Area_in_sqft", 100, 20000), ("log_area", 0, None),
          ("bath_bed_ratio", 0, 10), ("area_per_bedroom", 50, 10000), ("Rent", 10000, 10000000)]


def range_sql(c, lo, hi) -> str:
    conds = ([f"{c} < {lo}"] if lo is not None else []) + ([f"{c} > {hi}"] if hi is not None else [])
    lo_s = "NULL" if lo is None else f"{float(lo)!r}"
    hi_s = "NULL" if hi is None else f"{float(hi)!r}"
    return (f"SELECT '{c}' AS \"column\", CAST({lo_s} AS DOUBLE) AS min, CAST({hi_s} AS DOUBLE) AS max, "
            f"CAST(count_if({' OR '.join(conds)}) AS BIGINT) AS violations, count(*) AS rows, "
            f"count_if({' OR '.join(conds)}) = 0 AS passed FROM feat")


ORACLE["range_rules"] = FEAT + "\n" + union([range_sql(*x) for x in RANGES])

VR = [("price", 10000, 1000000, 25000, 450000), ("size", 100, 10000, 250, 5000),
      ("bedrooms", 0, 10, None, None), ("bathrooms", 1, 10, None, None), ("price_per_sqft", 40, 300, None, None)]


def vr_sql(c, hmin, hmax, emin, emax) -> str:
    exp = " OR ".join(([f"{c} < {emin}"] if emin is not None else []) + ([f"{c} > {emax}"] if emax is not None else [])) or "false"
    return (f"SELECT '{c}' AS \"column\", CAST(count_if({c} < {hmin} OR {c} > {hmax}) AS BIGINT) AS hard_violations, "
            f"CAST(count_if({exp}) AS BIGINT) AS outside_expected FROM raw")


ORACLE["validation_rules"] = f"""{BASE},
raw AS (SELECT Rent AS price, Area_in_sqft AS size, Beds AS bedrooms, Baths AS bathrooms,
               Rent / Area_in_sqft AS price_per_sqft FROM listings)
""" + union([vr_sql(*x) for x in VR])

ORACLE["formula_check"] = FEAT + "\n" + union([
    f"SELECT '{n}' AS feature, CAST(count_if(abs({n} - ({e})) > 1e-5 * abs({e})) AS BIGINT) AS mismatches FROM feat"
    for n, e in [("log_area", "ln(1 + Area_in_sqft)"), ("bath_bed_ratio", "Baths / (Beds + 1)"),
                 ("area_per_bedroom", "Area_in_sqft / (Beds + 1)")]])

ORACLE["drift_check"] = FEAT + "\n" + union([
    f"SELECT '{c}' AS \"column\", {rd(f'avg({c}) FILTER (WHERE split = {chr(39)}train{chr(39)})', 'base_mean')}, "
    f"{rd(f'stddev_samp({c}) FILTER (WHERE split = {chr(39)}train{chr(39)})', 'base_std')}, "
    f"{rd(f'avg({c}) FILTER (WHERE split = {chr(39)}test{chr(39)})', 'current_mean')}, "
    f"{rd(f'abs(avg({c}) FILTER (WHERE split = {chr(39)}test{chr(39)}) - avg({c}) FILTER (WHERE split = {chr(39)}train{chr(39)})) / nullif(stddev_samp({c}) FILTER (WHERE split = {chr(39)}train{chr(39)}), 0)', 'shift')}, "
    f"coalesce(abs(avg({c}) FILTER (WHERE split = 'test') - avg({c}) FILTER (WHERE split = 'train')) "
    f"/ nullif(stddev_samp({c}) FILTER (WHERE split = 'train'), 0) > 0.1, false) AS drift FROM feat"
    for c in NUMERIC])

NULLS = " + ".join(f"count_if({c} IS NULL)" for c in [*NUMERIC, *CATS, "Rent"])
SEEN = " UNION ".join(f"SELECT DISTINCT '{c}' AS \"column\", {c} AS value FROM split_rows" for c in CATS)
ORACLE["audit_report"] = f"""{SC},{ERR_SQL},{VOCAB_SQL}
SELECT 'missing_values' AS "check", CASE WHEN {NULLS} > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
       CAST({NULLS} AS DOUBLE) AS value FROM feat
UNION ALL SELECT 'unknown_categories', CASE WHEN count(*) > 0 THEN 'WARN' ELSE 'PASS' END, CAST(count(*) AS DOUBLE)
          FROM (SELECT * FROM ({SEEN}) s WHERE NOT EXISTS
                (SELECT 1 FROM vocab v WHERE v."column" = s."column" AND v.value = s.value))
UNION ALL SELECT 'encoder_width', CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END, CAST(count(*) + {len(NUMERIC)} AS DOUBLE)
          FROM vocab WHERE position > 0
UNION ALL SELECT 'high_error_share', CASE WHEN avg(CAST(error_pct > 10 AS DOUBLE)) > 0 THEN 'WARN' ELSE 'PASS' END,
                 round(avg(CAST(error_pct > 10 AS DOUBLE)), {ROUND}) + 0.0 FROM err"""

ORACLE["prediction_hourly"] = f"""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
       count(*) AS requests, {rd('avg(value)', 'mean_prediction')}, {rd('min(value)', 'min_prediction')},
       {rd('max(value)', 'max_prediction')}
FROM events GROUP BY 1, 2"""
ORACLE["prediction_hourly_stream"] = ORACLE["prediction_hourly"]

ORACLE["prediction_log"] = f"""{SC}
SELECT {rd('pred_blend', 'prediction')}, Location, Type, Area_in_sqft, Beds FROM scored"""


XS = ["pred_location_type", "pred_type", "pred_furnishing"]
HF1 = sql_bucket32(LISTING_KEY, 43)
RS_TERMS = [(f"mean_{c}", c) for c in [*XS, "Rent"]]
for i, a in enumerate(XS):
    for b in XS[i:]:
        RS_TERMS.append((f"mean_{a}__{b}", f"{a} * {b}"))
    RS_TERMS.append((f"mean_{a}__Rent", f"{a} * Rent"))

ORACLE["ridge_sums"] = f"""{SC},
m AS (SELECT CAST({HF1} % 5 AS INTEGER) AS fold, {', '.join(f'{c} / 1000 AS {c}' for c in [*XS, 'Rent'])}
      FROM scored WHERE split = 'train')
SELECT fold, count(*) AS n, {', '.join(rd(f'sum({e}) / count(*)', n) for n, e in RS_TERMS)}
FROM m GROUP BY fold"""


ORACLE["drift_psi"] = FEAT + ",\ncuts AS (" + union(
    [f"SELECT '{c}' AS c, quantile_cont({c}, 0.25) AS c1, quantile_cont({c}, 0.5) AS c2, "
     f"quantile_cont({c}, 0.75) AS c3 FROM {TRF}" for c in NUMERIC]) + "),\nbinned AS (" + union(
    [f"SELECT '{c}' AS c, split, 1 + CAST({c} > c1 AS INTEGER) + CAST({c} > c2 AS INTEGER) "
     f"+ CAST({c} > c3 AS INTEGER) AS bin FROM feat JOIN cuts ON cuts.c = '{c}' "
     f"WHERE split IN ('train', 'test')" for c in NUMERIC]) + """),
shares AS (SELECT c, split, bin, count(*) / sum(count(*)) OVER (PARTITION BY c, split) AS share
           FROM binned GROUP BY c, split, bin),
pairs AS (SELECT coalesce(b.c, t.c) AS c, greatest(coalesce(b.share, 0), 1e-4) AS bs,
                 greatest(coalesce(t.share, 0), 1e-4) AS ts
          FROM (SELECT * FROM shares WHERE split = 'train') b
          FULL JOIN (SELECT * FROM shares WHERE split = 'test') t ON b.c = t.c AND b.bin = t.bin)
SELECT c AS "column", """ + rd("sum((ts - bs) * ln(ts / bs))", "psi") + " FROM pairs GROUP BY c"


# M4, M5: gradients of the squared error around the mean of the rows a model is trained on; L1 and
# L2 penalties of 1, at least 15 rows a side, 0.1 off each gain.
def penalised(total: str, n: str) -> str:
    return f"power(greatest(abs({total}) - 1.0, 0), 2) / ({n} + 1.0)"


ORACLE["root_splits"] = f"""{BASE},
trf AS (SELECT *, CAST({HFOLD} % 5 AS INTEGER) AS fold FROM tr),
held AS (SELECT CAST(NULL AS INTEGER) AS held_out UNION ALL SELECT CAST(range AS INTEGER) FROM range(5)),
own AS (SELECT held_out, Rent, Beds, Baths, Location, Type, Furnishing FROM trf JOIN held ON held_out IS NULL OR fold <> held_out),
base AS (SELECT held_out, avg(Rent) AS b, count(*) AS n FROM own GROUP BY held_out),
g AS (SELECT o.*, b.b - o.Rent AS g FROM own o JOIN base b ON b.held_out IS NOT DISTINCT FROM o.held_out),
cell AS ({' UNION ALL '.join([f"SELECT held_out, '{c}' AS feature, CAST({c} AS DOUBLE) AS x, NULL AS v, count(*) AS n, sum(g) AS s FROM g GROUP BY held_out, {c}" for c in ('Beds', 'Baths')]
                             + [f"SELECT held_out, '{c}', NULL, {c}, count(*), sum(g) FROM g GROUP BY held_out, {c}" for c in CATS])}),
tot AS (SELECT held_out, feature, sum(n) AS tn, sum(s) AS ts FROM cell GROUP BY held_out, feature),
vocab AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, min({c}) AS first FROM tr" for c in CATS)}),
cand AS (
  SELECT a.held_out, a.feature, a.x, NULL AS v, sum(b.n) AS ln, sum(b.s) AS ls FROM cell a
  JOIN cell b ON b.held_out IS NOT DISTINCT FROM a.held_out AND b.feature = a.feature AND b.x <= a.x GROUP BY a.held_out, a.feature, a.x
  UNION ALL
  SELECT c.held_out, c.feature, NULL, c.v, t.tn - c.n, t.ts - c.s FROM cell c JOIN vocab USING (feature)
  JOIN tot t ON t.held_out IS NOT DISTINCT FROM c.held_out AND t.feature = c.feature WHERE c.v <> first),
scored AS (
  SELECT c.*, tn, ({penalised('ls', 'ln')} + {penalised('(ts - ls)', '(tn - ln)')} - {penalised('ts', 'tn')}) / 2 - 0.1 AS gain
  FROM cand c JOIN tot t ON t.held_out IS NOT DISTINCT FROM c.held_out AND t.feature = c.feature WHERE ln >= 15 AND tn - ln >= 15)
SELECT coalesce(held_out, -1) AS held_out, feature, coalesce(v, CAST(x AS VARCHAR)) AS split_at, {rd('sqrt(2 * gain / tn)', 'rms_gain')},
       CAST(ln AS BIGINT) AS left_rows, CAST(tn - ln AS BIGINT) AS right_rows
FROM scored QUALIFY row_number() OVER (PARTITION BY held_out, feature ORDER BY gain DESC, x, v) = 1"""

H60FOLD = sql_bucket32(LISTING_KEY, 43, 15)


def ordered_sql(c: str) -> str:
    before = f"OVER (PARTITION BY {c} ORDER BY h, {', '.join(LISTING_KEY)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"round((coalesce(sum(Rent) {before}, 0) + 10.0 * prior) / (count(Rent) {before} + 10.0), 3) AS {c}_ots"


ORACLE["target_encode_ordered"] = f"""{BASE},
o AS (SELECT *, {H60FOLD} AS h FROM tr),
p AS (SELECT *, coalesce(avg(Rent) OVER (ORDER BY h, {', '.join(LISTING_KEY)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS prior FROM o)
SELECT {', '.join(LISTING_KEY)}, {', '.join(ordered_sql(c) for c in CATS)} FROM p"""


# M6, M7: a 3 x 3 system for each (rows left in, alpha), by Cramer's rule on centred sums.
def ridge_sql() -> str:
    """All train rows (held 9) and those outside each of five folds."""
    y, pairs = "Rent", [(i, j) for i in range(3) for j in range(i, 3)]
    sums = [f"count(*) * covar_pop({XS[i]}, {XS[j]}) AS s{i}{j}" for i, j in pairs] + [f"count(*) * covar_pop({XS[i]}, {y}) AS t{i}" for i in range(3)]

    def det(m: list[list[str]]) -> str:
        (a, b, c), (d, e, f), (g, h, i) = m
        return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"

    matrix = [[f"(s{min(i, j)}{max(i, j)}{' + a' if i == j else ''})" for j in range(3)] for i in range(3)]
    swapped = [[[f"t{i}" if j == k else matrix[i][j] for j in range(3)] for i in range(3)] for k in range(3)]
    return f"""{SC},
m AS (SELECT {', '.join([*XS, y])}, CAST({sql_bucket32(LISTING_KEY, 44)} % 5 AS INTEGER) AS cv FROM scored WHERE split = 'train'),
held AS (SELECT CAST(range AS INTEGER) AS held FROM range(5) UNION ALL SELECT 9),
s AS (SELECT held, avg({y}) AS my, {', '.join(f'avg({x}) AS m{i}' for i, x in enumerate(XS))}, {', '.join(sums)} FROM m JOIN held ON cv <> held GROUP BY held),
w AS (SELECT held, a, my, m0, m1, m2, {', '.join(f'{det(swapped[k])} / {det(matrix)} AS w{k}' for k in range(3))}
      FROM s, (SELECT unnest([0.1, 1.0, 10.0, 100.0])::DOUBLE AS a)),
f AS (SELECT *, my - w0 * m0 - w1 * m1 - w2 * m2 AS b FROM w),
e AS (SELECT a, cv, avg(abs(b + {' + '.join(f'w{i} * {x}' for i, x in enumerate(XS))} - {y})) AS mae FROM m JOIN f ON held = cv GROUP BY a, cv),
c AS (SELECT a, avg(mae) AS mae FROM e GROUP BY a),
best AS (SELECT a FROM c ORDER BY mae, a LIMIT 1)
SELECT 'cv_mae' AS section, 'alpha=' || CAST(a AS VARCHAR) AS name, round(mae, 3) AS value, a = (SELECT a FROM best) AS chosen FROM c
UNION ALL SELECT 'coef', 'intercept', round(b, 3), true FROM f JOIN best USING (a) WHERE held = 9
{' '.join(f"UNION ALL SELECT 'coef', '{x}', round(w{i}, 6), true FROM f JOIN best USING (a) WHERE held = 9" for i, x in enumerate(XS))}"""


ORACLE["ridge_fit"] = ridge_sql()
