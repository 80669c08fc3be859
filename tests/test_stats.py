"""M2 fitted statistics: premiums, deviation, ranks, fallbacks, leak-freeness."""

import math

from pyspark.sql import functions as F

from hearth.operators import stats as st


def _features(df):
    s = st.fit_listing_stats(df.where("split = 'train'"))
    return {r.id: r for r in st.listing_features(df, s).collect()}, s


def test_global_mean_and_premiums(listing_rows):
    feats, s = _features(listing_rows)
    train = [r for r in listing_rows.collect() if r.split == "train"]
    g = sum(r.Rent for r in train) / len(train)
    assert math.isclose(s.global_mean, g)
    a_ap = [r for r in listing_rows.collect() if r.split == "test" and r.Location == "A"][0]
    f = feats[a_ap.id]
    assert math.isclose(f.location_type_premium, ((40000 + 50000) / 2) / g)
    furn = [r.Rent for r in train if r.Furnishing == "Furnished"]
    ap = [r.Rent for r in train if r.Type == "AP"]
    assert math.isclose(f.furnishing_type_premium, sum(furn) / len(furn) / g)
    assert math.isclose(f.type_room_premium, sum(ap) / len(ap) / g)


def test_zero_location_type_mean_falls_back_to_location(listing_rows):
    feats, s = _features(listing_rows)
    d_th = [r for r in listing_rows.collect() if r.Location == "D" and r.Type == "TH"]
    for r in d_th:
        assert math.isclose(feats[r.id].location_type_premium, (0.0 + 30000.0) / 2 / s.global_mean)


def test_unknown_categories(listing_rows):
    feats, _ = _features(listing_rows)
    z = [r for r in listing_rows.collect() if r.Location == "Z"][0]
    f = feats[z.id]
    assert f.property_rank_in_location == 0.5
    assert f.area_deviation_from_location == 0.0
    assert f.location_type_premium == 1.0 and f.furnishing_type_premium == 1.0


def test_deviation_one_row_and_zero_std(listing_rows):
    feats, _ = _features(listing_rows)
    for r in listing_rows.collect():
        if r.Location in ("B", "C"):
            assert feats[r.id].area_deviation_from_location == 0.0


def test_rank_is_strictly_smaller_share(listing_rows):
    feats, _ = _features(listing_rows)
    a_rows = [r for r in listing_rows.collect() if r.Location == "A"]
    train_areas = [r.Area_in_sqft for r in a_rows if r.split == "train"]      # 500, 700, 700, 2000
    for r in a_rows:
        expect = sum(a < r.Area_in_sqft for a in train_areas) / len(train_areas)
        assert feats[r.id].property_rank_in_location == expect
    # tie: both 700 rows share rank 0.25 (not percent_rank's 1/3)
    assert sorted(feats[r.id].property_rank_in_location for r in a_rows if r.Area_in_sqft == 700.0) == [0.25] * 3


def test_features_do_not_see_val_test_targets(listing_rows):
    feats, _ = _features(listing_rows)
    changed = listing_rows.withColumn("Rent", F.when(F.col("split") != "train", F.lit(1.0)).otherwise(F.col("Rent")))
    feats2, _ = _features(changed)
    cols = ["property_rank_in_location", "area_deviation_from_location", "location_type_premium",
            "furnishing_type_premium", "type_room_premium"]
    for i, r in feats.items():
        assert [r[c] for c in cols] == [feats2[i][c] for c in cols]


def test_region_features_fill(spark):
    df = spark.createDataFrame([("x", 10.0), ("x", 20.0), ("y", 40.0)], "address_region STRING, price DOUBLE")
    out = {(r.address_region, r.price): r for r in st.region_features(df).collect()}
    assert out[("x", 10.0)].region_price_median == 15.0
    # one-row region: std filled with the global std
    import statistics
    assert math.isclose(out[("y", 40.0)].region_price_std, statistics.stdev([10.0, 20.0, 40.0]))


def test_region_lookup_default(spark):
    req = spark.createDataFrame([("x",), ("nowhere",)], "location STRING")
    means = spark.createDataFrame([("x", 5.0)], "region STRING, region_price_mean DOUBLE")
    out = {r.location: r.region_price_mean for r in st.region_lookup(req, means).collect()}
    assert out == {"x": 5.0, "nowhere": 100000.0}


def test_v62_features(spark):
    req = spark.createDataFrame([(2, 1, 999.0, "x", True)], "bedrooms INT, bathrooms INT, size DOUBLE, location STRING, has_pool BOOLEAN")
    means = spark.createDataFrame([("x", 99900.0)], "region STRING, region_price_mean DOUBLE")
    r = st.v62_features(req, means).first()
    assert r.total_rooms == 3 and r.price_per_sqft_est == 100.0 and r.has_pool == 1 and r.has_gym == 0
    assert math.isclose(r.bed_size_interaction, 2 * math.log1p(999.0))


def test_rows_without_region_get_the_global_values(spark):
    from hearth.operators.stats import region_features
    df = spark.createDataFrame([("a", 10.0), ("a", 30.0), ("a", 50.0), ("b", 20.0), (None, 40.0), ("c", None)],
                               "address_region STRING, price DOUBLE")
    got = {(r.address_region, r.price): (r.region_price_mean, r.region_price_median, round(r.region_price_std, 6)) for r in region_features(df).collect()}
    everywhere = (30.0, 30.0, 15.811388)
    assert got[(None, 40.0)] == got[("c", None)] == everywhere
    assert got[("a", 10.0)] == (30.0, 30.0, 20.0)
    assert got[("b", 20.0)] == (20.0, 20.0, 15.811388)


def test_rank_of_unknown_area_and_location(spark, listing_rows):
    from hearth.operators.stats import area_rank_share, fit_listing_stats
    s = fit_listing_stats(listing_rows.where("split = 'train'"))
    req = spark.createDataFrame([(1, "A", None), (2, "Z", 10.0), (3, "A", 700.0), (4, "Z", None), (5, None, 5.0)],
                                "i INT, Location STRING, Area_in_sqft DOUBLE")
    got = {r.i: r.property_rank_in_location for r in area_rank_share(req, s).collect()}
    assert got == {1: 0.0, 2: 0.5, 3: 0.25, 4: 0.5, 5: 0.5}
