"""Scans with declared schemas, cleaning, normalisation, projections."""

import os
import tempfile

import pytest
from pyspark.sql import types as T

from hearth.operators import clean, project
from hearth.sources.tables import read_csv_table


def test_csv_scan_with_schema(spark):
    d = tempfile.mkdtemp(prefix="hearth-csv-")
    path = os.path.join(d, "raw.csv")
    with open(path, "w") as f:
        f.write("price,bedrooms,bathrooms,size,location,property_type\n")
        f.write("5000,Studio,1,450,North Quay,Apartment\n6000,2,2,1200,East Park,Villa\n")
    schema = T.StructType([T.StructField("price", T.DoubleType()), T.StructField("bedrooms", T.StringType()),
                           T.StructField("bathrooms", T.IntegerType()), T.StructField("size", T.DoubleType()),
                           T.StructField("location", T.StringType()), T.StructField("property_type", T.StringType())])
    df = read_csv_table(spark, path, schema)
    out = {r.Location: r for r in clean.normalise_raw(df).collect()}
    assert out["North Quay"].Beds == 0 and out["East Park"].Beds == 2
    assert out["North Quay"].Rent == 60000.0 and out["East Park"].Type == "Villa"


def test_coerce_numeric_bad_text_is_null(spark):
    df = spark.createDataFrame([("12.5",), ("abc",), (None,)], "x STRING")
    assert [r.x for r in clean.coerce_numeric(df, ["x"]).collect()] == [12.5, None, None]


def test_clean_range_bounds(spark):
    rows = [(100000.0, 1000.0, 2, 2), (20000.0, 1000.0, 2, 2), (100000.0, 200.0, 2, 2),
            (100000.0, 1000.0, 7, 2), (100000.0, 100000.0 / 301, 1, 1), (None, 1000.0, 1, 1)]
    df = spark.createDataFrame(rows, "price DOUBLE, size DOUBLE, bedrooms INT, bathrooms INT")
    assert clean.clean_range(df).count() == 1


def test_projection_order_and_missing(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Rent INT, a INT, b INT")
    assert project.select_features(df, ["b", "a"]).columns == ["Rent", "b", "a"]
    with pytest.raises(ValueError):
        project.reorder(df, ["a", "zzz"])
    x, label = project.split_xy(df)
    assert "Rent" not in x.columns and label == "Rent"
    assert project.drop_columns(df, ["a"]).columns == ["Rent", "b"]


def test_category_filter_and_request_frame(spark):
    schema = T.StructType([T.StructField("Location", T.StringType()), T.StructField("Type", T.StringType()),
                           T.StructField("Beds", T.IntegerType())])
    req = project.request_frame(spark, [{"Location": "A", "Type": "AP", "Beds": 2},
                                        {"Location": "A", "Type": "VH"}], schema)
    assert req.count() == 2 and req.where("Beds IS NULL").count() == 1
    assert project.category_filter(req, Location="A", Type="VH").count() == 1


def test_removed_columns_report(spark):
    out = project.removed_columns(spark, [f"c{i:02d}" for i in range(15)] + ["Rent"], ["Rent", "c00"], show=10)
    rows = out.orderBy("position").collect()
    assert len(rows) == 11 and rows[0].column == "c01" and rows[-1].column == "... and 4 more"
