"""Shared fixtures: one local Spark session per test run, small test tables."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("hearth-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hearth-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


@pytest.fixture
def listing_rows(spark):
    """Hand fixture covering the edge cases: studio rows, one-row location,
    zero-std location, tied areas, a zero (location, type) mean."""
    rows = [
        # Location, Type, Furnishing, Beds, Baths, Area, Rent, split
        ("A", "AP", "Furnished", 0, 1, 500.0, 40000.0, "train"),
        ("A", "AP", "Unfurnished", 1, 1, 700.0, 50000.0, "train"),
        ("A", "VH", "Furnished", 3, 4, 700.0, 120000.0, "train"),
        ("A", "VH", "Unfurnished", 4, 5, 2000.0, 150000.0, "train"),
        ("B", "AP", "Furnished", 2, 2, 1000.0, 70000.0, "train"),       # one-row location
        ("C", "AP", "Furnished", 1, 1, 800.0, 60000.0, "train"),        # zero std
        ("C", "AP", "Unfurnished", 1, 1, 800.0, 62000.0, "train"),
        ("D", "TH", "Furnished", 2, 3, 1500.0, 0.0, "train"),           # zero (loc, type) mean
        ("D", "AP", "Furnished", 1, 1, 600.0, 30000.0, "train"),
        ("A", "AP", "Furnished", 2, 2, 700.0, 999999.0, "test"),
        ("Z", "AP", "Semi-Furnished", 2, 2, 900.0, 80000.0, "test"),    # unknown location + furnishing
        ("D", "TH", "Unfurnished", 3, 3, 1500.0, 75000.0, "val"),
    ]
    schema = ("id INT, Location STRING, Type STRING, Furnishing STRING, Beds INT, Baths INT, "
              "Area_in_sqft DOUBLE, Rent DOUBLE, split STRING")
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
