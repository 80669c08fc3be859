"""Column roles, rule tables and parameters.

Everything under "FIXED VALUES" must equal what the valuation model this
library reproduces uses; it is stated plainly, in natural order.  Everything
else is a default of ours and is a parameter of the operator that uses it.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the modelled valuation pipeline)
# ---------------------------------------------------------------------------

TARGET = "Rent"

NUMERIC_FEATURES = [
    "Beds", "Baths", "Area_in_sqft", "log_area",
    "property_rank_in_location", "area_deviation_from_location",
    "location_type_premium", "furnishing_type_premium",
    "bath_bed_ratio", "area_per_bedroom", "type_room_premium",
]

CATEGORICAL_FEATURES = ["Location", "Type", "Furnishing"]

ALL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES

# Key used to compare splits for duplicated listings.
OVERLAP_KEY = ["Location", "Type", "Beds", "Baths", "Area_in_sqft", "Rent"]
OVERLAP_MAX_SHARE = 0.30

# Columns that carry the target and must never reach a feature table.
FORBIDDEN_COLUMNS = ["Rent_per_sqft", "Rent_category", "property_value_tier",
                     "rent_rank", "price_normalized"]

# Outlier cleaning of raw listings (monthly price, size in sqft).
CLEANING_BOUNDS = {
    "price_min": 25000,
    "price_max": 450000,
    "size_min": 250,
    "size_max": 5000,
    "price_per_sqft_min": 40,
    "price_per_sqft_max": 300,
    "bedrooms_max": 6,
    "bathrooms_max": 8,
}

# Validation rules: (column, hard min, hard max, expected min, expected max).
VALIDATION_RULES = [
    ("price", 10000, 1000000, 25000, 450000),
    ("size", 100, 10000, 250, 5000),
    ("bedrooms", 0, 10, None, None),
    ("bathrooms", 1, 10, None, None),
    ("price_per_sqft", 40, 300, None, None),
]

# Ranges the modelling table is tested against: (column, min, max).
FEATURE_RANGES = [
    ("Beds", 0, 10),
    ("Baths", 1, 10),
    ("Area_in_sqft", 100, 20000),
    ("log_area", 0, None),
    ("bath_bed_ratio", 0, 10),
    ("area_per_bedroom", 50, 10000),
    ("Rent", 10000, 10000000),
]

# Prediction sanity range (annual rent).
PREDICTION_RANGE = (10000, 1000000)

SPLIT_RATIOS = (0.70, 0.15, 0.15)
RANDOM_STATE = 42
N_FOLDS = 5
TARGET_SMOOTHING = 10.0
RIDGE_ALPHAS = [0.1, 1.0, 10.0, 100.0]
UNKNOWN_REGION_MEAN = 100000.0
UNKNOWN_RANK = 0.5
DEGENERATE_PREMIUM = 1.0
ERROR_BANDS = [(5.0, "EXCELLENT"), (10.0, "GOOD")]   # else WARNING
DRIFT_THRESHOLD = 0.1
MULTICOLLINEARITY_MAX = 0.90
LOW_SIGNAL_MIN = 0.1
BASELINE_QUANTILES = [0.25, 0.50, 0.75]
SHARE_BOUNDS = {"train": (0.60, 0.75), "val": (0.10, 0.20), "test": (0.15, 0.25)}
R2_MIN = 0.70
CORR_MIN = 0.85

# Performance targets: (metric, bound, direction).
PERFORMANCE_TARGETS = [
    ("test_mae", 15000.0, "max"),
    ("test_r2", 0.85, "min"),
    ("test_rmse", 25000.0, "max"),
    ("val_mae", 15500.0, "max"),
]

# Accepted ranges of the re-trained ensemble: (metric, min, max).
ACCEPTED_RANGES = [
    ("test_r2", 0.935, 0.940),
    ("test_mae", 5400.0, 5650.0),
    ("test_rmse", 25800.0, 26400.0),
    ("val_mae", 5800.0, 6050.0),
]

# Labels of the market comparison.
COMPARISON_LABELS = ["Location Average", "Property Type Average", "Your Prediction"]

# Tuned booster parameters of the three base learners.
TUNED_PARAMS = {
    "XGBoost": {"n_estimators": 500, "max_depth": 10, "learning_rate": 0.05,
                "subsample": 0.9, "colsample_bytree": 0.9, "colsample_bylevel": 0.9,
                "min_child_weight": 15, "gamma": 0.1, "reg_alpha": 1.0, "reg_lambda": 1},
    "LightGBM": {"n_estimators": 500, "max_depth": 10, "learning_rate": 0.05,
                 "subsample": 0.9, "colsample_bytree": 0.9, "min_child_weight": 15,
                 "reg_alpha": 1.0, "reg_lambda": 1, "num_leaves": 100},
    "CatBoost": {"iterations": 500, "depth": 10, "learning_rate": 0.05,
                 "subsample": 0.9, "colsample_bylevel": 0.9, "min_data_in_leaf": 15,
                 "reg_lambda": 1},
}

# Amenity flags of the v6.2 request row.
V62_FLAGS = ["has_water_view", "has_parking", "has_pool", "has_gym", "has_balcony"]

# ---------------------------------------------------------------------------
# Defaults of ours
# ---------------------------------------------------------------------------

# Largest fitted table we broadcast; beyond it a shuffle join is used.
BROADCAST_MAX_ROWS = 2_000_000
# Decimal places of floating outputs that are compared with the SQL oracle.
ROUND = 6
