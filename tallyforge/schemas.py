"""Record types and the fixed values that define behaviour."""

from __future__ import annotations

from pyspark.sql import types as T

ITEM = T.StructType(
    [
        T.StructField("sku", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("qty", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
    ]
)

RECEIPT = T.StructType(
    [
        T.StructField("receipt_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("submitted_at", T.TimestampType()),
        T.StructField("currency", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("scanner_version", T.StringType()),
        T.StructField("image_quality", T.DoubleType()),
        T.StructField("items", T.ArrayType(ITEM)),
        T.StructField("subtotal", T.DoubleType()),
        T.StructField("tax", T.DoubleType()),
        T.StructField("total", T.DoubleType()),
    ]
)

LABELS = [
    T.StructField("anomaly_type", T.StringType()),
    T.StructField("is_anomaly", T.IntegerType()),
]

LABELLED_RECEIPT = T.StructType(RECEIPT.fields + LABELS)

CANONICAL_COLUMNS = RECEIPT.fieldNames()

# Filled in only when a source lacks the whole column.
COLUMN_DEFAULTS = {
    "user_id": "U000000",
    "store_id": "ST001",
    "currency": "USD",
    "payment_method": "card",
    "scanner_version": "v4.0",
    "image_quality": 0.90,
}

# Rates, tolerances and thresholds.
TAX_RATE = 0.0825
TAX_MULTIPLIER = 1.0825
RECONCILE_TOLERANCE = 0.02
MAX_NULL_RATE = 0.02
MIN_BATCH_ROWS = 100
MAX_LAG_DAYS = 3.0
MAX_QUARANTINE_RATE = 0.15
HOLDOUT_FRACTION = 0.25
PSI_STABLE_BELOW = 0.10
PSI_SIGNIFICANT_FROM = 0.25
PSI_BINS = 10
PSI_FLOOR = 1e-6
MAX_RECALL_GAP = 0.20
MIN_SLICE_ROWS = 50
MIN_SLICE_POSITIVES = 10
FLAG_RATE_BOUNDS = (0.005, 0.30)

# Accepted codes.
STORES = [f"ST{n:03d}" for n in range(1, 41)]
CURRENCIES = ["USD"]
PAYMENT_METHODS = ["card", "cash", "wallet", "ebt"]
REGIONS = ["northeast", "midatlantic", "southeast", "midwest", "west"]
STORE_FORMATS = ["express", "standard", "supercenter"]
CHANGE_REASONS = ["initial_load", "remodel", "district_realignment", "manager_change"]
QUARANTINE_REASONS = [
    "missing_required_field",
    "non_positive_total",
    "unknown_store",
    "empty_items",
    "future_timestamp",
    "bad_currency",
]
REVIEW_HINTS = [
    "poor_image",
    "implausible_quantity",
    "does_not_reconcile",
    "price_outlier",
    "behavioural",
]

# Model input columns in training order.
FEATURE_COLUMNS = [
    "total",
    "n_items",
    "total_qty",
    "max_qty",
    "mean_unit_price",
    "max_unit_price",
    "max_price_ratio_vs_sku_median",
    "arithmetic_residual_abs",
    "arithmetic_residual_rel",
    "implied_tax_rate",
    "image_quality",
    "hour_of_day",
    "day_of_week",
    "ts_age_days",
    "is_future_ts",
    "user_receipts_prior_24h",
    "user_amount_ratio_vs_prior_median",
    "same_total_prior_24h",
    "subtotal_is_null",
    "tax_is_null",
    "payment_method_code",
    "scanner_version_code",
]
