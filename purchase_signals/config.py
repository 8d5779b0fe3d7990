"""Fixed values and tunable thresholds.

Everything in the "fixed values" block must equal what the original
pipeline uses, otherwise features, labels and decisions differ.
"""

from __future__ import annotations

# --- fixed values (must match the original pipeline) -----------------------

# Screen names, by category, in this order.
SHOPPING_SCREENS = ["ProductList", "ProductDetail", "CategoryBrowse", "Search"]
CART_SCREENS = ["ShoppingCart", "Checkout", "PaymentMethods", "DeliveryOptions"]
ENGAGEMENT_SCREENS = ["WishList", "Reviews", "Promotions"]
ACCOUNT_SCREENS = ["Account", "AddressBook", "OrderTracking"]

# Weights of the behaviour scores, in term order.
ENGAGEMENT_WEIGHTS = [
    ("session_count", 0.3),
    ("used_search_feature", 0.2),
    ("wrote_review", 0.15),
    ("added_to_wishlist", 0.15),
    ("total_screens_viewed", 0.2),
]
INTENT_WEIGHTS = [
    ("cart_count", 0.4),
    ("shopping_count", 0.3),
    ("engagement_count", 0.2),
    ("added_to_wishlist", 0.1),
]

# Label horizon in hours (inclusive) and weekend days (Monday = 0).
LABEL_HORIZON_HOURS = 24
WEEKEND_DAYS = [5, 6]

# Platform codes.
PLATFORM_CODES = {"iOS": 1, "Android": 0}

# Serving defaults when an input is missing or unparsable.
SERVE_DEFAULT_HOUR = 12
SERVE_DEFAULT_DAYOFWEEK = 0
SERVE_DEFAULT_SEGMENT = "Unknown User"
SERVE_DEFAULT_USER_TYPE = "User"
SERVE_DEFAULT_CATEGORY = "Unknown"
SERVE_DEFAULT_MAJOR_VERSION = 3
SERVE_DEFAULT_VERSION_SCORE = 3.0

# Record-hash key fields and separator.
HASH_KEY_FIELDS = ["user_id", "first_visit_date"]
HASH_SEPARATOR = "|"

# Date formats tried, in order, after ISO (month first).
DATE_FORMATS_SPARK = ["M/d/yyyy", "yyyy/M/d", "yyyy-M-d", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "yyyyMMdd"]
DATE_FORMATS_DUCKDB = ["%m/%d/%Y", "%Y/%m/%d", "%Y-%m-%d", "%b %d, %Y", "%B %d, %Y", "%d %b %Y", "%Y%m%d"]
# Each date format may be followed by a time of day.
TIME_SUFFIX_SPARK = "[ H:m[:s]]"
TIME_SUFFIXES_DUCKDB = ["", " %H:%M", " %H:%M:%S"]

# Date-like text patterns (unanchored) used to drop text columns.
DATE_LIKE_PATTERN = r"\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}"

# Batch gates, thresholds and training parameters.
# Partitions that a forest's training rows are dealt to at least, and the rows of
# one from which on there are more of them.
FIT_PARTITIONS = 16
FIT_PARTITION_ROWS = 250_000
# Categories that a feature table may have one-hot columns for, in all.
MAX_CATEGORIES = 10_000
MIN_INGEST_BATCH = 200
MIN_FEATURIZE_BATCH = 100
MAX_MISSING_SHARE = 0.3
MIN_TRAINING_ROWS = 100
TEST_SHARE = 0.2
RANDOM_STATE = 42
CV_FOLDS = 5
# Folds that are fitted at a time.
CV_PARALLELISM = 2
N_ESTIMATORS = 100
MIN_F1_IMPROVEMENT = 0.01
MAX_MODEL_AGE_DAYS = 30
MIN_NEW_RECORDS_FOR_TRAINING = 200
REPROCESS_AGE_DAYS = 7
TOP_CORRELATIONS = 10
TOP_IMPORTANCES = 10
TOP_INFLUENCES = 5

# Columns that never enter the model.
ID_COLUMNS = ["user_id", "record_hash", "processing_version", "_id"]
TARGET = "purchase_24h"

# Raw columns consumed by featurization and dropped afterwards.
RAW_DROP_COLUMNS = [
    "screen_list", "purchase_date", "first_visit_date", "time_to_purchase",
    "made_purchase", "region", "acquisition_channel", "user_segment",
    "app_version", "age_group", "user_type",
]

# One-hot prefixes by source column.
ONE_HOT_PREFIX = {
    "region": "region",
    "acquisition_channel": "channel",
    "age_group": "age_group",
    "user_type": "user_type",
}

# --- derived --------------------------------------------------------------

SCREEN_CATEGORIES = {
    "shopping_count": SHOPPING_SCREENS,
    "cart_count": CART_SCREENS,
    "engagement_count": ENGAGEMENT_SCREENS,
    "account_count": ACCOUNT_SCREENS,
}
TRACKED_SCREENS = SHOPPING_SCREENS + CART_SCREENS + ENGAGEMENT_SCREENS + ACCOUNT_SCREENS

# Vocabulary fitted on the shared app-log fixture (checked by a test against
# ``fit_vocabulary``); used where a static column list is required.
FIXTURE_VOCABULARY = {
    "region": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "acquisition_channel": ["Email", "Organic Search", "Paid Search", "Referral", "Social Media"],
    "age_group": ["Adult", "Senior", "Young"],
    "user_type": ["Browser", "Buyer", "Power User"],
}
