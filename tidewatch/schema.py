"""Table shapes and the values that define the results."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values ---------------------------------------------------------
EVENT_TYPES = ["page_view", "purchase", "support_ticket", "login", "logout"]
SCHEMA_VERSION = "1.0"
MODEL_VERSION = "1.0"
CUSTOMER_ID_LENGTH = (1, 50)

EVENT_TOPIC = "customer-events"
PREDICTION_TOPIC = "churn-predictions"
CONSUMER_GROUP = "churn-prediction-consumer"

ROLLING_DAYS = [7, 30, 90]
RECENT_DAYS = 30
BUSINESS_HOURS = (9, 17)
EVENING_HOURS = (18, 23)
WEEKEND_DAYS = [1, 7]

WATERMARK = "10 minutes"
WINDOW = "5 minutes"
TRIGGER = "30 seconds"
POLL_SIZE = 1000
INSERT_BATCH = 1000

HIGH_RISK = 0.7
MEDIUM_RISK = 0.4
QUIET_SCORE = 0.8
NO_PURCHASE_SCORE = 0.6
ACTIVE_SCORE = 0.2
INACTIVE_DAYS = 30
VALIDATION_PERCENT = 20
SEED = 42

FEATURES = [
    "total_events",
    "unique_event_types",
    "purchase_count",
    "page_view_count",
    "support_ticket_count",
    "avg_purchase_amount",
    "total_purchase_amount",
    "days_since_last_activity",
    "customer_lifetime_days",
    "events_per_day",
    "purchase_frequency",
    "events_last_30d",
    "purchases_last_30d",
    "page_views_last_30d",
    "active_days_last_30d",
    "avg_purchase_amount_last_30d",
]
# The stored feature row carries the columns before the recent ones.
STORED_FEATURES = FEATURES[:11]
RECENT_FEATURES = FEATURES[11:]

TREE_SETTINGS = {
    "maxDepth": 6,
    "stepSize": 0.1,
    "maxIter": 100,
    "subsamplingRate": 0.8,
    "columnsPerTree": 0.8,
    "seed": SEED,
}
PATIENCE = 10
# --- End of fixed values --------------------------------------------------

EVENT = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_data", T.MapType(T.StringType(), T.StringType())),
    T.StructField("schema_version", T.StringType()),
])

PREDICTION = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("churn_probability", T.DoubleType(), False),
    T.StructField("prediction_date", T.TimestampType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("features", T.StringType()),
])

_COUNTS = {
    "total_events", "unique_event_types", "purchase_count", "page_view_count",
    "support_ticket_count", "days_since_last_activity", "customer_lifetime_days",
}
STORED_FEATURE_ROW = T.StructType(
    [T.StructField("customer_id", T.StringType(), False)]
    + [T.StructField(name, T.IntegerType() if name in _COUNTS else T.DoubleType())
       for name in STORED_FEATURES]
    + [T.StructField("last_updated", T.TimestampType())]
)
