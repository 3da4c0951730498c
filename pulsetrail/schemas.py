"""Table schemas and the fixed vocabularies of the event model."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in fields])


# ---- Fixed values -------------------------------------------------------------
# Column names of the tables and the event vocabulary. Order and spelling are part of
# the data contract.

EVENTS = _struct(
    ("event_id", StringType),
    ("user_id", StringType),
    ("session_id", StringType),
    ("event_type", StringType),
    ("timestamp", DoubleType),
    ("timestamp_dt", TimestampNTZType),
    ("device", StringType),
    ("platform", StringType),
    ("region", StringType),
    ("category", StringType),
    ("product_id", StringType),
    ("price", DoubleType),
    ("revenue", DoubleType),
    ("response_time_ms", LongType),
    ("error_code", StringType),
    ("search_query", StringType),
    ("hour", IntegerType),
    ("day_of_week", IntegerType),
)

HOURLY = _struct(
    ("hour_bucket", TimestampNTZType),
    ("region", StringType),
    ("device", StringType),
    ("event_count", LongType),
    ("unique_users", LongType),
    ("unique_sessions", LongType),
    ("purchases", LongType),
    ("total_revenue", DoubleType),
    ("avg_response_ms", DoubleType),
    ("p95_response_ms", LongType),
    ("error_count", LongType),
    ("error_rate", DoubleType),
)

ANOMALIES = _struct(
    ("timestamp", TimestampNTZType),
    ("metric", StringType),
    ("value", DoubleType),
    ("expected", DoubleType),
    ("deviation", DoubleType),
    ("method", StringType),
    ("severity", StringType),
    ("description", StringType),
    ("region", StringType),
    ("device", StringType),
)

USER_FEATURES = (
    "user_total_revenue",
    "user_event_count",
    "user_purchase_count",
    "user_avg_response_ms",
    "user_first_event_ts",
    "user_last_event_ts",
)
SESSION_FEATURES = (
    "session_depth",
    "session_start",
    "session_end",
    "converted",
    "session_revenue",
)

EVENT_TYPES = (
    "page_view",
    "search",
    "product_view",
    "add_to_cart",
    "remove_from_cart",
    "checkout_start",
    "purchase",
    "error",
    "wishlist_add",
)

FUNNEL_STAGES = (
    "page_view",
    "search",
    "product_view",
    "add_to_cart",
    "checkout_start",
    "purchase",
)

CATEGORIES = (
    "Electronics",
    "Clothing",
    "Home & Kitchen",
    "Books",
    "Sports",
    "Beauty",
    "Toys",
    "Automotive",
    "Grocery",
    "Tools",
)

DEVICES = ("mobile", "desktop", "tablet")
ERROR_CODES = ("500", "503", "504", "404", "429")
OK_CODE = "200"
SEVERITIES = ("critical", "high", "medium", "low")
METHODS = ("zscore", "iqr", "isolation_forest")
RFM_SEGMENTS = (
    "Champions",
    "Loyal Customers",
    "Potential Loyalists",
    "New Customers",
    "At Risk",
    "Lost",
)
