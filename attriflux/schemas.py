"""Declared columns and types of the tables the operators exchange."""

from __future__ import annotations

from pyspark.sql import types as T

# The unified fact columns, in contract order.
UNIFIED_COLUMNS = [
    "source", "campaign_name", "c_date", "impressions", "clicks",
    "leads", "orders", "mark_spent", "revenue",
]
NUMERIC_COLUMNS = ["impressions", "clicks", "leads", "orders", "mark_spent", "revenue"]

FACT_TYPES: dict[str, T.DataType] = {
    "id": T.LongType(),
    "source": T.StringType(),
    "campaign_name": T.StringType(),
    "category": T.StringType(),
    "campaign_id": T.LongType(),
    "c_date": T.DateType(),
    "impressions": T.LongType(),
    "clicks": T.LongType(),
    "leads": T.LongType(),
    "orders": T.LongType(),
    "mark_spent": T.DoubleType(),
    "revenue": T.DoubleType(),
}

UNIFIED_SCHEMA = T.StructType([T.StructField(c, FACT_TYPES[c]) for c in UNIFIED_COLUMNS])

# Feature columns of the two model families, in training order.
ANOMALY_FEATURES = [
    "ctr", "cpc", "roas", "cpl", "conversion_rate",
    "roas_wow", "ctr_wow", "spend_wow", "roas_rolling3", "ctr_rolling3",
]
FORECAST_FEATURES = [
    "ctr", "cpc", "cpl", "conversion_rate", "ctr_wow", "spend_wow", "ctr_rolling3",
]
DERIVED_COLUMNS = [
    "ctr", "cpc", "roas", "cpl", "conversion_rate", "roas_prev", "ctr_prev", "spend_prev",
    "roas_wow", "ctr_wow", "spend_wow", "roas_rolling3", "ctr_rolling3", "is_anomaly",
]

# Journey tracking columns and attribution model names.
TRACKING_METHODS = ["cookie", "utm", "fingerprint", "referrer", "server_side"]
ATTRIBUTION_MODELS = ["last_click", "first_click", "linear", "time_decay", "shapley"]

META_PAYLOAD = T.StructType([
    T.StructField("campaign_name", T.StringType()),
    T.StructField("date_start", T.StringType()),
    T.StructField("impressions", T.StringType()),
    T.StructField("clicks", T.StringType()),
    T.StructField("spend", T.StringType()),
    T.StructField("actions", T.ArrayType(T.StructType([
        T.StructField("action_type", T.StringType()), T.StructField("value", T.StringType())]))),
    T.StructField("action_values", T.ArrayType(T.StructType([
        T.StructField("action_type", T.StringType()), T.StructField("value", T.StringType())]))),
])

TIKTOK_PAYLOAD = T.StructType([
    T.StructField("metrics", T.StructType([
        T.StructField(c, T.StringType()) for c in (
            "campaign_name", "impressions", "clicks", "spend", "conversion",
            "complete_payment_roas")])),
    T.StructField("dimensions", T.StructType([T.StructField("stat_time_day", T.StringType())])),
])

GOOGLE_PAYLOAD = T.StructType([
    T.StructField("campaign", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("segments", T.StructType([T.StructField("date", T.StringType())])),
    T.StructField("metrics", T.StructType([
        T.StructField("impressions", T.LongType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("cost_micros", T.LongType()),
        T.StructField("conversions", T.DoubleType()),
        T.StructField("conversions_value", T.DoubleType()),
    ])),
])

GA4_PAYLOAD = T.StructType([
    T.StructField("dimension_values", T.ArrayType(T.StringType())),
    T.StructField("metric_values", T.ArrayType(T.StringType())),
])
