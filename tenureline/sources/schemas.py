"""Declared schemas of the three raw extracts."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("customer_email", T.StringType()),
        T.StructField("signup_at", T.StringType()),
        T.StructField("metadata_super", T.StringType()),
        T.StructField("region_raw", T.StringType()),
        T.StructField("marketing_source_raw", T.StringType()),
    ]
)

RAW_SUBSCRIPTIONS = T.StructType(
    [
        T.StructField("subscription_id", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("plan_id", T.StringType()),
        T.StructField("status_code", T.StringType()),
        T.StructField("subscription_start_date", T.DateType()),
        T.StructField("subscription_end_date", T.DateType()),
    ]
)

RAW_PLANS = T.StructType(
    [
        T.StructField("plan_id", T.StringType()),
        T.StructField("plan_name", T.StringType()),
        T.StructField("monthly_cost", T.DecimalType(18, 2)),
    ]
)

RESOLVED_TIMELINE = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("resolved_subscription_id", T.StringType()),
        T.StructField("resolved_plan_id", T.StringType()),
        T.StructField("resolved_status", T.StringType()),
        T.StructField("resolved_start_date", T.DateType()),
        T.StructField("resolved_end_date", T.DateType()),
        T.StructField("monthly_cost", T.DecimalType(18, 2)),
        T.StructField("is_billable", T.BooleanType()),
    ]
)
