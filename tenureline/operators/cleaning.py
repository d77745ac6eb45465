"""Cleaning of raw customers and subscriptions."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenureline.functions.dates import closed_end
from tenureline.functions.text import null_literal, recode, trimmed_lower

# Recognised status codes, which of them earn revenue, and their strength.
STATUS_OF_CODE = {
    "active": "active",
    "cancelled": "cancelled",
    "canceled": "cancelled",
    "pending": "pending",
}
BILLABLE_STATUSES = ("active", "cancelled")
STATUS_PRECEDENCE = {"active": 3, "cancelled": 2, "pending": 1}


def clean_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        F.trim("customer_name").alias("customer_name"),
        trimmed_lower("customer_email").alias("customer_email"),
        F.col("signup_at").cast("timestamp_ntz").alias("signup_at"),
        null_literal("region_raw").alias("region"),
        null_literal("marketing_source_raw").alias("marketing_source"),
    )


def normalise_status(
    df: DataFrame,
    column: str,
    mapping: Mapping[str, str] = STATUS_OF_CODE,
    billable: Collection[str] = BILLABLE_STATUSES,
    precedence: Mapping[str, int] = STATUS_PRECEDENCE,
) -> DataFrame:
    """Add ``resolved_status`` (null when unrecognised), ``is_billable``, ``status_precedence``."""
    status = recode(trimmed_lower(column), mapping)
    return df.withColumn("resolved_status", status).withColumns(
        {
            "is_billable": F.coalesce(
                F.col("resolved_status").isin(list(billable)), F.lit(False)
            ),
            "status_precedence": recode(F.col("resolved_status"), precedence, default=0),
        }
    )


def lookup(df: DataFrame, dimension: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """Attach ``columns`` of ``dimension``; rows without a match stay, with nulls.

    No broadcast hint: Spark broadcasts the dimension when its measured size is below
    the broadcast threshold and sort-merges (splitting skewed keys) beyond it.
    """
    return df.join(dimension.select(on, *columns), on, "left")


def valid_intervals(
    df: DataFrame, start: str, end: str, code: str, codes: Collection[str] = tuple(STATUS_OF_CODE)
) -> DataFrame:
    """Keep recognised status codes whose end is open or not before the start."""
    return df.where(
        trimmed_lower(code).isin(list(codes))
        & (F.col(end).isNull() | (F.col(end) >= F.col(start)))
    )


def typed_subscriptions(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.select(
        F.col("subscription_id").alias("resolved_subscription_id"),
        "customer_id",
        F.col("plan_id").alias("resolved_plan_id"),
        "status_code",
        F.col("subscription_start_date").cast("date").alias("start_date"),
        F.col("subscription_end_date").cast("date").alias("end_date"),
    )


def valid_subscriptions(subscriptions: DataFrame) -> DataFrame:
    """The rows of ``clean_subscriptions`` before they meet the plans."""
    typed = typed_subscriptions(subscriptions)
    return valid_intervals(typed, "start_date", "end_date", "status_code")


def clean_subscriptions(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Typed, priced, valid subscriptions; an open end becomes the sentinel day."""
    valid = normalise_status(valid_subscriptions(subscriptions), "status_code")
    prices = plans.withColumnRenamed("plan_id", "resolved_plan_id")
    return lookup(valid, prices, "resolved_plan_id", ["monthly_cost"]).select(
        "resolved_subscription_id",
        "customer_id",
        "resolved_plan_id",
        "resolved_status",
        "start_date",
        closed_end("end_date").alias("end_date"),
        "monthly_cost",
        "is_billable",
        "status_precedence",
    )
