"""Small literal inputs."""

from __future__ import annotations

from decimal import Decimal

from conftest import day
from tenureline.sources.schemas import RAW_SUBSCRIPTIONS, RESOLVED_TIMELINE

PLANS = [("basic", "Basic", 31.0), ("pro", "Pro", 62.0)]

CLEANED = (
    "resolved_subscription_id string, customer_id bigint, resolved_plan_id string, "
    "resolved_status string, start_date date, end_date date, monthly_cost int, "
    "is_billable boolean, status_precedence int"
)


def plans(spark, rows=None):
    schema = "plan_id string, plan_name string, monthly_cost double"
    return spark.createDataFrame(PLANS if rows is None else rows, schema)


def subscriptions(spark, *rows):
    """Rows of (id, customer, plan, status, start, end) with days as text."""
    typed = [(*row[:4], day(row[4]), day(row[5])) for row in rows]
    return spark.createDataFrame(typed, RAW_SUBSCRIPTIONS)


def timeline(spark, *rows):
    """Rows of (customer, id, plan, status, start, end, price, billable)."""
    typed = [
        (*row[:4], day(row[4]), day(row[5]), None if row[6] is None else Decimal(row[6]), row[7])
        for row in rows
    ]
    return spark.createDataFrame(typed, RESOLVED_TIMELINE)
