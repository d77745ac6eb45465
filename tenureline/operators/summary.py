"""One summary row per customer from the resolved timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenureline.functions.dates import closed_end
from tenureline.functions.ranking import sort_key
from tenureline.operators.cleaning import lookup

_LATEST = [
    "resolved_status",
    "resolved_plan_id",
    "monthly_cost",
    "resolved_start_date",
    "resolved_end_date",
]


def _latest_first() -> Column:
    """Latest start, open end, billable, highest price, lowest id."""
    return sort_key(
        -F.unix_date("resolved_start_date"),
        -F.unix_date(closed_end("resolved_end_date")),
        ~F.col("is_billable"),
        -F.col("monthly_cost"),
        F.col("resolved_subscription_id"),
    )


def _latest() -> Column:
    return F.min_by(F.struct(*_LATEST), _latest_first()).alias("latest")


def _history() -> list[Column]:
    def ever(condition: Column) -> Column:
        return F.max(F.when(condition, 1).otherwise(0)) == 1

    return [
        F.min("resolved_start_date").alias("first_subscription_start_date"),
        F.max("resolved_end_date").alias("latest_subscription_end_date"),
        ever(F.col("is_billable")).alias("has_ever_billable_subscription"),
        ever(F.col("resolved_status") == "cancelled").alias("has_ever_cancelled"),
        F.count("*").alias("total_resolved_intervals"),
    ]


#: Names of ``summary_aggregates``.
SUMMARY_AGGREGATES = (
    "latest",
    "first_subscription_start_date",
    "latest_subscription_end_date",
    "has_ever_billable_subscription",
    "has_ever_cancelled",
    "total_resolved_intervals",
)


def summary_aggregates() -> list[Column]:
    """All that the summary needs of a customer's intervals, for ``describe_latest``."""
    return [_latest(), *_history()]


def describe_latest(df: DataFrame, plans: DataFrame) -> DataFrame:
    """Status always; plan, price and start only while the latest interval is open."""
    is_open = F.col("latest.resolved_end_date").isNull()

    def while_open(field: str) -> Column:
        return F.when(is_open, F.col(f"latest.{field}"))

    current = df.withColumns(
        {
            "current_subscription_status": F.col("latest.resolved_status"),
            "current_plan_id": while_open("resolved_plan_id"),
            "current_monthly_cost": while_open("monthly_cost"),
            "current_subscription_start_date": while_open("resolved_start_date"),
        }
    )
    names = plans.select(
        F.col("plan_id").alias("current_plan_id"), F.col("plan_name").alias("current_plan_name")
    )
    return lookup(current, names, "current_plan_id", ["current_plan_name"])


def latest_interval(timeline: DataFrame, plans: DataFrame) -> DataFrame:
    latest = timeline.groupBy("customer_id").agg(_latest())
    return describe_latest(latest, plans).select(
        "customer_id",
        "current_subscription_status",
        "current_plan_id",
        "current_plan_name",
        "current_monthly_cost",
        "current_subscription_start_date",
    )


def subscription_history(timeline: DataFrame) -> DataFrame:
    return timeline.groupBy("customer_id").agg(*_history())


def customer_subscription_summary(timeline: DataFrame, plans: DataFrame) -> DataFrame:
    """Latest interval and history in one aggregation, so the timeline is read once."""
    both = timeline.groupBy("customer_id").agg(*summary_aggregates())
    return describe_latest(both, plans).select(
        "customer_id",
        "current_subscription_status",
        "current_plan_id",
        "current_plan_name",
        "current_monthly_cost",
        "current_subscription_start_date",
        "first_subscription_start_date",
        "latest_subscription_end_date",
        "has_ever_billable_subscription",
        "has_ever_cancelled",
        "total_resolved_intervals",
    )
