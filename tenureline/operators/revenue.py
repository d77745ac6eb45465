"""Calendar months, proration, the monthly fact and the customer dimension."""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenureline.functions.dates import (
    ONE_MONTH,
    days_in_month,
    inclusive_days,
    month_start,
    months_between,
)
from tenureline.operators.summary import (
    SUMMARY_AGGREGATES,
    describe_latest,
    summary_aggregates,
)


class Horizon(NamedTuple):
    """The day at which open intervals are cut; null when there is nothing billable."""

    day: date | None


def horizon_metrics() -> list[Column]:
    """What a timeline shows of its horizon while it is stored; seeing a row twice changes nothing."""
    billable = F.col("is_billable")
    return [
        F.max(F.when(billable, F.col("resolved_end_date"))).alias("last_end"),
        F.max(F.when(billable, F.col("resolved_start_date"))).alias("last_start"),
    ]


def billable_intervals(timeline: DataFrame) -> DataFrame:
    return timeline.where("is_billable").select(
        "customer_id",
        "resolved_plan_id",
        "resolved_status",
        "resolved_start_date",
        "resolved_end_date",
        "monthly_cost",
    )


def revenue_horizon(
    billable: DataFrame, start: str = "resolved_start_date", end: str = "resolved_end_date"
) -> DataFrame:
    """One row: first and last revenue month, and the day open intervals are cut at."""
    horizon = billable.agg(
        F.min(start).alias("first_day"),
        F.coalesce(F.max(end), F.max(start)).alias("dataset_horizon_date"),
    )
    return horizon.select(
        month_start("first_day").alias("min_revenue_month"),
        month_start("dataset_horizon_date").alias("max_revenue_month"),
        "dataset_horizon_date",
    )


def month_spine(horizon: DataFrame) -> DataFrame:
    """One row per month of the horizon; a single null month when there is none."""
    months = F.sequence("min_revenue_month", "max_revenue_month", F.expr(ONE_MONTH))
    return horizon.select(F.explode_outer(months).alias("revenue_month"))


def month_windows(spine: DataFrame) -> DataFrame:
    return spine.select(
        "revenue_month",
        F.last_day("revenue_month").alias("month_end"),
        days_in_month("revenue_month").alias("days_in_month"),
    )


def _horizon_date(horizon: DataFrame | Horizon) -> Column:
    if isinstance(horizon, Horizon):
        return F.lit(horizon.day).cast("date")
    return horizon.select("dataset_horizon_date").scalar()


def apply_horizon(billable: DataFrame, horizon: DataFrame | Horizon) -> DataFrame:
    """Close open intervals at the horizon, which is known or else read as a scalar."""
    horizon_date = _horizon_date(horizon)
    return billable.select(
        "customer_id",
        "resolved_plan_id",
        "resolved_status",
        "resolved_start_date",
        F.coalesce("resolved_end_date", horizon_date).alias("effective_end_date"),
        "monthly_cost",
    )


def _unfold(intervals: DataFrame, months: Column, start: str, end: str) -> DataFrame:
    unfolded = intervals.withColumn("revenue_month", F.explode(months))
    return unfolded.select(
        "customer_id",
        "revenue_month",
        F.last_day("revenue_month").alias("month_end"),
        days_in_month("revenue_month").alias("days_in_month"),
        start,
        end,
        "monthly_cost",
    )


def interval_months(
    closed: DataFrame, start: str = "resolved_start_date", end: str = "effective_end_date"
) -> DataFrame:
    """One row per interval and month it touches, generated from the interval itself.

    Intervals that start after their end (open ones starting after the horizon) earn
    nothing; they go before the generator, which needs an ascending range.
    """
    earning = closed.where(F.col(start) <= F.col(end))
    return _unfold(earning, months_between(month_start(start), month_start(end)), start, end)


def edge_months(
    closed: DataFrame, start: str = "resolved_start_date", end: str = "effective_end_date"
) -> DataFrame:
    """The first and the last month of each interval, once if they are the same."""
    earning = closed.where(F.col(start) <= F.col(end))
    edges = F.array_distinct(F.array(month_start(start), month_start(end)))
    return _unfold(earning, edges, start, end)


def inner_months(
    closed: DataFrame, start: str = "resolved_start_date", end: str = "effective_end_date"
) -> DataFrame:
    """The months strictly between the first and the last one of each interval."""
    first, last = F.add_months(month_start(start), 1), F.add_months(month_start(end), -1)
    return _unfold(closed.where(first <= last), months_between(first, last), start, end)


def clip_overlap(
    months: DataFrame, start: str = "resolved_start_date", end: str = "effective_end_date"
) -> DataFrame:
    return months.select(
        "customer_id",
        "revenue_month",
        "days_in_month",
        F.greatest(start, "revenue_month").alias("overlap_start"),
        F.least(end, "month_end").alias("overlap_end"),
        "monthly_cost",
    )


def prorate(clipped: DataFrame, price: str = "monthly_cost") -> DataFrame:
    active = inclusive_days("overlap_start", "overlap_end")
    return clipped.select(
        "customer_id",
        "revenue_month",
        "days_in_month",
        active.alias("active_days_in_month"),
        (F.col(price) * active.cast("double") / F.col("days_in_month").cast("double")).alias(
            "prorated_mrr_amount"
        ),
    )


def monthly_totals(prorated: DataFrame) -> DataFrame:
    return prorated.groupBy("customer_id", "revenue_month").agg(
        F.sum("active_days_in_month").alias("active_days_in_month"),
        F.max("days_in_month").alias("days_in_month"),
        F.round(F.sum("prorated_mrr_amount"), 2).alias("mrr_amount"),
    )


def prorated_months(billable: DataFrame, horizon: DataFrame) -> DataFrame:
    return prorate(clip_overlap(interval_months(apply_horizon(billable, horizon))))


def mrr_monthly(timeline: DataFrame) -> DataFrame:
    """Customer-month revenue of any timeline; overlapping intervals add up."""
    billable = billable_intervals(timeline)
    return monthly_totals(prorated_months(billable, revenue_horizon(billable)))


def mrr_monthly_of_resolved(
    timeline: DataFrame, clustered: bool = False, horizon: Horizon | None = None
) -> DataFrame:
    """The same for a timeline without overlaps, read twice, and once more for an unknown horizon.

    A month strictly inside an interval belongs to that interval alone, so it needs
    neither a shuffle nor an aggregation. Only first and last months can be shared:
    for them the intervals are shuffled by customer (unless they are ``clustered``
    already), then unfolded and added up in place.
    """
    billable = billable_intervals(timeline)
    closed = apply_horizon(billable, horizon or revenue_horizon(billable))
    near = closed if clustered else closed.repartition("customer_id")
    shared = monthly_totals(prorate(clip_overlap(edge_months(near))))
    own = prorate(clip_overlap(inner_months(closed))).select(
        "customer_id",
        "revenue_month",
        "active_days_in_month",
        "days_in_month",
        F.round("prorated_mrr_amount", 2).alias("mrr_amount"),
    )
    return shared.unionByName(own)


def lifetime_value(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_id").agg(
        F.round(F.sum("mrr_amount"), 2).alias("total_lifetime_value")
    )


def _or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0.0))


def dim_customers(customers: DataFrame, summary: DataFrame, fact: DataFrame) -> DataFrame:
    """Every cleaned customer with its current state and lifetime value."""
    return described_customers(customers.join(summary, "customer_id", "left"), lifetime_value(fact))


def customer_facts(timeline: DataFrame, plans: DataFrame, horizon: Horizon) -> DataFrame:
    """Summary and lifetime value per customer of a timeline, shuffled once by customer.

    Each interval gives a row without month, for the summary, and a row per month it earns in.
    They are added up per customer and month, months are rounded, and then per customer, all in
    the partitioning by customer.
    """
    start, end = F.col("resolved_start_date"), F.coalesce("resolved_end_date", _horizon_date(horizon))
    months = F.when(
        F.col("is_billable") & (start <= end), months_between(month_start(start), month_start(end))
    )
    month = F.explode(F.concat(F.expr("array(CAST(NULL AS DATE))"), F.coalesce(months, F.expr("CAST(array() AS array<date>)"))))
    near = timeline.repartition("customer_id").withColumn("effective_end_date", end)
    rows = near.withColumn("revenue_month", month)
    active = inclusive_days(
        F.greatest(start, F.col("revenue_month")),
        F.least(F.col("effective_end_date"), F.last_day("revenue_month")),
    )
    earned = F.col("monthly_cost") * active.cast("double") / days_in_month("revenue_month").cast("double")
    no_month = F.col("revenue_month").isNull()
    per_month = rows.groupBy("customer_id", "revenue_month").agg(
        F.round(F.sum(F.when(~no_month, earned)), 2).alias("mrr_amount"), *summary_aggregates()
    )
    kept = [
        F.first(F.when(no_month, F.col(name)), ignorenulls=True).alias(name)
        for name in SUMMARY_AGGREGATES
    ]
    value = F.round(F.sum(F.when(~no_month, F.col("mrr_amount"))), 2).alias("total_lifetime_value")
    facts = per_month.groupBy("customer_id").agg(value, *kept)
    return describe_latest(facts, plans).drop("latest", "total_resolved_intervals")


def described_customers(customers: DataFrame, facts: DataFrame) -> DataFrame:
    """Every customer with what ``facts`` has on it, in the columns of the dimension."""
    joined = customers.join(facts, "customer_id", "left")
    return joined.select(
        "customer_id",
        "customer_name",
        "customer_email",
        "region",
        "signup_at",
        "current_subscription_status",
        _or_zero("total_lifetime_value").alias("total_lifetime_value"),
        "marketing_source",
        "current_plan_id",
        "current_plan_name",
        "current_monthly_cost",
        "current_subscription_start_date",
        "first_subscription_start_date",
        "latest_subscription_end_date",
        "has_ever_billable_subscription",
        "has_ever_cancelled",
    )
