"""The subscription marts: what is computed from what, and what is stored."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation

from tenureline.operators.cleaning import clean_customers, clean_subscriptions
from tenureline.operators.density import DENSE_ROWS
from tenureline.operators.intervals import resolve_subscriptions
from tenureline.operators.revenue import (
    Horizon,
    customer_facts,
    described_customers,
    dim_customers,
    horizon_metrics,
    mrr_monthly_of_resolved,
)
from tenureline.operators.summary import customer_subscription_summary
from tenureline.sources.publish import (
    fresh_path,
    publish_table,
    publish_view,
    scratch,
    stage_at,
)


class RawTables(NamedTuple):
    customers: DataFrame
    subscriptions: DataFrame
    plans: DataFrame


class Marts(NamedTuple):
    customers: DataFrame
    timeline: DataFrame
    summary: DataFrame
    fact: DataFrame
    dimension: DataFrame


def timeline_of(
    subscriptions: DataFrame,
    plans: DataFrame,
    dense_rows: int = DENSE_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """The resolved timeline; subscriptions are read once, and stored with their prices."""
    return resolve_subscriptions(clean_subscriptions(subscriptions, plans), dense_rows, partitions)


def observed_timeline(subscriptions: DataFrame, plans: DataFrame) -> tuple[DataFrame, Horizon]:
    """The timeline, computed once and stored, and its horizon, seen while it was stored."""
    spark, seen = subscriptions.sparkSession, Observation()
    path = fresh_path(spark, "timeline")
    with scratch(spark):
        timeline = timeline_of(subscriptions, plans).observe(seen, *horizon_metrics())
        timeline = stage_at(timeline, path)
    return timeline, Horizon(seen.get["last_end"] or seen.get["last_start"])


def staged_timeline(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    return observed_timeline(subscriptions, plans)[0]


def monthly_revenue(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    timeline, horizon = observed_timeline(subscriptions, plans)
    return mrr_monthly_of_resolved(timeline, horizon=horizon)


def customer_dimension(raw: RawTables) -> DataFrame:
    timeline, horizon = observed_timeline(raw.subscriptions, raw.plans)
    facts = customer_facts(timeline, raw.plans, horizon)
    return described_customers(clean_customers(raw.customers), facts)


def build_marts(
    raw: RawTables,
    root: str,
    buckets: int | None = None,
    dense_rows: int = DENSE_ROWS,
    prefix: str = "",
) -> Marts:
    """Rebuild everything under ``root``; databases are named ``prefix`` and the layer.

    The extracts are read once and stored as Parquet in the staging layer.

    Timeline, fact and dimension are stored bucketed by customer. The timeline is
    resolved in that partitioning already, so its one shuffle serves the bucketed
    write, the summary, the fact and the joins of the dimension.
    """
    spark = raw.subscriptions.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucketing = {"bucket_by": "customer_id", "buckets": buckets}
    raw = RawTables(
        *(publish_table(df, root, "staging", name) for name, df in raw._asdict().items())
    )
    customers = publish_view(clean_customers(raw.customers), "intermediate", "customers_enriched")
    seen = Observation()
    with scratch(spark):
        timeline = publish_table(
            timeline_of(raw.subscriptions, raw.plans, dense_rows, buckets).observe(
                seen, *horizon_metrics()
            ),
            root,
            "intermediate",
            "subscriptions_resolved",
            database=f"{prefix}intermediate",
            **bucketing,
        )
    horizon = Horizon(seen.get["last_end"] or seen.get["last_start"])
    summary = publish_view(
        customer_subscription_summary(timeline, raw.plans),
        "intermediate",
        "customer_subscription_summary",
    )
    fact = publish_table(
        mrr_monthly_of_resolved(timeline, clustered=True, horizon=horizon),
        root,
        "marts",
        "mrr_monthly",
        database=f"{prefix}marts",
        **bucketing,
    )
    dimension = publish_table(
        dim_customers(customers, summary, fact),
        root,
        "marts",
        "customers",
        database=f"{prefix}marts",
        **bucketing,
    )
    return Marts(customers, timeline, summary, fact, dimension)
