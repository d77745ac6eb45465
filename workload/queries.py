"""Every operator as a query over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenureline.operators import checks, cleaning, intervals, revenue, summary
from tenureline.plans import marts, quality
from tenureline.sources import extracts, schemas
from tenureline.sources.publish import fresh_path, publish_table, publish_view, stage
from workload import bindings

Query = Callable[[SparkSession, str], DataFrame]
SPEC = intervals.SUBSCRIPTIONS
_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__.removeprefix("query_")] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return bindings.raw_subscriptions(spark, sf_dir), bindings.raw_plans(spark)


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_subscriptions(*_inputs(spark, sf_dir))


def _unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bindings.as_timeline(_cleaned(spark, sf_dir))


def _timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.timeline_of(*_inputs(spark, sf_dir))


def _billable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue.billable_intervals(_timeline(spark, sf_dir))


def _closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    timeline, horizon = marts.observed_timeline(*_inputs(spark, sf_dir))
    return revenue.apply_horizon(revenue.billable_intervals(timeline), horizon)


# -- sources and sinks ---------------------------------------------------------------


@_query
def load_plans(spark, sf_dir):
    path = fresh_path(spark, "plans_extract")
    extracts.write_extract(bindings.part_plans(spark, sf_dir), path)
    return extracts.read_extract(spark, path, schemas.RAW_PLANS)


@_query
def load_customers(spark, sf_dir):
    path = fresh_path(spark, "customers_extract")
    extracts.write_extract(bindings.raw_customers(spark, sf_dir), path)
    return extracts.read_extract(spark, path, schemas.RAW_CUSTOMERS)


@_query
def load_subscriptions(spark, sf_dir):
    path = fresh_path(spark, "subscriptions_extract")
    extracts.write_extract(bindings.raw_subscriptions(spark, sf_dir), path)
    return extracts.read_extract(spark, path, schemas.RAW_SUBSCRIPTIONS)


@_query
def query_publish_view(spark, sf_dir):
    customers = cleaning.clean_customers(bindings.raw_customers(spark, sf_dir))
    return publish_view(customers, "intermediate", "customers_enriched")


@_query
def query_publish_table(spark, sf_dir):
    fact = marts.monthly_revenue(*_inputs(spark, sf_dir))
    return publish_table(fact, fresh_path(spark, "published"), "marts", "mrr_monthly")


@_query
def publish_marts(spark, sf_dir):
    root = fresh_path(spark, "marts")
    return marts.build_marts(bindings.raw_tables(spark, sf_dir), root).dimension


@_query
def publish_marts_fact(spark, sf_dir):
    root = fresh_path(spark, "marts")
    return marts.build_marts(bindings.raw_tables(spark, sf_dir), root, prefix="of_fact_").fact


@_query
def publish_marts_timeline(spark, sf_dir):
    root = fresh_path(spark, "marts")
    raw = bindings.raw_tables(spark, sf_dir)
    return marts.build_marts(raw, root, prefix="of_timeline_").timeline


# -- cleaning ------------------------------------------------------------------------


@_query
def clean_customers(spark, sf_dir):
    return cleaning.clean_customers(bindings.raw_customers(spark, sf_dir))


@_query
def normalise_status(spark, sf_dir):
    return cleaning.normalise_status(bindings.raw_subscriptions(spark, sf_dir), "status_code")


@_query
def attach_plan_price(spark, sf_dir):
    subscriptions, plans = _inputs(spark, sf_dir)
    return cleaning.lookup(subscriptions, plans, "plan_id", ["monthly_cost"])


@_query
def filter_valid_subscriptions(spark, sf_dir):
    coded = cleaning.normalise_status(bindings.raw_subscriptions(spark, sf_dir), "status_code")
    return cleaning.valid_intervals(
        coded, "subscription_start_date", "subscription_end_date", "status_code"
    )


@_query
def clean_subscriptions(spark, sf_dir):
    return _cleaned(spark, sf_dir)


# -- interval resolution -------------------------------------------------------------


@_query
def interval_boundaries(spark, sf_dir):
    return intervals.interval_boundaries(_cleaned(spark, sf_dir), SPEC.key, SPEC.start, SPEC.end)


@_query
def distinct_boundaries(spark, sf_dir):
    return intervals.distinct_boundaries(_cleaned(spark, sf_dir), SPEC.key, SPEC.start, SPEC.end)


@_query
def atomic_segments(spark, sf_dir):
    return intervals.atomic_segments(_cleaned(spark, sf_dir), SPEC.key, SPEC.start, SPEC.end)


@_query
def segment_candidates(spark, sf_dir):
    return intervals.segment_candidates(_cleaned(spark, sf_dir), SPEC)


@_query
def segment_candidates_by_block(spark, sf_dir):
    """The candidates as dense keys get them: every key above the limit of rows."""
    return intervals.segment_candidates(_cleaned(spark, sf_dir), SPEC, dense_rows=0)


@_query
def pick_winner(spark, sf_dir):
    return intervals.winning_segments(_cleaned(spark, sf_dir), SPEC)


@_query
def mark_islands(spark, sf_dir):
    winners = intervals.winning_segments(_cleaned(spark, sf_dir), SPEC)
    return intervals.mark_islands(winners, SPEC.key, SPEC.attributes)


@_query
def island_ids(spark, sf_dir):
    return intervals.island_ids(mark_islands(spark, sf_dir), SPEC.key)


@_query
def collapse_islands(spark, sf_dir):
    return intervals.collapse_islands(island_ids(spark, sf_dir), SPEC)


@_query
def resolve_subscriptions(spark, sf_dir):
    return _timeline(spark, sf_dir)


@_query
def resolve_skewed_subscriptions(spark, sf_dir):
    cleaned = cleaning.clean_subscriptions(
        bindings.skewed_subscriptions(spark, sf_dir), bindings.raw_plans(spark)
    )
    return intervals.resolve_subscriptions(cleaned)


# -- customer summary ----------------------------------------------------------------


@_query
def latest_interval(spark, sf_dir):
    return summary.latest_interval(_timeline(spark, sf_dir), bindings.raw_plans(spark))


@_query
def subscription_history(spark, sf_dir):
    return summary.subscription_history(_timeline(spark, sf_dir))


@_query
def customer_subscription_summary(spark, sf_dir):
    return summary.customer_subscription_summary(
        _timeline(spark, sf_dir), bindings.raw_plans(spark)
    )


# -- revenue -------------------------------------------------------------------------


@_query
def billable_intervals(spark, sf_dir):
    return _billable(spark, sf_dir)


@_query
def revenue_horizon(spark, sf_dir):
    return revenue.revenue_horizon(_billable(spark, sf_dir))


@_query
def month_spine(spark, sf_dir):
    return revenue.month_spine(revenue_horizon(spark, sf_dir))


@_query
def month_windows(spark, sf_dir):
    return revenue.month_windows(month_spine(spark, sf_dir))


@_query
def apply_horizon(spark, sf_dir):
    return _closed(spark, sf_dir)


@_query
def interval_months(spark, sf_dir):
    return revenue.interval_months(_closed(spark, sf_dir))


@_query
def clip_overlap(spark, sf_dir):
    return revenue.clip_overlap(interval_months(spark, sf_dir))


@_query
def prorate(spark, sf_dir):
    return revenue.prorate(clip_overlap(spark, sf_dir))


@_query
def mrr_monthly(spark, sf_dir):
    return marts.monthly_revenue(*_inputs(spark, sf_dir))


@_query
def lifetime_value(spark, sf_dir):
    return revenue.lifetime_value(mrr_monthly(spark, sf_dir))


@_query
def dim_customers(spark, sf_dir):
    return marts.customer_dimension(bindings.raw_tables(spark, sf_dir))


# -- data-quality checks, each on an input that breaks it ----------------------------


@_query
def check_not_null(spark, sf_dir):
    return checks.not_null(bindings.raw_customers(spark, sf_dir), "customer_email")


@_query
def check_unique(spark, sf_dir):
    return checks.unique(bindings.raw_subscriptions(spark, sf_dir), "customer_id")


@_query
def check_relationships(spark, sf_dir):
    subscriptions, plans = _inputs(spark, sf_dir)
    return checks.relationships(subscriptions, "plan_id", plans, "plan_id")


@_query
def check_accepted_values(spark, sf_dir):
    return checks.accepted_values(
        bindings.raw_subscriptions(spark, sf_dir),
        "status_code",
        list(cleaning.STATUS_OF_CODE),
    )


@_query
def check_negative_mrr(spark, sf_dir):
    subscriptions, plans = bindings.raw_subscriptions(spark, sf_dir), bindings.raw_plans(spark, -20)
    fact = marts.monthly_revenue(subscriptions, plans)
    return checks.violates(fact, checks.negative("mrr_amount"))


@_query
def check_active_days(spark, sf_dir):
    fact = revenue.mrr_monthly(_unresolved(spark, sf_dir))
    return checks.violates(fact, F.col("active_days_in_month") > F.col("days_in_month"))


@_query
def check_invalid_ranges(spark, sf_dir):
    typed = cleaning.typed_subscriptions(bindings.raw_subscriptions(spark, sf_dir))
    return checks.violates(typed, checks.ends_before_start("start_date", "end_date"))


@_query
def check_negative_price(spark, sf_dir):
    plans = bindings.supplier_plans(spark, sf_dir)
    return checks.violates(plans, checks.negative("monthly_cost"))


@_query
def check_raw_end_before_start(spark, sf_dir):
    return checks.violates(
        bindings.raw_subscriptions(spark, sf_dir),
        checks.ends_before_start("subscription_start_date", "subscription_end_date"),
    )


@_query
def check_unexpected_status(spark, sf_dir):
    return checks.violates(
        bindings.raw_subscriptions(spark, sf_dir),
        checks.unexpected_code("status_code", list(cleaning.STATUS_OF_CODE)),
    )


@_query
def check_duplicate_customer_month(spark, sf_dir):
    billable = revenue.billable_intervals(_unresolved(spark, sf_dir))
    months = revenue.prorated_months(billable, revenue.revenue_horizon(billable))
    return checks.unique_combination(months, ["customer_id", "revenue_month"])


@_query
def check_multiple_open_billable(spark, sf_dir):
    return checks.count_above(
        _unresolved(spark, sf_dir),
        F.col("resolved_end_date").isNull() & F.col("is_billable"),
        ["customer_id"],
        1,
        "open_billable_interval_count",
    )


@_query
def check_overlaps(spark, sf_dir):
    return checks.overlapping_pairs(_unresolved(spark, sf_dir))


@_query
def check_overlap_counts(spark, sf_dir):
    cleaned = cleaning.clean_subscriptions(
        bindings.skewed_subscriptions(spark, sf_dir), bindings.raw_plans(spark)
    )
    return checks.overlap_counts(bindings.as_timeline(cleaned))


@_query
def check_open_after_horizon(spark, sf_dir):
    timeline = bindings.late_starters_open(_unresolved(spark, sf_dir))
    return checks.opens_after_horizon(revenue.billable_intervals(timeline))


@_query
def check_report(spark, sf_dir):
    raw = bindings.raw_tables(spark, sf_dir)
    timeline = marts.staged_timeline(raw.subscriptions, raw.plans)
    cleaned_customers = cleaning.clean_customers(raw.customers)
    by_customer = stage(
        summary.customer_subscription_summary(timeline, raw.plans), "customer_summary"
    )
    fact = stage(revenue.mrr_monthly_of_resolved(timeline), "mrr_monthly")
    dimension = stage(
        revenue.dim_customers(cleaned_customers, by_customer, fact), "customers"
    )
    return quality.check_report(
        raw, marts.Marts(cleaned_customers, timeline, by_customer, fact, dimension)
    )
