"""The data-quality catalogue of the subscription marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenureline.operators import checks
from tenureline.operators.cleaning import STATUS_OF_CODE, STATUS_PRECEDENCE
from tenureline.operators.revenue import billable_intervals
from tenureline.plans.marts import Marts, RawTables

# Columns that must be present, be unique, or refer to another table.
REQUIRED = {
    "raw_customers": ["customer_id", "customer_email", "signup_at"],
    "raw_subscriptions": [
        "subscription_id",
        "customer_id",
        "plan_id",
        "subscription_start_date",
    ],
    "raw_plans": ["plan_id", "plan_name", "monthly_cost"],
    "timeline": [
        "customer_id",
        "resolved_subscription_id",
        "resolved_plan_id",
        "resolved_status",
        "resolved_start_date",
        "is_billable",
    ],
    "customers": ["customer_id", "customer_email", "signup_at"],
    "summary": ["customer_id"],
    "fact": ["customer_id", "revenue_month", "mrr_amount"],
    "dimension": ["customer_id", "customer_email"],
}
UNIQUE = {
    "raw_customers": "customer_id",
    "raw_subscriptions": "subscription_id",
    "raw_plans": "plan_id",
    "customers": "customer_id",
    "summary": "customer_id",
    "dimension": "customer_id",
}
REFERENCES = [
    ("raw_subscriptions", "customer_id", "raw_customers", "customer_id"),
    ("raw_subscriptions", "plan_id", "raw_plans", "plan_id"),
    ("timeline", "customer_id", "raw_customers", "customer_id"),
    ("timeline", "resolved_plan_id", "raw_plans", "plan_id"),
    ("summary", "customer_id", "raw_customers", "customer_id"),
    ("fact", "customer_id", "raw_customers", "customer_id"),
]


def row_predicates() -> dict[str, dict[str, Column]]:
    """Checks on single rows, by table."""
    predicates = {
        table: {f"not_null_{table}_{column}": F.col(column).isNull() for column in columns}
        for table, columns in REQUIRED.items()
    }
    predicates["raw_plans"]["negative_price"] = checks.negative("monthly_cost")
    predicates["raw_subscriptions"]["raw_end_before_start"] = checks.ends_before_start(
        "subscription_start_date", "subscription_end_date"
    )
    predicates["raw_subscriptions"]["unexpected_status"] = checks.unexpected_code(
        "status_code", list(STATUS_OF_CODE)
    )
    predicates["timeline"]["invalid_ranges"] = checks.ends_before_start(
        "resolved_start_date", "resolved_end_date"
    )
    predicates["fact"]["negative_mrr"] = checks.negative("mrr_amount")
    predicates["fact"]["active_days"] = F.col("active_days_in_month") > F.col("days_in_month")
    return predicates


def _entries_and_totals() -> tuple[dict[str, list[checks.Entry]], dict[str, Column]]:
    """What each table adds to the shared counts, and the checks read off them."""
    entries: dict[str, list[checks.Entry]] = {}
    totals: dict[str, Column] = {}
    for table, predicates in row_predicates().items():
        for name, predicate in predicates.items():
            entries.setdefault(table, []).append(
                checks.Entry(name, F.lit(name), name, predicate)
            )
            totals[name] = checks.entered(name, name)

    keys = {(child, column): key for child, column, _, key in REFERENCES}
    keys |= {(table, column): column for table, column in UNIQUE.items()}
    for (table, column), key in keys.items():
        entries[table].append(checks.Entry(key, F.col(column), f"{table}_{column}"))
    for table, column in UNIQUE.items():
        totals[f"unique_{table}_{column}"] = checks.repeated(column, f"{table}_{column}")
    for child, column, parent, key in REFERENCES:
        totals[f"relationships_{child}_{column}"] = checks.orphans(
            key, f"{child}_{column}", f"{parent}_{key}"
        )

    open_billable = F.col("resolved_end_date").isNull() & F.col("is_billable")
    unknown = ~F.col("resolved_status").isin(list(STATUS_PRECEDENCE))
    months = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("customer_id", "revenue_month")]
    entries["timeline"] += [
        checks.Entry("customer_id", F.col("customer_id"), "open_billable", open_billable),
        checks.Entry("status", F.col("resolved_status"), "unknown_status", unknown),
    ]
    entries["fact"].append(checks.Entry("customer_month", F.concat_ws(" ", *months), "months"))
    totals["multiple_open_billable"] = checks.values("customer_id", "open_billable", 1)
    totals["accepted_values_timeline_resolved_status"] = checks.values("status", "unknown_status")
    totals["duplicate_customer_month"] = checks.values("customer_month", "months", 1)
    return entries, totals


def check_report(raw: RawTables, marts: Marts) -> DataFrame:
    """Every declared check with its number of failing rows.

    Each table is scanned once for its row checks, keys and values together; all of them share one
    shuffle of counts. Overlaps are counted per day, no pair is formed.
    """
    tables = {
        "raw_customers": raw.customers,
        "raw_subscriptions": raw.subscriptions,
        "raw_plans": raw.plans,
        **marts._asdict(),
    }
    entries, totals = _entries_and_totals()
    counted = checks.counts_of_entries([(tables[name], own) for name, own in entries.items()])
    late = checks.opens_after_horizon(billable_intervals(marts.timeline))
    return checks.report(
        [
            checks.count_by_key(counted, totals),
            checks.count_rows("open_after_horizon", late),
            checks.count_records("overlaps", checks.overlap_counts(marts.timeline)),
        ]
    )
