"""The physical plans keep the shape they were designed for."""

from __future__ import annotations

from datetime import date

import pytest

from conftest import SMALL, plan_of
from tenureline.operators import checks, cleaning, density, intervals, revenue
from tenureline.plans import marts
from tenureline.plans.quality import row_predicates
from tenureline.sources import publish
from workload import bindings
from workload.queries import queries


@pytest.fixture(scope="module")
def cleaned(spark):
    return cleaning.clean_subscriptions(
        bindings.raw_subscriptions(spark, SMALL), bindings.raw_plans(spark)
    )


def test_scan_reads_only_the_needed_columns(spark):
    plan = plan_of(queries()["clean_subscriptions"](spark, SMALL))
    needed = "struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>"
    assert f"ReadSchema: {needed}" in plan


def test_light_keys_are_shuffled_once_per_side(cleaned):
    plan = plan_of(intervals.resolve_subscriptions(cleaned))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "hashpartitioning(customer_id" in plan
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_winner_is_cut_before_ranking(cleaned):
    winners = intervals.winning_segments(cleaned, intervals.SUBSCRIPTIONS)
    assert "WindowGroupLimit" in plan_of(winners)


def test_dense_keys_never_meet_on_the_key_alone(cleaned):
    """Rows of a dense key are cut or made distinct before each shuffle."""
    winners = intervals._winners_of_dense_keys(cleaned, intervals.SUBSCRIPTIONS, None)
    plan = plan_of(winners)
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    exchange = "Exchange hashpartitioning"
    shuffles = [at for at, line in enumerate(lines) if line.startswith(exchange)]
    below = {lines[at]: lines[at + 1].split(" ")[0].split("(")[0] for at in shuffles}
    assert len(shuffles) >= 4
    for shuffle, child in below.items():
        if shuffle.startswith("Exchange hashpartitioning(customer_id#") and "," in shuffle:
            assert child in {"WindowGroupLimit", "HashAggregate", "Project", "Filter"}, shuffle
    joins = [line for line in lines if line.split(" ")[0].endswith("Join")]
    assert any("block" in line for line in joins)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_months_are_generated_and_not_joined(spark, cleaned):
    line = bindings.as_timeline(cleaned)
    billable = revenue.billable_intervals(line)
    plan = plan_of(revenue.prorated_months(billable, revenue.revenue_horizon(billable)))
    assert "Generate explode(sequence" in plan
    assert "Join" not in plan.replace("BroadcastHashJoin", "")


def test_fact_shuffles_intervals_and_not_months(cleaned):
    plan = plan_of(revenue.mrr_monthly_of_resolved(bindings.as_timeline(cleaned)))
    assert "hashpartitioning(customer_id, revenue_month" not in plan
    shared, own = plan.split("Generate explode(sequence", 1)
    assert shared.count("REPARTITION_BY_COL") == 1 and "Exchange" not in own.split("Subquery")[0]


def test_row_checks_share_one_scan(spark):
    raw = bindings.raw_subscriptions(spark, SMALL)
    plan = plan_of(checks.count_violations(raw, row_predicates()["raw_subscriptions"]))
    assert plan.count("FileScan") == 1


def test_report_counts_keys_together_and_forms_no_pairs(spark):
    plan = plan_of(queries()["check_report"](spark, SMALL))
    assert plan.count("FileScan") <= 13 and plan.count("Exchange ") <= 14
    assert plan.count("Join") == 1 and "NestedLoop" not in plan


def test_overlap_check_uses_the_bucketing_of_the_timeline(spark, tmp_path):
    built = marts.build_marts(bindings.raw_tables(spark, SMALL), str(tmp_path), buckets=4)
    plan = plan_of(checks.overlapping_pairs(built.timeline))
    assert "hashpartitioning" not in plan


def staged_plans(spark, monkeypatch, subscriptions, plans):
    """Plans of all that is stored on the way to a timeline, and the timeline's own."""
    seen = []

    def watched(df, name):
        seen.append(plan_of(df))
        return publish.stage_at(df, publish.fresh_path(spark, name))

    monkeypatch.setattr(density, "stage", watched)
    timeline = marts.timeline_of(subscriptions, plans)
    return [*seen, plan_of(timeline)]


def test_subscriptions_are_read_once(spark, monkeypatch):
    """With and without dense keys; what routes them needs no shuffle by key."""
    for subscriptions in (bindings.raw_subscriptions, bindings.skewed_subscriptions):
        raw = subscriptions(spark, SMALL)
        routing, timeline = staged_plans(spark, monkeypatch, raw, bindings.raw_plans(spark))
        assert routing.count("orders.parquet") == 1 and "orders.parquet" not in timeline
        assert "hashpartitioning" not in routing and "CollectMetrics" in routing


def test_keys_with_a_share_of_all_rows_are_dense(spark):
    rows = bindings.skewed_subscriptions(spark, SMALL)
    light, dense = density.route_by_density(rows, "customer_id", 100)
    assert [r[0] for r in dense.select("customer_id").distinct().collect()] == [1]
    assert light.where("customer_id = 1").isEmpty()


def test_all_keys_are_dense_where_the_mean_is_and_not_all_are_named(spark, monkeypatch):
    rows = bindings.raw_subscriptions(spark, SMALL).where("customer_id IS NOT NULL")
    every = density.route_by_density(rows, "customer_id", 0)
    assert every.light.isEmpty() and every.dense.count() == rows.count()
    monkeypatch.setattr(density, "NAMED_KEYS", 5)
    every = density.route_by_density(rows, "customer_id", 0)
    assert every.light is None and every.dense.count() == rows.count()


def test_fact_with_a_known_horizon_reads_the_timeline_once_less(cleaned):
    line = bindings.as_timeline(cleaned)
    known = revenue.mrr_monthly_of_resolved(line, horizon=revenue.Horizon(date(1998, 12, 31)))
    asked = revenue.mrr_monthly_of_resolved(line)
    assert plan_of(known).count("FileScan") == 2 and "Subquery" not in plan_of(known)
    assert plan_of(asked).count("FileScan") > 2 and "Subquery" in plan_of(asked)


def test_dimension_shuffles_the_timeline_once_by_customer(spark):
    plan = plan_of(queries()["dim_customers"](spark, SMALL))
    assert plan.count("FileScan") == 2  # customers and the timeline
    by_customer = [line for line in plan.splitlines() if "Exchange hashpartitioning(customer_id" in line]
    assert sum("REPARTITION_BY_COL" in line for line in by_customer) == 1 and len(by_customer) <= 2


def test_rows_unfolded_into_blocks_are_never_broadcast(spark, cleaned):
    """Their size is estimated before they are unfolded: small tables hide it, larger ones fail."""
    def joins(df):
        return [line for line in plan_of(df).splitlines() if "Join" in line and "block" in line]

    found = [
        joins(intervals.segment_candidates(cleaned, intervals.SUBSCRIPTIONS, dense_rows=0)),
        joins(intervals._winners_of_dense_keys(cleaned, intervals.SUBSCRIPTIONS, None)),
        joins(checks.overlapping_pairs(bindings.as_timeline(cleaned), dense_rows=0)),
        joins(checks.overlap_counts(bindings.as_timeline(cleaned))),
    ]
    for lines in found:
        meeting = [line for line in lines if "LeftOuter" not in line]
        assert len(meeting) == 1 and "SortMergeJoin" in meeting[0]
