"""Checks find planted violations and nothing else."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, plan_of, rows_of
from frames import plans, subscriptions, timeline
from tenureline.operators import checks
from tenureline.operators.cleaning import STATUS_OF_CODE, clean_subscriptions
from tenureline.operators.intervals import resolve_subscriptions
from tenureline.operators.revenue import mrr_monthly, mrr_monthly_of_resolved
from tenureline.plans import marts, quality
from workload import bindings


@pytest.fixture(scope="module")
def raw(spark):
    return subscriptions(
        spark,
        ("a", 1, "basic", "active", "2024-01-01", "2024-01-31"),
        ("b", 1, "basic", "Trial", "2024-02-10", "2024-02-01"),
        ("b", 2, "lost", None, "2024-03-01", None),
        (None, None, None, " CANCELED ", "2024-03-01", "2024-03-01"),
    )


def test_not_null(raw):
    assert checks.not_null(raw, "customer_id").count() == 1
    assert checks.not_null(raw, "subscription_start_date").count() == 0


def test_unique_ignores_nulls(raw):
    assert rows_of(checks.unique(raw, "subscription_id")) == [("b", 2)]
    doubled = raw.unionByName(raw)
    assert (None, 2) not in rows_of(checks.unique(doubled, "subscription_id"))


def test_relationships_ignore_nulls(spark, raw):
    twice = raw.unionByName(raw)
    found = checks.relationships(twice, "plan_id", plans(spark), "plan_id")
    assert rows_of(found) == [("lost",), ("lost",)]
    plan = F.col("plan_id")
    sources = [
        (twice, [checks.Entry("plan_id", plan, "child")]),
        (plans(spark), [checks.Entry("plan_id", plan, "parent")]),
    ]
    counted = checks.counts_of_entries(sources)
    totals = {
        "lost": checks.orphans("plan_id", "child", "parent"),
        "twice": checks.repeated("plan_id", "child"),
    }
    assert rows_of(checks.count_by_key(counted, totals)) == [("lost", 2), ("twice", 2)]


def test_accepted_values_ignore_nulls(raw):
    found = checks.accepted_values(raw, "status_code", ["active", " CANCELED "])
    assert rows_of(found) == [("Trial", 1)]


def test_row_predicates(spark, raw):
    inverted = checks.ends_before_start("subscription_start_date", "subscription_end_date")
    assert [r.subscription_id for r in checks.violates(raw, inverted).collect()] == ["b"]
    unexpected = checks.unexpected_code("status_code", list(STATUS_OF_CODE))
    assert checks.violates(raw, unexpected).count() == 2
    loss = plans(spark, [("x", "X", -1.0), ("y", "Y", 0.0), ("z", "Z", None)])
    found = checks.violates(loss, checks.negative("monthly_cost"))
    assert [r.plan_id for r in found.collect()] == ["x"]


def test_groups(raw):
    pairs = raw.select("subscription_id", "customer_id")
    twice = checks.unique_combination(pairs.unionByName(pairs), ["subscription_id", "customer_id"])
    assert twice.count() == 4 and {r.row_count for r in twice.collect()} == {2}
    open_rows = F.col("subscription_end_date").isNull()
    assert checks.count_above(raw, open_rows, ["customer_id"], 0).count() == 1
    assert checks.count_above(raw, open_rows, ["customer_id"], 1).count() == 0


def test_no_overlap_on_a_resolved_timeline(spark):
    raw_tables = bindings.raw_tables(spark, SMALL)
    line = marts.staged_timeline(raw_tables.subscriptions, raw_tables.plans)
    assert checks.overlapping_pairs(line).count() == 0
    assert checks.overlapping_pairs(line, dense_rows=0).count() == 0


def test_touching_open_intervals_overlap(spark):
    line = timeline(
        spark,
        (1, "a", "basic", "active", "2024-01-01", None, "31.00", True),
        (1, "b", "basic", "active", "2024-06-01", None, "31.00", True),
        (1, "c", "basic", "active", "2023-01-01", "2024-01-01", "31.00", True),
        (2, "d", "basic", "active", "2024-01-01", "2024-01-02", "31.00", True),
        (2, "e", "basic", "active", "2024-01-03", None, "31.00", True),
    )
    pairs = checks.overlapping_pairs(line).collect()
    found = {(r.left_subscription_id, r.right_subscription_id) for r in pairs}
    assert found == {("a", "b"), ("c", "a")}


def test_report_names_and_counts(spark, tmp_path):
    raw_tables = bindings.raw_tables(spark, SMALL)
    built = marts.build_marts(raw_tables, str(tmp_path / "marts"), buckets=4)
    report = {r.check_name: r for r in quality.check_report(raw_tables, built).collect()}
    assert len(report) == 25 + 6 + 6 + 1 + 10
    assert not report["raw_end_before_start"].passed
    assert not report["relationships_raw_subscriptions_plan_id"].passed
    for name in ("overlaps", "invalid_ranges", "active_days", "unique_dimension_customer_id"):
        assert report[name].passed and report[name].failing_rows == 0


def test_invariants_of_the_marts(spark):
    """Resolution keeps the covered days; the fact stays within its months."""
    cleaned = clean_subscriptions(
        bindings.raw_subscriptions(spark, SMALL), bindings.raw_plans(spark)
    ).where("end_date < '2999-12-31'")
    line = resolve_subscriptions(cleaned)

    def days(df, start, end):
        return df.select("customer_id", F.explode(F.sequence(start, end)).alias("day"))

    before = days(cleaned, "start_date", "end_date").distinct().count()
    after = days(line, "resolved_start_date", "resolved_end_date")
    assert after.count() == before == after.distinct().count()
    fact = mrr_monthly_of_resolved(line)
    assert rows_of(fact) == rows_of(mrr_monthly(line))
    assert fact.where("active_days_in_month NOT BETWEEN 1 AND days_in_month").count() == 0


def test_large_blocks_are_dealt_over_salts(spark, monkeypatch):
    """No join key of the dense route holds much more than its share of the rows."""
    timeline = bindings.as_timeline(
        clean_subscriptions(
            bindings.skewed_subscriptions(spark, SMALL), bindings.raw_plans(spark)
        )
    )
    every = rows_of(checks.overlapping_pairs(timeline, dense_rows=0))
    seen, salted = [], checks._salted

    def watched(left, right, key):
        sides = salted(left, right, key)
        seen.append([side.groupBy(key, "block", "salt").count() for side in sides])
        return sides

    monkeypatch.setattr(checks, "BLOCK_ROWS", 8)
    monkeypatch.setattr(checks, "_salted", watched)
    assert rows_of(checks.overlapping_pairs(timeline, dense_rows=0)) == every
    left, right = seen[0]
    assert left.agg(F.max("count")).first()[0] <= 3 * 8
    assert right.where("salt > 0").count() > 0


def test_a_count_of_entries_is_as_wide_as_its_kinds_are(spark, raw):
    """A value shuffles the counts of its own kind's sources, not those of all sources."""
    entries = [checks.Entry(f"kind_{at}", F.lit(at), f"source_{at}") for at in range(20)]
    entries.append(checks.Entry("kind_0", F.lit(0), "source_1"))
    counted = checks.counts_of_entries([(raw, entries)])
    n = raw.count()
    found = {r.kind: r.asDict() for r in counted.collect()}
    for at in range(20):
        own = {f"source_{at}", "source_1"} if at == 0 else {f"source_{at}"}
        expected = {f"source_{i}": n * (f"source_{i}" in own) for i in range(20)}
        assert found[f"kind_{at}"] == {"kind": f"kind_{at}", "key_value": str(at), **expected}
    exchange = plan_of(counted).split("Exchange hashpartitioning", 1)[1]
    assert exchange.splitlines()[1].count("partial_count") == 2


def test_only_intervals_that_may_hold_inverted_ones_become_blocks(spark, monkeypatch):
    seen = []
    blocks = checks.covering_blocks
    monkeypatch.setattr(checks, "covering_blocks", lambda *x: (seen.append(1), blocks(*x))[1])
    rows = [
        (1, "a", "p", "active", "2024-01-01", "2024-01-31", "1.00", True),
        (1, "b", "p", "active", "2024-01-20", "2024-01-10", "1.00", True),
        (1, "c", "p", "active", "2024-03-01", None, "1.00", True),
        (2, "d", "p", "active", "2024-01-01", "2024-01-31", "1.00", True),
    ]
    assert rows_of(checks.overlap_counts(timeline(spark, *rows))) == [(1, 1)]
    assert rows_of(checks.overlap_counts(timeline(spark, rows[0], *rows[2:]))) == []
    plan = plan_of(checks.overlap_counts(timeline(spark, *rows[2:])))
    assert f"<= -{checks._NO_DAY}" in plan
    assert len(seen) == 3
