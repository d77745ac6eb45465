"""Hand-written cases with known results."""

from __future__ import annotations

import pytest

from conftest import day, rows_of
from frames import plans, subscriptions, timeline
from tenureline.operators.cleaning import clean_customers, clean_subscriptions, normalise_status
from tenureline.operators.intervals import (
    collapse_islands,
    island_ids,
    mark_islands,
    resolve_subscriptions,
    SUBSCRIPTIONS,
)
from tenureline.operators.revenue import (
    billable_intervals,
    dim_customers,
    month_spine,
    month_windows,
    mrr_monthly,
    mrr_monthly_of_resolved,
    revenue_horizon,
)
from tenureline.operators.summary import customer_subscription_summary
from tenureline.sources.schemas import RAW_CUSTOMERS


def resolved(spark, *rows, price_list=None, dense_rows=512):
    cleaned = clean_subscriptions(subscriptions(spark, *rows), plans(spark, price_list))
    return resolve_subscriptions(cleaned, dense_rows=dense_rows)


def lines(df):
    """(id, status, start, end, price, billable) by start."""
    return sorted(
        (
            r.resolved_subscription_id,
            r.resolved_status,
            str(r.resolved_start_date),
            str(r.resolved_end_date) if r.resolved_end_date else None,
            r.monthly_cost,
            r.is_billable,
        )
        for r in df.collect()
    )


@pytest.mark.parametrize("dense_rows", [512, 0])
class TestResolution:
    def test_active_splits_pending(self, spark, dense_rows):
        df = resolved(
            spark,
            ("sub_pending", 1, "basic", "pending", "2024-01-01", "2024-01-31"),
            ("sub_active", 1, "basic", "active", "2024-01-10", "2024-01-20"),
            dense_rows=dense_rows,
        )
        assert lines(df) == [
            ("sub_active", "active", "2024-01-10", "2024-01-20", 31.0, True),
            ("sub_pending", "pending", "2024-01-01", "2024-01-09", 31.0, False),
            ("sub_pending", "pending", "2024-01-21", "2024-01-31", 31.0, False),
        ]

    def test_same_day_transition(self, spark, dense_rows):
        df = resolved(
            spark,
            ("sub_cancelled", 2, "basic", "cancelled", "2024-01-01", "2024-01-15"),
            ("sub_active", 2, "pro", "active", "2024-01-15", None),
            dense_rows=dense_rows,
        )
        assert lines(df) == [
            ("sub_active", "active", "2024-01-15", None, 62.0, True),
            ("sub_cancelled", "cancelled", "2024-01-01", "2024-01-14", 31.0, True),
        ]

    def test_ties_go_to_start_then_price_then_id(self, spark, dense_rows):
        df = resolved(
            spark,
            ("early", 1, "pro", "active", "2024-01-01", "2024-01-31"),
            ("late_b", 1, "basic", "active", "2024-01-10", "2024-01-12"),
            ("late_a", 1, "basic", "active", "2024-01-10", "2024-01-12"),
            ("dear", 1, "pro", "active", "2024-01-20", "2024-01-22"),
            ("unpriced", 1, "gone", "active", "2024-01-20", "2024-01-25"),
            dense_rows=dense_rows,
        )
        assert lines(df) == [
            ("dear", "active", "2024-01-20", "2024-01-22", 62.0, True),
            ("early", "active", "2024-01-01", "2024-01-09", 62.0, True),
            ("early", "active", "2024-01-13", "2024-01-19", 62.0, True),
            ("early", "active", "2024-01-26", "2024-01-31", 62.0, True),
            ("late_a", "active", "2024-01-10", "2024-01-12", 31.0, True),
            ("unpriced", "active", "2024-01-23", "2024-01-25", None, True),
        ]

    def test_end_on_the_sentinel_day_comes_back_open(self, spark, dense_rows):
        df = resolved(
            spark,
            ("s", 1, "basic", "active", "2024-01-01", "2999-12-31"),
            dense_rows=dense_rows,
        )
        assert lines(df) == [("s", "active", "2024-01-01", None, 31.0, True)]

    def test_end_after_the_sentinel_day(self, spark, dense_rows):
        df = resolved(
            spark,
            ("open", 1, "basic", "active", "2024-01-01", None),
            ("longer", 1, "basic", "pending", "2024-01-01", "3000-01-05"),
            dense_rows=dense_rows,
        )
        assert lines(df) == [
            ("longer", "pending", "3000-01-01", "3000-01-05", 31.0, False),
            ("open", "active", "2024-01-01", None, 31.0, True),
        ]

    def test_adjacent_rows_of_different_ids_stay_apart(self, spark, dense_rows):
        df = resolved(
            spark,
            ("a", 1, "basic", "active", "2024-01-01", "2024-01-10"),
            ("b", 1, "basic", "active", "2024-01-11", "2024-01-20"),
            dense_rows=dense_rows,
        )
        assert len(lines(df)) == 2

    def test_hidden_boundaries_do_not_split(self, spark, dense_rows):
        df = resolved(
            spark,
            ("a", 1, "basic", "active", "2024-01-01", "2024-01-31"),
            ("b", 1, "basic", "pending", "2024-01-05", "2024-01-10"),
            dense_rows=dense_rows,
        )
        assert lines(df) == [("a", "active", "2024-01-01", "2024-01-31", 31.0, True)]

    def test_null_plan_never_merges(self, spark, dense_rows):
        df = resolved(
            spark,
            ("a", 1, None, "active", "2024-01-01", "2024-01-31"),
            ("b", 1, "basic", "pending", "2024-01-05", "2024-01-10"),
            dense_rows=dense_rows,
        )
        assert [(line[2], line[3]) for line in lines(df)] == [
            ("2024-01-01", "2024-01-04"),
            ("2024-01-05", "2024-01-10"),
            ("2024-01-11", "2024-01-31"),
        ]

    def test_invalid_rows_are_dropped(self, spark, dense_rows):
        df = resolved(
            spark,
            ("trial", 1, "basic", "trial", "2024-01-01", "2024-01-31"),
            ("none", 1, "basic", None, "2024-01-01", "2024-01-31"),
            ("inverted", 1, "basic", "active", "2024-01-31", "2024-01-01"),
            ("nobody", None, "basic", "active", "2024-01-01", "2024-01-02"),
            ("one_day", 1, "basic", " Canceled ", "2024-01-05", "2024-01-05"),
            dense_rows=dense_rows,
        )
        assert lines(df) == [("one_day", "cancelled", "2024-01-05", "2024-01-05", 31.0, True)]


def test_islands_follow_every_attribute(spark):
    segments = spark.createDataFrame(
        [
            (1, day("2024-01-01"), day("2024-01-02"), "a", "p", "active", True, 5),
            (1, day("2024-01-03"), day("2024-01-04"), "a", "p", "active", True, 7),
            (1, day("2024-01-06"), day("2024-01-07"), "a", "p", "active", True, 5),
            (1, day("2024-01-08"), day("2024-01-09"), "a", "q", "active", True, 5),
        ],
        "customer_id bigint, segment_start date, segment_end date, "
        "resolved_subscription_id string, resolved_plan_id string, resolved_status string, "
        "is_billable boolean, monthly_cost int",
    )
    marked = mark_islands(segments, "customer_id", SUBSCRIPTIONS.attributes)
    numbered = island_ids(marked, "customer_id")
    ids = [r.segment_group_id for r in numbered.orderBy("segment_start").collect()]
    assert ids == [1, 1, 2, 3]
    first = collapse_islands(numbered, SUBSCRIPTIONS).orderBy("resolved_start_date").first()
    assert (first.resolved_end_date, first.monthly_cost) == (day("2024-01-04"), 7)


class TestMonthlyRevenue:
    def fact(self, spark, *rows):
        line = timeline(spark, *rows)
        found = [(*r[:1], str(r[1]), *r[2:]) for r in rows_of(mrr_monthly(line))]
        assert rows_of(mrr_monthly_of_resolved(line)) == rows_of(mrr_monthly(line))
        assert rows_of(mrr_monthly_of_resolved(line, True)) == rows_of(mrr_monthly(line))
        return sorted(found)

    def test_mid_month_cancellation(self, spark):
        row = (10, "s", "basic", "cancelled", "2024-01-10", "2024-01-20", "31.00", True)
        assert self.fact(spark, row) == [(10, "2024-01-01", 11, 31, 11.0)]

    def test_plan_switch_in_month(self, spark):
        assert self.fact(
            spark,
            (11, "a", "basic", "active", "2024-01-01", "2024-01-15", "31.00", True),
            (11, "b", "pro", "active", "2024-01-16", "2024-01-31", "62.00", True),
        ) == [(11, "2024-01-01", 31, 31, 47.0)]

    def test_open_interval_ends_at_the_latest_end(self, spark):
        assert self.fact(
            spark,
            (1, "a", "basic", "active", "2024-01-15", None, "31.00", True),
            (2, "b", "basic", "active", "2024-01-01", "2024-02-10", "29.00", True),
        ) == [
            (1, "2024-01-01", 17, 31, 17.0),
            (1, "2024-02-01", 10, 29, 10.69),
            (2, "2024-01-01", 31, 31, 29.0),
            (2, "2024-02-01", 10, 29, 10.0),
        ]

    def test_months_inside_an_interval(self, spark):
        assert self.fact(
            spark,
            (1, "a", "basic", "active", "2023-12-31", "2024-03-30", "31.00", True),
            (1, "b", "pro", "active", "2024-03-31", "2024-04-30", "62.00", True),
        ) == [
            (1, "2023-12-01", 1, 31, 1.0),
            (1, "2024-01-01", 31, 31, 31.0),
            (1, "2024-02-01", 29, 29, 31.0),
            (1, "2024-03-01", 31, 31, 32.0),
            (1, "2024-04-01", 30, 30, 62.0),
        ]

    def test_overlapping_intervals_add_up(self, spark):
        line = timeline(
            spark,
            (1, "a", "basic", "active", "2024-01-01", "2024-03-31", "31.00", True),
            (1, "b", "pro", "active", "2024-02-01", "2024-02-29", "62.00", True),
        )
        assert [r[2:] for r in rows_of(mrr_monthly(line))][1] == (58, 29, 93.0)

    def test_open_interval_after_the_horizon_earns_nothing(self, spark):
        closed = (1, "a", "basic", "active", "2024-01-01", "2024-01-10", "31.00", True)
        same_month = (2, "b", "basic", "active", "2024-01-20", None, "31.00", True)
        later_month = (3, "c", "basic", "active", "2024-03-05", None, "31.00", True)
        assert self.fact(spark, closed, same_month, later_month) == [
            (1, "2024-01-01", 10, 31, 10.0)
        ]

    def test_all_open_ends_at_the_latest_start(self, spark):
        assert self.fact(
            spark,
            (1, "a", "basic", "active", "2024-01-30", None, "31.00", True),
            (2, "b", "basic", "active", "2024-01-31", None, "31.00", True),
        ) == [(1, "2024-01-01", 2, 31, 2.0), (2, "2024-01-01", 1, 31, 1.0)]

    def test_nothing_billable(self, spark):
        row = (1, "a", "basic", "pending", "2024-01-01", "2024-01-31", "31.00", False)
        assert self.fact(spark, row) == []
        horizon = revenue_horizon(billable_intervals(timeline(spark, row)))
        assert rows_of(horizon) == [(None, None, None)]
        assert rows_of(month_windows(month_spine(horizon))) == [(None, None, None)]

    def test_unknown_price_gives_a_null_amount(self, spark):
        row = (1, "a", "gone", "active", "2024-01-01", "2024-01-31", None, True)
        assert self.fact(spark, row) == [(1, "2024-01-01", 31, 31, None)]

    def test_spine_longer_than_a_hundred_months(self, spark):
        row = (1, "a", "basic", "active", "2000-01-15", "2024-12-31", "31.00", True)
        horizon = revenue_horizon(billable_intervals(timeline(spark, row)))
        rows = rows_of(month_windows(month_spine(horizon)))
        assert len(rows) == 300
        assert (day("2000-02-01"), day("2000-02-29"), 29) in rows


class TestSummaryAndDimension:
    def test_closed_latest_interval_hides_the_plan(self, spark):
        line = timeline(
            spark,
            (1, "a", "basic", "active", "2024-01-01", "2024-01-31", "31.00", True),
            (1, "b", "pro", "cancelled", "2024-03-01", "2024-03-05", "62.00", True),
        )
        (row,) = rows_of(customer_subscription_summary(line, plans(spark)))
        assert row == (
            1, "cancelled", None, None, None, None,
            day("2024-01-01"), day("2024-03-05"), True, True, 2,
        )

    def test_open_latest_interval_with_an_earlier_end(self, spark):
        line = timeline(
            spark,
            (1, "a", "basic", "pending", "2024-01-01", "2024-01-31", "31.00", False),
            (1, "b", "pro", "pending", "2024-03-01", None, "62.00", False),
        )
        (row,) = customer_subscription_summary(line, plans(spark)).collect()
        assert (row.current_plan_name, row.current_monthly_cost) == ("Pro", 62)
        assert row.latest_subscription_end_date == day("2024-01-31")
        assert not row.has_ever_billable_subscription and not row.has_ever_cancelled

    def test_customers_without_subscriptions_are_kept(self, spark):
        raw = spark.createDataFrame(
            [
                (1, " Ann ", " A@X.Com ", "2024-01-01 10:00:00", "{}", " None ", "none"),
                (2, None, None, None, None, "", None),
            ],
            RAW_CUSTOMERS,
        )
        customers = clean_customers(raw)
        row = (1, "a", "basic", "active", "2024-01-01", "2024-01-31", "31.00", True)
        line = timeline(spark, row)
        summary = customer_subscription_summary(line, plans(spark))
        dimension = dim_customers(customers, summary, mrr_monthly(line))
        ann, other = dimension.orderBy("customer_id").collect()
        assert (ann.customer_name, ann.customer_email, ann.region) == ("Ann", "a@x.com", None)
        assert ann.marketing_source == "none" and ann.total_lifetime_value == 31.0
        assert other.region == "" and other.total_lifetime_value == 0.0
        assert other.current_subscription_status is None


def test_status_codes(spark):
    codes = [" Active ", "CANCELED", "cancelled", "pending", "trial", "", None]
    df = spark.createDataFrame([(code,) for code in codes], "code string")
    got = [tuple(r)[1:] for r in normalise_status(df, "code").collect()]
    assert got == [
        ("active", True, 3),
        ("cancelled", True, 2),
        ("cancelled", True, 2),
        ("pending", False, 1),
        (None, False, 0),
        (None, False, 0),
        (None, False, 0),
    ]
