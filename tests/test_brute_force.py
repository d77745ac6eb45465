"""Random intervals against a day-by-day computation in plain Python."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta
from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows_of
from frames import CLEANED
from tenureline.operators.checks import overlap_counts, overlapping_pairs
from tenureline.operators.intervals import SUBSCRIPTIONS, resolve_subscriptions, segment_candidates
from workload.bindings import as_timeline

ORIGIN = date(2024, 1, 1)
OPEN = date(2999, 12, 31)
STATUS = {"active": (True, 3), "cancelled": (True, 2), "pending": (False, 1)}


def interval(number, customer, plan, status, offset, length, price):
    start = ORIGIN + timedelta(days=offset)
    end = OPEN if length is None else start + timedelta(days=length)
    billable, precedence = STATUS[status]
    return (f"s{number:04}", customer, plan, status, start, end, price, billable, precedence)


drawn = st.tuples(
    st.integers(1, 4),
    st.sampled_from(["p1", "p2"]),
    st.sampled_from(sorted(STATUS)),
    st.integers(0, 80),
    st.one_of(st.none(), st.integers(0, 40)),
    st.sampled_from([None, 20, 50]),
)


def winner_per_day(rows):
    """{customer: [(day, winning row)]}, open intervals followed one day past the end."""
    last = max([r[4] for r in rows] + [r[5] for r in rows if r[5] < OPEN]) + timedelta(days=1)
    winners = {}
    for customer in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == customer]
        days = []
        current = ORIGIN
        while current <= last:
            alive = [r for r in mine if r[4] <= current <= r[5]]
            if alive:
                best = min(alive, key=lambda r: (-r[8], -r[4].toordinal(), -(r[6] or -1), r[0]))
                days.append((current, best))
            current += timedelta(days=1)
        winners[customer] = days
    return winners, last


def expected_timeline(rows):
    winners, last = winner_per_day(rows)
    result = []
    for customer, days in winners.items():
        for current, row in days:
            previous = result[-1] if result else None
            if (
                previous
                and previous[:2] == [customer, row[0]]
                and previous[5] == current - timedelta(days=1)
            ):
                previous[5] = current
            else:
                result.append([customer, row[0], row[2], row[3], current, current, row[6], row[7]])
    for line in result:
        if line[5] == last:
            line[5] = None
    return sorted((tuple(line) for line in result), key=repr)


@pytest.mark.parametrize("dense_rows", [512, 4, 0])
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(drawn, min_size=1, max_size=40))
def test_resolution(spark, dense_rows, draws):
    rows = [interval(number, *draw) for number, draw in enumerate(draws)]
    cleaned = spark.createDataFrame(rows, CLEANED)
    assert rows_of(resolve_subscriptions(cleaned, dense_rows)) == expected_timeline(rows)


def many_intervals(count: int, customers: int):
    source = random.Random(11)
    rows = []
    for number in range(count):
        hot = source.random() < 0.34
        rows.append(
            interval(
                number,
                1 if hot else source.randint(2, customers),
                source.choice(["p1", "p2"]),
                source.choice(sorted(STATUS)),
                source.randint(0, 80),
                source.choice([None, 0, 1, 5, 30]),
                source.choice([None, 20, 50]),
            )
        )
    return rows


def test_one_customer_with_a_third_of_all_rows(spark):
    rows = many_intervals(3000, 40)
    cleaned = spark.createDataFrame(rows, CLEANED)
    expected = expected_timeline(rows)
    for dense_rows in (10_000, 512, 0):
        assert rows_of(resolve_subscriptions(cleaned, dense_rows)) == expected


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_light_keys_stay_light_beside_many_dense_ones(spark, monkeypatch, broadcast):
    """However many keys are dense, and whether or not they can be broadcast."""
    from tenureline.operators import checks, density, intervals

    rows = many_intervals(300, 20)
    cleaned = spark.createDataFrame(rows, CLEANED)
    sizes = {r[0]: r[1] for r in cleaned.groupBy("customer_id").count().collect()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    limit = sorted(sizes.values())[len(sizes) // 4]
    seen = []

    def watched(df, key, dense_rows, **more):
        routed = density.route_by_density(df, key, dense_rows, **more)
        seen.append({r[0] for r in routed.light.select(key).distinct().collect()})
        return routed

    monkeypatch.setattr(intervals, "route_by_density", watched)
    monkeypatch.setattr(checks, "route_by_density", watched)
    try:
        assert rows_of(resolve_subscriptions(cleaned, limit)) == expected_timeline(rows)
        timeline = cleaned.selectExpr(
            "*", "start_date AS resolved_start_date", "end_date AS resolved_end_date"
        )
        every = rows_of(checks.overlapping_pairs(timeline, dense_rows=10_000))
        assert rows_of(checks.overlapping_pairs(timeline, dense_rows=limit)) == every
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    light = {key for key, n in sizes.items() if key is not None and n <= limit}
    assert light and light < {key for key in sizes if key is not None}
    assert seen[0] == seen[2] == light


def test_candidates_are_the_containing_intervals(spark):
    rows = many_intervals(200, 10)
    cleaned = spark.createDataFrame(rows, CLEANED)
    near = rows_of(segment_candidates(cleaned, SUBSCRIPTIONS, 10_000))
    assert near == rows_of(segment_candidates(cleaned, SUBSCRIPTIONS, 0))
    assert near == rows_of(segment_candidates(cleaned, SUBSCRIPTIONS, 20))
    assert all(row[1] >= row[6] and row[2] <= row[7] for row in near)


def expected_pairs(rows):
    """Pairs by position, as (customer, left id, right id, start, end, start, end)."""
    pairs = []
    for customer in {r[0] for r in rows}:
        mine = sorted(
            (r for r in rows if r[0] == customer),
            key=lambda r: (r[4], r[5] or OPEN, r[1], r[2] or "~", r[3], r[5] is None),
        )
        for left, right in combinations(mine, 2):
            if left[4] <= (right[5] or OPEN) and (left[5] or OPEN) >= right[4]:
                pairs.append((customer, left[1], right[1], left[4], left[5], right[4], right[5]))
    return sorted(pairs, key=repr)


@pytest.mark.parametrize("dense_rows", [10_000, 30, 0])
def test_overlapping_pairs_with_copies_and_inverted_ranges(spark, dense_rows):
    cleaned = many_intervals(150, 8)
    cleaned += cleaned[:30] + cleaned[:10]  # copies of whole rows
    start = date(2024, 2, 10)
    cleaned += [
        ("inverted", 1, "p1", "active", start, start - timedelta(days=20), 20, True, 3),
        ("inverted", 1, "p1", "active", start, start - timedelta(days=20), 20, True, 3),
        ("nulls", 1, None, "active", start, start + timedelta(days=5), None, True, 3),
        ("nulls", 1, "p1", "active", start, start + timedelta(days=5), None, True, 3),
    ]
    df = as_timeline(spark.createDataFrame(cleaned, CLEANED))
    rows = [tuple(r) for r in df.collect()]
    pairs = expected_pairs(rows)
    assert rows_of(overlapping_pairs(df, dense_rows=dense_rows)) == pairs
    assert rows_of(overlap_counts(df)) == sorted(Counter(pair[0] for pair in pairs).items())
