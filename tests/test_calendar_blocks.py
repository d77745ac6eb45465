from __future__ import annotations

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from tenureline.functions.calendar_blocks import (
    BLOCK_SIZES,
    covering_blocks,
    enclosing_blocks,
    window_days,
    window_starts,
)


def random_ranges(count: int):
    source = random.Random(7)
    first_day, last_day = date.min.toordinal(), date.max.toordinal()
    fixed = [
        (date.min, date.max),
        (date.min, date.min),
        (date.max, date.max),
        (date(2024, 2, 29), date(2999, 12, 31)),
    ]
    for _ in range(count):
        length = source.choice([0, 1, 7, 31, 500, 20_000])
        start = source.randint(first_day, last_day - length)
        span = source.randint(0, length) if length else 0
        fixed.append((date.fromordinal(start), date.fromordinal(start + span)))
    return fixed


def test_each_day_of_a_range_is_in_exactly_one_covering_block(spark):
    probes = []
    for number, (first, last) in enumerate(random_ranges(300)):
        for offset in (-2, -1, 0, 1, 2):
            for edge in (first, last):
                ordinal = edge.toordinal() + offset
                if date.min.toordinal() <= ordinal <= date.max.toordinal():
                    probes.append((number, first, last, date.fromordinal(ordinal)))
        middle = first + timedelta(days=(last - first).days // 2)
        probes.append((number, first, last, middle))
    df = spark.createDataFrame(probes, "number int, first date, last date, day date")
    shared = F.size(
        F.array_intersect(covering_blocks("first", "last"), enclosing_blocks("day"))
    )
    inside = (F.col("day") >= F.col("first")) & (F.col("day") <= F.col("last"))
    wrong = df.select("*", shared.alias("shared")).where(
        F.col("shared") != F.when(inside, 1).otherwise(0)
    )
    assert wrong.collect() == []


def test_few_blocks_per_range(spark):
    df = spark.createDataFrame(random_ranges(300), "first date, last date")
    blocks = df.select(covering_blocks("first", "last").alias("blocks"))
    assert blocks.agg(F.max(F.size("blocks"))).first()[0] <= 2 * BLOCK_SIZES
    assert blocks.where(F.size("blocks") != F.size(F.array_distinct("blocks"))).count() == 0


def test_inverted_range_has_no_blocks(spark):
    df = spark.createDataFrame([(date(2024, 1, 2), date(2024, 1, 1))], "first date, last date")
    assert df.select(F.size(covering_blocks("first", "last"))).first()[0] == 0


def test_windows_cover_exactly_the_range(spark):
    powers = [(date(2024, 1, 1), date(2024, 1, 1) + timedelta(days=2**k - 1)) for k in range(20)]
    df = spark.createDataFrame(random_ranges(300) + powers, "first date, last date")
    windows = df.withColumn("days", window_days("first", "last")).withColumn(
        "starts", window_starts("first", "last", "days")
    )
    low, high = F.array_min("starts"), F.date_add(F.array_max("starts"), F.col("days") - 1)
    wrong = windows.where(
        (low != F.col("first"))
        | (high != F.col("last"))
        | (F.datediff(F.array_max("starts"), low) > F.col("days"))
        | (F.size("starts") > 2)
    )
    assert wrong.collect() == []
