"""Overlapping intervals to one timeline per key.

Bound used throughout: a key has at most as many distinct boundary days as the
calendar, however many rows it has. So boundaries, segments, winners and islands are
small per key once boundaries are distinct, and windows over them may be partitioned
by the key. Only the step from raw intervals to winners can meet a hot key; it is
routed by ``route_by_density``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenureline.functions.calendar_blocks import (
    covering_blocks,
    enclosing_blocks,
    window_days,
    window_starts,
)
from tenureline.functions.dates import reopened_end
from tenureline.functions.ranking import nulls_last
from tenureline.operators.density import DENSE_ROWS, route_by_density

SEGMENT = ["segment_start", "segment_end"]


@dataclass(frozen=True)
class IntervalTable:
    """Column names of an interval table, and how its rows compete for a day."""

    key: str
    start: str
    end: str
    attributes: tuple[str, ...]  # a change in one of these starts a new island
    measure: str  # carried along, highest value per island
    preference: tuple[str, ...]  # sort order, winner first; ``-`` means descending

    @property
    def payload(self) -> list[str]:
        return [*self.attributes, self.measure]


SUBSCRIPTIONS = IntervalTable(
    key="customer_id",
    start="start_date",
    end="end_date",
    attributes=(
        "resolved_subscription_id",
        "resolved_plan_id",
        "resolved_status",
        "is_billable",
    ),
    measure="monthly_cost",
    preference=(
        "-is_billable",
        "-status_precedence",
        "-start_date",
        "-monthly_cost",
        "resolved_subscription_id",
        "resolved_plan_id",
    ),
)


def top1(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per group; Spark cuts each group to one row before shuffling it."""
    position = Window.partitionBy(*by).orderBy(*nulls_last(order))
    ranked = df.withColumn("position_in_group", F.row_number().over(position))
    return ranked.where("position_in_group = 1").drop("position_in_group")


# -- segments ----------------------------------------------------------------------


def interval_boundaries(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Every start and every day after an end, one row each."""
    days = F.array(F.col(start), F.date_add(end, 1))
    return df.select(key, F.explode(days).alias("boundary_date"))


def distinct_boundaries(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    return interval_boundaries(df, key, start, end).dropDuplicates()


def segments_between(boundaries: DataFrame, key: str) -> DataFrame:
    """Stretches between consecutive boundaries; repeated boundaries give none."""
    following = F.lead("boundary_date").over(Window.partitionBy(key).orderBy("boundary_date"))
    return (
        boundaries.withColumn("next_boundary_date", following)
        .where("next_boundary_date > boundary_date")
        .select(
            key,
            F.col("boundary_date").alias("segment_start"),
            F.date_sub("next_boundary_date", 1).alias("segment_end"),
        )
    )


def atomic_segments(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Segments of all keys, gaps included; boundaries are made distinct map-side."""
    return segments_between(distinct_boundaries(df, key, start, end), key)


# -- candidates and winners --------------------------------------------------------


def contained_in_task(segments: DataFrame, df: DataFrame, spec: IntervalTable) -> DataFrame:
    """Segment-interval pairs by comparing the rows of a key; for light keys."""
    inside = (F.col("segment_start") >= F.col(spec.start)) & (
        F.col("segment_end") <= F.col(spec.end)
    )
    other = segments.withColumnRenamed(spec.key, "segment_key")
    return df.join(other, (F.col(spec.key) == F.col("segment_key")) & inside).drop("segment_key")


def by_covering_block(df: DataFrame, spec: IntervalTable) -> DataFrame:
    return df.withColumn("block", F.explode(covering_blocks(spec.start, spec.end)))


def contained_by_block(segments: DataFrame, blocks: DataFrame, spec: IntervalTable) -> DataFrame:
    """The same pairs by equality of calendar blocks; for keys of any size.

    A segment never crosses a boundary of its key, so its first day decides. Always a shuffle:
    Spark takes either side for as large as it was before its rows became blocks, and would
    broadcast one many times its limit, by way of the driver.
    """
    probes = segments.withColumn("block", F.explode(enclosing_blocks("segment_start")))
    return probes.join(blocks.hint("merge"), [spec.key, "block"]).drop("block")


def _clustered(df: DataFrame, key: str, partitions: int | None) -> DataFrame:
    return df.repartition(partitions, key) if partitions else df.repartition(key)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def segment_candidates(
    df: DataFrame, spec: IntervalTable, dense_rows: int = DENSE_ROWS
) -> DataFrame:
    """Every segment with every interval of its key that contains it."""
    has_key = F.col(spec.key).isNotNull()
    light, dense = route_by_density(df.where(has_key), spec.key, dense_rows, staged=True)
    columns = [spec.key, *SEGMENT, *(c for c in df.columns if c != spec.key)]
    parts = []
    if light is not None:
        parts.append(_candidates_of_light_keys(light, spec, None).select(columns))
    if dense is not None:
        segments = atomic_segments(dense, spec.key, spec.start, spec.end)
        blocks = by_covering_block(dense, spec)
        parts.append(contained_by_block(segments, blocks, spec).select(columns))
    return _union(parts)


def pick_winner(candidates: DataFrame, spec: IntervalTable) -> DataFrame:
    return top1(candidates, [spec.key, *SEGMENT], spec.preference)


def _candidates_of_light_keys(
    df: DataFrame, spec: IntervalTable, partitions: int | None
) -> DataFrame:
    # Clustered once; boundaries, segments, join and what follows all reuse it.
    near = _clustered(df, spec.key, partitions)
    boundaries = interval_boundaries(near, spec.key, spec.start, spec.end)
    return contained_in_task(segments_between(boundaries, spec.key), near, spec)


def _best_of_blocks(df: DataFrame, spec: IntervalTable) -> DataFrame:
    """The preferred interval of every block.

    An interval has a dozen blocks but two windows at most. Most rows of a hot key lose
    in their windows already, so only the best of each window is unfolded into blocks.
    Both rankings cut rows before their shuffle; days go first, as they sort faster.
    """
    windows = df.withColumn("window_days", window_days(spec.start, spec.end)).withColumn(
        "window_start", F.explode(window_starts(spec.start, spec.end, "window_days"))
    )
    best = top1(windows, ["window_start", "window_days", spec.key], spec.preference)
    blocks = covering_blocks("window_start", "date_add(window_start, window_days - 1)")
    unfolded = best.withColumn("block", F.explode(blocks)).drop("window_start", "window_days")
    return top1(unfolded, ["block", spec.key], spec.preference)


def _winners_of_dense_keys(df: DataFrame, spec: IntervalTable, partitions: int | None) -> DataFrame:
    # Blocks per key are bounded by the calendar, so once only the best interval of a
    # block is left, a hot key is no larger than its history is long, and its candidates
    # may be gathered by key for the ranking and what follows.
    blocks = _best_of_blocks(df, spec)
    segments = atomic_segments(df, spec.key, spec.start, spec.end)
    candidates = contained_by_block(segments, blocks, spec)
    return pick_winner(_clustered(candidates, spec.key, partitions), spec)


def winning_segments(
    df: DataFrame,
    spec: IntervalTable,
    dense_rows: int = DENSE_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """The preferred interval of every segment, partitioned by key; ``df`` is read once."""
    has_key = F.col(spec.key).isNotNull()
    light, dense = route_by_density(df.where(has_key), spec.key, dense_rows, staged=True)
    columns = [spec.key, *SEGMENT, *spec.payload]
    parts = []
    if light is not None:
        candidates = _candidates_of_light_keys(light, spec, partitions)
        parts.append(pick_winner(candidates, spec).select(columns))
    if dense is not None:
        parts.append(_winners_of_dense_keys(dense, spec, partitions).select(columns))
    return _union(parts)


# -- islands -----------------------------------------------------------------------


def mark_islands(
    df: DataFrame,
    key: str,
    attributes: Sequence[str],
    start: str = "segment_start",
    end: str = "segment_end",
) -> DataFrame:
    """``new_group_flag`` is 0 when a row continues the previous one, else 1.

    Plain equality on purpose: a null attribute never continues anything.
    """
    ordered = Window.partitionBy(key).orderBy(start, end)
    unchanged = [F.lag(name).over(ordered) == F.col(name) for name in attributes]
    adjacent = F.lag(end).over(ordered) == F.date_sub(start, 1)
    continues = reduce(and_, unchanged, adjacent)
    return df.withColumn("new_group_flag", F.when(continues, 0).otherwise(1))


def island_ids(
    df: DataFrame, key: str, start: str = "segment_start", end: str = "segment_end"
) -> DataFrame:
    so_far = (
        Window.partitionBy(key)
        .orderBy(start, end)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn("segment_group_id", F.sum("new_group_flag").over(so_far))


def collapse_islands(df: DataFrame, spec: IntervalTable) -> DataFrame:
    islands = df.groupBy(spec.key, *spec.attributes, "segment_group_id").agg(
        F.min("segment_start").alias("resolved_start_date"),
        reopened_end(F.max("segment_end")).alias("resolved_end_date"),
        F.max(spec.measure).alias(spec.measure),
    )
    return islands.drop("segment_group_id")


def resolve_intervals(
    df: DataFrame,
    spec: IntervalTable,
    dense_rows: int = DENSE_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Overlapping closed intervals to one non-overlapping timeline per key."""
    winners = winning_segments(df, spec, dense_rows, partitions)
    marked = island_ids(mark_islands(winners, spec.key, spec.attributes), spec.key)
    return collapse_islands(marked, spec)


def resolve_subscriptions(
    cleaned: DataFrame,
    dense_rows: int = DENSE_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    timeline = resolve_intervals(cleaned, SUBSCRIPTIONS, dense_rows, partitions)
    return timeline.select(
        "customer_id",
        "resolved_subscription_id",
        "resolved_plan_id",
        "resolved_status",
        "resolved_start_date",
        "resolved_end_date",
        "monthly_cost",
        "is_billable",
    )
