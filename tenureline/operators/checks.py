"""Data-quality checks. Each returns the offending rows; no rows means pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenureline.functions.calendar_blocks import covering_blocks, enclosing_blocks
from tenureline.functions.dates import closed_end
from tenureline.functions.ranking import nulls_last, sort_key
from tenureline.operators.density import DENSE_ROWS, route_by_density
from tenureline.operators.revenue import apply_horizon, revenue_horizon
from tenureline.sources.publish import stage


def violates(df: DataFrame, predicate: Column) -> DataFrame:
    return df.where(predicate)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return violates(df, F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count("*").alias("n_records"))
    )
    return counts.where("n_records > 1")


def relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Non-null child keys without a parent, one row per child row.

    Only the two key columns take part; a skewed child key is split by adaptive
    execution, as the preserved side of an anti join may be.
    """
    keys = child.where(F.col(column).isNotNull()).select(F.col(column).alias("from_field"))
    parents = parent.select(F.col(parent_column).alias("from_field"))
    return keys.join(parents, "from_field", "left_anti")


class Entry(NamedTuple):
    """What rows of a table add to a shared count: ``source`` under a value of ``kind``.

    Rows for which ``when`` does not hold add nothing.
    """

    kind: str
    value: Column
    source: str
    when: Column | None = None


def counts_of_entries(tables: Sequence[tuple[DataFrame, Sequence[Entry]]]) -> DataFrame:
    """Entries per kind and value, one column per source: ``(kind, key_value, <sources>)``.

    Every table is scanned once, whatever it is checked for, and all are counted in one shuffle of
    counts combined map-side, which then answers row checks, uniqueness and references between any
    of them. Values are compared as text; null is a value of its own.

    The shuffle holds kinds by number, and as many counts per value as the kind of most sources
    has: a source's place among those of its kind tells its count. Columns are made after it.
    """
    sources = list(dict.fromkeys(entry.source for _, entries in tables for entry in entries))
    of_kind: dict[str, list[str]] = {}
    for entry in (entry for _, entries in tables for entry in entries):
        names = of_kind.setdefault(entry.kind, [])
        if entry.source not in names:
            names.append(entry.source)
    kinds, parts = list(of_kind), []
    for df, entries in tables:
        rows = []
        for entry in entries:
            row = F.struct(
                F.lit(kinds.index(entry.kind)).alias("kind"),
                entry.value.cast("string").alias("key_value"),
                F.lit(of_kind[entry.kind].index(entry.source)).alias("source"),
            )
            rows.append(row if entry.when is None else F.when(entry.when, row))
        entered = df.select(F.explode(F.array(*rows)).alias("entry"))
        parts.append(entered.where("entry IS NOT NULL").select("entry.*"))
    most = max(map(len, of_kind.values()))
    counts = [F.count_if(F.col("source") == at).alias(f"count_{at}") for at in range(most)]
    counted = reduce(DataFrame.unionByName, parts).groupBy("kind", "key_value").agg(*counts)
    columns = []
    for name in sources:
        own = F.lit(0).cast("long")
        for at, names in enumerate(of_kind.values()):
            if name in names:
                own = F.when(F.col("kind") == at, F.col(f"count_{names.index(name)}")).otherwise(own)
        columns.append(own.alias(name))
    named = F.get(F.array(*map(F.lit, kinds)), F.col("kind")).alias("kind")
    return counted.select(named, "key_value", *columns)


def _of(kind: str) -> Column:
    return F.col("kind") == kind


def entered(kind: str, source: str) -> Column:
    """How many entries of ``source`` there are under ``kind``."""
    return F.coalesce(F.sum(F.when(_of(kind), F.col(source))), F.lit(0))


def values(kind: str, source: str, above: int = 0) -> Column:
    """How many values have more than ``above`` entries of ``source``, null among them."""
    return F.count_if(_of(kind) & (F.col(source) > above))


def repeated(kind: str, source: str) -> Column:
    """How many values but null have more than one entry of ``source``."""
    return F.count_if(_of(kind) & F.col("key_value").isNotNull() & (F.col(source) > 1))


def orphans(kind: str, child: str, parent: str) -> Column:
    """How many entries of ``child`` have a value that no ``parent`` has; null has none."""
    lost = _of(kind) & F.col("key_value").isNotNull() & (F.col(parent) == 0)
    return F.coalesce(F.sum(F.when(lost, F.col(child))), F.lit(0))


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with counts; nulls are left to the null check."""
    outside = violates(df, ~F.col(column).isin(list(values)))
    return outside.groupBy(F.col(column).alias("value_field")).agg(
        F.count("*").alias("n_records")
    )


def count_above(
    df: DataFrame, predicate: Column, by: Sequence[str], limit: int, name: str = "row_count"
) -> DataFrame:
    """Groups with more than ``limit`` rows for which ``predicate`` holds."""
    counts = df.where(predicate).groupBy(*by).agg(F.count("*").alias(name))
    return counts.where(F.col(name) > limit)


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return count_above(df, F.lit(True), columns, 1)


# -- predicates of single rows ------------------------------------------------------


def negative(column: str) -> Column:
    return F.col(column) < 0


def ends_before_start(start: str, end: str) -> Column:
    return F.col(end).isNotNull() & (F.col(end) < F.col(start))


def unexpected_code(column: str, codes: Sequence[str]) -> Column:
    return F.col(column).isNull() | ~F.lower(F.trim(F.col(column))).isin(list(codes))


# -- overlapping intervals ----------------------------------------------------------


def overlapping_pairs(
    df: DataFrame,
    key: str = "customer_id",
    start: str = "resolved_start_date",
    end: str = "resolved_end_date",
    identity: str = "resolved_subscription_id",
    order: Sequence[str] = (
        "resolved_subscription_id",
        "resolved_plan_id",
        "resolved_status",
    ),
    dense_rows: int = DENSE_ROWS,
) -> DataFrame:
    """Pairs of intervals of one key that share a day; a null end is open.

    ``order`` decides, after start and end, which one of a pair is the left one.
    """
    intervals = df.where(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key),
        F.col(identity).alias("subscription_id"),
        F.col(start).alias("first_day"),
        closed_end(end).alias("last_day"),
        F.col(end).alias("end_date"),
        *[F.col(name).alias(f"order_{at}") for at, name in enumerate(order)],
    )
    ranking = ["first_day", "last_day", *(f"order_{at}" for at in range(len(order))), "end_date"]
    light, dense = route_by_density(intervals, key, dense_rows)
    parts = [] if light is None else [_pairs_in_task(light, key, ranking)]
    if dense is not None:
        parts.extend(_pairs_by_block(dense, key, ranking))
    return reduce(DataFrame.unionByName, parts).select(
        key,
        "left_subscription_id",
        "right_subscription_id",
        F.col("left_first_day").alias("resolved_start_date"),
        F.col("left_end_date").alias("resolved_end_date"),
        F.col("right_first_day").alias("overlapping_start_date"),
        F.col("right_end_date").alias("overlapping_end_date"),
    )


_PAIR_FIELDS = ["subscription_id", "first_day", "last_day", "end_date"]
_PAIR_COLUMNS = [f"{side}_{field}" for side in ("left", "right") for field in _PAIR_FIELDS]


def _side(df: DataFrame, side: str, key: str, *extra: str) -> DataFrame:
    renamed = [F.col(field).alias(f"{side}_{field}") for field in [*_PAIR_FIELDS, *extra]]
    return df.select(key, *renamed)


def _share_a_day() -> Column:
    return (F.col("left_first_day") <= F.col("right_last_day")) & (
        F.col("left_last_day") >= F.col("right_first_day")
    )


def _pairs_in_task(light: DataFrame, key: str, ranking: Sequence[str]) -> DataFrame:
    """For light keys: only rows that start before an earlier row ended are paired."""
    ordered = Window.partitionBy(key).orderBy(*nulls_last(ranking))
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    numbered = light.withColumns(
        {
            "position": F.row_number().over(ordered),
            "reached": F.max("last_day").over(earlier),
        }
    )
    late = numbered.where(F.col("first_day") <= F.col("reached"))
    left, right = _side(numbered, "left", key, "position"), _side(late, "right", key, "position")
    in_order = F.col("left_position") < F.col("right_position")
    return left.join(right, key).where(in_order & _share_a_day()).select(key, *_PAIR_COLUMNS)


# Rows of one key and block on the left that one task may meet, and the most blocks that are
# split beyond that: a bound of what is broadcast. A block with a larger share of all rows than
# one part of so many is always split.
BLOCK_ROWS, SPLIT_BLOCKS = 1_024, 10_000


def _salted(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``salt``: the left rows of a large block are dealt over several salts, its
    right rows are repeated for each. Blocks are counted, with counts combined map-side."""
    sizes = stage(left.groupBy(key, "block").agg(F.count("*").alias("rows")), "block_sizes")
    total = sizes.agg(F.sum("rows")).first()[0] or 0
    part = max(BLOCK_ROWS, total // SPLIT_BLOCKS)
    split = sizes.where(F.col("rows") > part)
    split = split.select(key, "block", F.ceil(F.col("rows") / part).cast("int").alias("salts"))
    split = F.broadcast(split)
    salts = F.coalesce("salts", F.lit(1))
    dealt = F.pmod(F.xxhash64("left_rank"), salts)
    every = F.explode(F.sequence(F.lit(0), salts - 1))
    return (
        left.join(split, [key, "block"], "left").withColumn("salt", dealt.cast("int")).drop("salts"),
        right.join(split, [key, "block"], "left").withColumn("salt", every).drop("salts"),
    )


def _pairs_by_block(dense: DataFrame, key: str, ranking: Sequence[str]) -> list[DataFrame]:
    """For keys of any size: the later interval of a pair starts inside the earlier one.

    Equal rows are folded into one row with a count and unfolded at the end.
    """
    folded = (
        dense.groupBy(key, "subscription_id", *ranking)
        .agg(F.count("*").alias("copies"))
        .withColumn("rank", sort_key(*(F.col(name) for name in ranking)))
    )
    covering = covering_blocks("left_first_day", "left_last_day")
    enclosing = enclosing_blocks("right_first_day")
    left = _side(folded, "left", key, "rank", "copies").withColumn("block", F.explode(covering))
    right = _side(folded, "right", key, "rank", "copies").withColumn("block", F.explode(enclosing))
    in_order = F.col("left_rank") < F.col("right_rank")
    left, right = _salted(left, right, key)
    between_rows = (
        left.join(right.hint("merge"), [key, "block", "salt"])  # see contained_by_block
        .where(in_order & _share_a_day())
        .withColumn("left_copy", F.explode(F.sequence(F.lit(1), F.col("left_copies"))))
        .withColumn("right_copy", F.explode(F.sequence(F.lit(1), F.col("right_copies"))))
    )
    repeated = folded.where("copies > 1 AND first_day <= last_day")
    twins = _side(repeated, "left", key, "copies").select(
        "*", *[F.col(f"left_{field}").alias(f"right_{field}") for field in _PAIR_FIELDS]
    )
    between_copies = (
        twins.withColumn("first", F.explode(F.sequence(F.lit(2), F.col("left_copies"))))
        .withColumn("second", F.explode(F.sequence(F.col("first"), F.col("left_copies"))))
    )
    return [
        between_rows.select(key, *_PAIR_COLUMNS),
        between_copies.select(key, *_PAIR_COLUMNS),
    ]


# A day number beyond all dates.
_NO_DAY = (1 << 31) - 1


def overlap_counts(
    df: DataFrame,
    key: str = "customer_id",
    start: str = "resolved_start_date",
    end: str = "resolved_end_date",
) -> DataFrame:
    """How many pairs ``overlapping_pairs`` has per key, without forming them.

    In the order of the pairs, the left ones of an interval are all that come before it. So of
    the n intervals of a key, each one meets those that start until it ends, less those up to
    itself: the sum of that over all of them is counted from starts and ends per day, which the
    calendar bounds. Intervals that end before they start are counted apart: they pair with
    those that hold both of their days. Only intervals that may hold such days become blocks.
    """
    intervals = df.where(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key), F.col(start).alias("first_day"), closed_end(end).alias("last_day")
    )
    proper = intervals.where("first_day <= last_day")
    ends = "struct(first_day AS day, 1 AS starts), struct(last_day AS day, 0 AS starts)"
    per_day = (
        proper.select(key, F.expr(f"inline(array({ends}))"))
        .groupBy(key, "day")
        .agg(
            F.sum("starts").cast("decimal(19,0)").alias("starts"),
            F.count_if(F.col("starts") == 0).cast("decimal(19,0)").alias("ends"),
        )
    )
    by_day = Window.partitionBy(key).orderBy("day")
    begun = F.sum("starts").over(by_day.rowsBetween(Window.unboundedPreceding, 0))
    n = F.sum("starts")
    between_proper = (
        per_day.withColumn("begun", begun)
        .groupBy(key)
        .agg((F.sum(F.col("ends") * F.col("begun")) - n * (n + 1) / 2).cast("long").alias("pairs"))
    )
    backwards = intervals.where("last_day < first_day")
    from_day, to_day = F.min(F.unix_date("first_day")), F.max(F.unix_date("last_day"))
    least, most = backwards.agg(from_day, to_day).first()
    least, most = (_NO_DAY, -_NO_DAY) if least is None else (least, most)
    reaching = (F.unix_date("first_day") <= most) & (F.unix_date("last_day") >= least)
    blocks = proper.where(reaching).select(
        key, "first_day", F.explode(covering_blocks("first_day", "last_day")).alias("block")
    )
    holders = blocks.groupBy(key, "block", "first_day").agg(F.count("*").alias("n_proper"))
    inverted = backwards.groupBy(
        key, F.col("first_day").alias("from_day"), F.col("last_day").alias("to_day")
    )
    enclosed = inverted.agg(F.count("*").alias("n_inverted")).withColumn(
        "block", F.explode(enclosing_blocks("from_day"))
    )
    with_inverted = (
        enclosed.join(holders.hint("merge"), [key, "block"])  # see contained_by_block
        .where("first_day <= to_day")
        .groupBy(key)
        .agg(F.sum(F.col("n_inverted") * F.col("n_proper")).alias("pairs"))
    )
    both = between_proper.unionByName(with_inverted).groupBy(key)
    return both.agg(F.sum("pairs").alias("n_records")).where("n_records > 0")


# -- horizon ------------------------------------------------------------------------


def opens_after_horizon(billable: DataFrame) -> DataFrame:
    """Open billable intervals that start after the day at which open ones are cut.

    They earn nothing, so the monthly fact has no row for them; here they are listed.
    """
    closed = apply_horizon(billable, revenue_horizon(billable))
    return closed.where(F.col("resolved_start_date") > F.col("effective_end_date"))


# -- report -------------------------------------------------------------------------


def as_report(counts: DataFrame) -> DataFrame:
    """One row of counts as one row per check."""
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("check_name"), F.col(f"`{name}`").alias("failing_rows"))
            for name in counts.columns
        ]
    )
    return counts.select(F.inline(rows))


def count_violations(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Violations of many row predicates, counted in one pass over ``df``."""
    violated = [F.count_if(predicate).alias(name) for name, predicate in predicates.items()]
    return as_report(df.agg(*violated))


def count_by_key(counted: DataFrame, totals: Mapping[str, Column]) -> DataFrame:
    """Totals over ``counts_of_entries``, one row per check."""
    return as_report(counted.agg(*[total.alias(name) for name, total in totals.items()]))


def count_rows(name: str, offending: DataFrame) -> DataFrame:
    return as_report(offending.agg(F.count("*").alias(name)))


def count_records(name: str, offending: DataFrame) -> DataFrame:
    """For offending rows that each stand for ``n_records`` rows."""
    return as_report(offending.agg(F.coalesce(F.sum("n_records"), F.lit(0)).alias(name)))


def report(counts: Sequence[DataFrame]) -> DataFrame:
    """One row per check: name, number of failing rows, passed or not."""
    rows = reduce(DataFrame.unionByName, counts)
    return rows.withColumn("passed", F.col("failing_rows") == 0)
