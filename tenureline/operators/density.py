"""Routing keys by their number of rows.

Work that compares the intervals of one key with each other is cheapest inside one
task, as long as the key is small. A key above the limit is routed to operators that
spread it over many tasks. Both routes give the same rows, so routing is only a
matter of cost, and may rest on estimates: a sketch of the heaviest keys, gathered in
each task and merged, in place of a count per key and its shuffle. Its size is fixed.

A key that holds a share of all rows is always among the heaviest. If there are more
keys above the limit than the sketch names, either they are most of the rows, so that the
mean key is above it and all go the dense way, or those not named are light ones of
moderate size: they cost their rows times the days on which anything of theirs begins.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from tenureline.sources.publish import stage

# Above about this many rows, comparing all intervals of a key costs more than
# looking each one up by calendar block.
DENSE_ROWS = 512
# Keys that the sketch names, and keys that it tracks.
NAMED_KEYS, TRACKED_KEYS = 1_024, 65_536


class Routed(NamedTuple):
    light: DataFrame | None  # keys that a task compares by themselves
    dense: DataFrame | None  # keys of any size


def density_sketch(key: str) -> list[Column]:
    """Aggregates of fixed size: rows, distinct keys, and the heaviest keys with their rows."""
    heaviest = F.expr(f"approx_top_k(`{key}`, {NAMED_KEYS}, {TRACKED_KEYS})")
    return [
        F.count(key).alias("rows"),
        F.approx_count_distinct(key).alias("keys"),
        heaviest.alias("heaviest"),
    ]


def dense_keys(sketch: Row | dict, dense_rows: int) -> list | None:
    """Keys of more than ``dense_rows`` rows as far as the sketch names them; None means all,
    where it names but a part of them and the mean key is above the limit."""
    named = sketch["heaviest"] or []
    dense = [x["item"] for x in named if x["count"] > dense_rows]
    tracked_all = sketch["keys"] <= TRACKED_KEYS // 2
    named_all = tracked_all and (len(named) < NAMED_KEYS or len(dense) < len(named))
    if not named_all and sketch["rows"] > dense_rows * sketch["keys"]:
        return None
    return dense


def route_by_density(
    df: DataFrame, key: str, dense_rows: int = DENSE_ROWS, staged: bool = False
) -> Routed:
    """Split ``df``, whose keys are not null, at about ``dense_rows`` rows per key.

    ``staged`` stores ``df`` once, for its readers on both routes, and fills the sketch on the
    way; otherwise the sketch costs a scan of the keys.
    """
    if staged:
        seen = Observation()
        df = stage(df.observe(seen, *density_sketch(key)), "routed")
        sketch = seen.get
    else:
        sketch = df.agg(*density_sketch(key)).first()
    keys = dense_keys(sketch, dense_rows)
    if keys is None:
        return Routed(None, df)
    if not keys:
        return Routed(df, None)
    return Routed(df.where(~F.col(key).isin(keys)), df.where(F.col(key).isin(keys)))
