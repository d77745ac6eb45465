"""Date ranges as unions of aligned calendar blocks.

A block is 2^k days long and starts at a multiple of 2^k days, so blocks form a
binary tree over the calendar. Any range is a disjoint union of at most two blocks
per size, and every date lies in exactly one block of each size. Hence

    date in range  <=>  exactly one of enclosing_blocks(date) is in
                        covering_blocks(first, last)

which turns "point in range" into an equality join on (key, block). The block also
splits a key: rows of one hot key spread over as many join keys as it has blocks.

A range is also the union of two windows of 2^k days that may overlap and start on any
day. They are fewer than the blocks, and as good when only the best range matters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2^22 days reach from 0001-01-01 beyond 9999-12-31, the range of SQL dates.
BLOCK_SIZES = 22
_DAYS_BEFORE_EPOCH = 719_162  # 0001-01-01 to 1970-01-01


def _day_number(day: str) -> str:
    return f"(unix_date({day}) + {_DAYS_BEFORE_EPOCH})"


def _block_id(size: int, index: str) -> str:
    return f"({1 << (BLOCK_SIZES - size)} + {index})"


def covering_blocks(first: str, last: str) -> Column:
    """Blocks whose disjoint union is ``[first, last]``; empty when the range is."""
    start, stop = _day_number(first), f"({_day_number(last)} + 1)"
    blocks = []
    for size in range(BLOCK_SIZES):
        # Whole blocks of this size inside the range: indexes low .. high - 1. A pair
        # of them makes one block of the next size, so only unpaired ends are kept.
        low = f"shiftright({start} + {(1 << size) - 1}, {size})"
        high = f"shiftright({stop}, {size})"
        unpaired_low = f"{low} < {high} AND {low} & 1 = 1"
        unpaired_high = f"{low} < {high} AND {high} & 1 = 1"
        blocks.append(f"CASE WHEN {unpaired_low} THEN {_block_id(size, low)} END")
        blocks.append(f"CASE WHEN {unpaired_high} THEN {_block_id(size, high)} - 1 END")
    return F.array_compact(F.expr(f"array({', '.join(blocks)})"))


def enclosing_blocks(day: str) -> Column:
    """The block of every size that ``day`` lies in."""
    number = _day_number(day)
    blocks = [_block_id(size, f"shiftright({number}, {size})") for size in range(BLOCK_SIZES)]
    return F.expr(f"array({', '.join(blocks)})")


def window_days(first: str, last: str) -> Column:
    """Length of the two windows of a range: the largest power of two that fits.

    Half of that, should the logarithm of a power of two fall short, covers it as well.
    """
    return F.expr(f"shiftleft(1, CAST(floor(log2(datediff({last}, {first}) + 1)) AS INT))")


def window_starts(first: str, last: str, days: str) -> Column:
    """First days of the one or two windows whose union is ``[first, last]``."""
    return F.expr(f"array_distinct(array({first}, date_sub({last}, {days} - 1)))")
