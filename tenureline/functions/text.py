"""String clean-up expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed_lower(column: str) -> Column:
    return F.lower(F.trim(F.col(column)))


def null_literal(column: str, literal: str = "None") -> Column:
    """Trim, and turn a spelled-out null (exact case) into a real one; '' is kept."""
    return F.nullif(F.trim(F.col(column)), F.lit(literal))


def recode(code: Column, mapping: Mapping[str, object], default: object = None) -> Column:
    """Translate ``code`` through a small fixed mapping; anything else gives ``default``.

    A literal map reads ``code`` once, where a chain of conditions would repeat it.
    """
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    translated = F.try_element_at(F.create_map(*pairs), code)
    return translated if default is None else F.coalesce(translated, F.lit(default))
