"""Text predicates and file-name pieces as columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def matches_any(patterns: Mapping[str, Iterable[str]]) -> Column:
    """True where any column matches any of its patterns (unanchored, case-sensitive)."""
    return F.coalesce(
        reduce(or_, (F.coalesce(column_matches(c, ps), F.lit(False)) for c, ps in patterns.items())),
        F.lit(False),
    )


def column_matches(column: str, patterns: Iterable[str]) -> Column:
    """One column against its patterns, joined into a single alternation."""
    return F.col(column).rlike("|".join(f"({p})" for p in patterns))


def ends_with_any(columns: Iterable[str], words: Iterable[str]) -> Column:
    """True where any column ends with any word: ``LIKE '%word'``."""
    words = list(words)
    tests = (F.coalesce(F.col(c).endswith(w), F.lit(False)) for c in columns for w in words)
    return reduce(or_, tests)


def before_first_dot(column: Column) -> Column:
    return F.substring_index(column, ".", 1)


def after_first_dot(column: Column) -> Column:
    """Text between the first and second dot; empty when there is no dot."""
    return F.split_part(column, F.lit("."), F.lit(2))


def after_last_slashes(column: Column) -> Column:
    return F.element_at(F.split(column, "//"), -1)
