"""Aggregate helpers: conditional first/last and counts in one pass."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def min_if(cond: Column, value: Column) -> Column:
    """``min(if(cond, value, null))``; NULL when no row qualifies."""
    return F.min(F.when(cond, value))


def max_if(cond: Column, value: Column) -> Column:
    return F.max(F.when(cond, value))


def count_if(cond: Column) -> Column:
    """Rows where ``cond`` is true; a NULL condition is not counted."""
    return F.count_if(cond)


def repeatable_any(value: Column) -> Column:
    """A deterministic stand-in for ``any_value``: the smallest non-NULL
    value, so reruns and other engines agree."""
    return F.min(value)
