"""Numeric column expressions. All are built-in expressions and stay inside code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast.config import DAYS_IN_MONTH


def clip(col: str | Column, low: float, high: float) -> Column:
    """Bound a value; NULL stays NULL (plain greatest/least would turn it into a bound)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def mean(col: str | Column) -> Column:
    """Mean as one double division of an exact sum, also for decimals (``avg`` rounds those)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_divide(F.sum(c).cast("double"), F.count(c))


def relative_delta(value: str | Column, base: str | Column) -> Column:
    """(value − base) / base; NULL for a zero base."""
    v = F.col(value) if isinstance(value, str) else value
    b = F.col(base) if isinstance(base, str) else base
    return F.try_divide(v - b, b)


def select_trend(deltas: Sequence[str | Column]) -> Column:
    """First non-zero delta, walking from the shortest lag. A missing delta ends the walk with 0."""
    walk = None
    for delta in deltas:
        d = F.col(delta) if isinstance(delta, str) else delta
        walk = (F if walk is None else walk).when(d.isNull(), F.lit(0.0))
        walk = walk.when(d != 0, d)
    return walk.otherwise(F.lit(0.0))


def first_known(*cols: str | Column) -> Column:
    """First value that is not missing."""
    return F.coalesce(*cols)


def month_of_year(month_id: str | Column) -> Column:
    """0-based calendar month of a running month number."""
    return (F.col(month_id) if isinstance(month_id, str) else month_id) % 12


def days_in_month(month_id: str | Column) -> Column:
    """Days of the month, February always 28."""
    return F.element_at(F.array(*[F.lit(d) for d in DAYS_IN_MONTH]), (month_of_year(month_id) + 1).cast("int"))


def parse_date(col: str | Column) -> Column:
    """dd.MM.yyyy text to date."""
    return F.to_date(col, "dd.MM.yyyy")
