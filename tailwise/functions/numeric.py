"""Null-safe arithmetic and banding helpers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that yields NULL, not an ANSI error, when the denominator is zero."""
    top = F.col(numerator) if isinstance(numerator, str) else numerator
    bottom = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def band(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first ``(threshold, label)`` with ``value >= threshold``."""
    expr = None
    for threshold, label in steps:
        condition = value >= F.lit(threshold)
        expr = F.when(condition, label) if expr is None else expr.when(condition, label)
    return expr.otherwise(otherwise)


def count_when(condition: Column) -> Column:
    """Number of rows for which ``condition`` holds (a NULL condition counts as false)."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def sum_when(condition: Column, value: Column | str) -> Column:
    """Sum of ``value`` over rows where ``condition`` holds, 0 when none does."""
    amount = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(condition, amount).otherwise(F.lit(0.0)))


def rounded(df: DataFrame, places: int, columns: Iterable[str]) -> DataFrame:
    """Round the named columns, keeping column order; ``+ 0.0`` turns a negative zero into zero."""
    return df.withColumns({c: F.round(F.col(c), places) + F.lit(0.0) for c in columns})


def money_text(value: Column, places: int = 0) -> Column:
    """``$1,234,567`` style text."""
    return F.concat(F.lit("$"), F.format_number(value, places))


def percent_text(value: Column, prefix: str = "") -> Column:
    """A number followed by a percent sign, as a report prints it."""
    return F.concat(F.lit(prefix), value.cast("string"), F.lit("%"))
