"""Origin and development period arithmetic as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months in one period of each supported grain.
GRAIN_MONTHS = {"year": 12, "quarter": 3, "month": 1}


def months_per_period(grain: str) -> int:
    if grain not in GRAIN_MONTHS:
        raise ValueError(f"unknown grain {grain!r}; choose one of {sorted(GRAIN_MONTHS)}")
    return GRAIN_MONTHS[grain]


def origin_key(loss_date: Column | str, grain: str = "year") -> Column:
    """Integer key of the origin period: 2018, 20183 (third quarter) or 201809 (September)."""
    months_per_period(grain)
    date = F.col(loss_date) if isinstance(loss_date, str) else loss_date
    if grain == "year":
        return F.year(date)
    if grain == "quarter":
        return F.year(date) * 10 + F.quarter(date)
    return F.year(date) * 100 + F.month(date)


def origin_start_index(origin: Column, grain: str = "year") -> Column:
    """Months since year 0 at which an origin key starts; the inverse of :func:`origin_key`."""
    months_per_period(grain)
    if grain == "year":
        return origin * 12
    if grain == "quarter":
        return F.floor(origin / 10).cast("int") * 12 + (origin % 10 - 1) * 3
    return F.floor(origin / 100).cast("int") * 12 + origin % 100 - 1


def origin_offset(origin: Column, periods: Column, grain: str = "year") -> Column:
    """The origin key that lies ``periods`` after ``origin`` (used for calendar diagonals)."""
    step = months_per_period(grain)
    if grain == "year":
        return origin + periods
    months = origin_start_index(origin, grain) + periods * step
    year = F.floor(months / 12).cast("int")
    within = F.floor((months % 12) / step).cast("int") + 1
    return year * (10 if grain == "quarter" else 100) + within


def development_age(
    loss_date: Column | str,
    valuation_date: Column | str,
    grain: str = "year",
    base: int = 0,
) -> Column:
    """Whole periods elapsed between the loss and the valuation date, counted from ``base``."""
    elapsed = F.months_between(valuation_date, loss_date)
    return F.floor(elapsed / months_per_period(grain)).cast("int") + F.lit(base)


def observed_age(origin: Column, as_of: Column, grain: str = "year") -> Column:
    """Highest 0-based age an origin can show at ``as_of`` (origin + age <= current period)."""
    now = F.year(as_of) * 12 + F.month(as_of) - 1
    return F.floor((now - origin_start_index(origin, grain)) / months_per_period(grain)).cast("int")
