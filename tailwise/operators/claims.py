"""Claim-level operators: payment totals per claim, incurred amounts, ageing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import periods


def payment_totals(
    payments: DataFrame, reserve_mode: str = "max", as_of: dt.date | None = None
) -> DataFrame:
    """Last payment date, total paid and case reserve per claim, up to ``as_of`` if given.

    ``reserve_mode="max"`` is the highest reserve ever set; ``"latest"`` the one set with the last
    payment (the larger of several on that day). All aggregates combine on the map side.
    """
    if as_of is not None:
        payments = payments.filter(F.col("payment_date") <= F.lit(as_of))
    if reserve_mode == "max":
        reserve = F.max("reserve_amount")
    elif reserve_mode == "latest":
        reserve = F.max(F.struct("payment_date", "reserve_amount"))["reserve_amount"]
    else:
        raise ValueError(f"unknown reserve_mode {reserve_mode!r}; choose 'max' or 'latest'")
    return payments.groupBy("claim_id").agg(
        F.max("payment_date").alias("latest_payment_date"),
        F.sum("payment_amount").alias("total_paid"),
        reserve.alias("current_reserve"),
    )


def enrich_claims(
    claims: DataFrame, payments: DataFrame, reserve_mode: str = "max", scale: int | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Every claim with its payment totals (up to ``as_of``), incurred amount and origin year.

    ``scale`` rounds the amounts so that results do not depend on the order of floating sums.
    """
    joined = claims.join(payment_totals(payments, reserve_mode, as_of), "claim_id", "left")
    paid = F.coalesce("total_paid", F.lit(0.0))
    reserve = F.coalesce("current_reserve", F.lit(0.0))
    incurred = paid + reserve
    if scale is not None:
        paid, reserve, incurred = (F.round(c, scale) for c in (paid, reserve, incurred))
    return joined.withColumns(
        {
            "total_paid": paid,
            "current_reserve": reserve,
            "incurred_amount": incurred,
            "origin_year": F.year("loss_date"),
            "origin_period": periods.origin_key("loss_date"),
        }
    )


def age_in_months(as_of: dt.date, loss_date: str = "loss_date") -> Column:
    return F.months_between(F.lit(as_of), F.col(loss_date))


def older_than(claims: DataFrame, months: int, as_of: dt.date) -> DataFrame:
    """Claims whose loss lies more than ``months`` months before ``as_of``."""
    return claims.filter(age_in_months(as_of) > months)
