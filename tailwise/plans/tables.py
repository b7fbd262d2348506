"""All derived tables from the two raw ones, as a plain dictionary of DataFrames.

Two intermediate tables feed many others and cost a pass over the raw data each: the cells per
loss type and the claims with payments. :func:`build_tables` writes those two once to the shared
folder and derives the rest from the written copies. The claims are written with their classification,
in one pass over the texts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import analytics, chainladder, claims as claim_ops, metrics, risk, triangle
from ..session import materialise
from ..sources.files import write_table


def pool_cells(cells: DataFrame) -> DataFrame:
    """Cells of all loss types together; a claim has one loss type, so claim counts add up."""
    pooled = cells.groupBy("origin_period", "development_period").agg(
        F.sum("incremental_value").alias("incremental_value"),
        F.sum("claim_count").alias("claim_count"),
    )
    totals = triangle.running_total(
        pooled, ["origin_period"], "development_period", "incremental_value"
    )
    return totals.withColumn("loss_type", F.lit("ALL"))


def build_tables(
    claims: DataFrame,
    payments: DataFrame,
    as_of: dt.date,
    tail: float = 1.0,
    max_periods: int | None = None,
    scale: int | None = None,
) -> dict[str, DataFrame]:
    """Silver and gold tables by name, all as of one valuation date.

    One fold of the payments to claim-days feeds the cells and the claim totals.
    """
    tables: dict[str, DataFrame] = {}

    days = materialise(triangle.claim_days(payments, as_of), "claim-days")
    by_type = materialise(
        triangle.paid_cells(
            days, claims, ["loss_type"], max_periods=max_periods, scale=scale, fold_days=False
        ),
        "cells",
    )
    enriched = claim_ops.enrich_claims(claims, days, scale=scale)
    judged = materialise(risk.classify_claims(enriched, textless=True), "claims-classified")
    with_payments = judged.select(*enriched.columns)
    classified = judged.filter(risk.has_text())

    pooled = pool_cells(by_type)
    tables["triangle_base"] = triangle.triangle_base(payments, claims, as_of=as_of)
    tables["triangle_by_loss_type"] = triangle.label_cells(by_type, as_of=as_of)
    tables["triangle_cells"] = triangle.label_cells(pooled, as_of=as_of)
    tables["triangle_pivot"] = triangle.triangle_wide(pooled, triangle.ages_of(pooled, at_least=10))

    tables["claims_with_payments"] = with_payments
    tables["claims_basic_risk"] = risk.flag_patterns(with_payments)
    tables["risk_summary_basic"] = risk.risk_summary(
        tables["claims_basic_risk"], flag="high_risk_flag_sql", detail="indicator"
    )
    tables["claims_classified"] = classified
    tables["risk_summary"] = risk.risk_summary(classified, detail="classified")
    tables["risk_entities"] = risk.risk_entity_breakdown(classified, as_of)
    tables["high_risk_detail"] = risk.high_risk_detail(classified, as_of)
    tables["litigation_watch_list"] = risk.litigation_watch_list(classified)

    links = chainladder.link_ratios(pooled)
    tables["link_ratios"] = links
    tables["ata_factors"] = chainladder.ata_factors(links)
    tables["cdf_factors"] = chainladder.cdf_factors(links, terminal=False)
    tables["development_factors"] = chainladder.development_factors(by_type, tail=tail)
    estimates = chainladder.reserve_estimates(by_type, tail=tail)
    tables["reserve_estimates"] = chainladder.with_grand_total(estimates)
    loading = chainladder.risk_loading_factor(tables["risk_summary"])
    total = tables["reserve_estimates"].filter(F.col("loss_type") == "ALL")
    summary = metrics.reserve_summary(total, loading, as_of)
    tables["reserve_summary"] = summary

    tables["reserve_adequacy"] = metrics.reserve_adequacy_view(summary)
    tables["ibnr_by_origin"] = metrics.ibnr_by_origin(tables["reserve_estimates"])
    tables["risk_exposure"] = metrics.risk_exposure(tables["risk_summary"])
    tables["executive_dashboard"] = metrics.executive_dashboard(summary)
    tables["development_factor_view"] = metrics.development_factor_view(
        tables["development_factors"]
    )
    if "county" in claims.columns:
        tables["claims_watchlist"] = metrics.claims_watchlist(classified)

    tables["development_curves"] = triangle.development_curves(pooled)
    tables["calendar_year_development"] = triangle.calendar_year_development(pooled)
    tables["actual_vs_expected"] = analytics.actual_vs_expected(pooled)
    tables["ata_diagnostics"] = analytics.ata_diagnostics(tables["ata_factors"])
    tables["development_exhibit"] = analytics.development_exhibit(links)
    tables["ibnr_runoff"] = analytics.ibnr_runoff(by_type, tail=tail)
    tables["growth_curve_fit"] = analytics.growth_curve_fit(pooled)
    tables["method_comparison"] = analytics.method_comparison(estimates)
    tables["reserve_variability"] = analytics.reserve_variability(by_type, tail=tail)
    tables["tail_sensitivity"] = analytics.tail_sensitivity(estimates)
    return tables


PARTITIONED = {
    "triangle_by_loss_type": ("triangle_type", "loss_type"),
    "triangle_cells": ("triangle_type", "loss_type"),
    "reserve_estimates": ("loss_type",),
}


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Store every table as parquet below ``folder``, partitioned where it is filtered by segment."""
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}", "overwrite", PARTITIONED.get(name, ()))
