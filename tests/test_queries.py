"""Named queries against their SQL on the smallest data.

One query of each family by default; ALL_QUERIES=1 runs all of them (about twelve minutes).
"""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, differences

SF = "/root/testdata/sf0.001"

FAMILIES = [
    "actual_vs_expected", "reserve_alerts", "claim_classification", "claim_size_trend", "claims_batch_ingest",
    "credibility_blend", "development_exhibit", "duplicate_check", "enriched_claims",
    "executive_summary", "growth_curve_fit", "ibnr_runoff", "incurred_triangle_latest", "mack_1993",
    "mack_estimates", "method_totals", "null_check", "paid_triangle_quarterly",
    "predicted_development", "reserve_estimates_with_total", "reserve_summary", "risk_detection",
    "risk_entity_breakdown", "risk_exposure", "standard_vs_high_risk_fit", "streamed_cells",
    "triangle_densified", "triangle_long_store", "triangle_quality", "top_high_risk_claims",
    "payments_outside_window", "triangle_monthly", "triangle_quality_quarterly", "expected_values_with_holes",
    "metric_values", "stream_quarantine", "stream_expectation_counts", "claim_versions", "versioned_cells",
    "maintained_cells", "boardroom", "kpi_counters",
    "adequacy_without_held", "orphan_payments", "triangle_completeness",
]
CHOSEN = entry.oracle_sql() if os.environ.get("ALL_QUERIES") else FAMILIES


def test_every_query_has_sql():
    from tailwise.plans.queries import QUERIES

    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(CHOSEN))
def test_query_matches_sql(spark, con, name):
    sql = entry.oracle_sql()[name]
    assert differences(entry.queries()[name](spark, SF), con, sql) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "loss_type", "origin_period", "latest_cumulative", "ultimate_loss", "ibnr", "percent_reported",
    ]
