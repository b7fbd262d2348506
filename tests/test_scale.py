"""What has to hold at any size: plan shapes, hot keys, medians of large groups."""

import re
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import fixtures
from tailwise.operators import chainladder, percentiles, triangle
from tailwise.plans.inputs import Inputs
from tailwise.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


SINGLE_SCAN = [
    "triangle_by_loss_type", "reserve_estimates", "reserve_estimates_with_total", "mack_estimates",
    "mack_1993", "development_factors", "ibnr_runoff", "growth_curve_fit", "method_comparison",
    "method_totals", "reserve_variability", "tail_sensitivity", "actual_vs_expected",
    "triangle_quality", "triangle_long_store", "triangle_summary",
]


@pytest.mark.parametrize("name", SINGLE_SCAN)
def test_payments_are_read_once(spark, name):
    text = plan(QUERIES[name](Inputs(spark, SF)))
    assert len(re.findall(r"FileScan parquet \[l_", text)) == 1, text


# These write claim-days, cells and claims once and read them from there: no scan of the payments is left.
WRITTEN_ONCE = ["metric_values", "reserve_alerts", "claim_size_trend"]


@pytest.mark.parametrize("name", WRITTEN_ONCE)
def test_payments_are_read_once_when_written(spark, name, monkeypatch):
    from tailwise.operators import dashboards
    from tailwise.plans import inputs

    scans = []

    def counting(df, label, kept=inputs.materialise):
        scans.append(len(re.findall(r"FileScan parquet \[l_", plan(df))))
        return kept(df, label)

    monkeypatch.setattr(inputs, "materialise", counting)
    monkeypatch.setattr(dashboards, "materialise", counting)
    text = plan(QUERIES[name](Inputs(spark, SF)))
    assert "FileScan parquet [l_" not in text, text
    assert sum(scans) == 1, scans


STREAMED = {
    "claims_stream_ingest", "payments_stream_ingest", "streamed_cells", "derived_tables", "stream_quarantine",
    "stream_expectation_counts", "claim_versions", "versioned_cells", "maintained_cells",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMED))
def test_no_python_and_no_products_of_large_inputs(spark, name):
    text = plan(QUERIES[name](Inputs(spark, SF)))
    assert "EvalPython" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text
    # Nested loops occur only with one-row aggregates.
    for side in re.findall(r"BroadcastNestedLoopJoin.*", text):
        assert "Cross" in side or "Inner" in side
    assert "BroadcastNestedLoopJoin" not in text or name in (
        "risk_loaded_estimates", "reserve_summary", "reserve_summary_held", "reserve_adequacy_view",
        "reserve_adequacy_recomputed", "executive_dashboard", "summary_metrics", "reserve_alerts",
        "kpi_counters", "executive_summary", "adequacy_by_loss_type", "boardroom", "total_ibnr",
        "deficient_loss_types", "metric_values",
    )


def test_columns_are_pruned_and_filters_pushed(spark):
    text = plan(QUERIES["reserve_estimates"](Inputs(spark, SF)))
    schema = re.search(r"ReadSchema: struct<(l_[^>]*)>", text).group(1)
    columns = {c.split(":")[0] for c in schema.split(",")}
    assert columns == {"l_orderkey", "l_extendedprice", "l_discount", "l_shipdate"}
    chosen = triangle.segment_filter(Inputs(spark, SF).table("orders").withColumnRenamed("o_orderpriority", "loss_type"), "1-URGENT")
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan(chosen)


def test_a_claim_with_a_third_of_all_payments(spark):
    """The hot claim reaches the join as one row per day."""
    n = 60_000
    payments = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("claim_id"),
        F.date_add(F.lit("2015-01-01").cast("date"), (F.col("id") % 1500).cast("int")).alias("payment_date"),
        F.lit(1.0).alias("payment_amount"),
        F.lit(0.0).alias("reserve_amount"),
    )
    claims = spark.range(5000).select(
        F.col("id").alias("claim_id"), F.lit("2015-01-01").cast("date").alias("loss_date"),
        F.lit("Fire").alias("loss_type"),
    )
    hot_days = triangle.claim_days(payments).filter("claim_id = 7").count()
    assert hot_days <= 1500
    cells = triangle.paid_cells(payments, claims, ["loss_type"])
    assert sum(r.incremental_value for r in cells.collect()) == n
    base = triangle.triangle_base(payments, claims)
    slow = triangle.triangle_cells(base, ["loss_type"])
    columns = ["development_period", "incremental_value", "claim_count"]
    assert sorted(cells.select(columns).collect()) == sorted(slow.select(columns).collect())


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(st.none(), st.integers(-50, 50).map(float), st.floats(-1e9, 1e9, allow_nan=False).map(lambda v: round(v, 4))),
        ),
        min_size=1, max_size=80,
    )
)
def test_grouped_median_is_exact(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.median for r in percentiles.grouped_median(df, ["k"], "v").collect()}
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert got.keys() == groups.keys()
    for k, values in groups.items():
        assert got[k] == pytest.approx(statistics.median(values), rel=1e-12, abs=1e-12)


def test_total_is_the_sum_of_segments(spark):
    rows = chainladder.with_grand_total(Inputs(spark, SF).estimates()).collect()
    total = sum(r.ibnr for r in rows if r.loss_type == "ALL")
    parts = sum(r.ibnr for r in rows if r.loss_type != "ALL")
    assert total == pytest.approx(parts)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 1000), min_size=1, max_size=5), min_size=2, max_size=6))
def test_random_triangles(spark, increments):
    triangle_values = {}
    for i, steps in enumerate(increments):
        total, values = 0, []
        for x in steps:
            total += x
            values.append(total)
        triangle_values[2000 + i] = values
    cells = fixtures.cells(spark, triangle_values)
    # Brute force chain ladder.
    ages = max(len(v) for v in triangle_values.values())
    factors = []
    for j in range(ages - 1):
        pairs = [(v[j], v[j + 1]) for v in triangle_values.values() if len(v) > j + 1 and v[j] > 0]
        factors.append(sum(b for _, b in pairs) / sum(a for a, _ in pairs) if pairs else 1.0)
    for row in chainladder.reserve_estimates(cells, floor=False).collect():
        values = triangle_values[row.origin_period]
        expected = float(values[-1])
        for f in factors[len(values) - 1:]:
            expected *= f
        assert row.ultimate_loss == pytest.approx(expected, rel=1e-9)
        assert row.latest_age == len(values) - 1


def test_a_run_owns_its_folder(spark):
    import os

    from tailwise.session import materialise, run_folder

    kept = materialise(spark.range(3).toDF("x"), "few")
    assert kept.count() == 3
    folder = run_folder(spark).removeprefix("file:")
    assert spark.sparkContext.applicationId in folder and any(n.startswith("few-") for n in os.listdir(folder))
