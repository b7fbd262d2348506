"""The worked examples with their published figures."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

import fixtures
from tailwise.operators import analytics, chainladder, claims, diagnostics, metrics, risk, triangle

approx = pytest.approx


@pytest.fixture(scope="module")
def small(spark):
    return fixtures.claims(spark), fixtures.payments(spark)


@pytest.fixture(scope="module")
def pooled(spark):
    return fixtures.cells(spark, fixtures.POOLED)


def test_triangle_of_ten_claims(spark, small):
    cells = triangle.paid_cells(small[1], small[0])
    values = {
        (r.origin_period, r.development_period): r.cumulative_value for r in cells.collect()
    }
    assert values == {
        (2018, 0): 160000, (2018, 1): 240000, (2018, 2): 265000, (2018, 3): 300000,
        (2019, 0): 68000, (2020, 0): 27000, (2021, 0): 25000,
    }


def test_both_routes_to_the_cells_agree(small):
    columns = ["loss_type", "origin_period", "development_period", "incremental_value",
               "cumulative_value", "claim_count"]
    fast = triangle.paid_cells(small[1], small[0], ["loss_type"]).select(columns)
    base = triangle.triangle_base(small[1], small[0])
    slow = triangle.triangle_cells(base, ["loss_type"]).select(columns)
    assert sorted(fast.collect()) == sorted(slow.collect())


def test_reserves_of_ten_claims(spark, small):
    from pyspark.sql import functions as F

    cells = triangle.paid_cells(small[1], small[0]).withColumn("loss_type", F.lit("ALL"))
    factors = fixtures.by_key(chainladder.development_factors(cells), "development_period")
    assert [factors[j].ata_factor for j in range(3)] == approx([1.5, 1.104167, 1.132075], abs=1e-6)
    assert [factors[j].cdf_to_ultimate for j in range(3)] == approx([1.875, 1.25, 1.132075], abs=1e-6)
    found = fixtures.by_key(chainladder.reserve_estimates(cells), "origin_period")
    assert [found[y].ultimate_loss for y in range(2018, 2022)] == approx(
        [300000, 127500, 50625, 46875]
    )
    assert [found[y].ibnr for y in range(2018, 2022)] == approx([0, 59500, 23625, 21875])


def test_reserves_of_sixty_claims(pooled):
    found = fixtures.by_key(chainladder.reserve_estimates(pooled), "origin_period")
    assert [round(found[y].ibnr, 2) for y in range(2018, 2024)] == [
        0.0, 5353.16, 18838.67, 18304.94, 68551.53, 75935.09,
    ]
    assert sum(r.ibnr for r in found.values()) == approx(186983.38, abs=0.01)
    factors = fixtures.by_key(
        chainladder.ata_factors(chainladder.link_ratios(pooled)), "development_period"
    )
    assert [round(factors[j].ata_factor, 6) for j in range(4)] == [
        1.282919, 1.100216, 1.031864, 1.007435,
    ]
    assert [factors[j].n_observations for j in range(4)] == [5, 4, 2, 1]
    assert factors[3].ata_stddev is None


def test_fused_estimates_equal_the_single_steps(pooled):
    links = chainladder.link_ratios(pooled)
    for tail in (1.0, 1.05):
        factors = chainladder.cdf_factors(links, tail=tail)
        stepwise = chainladder.project_ultimate(chainladder.latest_diagonal(pooled), factors)
        fused = fixtures.by_key(chainladder.reserve_estimates(pooled, tail=tail), "origin_period")
        for row in stepwise.collect():
            assert fused[row.origin_period].ultimate_loss == approx(row.ultimate_loss)
            assert fused[row.origin_period].percent_reported == approx(row.percent_reported)


def test_volume_weighted_beats_simple_average(spark):
    cells = fixtures.cells(spark, {2000: [1000, 1200], 2001: [5000, 5500]})
    row = chainladder.ata_factors(chainladder.link_ratios(cells)).first()
    assert row.ata_factor == approx(6700 / 6000)
    assert row.ata_simple_avg == approx(1.15)


def test_risk_loading(spark):
    summary = spark.createDataFrame([(30.0, 100.0)], "high_risk_incurred double, total_incurred double")
    loading = chainladder.risk_loading_factor(summary)
    estimates = spark.createDataFrame(
        [("ALL", 2020, 420000.0, 525000.0, 105000.0)],
        "loss_type string, origin_period int, latest_cumulative double, ultimate_loss double, ibnr double",
    )
    row = metrics.reserve_summary(estimates, loading, dt.date(2021, 12, 31)).first()
    assert row.ai_adjustment_factor == approx(1.15)
    assert row.held_reserves == approx(120750)
    assert row.reserve_margin == approx(15750)
    assert row.reserve_adequacy == approx(1.15)


def test_adequacy_bands(spark):
    rows = spark.createDataFrame([(1.0,), (0.85,), (0.8499,)], "a double")
    labels = [r[0] for r in rows.select(metrics.adequacy_status(rows.a)).collect()]
    assert labels == ["ADEQUATE", "MARGINAL", "DEFICIENT"]


def test_segment_with_one_age_has_no_ibnr(spark):
    cells = fixtures.cells(spark, {2020: [100], 2021: [50]}, "Theft")
    rows = chainladder.reserve_estimates(cells, tail=1.1).collect()
    assert [(r.ibnr, r.percent_reported, r.ultimate_loss) for r in rows] == [
        (0.0, 1.0, r.latest_cumulative) for r in rows
    ]
    assert chainladder.development_factors(cells).count() == 0


def test_hole_in_the_triangle_drops_both_links(spark):
    cells = fixtures.cells(spark, {2018: [100, None, 150], 2019: [100, 120]})
    links = {
        (r.origin_period, r.development_period): r.link_ratio
        for r in chainladder.link_ratios(cells).collect()
    }
    assert links == {(2018, 0): None, (2018, 2): None, (2019, 0): 1.2, (2019, 1): None}
    found = fixtures.by_key(chainladder.reserve_estimates(cells), "origin_period")
    assert found[2018].ultimate_loss == approx(150)
    assert found[2019].ultimate_loss == approx(120)


def test_densify_fills_to_the_observed_age_only(spark):
    cells = fixtures.cells(spark, {2018: [100, None, 150], 2020: [80]})
    dense = fixtures.by_key(
        triangle.densify(cells, dt.date(2021, 6, 30), ["loss_type"]),
        "origin_period", "development_period",
    )
    assert sorted(dense) == [(2018, 0), (2018, 1), (2018, 2), (2018, 3), (2020, 0), (2020, 1)]
    assert dense[(2018, 1)].cumulative_value == 100
    assert dense[(2018, 3)].cumulative_value == 150


def test_zero_values_do_not_raise(spark):
    cells = fixtures.cells(spark, {2019: [0, 0, 10], 2020: [0, 5], 2021: [0]})
    rows = fixtures.by_key(chainladder.mack_estimates(cells), "origin_period")
    assert rows[2021].se_ibnr is None
    assert rows[2021].percent_reported == 1.0
    triangle.development_curves(cells, ["loss_type"]).collect()
    analytics.actual_vs_expected(cells).collect()


def test_runoff_adds_up_to_the_ibnr(pooled):
    from pyspark.sql import functions as F

    for tail in (1.0, 1.04):
        runoff = analytics.ibnr_runoff(pooled, tail=tail, floor=False)
        sums = runoff.groupBy("origin_period").agg(
            F.sum("projected_emergence").alias("emerged"), F.first("ibnr").alias("ibnr")
        )
        for row in sums.collect():
            assert row.emerged == approx(row.ibnr, rel=1e-9)


def test_bornhuetter_ferguson_meets_chain_ladder_when_reported(pooled):
    rows = analytics.method_comparison(chainladder.reserve_estimates(pooled)).collect()
    oldest = next(r for r in rows if r.origin_period == 2018)
    assert oldest.percent_reported == 1.0
    assert oldest.bf_ultimate == oldest.cl_ultimate == oldest.benktander_ultimate


def test_last_age_factor_is_the_tail(pooled):
    factors = chainladder.cdf_factors(chainladder.link_ratios(pooled), tail=1.07)
    last = factors.orderBy("development_period").collect()[-1]
    assert last.cdf_to_ultimate == approx(1.07)


def test_completeness_and_quality(pooled):
    row = diagnostics.completeness(pooled).first()
    assert (row.n_origins, row.n_development_periods, row.actual_cells) == (6, 5, 18)
    assert row.expected_cells == 5 + 4 + 3 + 2 + 1 + 0
    assert diagnostics.triangle_quality(pooled).first().overall_quality in ("GOOD", "FAIR", "POOR")


def test_period_boundaries(spark):
    from pyspark.sql import functions as F
    from tailwise.functions import periods

    pairs = [("2018-09-15", "2019-06-15"), ("2018-06-01", "2021-06-01"), ("2020-02-29", "2021-02-28")]
    df = spark.createDataFrame([(fixtures.day(a), fixtures.day(b)) for a, b in pairs], "l date, p date")
    age = periods.development_age("l", "p")
    assert [r[0] for r in df.select(age).collect()] == [0, 3, 1]
    keys = df.select(*[periods.origin_key("l", g) for g in ("year", "quarter", "month")])
    assert tuple(keys.first()) == (2018, 20183, 201809)
    shifted = spark.range(1).select(
        periods.origin_offset(F.lit(20184), F.lit(2), "quarter"),
        periods.origin_offset(F.lit(201811), F.lit(3), "month"),
        periods.origin_offset(F.lit(2018), F.lit(1), "year"),
    )
    assert tuple(shifted.first()) == (20192, 201902, 2019)
    with pytest.raises(ValueError):
        periods.origin_key("l", "week")


def test_as_of_date_cuts_payments(small):
    cells = triangle.paid_cells(small[1], small[0], as_of=dt.date(2019, 12, 31))
    assert {r.origin_period for r in cells.collect()} == {2018, 2019}


def test_incurred_modes(small):
    chosen = small[0].filter("claim_id like 'C18-%'")
    largest = fixtures.by_key(
        triangle.incurred_cells(small[1], chosen), "origin_period", "development_period"
    )
    assert largest[(2018, 0)].incurred_value == 220000  # C18-5: 20,000 paid, 200,000 reserve
    latest = fixtures.by_key(
        triangle.incurred_cells(small[1], chosen, mode="latest"), "origin_period", "development_period"
    )
    # 45,000+25,000; 40,000; 25,000+125,000; 30,000; 20,000+200,000
    assert latest[(2018, 0)].incurred_value == 510000


def test_enriched_claims_reserve_modes(small):
    highest = fixtures.by_key(claims.enrich_claims(*small), "claim_id")
    latest = fixtures.by_key(claims.enrich_claims(*small, reserve_mode="latest"), "claim_id")
    assert highest["C18-5"].current_reserve == 250000
    assert latest["C18-5"].current_reserve == 200000
    assert latest["C18-5"].incurred_amount == 305000


def test_credibility_blend(spark):
    estimates = spark.createDataFrame(
        [(2020, 100.0, 200.0, 0.5), (2021, 100.0, 105.0, 0.95)],
        "origin_period int, latest_cumulative double, ultimate_loss double, percent_reported double",
    )
    chosen = spark.createDataFrame([(2020, 0.25, 10.0)], "origin_period int, z double, case_reserve double")
    rows = fixtures.by_key(analytics.credibility_blend(estimates, chosen), "origin_period")
    assert rows[2020].bf_ultimate == approx(188.0)
    assert rows[2020].ultimate_reserve == approx(0.25 * 200 + 0.75 * 188)
    assert rows[2021].bf_ultimate == approx(110.0)
    assert rows[2021].ibnr_reserve == approx(107.5 - 100 - 99)


def test_predictions_flag_unknown_ages(spark, pooled):
    positions = spark.createDataFrame(
        [("ALL", 2023, 100.0, 0), ("ALL", 2000, 100.0, 99)],
        "loss_type string, origin_period int, current_value double, current_age int",
    )
    factors = chainladder.cdf_factors(chainladder.link_ratios(pooled))
    rows = fixtures.by_key(chainladder.predict_development(positions, factors), "origin_period")
    assert rows[2023].projected_ultimate == approx(146.7293, abs=1e-3)
    assert rows[2000].projected_ultimate is None and not rows[2000].valid_age


def test_flagged_claims_of_the_small_portfolio(small):
    scored = fixtures.by_key(risk.detect_risks(small[0]), "claim_id")
    assert scored["C18-5"].risk_keywords == ["mold", "black mold", "attorney", "representation"]
    assert scored["C18-5"].risk_score == 1.0
    assert scored["C18-5"].risk_category == "water_damage"


@pytest.mark.parametrize("grain", ["year", "quarter", "month"])
def test_cells_hold_every_payment_on_or_after_the_loss(spark, grain):
    claims, payments = fixtures.claims(spark), fixtures.payments(spark)
    base = triangle.triangle_base(payments, claims, grain)
    cells = triangle.paid_cells(payments, claims, grain=grain)
    total = base.agg(F.sum("payment_amount")).first()[0]
    assert cells.agg(F.sum("incremental_value")).first()[0] == total
    limited = triangle.paid_cells(payments, claims, grain=grain, max_periods=2)
    outside = triangle.payments_outside_window(base, 2)
    left = sum(r.payment_amount for r in outside.collect())
    assert (limited.agg(F.sum("incremental_value")).first()[0] or 0) + left == total


def test_holes_and_tall_triangles(spark):
    from tailwise.operators import analytics, diagnostics

    rows = [("a", o, d, 100.0 * 2**d) for o in (1, 2) for d in range(3)] + [("a", 3, 0, 100.0), ("a", 3, 2, 400.0)]
    cells = spark.createDataFrame(rows, "loss_type string, origin_period int, development_period int, cumulative_value double")
    compared = analytics.actual_vs_expected(cells).filter("origin_period = 3").collect()
    assert compared == []
    tall = [("a", o, d, 1.0) for o in range(12) for d in range(3)]
    tall = spark.createDataFrame(tall, cells.schema)
    row = diagnostics.completeness(tall).first()
    assert (row.expected_cells, row.actual_cells) == (6, 36)


def test_a_type_without_held_amount_is_deficient(spark):
    from tailwise.operators import metrics

    estimates = spark.createDataFrame(
        [("a", 1, 10.0, 20.0, 10.0, 0.5), ("b", 1, 10.0, 20.0, 10.0, 0.5)],
        "loss_type string, origin_period int, latest_cumulative double, ultimate_loss double, ibnr double, percent_reported double",
    )
    held = spark.createDataFrame([("a", 25.0)], "loss_type string, held_reserves double")
    got = {r.loss_type: (r.held_reserves, r.adequacy_status) for r in metrics.adequacy_of_held(estimates, held).collect()}
    assert got == {"a": (25.0, "ADEQUATE"), "b": (0.0, "DEFICIENT")}


def test_one_valuation_date_for_cells_and_claims(spark):
    from tailwise.plans.tables import build_tables

    as_of = dt.date(2019, 12, 31)
    tables = build_tables(fixtures.claims(spark), fixtures.payments(spark), as_of)
    paid = tables["triangle_cells"].agg(F.sum("incremental_value")).first()[0]
    assert tables["claims_with_payments"].agg(F.sum("total_paid")).first()[0] == paid
    late = claims.payment_totals(fixtures.payments(spark), as_of=as_of).agg(F.max("latest_payment_date")).first()[0]
    assert late <= as_of
