"""The named queries. Each takes the session and a data folder and returns a lazy result."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import periods
from ..functions.vocabulary import SHORT_TERMS, extend
from ..operators import (
    analytics, chainladder, claims, dashboards, diagnostics, metrics, quality, risk, triangle,
)
from ..schemas import CLAIM_STATUSES, LOSS_TYPES, REQUIRED_CLAIM_COLUMNS, conform, contract
from ..session import fresh_path
from ..sources import evolution, files
from ..streaming import cells as stream_cells
from ..streaming import expectations as stream_expectations
from ..streaming import ingest
from ..streaming.triangles import TriangleStore
from ..streaming.versions import KeyedTable
from . import tables
from .inputs import AS_OF, SCALE, Inputs, joined_text, shown

QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a function of :class:`Inputs` under its own name."""
    QUERIES[build.__name__] = build
    return build


def bound(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return QUERIES[name](Inputs(spark, sf_dir))

    run.__name__ = name
    return run


# Sums of payments are exact to four decimals; projected amounts are shown in cents.
ESTIMATE_MONEY = ["ultimate_loss", "ibnr"]

# Columns of the published yearly layout, and all quarters an origin since 1992 can show at the end of 1999.
LAYOUT_AGES = 10
QUARTERS = 32


def shown_estimates(df: DataFrame, **places) -> DataFrame:
    return shown(shown(df, p4="latest_cumulative"), **places)



# --- projections, joins and claim-level aggregates -------------------------------------------


@query
def origin_periods(x: Inputs) -> DataFrame:
    keyed = triangle.add_origin_period(x.claims(), grain="quarter")
    return keyed.select(
        "claim_id", "origin_year", "origin_quarter", "origin_month",
        F.col("origin_period").alias("origin_quarter_key"),
        periods.origin_key("loss_date", "month").alias("origin_month_key"),
    )


@query
def triangle_base(x: Inputs) -> DataFrame:
    base = triangle.triangle_base(x.payments(), x.claims())
    return shown(
        base.select(
            "payment_id", "claim_id", "loss_date", "payment_date", "loss_type", "catastrophe_code",
            "origin_period", "development_period", "payment_amount", "reserve_amount",
        ),
        p4=["payment_amount", "reserve_amount"],
    )


@query
def development_ages_by_grain(x: Inputs) -> DataFrame:
    base = triangle.triangle_base(x.payments(), x.claims(), carry=())
    for grain in ("year", "quarter", "month"):
        age = periods.development_age("loss_date", "payment_date", grain, base=1)
        base = base.withColumn(f"{grain}_age", age)
    return base.groupBy("year_age", "quarter_age", "month_age").agg(
        F.count(F.lit(1)).alias("payments")
    )


@query
def valid_development_window(x: Inputs) -> DataFrame:
    base = triangle.triangle_base(x.payments(), x.claims(), dev_base=1, carry=())
    kept = triangle.filter_valid_development(base, max_periods=5, base=1)
    return kept.groupBy("development_period").agg(F.count(F.lit(1)).alias("payments"))


@query
def cell_aggregates(x: Inputs) -> DataFrame:
    base = triangle.triangle_base(x.payments(), x.claims(), carry=())
    cells = triangle.aggregate_cells(base, "payment_amount", ["sum", "count", "avg"])
    return shown(cells, p4=["cell_sum", "cell_avg"])


@query
def claim_running_paid(x: Inputs) -> DataFrame:
    daily = triangle.claim_days(x.payments(), AS_OF)
    running = triangle.running_total(
        daily, ["claim_id"], "payment_date", "payment_amount", "cumulative_paid"
    )
    return shown(running, p4=["payment_amount", "reserve_amount", "cumulative_paid"])


@query
def payment_totals(x: Inputs) -> DataFrame:
    return shown(claims.payment_totals(x.payments()), p4=["total_paid", "current_reserve"])


@query
def payment_totals_latest_reserve(x: Inputs) -> DataFrame:
    totals = claims.payment_totals(x.payments(), reserve_mode="latest")
    return shown(totals, p4=["total_paid", "current_reserve"])


@query
def enriched_claims(x: Inputs) -> DataFrame:
    return x.enriched(places=True).select(
        "claim_id", "policy_id", "loss_date", "report_date", "claimant_name", "loss_type",
        "loss_description", "adjuster_notes", "claim_status", "county", "state",
        "catastrophe_code", "origin_year", "latest_payment_date", "total_paid",
        "current_reserve", "incurred_amount",
    )


@query
def claims_older_than_24_months(x: Inputs) -> DataFrame:
    old = claims.older_than(x.claims(), 24, AS_OF)
    return old.groupBy("loss_type", "claim_status").agg(F.count(F.lit(1)).alias("claim_count"))


# --- triangles -------------------------------------------------------------------------------


@query
def triangle_cells(x: Inputs) -> DataFrame:
    cells = triangle.label_cells(x.cells(()), as_of=AS_OF)
    return shown(cells, p4=["incremental_value", "cumulative_value"])


@query
def triangle_by_loss_type(x: Inputs) -> DataFrame:
    cells = triangle.label_cells(x.cells(), as_of=AS_OF)
    return shown(cells, p4=["incremental_value", "cumulative_value"])


@query
def triangle_cells_from_base(x: Inputs) -> DataFrame:
    days = triangle.claim_days(x.payments(), keep=["payment_type"])
    base = triangle.triangle_base(days, x.claims())
    cells = triangle.triangle_cells(base, ["loss_type", "payment_type"], scale=SCALE)
    return shown(cells, p4=["incremental_value", "cumulative_value"])


@query
def triangle_pivot(x: Inputs) -> DataFrame:
    wide = triangle.triangle_wide(x.cells(()), range(10))
    return shown(wide, p4=[c for c in wide.columns if c.startswith("dev_")])


@query
def triangle_water_damage(x: Inputs) -> DataFrame:
    chosen = triangle.segment_filter(x.claims(), loss_type="Water Damage")
    cells = triangle.paid_cells(x.payments(), chosen, scale=SCALE)
    return shown(cells, p4=["incremental_value", "cumulative_value"])


def _wide(df: DataFrame) -> DataFrame:
    return shown(df, p4=[c for c in df.columns if c.startswith("dev_")])


@query
def payments_outside_window(x: Inputs) -> DataFrame:
    """What a limit of three months of development would leave out, per later age."""
    base = triangle.triangle_base(x.payments(), x.claims(), grain="month")
    return shown(triangle.payments_outside_window(base, 3), p4="payment_amount")


@query
def triangle_monthly(x: Inputs) -> DataFrame:
    """Monthly cells of every age."""
    cells = x.cells(grain="month")
    return shown(cells, p4=["incremental_value", "cumulative_value"])


@query
def triangle_quality_quarterly(x: Inputs) -> DataFrame:
    """Completeness where origins outnumber ages."""
    return shown(diagnostics.completeness(x.cells(grain="quarter")), p6="completeness_pct")


@query
def expected_values_with_holes(x: Inputs) -> DataFrame:
    """Actual against expected over small segments, whose triangles have holes."""
    segments = ["loss_type", "claim_status", "state"]
    placed = x.claims(places=True)
    cells = triangle.paid_cells(x.payments(), placed, segments, grain="month", scale=SCALE)
    compared = analytics.actual_vs_expected(cells, segments)
    return shown(compared, p4=["actual_value", "expected_value", "residual"]).drop("pct_deviation")


@query
def adequacy_without_held(x: Inputs) -> DataFrame:
    """Adequacy where one loss type has no held amount at all."""
    held = x.enriched().filter(F.col("loss_type") != "Fire")
    held = held.groupBy("loss_type").agg(F.sum("incurred_amount").alias("held_reserves"))
    adequacy = metrics.adequacy_of_held(x.estimates(), held)
    money = ["estimated_ultimate", "estimated_ibnr", "reserve_margin"]
    return shown(adequacy, p4="held_reserves", p2=money, p6="reserve_adequacy")


@query
def paid_triangle_quarterly(x: Inputs) -> DataFrame:
    return _wide(
        triangle.paid_triangle(
            x.payments(), x.claims(), loss_type="Fire", grain="quarter", max_periods=QUARTERS,
            as_of=AS_OF.replace(year=1999), scale=SCALE,
        )
    )


@query
def paid_triangle_state(x: Inputs) -> DataFrame:
    return _wide(
        triangle.paid_triangle(
            x.payments(), x.claims(places=True), loss_type="Wind", state="ASIA", dev_base=1,
            max_periods=LAYOUT_AGES, scale=SCALE,
        )
    )


@query
def incurred_triangle(x: Inputs) -> DataFrame:
    return _wide(
        triangle.incurred_triangle(x.payments(), x.claims(), loss_type="Theft", max_periods=LAYOUT_AGES, scale=SCALE)
    )


@query
def incurred_triangle_latest(x: Inputs) -> DataFrame:
    return _wide(
        triangle.incurred_triangle(x.payments(), x.claims(), mode="latest", max_periods=LAYOUT_AGES, scale=SCALE)
    )


@query
def triangle_long_store(x: Inputs) -> DataFrame:
    long = triangle.triangle_long(x.cells(()), range(10), as_of=AS_OF)
    return shown(long, p4=["cumulative_value", "incremental_value"]).drop("state", "county")


@query
def triangle_long_by_segment(x: Inputs) -> DataFrame:
    """The stored form of all triangles by loss type and state."""
    segments = ["loss_type", "state"]
    cells = triangle.paid_cells(x.payments(), x.claims(places=True), segments, scale=SCALE)
    long = triangle.triangle_long(cells, range(LAYOUT_AGES), as_of=AS_OF, segments=segments)
    return shown(long, p4=["cumulative_value", "incremental_value"]).drop("county")


@query
def triangle_densified(x: Inputs) -> DataFrame:
    cells = x.cells(("loss_type", "claim_status"))
    dense = triangle.densify(cells, AS_OF, ["loss_type", "claim_status"])
    return shown(dense, p4=["incremental_value", "cumulative_value"])


@query
def development_curves(x: Inputs) -> DataFrame:
    curves = triangle.development_curves(x.cells(), ["loss_type"])
    return shown(curves, p4=["cumulative_value", "incremental_value"], p6="development_index")


@query
def calendar_year_development(x: Inputs) -> DataFrame:
    calendar = triangle.calendar_year_development(x.cells(), ["loss_type"])
    return shown(calendar, p4=["total_incremental"], p2="avg_incremental")


@query
def incremental_by_age(x: Inputs) -> DataFrame:
    return shown(triangle.incremental_by_age(x.cells(), ["loss_type"]), p4="incremental_loss")


@query
def triangle_summary(x: Inputs) -> DataFrame:
    summary = triangle.triangle_summary(x.cells(), ["loss_type"])
    exact = ["total_value", "min_value", "max_value", "diagonal_sum", "first_period_total"]
    return shown(summary, p4=exact, p2="mean_value")


# --- chain ladder ----------------------------------------------------------------------------


@query
def link_ratios(x: Inputs) -> DataFrame:
    links = x.links().select(
        "loss_type", "origin_period", "development_period", "cumulative_value", "next_value",
        "link_ratio",
    )
    return shown(links, p4=["cumulative_value", "next_value"], p6="link_ratio")


@query
def ata_factors(x: Inputs) -> DataFrame:
    factors = chainladder.ata_factors(x.links())
    return shown(factors, p6=["ata_factor", "ata_simple_avg", "ata_min", "ata_max", "ata_stddev"])


@query
def cdf_factors_table(x: Inputs) -> DataFrame:
    factors = chainladder.cdf_factors(x.links(), terminal=False)
    return shown(factors, p6=["ata_factor", "cdf_to_ultimate"])


@query
def cdf_factors_with_tail(x: Inputs) -> DataFrame:
    factors = chainladder.cdf_factors(x.links(), tail=1.05)
    return shown(factors, p6=["ata_factor", "cdf_to_ultimate"])


@query
def latest_diagonal(x: Inputs) -> DataFrame:
    return shown(chainladder.latest_diagonal(x.cells()), p4="latest_cumulative")


@query
def projected_ultimates(x: Inputs) -> DataFrame:
    cells = x.cells()
    factors = chainladder.cdf_factors(chainladder.link_ratios(cells), tail=1.02)
    projected = chainladder.project_ultimate(chainladder.latest_diagonal(cells), factors)
    return shown_estimates(
        projected.drop("development_age"),
        p2=ESTIMATE_MONEY, p6=["cdf_to_ultimate", "percent_reported"],
    )


@query
def reserve_estimates(x: Inputs) -> DataFrame:
    return shown_estimates(x.estimates(), p2=ESTIMATE_MONEY, p6=["cdf_to_ultimate", "percent_reported"])


@query
def reserve_estimates_unfloored(x: Inputs) -> DataFrame:
    estimates = chainladder.reserve_estimates(x.cells(), tail=0.95, floor=False)
    return shown_estimates(estimates, p2=ESTIMATE_MONEY, p6=["cdf_to_ultimate", "percent_reported"])


@query
def reserve_estimates_with_total(x: Inputs) -> DataFrame:
    every = chainladder.with_grand_total(x.estimates())
    return shown_estimates(every, p2=ESTIMATE_MONEY, p6="percent_reported")


@query
def reserve_estimates_pooled(x: Inputs) -> DataFrame:
    pooled = chainladder.reserve_estimates(x.pooled_cells())
    return shown_estimates(pooled, p2=ESTIMATE_MONEY, p6=["cdf_to_ultimate", "percent_reported"])


@query
def development_factors(x: Inputs) -> DataFrame:
    factors = chainladder.development_factors(x.cells())
    return shown(factors, p6=["ata_factor", "cdf_to_ultimate", "percent_developed"])


@query
def mack_sigma2(x: Inputs) -> DataFrame:
    return shown(chainladder.mack_sigma2(x.cells()), p6="ata_factor", p2="sigma2")


@query
def mack_estimates(x: Inputs) -> DataFrame:
    estimates = chainladder.mack_estimates(x.cells())
    return shown_estimates(
        estimates, p2=[*ESTIMATE_MONEY, "se_ibnr"], p6=["cdf_to_ultimate", "percent_reported", "cv"]
    )


@query
def mack_1993(x: Inputs) -> DataFrame:
    errors = chainladder.mack_1993(x.cells()).select(
        "loss_type", "origin_period", "ultimate_loss", "ibnr", "se_ibnr"
    )
    return shown(errors, p2=["ultimate_loss", "ibnr", "se_ibnr"])


@query
def reserve_totals_interval(x: Inputs) -> DataFrame:
    totals = chainladder.reserve_totals(chainladder.mack_estimates(x.cells()))
    projected = [c for c in totals.columns if c not in ("loss_type", "total_paid")]
    return shown(totals, p4="total_paid", p2=projected)


@query
def predicted_development(x: Inputs) -> DataFrame:
    positions = x.enriched().select(
        "claim_id",
        "loss_type",
        "origin_period",
        F.col("total_paid").alias("current_value"),
        periods.development_age("loss_date", F.lit(AS_OF), base=0).alias("current_age"),
    )
    factors = chainladder.cdf_factors(x.links())
    scored = chainladder.predict_development(positions, factors)
    return shown(
        scored, p4=["current_value", "projected_ultimate", "projected_ibnr"],
        p6=["cdf_to_ultimate", "percent_reported"],
    )


@query
def standard_vs_high_risk_fit(x: Inputs) -> DataFrame:
    flagged = risk.flag_patterns(x.claims())
    kinds = F.when(F.col("high_risk_flag_sql"), F.array(F.lit("all"), F.lit("high_risk")))
    segmented = flagged.withColumn("risk_segment", F.explode(kinds.otherwise(F.array(F.lit("all")))))
    cells = triangle.paid_cells(x.payments(), segmented, ["risk_segment"], scale=SCALE)
    compared = chainladder.compare_risk_segments(cells)
    return shown(
        compared, p6="ibnr_increase_pct", p2=[c for c in compared.columns if not c.endswith("_pct")]
    )


@query
def risk_loaded_estimates(x: Inputs) -> DataFrame:
    loaded = chainladder.load_for_risk(x.total_estimates(), x.loading())
    money = [*ESTIMATE_MONEY, "ai_adjusted_ultimate", "ai_adjusted_ibnr", "ibnr_difference"]
    return shown_estimates(loaded, p2=money, p6=["percent_reported", "ai_adjustment_factor"])


# --- diagnostics -----------------------------------------------------------------------------


@query
def triangle_completeness(x: Inputs) -> DataFrame:
    return shown(diagnostics.completeness(x.cells()), p6="completeness_pct")


@query
def development_stability(x: Inputs) -> DataFrame:
    stable = diagnostics.development_stability(x.cells())
    names = ["mean_factor", "median_factor", "std_factor", "min_factor", "max_factor", "cv"]
    return shown(stable, p6=names)


@query
def outlier_factors(x: Inputs) -> DataFrame:
    outliers = diagnostics.detect_outliers(x.cells(), threshold=1.5)
    return shown(outliers, p6=["link_ratio", "mean_factor", "z_score"])


@query
def triangle_quality(x: Inputs) -> DataFrame:
    return shown(diagnostics.triangle_quality(x.cells()), p6="completeness_pct")


# --- reserve analytics -----------------------------------------------------------------------


@query
def actual_vs_expected(x: Inputs) -> DataFrame:
    compared = analytics.actual_vs_expected(x.cells())
    return shown(
        compared, p4="actual_value", p2=["expected_value", "residual"], p6="pct_deviation"
    )


@query
def residuals_by_age(x: Inputs) -> DataFrame:
    residuals = analytics.residuals_by_age(analytics.actual_vs_expected(x.cells()))
    return shown(residuals, p2="avg_residual", p6="avg_pct_deviation")


@query
def ata_diagnostics(x: Inputs) -> DataFrame:
    checked = analytics.ata_diagnostics(chainladder.ata_factors(x.links()))
    names = ["ata_factor", "ata_simple_avg", "ata_min", "ata_max", "ata_stddev", "cv", "range_pct"]
    return shown(checked, p6=names)


@query
def development_exhibit(x: Inputs) -> DataFrame:
    return analytics.development_exhibit(x.links())


@query
def ibnr_runoff(x: Inputs) -> DataFrame:
    runoff = analytics.ibnr_runoff(x.cells(), tail=1.02)
    return shown(
        runoff, p2=["projected_emergence", "ibnr", "ultimate_loss"],
        p6=["incremental_emergence_pct", "cumulative_emergence_pct"],
    )


@query
def runoff_by_period(x: Inputs) -> DataFrame:
    runoff = analytics.ibnr_runoff(x.cells(), tail=1.02)
    return shown(analytics.runoff_by_period(runoff), p2="total_emergence")


@query
def growth_curve_fit(x: Inputs) -> DataFrame:
    fit = analytics.growth_curve_fit(x.cells())
    names = ["actual_pct_developed", "fitted_pct_developed", "residual", "omega_param", "theta_param"]
    return shown(fit, p6=names)


@query
def growth_curve_parameters(x: Inputs) -> DataFrame:
    parameters = analytics.growth_curve_parameters(analytics.growth_curve_fit(x.cells()))
    return shown(parameters, p6=["omega_param", "theta_param", "mean_abs_error_pct"])


@query
def method_comparison(x: Inputs) -> DataFrame:
    compared = analytics.method_comparison(x.estimates())
    exact = ("loss_type", "origin_period", "percent_reported", "paid_to_date")
    money = [c for c in compared.columns if c not in exact]
    return shown(compared, p2=money, p4="paid_to_date", p6="percent_reported")


@query
def method_totals(x: Inputs) -> DataFrame:
    totals = analytics.method_totals(analytics.method_comparison(x.estimates()))
    return shown(totals, p2="total_ibnr")


@query
def reserve_variability(x: Inputs) -> DataFrame:
    ranges = analytics.reserve_variability(x.cells())
    money = ["ibnr_mid", "standard_error", "ibnr_low_95", "ibnr_75th_pct", "ibnr_high_95", "range_95"]
    return shown(ranges, p2=money, p6="estimated_cv")


@query
def variability_totals(x: Inputs) -> DataFrame:
    return analytics.variability_totals(analytics.reserve_variability(x.cells()))


@query
def tail_sensitivity(x: Inputs) -> DataFrame:
    scenarios = analytics.tail_sensitivity(x.estimates())
    return shown(
        scenarios, p2=["total_ibnr_base", "adjusted_ibnr", "tail_ibnr_addition"], p6="pct_increase"
    )


def _assumptions(x: Inputs) -> DataFrame:
    """Per-origin credibility and manual amounts derived from the claims of each origin."""
    return x.claims().groupBy(F.year("loss_date").alias("origin_period")).agg(
        (F.avg(F.when(F.col("claim_status") == "Closed", 1.0).otherwise(0.0))).alias("z"),
        F.count(F.lit(1)).cast("double").alias("case_reserve"),
        (F.count_if(F.col("claim_status") == "Open") * 100.0).alias("additional"),
    )


@query
def credibility_blend(x: Inputs) -> DataFrame:
    chosen = _assumptions(x).drop("additional")
    blended = analytics.credibility_blend(x.total_estimates(), chosen)
    money = [*ESTIMATE_MONEY, "case_reserve", "bf_ultimate", "ultimate_reserve", "ibnr_reserve"]
    return shown_estimates(blended, p2=money, p6=["credibility", "percent_reported"])


@query
def manual_adjustments(x: Inputs) -> DataFrame:
    assumptions = _assumptions(x)
    blended = analytics.credibility_blend(
        x.total_estimates(), assumptions.select("origin_period", "z", "case_reserve")
    )
    adjusted = analytics.add_manual_reserve(
        blended, assumptions.select("origin_period", "additional")
    )
    chosen = adjusted.select(
        "origin_period", "ultimate_reserve", "ibnr_reserve", "additional", "total_ultimate",
        "total_ibnr",
    )
    return shown(chosen, p2=[c for c in chosen.columns if c != "origin_period"])


# --- risk ------------------------------------------------------------------------------------


@query
def risk_detection(x: Inputs) -> DataFrame:
    scored = x.scored().select(
        "claim_id", "risk_keywords", "risk_score", "risk_category", "high_risk_flag"
    )
    return shown(joined_text(scored, "risk_keywords"), p6="risk_score")


@query
def risk_detection_short_vocabulary(x: Inputs) -> DataFrame:
    scored = risk.detect_risks(x.claims(), description_col=None, terms=SHORT_TERMS)
    chosen = scored.select(
        "claim_id", "risk_keywords", "risk_score", "risk_category", "high_risk_flag"
    )
    return shown(joined_text(chosen, "risk_keywords"), p6="risk_score")


# Words that do occur in the documents, to exercise a vocabulary of one's own on real texts.
DOCUMENT_WORDS = {
    "the": ("article", 0.2),
    "worthless": ("judgement", 0.9),
    "of the": ("phrase", 0.5),
    "le": ("french", 0.4),
    "der": ("german", 0.4),
    "mold": ("judgement", 0.3),
}


@query
def custom_vocabulary_documents(x: Inputs) -> DataFrame:
    terms = extend(DOCUMENT_WORDS)
    documents = x.table("documents").select("doc_id", "text")
    scored = risk.detect_risks(documents, text_col="text", description_col=None, terms=terms)
    chosen = scored.select("doc_id", "risk_keywords", "risk_score", "risk_category")
    return shown(joined_text(chosen, "risk_keywords"), p6="risk_score")


@query
def pattern_flags(x: Inputs) -> DataFrame:
    return risk.flag_patterns(x.claims()).select(
        "claim_id", "has_water_mold_risk", "has_litigation_risk", "has_structural_risk",
        "risk_category_sql", "high_risk_flag_sql",
    )


@query
def claim_classification(x: Inputs) -> DataFrame:
    classified = x.classified().select(
        "claim_id", "risk_category", "claim_sentiment", "risk_score", "high_risk_flag",
        "risk_keywords", "extracted_risks.*", "_analysis_method",
    )
    return shown(joined_text(classified, "risk_keywords"), p6="risk_score")


_SUMMARY_PLACES = {
    "p4": ["total_incurred", "high_risk_incurred"],
    "p2": ["high_risk_pct", "high_risk_incurred_pct"],
}


@query
def risk_summary_keywords(x: Inputs) -> DataFrame:
    return shown(risk.risk_summary(x.scored()), **_SUMMARY_PLACES, p6="avg_risk_score")


@query
def risk_summary_patterns(x: Inputs) -> DataFrame:
    summary = risk.risk_summary(x.pattern_flagged(), flag="high_risk_flag_sql", detail="indicator")
    return shown(summary, **_SUMMARY_PLACES, p6="avg_risk_indicator")


@query
def risk_summary_classified(x: Inputs) -> DataFrame:
    summary = risk.risk_summary(x.classified(), detail="classified")
    return shown(summary, **_SUMMARY_PLACES, p6="avg_risk_score")


@query
def emerging_risks(x: Inputs) -> DataFrame:
    flagged = risk.flag_emerging_risks(x.scored(), threshold=0.9, min_incurred=200_000.0)
    chosen = flagged.select("claim_id", "risk_score", "incurred_amount", "risk_priority")
    return shown(chosen, p6="risk_score", p4="incurred_amount")


@query
def risk_by_category(x: Inputs) -> DataFrame:
    return shown(risk.risk_by_category(x.scored()), p6="avg_severity", p4="total_exposure")


@query
def risk_entity_breakdown(x: Inputs) -> DataFrame:
    breakdown = risk.risk_entity_breakdown(x.classified(), AS_OF)
    return shown(breakdown, p4="total_exposure")


@query
def high_risk_detail(x: Inputs) -> DataFrame:
    detail = risk.high_risk_detail(x.classified(places=True), AS_OF).select(
        "claim_id", "loss_type", "claim_status", "state", "county", "incurred_amount",
        "risk_category", "risk_score", "claim_sentiment", "review_priority", "days_since_loss",
    )
    return shown(detail, p6="risk_score")


@query
def litigation_watch_list(x: Inputs) -> DataFrame:
    return risk.litigation_watch_list(x.classified()).select(
        "claim_id", "policy_id", "claimant_name", "loss_date", "loss_type", "incurred_amount",
        "claim_sentiment", "litigation_details", "attorney_details", "adjuster_notes",
    )


@query
def portfolio_findings(x: Inputs) -> DataFrame:
    return shown(
        risk.portfolio_findings(x.scored()), p4=["total_incurred", "high_risk_incurred"],
        p6=["high_risk_pct", "high_risk_incurred_pct"],
    )


# --- summaries and metric views --------------------------------------------------------------

_SUMMARY_MONEY = ["total_ibnr", "total_ultimate", "held_reserves", "reserve_margin"]


def _shown_summary(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    return shown(
        df, p4="total_paid", p2=[*_SUMMARY_MONEY, *(extra or [])],
        p6=["ai_adjustment_factor", "reserve_adequacy"],
    )


@query
def reserve_summary(x: Inputs) -> DataFrame:
    return _shown_summary(x.summary())


@query
def reserve_summary_held(x: Inputs) -> DataFrame:
    loaded = chainladder.load_for_risk(x.total_estimates(), x.loading())
    return _shown_summary(metrics.reserve_summary_held(loaded, AS_OF))


_VIEW_MONEY = ["estimated_ultimate_loss", "held_reserves", "total_ibnr", "reserve_margin"]


@query
def reserve_adequacy_view(x: Inputs) -> DataFrame:
    view = metrics.reserve_adequacy_view(x.segment_summary())
    return shown(view, p2=_VIEW_MONEY, p6=["reserve_adequacy", "ai_adjustment_factor"])


@query
def reserve_adequacy_recomputed(x: Inputs) -> DataFrame:
    view = metrics.reserve_adequacy_recomputed(x.segment_summary())
    return shown(view, p2=_VIEW_MONEY, p6="reserve_adequacy")


@query
def adequacy_of_held_reserves(x: Inputs) -> DataFrame:
    held = x.enriched().groupBy("loss_type").agg(F.sum("incurred_amount").alias("held_reserves"))
    adequacy = metrics.adequacy_of_held(x.estimates(), held)
    money = ["estimated_ultimate", "estimated_ibnr", "reserve_margin"]
    return shown(adequacy, p4="held_reserves", p2=money, p6="reserve_adequacy")




def _shown_origins(df: DataFrame, **places) -> DataFrame:
    return shown(df, p4="paid_to_date", p2=["projected_ultimate", "estimated_ibnr"], **places)


@query
def ibnr_by_origin(x: Inputs) -> DataFrame:
    return _shown_origins(metrics.ibnr_by_origin(x.estimates()))


@query
def risk_exposure(x: Inputs) -> DataFrame:
    exposure = metrics.risk_exposure(risk.risk_summary(x.classified(), detail="classified"))
    return shown(exposure, p4=["total_incurred", "high_risk_exposure"])


@query
def executive_dashboard(x: Inputs) -> DataFrame:
    return _shown_summary(metrics.executive_dashboard(x.summary()), ["risk_adjusted_ibnr"])


@query
def development_factor_view(x: Inputs) -> DataFrame:
    return metrics.development_factor_view(chainladder.development_factors(x.cells()))


@query
def claims_watchlist(x: Inputs) -> DataFrame:
    return joined_text(metrics.claims_watchlist(x.classified(places=True)), "risk_keywords")


@query
def loss_ratio(x: Inputs) -> DataFrame:
    """Premium is the order value of each origin year and loss type."""
    mapped = x.claims().join(
        x.table("orders").select(F.col("o_orderkey").alias("claim_id"), "o_totalprice"), "claim_id"
    )
    keys = [F.year("loss_date").alias("origin_period"), "loss_type"]
    premium = mapped.groupBy(*keys).agg(F.sum("o_totalprice").alias("earned_premium"))
    ratios = metrics.loss_ratio(x.enriched(), premium)
    return shown(ratios, p4=["incurred_loss", "earned_premium"], p6="loss_ratio")


@query
def summary_metrics(x: Inputs) -> DataFrame:
    return shown(metrics.summary_metrics(x.segment_summary()), p2="value")


@query
def metric_values(x: Inputs) -> DataFrame:
    """All metrics of the catalogue over the whole book, with unit and band."""
    once = x.once()
    summary = once.summary()
    totals = once.total_estimates().agg(
        F.sum("ultimate_loss").alias("ultimate_loss"), F.sum("latest_cumulative").alias("latest_cumulative")
    )
    steps = once.links().filter(F.col("link_ratio").isNotNull()).agg(
        F.sum("next_value").alias("next_value"), F.sum("cumulative_value").alias("cumulative_value")
    )
    losses = once.enriched().agg(F.sum("incurred_amount").alias("incurred_loss"))
    premium = x.table("orders").agg(F.sum("o_totalprice").cast("double").alias("earned_premium"))
    inputs = {
        "reserve_adequacy": summary, "reserve_margin": summary, "risk_adjusted_ibnr": summary,
        "ibnr": totals, "development_factor": steps, "high_risk_exposure": once.classified(),
        "loss_ratio": losses.crossJoin(premium),  # one row each
    }
    rows = [metrics.metric_value(name, row) for name, row in inputs.items()]
    return shown(reduce(DataFrame.unionByName, rows), p4="value")


@query
def reserve_alerts(x: Inputs) -> DataFrame:
    once = x.once()
    recomputed = metrics.reserve_adequacy_recomputed(once.segment_summary())
    raised = metrics.alerts(recomputed, risk.portfolio_findings(once.classified()))
    return shown(raised, p4="value")


# --- dashboards ------------------------------------------------------------------------------


@query
def kpi_counters(x: Inputs) -> DataFrame:
    counters = dashboards.kpi_counters(x.summary())
    return shown(
        counters, p2=["total_ibnr", "total_ultimate"],
        p6=["reserve_adequacy", "ai_adjustment_factor"],
    )


@query
def executive_summary(x: Inputs) -> DataFrame:
    return dashboards.executive_summary(x.summary())


@query
def adequacy_by_loss_type(x: Inputs) -> DataFrame:
    view = metrics.reserve_adequacy_recomputed(x.segment_summary())
    shares = dashboards.adequacy_by_loss_type(view)
    return shown(shares, p2=["estimated_ultimate_loss", "held_reserves", "reserve_margin"])


@query
def origin_development(x: Inputs) -> DataFrame:
    view = metrics.ibnr_by_origin(x.estimates(), places=None)
    return _shown_origins(dashboards.origin_development(view), p1="percent_remaining")


@query
def factor_trend(x: Inputs) -> DataFrame:
    return dashboards.factor_trend(chainladder.development_factors(x.cells()))


@query
def heatmap_cells(x: Inputs) -> DataFrame:
    return shown(dashboards.heatmap_cells(x.cells(())), p4="cumulative_value")


@query
def claims_by_risk_category(x: Inputs) -> DataFrame:
    return shown(dashboards.claims_by_risk_category(x.scored()), p4="total_exposure")


@query
def high_risk_trend(x: Inputs) -> DataFrame:
    exposure = metrics.risk_exposure(risk.risk_summary(x.classified(), detail="classified"))
    return shown(dashboards.high_risk_trend(exposure), p4="high_risk_exposure")


@query
def risk_score_histogram(x: Inputs) -> DataFrame:
    return shown(dashboards.risk_score_histogram(x.scored()), p4="total_exposure")


@query
def top_high_risk_claims(x: Inputs) -> DataFrame:
    return dashboards.top_high_risk_claims(x.scored(places=True))


@query
def keyword_frequency(x: Inputs) -> DataFrame:
    return dashboards.keyword_frequency(x.scored())


@query
def claims_by_status(x: Inputs) -> DataFrame:
    return shown(dashboards.claims_by_status(x.enriched()), p4="total_incurred")


@query
def claims_by_loss_type(x: Inputs) -> DataFrame:
    return shown(
        dashboards.claims_by_loss_type(x.enriched()), p4="total_incurred", p2="avg_incurred"
    )


@query
def claims_by_place(x: Inputs) -> DataFrame:
    return shown(dashboards.claims_by_place(x.scored(places=True)), p4="total_incurred")


@query
def open_claims_by_age(x: Inputs) -> DataFrame:
    return shown(dashboards.open_claims_by_age(x.enriched(), AS_OF), p4="total_incurred")


@query
def claims_by_catastrophe(x: Inputs) -> DataFrame:
    return shown(
        dashboards.claims_by_catastrophe(x.scored()), p4=["total_incurred", "high_risk_incurred"]
    )


@query
def claim_size_trend(x: Inputs) -> DataFrame:
    trend = dashboards.claim_size_trend(x.enriched())
    return shown(trend, p2="avg_incurred", p4="max_incurred", p6="median_incurred")


@query
def boardroom(x: Inputs) -> DataFrame:
    return dashboards.boardroom(x.summary(), risk.portfolio_findings(x.scored()))


@query
def expectation_scatter(x: Inputs) -> DataFrame:
    scatter = dashboards.expectation_scatter(analytics.actual_vs_expected(x.cells()))
    return shown(scatter, p4="actual_value", p2="expected_value", p6="pct_deviation")


@query
def factor_ranges(x: Inputs) -> DataFrame:
    ranges = dashboards.factor_ranges(analytics.ata_diagnostics(chainladder.ata_factors(x.links())))
    return shown(ranges, p6=["selected_ata", "simple_average", "ata_min", "ata_max"])


@query
def calendar_years_recent(x: Inputs) -> DataFrame:
    calendar = triangle.calendar_year_development(x.cells(()))
    return dashboards.calendar_years_from(calendar, first_year=1997)


@query
def exhibit_text(x: Inputs) -> DataFrame:
    return dashboards.exhibit_text(analytics.development_exhibit(x.links()))


@query
def segment_exposure(x: Inputs) -> DataFrame:
    exposure = dashboards.segment_exposure(
        x.scored(places=True), "Water Damage", "NATION_7", 24, AS_OF
    )
    return shown(exposure, p4=["total_exposure", "high_risk_exposure"], p6="avg_risk_score")


@query
def county_high_risk_claims(x: Inputs) -> DataFrame:
    chosen = dashboards.county_high_risk(x.scored(places=True), "NATION_3").select(
        "claim_id", "loss_date", "loss_type", "county", "adjuster_notes", "risk_category",
        "risk_score", "incurred_amount",
    )
    return shown(chosen, p6="risk_score")


@query
def high_risk_ranking(x: Inputs) -> DataFrame:
    exposure = metrics.risk_exposure(risk.risk_summary(x.classified(), detail="classified"))
    return exposure.select(
        "origin_year", "loss_type", "total_claims", "high_risk_claims", "high_risk_percentage"
    ).orderBy(F.desc("high_risk_percentage"), "origin_year", "loss_type")


@query
def total_ibnr(x: Inputs) -> DataFrame:
    return shown(x.summary().agg(F.sum("total_ibnr").alias("total_ibnr")), p2="total_ibnr")


@query
def segment_reserve_totals(x: Inputs) -> DataFrame:
    totals = dashboards.segment_reserve_totals(chainladder.with_grand_total(x.estimates()))
    return shown(
        totals, p4="total_paid", p2=["total_ibnr", "total_ultimate"], p6="avg_percent_developed"
    )


@query
def consistency_check(x: Inputs) -> DataFrame:
    checked = dashboards.consistency_check(chainladder.with_grand_total(x.estimates()))
    return shown(checked, p2=["all_ibnr", "parts_ibnr", "difference"])


@query
def raw_counts(x: Inputs) -> DataFrame:
    by_loss = x.claims().groupBy(F.lit("loss_type").alias("kind"), F.col("loss_type").alias("value"))
    by_type = x.payments().groupBy(
        F.lit("payment_type").alias("kind"), F.col("payment_type").alias("value")
    )
    count = F.count(F.lit(1)).alias("row_count")
    return by_loss.agg(count).unionByName(by_type.agg(count))


@query
def county_ranking(x: Inputs) -> DataFrame:
    ranked = dashboards.place_ranking(x.scored(places=True), "county")
    return shown(ranked, p4=["total_exposure", "high_risk_exposure"])


@query
def state_ranking(x: Inputs) -> DataFrame:
    ranked = dashboards.place_ranking(x.scored(places=True), "state")
    return shown(ranked, p4=["total_exposure", "high_risk_exposure"])


@query
def segment_origin_estimate(x: Inputs) -> DataFrame:
    chosen = x.estimates().filter(
        (F.col("loss_type") == "Water Damage") & (F.col("origin_period") == 1998)
    )
    view = metrics.ibnr_by_origin(chosen)
    return _shown_origins(view)


@query
def mold_claims(x: Inputs) -> DataFrame:
    return dashboards.mold_claims(x.scored()).select("claim_id", "risk_category", "incurred_amount")


@query
def litigation_claims(x: Inputs) -> DataFrame:
    return dashboards.litigation_claims(x.scored()).select(
        "claim_id", "risk_category", "incurred_amount"
    )


@query
def deficient_loss_types(x: Inputs) -> DataFrame:
    view = metrics.reserve_adequacy_recomputed(x.segment_summary())
    chosen = dashboards.deficient_loss_types(view).select(
        "loss_type", "reserve_adequacy", "adequacy_status"
    )
    return shown(chosen, p6="reserve_adequacy")


# --- data quality ----------------------------------------------------------------------------


@query
def null_check(x: Inputs) -> DataFrame:
    columns = ["claim_id", "adjuster_notes", "loss_description", "catastrophe_code", "loss_date"]
    return shown(quality.check_nulls(x.claims(), columns, threshold=0.25), p6="null_pct")


@query
def duplicate_check(x: Inputs) -> DataFrame:
    report = quality.check_duplicates(x.table("lineitem"), ["l_orderkey", "l_linenumber"])
    return shown(report, p6="duplicate_pct")


@query
def value_range_check(x: Inputs) -> DataFrame:
    report = quality.check_value_range(x.payments(), "payment_amount", 1000.0, 90_000.0)
    return shown(report, p4=["actual_min", "actual_max"])


@query
def domain_check(x: Inputs) -> DataFrame:
    allowed = {"loss_type": LOSS_TYPES[1:], "claim_status": CLAIM_STATUSES}
    required = [*REQUIRED_CLAIM_COLUMNS, "catastrophe_code"]
    return quality.check_domain(x.claims(), required, allowed)


@query
def orphan_payments(x: Inputs) -> DataFrame:
    """Payments of claims that were closed before the valuation date are orphans of the open book."""
    open_claims = x.claims().filter(F.col("claim_status") != "Closed")
    folded = x.payments().groupBy("claim_id", "payment_type").agg(F.count(F.lit(1)).alias("n"))
    orphans = quality.orphan_payments(folded, open_claims)
    return orphans.groupBy("payment_type").agg(
        F.sum("n").alias("payments"), F.count(F.lit(1)).alias("claims")
    )


@query
def quality_summary(x: Inputs) -> DataFrame:
    columns = ["claim_id", "adjuster_notes", "loss_date"]
    return quality.quality_summary(
        {
            "nulls": quality.check_nulls(x.claims(), columns),
            "duplicates": quality.check_duplicates(x.payments(), ["payment_id"]),
            "range": quality.check_value_range(x.payments(), "payment_amount", 0.0),
        }
    )


@query
def conformed_estimates(x: Inputs) -> DataFrame:
    labelled = x.estimates().withColumns(
        {"triangle_type": F.lit("paid"), "segment": F.lit(None).cast("string"), "tail_factor": F.lit(1.0)}
    )
    table = conform(labelled, "reserve_estimates").drop("segment")
    return shown_estimates(table, p2=ESTIMATE_MONEY, p6="percent_reported")


# --- files and streams -----------------------------------------------------------------------


def _raw_claims(x: Inputs) -> DataFrame:
    timed = x.claims().withColumns(
        {
            "created_at": F.col("report_date").cast("timestamp"),
            "updated_at": F.col("report_date").cast("timestamp"),
        }
    )
    return conform(timed, "claims")


def _raw_payments(x: Inputs) -> DataFrame:
    """Payments in the raw layout; payments without a reserve are refunds (negative amounts)."""
    amount = F.round("payment_amount", 4)
    signed = F.when(F.col("reserve_amount") == 0, -amount).otherwise(amount)
    timed = x.payments().withColumns(
        {
            "payment_amount": signed,
            "reserve_amount": F.round("reserve_amount", 4),
            "created_at": F.col("payment_date").cast("timestamp"),
        }
    )
    return conform(timed, "payments")


def _drop_files(df: DataFrame, folder: str, file_format: str = "csv") -> None:
    df.write.format(file_format).option("header", "true").mode("append").save(folder)


_PAYMENT_OUT = ["payment_id", "claim_id", "payment_date", "payment_type", "payment_amount",
                "reserve_amount", "payment_status"]


@query
def claims_batch_ingest(x: Inputs) -> DataFrame:
    folder = fresh_path(x.spark, "claims-csv")
    _drop_files(_raw_claims(x), folder)
    return files.ingest_claims_batch(x.spark, folder).select(
        "claim_id", "policy_id", "loss_date", "report_date", "loss_type", "loss_description",
        "adjuster_notes", "claim_status", "catastrophe_code",
        F.to_date("created_at").alias("created_on"), "_ingestion_type",
    )


@query
def payments_batch_ingest(x: Inputs) -> DataFrame:
    folder = fresh_path(x.spark, "payments-json")
    _drop_files(_raw_payments(x), folder, "json")
    return files.ingest_payments_batch(x.spark, folder, "json").select(*_PAYMENT_OUT)


@query
def payments_quarantine(x: Inputs) -> DataFrame:
    broken = files.quarantine(_raw_payments(x), files.expectations("payments"))
    return joined_text(broken, "violated").groupBy("violated", "payment_type").agg(
        F.count(F.lit(1)).alias("payments")
    )


@query
def claims_stream_ingest(x: Inputs) -> DataFrame:
    source, target = fresh_path(x.spark, "stream-in"), fresh_path(x.spark, "stream-out")
    _drop_files(_raw_claims(x), source)
    ingest.ingest_streaming(x.spark, "claims", source, target, fresh_path(x.spark, "state"))
    return x.spark.read.parquet(target).select(
        "claim_id", "policy_id", "loss_date", "loss_type", "adjuster_notes", "claim_status",
        "_ingestion_type",
    )


def _two_drops(x: Inputs, after_drop) -> None:
    """Deliver cleared payments first and pending ones later, running ``after_drop`` after each."""
    source = fresh_path(x.spark, "stream-in")
    raw = _raw_payments(x)
    for status in ("Cleared", "Pending"):
        _drop_files(raw.filter(F.col("payment_status") == status), source, "parquet")
        after_drop(source)


@query
def payments_stream_ingest(x: Inputs) -> DataFrame:
    target, state = fresh_path(x.spark, "stream-out"), fresh_path(x.spark, "state")

    def run(source: str) -> None:
        ingest.ingest_streaming(x.spark, "payments", source, target, state, "parquet")

    _two_drops(x, run)
    return x.spark.read.parquet(target).select(*_PAYMENT_OUT)


@query
def streamed_cells(x: Inputs) -> DataFrame:
    target, state = fresh_path(x.spark, "increments"), fresh_path(x.spark, "state")
    claims_by_text_id = x.claims().withColumn("claim_id", F.col("claim_id").cast("string"))

    def run(source: str) -> None:
        stream = ingest.valid_stream(x.spark, "payments", source, "parquet")
        stream_cells.maintain_cells(stream, target, state).awaitTermination()

    _two_drops(x, run)
    cells = stream_cells.current_cells(x.spark, target, claims_by_text_id, scale=SCALE)
    return shown(cells, p4=["incremental_value", "cumulative_value"])


def _judged_payments(x: Inputs) -> str:
    """The folder into which two drops of payments were judged, one batch each."""
    target, state = fresh_path(x.spark, "judged"), fresh_path(x.spark, "state")

    def run(source: str) -> None:
        stream_expectations.ingest_judged(x.spark, "payments", source, target, state, "parquet")

    _two_drops(x, run)
    return target


@query
def stream_quarantine(x: Inputs) -> DataFrame:
    """The payments a stream has quarantined, by batch, with the rules they violate."""
    rows = stream_expectations.quarantined(x.spark, _judged_payments(x))
    return joined_text(rows, "violated").select("batch", "violated", *_PAYMENT_OUT)


@query
def stream_expectation_counts(x: Inputs) -> DataFrame:
    """Rows read, accepted and quarantined of every batch of the payment stream."""
    return stream_expectations.batch_counts(x.spark, _judged_payments(x))


def _sent_twice(x: Inputs) -> KeyedTable:
    """Claims in two batches: all of them, then all again a day later with open ones closed and some withdrawn."""
    table = KeyedTable(x.spark, fresh_path(x.spark, "claim-versions"), "claim_id", contract("claims"))
    first = _raw_claims(x)
    later = first.withColumns(
        {
            "claim_status": F.when(F.col("claim_status") == "Open", "Closed").otherwise(F.col("claim_status")),
            "updated_at": F.col("updated_at") + F.expr("INTERVAL 1 DAY"),
        }
    )
    table.append(first, 0)
    table.append(later, 1, F.col("claim_id").cast("long") % 50 == 0)
    # The first versions come once more, late: they are older than what is known.
    table.append(first, 2)
    return table


@query
def claim_versions(x: Inputs) -> DataFrame:
    """The newest version of every claim that was not withdrawn."""
    return _sent_twice(x).current().select("claim_id", "loss_type", "claim_status", "loss_date", F.to_date("updated_at").alias("updated_on"))


@query
def versioned_cells(x: Inputs) -> DataFrame:
    """Cells of payments joined with the newest versions of their claims, after a compaction."""
    table = _sent_twice(x)
    table.compact()
    table.vacuum()
    payments = x.payments().withColumn("claim_id", F.col("claim_id").cast("string"))
    cells = triangle.paid_cells(payments, table.current(), ["loss_type"], scale=SCALE)
    return shown(cells, p4=["incremental_value", "cumulative_value"])


@query
def maintained_cells(x: Inputs) -> DataFrame:
    """Cells kept current by two streams: payments before their claims, late payments, claims that change."""
    store = TriangleStore(x.spark, fresh_path(x.spark, "store"), scale=SCALE)
    claims_in, payment_state, claim_state = (fresh_path(x.spark, n) for n in ("claims-in", "state", "state"))
    raw = _raw_claims(x)
    # A third of the claims first comes as a theft of an earlier year.
    wrong = raw.withColumns({"loss_type": F.lit("Theft"), "loss_date": F.add_months("loss_date", -24)})
    key = F.col("claim_id").cast("long") % 3
    later = raw.withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 DAY"))
    drops = iter([wrong.filter(key == 0).unionByName(raw.filter(key == 1)), later.filter(key != 1)])

    def run(source: str) -> None:
        payments = ingest.valid_stream(x.spark, "payments", source, "parquet")
        store.keep_payments(payments, payment_state).awaitTermination()
        _drop_files(next(drops), claims_in, "parquet")
        claims = ingest.valid_stream(x.spark, "claims", claims_in, "parquet")
        store.keep_claims(claims, claim_state).awaitTermination()

    _two_drops(x, run)
    return shown(store.cells(), p4=["incremental_value", "cumulative_value"])


@query
def evolved_payments(x: Inputs) -> DataFrame:
    """Cleared payments, then pending ones that come with a wider and an added column, in one table."""
    folder = fresh_path(x.spark, "evolved")
    raw = _raw_payments(x).withColumn("paid_month", F.month("payment_date"))
    first = ["payment_id", "claim_id", "payment_type", "payment_amount", "paid_month"]
    evolution.append(raw.filter(F.col("payment_status") == "Cleared").select(*first), folder, ["payment_type"])
    wide = raw.withColumn("paid_month", F.col("paid_month").cast("long")).select(*first, "payment_status")
    evolution.append(wide.filter(F.col("payment_status") == "Pending"), folder, ["payment_type"])
    return evolution.read(x.spark, folder)


@query
def triangle_store_partition(x: Inputs) -> DataFrame:
    """Write the triangle partitioned by type and loss type, then read one partition back."""
    folder = fresh_path(x.spark, "triangles")
    cells = triangle.label_cells(x.cells(), as_of=AS_OF)
    files.write_table(cells, folder, "overwrite", ["triangle_type", "loss_type"])
    stored = x.spark.read.parquet(folder).filter(
        (F.col("triangle_type") == "paid") & (F.col("loss_type") == "Fire")
    )
    return shown(stored, p4=["incremental_value", "cumulative_value"])


@query
def derived_tables(x: Inputs) -> DataFrame:
    """The full table build: one row per derived table with its number of rows."""
    built = tables.build_tables(x.claims(places=True), x.payments(), AS_OF, scale=SCALE)
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in built.items()
    ]
    return reduce(DataFrame.unionByName, counts)
