"""Chain Ladder: development factors, ultimates and IBNR for every segment at once.

The single-step operators (link ratios, factors, diagonal, projection) can be combined freely.
:func:`age_profile` is the fused form: it annotates the cells with everything the projection
needs through window functions, so the estimates of all segments come from *one* pass over the
cells. There is no self-join and no join with a factor table, hence the payments behind lazy cells
are scanned once. Windows run over cells, whose number is segments × origins × ages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio

SEGMENT = ("loss_type",)


def _origins(by: Sequence[str]):
    return Window.partitionBy(*by, "origin_period").orderBy("development_period")


def _ages(by: Sequence[str]):
    return Window.partitionBy(*by, "development_period")


def _from_here_on(by: Sequence[str]):
    """All cells of the segment at this age or later."""
    return (
        Window.partitionBy(*by)
        .orderBy(F.desc("development_period"))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )


# --- link ratios and factors -----------------------------------------------------------------


def link_ratios(cells: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Each cell with the value one age later and their ratio (NULL when either is missing).

    ``lead`` is accepted only if it is exactly the next age, which gives the result of a left
    self-join on age + 1 without reading the cells twice.
    """
    frame = _origins(by)
    current = F.col("cumulative_value")
    next_age = F.lead("development_period").over(frame)
    follower = F.when(
        next_age == F.col("development_period") + 1, F.lead("cumulative_value").over(frame)
    )
    return (
        cells.filter(current.isNotNull())
        .withColumn("next_value", follower)
        .withColumn("link_ratio", F.when(current > 0, F.try_divide("next_value", current)))
    )


def ata_factors(links: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Volume-weighted age-to-age factors with the spread of the individual ratios."""
    return (
        links.filter(F.col("link_ratio").isNotNull())
        .groupBy(*by, "development_period")
        .agg(
            ratio(F.sum("next_value"), F.sum("cumulative_value")).alias("ata_factor"),
            F.avg("link_ratio").alias("ata_simple_avg"),
            F.count(F.lit(1)).alias("n_observations"),
            F.min("link_ratio").alias("ata_min"),
            F.max("link_ratio").alias("ata_max"),
            F.stddev_samp("link_ratio").alias("ata_stddev"),
        )
    )


def add_cdf(factors: DataFrame, by: Sequence[str] = SEGMENT, tail: float = 1.0) -> DataFrame:
    """Cumulative factor to ultimate: product of this and all later factors, times the tail."""
    product = F.product(F.coalesce("ata_factor", F.lit(1.0))).over(_from_here_on(by))
    with_cdf = factors.withColumn("cdf_to_ultimate", product * F.lit(tail))
    developed = F.round(ratio(F.lit(1.0), F.col("cdf_to_ultimate")) * 100, 2)
    return with_cdf.withColumn("percent_developed", developed)


def cdf_factors(
    links: DataFrame, by: Sequence[str] = SEGMENT, tail: float = 1.0, terminal: bool = True
) -> DataFrame:
    """ATA and CDF per age.

    With ``terminal=True`` every age of the segment has a row: ages without a usable pair get a
    factor of 1 and the last age's CDF is the tail. With ``False`` only ages that have a factor
    are listed, which is how the published factor table looks.
    """
    if not terminal:
        return add_cdf(ata_factors(links, by).select(*by, "development_period", "ata_factor"), by, tail)
    usable = F.col("link_ratio").isNotNull()
    per_age = links.groupBy(*by, "development_period").agg(
        F.coalesce(
            ratio(
                F.sum(F.when(usable, F.col("next_value"))),
                F.sum(F.when(usable, F.col("cumulative_value"))),
            ),
            F.lit(1.0),
        ).alias("ata_factor")
    )
    return add_cdf(per_age, by, tail)


# --- diagonal, ultimate, IBNR ----------------------------------------------------------------


def latest_diagonal(cells: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Value and age of the last observed cell of each origin (0 when nothing was observed)."""
    observed = F.when(F.col("cumulative_value").isNotNull(), F.col("development_period"))
    return cells.groupBy(*by, "origin_period").agg(
        F.coalesce(F.max_by("cumulative_value", observed), F.lit(0.0)).alias("latest_cumulative"),
        F.max(observed).alias("latest_age"),
        F.count(observed).alias("development_age"),
    )


def _ibnr(ultimate: Column, latest: Column, floor: bool) -> Column:
    gap = ultimate - latest
    return F.greatest(gap, F.lit(0.0)) if floor else gap


def _reported(latest: Column, ultimate: Column) -> Column:
    return F.when(ultimate > 0, F.try_divide(latest, ultimate)).otherwise(F.lit(1.0))


def add_reserve_columns(df: DataFrame, cdf: str = "cdf_to_ultimate", floor: bool = True) -> DataFrame:
    """``ultimate_loss``, ``ibnr`` and ``percent_reported`` from a latest value and its CDF."""
    latest = F.col("latest_cumulative")
    ultimate = F.col("ultimate_loss")
    projected = df.withColumn("ultimate_loss", latest * F.col(cdf))
    return projected.withColumns(
        {
            "ibnr": _ibnr(ultimate, latest, floor),
            "percent_reported": _reported(latest, ultimate),
        }
    )


def project_ultimate(
    diagonal: DataFrame, factors: DataFrame, by: Sequence[str] = SEGMENT, floor: bool = True
) -> DataFrame:
    """Latest value × CDF at its age. ``factors`` has one row per segment and age.

    No broadcast hint: the factor table is an aggregate whose size Spark knows at run time.
    """
    keyed = factors.select(*by, F.col("development_period").alias("latest_age"), "cdf_to_ultimate")
    joined = diagonal.join(keyed, [*by, "latest_age"], "left")
    return add_reserve_columns(joined, floor=floor)


# --- fused form ------------------------------------------------------------------------------


def age_profile(cells: DataFrame, by: Sequence[str] = SEGMENT, tail: float = 1.0) -> DataFrame:
    """Cells annotated with the factors of their age.

    Added columns: ``next_value``, ``link_ratio``; per age ``ata_factor``, ``n_observations``,
    ``column_total``, ``sigma2``; ``cdf_to_ultimate``; the suffix sums ``process_term`` (of
    sigma²/f²) and ``parameter_term`` (of sigma²/(f²·column total)) that the standard error needs;
    ``leads_age`` (exactly one cell per age) and ``is_latest`` (last cell of the origin).
    """
    ages = _ages(by)
    value = F.col("cumulative_value")
    usable = F.col("link_ratio").isNotNull()
    last_age = F.max("development_period").over(Window.partitionBy(*by, "origin_period"))
    paired = (
        link_ratios(cells, by)
        .withColumn("is_latest", F.col("development_period") == last_age)
        .withColumns(
            {
                "ata_factor": ratio(
                    F.sum(F.when(usable, F.col("next_value"))).over(ages),
                    F.sum(F.when(usable, value)).over(ages),
                ),
                "n_observations": F.count("link_ratio").over(ages),
                "column_total": F.sum(value).over(ages),
                "leads_age": F.row_number().over(ages.orderBy("origin_period")) == 1,
            }
        )
    )
    deviation = F.col("link_ratio") - F.col("ata_factor")
    spread = F.sum(F.when(usable, value * deviation * deviation)).over(ages)
    with_sigma = paired.withColumn(
        "sigma2",
        F.when(F.col("n_observations") > 1, spread / (F.col("n_observations") - 1)).otherwise(
            F.lit(0.0)
        ),
    )
    # One contribution per age: the cell that leads the age carries it, all others are neutral.
    later = _from_here_on(by)
    leads = F.col("leads_age")
    factor = F.coalesce("ata_factor", F.lit(1.0))
    term = F.col("sigma2") / (factor * factor)
    counted = leads & (factor > 0) & (F.col("column_total") > 0)
    return with_sigma.withColumns(
        {
            "cdf_to_ultimate": F.product(F.when(leads, factor).otherwise(F.lit(1.0))).over(later)
            * F.lit(tail),
            "process_term": F.sum(F.when(counted, term).otherwise(F.lit(0.0))).over(later),
            "parameter_term": F.sum(
                F.when(counted, term / F.col("column_total")).otherwise(F.lit(0.0))
            ).over(later),
        }
    )


def reserve_estimates(
    cells: DataFrame, by: Sequence[str] = SEGMENT, tail: float = 1.0, floor: bool = True
) -> DataFrame:
    """Latest value, ultimate, IBNR and reported share per origin, for all segments in one plan.

    A segment seen at a single age has no pair to develop from: its ultimate is its latest value.
    """
    return _estimates(age_profile(cells, by, tail), by, floor)


def _estimates(profile: DataFrame, by: Sequence[str], floor: bool, extra: Sequence[str] = ()) -> DataFrame:
    only_age = (
        F.min("development_period").over(Window.partitionBy(*by))
        == F.max("development_period").over(Window.partitionBy(*by))
    )
    flat = F.when(F.col("only_age"), F.lit(1.0)).otherwise(F.col("cdf_to_ultimate"))
    diagonal = (
        profile.withColumn("only_age", only_age)
        .filter("is_latest")
        .select(
            *by,
            "origin_period",
            F.col("development_period").alias("latest_age"),
            F.col("cumulative_value").alias("latest_cumulative"),
            flat.alias("cdf_to_ultimate"),
            *extra,
        )
    )
    return add_reserve_columns(diagonal, floor=floor)


def with_grand_total(estimates: DataFrame, by: str = "loss_type", label: str = "ALL") -> DataFrame:
    """Add the per-origin sum over all segments as a segment of its own.

    Grouping sets feed detail and total rows from the same input in one shuffle.
    """
    summed = estimates.groupingSets(
        [[F.col("origin_period"), F.col(by)], [F.col("origin_period")]],
        F.col("origin_period"),
        F.col(by),
    ).agg(
        F.grouping(by).alias("is_total"),
        F.sum("latest_cumulative").alias("latest_cumulative"),
        F.sum("ultimate_loss").alias("ultimate_loss"),
        F.sum("ibnr").alias("ibnr"),
    )
    name = F.when(F.col("is_total") == 1, F.lit(label)).otherwise(F.col(by))
    return summed.select(
        name.alias(by),
        "origin_period",
        "latest_cumulative",
        "ultimate_loss",
        "ibnr",
        _reported(F.col("latest_cumulative"), F.col("ultimate_loss")).alias("percent_reported"),
    )


def development_factors(
    cells: DataFrame, by: Sequence[str] = SEGMENT, tail: float = 1.0
) -> DataFrame:
    """ATA, CDF and percent developed per age, for every age that has a later one."""
    profile = age_profile(cells, by, tail)
    last = F.max("development_period").over(Window.partitionBy(*by))
    cdf = F.col("cdf_to_ultimate")
    return (
        profile.withColumn("last_age", last)
        .filter(F.col("leads_age") & (F.col("development_period") < F.col("last_age")))
        .select(
            *by,
            "development_period",
            F.coalesce("ata_factor", F.lit(1.0)).alias("ata_factor"),
            "cdf_to_ultimate",
            F.when(cdf > 0, F.try_divide(F.lit(100.0), cdf))
            .otherwise(F.lit(100.0))
            .alias("percent_developed"),
        )
    )


# --- uncertainty -----------------------------------------------------------------------------


def mack_sigma2(cells: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Variance parameter per age: weighted squared deviations from the factor over n − 1."""
    last = F.max("development_period").over(Window.partitionBy(*by))
    return (
        age_profile(cells, by)
        .withColumn("last_age", last)
        .filter(F.col("leads_age") & (F.col("development_period") < F.col("last_age")))
        .select(*by, "development_period", "ata_factor", "n_observations", "sigma2")
    )


def mack_estimates(
    cells: DataFrame, by: Sequence[str] = SEGMENT, tail: float = 1.0, floor: bool = True
) -> DataFrame:
    """Estimates with a simplified standard error and coefficient of variation.

    The error of an origin is its ultimate times the square root of
    ``process_term / latest + parameter_term`` at its age; a latest value of 0 gives NULL.
    """
    observed = F.count(F.lit(1)).over(Window.partitionBy(*by, "origin_period"))
    profile = age_profile(cells, by, tail).withColumn("development_age", observed)
    extra = ["development_age", "process_term", "parameter_term"]
    estimates = _estimates(profile, by, floor, extra)
    variance = F.try_divide("process_term", "latest_cumulative") + F.col("parameter_term")
    with_error = estimates.withColumn(
        "se_ibnr", F.col("ultimate_loss") * F.sqrt(F.greatest(variance, F.lit(0.0)))
    )
    # greatest() skips NULLs, so an undefined variance is put back explicitly.
    with_error = with_error.withColumn("se_ibnr", F.when(variance.isNotNull(), F.col("se_ibnr")))
    cv = F.when(F.col("ibnr") > 0, F.try_divide("se_ibnr", "ibnr")).otherwise(F.lit(0.0))
    return with_error.withColumn("cv", cv).drop("process_term", "parameter_term")


def mack_1993(cells: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Standard error with the projected values in the process term (Mack, 1993).

    For each origin the sum over later ages j of sigma²_j/f_j² · (1/C_ij + 1/S_j), where C_ij is
    the value projected to age j and S_j the sum of the values the factor was estimated from.
    Since C_ij = latest · F_age/F_j, the sum splits into suffix sums of sigma²_j/f_j²·F_j and
    sigma²_j/(f_j²·S_j), so no origin × age expansion is needed.
    """
    profile = age_profile(cells, by)
    used = F.sum(F.when(F.col("link_ratio").isNotNull(), F.col("cumulative_value"))).over(_ages(by))
    factor = F.coalesce("ata_factor", F.lit(1.0))
    term = F.when(F.col("leads_age"), F.col("sigma2") / (factor * factor)).otherwise(F.lit(0.0))
    later = _from_here_on(by)
    summed = profile.withColumn("used_total", used).withColumns(
        {
            "projected_term": F.sum(term * F.col("cdf_to_ultimate")).over(later),
            "estimate_term": F.sum(
                F.coalesce(F.try_divide(term, F.col("used_total")), F.lit(0.0))
            ).over(later),
        }
    )
    estimates = _estimates(summed, by, False, ["projected_term", "estimate_term"])
    process = F.try_divide(
        F.col("projected_term"), F.col("latest_cumulative") * F.col("cdf_to_ultimate")
    )
    error = F.col("ultimate_loss") * F.sqrt(process + F.col("estimate_term"))
    return estimates.withColumn("se_ibnr", error).drop("projected_term", "estimate_term")


def reserve_totals(estimates: DataFrame, by: Sequence[str] = SEGMENT, z: float = 1.96) -> DataFrame:
    """Totals per segment with the total standard error and the confidence interval of the IBNR."""
    totals = estimates.groupBy(*by).agg(
        F.sum("latest_cumulative").alias("total_paid"),
        F.sum("ultimate_loss").alias("total_ultimate"),
        F.sum("ibnr").alias("total_ibnr"),
        F.sqrt(F.sum(F.col("se_ibnr") * F.col("se_ibnr"))).alias("total_se"),
    )
    half_width = F.lit(z) * F.col("total_se")
    return totals.withColumns(
        {
            "ibnr_lower_95": F.greatest(F.col("total_ibnr") - half_width, F.lit(0.0)),
            "ibnr_upper_95": F.col("total_ibnr") + half_width,
        }
    )


# --- applications ----------------------------------------------------------------------------


def predict_development(
    positions: DataFrame, factors: DataFrame, by: Sequence[str] = SEGMENT
) -> DataFrame:
    """Project a table of (origin_period, current_value, current_age).

    ``factors`` is :func:`cdf_factors` with its terminal row. An age outside the table gives NULL
    projections and ``valid_age = false``.
    """
    keyed = factors.select(*by, F.col("development_period").alias("current_age"), "cdf_to_ultimate")
    joined = positions.join(keyed, [*by, "current_age"], "left")
    value = F.col("current_value")
    ultimate = F.col("projected_ultimate")
    reported = F.when(ultimate.isNotNull(), _reported(value, ultimate))
    return joined.withColumn("projected_ultimate", value * F.col("cdf_to_ultimate")).withColumns(
        {
            "projected_ibnr": ultimate - value,
            "percent_reported": reported,
            "valid_age": F.col("cdf_to_ultimate").isNotNull(),
        }
    )


def compare_risk_segments(
    cells: DataFrame, flag: str = "risk_segment", tail: float = 1.0
) -> DataFrame:
    """Two fits side by side: all claims and high-risk claims only.

    ``cells`` carries ``flag`` with the values ``all`` and ``high_risk``; both are fitted by the
    same plan and pivoted into one row.
    """
    totals = (
        reserve_estimates(cells, [flag], tail, floor=False)
        .groupBy(flag)
        .agg(F.sum("ibnr").alias("ibnr"), F.sum("ultimate_loss").alias("ultimate"))
    )

    def of(segment: str, column: str) -> Column:
        return F.max(F.when(F.col(flag) == segment, F.col(column)))

    paired = totals.agg(
        of("all", "ibnr").alias("standard_ibnr"),
        of("all", "ultimate").alias("standard_ultimate"),
        of("high_risk", "ibnr").alias("adjusted_ibnr"),
        of("high_risk", "ultimate").alias("adjusted_ultimate"),
    )
    standard, adjusted = F.col("standard_ibnr"), F.col("adjusted_ibnr")
    growth = (F.try_divide(adjusted, standard) - 1) * 100
    return paired.withColumns(
        {
            "ibnr_increase": adjusted - standard,
            "ibnr_increase_pct": F.when(standard > 0, growth).otherwise(F.lit(0.0)),
        }
    )


def risk_loading_factor(risk_summary: DataFrame, weight: float = 0.5) -> DataFrame:
    """One row: 1 + weight × (high-risk incurred / total incurred)."""
    totals = risk_summary.agg(
        F.coalesce(F.sum("high_risk_incurred"), F.lit(0.0)).alias("high_risk"),
        F.coalesce(F.sum("total_incurred"), F.lit(0.0)).alias("incurred"),
    )
    share = F.when(F.col("incurred") > 0, F.try_divide("high_risk", "incurred")).otherwise(0.0)
    return totals.select((F.lit(1.0) + share * F.lit(weight)).alias("ai_adjustment_factor"))


def load_for_risk(estimates: DataFrame, loading: DataFrame) -> DataFrame:
    """Apply a one-row loading to every estimate."""
    loaded = estimates.crossJoin(loading)
    adjusted_ultimate = F.col("ultimate_loss") * F.col("ai_adjustment_factor")
    return loaded.withColumn("ai_adjusted_ultimate", adjusted_ultimate).withColumns(
        {
            "ai_adjusted_ibnr": F.col("ai_adjusted_ultimate") - F.col("latest_cumulative"),
            "ibnr_difference": F.col("ai_adjusted_ultimate")
            - F.col("latest_cumulative")
            - F.col("ibnr"),
        }
    )
