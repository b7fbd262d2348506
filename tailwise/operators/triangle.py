"""From payment transactions to loss triangles.

Two routes lead to the same cells. :func:`triangle_base` keeps one row per payment for users who
need it; :func:`paid_cells` is the route for large inputs. It folds payments to one row per claim
and day *before* the join, so a claim that owns a large share of all payments arrives at the join
as a few thousand rows at most, and it counts claims per cell by adding up claim-level rows, so no
distinct aggregation is needed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import periods

CLAIM_ATTRIBUTES = ("loss_type", "state", "county", "catastrophe_code")


# --- row-level projections -------------------------------------------------------------------


def add_origin_period(df: DataFrame, loss_date: str = "loss_date", grain: str = "year") -> DataFrame:
    """Add ``origin_year/quarter/month`` and the integer ``origin_period`` of the grain."""
    return df.withColumns(
        {
            "origin_year": F.year(loss_date),
            "origin_quarter": F.quarter(loss_date),
            "origin_month": F.month(loss_date),
            "origin_period": periods.origin_key(loss_date, grain),
        }
    )


def add_development_period(
    df: DataFrame,
    loss_date: str = "loss_date",
    valuation_date: str = "payment_date",
    grain: str = "year",
    base: int = 0,
) -> DataFrame:
    age = periods.development_age(loss_date, valuation_date, grain, base)
    return df.withColumn("development_period", age)


def filter_valid_development(df: DataFrame, max_periods: int = 10, base: int = 0) -> DataFrame:
    """Keep ages ``base .. base + max_periods - 1``."""
    return df.filter(F.col("development_period").between(base, base + max_periods - 1))


def _limited(df: DataFrame, max_periods: int | None, base: int) -> DataFrame:
    """All ages, or the first ``max_periods`` of them where a caller asks for a limit."""
    return df if max_periods is None else filter_valid_development(df, max_periods, base)


def payments_outside_window(base: DataFrame, max_periods: int, dev_base: int = 0) -> DataFrame:
    """Number and amount of payments per age that a limit of ``max_periods`` leaves out."""
    outside = base.filter(~F.col("development_period").between(dev_base, dev_base + max_periods - 1))
    return outside.groupBy("development_period").agg(
        F.count(F.lit(1)).alias("payment_count"), F.sum("payment_amount").alias("payment_amount")
    )


def ages_of(cells: DataFrame, dev_base: int = 0, at_least: int = 0) -> range:
    """Ages from ``dev_base`` to the last one in the cells (one aggregated row comes to the driver)."""
    last = cells.agg(F.max("development_period")).first()[0]
    return range(dev_base, max(dev_base - 1 if last is None else last, dev_base + at_least - 1) + 1)


def running_total(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: str,
    amount: str,
    into: str = "cumulative_value",
) -> DataFrame:
    """Running sum of ``amount`` within each partition."""
    frame = (
        Window.partitionBy(*partition_by)
        .orderBy(order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(into, F.sum(amount).over(frame))


def aggregate_cells(
    df: DataFrame,
    value: str,
    how: Sequence[str] = ("sum",),
    origin: str = "origin_period",
    development: str = "development_period",
) -> DataFrame:
    """Aggregates of ``value`` per cell, one column for each of ``sum``, ``count``, ``avg`` asked for."""
    folds = {"sum": F.sum, "count": F.count, "avg": F.avg}
    unknown = set(how) - set(folds)
    if unknown:
        raise ValueError(f"unknown aggregates {sorted(unknown)}; choose from {sorted(folds)}")
    return df.groupBy(origin, development).agg(*[folds[h](value).alias(f"cell_{h}") for h in how])


def segment_filter(
    claims: DataFrame, loss_type: str | None = None, state: str | None = None
) -> DataFrame:
    """Narrow the claim side before the join, so that the condition reaches the scan."""
    if loss_type is not None:
        claims = claims.filter(F.col("loss_type") == loss_type)
    if state is not None:
        claims = claims.filter(F.col("state") == state)
    return claims


# --- payments joined to claims ---------------------------------------------------------------


def _carried(claims: DataFrame, wanted: Sequence[str]) -> list[str]:
    return ["claim_id", "loss_date", *[c for c in wanted if c in claims.columns]]


def triangle_base(
    payments: DataFrame,
    claims: DataFrame,
    grain: str = "year",
    dev_base: int = 0,
    as_of: dt.date | None = None,
    carry: Sequence[str] = CLAIM_ATTRIBUTES,
) -> DataFrame:
    """One row per payment made on or after the loss, with its origin and development period.

    Where one claim may own a large part of the payments and cells follow, give it the payments folded
    by :func:`claim_days`.
    """
    if as_of is not None:
        payments = payments.filter(F.col("payment_date") <= F.lit(as_of))
    joined = payments.join(claims.select(*_carried(claims, carry)), "claim_id")
    on_or_after = joined.filter(F.col("payment_date") >= F.col("loss_date"))
    with_age = add_development_period(on_or_after, grain=grain, base=dev_base)
    return with_age.withColumn("origin_period", periods.origin_key("loss_date", grain))


def claim_days(
    payments: DataFrame, as_of: dt.date | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Payments folded to one row per claim and payment date (and the columns of ``keep``).

    The sums combine on the map side, so the shuffle carries at most one row per claim, date and
    map task whatever the distribution of payments over claims.
    """
    if as_of is not None:
        payments = payments.filter(F.col("payment_date") <= F.lit(as_of))
    return payments.groupBy("claim_id", "payment_date", *keep).agg(
        F.sum("payment_amount").alias("payment_amount"),
        F.max("reserve_amount").alias("reserve_amount"),
    )


def claim_ages(
    payments: DataFrame,
    claims: DataFrame,
    segments: Sequence[str] = (),
    grain: str = "year",
    dev_base: int = 0,
    as_of: dt.date | None = None,
    fold_days: bool = True,
) -> DataFrame:
    """Amount paid per claim and development period, with the claim's origin and segments.

    Folding payments to claim-days first costs a shuffle and makes the join safe whatever share of
    the payments one claim owns. ``fold_days=False`` saves it where no claim is that large.
    """
    if as_of is not None:
        payments = payments.filter(F.col("payment_date") <= F.lit(as_of))
    if fold_days:
        payments = payments.groupBy("claim_id", "payment_date").agg(
            F.sum("payment_amount").alias("payment_amount")
        )
    base = triangle_base(payments, claims, grain, dev_base, carry=segments)
    return base.groupBy("claim_id", "origin_period", "development_period", *segments).agg(
        F.sum("payment_amount").alias("payment_amount")
    )


# --- cells -----------------------------------------------------------------------------------


def _cells(claim_level: DataFrame, segments: Sequence[str], scale: int | None) -> DataFrame:
    amount = F.sum("payment_amount")
    if scale is not None:
        amount = F.round(amount, scale)
    cells = claim_level.groupBy(*segments, "origin_period", "development_period").agg(
        amount.alias("incremental_value"), F.count(F.lit(1)).alias("claim_count")
    )
    return running_total(
        cells, [*segments, "origin_period"], "development_period", "incremental_value"
    )


def paid_cells(
    payments: DataFrame,
    claims: DataFrame,
    segments: Sequence[str] = (),
    grain: str = "year",
    max_periods: int | None = None,
    dev_base: int = 0,
    as_of: dt.date | None = None,
    scale: int | None = None,
    fold_days: bool = True,
) -> DataFrame:
    """Incremental (X) and cumulative (C) paid cells with the number of claims paid in each.

    All ages are kept unless ``max_periods`` asks for a limit; ``payments_outside_window`` tells what a
    limit leaves out.

    ``scale`` rounds each cell sum to that many decimals. Money has a fixed number of decimals,
    so this removes the dependence of floating sums on task order and makes reruns identical.
    """
    ages = claim_ages(payments, claims, segments, grain, dev_base, as_of, fold_days)
    return _cells(_limited(ages, max_periods, dev_base), segments, scale)


def triangle_cells(
    base: DataFrame,
    segments: Sequence[str] = (),
    max_periods: int | None = None,
    dev_base: int = 0,
    scale: int | None = None,
) -> DataFrame:
    """The same cells from an existing :func:`triangle_base`."""
    keys = ["claim_id", "origin_period", "development_period", *segments]
    claim_level = base.groupBy(*keys).agg(F.sum("payment_amount").alias("payment_amount"))
    return _cells(_limited(claim_level, max_periods, dev_base), segments, scale)


def label_cells(
    cells: DataFrame,
    triangle_type: str = "paid",
    loss_type: str = "ALL",
    grain: str = "year",
    as_of: dt.date | None = None,
) -> DataFrame:
    """Add the descriptive columns of the triangle store that are not already present."""
    labels = {
        "triangle_type": F.lit(triangle_type),
        "loss_type": F.lit(loss_type),
        "period_type": F.lit(grain),
        "as_of_date": F.lit(as_of).cast("date"),
    }
    return cells.withColumns({k: v for k, v in labels.items() if k not in cells.columns})


def incurred_cells(
    payments: DataFrame,
    claims: DataFrame,
    segments: Sequence[str] = (),
    grain: str = "year",
    max_periods: int | None = None,
    dev_base: int = 0,
    mode: str = "max",
    as_of: dt.date | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Incurred (paid to date plus case reserve) cells.

    ``mode="max"`` takes the largest incurred amount of any claim in the cell. ``mode="latest"``
    is the actuarial reading: each claim's last incurred amount in the period, summed over claims.
    """
    if mode not in ("max", "latest"):
        raise ValueError(f"unknown mode {mode!r}; choose 'max' or 'latest'")
    daily = running_total(
        claim_days(payments, as_of), ["claim_id"], "payment_date", "payment_amount", "paid_to_date"
    )
    incurred = daily.select(
        "claim_id",
        "payment_date",
        (F.col("paid_to_date") + F.coalesce("reserve_amount", F.lit(0.0))).alias("incurred"),
    )
    base = _limited(
        triangle_base(incurred, claims, grain, dev_base, carry=segments), max_periods, dev_base
    )
    cell = [*segments, "origin_period", "development_period"]
    if mode == "max":
        value = F.max("incurred")
    else:
        base = base.groupBy("claim_id", *cell).agg(
            F.max_by("incurred", "payment_date").alias("incurred")
        )
        value = F.sum("incurred")
    if scale is not None:
        value = F.round(value, scale)
    return base.groupBy(*cell).agg(value.alias("incurred_value"))


def densify(
    cells: DataFrame,
    as_of: dt.date,
    segments: Sequence[str] = (),
    grain: str = "year",
    max_periods: int | None = None,
) -> DataFrame:
    """Fill holes with zero increments up to each origin's observed age (0-based cells).

    The cumulative value is carried forward; nothing is invented below the observed diagonal.
    """
    origin_keys = [*segments, "origin_period"]
    last_seen = periods.observed_age(F.col("origin_period"), F.lit(as_of), grain)
    by_origin = cells.groupBy(*origin_keys).agg(
        F.map_from_entries(
            F.collect_list(
                F.struct("development_period", F.struct("incremental_value", "claim_count"))
            )
        ).alias("seen"),
        F.max("development_period").alias("last_paid"),
    )
    shown = last_seen if max_periods is None else F.least(last_seen, F.lit(max_periods - 1))
    until = F.greatest("last_paid", shown)
    grid = by_origin.select(
        *origin_keys, "seen", F.explode(F.sequence(F.lit(0), until)).alias("development_period")
    )
    cell = F.col("seen")[F.col("development_period")]
    filled = grid.select(
        *origin_keys,
        "development_period",
        F.coalesce(cell["incremental_value"], F.lit(0.0)).alias("incremental_value"),
        F.coalesce(cell["claim_count"], F.lit(0)).cast("long").alias("claim_count"),
    )
    return running_total(filled, origin_keys, "development_period", "incremental_value")


# --- wide and long layouts -------------------------------------------------------------------


def triangle_wide(
    cells: DataFrame,
    ages: Sequence[int],
    segments: Sequence[str] = (),
    value: str = "cumulative_value",
) -> DataFrame:
    """Rows = origins, columns ``dev_<age>``; NULL marks an unobserved cell.

    ``ages`` is an argument because asking Spark to discover pivot values costs an extra job.
    """
    wide = cells.groupBy(*segments, "origin_period").pivot("development_period", list(ages))
    pivoted = wide.agg(F.first(value))
    return pivoted.select(
        *segments, "origin_period", *[F.col(str(a)).alias(f"dev_{a}") for a in ages]
    )


def _columns(cells: DataFrame, max_periods: int | None, dev_base: int) -> range:
    if max_periods is None:
        return ages_of(cells, dev_base)
    return range(dev_base, dev_base + max_periods)


def paid_triangle(
    payments: DataFrame,
    claims: DataFrame,
    loss_type: str | None = None,
    state: str | None = None,
    grain: str = "year",
    max_periods: int | None = None,
    dev_base: int = 0,
    as_of: dt.date | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Wide cumulative paid triangle for one segment at the chosen grain and valuation date."""
    chosen = segment_filter(claims, loss_type, state)
    cells = paid_cells(payments, chosen, (), grain, max_periods, dev_base, as_of, scale)
    return triangle_wide(cells, _columns(cells, max_periods, dev_base))


def incurred_triangle(
    payments: DataFrame,
    claims: DataFrame,
    loss_type: str | None = None,
    grain: str = "year",
    max_periods: int | None = None,
    dev_base: int = 0,
    mode: str = "max",
    as_of: dt.date | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Wide incurred triangle."""
    chosen = segment_filter(claims, loss_type)
    cells = incurred_cells(
        payments, chosen, (), grain, max_periods, dev_base, mode, as_of, scale
    )
    return triangle_wide(cells, _columns(cells, max_periods, dev_base), value="incurred_value")


def wide_to_long(wide: DataFrame, segments: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``dev_<age>`` columns; cells that are NULL stay as NULL rows."""
    ages = [c for c in wide.columns if c.startswith("dev_")]
    long = wide.unpivot([*segments, "origin_period"], ages, "age_column", "cumulative_value")
    age = F.substring("age_column", 5, 10).cast("int")
    return long.select(
        *segments, "origin_period", age.alias("development_period"), "cumulative_value"
    )


def triangle_long(
    cells: DataFrame,
    ages: Sequence[int],
    triangle_type: str = "paid",
    loss_type: str = "ALL",
    grain: str = "year",
    as_of: dt.date | None = None,
    segments: Sequence[str] = (),
) -> DataFrame:
    """The stored long form: every origin × age, NULL where unobserved, plus labels and an id.

    ``segments`` are those of loss_type, state and county that the cells have; a triangle's id is made
    of its labels.

    The pivot carries whole cells (value, increment, count), so going wide and back needs no join
    with the cells and the payments behind them are read once.
    """
    packed = cells.withColumn(
        "cell", F.struct("cumulative_value", "incremental_value", "claim_count")
    )
    wide = triangle_wide(packed, ages, segments, value="cell")
    columns = [f"dev_{a}" for a in ages]
    long = wide.unpivot([*segments, "origin_period"], columns, "age_column", "cell")
    kind = F.col("loss_type") if "loss_type" in segments else F.lit(loss_type)
    place = {p: F.col(p) if p in segments else F.lit(None).cast("string") for p in ("state", "county")}
    key = F.concat_ws("|", F.lit(triangle_type), kind, *place.values(), F.lit(grain))
    labelled = label_cells(long, triangle_type, loss_type, grain, as_of)
    return labelled.select(
        F.sha2(key, 256).alias("triangle_id"),
        "triangle_type",
        "loss_type",
        *[column.alias(p) for p, column in place.items()],
        "origin_period",
        F.substring("age_column", 5, 10).cast("int").alias("development_period"),
        "cell.cumulative_value",
        "cell.incremental_value",
        "cell.claim_count",
        "period_type",
        "as_of_date",
    )


# --- triangle analyses -----------------------------------------------------------------------


def _origin_window(segments: Sequence[str]):
    return Window.partitionBy(*segments, "origin_period").orderBy("development_period")


def development_curves(cells: DataFrame, segments: Sequence[str] = ()) -> DataFrame:
    """Cumulative value, its index to the origin's first cell, and the step from the cell before."""
    frame = _origin_window(segments)
    value = F.col("cumulative_value")
    return cells.filter(value.isNotNull()).select(
        *segments,
        "origin_period",
        "development_period",
        "cumulative_value",
        F.try_divide(value, F.first(value).over(frame)).alias("development_index"),
        (value - F.coalesce(F.lag(value).over(frame), F.lit(0.0))).alias("incremental_value"),
    )


def calendar_year_development(
    cells: DataFrame, segments: Sequence[str] = (), grain: str = "year", dev_base: int = 0
) -> DataFrame:
    """Increments added up along the diagonals (all cells paid in one calendar period)."""
    diagonal = periods.origin_offset(
        F.col("origin_period"), F.col("development_period") - F.lit(dev_base), grain
    )
    return (
        cells.withColumn("calendar_year", diagonal)
        .groupBy(*segments, "calendar_year")
        .agg(
            F.sum("incremental_value").alias("total_incremental"),
            F.count_distinct("origin_period").alias("n_origin_years"),
            F.avg("incremental_value").alias("avg_incremental"),
        )
    )


def incremental_by_age(cells: DataFrame, segments: Sequence[str] = ()) -> DataFrame:
    """Total step of the cumulative values into each development period."""
    before = F.lag("cumulative_value").over(_origin_window(segments))
    step = F.col("cumulative_value") - F.coalesce(before, F.lit(0.0))
    return (
        cells.withColumn("step", step)
        .groupBy(*segments, "development_period")
        .agg(F.sum("step").alias("incremental_loss"))
    )


def triangle_summary(cells: DataFrame, segments: Sequence[str] = ()) -> DataFrame:
    """Shape and totals of each segment's triangle, in one pass over its cells."""
    first_age = F.min("development_period").over(Window.partitionBy(*segments))
    last_age = F.max("development_period").over(
        Window.partitionBy(*segments, "origin_period")
    )
    marked = cells.withColumns({"first_age": first_age, "last_age": last_age})
    value = F.col("cumulative_value")
    age = F.col("development_period")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, value).otherwise(F.lit(0.0)))

    return marked.groupBy(*segments).agg(
        F.count_distinct("origin_period").alias("n_origins"),
        F.count_distinct("development_period").alias("n_development_periods"),
        F.sum(value).alias("total_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.avg(value).alias("mean_value"),
        total(age == F.col("last_age")).alias("diagonal_sum"),
        total(age == F.col("first_age")).alias("first_period_total"),
    )
