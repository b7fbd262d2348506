"""Inputs of the named queries: the domain tables and the intermediate results they share."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import rounded
from ..operators import chainladder, claims, metrics, risk, triangle
from ..session import materialise
from ..sources import tables

# Valuation date of the test data, and the decimals its amounts have.
AS_OF = dt.date(2001, 12, 31)
SCALE = 4


class Inputs:
    """Lazy domain tables of one data folder; every method returns a DataFrame plan.

    The raw plans are built once, so each file's footer is read once per query.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw: dict[str, DataFrame] = {}
        self._once: Once | None = None

    def table(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = tables.table(self.spark, self.sf_dir, name)
        return self._raw[name]

    def claims(self, places: bool = False) -> DataFrame:
        return self._placed(tables.claims(self.table), places)

    def _placed(self, mapped: DataFrame, places: bool) -> DataFrame:
        if places:
            return tables.with_places(mapped, self.table)
        return mapped.drop("customer_key")

    def payments(self) -> DataFrame:
        return tables.payments(self.table)

    def cells(self, segments: Iterable[str] = ("loss_type",), **options) -> DataFrame:
        options.setdefault("scale", SCALE)
        return triangle.paid_cells(self.payments(), self.claims(), list(segments), **options)

    def pooled_cells(self, **options) -> DataFrame:
        """Cells of all loss types together, labelled ALL."""
        return self.cells((), **options).withColumn("loss_type", F.lit("ALL"))

    def links(self) -> DataFrame:
        return chainladder.link_ratios(self.cells())

    def estimates(self) -> DataFrame:
        return chainladder.reserve_estimates(self.cells())

    def total_estimates(self) -> DataFrame:
        """Per-origin sums over the loss types."""
        every = chainladder.with_grand_total(self.estimates())
        return every.filter(F.col("loss_type") == "ALL")

    def enriched(self, places: bool = False) -> DataFrame:
        return claims.enrich_claims(self.claims(places), self.payments(), scale=SCALE)

    # Texts are analysed where they are scanned: the joins that follow carry the results, and the
    # text itself only if the query shows it.

    def _with_payments(self, mapped: DataFrame, places: bool) -> DataFrame:
        return claims.enrich_claims(self._placed(mapped, places), self.payments(), scale=SCALE)

    def scored(self, places: bool = False) -> DataFrame:
        return self._with_payments(risk.detect_risks(tables.claims(self.table)), places)

    def classified(self, places: bool = False) -> DataFrame:
        return self._with_payments(risk.classify_claims(tables.claims(self.table)), places)

    def pattern_flagged(self) -> DataFrame:
        return self._with_payments(risk.flag_patterns(tables.claims(self.table)), False)

    def once(self) -> Once:
        """The same inputs for queries that use cells and claims several times; see :class:`Once`."""
        if self._once is None:
            self._once = Once(self.spark, self.sf_dir)
        return self._once

    def loading(self) -> DataFrame:
        return chainladder.risk_loading_factor(
            risk.risk_summary(self.classified(), ["loss_type"], detail="classified")
        )

    def summary(self) -> DataFrame:
        return metrics.reserve_summary(self.total_estimates(), self.loading(), AS_OF)

    def segment_summary(self) -> DataFrame:
        return metrics.reserve_summary_by_segment(self.estimates(), self.loading(), AS_OF)


class Once(Inputs):
    """Inputs that read the payments once: claim-days, cells and classified claims are written and read again.

    Worth it for queries that use them three times or more; with two uses a second scan costs less than the write.

    Classified claims are those with a text, which they then no longer carry.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self._kept: dict[str, DataFrame] = {}

    def _keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._kept:
            self._kept[name] = materialise(build(), name)
        return self._kept[name]

    def once(self) -> Once:
        return self

    def days(self) -> DataFrame:
        return self._keep("claim-days", lambda: triangle.claim_days(self.payments()))

    def cells(self, segments: Iterable[str] = ("loss_type",), **options) -> DataFrame:
        segments = list(segments)
        if options or segments != ["loss_type"]:
            options.setdefault("scale", SCALE)
            return triangle.paid_cells(self.days(), self.claims(), segments, fold_days=False, **options)
        return self._keep("cells", lambda: triangle.paid_cells(self.days(), self.claims(), segments, scale=SCALE, fold_days=False))

    def enriched(self, places: bool = False) -> DataFrame:
        return claims.enrich_claims(self.claims(places), self.days(), scale=SCALE)

    def _with_payments(self, mapped: DataFrame, places: bool) -> DataFrame:
        return claims.enrich_claims(self._placed(mapped, places), self.days(), scale=SCALE)

    def classified(self, places: bool = False) -> DataFrame:
        def build() -> DataFrame:
            judged = risk.classify_claims(tables.claims(self.table)).drop("adjuster_notes", "loss_description")
            return self._with_payments(judged, places)

        return self._keep(f"classified-{places}", build)


def shown(df: DataFrame, **places: Iterable[str] | str) -> DataFrame:
    """Round result columns: ``shown(df, p2="ibnr", p6=["cv"])`` rounds to 2 and 6 decimals."""
    for key, columns in places.items():
        names = [columns] if isinstance(columns, str) else columns
        df = rounded(df, int(key[1:]), names)
    return df


def joined_text(df: DataFrame, *columns: str) -> DataFrame:
    """Show array columns as comma-separated text."""
    return df.withColumns({c: F.concat_ws(",", c) for c in columns})
