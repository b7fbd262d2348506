"""Expectations on streams: valid rows and violating rows are both kept, and counted.

Each micro-batch is written once, parted into accepted and quarantined rows, so that a batch is in both
tables or in neither and the two always add up to what was read. A replayed batch overwrites its own folder.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..sources.files import expectations
from .ingest import read_raw_stream

VIOLATED, ACCEPTED = "violated", "_accepted"
OBSERVED = "expectations"  # the name of the counts among a query's observed metrics


def judged(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the names of the rules a row violates (a rule that is NULL does not hold)."""
    if VIOLATED in df.columns or ACCEPTED in df.columns:
        raise ValueError(f"columns {VIOLATED!r} and {ACCEPTED!r} must be free")
    names = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn(VIOLATED, F.array_compact(F.array(*names)))


def observed(stream: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The judged stream, with the batch's rows and violations by rule among its metrics."""
    rows = judged(stream, rules)
    broken = [F.count_if(F.array_contains(VIOLATED, name)).alias(name) for name in rules]
    return rows.observe(OBSERVED, F.count(F.lit(1)).alias("rows"), F.count_if(F.size(VIOLATED) > 0).alias("quarantined"), *broken)


class ViolationCounts(StreamingQueryListener):
    """Collects the counts of running queries by batch, for a live view; the stored tables hold them too."""

    def __init__(self):
        self.by_batch: dict[tuple[str, int], dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        counts = event.progress.observedMetrics.get(OBSERVED)
        if counts is not None and counts.rows is not None:
            self.by_batch[str(event.progress.id), event.progress.batchId] = counts.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def keep_judged(stream: DataFrame, rules: Mapping[str, Column], target: str, checkpoint: str) -> StreamingQuery:
    """Write every micro-batch's accepted and quarantined rows, to the end of the available input."""

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn(ACCEPTED, F.size(VIOLATED) == 0)
        rows.write.mode("overwrite").partitionBy(ACCEPTED).parquet(f"{target}/batch={number}")

    return (
        observed(stream, rules).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_judged(
    spark: SparkSession, table: str, source: str, target: str, checkpoint: str, file_format: str = "csv",
    max_files_per_trigger: int | None = None,
) -> None:
    """Run one ingestion of a raw table to the end of the available input."""
    stream = read_raw_stream(spark, table, source, file_format, max_files_per_trigger)
    keep_judged(stream, expectations(table), target, checkpoint).awaitTermination()


def _holds() -> Column:
    """The folder a row is in, by its name."""
    return F.col(ACCEPTED).cast("string") == "true"


def accepted(spark: SparkSession, target: str) -> DataFrame:
    """The rows that hold every rule, with their batch; other folders are not read."""
    return spark.read.parquet(target).filter(_holds()).drop(ACCEPTED, VIOLATED)


def quarantined(spark: SparkSession, target: str) -> DataFrame:
    """The rows that violate a rule, with the rules' names and their batch."""
    return spark.read.parquet(target).filter(~_holds()).drop(ACCEPTED)


def batch_counts(spark: SparkSession, target: str) -> DataFrame:
    """Rows read, accepted and quarantined of every batch."""
    rows = spark.read.parquet(target)
    return rows.groupBy("batch").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(_holds()).alias("accepted"),
        F.count_if(~_holds()).alias("quarantined"),
    )


def rule_counts(spark: SparkSession, target: str) -> DataFrame:
    """Violations by batch and rule; a row that violates two rules counts for both."""
    rows = quarantined(spark, target).select("batch", F.explode(VIOLATED).alias("rule"))
    return rows.groupBy("batch", "rule").agg(F.count(F.lit(1)).alias("violations"))
