"""Keeping triangle cells current while payments stream in.

Payments per claim and day are additive, so each batch appends its own sums under its batch number,
without looking at the claims: a payment may arrive before its claim. The current triangle joins the
sums of all batches with the claims known when it is asked for. A replayed batch overwrites its own
folder, which makes the sink idempotent without any state; closed batches can be folded into one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.triangle import paid_cells


def batch_increments(payments: DataFrame) -> DataFrame:
    """Amount per claim and payment date of one batch: the finest grain at which batches add up."""
    return payments.groupBy("claim_id", "payment_date").agg(
        F.sum("payment_amount").alias("payment_amount")
    )


def maintain_cells(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch's claim-days below ``target/batch=<id>`` and stop at the end."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch_increments(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def compact(spark: SparkSession, target: str, into: str) -> None:
    """Fold the batches below ``target`` into one new folder that stands in for all of them."""
    batch_increments(spark.read.parquet(target)).write.mode("errorifexists").parquet(f"{into}/batch=-1")


def current_cells(
    spark: SparkSession, target: str, claims: DataFrame, segments: Sequence[str] = ("loss_type",),
    scale: int | None = None,
) -> DataFrame:
    """Cells of all batches so far, for the claims known now; all ages."""
    days = batch_increments(spark.read.parquet(target))
    return paid_cells(days, claims, segments, scale=scale, fold_days=False)
