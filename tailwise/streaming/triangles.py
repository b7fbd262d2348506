"""Claim-days and triangle cells kept current from streams of payments and claims.

A micro-batch touches some segments and origins. Their claim-days are read from the store, the batch is
added, and these parts alone are written again, with their cells; other parts keep their files. A payment
may come before its claim (its days wait in a part of their own), and a claim may be sent again, also with
another segment or loss date (its days move).

Every batch is first staged completely, then published by overwriting the touched parts. A run that dies in
between is finished by the next one from what was staged. A batch that comes again is recognised by its
number, so one store belongs to one checkpoint for payments and one for claims, and only one of the two
streams runs at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import periods
from ..operators import triangle
from ..schemas import contract
from ..session import delete_folder, folder_names, has_mark, is_complete, materialise, set_mark
from .cells import batch_increments
from .versions import KeyedTable

PUBLISHED = "_PUBLISHED"
WAITING = "waiting"  # the part of days whose claim is not known
CLOSED = -1  # the batch number of days that can no longer come again


class TriangleStore:
    """Claim versions, claim-days by part and cells by part below one shared folder."""

    def __init__(self, spark: SparkSession, folder: str, segments: Sequence[str] = ("loss_type",), grain: str = "year", scale: int | None = None):
        self.spark, self.folder, self.segments = spark, folder.rstrip("/"), list(segments)
        self.grain, self.scale = grain, scale
        self.claims = KeyedTable(spark, f"{self.folder}/claims", "claim_id", contract("claims"))

    # --- reading ---

    def cells(self) -> DataFrame:
        """The cells as :func:`triangle.paid_cells` gives them."""
        path = f"{self.folder}/cells"
        if not folder_names(self.spark, path):
            raise ValueError(f"nothing has been published at {path}")
        return self.spark.read.parquet(path).filter(F.col("development_period").isNotNull()).drop("part")

    def days(self) -> DataFrame:
        """The stored claim-days, those of unknown claims included."""
        return self._stored_days().filter(F.col("payment_date").isNotNull())

    def _stored_days(self) -> DataFrame:
        path = f"{self.folder}/days"
        fields = [f for f in contract("claims").fields if f.name in self.segments]
        extra = "".join(f", {f.name} {f.dataType.simpleString()}" for f in fields)
        schema = f"claim_id string, payment_date date, payment_amount double, batch long, loss_date date{extra}, part string"
        if not folder_names(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    # --- parts ---

    def _part(self) -> Column:
        """The part a claim's days belong to, by its segments and origin."""
        origin = periods.origin_key("loss_date", self.grain).cast("string")
        named = F.concat_ws("|", *[F.coalesce(F.col(s).cast("string"), F.lit("-")) for s in self.segments], origin)
        return F.when(F.col("loss_date").isNull(), WAITING).otherwise(named)

    def _attributed(self, days: DataFrame, claims: DataFrame) -> DataFrame:
        """Days with the claim attributes that decide their part; unknown claims leave them NULL."""
        # Claims are as many as the days; their files, far smaller than their rows, make Spark broadcast them.
        known = claims.select("claim_id", "loss_date", *self.segments).hint("merge")
        bare = days.select("claim_id", "payment_date", "payment_amount", "batch")
        return bare.join(known, "claim_id", "left").withColumn("part", self._part())

    # --- batches ---

    def apply_payments(self, batch: DataFrame, number: int) -> None:
        """Add a batch of payments (claim_id, payment_date, payment_amount).

        Rows without a claim or a date belong to no cell and are left out.
        """
        def stage(path: str) -> None:
            usable = batch.filter(F.col("claim_id").isNotNull() & F.col("payment_date").isNotNull())
            days = materialise(batch_increments(usable).withColumn("batch", F.lit(number).cast("long")), "batch-days")
            known = self.claims.current(days.select("claim_id").distinct())
            new = materialise(self._attributed(days, known), "batch-keyed")
            parts = new.select("part").distinct()
            old = self._stored_days().filter(F.col("batch") != number).join(parts, "part", "left_semi")
            self._write_staged(self._closed(old), new, parts, path)

        self._run("payments", number, stage)

    def apply_claims(self, batch: DataFrame, number: int, deleted: Column | None = None) -> None:
        """Add a batch of claims: new ones, and newer versions of known ones."""
        def stage(path: str) -> None:
            self.claims.append(batch, number, deleted)
            sent = materialise(batch.select("claim_id").filter(F.col("claim_id").isNotNull()).distinct(), "batch-claims")
            # The parts of all versions: where the claims' days are, and where they go.
            versions = self.claims.versions().join(sent, "claim_id", "left_semi")
            parts = versions.select(self._part().alias("part")).distinct().unionByName(self.spark.range(1).select(F.lit(WAITING).alias("part")))
            parts = materialise(parts.distinct(), "batch-parts")
            old = materialise(self._stored_days().filter(F.col("payment_date").isNotNull()).join(parts, "part", "left_semi"), "batch-touched")
            moved = self._attributed(old.join(sent, "claim_id", "left_semi"), self.claims.current(sent))
            kept = old.join(sent, "claim_id", "left_anti")
            self._write_staged(kept, moved, parts, path)

        self._run("claims", number, stage)

    def _closed(self, days: DataFrame) -> DataFrame:
        """Days of earlier batches, folded: only the newest batch can come again."""
        keys = ["claim_id", "payment_date", "loss_date", *self.segments, "part"]
        folded = days.filter(F.col("payment_date").isNotNull()).groupBy(*keys).agg(F.sum("payment_amount").alias("payment_amount"))
        return folded.withColumn("batch", F.lit(CLOSED).cast("long"))

    def _write_staged(self, old: DataFrame, new: DataFrame, parts: DataFrame, path: str) -> None:
        """The whole content of the touched parts. A row without a date stands for each part, so that one that becomes empty is replaced too."""
        rows = old.unionByName(new).unionByName(parts, allowMissingColumns=True)
        rows.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(path)

    def _run(self, kind: str, number: int, stage) -> None:
        self._finish_staged()
        path = f"{self.folder}/staged/{kind}-{number}"
        if is_complete(self.spark, path):
            return  # it has come again
        stage(path)
        self._publish(path)
        for name in folder_names(self.spark, f"{self.folder}/staged"):
            before = name.startswith(f"{kind}-") and int(name.split("-")[1]) < number
            if before:
                delete_folder(self.spark, f"{self.folder}/staged/{name}")

    def _finish_staged(self) -> None:
        """Publish what a run has staged but not published."""
        for name in folder_names(self.spark, f"{self.folder}/staged"):
            path = f"{self.folder}/staged/{name}"
            if is_complete(self.spark, path) and not has_mark(self.spark, path, PUBLISHED):
                self._publish(path)

    def _publish(self, path: str) -> None:
        schema = self._stored_days().schema
        rows = self.spark.read.schema(schema).parquet(path)
        self._replace(rows, "days")
        paid = rows.filter((F.col("payment_date") >= F.col("loss_date")) & (F.col("part") != WAITING))
        aged = triangle.add_development_period(paid, grain=self.grain).withColumn("origin_period", periods.origin_key("loss_date", self.grain))
        made = triangle.triangle_cells(aged.withColumn("_part", F.col("part")), [*self.segments, "_part"], scale=self.scale)
        parts = rows.select(F.col("part").alias("_part")).filter(F.col("_part") != WAITING).distinct()
        cells = made.unionByName(parts, allowMissingColumns=True)
        self._replace(cells.withColumnRenamed("_part", "part"), "cells")
        set_mark(self.spark, path, PUBLISHED)

    def _replace(self, rows: DataFrame, name: str) -> None:
        """Overwrite the parts that occur in ``rows``, and no other."""
        writer = rows.hint("rebalance", "part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("part").parquet(f"{self.folder}/{name}")

    # --- streams ---

    def keep_payments(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return self._keep(stream, self.apply_payments, checkpoint)

    def keep_claims(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return self._keep(stream, self.apply_claims, checkpoint)

    def _keep(self, stream: DataFrame, apply, checkpoint: str) -> StreamingQuery:
        return (
            stream.writeStream.foreachBatch(lambda batch, number: apply(batch, number))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
