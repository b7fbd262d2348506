"""A keyed table whose rows are sent again: all versions are kept, the newest one is read.

Batches are appended below ``batches/batch=<number>``; a replayed batch overwrites its own folder. Reading
merges: of a key's rows the one with the greatest order (such as ``updated_at``), then batch, is current;
a row marked as deleted hides its key. Compaction writes the current rows up to a batch as a base below
``base/upto=<number>``, from which readers go on once it is complete; nothing is changed in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import delete_folder, folder_names, is_complete

DELETED = "_deleted"


class KeyedTable:
    """Versions of rows with one key column, in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType, order: Sequence[str] = ("updated_at",)):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, list(order)
        self.schema = T.StructType([*schema.fields, T.StructField(DELETED, T.BooleanType())])

    def append(self, batch: DataFrame, number: int, deleted: Column | None = None) -> None:
        """Store a batch's rows as versions; ``deleted`` tells which of them end their key.

        A row without a key is no version of anything and is left out.
        """
        mark = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
        rows = batch.withColumn(DELETED, mark).filter(F.col(self.key).isNotNull())
        rows.select(*self.schema.names).write.mode("overwrite").parquet(self._batch(number))

    def _batch(self, number: int) -> str:
        return f"{self.path}/batches/batch={number}"

    def _numbers(self, kind: str, name: str) -> list[int]:
        found = [int(n.split("=")[1]) for n in folder_names(self.spark, f"{self.path}/{kind}") if n.startswith(f"{name}=")]
        return sorted(n for n in found if is_complete(self.spark, f"{self.path}/{kind}/{name}={n}"))

    def _upto(self) -> int | None:
        """The batch up to which a complete base holds everything."""
        return max(self._numbers("base", "upto"), default=None)

    def last_batch(self) -> int | None:
        return max(self._numbers("batches", "batch"), default=self._upto())

    def versions(self) -> DataFrame:
        """The rows of the newest base and of all batches after it, with their batch number."""
        base = self._upto()
        places = [] if base is None else [(f"{self.path}/base/upto={base}", base)]
        places += [(self._batch(n), n) for n in self._numbers("batches", "batch") if base is None or n > base]
        empty = self.spark.createDataFrame([], self.schema).withColumn("batch", F.lit(0).cast("long"))
        if not places:
            return empty
        # Batch folders are many and small; they are read by one scan, the number comes from the path.
        rows = self.spark.read.schema(self.schema).parquet(*[p for p, _ in places])
        number = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:batch|upto)=(-?[0-9]+)/[^/]*$", 1).cast("long")
        return rows.withColumn("batch", number)

    def current(self, keys: DataFrame | None = None, deleted: bool = False) -> DataFrame:
        """The newest version of every key, or of those in ``keys``; rows that end their key on request.

        Versions are picked by an aggregate that combines on the map side, so a key that was sent any
        number of times arrives once a task. Equal order and batch: the greater row hash counts.
        """
        rows = self.versions()
        if keys is not None:
            rows = rows.join(keys.select(self.key), self.key, "left_semi")
        names = self.schema.names
        rank = F.struct(*self.order, "batch", F.xxhash64(*names))
        newest = rows.groupBy(self.key).agg(F.max_by(F.struct(*names), rank).alias("_row"))
        rows = newest.select(*[F.col("_row")[n].alias(n) for n in names])
        return rows if deleted else rows.filter(~F.col(DELETED)).drop(DELETED)

    def compact(self) -> None:
        """Write the newest version of every key so far as a base; ended keys stay as such.

        Readers use the base once it is complete. A version that comes later but is older is still seen as
        older, because the base keeps every key's order.
        """
        last = self.last_batch()
        if last is not None and last != self._upto():
            self.current(deleted=True).write.mode("overwrite").parquet(f"{self.path}/base/upto={last}")

    def vacuum(self) -> None:
        """Delete batches and bases that the newest base stands for; no reader may still be using them."""
        base = self._upto()
        if base is None:
            return
        for number in self._numbers("batches", "batch"):
            if number <= base:
                delete_folder(self.spark, self._batch(number))
        for number in self._numbers("base", "upto"):
            if number < base:
                delete_folder(self.spark, f"{self.path}/base/upto={number}")

    def keep_stream(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Append every micro-batch under its number, to the end of the available input."""
        return (
            stream.writeStream.foreachBatch(lambda batch, number: self.append(batch, number))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
