"""Append-only file streams with expectations, run until the input is exhausted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..schemas import contract, typed
from ..sources.files import (
    TEXT_FORMATS, TEXT_OPTIONS, expectations, keep_valid, with_ingest_metadata, written_schema,
)


def read_raw_stream(
    spark: SparkSession, table: str, path: str, file_format: str = "csv",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Typed stream of a raw table's files; the schema is explicit, never inferred."""
    schema = contract(table)
    reader = spark.readStream.format(file_format)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_format in TEXT_FORMATS:
        columns = written_schema(spark, table, path, file_format)
        raw = reader.options(**TEXT_OPTIONS[file_format]).schema(columns).load(path)
    else:
        raw = reader.schema(schema).load(path)
    return typed(with_ingest_metadata(raw, "streaming"), schema)


def valid_stream(
    spark: SparkSession, table: str, path: str, file_format: str = "csv",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The stream with rows that violate an expectation dropped."""
    stream = read_raw_stream(spark, table, path, file_format, max_files_per_trigger)
    return keep_valid(stream, expectations(table))


def append_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived to a parquet table and stop.

    The checkpoint records which files were taken, so the next run continues with new ones only.
    """
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_streaming(
    spark: SparkSession, table: str, source: str, target: str, checkpoint: str,
    file_format: str = "csv", expect: bool = True, max_files_per_trigger: int | None = None,
) -> None:
    """Run one ingestion to the end of the available input."""
    read = valid_stream if expect else read_raw_stream
    stream = read(spark, table, source, file_format, max_files_per_trigger)
    append_available(stream, target, checkpoint).awaitTermination()

