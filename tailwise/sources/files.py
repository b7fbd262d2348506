"""Batch ingestion with typed schemas, row expectations and partitioned sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import contract, text_schema, typed

TEXT_FORMATS = ("csv", "json")
# Quoted values may hold line breaks and doubled quotes; a header is checked against the columns.
# Such files cannot be split, so large inputs should come as many files.
TEXT_OPTIONS = {
    "csv": {"header": "true", "enforceSchema": "false", "multiLine": "true", "escape": '"'},
    "json": {},
}


def expectations(table: str) -> dict[str, Column]:
    """The named row conditions of a raw table."""
    if table == "claims":
        return {
            "valid_claim_id": F.col("claim_id").isNotNull(),
            "valid_loss_date": F.col("loss_date").isNotNull(),
            "valid_loss_type": F.col("loss_type").isNotNull(),
        }
    if table == "payments":
        return {
            "valid_payment_id": F.col("payment_id").isNotNull(),
            "valid_claim_id": F.col("claim_id").isNotNull(),
            "valid_payment_amount": F.col("payment_amount") >= 0,
        }
    raise ValueError(f"no expectations for {table!r}")


def _all_hold(rules: Mapping[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(r, F.lit(False)) for r in rules.values()])


def keep_valid(
    df: DataFrame, rules: Mapping[str, Column], observation: Observation | None = None
) -> DataFrame:
    """Drop rows that violate a rule; optionally count violations while the rows stream by."""
    if observation is not None:
        broken = [
            F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()
        ]
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"), *broken)
    return df.filter(_all_hold(rules))


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows :func:`keep_valid` drops, with the names of the rules they violate."""
    names = [
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()
    ]
    return df.filter(~_all_hold(rules)).withColumn("violated", F.array_compact(F.array(*names)))


def with_ingest_metadata(df: DataFrame, ingestion_type: str | None = None) -> DataFrame:
    """Add arrival time, source file and (optionally) how the rows came in."""
    extra = {"_ingested_at": F.current_timestamp(), "_source_file": F.col("_metadata.file_path")}
    if ingestion_type is not None:
        extra["_ingestion_type"] = F.lit(ingestion_type)
    return df.withColumns(extra)


def written_schema(spark: SparkSession, table: str, path: str, file_format: str) -> T.StructType:
    """All columns as text, for CSV in the order of the header of the files already there."""
    texts = text_schema(contract(table))
    if file_format != "csv":
        return texts
    names = spark.read.options(**TEXT_OPTIONS["csv"]).csv(path).columns
    missing = set(texts.names) - set(names)
    if names and missing:
        raise ValueError(f"{table}: the header at {path} lacks {sorted(missing)}")
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names or texts.names])


def read_raw(spark: SparkSession, table: str, path: str, file_format: str = "csv") -> DataFrame:
    """Rows of a raw table; text formats give strings, to be cast by :func:`typed`.

    So a bad value costs a value, not the file. CSV columns are found by the header's names, in any
    order.
    """
    if file_format in TEXT_FORMATS:
        reader = spark.read.format(file_format).options(**TEXT_OPTIONS[file_format])
        return reader.schema(written_schema(spark, table, path, file_format)).load(path)
    return spark.read.format(file_format).schema(contract(table)).load(path)


def parse_failures(raw: DataFrame, table: str) -> DataFrame:
    """The rows of a text table with a value that does not parse, with those columns' names."""
    schema = contract(table)
    failed = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in schema
    ]
    return raw.withColumn("unparsed", F.array_compact(F.array(*failed))).filter(F.size("unparsed") > 0)


def ingest_claims_batch(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    raw = with_ingest_metadata(read_raw(spark, "claims", path, file_format), "batch")
    return typed(raw, contract("claims"))


def ingest_payments_batch(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    raw = with_ingest_metadata(read_raw(spark, "payments", path, file_format))
    return typed(raw, contract("payments"))


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    file_format: str = "parquet",
    sort_within: Sequence[str] = (),
) -> None:
    """Append to or overwrite a stored table.

    Partitioned output is first grouped by the partition columns, with AQE splitting large groups
    over several tasks, so that a task writes to few folders. ``sort_within`` clusters rows for
    min/max skipping.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_within:
        df = df.sortWithinPartitions(*partition_by, *sort_within)
    writer = df.write.format(file_format).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def save_as_table(
    df: DataFrame, name: str, mode: str = "append", partition_by: Sequence[str] = ()
) -> None:
    """The same for a catalogued table, in the session's default format."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
