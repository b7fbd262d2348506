"""What the operators share: words, hashed folds, lazy rows, Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A word is a run of characters other than the six ASCII spaces; Python's bytes.split() agrees.
WORD = r"[^\x20\x09-\x0D]+"


BATCH_BYTES = "16m"  # of an Arrow batch; the JVM and Python hold several at a time


def small_batches(spark: SparkSession, size: str = BATCH_BYTES) -> None:
    """Bound the session's Arrow batches by bytes, for texts of any length on small executors."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def release_memory() -> None:
    """Give memory that a finished task freed back to the system: the worker waits, but keeps little."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL(None).malloc_trim(0)


def returning(run: Callable) -> Callable:
    """A function over Arrow batches that releases memory when its task ends."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return whole


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, by Spark's own reader so that any store works."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(identifier: Column, folds: int) -> Column:
    """crc32 of the identifier as text, modulo ``folds``; a null identifier counts as ''."""
    return F.crc32(F.coalesce(identifier.cast("string"), F.lit("")).cast("binary")) % folds


def drawn(identifier: Column, seed: int) -> Column:
    """A uniform number in [0, 1) that depends on the identifier and the seed alone."""
    mixed = F.xxhash64(F.lit(seed), identifier.cast("string"))
    return F.shiftrightunsigned(mixed, 11).cast("double") / float(2**53)


def one_row_barrier(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through a one-row generator.

    Spark merges adjacent projections and would repeat a costly expression for every use of it;
    a generator between them computes it once.
    """
    packed = F.struct(*[expression.alias(name) for name, expression in columns.items()])
    kept = [F.col(name) for name in df.columns]
    return df.select(*kept, F.explode(F.array(packed)).alias("_made")).select(*kept, "_made.*")


PAGE = 1 << 15  # bits of one bitmap of Spark's
MOST_PAGES = 1 << 12  # 16 MB of bits


def maybe_among(rows: DataFrame, key: str, members: DataFrame) -> DataFrame:
    """``rows`` with ``_maybe``: false if ``key`` is surely not in the one column of ``members``, or null.

    Hashed bits of the members, 16 or more each and 16 MB at most, go to all tasks, so that wide rows need no
    shuffle to learn that they meet nothing. Of the others some are no members (more of them where the bits
    are too few): an exact join has to follow. ``members`` is read twice.
    """
    needed = members.count() * 16
    pages = min(MOST_PAGES, 1 << max(0, (needed - 1) // PAGE).bit_length())

    def place(column: Column) -> tuple[Column, Column]:
        bit = F.pmod(F.xxhash64(column.cast("string")), F.lit(pages * PAGE))
        return F.floor(bit / PAGE).cast("int"), (bit % PAGE).cast("int")

    page, at = place(F.col(members.columns[0]))
    placed = members.filter(F.col(members.columns[0]).isNotNull()).select(page.alias("_page"), at.alias("_at"))
    bits = placed.repartition("_page").groupBy("_page").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    page, at = place(F.col(key))
    met = rows.withColumn("_own", page).join(F.broadcast(bits), F.col("_own") == F.col("_page"), "left")
    byte = F.conv(F.hex(F.substr(F.col("_bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.col(key).isNotNull() & (F.getbit(byte, at % 8) == 1)
    return met.select(*rows.columns, F.coalesce(held, F.lit(False)).alias("_maybe"))


def texts_of(column: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Byte offsets and the byte buffer of a string column without nulls."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, memoryview(data) if data is not None else memoryview(b"")


def bounded_sample(rows: DataFrame, stratum: str, per_stratum: int, seed: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``per_stratum`` rows of every stratum, the first in a seeded order of identifiers.

    Rows are thinned by their drawn number before they are ranked, so a window sees about twice the
    bound however large a stratum is; if the thinning leaves too few (small strata are not thinned), the
    sample is smaller by a few rows.
    """
    counts = rows.groupBy(stratum).agg(F.count("*").alias("_n"))
    # One row per class of a classifier.
    thin = rows.withColumn("_u", drawn(F.col(id_col), seed)).join(F.broadcast(counts), stratum)
    thin = thin.filter(F.col("_u") * F.col("_n") < 2.0 * per_stratum + 50)
    order = Window.partitionBy(stratum).orderBy("_u", id_col)
    return thin.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= per_stratum).drop("_u", "_n", "_rank")
