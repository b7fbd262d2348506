"""A stored table whose columns may grow: appends are reconciled with what is stored.

Added columns are NULL in older rows, and columns that an append lacks are NULL in its rows. A type may be
widened by either side; older files stay as they are and are read with the wider type. Any other
change of a type is an error before a row is written. Every append that changes the schema adds it to a
log beside the files (``_schemas``, which readers of the folder pass over), so a read lists no footers
and old files are never rewritten. The log is written before the rows: a writer lost in between leaves a
schema whose new columns are still NULL everywhere. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import write_table

LOG = "_schemas"
WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The one of two types that holds all values of both, as the parquet reader widens; None if neither does."""
    if a == b:
        return a
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        for one, other in ((a, b), (b, a)):
            if one.scale >= other.scale and one.precision - one.scale >= other.precision - other.scale:
                return one
        return None
    for one, other in ((a, b), (b, a)):
        if isinstance(one, T.DoubleType) and (isinstance(other, T.FloatType) or other in WHOLE[:3]):
            return one
    return None


def reconciled(stored: T.StructType, arriving: T.StructType, partition_by: Sequence[str] = ()) -> T.StructType:
    """The stored columns, widened where needed, then the added ones; ValueError lists all clashes.

    Names are compared without case, as Spark does; a stored spelling stays. A partition column is part of
    the layout: it cannot be added later or change its type.
    """
    new = {f.name.lower(): f for f in arriving}
    known = {f.name.lower() for f in stored}
    fixed = {name.lower() for name in partition_by}
    if len(new) < len(arriving):
        raise ValueError("columns whose names differ in case only")
    fields, clashes = [], []
    for field in stored:
        other = new.get(field.name.lower(), field)
        kind = wider(field.dataType, other.dataType)
        if kind is None or (kind != field.dataType and field.name.lower() in fixed):
            clashes.append(f"{field.name}: {field.dataType.simpleString()} stored, {other.dataType.simpleString()} given")
        fields.append(T.StructField(field.name, kind or field.dataType))
    clashes += [f"{name}: not a column of the stored layout" for name in fixed - known]
    clashes += [f"{name}: missing from the rows" for name in fixed - set(new)]
    if clashes:
        raise ValueError("; ".join(sorted(clashes)))
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for name, f in new.items() if name not in known])


def _newest(spark: SparkSession, path: str) -> tuple[int, T.StructType | None]:
    """Number and content of the newest logged schema; (0, None) if nothing was stored."""
    try:
        log = spark.read.schema("version int, fields string").json(f"{path}/{LOG}")
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return 0, None
        raise
    # One row per change of the schema.
    version, fields = log.agg(F.max("version"), F.max_by("fields", "version")).first()
    return (version, T.StructType.fromJson(json.loads(fields))) if fields else (0, None)


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The newest schema of a table; None if nothing was stored."""
    return _newest(spark, path)[1]


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> T.StructType:
    """Append rows, evolving the stored schema; returns the schema of the table after it."""
    spark = df.sparkSession
    version, stored = _newest(spark, path)
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    target = reconciled(plain if stored is None else stored, plain, partition_by)
    if target != stored:
        log = spark.createDataFrame([(version + 1, target.json())], "version int, fields string")
        log.coalesce(1).write.mode("append").json(f"{path}/{LOG}")
    given = {name.lower() for name in df.columns}
    columns = [
        (F.col(f.name) if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in target
    ]
    write_table(df.select(*columns), path, "append", partition_by)
    return target


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows with the newest schema; ValueError if nothing was stored."""
    schema = stored_schema(spark, path)
    if schema is None:
        raise ValueError(f"no table at {path}")
    return spark.read.schema(schema).parquet(path).select(*schema.names)
