"""Run named queries and their SQL side by side and report differences.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def kind(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, (dt.date, dt.datetime)):
        return type(value).__name__
    return type(value).__name__


def normal(value):
    """Exact text of a value; NaN and negative zero stay visible."""
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value)


def differences(spark_df, con, sql):
    names = sorted(spark_df.columns)
    left = [tuple(r[n] for n in names) for r in spark_df.collect()]
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != names:
        return f"columns {sorted(set(columns) ^ set(names))}"
    order = [columns.index(n) for n in names]
    right = [tuple(r[i] for i in order) for r in cursor.fetchall()]
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for i, n in enumerate(names):
        kinds = [{kind(r[i]) for r in side} - {None} for side in (left, right)]
        if kinds[0] != kinds[1]:
            return f"type of {n}: {kinds}"
    a = sorted(tuple(normal(v) for v in r) for r in left)
    b = sorted(tuple(normal(v) for v in r) for r in right)
    unequal = [(x, y) for x, y in zip(a, b) if x != y]
    if unequal:
        x, y = unequal[0]
        cells = {n: (p, q) for n, p, q in zip(names, x, y) if p != q}
        return f"{len(unequal)} of {len(a)} rows differ, first: {cells} in {x}"
    return None


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or queries:
        started = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name not in sqls:
                print(f"rows-only {name}: {df.count()} rows {time.time() - started:.1f}s", flush=True)
                continue
            problem = differences(df, con, sqls[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
