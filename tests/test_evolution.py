"""Tables whose columns grow at the sink."""

import pytest

from tailwise.sources import evolution


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_columns_are_added_and_types_widened(spark, tmp_path):
    path = str(tmp_path / "t")
    evolution.append(spark.createDataFrame([(1, 7, "a")], "id int, n int, kind string"), path, ["kind"])
    evolution.append(spark.createDataFrame([("a", 2**40, 2.5, "x")], "kind string, ID long, extra double, note string"), path, ["kind"])
    evolution.append(spark.createDataFrame([(3, 1.5, "b")], "id int, extra float, kind string"), path, ["kind"])
    table = evolution.read(spark, path)
    assert table.dtypes == [("id", "bigint"), ("n", "int"), ("kind", "string"), ("extra", "double"), ("note", "string")]
    assert rows(table) == [(1, 7, "a", None, None), (2**40, None, "a", 2.5, "x"), (3, None, "b", 1.5, None)]
    assert rows(table.filter("kind = 'b'").select("id")) == [(3,)]


def test_decimals_and_numbers_widen_over_old_files(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.sql("SELECT CAST(1.25 AS DECIMAL(5,2)) AS paid, 3 AS n, CAST(0.5 AS FLOAT) AS x")
    evolution.append(first, path)
    evolution.append(spark.sql("SELECT CAST(12345678.125 AS DECIMAL(12,3)) AS paid, 2.25D AS n, 0.25D AS x"), path)
    assert sorted((float(r.paid), r.n, r.x) for r in evolution.read(spark, path).collect()) == [(1.25, 3.0, 0.5), (12345678.125, 2.25, 0.25)]


def test_clashes_write_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no table"):
        evolution.read(spark, path)
    evolution.append(spark.createDataFrame([(1, "a")], "id int, kind string"), path, ["kind"])
    clash = spark.createDataFrame([("1", 2)], "id string, kind int")
    with pytest.raises(ValueError, match="id: int stored, string given; kind: string stored, int given"):
        evolution.append(clash, path, ["kind"])
    with pytest.raises(ValueError, match="missing"):
        evolution.append(spark.createDataFrame([(1,)], "id int"), path, ["kind"])
    assert rows(evolution.read(spark, path)) == [(1, "a")]
    evolution.append(spark.createDataFrame([], "id int, kind string, later date"), path, ["kind"])
    assert rows(evolution.read(spark, path)) == [(1, "a", None)]
