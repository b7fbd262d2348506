"""Streams that keep tables: expectations, claim versions, cells by touched part."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tailwise import schemas
from tailwise.operators import triangle
from tailwise.session import fresh_path
from tailwise.sources.files import expectations
from tailwise.streaming import expectations as judged
from tailwise.streaming import ingest
from tailwise.streaming.triangles import TriangleStore
from tailwise.streaming.versions import KeyedTable

CLAIM = "claim_id string, loss_type string, loss_date date, updated_at timestamp"
PAYMENT = "payment_id string, claim_id string, payment_date date, payment_amount double"


def claims_of(spark, rows):
    """(claim_id, loss_type, loss_date, updated_at) rows in the stored layout."""
    df = spark.createDataFrame(rows, "claim_id string, loss_type string, loss_date string, updated_at string")
    df = df.withColumns({"loss_date": F.to_date("loss_date"), "updated_at": F.to_timestamp("updated_at")})
    fixed = {"policy_id": F.lit("P"), "report_date": F.col("loss_date"), "claim_status": F.lit("Open"), "created_at": F.col("updated_at")}
    return schemas.conform(df.withColumns(fixed), "claims")


def payments_of(spark, rows):
    df = spark.createDataFrame(rows, "payment_id string, claim_id string, payment_date string, payment_amount double")
    fixed = {"payment_type": F.lit("x"), "payment_status": F.lit("y"), "created_at": F.lit("2020-01-01").cast("timestamp")}
    return schemas.conform(df.withColumn("payment_date", F.to_date("payment_date")).withColumns(fixed), "payments")


COLUMNS = ["loss_type", "origin_period", "development_period", "incremental_value", "cumulative_value", "claim_count"]


def expected(payments, claims):
    return sorted(triangle.paid_cells(payments, claims, ["loss_type"], scale=4).select(COLUMNS).collect(), key=str)


def got(store):
    return sorted(store.cells().select(COLUMNS).collect(), key=str)


def files_below(folder):
    return {os.path.join(d, n) for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}


# --- expectations ---


def test_both_sinks_add_up_also_after_a_restart(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = [("1", "A", "2020-01-01", 5.0), ("2", None, "2020-01-02", -5.0), (None, "A", "2020-01-03", None), ("4", "B", None, 0.0)]
    listener = judged.ViolationCounts()
    spark.streams.addListener(listener)
    try:
        for part in (rows, rows[1:], [], rows[:1]):
            if part:
                payments_of(spark, part).write.mode("append").parquet(source)
            judged.ingest_judged(spark, "payments", source, target, state, "parquet")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    counts = {r.batch: (r.rows, r.accepted, r.quarantined) for r in judged.batch_counts(spark, target).collect()}
    assert counts == {0: (4, 2, 2), 1: (3, 1, 2), 2: (1, 1, 0)}
    kept = {(r.batch, r.payment_id): r.violated for r in judged.quarantined(spark, target).collect()}
    both = ["valid_claim_id", "valid_payment_amount"]
    assert kept[0, "2"] == both and kept[0, None] == ["valid_payment_id", "valid_payment_amount"]
    rules = {(r.batch, r.rule): r.violations for r in judged.rule_counts(spark, target).collect()}
    assert rules[0, "valid_payment_amount"] == 2 and rules[1, "valid_claim_id"] == 1
    assert sorted(r.payment_id for r in judged.accepted(spark, target).collect()) == ["1", "1", "4", "4"]
    live = sorted((c["rows"], c["quarantined"], c["valid_payment_amount"]) for c in listener.by_batch.values() if c["rows"])
    assert live == [(1, 0, 0), (3, 2, 2), (4, 2, 2)]


def test_a_batch_that_is_written_again_counts_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    payments_of(spark, [("1", "A", "2020-01-01", 5.0), ("2", "A", "2020-01-01", -1.0)]).write.parquet(source)
    for state in ("one", "two"):  # a lost checkpoint reads everything again as batch 0
        judged.ingest_judged(spark, "payments", source, target, str(tmp_path / state), "parquet")
    assert [tuple(r) for r in judged.batch_counts(spark, target).collect()] == [(0, 2, 1, 1)]


def test_names_that_clash(spark):
    with pytest.raises(ValueError):
        judged.judged(spark.createDataFrame([(1,)], "violated int"), {"x": F.lit(True)})
    assert judged.judged(payments_of(spark, []), expectations("payments")).count() == 0


# --- versions ---


def table(spark, path):
    from pyspark.sql import types as T

    return KeyedTable(spark, str(path), "claim_id", T.StructType.fromDDL(CLAIM))


def rows_of(spark, *rows):
    df = spark.createDataFrame(rows, "claim_id string, loss_type string, loss_date string, updated_at string, gone boolean")
    return df.withColumns({"loss_date": F.to_date("loss_date"), "updated_at": F.to_timestamp("updated_at")})


def seen(frame):
    return sorted((r.claim_id, r.loss_type) for r in frame.collect())


def test_newest_version_wins_and_tombstones_hide(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.current().collect() == [] and t.last_batch() is None
    t.append(rows_of(spark, ("A", "Fire", "2020-01-01", "2020-01-01", None), ("B", "Wind", "2020-01-01", "2020-01-05", None), (None, "Wind", "2020-01-01", "2020-01-05", None)), 0)
    t.append(rows_of(spark, ("A", "Theft", "2020-01-01", "2020-01-02", False), ("B", "Fire", "2020-01-01", "2020-01-04", False), ("C", "Fire", "2020-01-01", None, False)), 1, F.col("gone"))
    assert seen(t.current()) == [("A", "Theft"), ("B", "Wind"), ("C", "Fire")]
    # The same order in a later batch counts; an older row that comes late does not; a replay changes nothing.
    last = rows_of(spark, ("A", "Water", "2020-01-01", "2020-01-02", False), ("B", "Late", "2020-01-01", "2020-01-01", False), ("C", None, None, "2020-01-09", True))
    for _ in range(2):
        t.append(last, 2, F.col("gone"))
    want = [("A", "Water"), ("B", "Wind")]
    assert seen(t.current()) == want
    assert seen(t.current(spark.createDataFrame([("B",), ("Z",)], "claim_id string"))) == [("B", "Wind")]
    t.compact()
    assert seen(t.current()) == want and t.versions().count() == 3
    t.vacuum()
    assert seen(t.current()) == want and t.last_batch() == 2
    # What was deleted stays deleted for older versions, and returns with a newer one.
    t.append(rows_of(spark, ("C", "Old", "2020-01-01", "2020-01-08", False), ("A", "New", "2020-01-01", "2020-02-01", False)), 3)
    assert seen(t.current()) == [("A", "New"), ("B", "Wind")]
    t.append(rows_of(spark, ("C", "Back", "2020-01-01", "2020-01-10", False)), 4)
    t.compact()
    t.vacuum()
    assert seen(t.current()) == [("A", "New"), ("B", "Wind"), ("C", "Back")]


def test_an_unfinished_base_is_not_read(spark, tmp_path):
    t = table(spark, tmp_path)
    t.append(rows_of(spark, ("A", "Fire", "2020-01-01", "2020-01-01", None)), 0)
    t.append(rows_of(spark, ("A", "Wind", "2020-01-01", "2020-01-02", None)), 1)
    (tmp_path / "base" / "upto=1").mkdir(parents=True)
    (tmp_path / "base" / "upto=1" / "part-0.parquet").write_bytes(b"cut off")
    assert seen(t.current()) == [("A", "Wind")]
    t.compact()
    assert seen(t.current()) == [("A", "Wind")] and t.versions().count() == 1


def test_claims_sent_twice_do_not_count_twice(spark, tmp_path):
    claims = claims_of(spark, [(f"C{i}", "Fire" if i % 2 else "Wind", "2019-03-01", "2020-01-01") for i in range(20)])
    payments = payments_of(spark, [(f"P{i}", f"C{i % 20}", f"20{19 + i % 3}-05-01", 10.0) for i in range(60)])
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    t = KeyedTable(spark, str(tmp_path / "claims"), "claim_id", schemas.contract("claims"))
    for status in ("Open", "Closed"):
        sent = claims.withColumns({"claim_status": F.lit(status), "updated_at": F.current_timestamp()})
        sent.write.mode("append").parquet(source)
        t.keep_stream(ingest.valid_stream(spark, "claims", source, "parquet"), state).awaitTermination()
    assert t.versions().count() == 40
    assert {r.claim_status for r in t.current().collect()} == {"Closed"}
    assert expected(payments, t.current()) == expected(payments, claims)


# --- cells by touched part ---


def test_random_batches_equal_the_whole(spark, tmp_path):
    """Late claims, late payments, changed claims and replays, in any order."""
    drawn = random.Random(4)
    store = TriangleStore(spark, str(tmp_path / "store"), scale=4)
    known, paid = {}, []
    number = {"claims": 0, "payments": 0}
    for step in range(7):
        if step % 2 == 0:
            rows = [(f"P{step}-{i}", f"C{drawn.randrange(12)}", f"20{drawn.randrange(15, 22)}-0{drawn.randrange(1, 9)}-03", drawn.randrange(1000) / 10) for i in range(25)]
            paid += rows
            batch, apply, kind = payments_of(spark, rows), store.apply_payments, "payments"
        else:
            rows = [(f"C{i}", drawn.choice(["Fire", "Wind", None]), f"20{drawn.randrange(15, 18)}-02-01", f"2020-01-{step + 10}") for i in drawn.sample(range(12), 7)]
            known |= {r[0]: r for r in rows}
            batch, apply, kind = claims_of(spark, rows), store.apply_claims, "claims"
        for _ in range(drawn.choice([1, 2])):  # a replay has the same number
            apply(batch, number[kind])
        number[kind] += 1
        if known:
            assert got(store) == expected(payments_of(spark, paid), claims_of(spark, list(known.values())))
    days = store.days().groupBy("claim_id").agg(F.sum("payment_amount").alias("paid")).collect()
    assert sum(r.paid for r in days) == pytest.approx(sum(r[3] for r in paid))


def test_untouched_parts_keep_their_files(spark, tmp_path):
    store = TriangleStore(spark, str(tmp_path / "store"))
    store.apply_claims(claims_of(spark, [("A", "Fire", "2018-01-01", "2020-01-01"), ("B", "Wind", "2018-01-01", "2020-01-01"), ("C", "Wind", "2019-01-01", "2020-01-01")]), 0)
    store.apply_payments(payments_of(spark, [("1", "A", "2018-02-01", 1.0), ("2", "B", "2018-02-01", 2.0), ("3", "C", "2019-02-01", 3.0)]), 0)
    before = {n: files_below(tmp_path / "store" / n) for n in ("days", "cells")}
    store.apply_payments(payments_of(spark, [("4", "B", "2019-02-01", 5.0)]), 1)
    for name, files in before.items():
        now = files_below(tmp_path / "store" / name)
        changed = {f.split("part=")[1].split("/")[0] for f in now ^ files}
        assert {c.replace("%7C", "|") for c in changed} == {"Wind|2018"}, name
    # A claim that moves leaves nothing behind.
    store.apply_claims(claims_of(spark, [("C", "Fire", "2018-03-01", "2020-02-01")]), 1)
    cells = {(r.loss_type, r.origin_period, r.development_period): r.cumulative_value for r in store.cells().collect()}
    assert cells == {("Fire", 2018, 0): 4.0, ("Wind", 2018, 0): 2.0, ("Wind", 2018, 1): 7.0}


def test_a_run_that_died_is_finished(spark, tmp_path, monkeypatch):
    store = TriangleStore(spark, str(tmp_path / "store"))
    store.apply_claims(claims_of(spark, [("A", "Fire", "2018-01-01", "2020-01-01")]), 0)
    store.apply_payments(payments_of(spark, [("1", "A", "2018-02-01", 1.0)]), 0)
    batch = payments_of(spark, [("2", "A", "2018-03-01", 2.0)])

    def die(path):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(store, "_publish", die)
        with pytest.raises(RuntimeError):
            store.apply_payments(batch, 1)
    # The other stream goes on first; then the batch comes again.
    store.apply_claims(claims_of(spark, [("A", "Wind", "2018-01-01", "2020-02-01")]), 1)
    store.apply_payments(batch, 1)
    assert [(r.loss_type, r.cumulative_value) for r in store.cells().collect()] == [("Wind", 3.0)]


def test_empty_and_odd_batches(spark, tmp_path):
    store = TriangleStore(spark, str(tmp_path / "store"))
    with pytest.raises(ValueError):
        store.cells()
    store.apply_payments(payments_of(spark, []), 0)
    store.apply_payments(payments_of(spark, [("1", None, "2018-02-01", 1.0), ("2", "A", None, 1.0), ("3", "A", "2018-02-01", 4.0), ("4", "A", "2017-02-01", 8.0)]), 1)
    store.apply_claims(claims_of(spark, []), 0)
    store.apply_claims(claims_of(spark, [("A", "Fire", "2018-01-01", "2020-01-01")]), 1)
    # A payment before the loss is no cell's; it is kept, for the claim's date may still change.
    assert [r.cumulative_value for r in store.cells().collect()] == [4.0]
    store.apply_claims(claims_of(spark, [("A", "Fire", "2017-01-01", "2020-01-02")]), 2)
    assert sorted((r.origin_period, r.development_period, r.cumulative_value) for r in store.cells().collect()) == [(2017, 0, 8.0), (2017, 1, 12.0)]


def test_claims_are_not_broadcast_to_their_days(spark):
    """Files of claims are far smaller than their rows, so Spark would send all of them to every task."""
    store = TriangleStore(spark, fresh_path(spark, "store"))
    days = spark.createDataFrame([("1", dt.date(2001, 2, 1), 5.0, 0)], "claim_id string, payment_date date, payment_amount double, batch long")
    claims = spark.createDataFrame([("1", dt.date(2001, 1, 1), "Fire")], "claim_id string, loss_date date, loss_type string")
    joined = store._attributed(days, claims)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert [r.part for r in joined.collect()] == ["Fire|2001"]
