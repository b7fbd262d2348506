"""Ingestion, expectations, sinks, contracts and quality checks."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import fixtures
from tailwise import schemas
from tailwise.operators import quality
from tailwise.sources import files
from tailwise.streaming import ingest

CLAIMS_CSV = """claim_id,policy_id,loss_date,report_date,claimant_name,loss_type,loss_description,adjuster_notes,claim_status,county,state,zip_code,catastrophe_code,created_at,updated_at
C1,P1,2020-01-31,2020-02-01,A,Fire,"Smoke, soot",note,Open,Orange,FL,02101,,2020-02-01 10:30:00,2020-02-01 10:30:00
,P2,2020-01-31,2020-02-01,B,Fire,x,y,Open,Orange,FL,02101,,2020-02-01 10:30:00,2020-02-01 10:30:00
C3,P3,not a date,2020-02-01,C,Wind,x,y,Open,Orange,FL,02101,CAT,2020-02-01 10:30:00,2020-02-01 10:30:00
C4,P4,2020-01-31,2020-02-01,D,,x,y,Open,Orange,FL,02101,,2020-02-01 10:30:00,2020-02-01 10:30:00
"""
PAYMENT_HEADER = (
    "payment_id,claim_id,payment_date,payment_type,payment_amount,cumulative_paid,reserve_amount,"
    "payment_status,check_number,payee_name,expense_type,created_at\n"
)


def payment_line(pid, cid, amount):
    return f"{pid},{cid},2020-03-01,Indemnity,{amount},,5,Cleared,,,,2020-03-01 00:00:00\n"


def test_typed_ingest_and_expectations(spark, tmp_path):
    path = tmp_path / "claims.csv"
    path.write_text(CLAIMS_CSV)
    raw = files.ingest_claims_batch(spark, str(path))
    rows = {r.policy_id: r for r in raw.collect()}
    assert rows["P1"].zip_code == "02101" and rows["P1"].loss_date == dt.date(2020, 1, 31)
    assert rows["P1"].loss_description == "Smoke, soot" and rows["P1"].catastrophe_code is None
    assert rows["P3"].loss_date is None
    assert rows["P1"]._source_file.endswith("claims.csv") and rows["P1"]._ingestion_type == "batch"

    rules = files.expectations("claims")
    seen = Observation("claims")
    kept = files.keep_valid(raw, rules, seen)
    assert [r.policy_id for r in kept.collect()] == ["P1"]
    assert seen.get == {"rows": 4, "valid_claim_id": 1, "valid_loss_date": 1, "valid_loss_type": 1}
    bad = {r.policy_id: r.violated for r in files.quarantine(raw, rules).collect()}
    assert bad == {"P2": ["valid_claim_id"], "P3": ["valid_loss_date"], "P4": ["valid_loss_type"]}


def test_stream_takes_new_files_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(
        PAYMENT_HEADER + payment_line("P1", "C1", 10) + payment_line("P2", "", 10)
    )
    ingest.ingest_streaming(spark, "payments", source, target, state)
    assert spark.read.parquet(target).count() == 1
    (tmp_path / "in" / "b.csv").write_text(
        PAYMENT_HEADER + payment_line("P3", "C1", -1) + payment_line("P4", "C2", 0)
        + payment_line("P5", "C2", "abc")
    )
    ingest.ingest_streaming(spark, "payments", source, target, state)
    ingest.ingest_streaming(spark, "payments", source, target, state)
    stored = spark.read.parquet(target)
    assert sorted(r.payment_id for r in stored.collect()) == ["P1", "P4"]
    assert {r._ingestion_type for r in stored.collect()} == {"streaming"}


def test_streamed_cells_equal_batch_cells(spark, tmp_path):
    from tailwise.operators import triangle
    from tailwise.streaming import cells as stream_cells

    claims, payments = fixtures.claims(spark), fixtures.payments(spark)
    raw = payments.withColumns(
        {"payment_type": F.lit("x"), "payment_status": F.lit("y"), "created_at": F.lit("2020-01-01").cast("timestamp")}
    )
    contract = schemas.conform(raw, "payments")
    source, target, state = (str(tmp_path / n) for n in ("in", "inc", "state"))
    for half in (F.col("payment_date") < "2019-06-01", F.col("payment_date") >= "2019-06-01"):
        contract.filter(half).write.mode("append").parquet(source)
        stream = ingest.valid_stream(spark, "payments", source, "parquet", max_files_per_trigger=1)
        stream_cells.maintain_cells(stream, target, state).awaitTermination()
    columns = ["loss_type", "origin_period", "development_period", "cumulative_value", "claim_count"]
    # Claims that arrive after their payments count from then on.
    early = claims.filter(F.col("claim_id") != claims.agg(F.min("claim_id")).first()[0])
    for known in (early, claims):
        streamed = stream_cells.current_cells(spark, target, known).select(columns).collect()
        batch = triangle.paid_cells(payments, known, ["loss_type"]).select(columns).collect()
        assert sorted(streamed) == sorted(batch)
    folded = str(tmp_path / "folded")
    stream_cells.compact(spark, target, folded)
    assert sorted(stream_cells.current_cells(spark, folded, claims).select(columns).collect()) == sorted(streamed)


def test_csv_by_name_with_quotes_and_line_breaks(spark, tmp_path):
    names = schemas.contract("payments").names
    order = [*names[1:], names[0]]
    values = {n: "1" for n in names} | {"payment_id": "P1", "claim_id": "C1", "payment_date": "2020-01-05", "created_at": "2020-01-05 00:00:00"}
    values |= {"payment_type": 'a "quoted"\nnote, with more', "reserve_amount": "many"}
    quoted = ",".join('"' + values[n].replace('"', '""') + '"' for n in order)
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text(",".join(order) + "\n" + quoted + "\n")
    row = files.ingest_payments_batch(spark, str(source)).first()
    assert (row.payment_id, row.claim_id, row.payment_type) == ("P1", "C1", 'a "quoted"\nnote, with more')
    assert row.reserve_amount is None
    failures = files.parse_failures(files.read_raw(spark, "payments", str(source)), "payments").collect()
    assert [r.unparsed for r in failures] == [["reserve_amount"]]
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    ingest.ingest_streaming(spark, "payments", str(source), target, state)
    streamed = spark.read.parquet(target).collect()
    assert [(r.payment_id, r.payment_type) for r in streamed] == [("P1", 'a "quoted"\nnote, with more')]


def test_partitioned_sink_prunes(spark, tmp_path):
    df = fixtures.claims(spark)
    path = str(tmp_path / "t")
    files.write_table(df, path, "overwrite", ["loss_type"], sort_within=["claim_id"])
    read = spark.read.parquet(path).filter("loss_type = 'Wind'")
    assert read.count() == 2
    assert "PartitionFilters: [isnotnull(loss_type" in read._jdf.queryExecution().toString()


def test_contracts(spark):
    for name in schemas.contract_names():
        assert len(schemas.contract(name).fields) > 4
    with pytest.raises(ValueError, match="report_date"):
        schemas.conform(fixtures.claims(spark).withColumn("policy_id", F.lit("p")), "claims")


def test_saved_table_appends(spark):
    files.save_as_table(spark.range(2), "saved_rows", "overwrite")
    files.save_as_table(spark.range(3), "saved_rows")
    assert spark.table("saved_rows").count() == 5


def test_checks(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("", None), (None, 5.0), ("a", 1.0)], "name string, amount double"
    )
    nulls = fixtures.by_key(quality.check_nulls(df, ["name", "amount", "missing"], 0.25), "column_name")
    assert (nulls["name"].null_count, nulls["name"].passed) == (2, False)
    assert (nulls["amount"].null_count, nulls["amount"].passed) == (1, True)
    assert "missing" not in nulls
    duplicates = quality.check_duplicates(df, ["name", "amount"]).first()
    assert (duplicates.total_rows, duplicates.distinct_rows, duplicates.duplicate_rows) == (4, 3, 1)
    spread = quality.check_value_range(df, "amount", 2.0, 4.0).first()
    assert (spread.actual_min, spread.actual_max, spread.violations) == (1.0, 5.0, 3)
    domain = fixtures.by_key(
        quality.check_domain(df, ["name"], {"name": ["a"]}), "rule"
    )
    assert domain["name is required"].violations == 2
    assert domain["name in enumeration"].violations == 1
    summary = fixtures.by_key(
        quality.quality_summary({"n": quality.check_nulls(df, ["name", "amount"], 0.25)}), "check_name"
    )
    assert (summary["n"].passed_checks, summary["n"].failed_checks) == (1, 1)
    with pytest.raises(quality.QualityError):
        quality.enforce(quality.check_nulls(df, ["name"]))
    quality.enforce(quality.check_nulls(df, ["name"], 0.9))
    empty = quality.check_duplicates(df.limit(0), ["name"]).first()
    assert empty.passed and empty.duplicate_pct == 0.0


def test_orphans(spark):
    payments = fixtures.payments(spark)
    claims = fixtures.claims(spark).filter("claim_id <> 'C19-2'")
    assert [r.payment_amount for r in quality.orphan_payments(payments, claims).collect()] == [8000.0]


def test_shared_folder_is_the_configured_one(spark):
    from tailwise import session

    assert session.shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.fresh_path(spark, "a") != session.fresh_path(spark, "a")
