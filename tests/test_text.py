"""Keyword rules, against a plain Python reading of them."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tailwise.functions.vocabulary import DEFAULT_TERMS, SHORT_TERMS, extend
from tailwise.operators import risk


def plain(text, terms=DEFAULT_TERMS):
    """Brute force: each keyword on its own."""
    text = (text or "").lower()
    found = [t for t in terms if re.search(rf"\b{re.escape(t.keyword)}\b", text)]
    best = {}
    for t in found:
        best[t.category] = max(best.get(t.category, 0), t.severity)
    category = max(best.items(), key=lambda kv: kv[1])[0] if best else "low_risk"
    return [t.keyword for t in found], min(1.0, sum(t.severity for t in found) / 3.0), category


def scored(spark, texts, terms=DEFAULT_TERMS):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = risk.score_text(df, F.col("t"), terms).orderBy("i").collect()
    return [(r.risk_keywords, r.risk_score, r.risk_category) for r in rows]


CASES = [
    None, "", "tissue", "leaking", "Pre-existing leak", "preexisting", "pre existing",
    "TOXIC MOLD", "toxic  mold", "mold_1", "moldé", "black mold and mould", "water-damage",
    "water damage; prior damage", "demand letter", "demand a letter", "sue sued suing",
    "court, attorney lawyer lawsuit", "hail hail hail", "x" * 5000 + " sinkhole",
]


def test_known_cases(spark):
    for text, got in zip(CASES, scored(spark, CASES)):
        words, score, category = plain(text)
        assert got[0] == words, text
        assert got[1] == pytest.approx(score), text
        assert got[2] == category, text


def test_sizes():
    assert (len(DEFAULT_TERMS), len(SHORT_TERMS)) == (48, 19)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(
            st.sampled_from(
                [t.keyword for t in DEFAULT_TERMS]
                + ["the", "-", "mold", "black", "é", "_", "damage", "water", ".", "Letter"]
            ),
            max_size=7,
        ).map(lambda parts: " ".join(parts)),
        min_size=20, max_size=40,
    )
)
def test_random_texts(spark, texts):
    for text, got in zip(texts, scored(spark, texts)):
        words, score, category = plain(text)
        assert got[0] == words and got[2] == category
        assert got[1] == pytest.approx(score)


def test_custom_vocabulary_keeps_positions_and_breaks_ties_by_first_hit(spark):
    terms = extend({"mold": ("alpha", 0.2), "zebra": ("beta", 1.0), "apple": ("alpha", 1.0)})
    assert terms[0].keyword == "mold" and terms[0].category == "alpha"
    texts = ["mold zebra apple", "zebra apple", "zebra lawsuit"]
    for text, got in zip(texts, scored(spark, texts, terms)):
        assert got[0] == plain(text, terms)[0]
        assert got[2] == plain(text, terms)[2]


def test_pattern_flags(spark):
    rows = [("Moldy walls",), ("legal counsel",), (None,), ("",), ("damp foundation",), ("attorney; mold",)]
    df = spark.createDataFrame(rows, "adjuster_notes string")
    got = [
        (r.has_water_mold_risk, r.has_litigation_risk, r.has_structural_risk, r.risk_category_sql,
         r.high_risk_flag_sql)
        for r in risk.flag_patterns(df).collect()
    ]
    assert got == [
        (True, False, False, "water_damage", True),
        (False, True, False, "low_risk", False),
        (False, False, False, "low_risk", False),
        (False, False, False, "low_risk", False),
        (True, False, True, "structural", False),
        (True, True, False, "litigation", True),
    ]


def test_classification_uses_the_whole_text(spark):
    late = "calm " * 2000 + "lawsuit"
    df = spark.createDataFrame(
        [(1, late, None), (2, None, None), (3, "all repairs finished", "")],
        "claim_id int, adjuster_notes string, loss_description string",
    )
    rows = {r.claim_id: r for r in risk.classify_claims(df).collect()}
    assert set(rows) == {1, 3}
    assert rows[1].risk_category == "high_risk" and rows[1].risk_keywords == ["litigation_risk"]
    assert rows[1].risk_score == 1.0 and rows[1].high_risk_flag
    assert rows[3].risk_category == "low_risk" and rows[3].risk_score == pytest.approx(0.1)


def test_classifiers_can_be_replaced(spark):
    df = spark.createDataFrame(
        [("water",)], "adjuster_notes string"
    ).withColumn("loss_description", F.lit(None).cast("string"))
    row = risk.classify_claims(
        df,
        label=lambda text, present: F.lit("medium_risk"),
        sentiment=lambda text, present: F.lit("negative"),
        method="model",
    ).first()
    assert row.high_risk_flag and row.risk_score == pytest.approx(0.7)
    assert row._analysis_method == "model"


def test_emerging_risks(spark):
    df = spark.createDataFrame(
        [(0.5, 0.0), (0.25, 50000.0), (0.25, 49999.0), (0.1, 1e9), (0.85, 1.0)],
        "risk_score double, incurred_amount double",
    )
    flagged = risk.flag_emerging_risks(df).collect()
    assert sorted((r.risk_score, r.risk_priority) for r in flagged) == [
        (0.25, "LOW"), (0.5, "MEDIUM"), (0.85, "CRITICAL"),
    ]


def test_keywords_of_any_case_and_none(spark):
    from tailwise.functions.vocabulary import Term

    terms = (Term("Sprinkler", "system", 0.5), Term("Burst Pipe", "water", 0.9))
    texts = ["the SPRINKLER and a burst pipe", "sprinklers", None]
    assert [k for k, _, _ in scored(spark, texts, terms)] == [["Sprinkler", "Burst Pipe"], [], []]
    assert scored(spark, texts, ())[0] == ([], 0.0, "low_risk")


def test_a_model_gets_the_text_as_written(spark):
    import pandas as pd

    @F.pandas_udf("string")
    def label(text: pd.Series) -> pd.Series:
        return text.str.contains("LAWSUIT").map({True: "high_risk", False: "low_risk"})

    claims = spark.createDataFrame(
        [(1, "A LAWSUIT is near", "d"), (2, "a lawsuit is near", "d")], "claim_id int, adjuster_notes string, loss_description string"
    )
    rows = risk.classify_claims(claims, label=lambda text, found: label(text)).orderBy("claim_id").collect()
    assert [r.risk_category for r in rows] == ["high_risk", "low_risk"]


def test_results_are_computed_before_the_generator(spark):
    df = spark.createDataFrame([("Toxic mold", None)], "adjuster_notes string, loss_description string")
    for judged in (risk.classify_claims(df), risk.detect_risks(df)):
        text = judged._jdf.queryExecution().optimizedPlan().toString()
        generators = [line for line in text.splitlines() if "Generate " in line]
        assert generators and not any("array_intersect" in g or "CASE WHEN" in g for g in generators), text


def test_claims_without_text_are_kept_on_request(spark):
    df = spark.createDataFrame(
        [(1, "lawsuit", None), (2, None, None), (3, None, ""), (3, None, "")],
        "claim_id int, adjuster_notes string, loss_description string",
    )
    rows = risk.classify_claims(df, textless=True).filter(risk.has_text()).collect()
    assert sorted(rows, key=str) == sorted(risk.classify_claims(df).collect(), key=str)
    every = risk.classify_claims(df, textless=True).collect()
    assert sorted((r.claim_id, r.risk_category) for r in every) == [
        (1, "high_risk"), (2, "low_risk"), (3, "low_risk"), (3, "low_risk"),
    ]


def test_derived_tables_write_the_claims_once(spark, monkeypatch):
    import datetime as dt

    import fixtures
    from tailwise.plans import tables

    written = []

    def counting(df, name, kept=tables.materialise):
        written.append("adjuster_notes" in df.columns)
        return kept(df, name)

    monkeypatch.setattr(tables, "materialise", counting)
    claims = fixtures.claims(spark)
    blank = claims.withColumns({"claim_id": F.lit("none"), "adjuster_notes": F.lit(None).cast("string")}).limit(1)
    claims = claims.unionByName(blank)
    built = tables.build_tables(claims, fixtures.payments(spark), dt.date(2023, 12, 31))
    assert sum(written) == 1
    assert built["claims_with_payments"].count() == 11 and built["claims_classified"].count() == 10
    assert "risk_category" not in built["claims_with_payments"].columns
