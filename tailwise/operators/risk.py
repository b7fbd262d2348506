"""Risk signals in free text and the tables summarising them.

All text work is column expressions over the whole text; the number of expressions depends on the
vocabulary only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as words
from ..functions.numeric import band, count_when, ratio, sum_when
from ..functions.vocabulary import (
    DEFAULT_TERMS,
    ENTITY_WORDS,
    NEGATIVE_WORDS,
    PATTERN_CATEGORIES,
    PATTERN_FLAGS,
    PATTERN_HIGH_RISK,
    POSITIVE_WORDS,
    Term,
)

# Review priorities by score.
EMERGING_PRIORITY = [(0.8, "CRITICAL"), (0.6, "HIGH"), (0.4, "MEDIUM")]
REVIEW_PRIORITY = [(0.9, "CRITICAL"), (0.7, "HIGH"), (0.5, "MEDIUM")]


# --- keyword scoring -------------------------------------------------------------------------


def score_text(df: DataFrame, text: Column, terms: Sequence[Term] = DEFAULT_TERMS) -> DataFrame:
    """Add ``risk_keywords``, ``risk_score`` and ``risk_category`` for the text.

    The text is lower-cased and searched once; the three results work on the few words found. NULL
    or empty text has no keywords, score 0 and category low_risk.
    """
    keywords = [t.keyword for t in terms]
    matched = (
        words.with_keywords_found(df, text, keywords)
        .withColumn(
            "_matched",
            F.when(F.size("_found") > 0, words.listed(keywords, F.col("_found"))).otherwise(
                F.array().cast("array<string>")
            ),
        )
        .withColumn("_positions", words.positions_of(F.col("_matched"), terms))
    )
    positions, any_word = F.col("_positions"), F.size("_matched") > 0
    return words.with_results(
        matched,
        {
            "risk_keywords": F.col("_matched"),
            "risk_score": F.when(any_word, words.score_of(positions, terms)).otherwise(0.0),
            "risk_category": F.when(any_word, words.category_of(positions, terms)).otherwise("low_risk"),
        },
    ).drop("_lowered", "_found", "_matched", "_positions")


def detect_risks(
    claims: DataFrame,
    text_col: str = "adjuster_notes",
    description_col: str | None = "loss_description",
    terms: Sequence[Term] = DEFAULT_TERMS,
    threshold: float = 0.5,
) -> DataFrame:
    """Score notes (and description) of each claim and flag scores at or above ``threshold``."""
    text = F.col(text_col)
    if description_col is not None and description_col in claims.columns:
        text = F.concat_ws(" ", text, F.col(description_col))
    scored = score_text(claims, text, terms)
    return scored.withColumn("high_risk_flag", F.col("risk_score") >= threshold)


def flag_patterns(claims: DataFrame, text_col: str = "adjuster_notes") -> DataFrame:
    """Substring-based flags and category; NULL text raises no flag."""
    lowered = F.lower(text_col)
    flags = {name: words.has_any_substring(lowered, parts) for name, parts in PATTERN_FLAGS.items()}
    category = None
    for label, parts in PATTERN_CATEGORIES:
        found = words.has_any_substring(lowered, parts)
        category = F.when(found, label) if category is None else category.when(found, label)
    return claims.withColumns(
        {
            **flags,
            "risk_category_sql": category.otherwise("low_risk"),
            "high_risk_flag_sql": words.has_any_substring(lowered, PATTERN_HIGH_RISK),
        }
    )


# --- classification by rules -----------------------------------------------------------------

# A classifier gets the text as it was written and the rule keywords found in it.
Classifier = Callable[[Column, Column], Column]

_RULE_WORDS = sorted(
    {t.keyword for t in DEFAULT_TERMS}
    | {w for lexicon in ENTITY_WORDS.values() for w in lexicon}
    | {*NEGATIVE_WORDS, *POSITIVE_WORDS}
)


def rule_label(text: Column, found: Column) -> Column:
    """``high_risk`` with a word of severity 0.8 or more, ``medium_risk`` with any, else ``low_risk``."""
    severe = [F.lit(t.keyword) for t in DEFAULT_TERMS if t.severity >= 0.8]
    mild = [F.lit(t.keyword) for t in DEFAULT_TERMS if t.severity < 0.8]
    return (
        F.when(F.arrays_overlap(F.array(*severe), found), "high_risk")
        .when(F.arrays_overlap(F.array(*mild), found), "medium_risk")
        .otherwise("low_risk")
    )


def rule_sentiment(text: Column, found: Column) -> Column:
    """More negative than positive words: ``negative``; the other way round: ``positive``."""
    negative = F.size(words.listed(NEGATIVE_WORDS, found))
    positive = F.size(words.listed(POSITIVE_WORDS, found))
    return (
        F.when(negative > positive, "negative")
        .when(negative < positive, "positive")
        .otherwise("neutral")
    )


def rule_entities(text: Column, found: Column) -> Column:
    """Struct of the seven entities: the first word that stands for each, NULL if none occurs."""
    fields = [
        F.get(words.listed(lexicon, found), F.lit(0)).alias(entity)
        for entity, lexicon in ENTITY_WORDS.items()
    ]
    return F.struct(*fields)


def entity_names(entities: Column) -> Column:
    """Array of the names of the entities present."""
    names = [F.when(entities[name].isNotNull(), F.lit(name)) for name in ENTITY_WORDS]
    return F.array_compact(F.array(*names))


def has_text() -> Column:
    """Whether a claim has notes or a description."""
    return F.col("adjuster_notes").isNotNull() | F.col("loss_description").isNotNull()


def classify_claims(
    claims: DataFrame,
    label: Classifier = rule_label,
    sentiment: Classifier = rule_sentiment,
    entities: Classifier = rule_entities,
    method: str = "rules",
    textless: bool = False,
) -> DataFrame:
    """Label, entities and sentiment of each claim's whole text, with score and flag derived.

    The built-in classifiers are word rules; a model plugs in as a pandas UDF on the text with the
    same signature. Claims with neither notes nor description are left out, unless ``textless`` keeps
    them (judged as an empty text); :func:`has_text` tells them apart.
    """
    notes, description = F.col("adjuster_notes"), F.col("loss_description")
    blank = F.lit("")
    text = F.concat_ws(" | ", F.coalesce(notes, blank), F.coalesce(description, blank))
    found = F.col("_found")
    judged = claims if textless else claims.filter(has_text())
    analysed = words.with_results(
        words.with_keywords_found(judged, text, _RULE_WORDS),
        {
            "risk_category": label(text, found),
            "extracted_risks": entities(text, found),
            "claim_sentiment": sentiment(text, found),
        },
    )
    negative = F.col("claim_sentiment") == "negative"
    level = F.col("risk_category")
    base = F.when(level == "high_risk", 1.0).when(level == "medium_risk", 0.5).otherwise(0.1)
    boost = F.when(negative, 0.2).otherwise(0.0)
    return analysed.withColumns(
        {
            "risk_score": F.least(F.lit(1.0), base + boost),
            "high_risk_flag": (level == "high_risk") | ((level == "medium_risk") & negative),
            "risk_keywords": entity_names(F.col("extracted_risks")),
            "_analysis_method": F.lit(method),
        }
    ).drop("_lowered", "_found")


# --- summaries -------------------------------------------------------------------------------


def risk_summary(
    scored: DataFrame,
    group_by: Sequence[str] = ("origin_year", "loss_type"),
    flag: str = "high_risk_flag",
    detail: str = "score",
) -> DataFrame:
    """Counts, scores and incurred amounts per group.

    ``detail`` selects the extra columns: ``"score"`` the mean score, ``"indicator"`` the mean of
    the flag itself (for pattern flags), ``"classified"`` the mean score plus level and sentiment
    counts. The last two publish percentages with two decimals (and the mean score with four), as
    the reports built on them expect; ``"score"`` is left unrounded.
    """
    high = F.col(flag)
    folds = {
        "total_claims": F.count(F.lit(1)),
        "high_risk_claims": count_when(high),
        "total_incurred": F.sum("incurred_amount"),
        "high_risk_incurred": sum_when(high, "incurred_amount"),
    }
    if detail == "indicator":
        folds["avg_risk_indicator"] = F.avg(F.when(high, 1.0).otherwise(0.0))
    elif detail in ("score", "classified"):
        score = F.avg("risk_score")
        folds["avg_risk_score"] = F.round(score, 4) if detail == "classified" else score
    else:
        raise ValueError(f"unknown detail {detail!r}")
    if detail == "classified":
        level, mood = F.col("risk_category"), F.col("claim_sentiment")
        folds["medium_risk_claims"] = count_when(level == "medium_risk")
        folds["low_risk_claims"] = count_when(level == "low_risk")
        for name in ("negative", "positive", "neutral"):
            folds[f"{name}_sentiment_count"] = count_when(mood == name)
    summary = scored.groupBy(*group_by).agg(*[c.alias(name) for name, c in folds.items()])
    shares = {
        "high_risk_pct": ratio("high_risk_claims", "total_claims") * 100,
        "high_risk_incurred_pct": ratio("high_risk_incurred", "total_incurred") * 100,
    }
    if detail != "score":
        shares = {name: F.round(share, 2) for name, share in shares.items()}
    return summary.withColumns(shares)


def flag_emerging_risks(
    scored: DataFrame, threshold: float = 0.5, min_incurred: float = 50_000.0
) -> DataFrame:
    """Claims with a high score, or a large amount with at least half the threshold score."""
    score = F.col("risk_score")
    large = (F.col("incurred_amount") >= min_incurred) & (score >= threshold * 0.5)
    return scored.filter((score >= threshold) | large).withColumn(
        "risk_priority", band(score, EMERGING_PRIORITY, "LOW")
    )


def risk_by_category(scored: DataFrame) -> DataFrame:
    """Claims, mean score and exposure per category other than low_risk."""
    return (
        scored.filter(F.col("risk_category") != "low_risk")
        .groupBy("risk_category")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.avg("risk_score").alias("avg_severity"),
            F.sum("incurred_amount").alias("total_exposure"),
        )
    )


def risk_entity_breakdown(classified: DataFrame, as_of: dt.date) -> DataFrame:
    """Occurrences and exposure per entity and loss type, with this and last year's claims.

    A claim lists an entity once, so claim rows are first folded per claim; what remains of the
    distinct counts are then plain sums over one row per claim and entity.
    """
    exploded = classified.select(
        "claim_id",
        "origin_year",
        "loss_type",
        "incurred_amount",
        F.explode("risk_keywords").alias("risk_entity"),
    )
    per_claim = exploded.groupBy("risk_entity", "loss_type", "claim_id", "origin_year").agg(
        F.count(F.lit(1)).alias("occurrences"), F.sum("incurred_amount").alias("incurred")
    )
    year = F.col("origin_year")
    folded = per_claim.groupBy("risk_entity", "loss_type").agg(
        F.sum("occurrences").alias("occurrence_count"),
        F.count(F.lit(1)).alias("affected_claims"),
        F.sum("incurred").alias("total_exposure"),
        count_when(year == as_of.year).alias("current_year_claims"),
        count_when(year == as_of.year - 1).alias("prior_year_claims"),
    )
    return folded.withColumn(
        "avg_claim_amount", F.round(ratio("total_exposure", "occurrence_count"), 2)
    )


def high_risk_detail(classified: DataFrame, as_of: dt.date) -> DataFrame:
    """High-risk claims with a review priority and the days since the loss."""
    return classified.filter("high_risk_flag").withColumns(
        {
            "review_priority": band(F.col("risk_score"), REVIEW_PRIORITY, "LOW"),
            "days_since_loss": F.date_diff(F.lit(as_of), "loss_date"),
        }
    )


def litigation_watch_list(classified: DataFrame) -> DataFrame:
    """Claims with a litigation or attorney entity."""
    entities = F.col("risk_keywords")
    involved = F.array_contains(entities, "litigation_risk") | F.array_contains(
        entities, "attorney_involvement"
    )
    return classified.filter(involved).withColumns(
        {
            "litigation_details": F.col("extracted_risks.litigation_risk"),
            "attorney_details": F.col("extracted_risks.attorney_involvement"),
        }
    )


def portfolio_findings(scored: DataFrame) -> DataFrame:
    """One row of portfolio totals, from a single aggregation."""
    high = F.col("high_risk_flag")
    totals = scored.agg(
        F.count(F.lit(1)).alias("total_claims"),
        count_when(high).alias("high_risk_claims"),
        F.coalesce(F.sum("incurred_amount"), F.lit(0.0)).alias("total_incurred"),
        F.coalesce(sum_when(high, "incurred_amount"), F.lit(0.0)).alias("high_risk_incurred"),
    )
    return totals.withColumns(
        {
            "high_risk_pct": ratio("high_risk_claims", "total_claims") * 100,
            "high_risk_incurred_pct": ratio("high_risk_incurred", "total_incurred") * 100,
        }
    )
