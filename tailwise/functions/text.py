"""Whole-word matching as native expressions: no Python worker sees the text.

A vocabulary is matched in one pass: the words of the text that are words of the vocabulary are
collected (usually none or a few), and everything else works on that short list.
Keywords of several words are confirmed on the text only if all their words occur.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vocabulary import Term

# A word boundary that treats accented letters as letters; the plain ones are looked at first.
_WORD_CHAR = r"[\w[\p{L}\p{N}]]"


def words_in(keyword: str) -> list[str]:
    """The words a keyword consists of, lower-cased."""
    return re.findall(r"\w+", keyword.lower())


def _whole(keyword: str) -> str:
    """Pattern for a keyword between boundaries; it begins with the plain text, which is searched fastest."""
    plain = re.escape(keyword)
    return f"{plain}(?<!{_WORD_CHAR}{plain})(?!{_WORD_CHAR})"


def words_present(lowered: Column, keywords: Iterable[str]) -> Column:
    """Array of the words of ``keywords`` that occur in the lower-cased text, in text order.

    The text is cut into words once and each is looked up among those wanted.
    """
    words = sorted({w for keyword in keywords for w in words_in(keyword.lower())})
    if not words:
        return F.array().cast("array<string>")
    shortest = min(map(len, words))
    written = F.regexp_extract_all(lowered, F.lit(f"{_WORD_CHAR}{{{shortest},}}+"), F.lit(0))
    return F.filter(written, lambda word: word.isin(words))


def phrases_present(lowered: Column, present: Column, keywords: Iterable[str]) -> Column:
    """Array with the keywords of several words that occur, NULL for those that do not."""
    confirmed = []
    for keyword in keywords:
        words = words_in(keyword.lower())
        if words == [keyword.lower()]:
            if keyword != keyword.lower():
                confirmed.append(F.when(F.array_contains(present, keyword.lower()), F.lit(keyword)))
            continue
        test = lowered.rlike(_whole(keyword.lower()))
        for word in words:
            test = F.array_contains(present, word) & test
        confirmed.append(F.when(test, F.lit(keyword)))
    return F.array(*confirmed).cast("array<string>")


def with_keywords_found(df: DataFrame, text: Column, keywords: Sequence[str]) -> DataFrame:
    """Add ``_lowered`` (the text in lower case) and ``_found`` (keywords and words in it)."""
    lowered, present = F.col("_lowered"), F.col("_present")
    searched = df.withColumn("_lowered", F.lower(F.coalesce(text, F.lit("")))).withColumn(
        "_present", words_present(lowered, keywords)
    )
    # A phrase needs its words, so a text without any of the words has nothing to look at.
    found = F.when(
        F.size(present) > 0, F.concat(present, phrases_present(lowered, present, keywords))
    ).otherwise(present)
    return searched.withColumn("_found", found).drop("_present")


def with_results(df: DataFrame, results: Mapping[str, Column]) -> DataFrame:
    """Add costly results through a one-row generator.

    Spark copies an expression into every filter it pushes below it, but does not push filters
    below a generator's output: a later filter on a score reads the score instead of searching the
    text again. The results are computed in a projection before it, so the generator only unpacks them.
    """
    row = F.struct(*[value.alias(name) for name, value in results.items()])
    return df.withColumn("_results", row).select(*df.columns, F.inline(F.array("_results")))


def listed(keywords: Iterable[str], found: Column) -> Column:
    """The keywords that were found, each once, in the order of ``keywords``."""
    return F.array_intersect(F.array(*[F.lit(k) for k in keywords]), found)


def has_any_substring(lowered: Column, parts: Iterable[str]) -> Column:
    """Substring test for any of ``parts``; NULL text gives FALSE."""
    found = F.lit(False)
    for part in parts:
        found = found | lowered.contains(part)
    return F.coalesce(found, F.lit(False))


def positions_of(matched: Column, terms: Sequence[Term]) -> Column:
    """Positions of matched keywords in the vocabulary."""
    keywords = F.array(*[F.lit(t.keyword) for t in terms])
    return F.transform(matched, lambda k: (F.array_position(keywords, k) - 1).cast("int"))


def _lookup(terms: Sequence[Term], field: str, position: Column) -> Column:
    return F.get(F.array(*[F.lit(getattr(t, field)) for t in terms]), position)


def score_of(positions: Column, terms: Sequence[Term]) -> Column:
    """Sum of the matched severities over 3, capped at 1."""
    total = F.aggregate(
        positions, F.lit(0.0), lambda acc, p: acc + _lookup(terms, "severity", p)
    )
    return F.least(F.lit(1.0), total / F.lit(3.0))


def category_of(positions: Column, terms: Sequence[Term]) -> Column:
    """Category of the most severe match; equal severities go to the category matched first."""
    blocks = [category for category, _ in groupby(terms, key=lambda t: t.category)]
    if len(blocks) == len(set(blocks)):
        best = _best_of_blocks(positions, terms, blocks)
    else:
        best = _best_of_mixed(positions, terms)
    return F.coalesce(best, F.lit("low_risk"))


def _best_of_blocks(positions: Column, terms: Sequence[Term], blocks: list[str]) -> Column:
    """Each category is one run of terms, so the order of first matches is the order of runs.

    Severity and run then rank the terms once and for all, and the best match is a maximum.
    """
    keys = sorted({(t.severity, -blocks.index(t.category)) for t in terms})
    ranks = F.array(*[F.lit(keys.index((t.severity, -blocks.index(t.category)))) for t in terms])
    categories = F.array(*[F.lit(blocks[-block]) for _, block in keys])
    return F.get(categories, F.array_max(F.transform(positions, lambda p: F.get(ranks, p))))


def _best_of_mixed(positions: Column, terms: Sequence[Term]) -> Column:
    """Terms of a category are scattered: the category's first match decides between equals."""
    categories = F.transform(positions, lambda p: _lookup(terms, "category", p))

    def candidate(p: Column) -> Column:
        category = _lookup(terms, "category", p)
        return F.struct(
            _lookup(terms, "severity", p).alias("severity"),
            (-F.array_position(categories, category)).alias("priority"),
            category.alias("category"),
        )

    return F.array_max(F.transform(positions, candidate))["category"]
