"""Preparation of a training corpus in stages, each written and read again by the next.

Language identification, exact copies, near copies, mixing of sources, tokens. Every stage takes all rows
that the one before kept; all but the last return the columns they are given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tailwise.llm import bpe, exact, language, mix, near
from tailwise.llm.common import fold, read_table, small_batches
from tailwise.llm.queries import MAX_EPOCHS, WEIGHTS, vocabulary_path
from tailwise.session import materialise

# A text without a passage that scores above this, one language against the rest (about -1 to 1), is in no
# language that was learned. Other passages and the number of languages do not change a passage's scores.
LEAST_PASSAGE_SCORE = -0.3

# A worker that encodes or decodes holds several batches and the numbers of their texts.
TOKEN_BATCHES = "6m"

# SQL cannot train the language classifier of the first stage.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage in a language learned from the labelled ones; texts without a letter go."""
    small_batches(spark)
    model = language.fit(docs.filter(fold(F.col("doc_id"), 5) != 0).select("doc_id", "text", "lang"))
    others = [c for c in docs.columns if c != "text"]
    guessed = language.predict(docs.select(F.struct(*others).alias("others"), "text"), model, raw_col="raw")
    kept = guessed.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("raw") > LEAST_PASSAGE_SCORE))
    return kept.select(*[F.col("text") if c == "text" else F.col("others")[c].alias(c) for c in docs.columns])


def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest identifier stays."""
    small_batches(spark)
    return exact.without_duplicates(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    small_batches(spark)
    return near.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mix.mixed_documents(docs, WEIGHTS, MAX_EPOCHS)


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token numbers of every document, and whether they decode to its text."""
    small_batches(spark, TOKEN_BATCHES)
    vocabulary = bpe.read_vocabulary(vocabulary_path())
    text = F.coalesce("text", F.lit(""))
    # The text goes through once; its digest tells whether it came back.
    rows = docs.select("doc_id", "lang", "source", "n_chars", _digest(text).alias("digest"), text.alias("text"))
    # Both maps in one job take two workers a task, which Spark keeps for later stages while it is busy; with
    # the numbers written between the maps one worker a task is enough.
    encoded = materialise(bpe.encode(rows, vocabulary), "tokens-encoded")
    done = bpe.decode(encoded, vocabulary)
    return done.select(
        "doc_id", "lang", "source", "n_chars", bpe.n_tokens(F.col("ids")).alias("n_tokens"), "ids", (_digest(F.col("decoded")) == F.col("digest")).alias("round_trip")
    )


STAGES = [
    ("language", known_language),
    ("exact copies", no_exact_copies),
    ("near copies", no_near_copies),
    ("mix", mixed),
    ("tokens", tokenised),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
