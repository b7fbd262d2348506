"""The registered queries of the operators: production parameters, whole tables, full results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact, html, language, lm, mix, nbsvm, near, phrases, quality, runs, toxicity, urls
from .common import fold, read_table


def vocabulary_path() -> str:
    """Where the public vocabulary file is installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3

# The filter list, as given.
URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix of all documents takes of each."""
    taken = mix.mix(read_table(spark, sf_dir, "documents"), WEIGHTS, MAX_EPOCHS)
    return taken.select("doc_id", "size", "source_size", "target", "taken", "repeats", "part_words")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and their way back."""
    return bpe.digests(read_table(spark, sf_dir, "documents"), vocabulary_path())


def op3_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates and number of links of every document."""
    return near.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a quarter of the identifiers is held out of the learning."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out & F.col("doc_id").isNotNull())
    model = toxicity.fit(docs.select("doc_id", "text").filter(~held_out), labels)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a fifth of the identifiers is held out of the learning."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = language.fit(docs.filter(~held_out))
    guessed = language.predict(docs.select("doc_id", "text"), model)
    return guessed.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model and unigram score of every document; a seventh of the identifiers is held out of the learning."""
    docs = read_table(spark, sf_dir, "documents")
    scored = lm.score(docs.select("doc_id", "text", (fold(F.col("doc_id"), 7) == 2).alias("held_out")))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner and size of every document's group of equal texts."""
    return exact.exact_duplicates(read_table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    made = html.extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return made.withColumn("n_chars", F.length("text").cast("long"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdict of every document; its source is the host."""
    judged = quality.assess(read_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_left"
    )


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL.

    A page's outcome is the quality label of the document that its URL names by number.
    """
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract("url", r"/([0-9]{1,18})(?:[^0-9]|$)", 1)
    numbered = pages.select(urls.host_of(F.col("url")).alias("host"), F.when(number != "", number).cast("long").alias("doc_id"))
    labels = read_table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("bad"))
    outcomes = numbered.join(labels, "doc_id").select("host", "bad")
    return urls.judge(pages, URL_RULES, outcomes).select("page_id", "host", "path", "rule", "verdict")


def op11_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; a fifth of the identifiers is held out of the learning."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out & F.col("doc_id").isNotNull())
    model = nbsvm.fit(docs.filter(~held_out), labels)
    scored = nbsvm.score(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= nbsvm.THRESHOLD).cast("int").alias("predicted")
    )


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, a tenth of which is given a periodic end."""
    return runs.digests(read_table(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language."""
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_mix": op1_mix,
    "op2_bpe": op2_bpe,
    "op3_near_join": op3_near_join,
    "op4_toxicity": op4_toxicity,
    "op5_language": op5_language,
    "op6_lm": op6_lm,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_quality": op8_quality,
    "op9_html_text": op9_html_text,
    "op10_urls": op10_urls,
    "op11_nbsvm": op11_nbsvm,
    "op12_runs": op12_runs,
    "op13_phrases": op13_phrases,
}
