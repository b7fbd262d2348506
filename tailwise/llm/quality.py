"""Quality rules: word and symbol counts, and line frequency across documents. DataFrame functions only.

Per document, in one pass over its text: words, their characters, symbols, repeated lines, words in
repeated windows. Across documents, per host: every normalised line is hashed, the distinct
documents that hold it are counted (documents with equal texts count once: a document is no boilerplate
for having been copied), lines above the limit are taken out, and a document left with too little is
rejected. The limit is a number of documents, the same for a host of any size.

The per-document measures and the line hashes are written once, so the text is read once. Windows are
compared inside the row: hashes are sorted only in documents that repeat a window at all. Line counts
are folded by line and text before they meet by line, so a line that most documents hold arrives as
partial counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import WORD, one_row_barrier

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8

LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words
LINE_DOCS = 20  # a line that more documents of its host hold is above the limit
# A document needs this share of its words outside such lines.
WORDS_LEFT = 0.3


def normalised(line: Column) -> Column:
    """A line for comparison: lower case, spaces folded, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(line), SPACES, " "))


def _window_hashes(words: Column) -> Column:
    """A hash for every window of words, by place; empty if the text is shorter."""
    places = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.transform(places, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))


def _covered(places: Column) -> Column:
    """Words covered by windows that begin at the given places, in order."""
    following = F.slice(places, 2, F.greatest(F.size(places), F.lit(1)))
    steps = F.zip_with(places, following, lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, source, text) to counts and line hashes.

    Columns: row_id, doc_id, source, text_hash, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, lines (array of hash and words: the lines with a word, repeated ones too).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "source", text.alias("text"))
    rows = one_row_barrier(rows, words=F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), real_lines=F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)))
    rows = one_row_barrier(
        rows.select(
            "row_id", "doc_id", "source", "words", "real_lines", "text",
        ),
        text_hash=F.xxhash64("text"),
        word_chars=F.length(F.regexp_replace("text", SPACES, "")),
        n_symbols=F.regexp_count("text", F.lit(SYMBOLS)),
        windows=_window_hashes(F.col("words")),
        lines=F.transform("real_lines", lambda x: F.struct(F.xxhash64(normalised(x)).alias("hash"), F.regexp_count(x, F.lit(WORD)).alias("words"))),
    ).drop("text")
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("hash"), i.alias("place"))))
    rows = one_row_barrier(rows, ordered=F.when(repeated, ordered))
    neighbour = lambda k, step: F.get(F.col("ordered"), k + step)["hash"]
    twice = F.filter("ordered", lambda w, k: F.coalesce(w["hash"] == neighbour(k, 1), F.lit(False)) | F.coalesce(w["hash"] == neighbour(k, -1), F.lit(False)))
    rows = one_row_barrier(rows, places=F.array_sort(F.transform(twice, lambda w: w["place"])))
    return rows.select(
        "row_id",
        "doc_id",
        "source",
        "text_hash",
        F.size("words").cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("real_lines") - F.size(F.array_distinct("real_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("places")), F.lit(0)).cast("long").alias("n_repeat_words"),
        "lines",
    )


def frequent_lines(measured: DataFrame, line_docs: int) -> DataFrame:
    """(source, hash) of the lines above the limit of their host."""
    held = measured.select("source", "text_hash", F.explode(F.array_distinct(F.transform("lines", lambda x: x["hash"]))).alias("hash"))
    counts = held.groupBy("source", "hash", "text_hash").agg(F.lit(1).alias("one")).groupBy("source", "hash").agg(F.count("*").alias("n_docs"))
    return counts.filter(F.col("n_docs") > line_docs)


def assess(docs: DataFrame, line_docs: int = LINE_DOCS, words_left: float = WORDS_LEFT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source as the host, text) with counts and verdict.

    ``n_left`` are the words outside lines above the limit. A null or empty text has no words and fails;
    a null source is a host of its own; repeated rows are judged alike; texts may be of any length; an empty
    table gives an empty result; other columns are ignored.
    """
    measured = materialise(measures(docs), "quality-measures")
    frequent = frequent_lines(measured, line_docs).withColumnRenamed("source", "_s").withColumnRenamed("hash", "_h")
    lines = measured.select("row_id", "source", F.explode("lines").alias("line"))
    lines = lines.select("row_id", "source", F.col("line.hash").alias("hash"), F.col("line.words").alias("words"))
    met = lines.join(frequent, F.col("source").eqNullSafe(F.col("_s")) & (F.col("hash") == F.col("_h")))
    removed = met.groupBy("row_id").agg(F.sum("words").alias("n_removed"))
    judged = measured.drop("lines", "text_hash").join(removed, "row_id", "left").drop("row_id")
    judged = judged.withColumn("n_left", F.col("n_words") - F.coalesce("n_removed", F.lit(0))).drop("n_removed")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    enough = F.col("n_left") >= words_left * F.col("n_words")
    return judged.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & enough)
