from collections import Counter

import pytest
from pyspark.sql import functions as F
from tailwise.llm import oracle, phrases
from tailwise.llm.queries import op13_phrases

from tests_compare import check_sql


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    check_sql(op13_phrases(spark, sf), sf, oracle.STATEMENTS["op13_phrases"])


def slow(rows, least, top):
    """Phrases of (lang, text) rows by counting every one of them."""
    table = str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {c: "\n" for c in ".,;:!?\n\x0b\x0c\r"})
    counts, totals = {}, Counter()
    for lang, text in rows:
        for piece in (text or "").translate(table).split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            totals[lang or "und"] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    key = (lang or "und", tuple(words[i : i + size]))
                    counts[key] = counts.get(key, 0) + 1
    frequent = {k: f for k, f in counts.items() if f >= least}
    out = {}
    for (lang, words), a in frequent.items():
        if len(words) < 2:
            continue
        within = [w for (other, w), f in frequent.items() if other == lang and len(w) > len(words) and f >= a]
        if any(w[i : i + len(words)] == words for w in within for i in range(len(w) - len(words) + 1)):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = frequent[lang, words[:k]], frequent[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words), left, right, totals[lang]))
    return {(lang, n + 1, p, -a, left, right, total, -s) for lang, found in out.items() for n, (s, a, p, left, right, total) in enumerate(sorted(found)[:top])}


TEXTS = [
    ("en", "New York is big, New York is far. new york!"),
    ("en", "the the the the the the\tthe the; the end of the end of the end"),
    ("en", "a b c d e f a b c d e f a b c d e f\na b c d e"),
    ("de", "the the the end; die Straße die Straße die STRASSE Ä ä Ä ä"),
    (None, "no language here, no language there. x"),
    ("en", None),
    ("en", ""),
    ("und", "no language here"),
    ("en", " \t \n. ,"),
    ("en", "\x1c odd \x00 \x00 odd \x1c odd \x00 \x00 odd"),
] * 2


@pytest.mark.parametrize("budget", [1, 5, 40, 1_000_000])
@pytest.mark.parametrize("least,top", [(2, 2000), (4, 5)])
def test_small_corpus_against_all_phrases(spark, budget, least, top):
    docs = spark.createDataFrame(TEXTS, "lang string, text string").withColumn("f", F.lit("clash")).repartition(3)
    got = phrases.collocations(docs, top, least, budget=budget)
    assert {tuple(r) for r in got.collect()} == slow(TEXTS, least, top)


def test_hot_pair_and_empty_tables(spark):
    rows = [("en", "of the " * 3000), ("en", "of the end " * 50)] * 3
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = {tuple(r) for r in phrases.collocations(docs, budget=500).collect()}
    assert got == slow(rows, 100, 2000)
    assert phrases.collocations(docs.limit(0)).collect() == []
    assert phrases.collocations(docs.select("lang", F.lit(None).cast("string").alias("text"))).collect() == []


def test_large_numbers_stay_exact(spark):
    row = spark.range(1).select(phrases._score(*(F.lit(v).cast("long") for v in (10**13, 9 * 10**16, 3 * 10**13, 10**13 + 1))).alias("s")).first()
    assert row.s == 1000 * 10**13 * 9 * 10**16 // (3 * 10**13 * (10**13 + 1))
