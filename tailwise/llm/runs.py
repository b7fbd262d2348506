"""Periodic runs of words: stretches that repeat a block of words at least four times, found online.

A run of period q keeps every word equal to the word q places before it, that is, it matches on the
diagonal of lag q. Words are read in order; each lag that matches holds the place its match began, and one
word more lengthens it. A word's earlier occurrences open lags. When a lag stops matching, it is closed: a
match long enough, with no smaller period, is a run and is emitted at once.

The table of lags is sparse, and every lag left out is one that cannot become a run:

- A reportable match lasts at least GRAM words, so an occurrence counts if the next GRAM words are equal.
- A match begins where the words before differ (else it has begun earlier), so only occurrences after
  another word are looked at. Inside a periodic stretch, however long, there is none.
- A run of period q needs 3q further words; lags without that room, or that differ at places probed ahead,
  are not opened.
- A multiple of an open lag that begins the same stretch repeats with the smaller period and ends with it.

Searching is a map over Arrow batches without a shuffle; a document is one unit of work.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, one_row_barrier, returning

LEAST_WORDS = 6  # of a run
LEAST_TIMES = 4  # the period in a run
GRAM = 4  # words that an occurrence shares; a run of period 1 matches for 5 words, others for 6 or more

RUN = "struct<start: long, length: long, period: long>"
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _gram_codes(words: np.ndarray) -> np.ndarray:
    """A number per place for the GRAM words from there on, equal where these are; exact, not hashed."""
    codes = words
    for step in (1, 2):
        codes = np.unique(codes[:-step] * (codes.max() + 1) + codes[step:], return_inverse=True)[1]
    return codes


def _primitive(words: np.ndarray, start: int, period: int) -> bool:
    """Whether the block of the period is no repetition of a shorter block."""
    block = words[start : start + period]
    rest, divisor = period, 2
    while rest > 1:
        if divisor * divisor > rest:
            divisor = rest
        if rest % divisor == 0:
            shorter = period // divisor
            if np.array_equal(block[shorter:], block[:-shorter]):
                return False
            while rest % divisor == 0:
                rest //= divisor
        divisor += 1
    return True


class Diagonals:
    """The open lags of one text, and the runs emitted so far."""

    def __init__(self, words: np.ndarray):
        self.words, self.listed = words, words.tolist()
        self.open: dict[int, int] = {}  # lag to the place where its match began
        self.by_start: dict[int, list[int]] = {}  # first word of a stretch to its open lags
        self.runs: list[tuple[int, int, int]] = []

    def start(self, place: int, occurrences: Iterable[list[int]]) -> None:
        """Open the lags to earlier occurrences that can still become runs."""
        words = self.words
        # A match of 3q words from here must fit: q words back at most this far.
        least = place - (len(words) - place) // (LEAST_TIMES - 1)
        near = [listed[bisect_left(listed, least) :] for listed in occurrences if listed[-1] >= least]
        if not near:
            return
        lags = place - np.fromiter(chain.from_iterable(near), dtype=np.int64)
        for times in (3, 2, 1):
            ahead = place + times * lags - 1
            lags = lags[words[ahead] == words[ahead - lags]]
        for lag in np.sort(lags).tolist():
            stretch = self.by_start.setdefault(place - lag, [])
            if any(lag % other == 0 for other in stretch):
                continue
            stretch.append(lag)
            self.open[lag] = place

    def step(self, place: int) -> None:
        """Lengthen every open lag by the word at ``place``, or close it there."""
        words = self.listed
        word = words[place]
        for lag in [lag for lag in self.open if words[place - lag] != word]:
            self.close(lag, place)

    def close(self, lag: int, end: int) -> None:
        """The match of a lag ends before ``end``; emit it if it is a run."""
        start = self.open.pop(lag) - lag
        self.by_start[start].remove(lag)
        length = end - start
        if length >= max(LEAST_WORDS, LEAST_TIMES * lag) and _primitive(self.words, start, lag):
            self.runs.append((start, length, lag))


def find(words: np.ndarray) -> list[tuple[int, int, int]]:
    """The runs of a text as (start, length, period), by start, then period. Words are numbers from 0."""
    n = len(words)
    if n < LEAST_WORDS:
        return []
    codes = _gram_codes(words)
    repeated = np.bincount(codes)[codes] > 1
    places = np.flatnonzero(repeated)
    if not len(places):
        return []
    lags = Diagonals(words)
    listed = lags.listed
    seen: dict[int, dict[int, list[int]]] = {}  # gram to the word before it to places
    numbers = codes.tolist()
    upcoming = places.tolist()
    at = 0
    place = upcoming[0]
    while place < n:
        if lags.open:
            lags.step(place)
        if at < len(upcoming) and upcoming[at] == place:
            at += 1
            before = listed[place - 1] if place else -1
            known = seen.setdefault(numbers[place], {})
            if len(known) > (before in known):
                lags.start(place, (earlier for other, earlier in known.items() if other != before))
            known.setdefault(before, []).append(place)
        if lags.open or at == len(upcoming):
            place += 1
        else:
            place = upcoming[at]
        if not lags.open and at == len(upcoming):
            break
    for lag in list(lags.open):
        lags.close(lag, n)
    return sorted(lags.runs, key=lambda run: (run[0], run[2]))


def words_of(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """The words of a text, and each as a number that equal words share."""
    words = text.split()
    numbers: dict[bytes, int] = {}
    return words, np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of runs and the first period of each, joined by one space."""
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    if kept.all():
        return b" ".join(words)
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def find_runs(docs: DataFrame, text_col: str = "text", runs_col: str = "runs", collapsed_col: str = "collapsed") -> DataFrame:
    """Add the runs of every text, an array by start and period, and the text without their repetitions.

    A null, empty or blank text has no run and collapses to the empty text. Every row, repeated or not,
    gives one row; all other columns stay; the new names must not be among them (ValueError). Texts may be
    of any length: work grows with it, memory is a few numbers a word. Equal runs cannot occur: two runs
    of one text differ in start or period. An empty table gives an empty table.
    """
    for name in (runs_col, collapsed_col):
        if name in docs.columns:
            raise ValueError(f"column {name!r} is already there")
    names = docs.columns
    at = names.index(text_col)
    schema = docs.select("*", F.lit(None).cast(f"array<{RUN}>").alias(runs_col), F.lit("").alias(collapsed_col)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, collapsed = [], []
            for text in batch.column(at):
                words, numbers = words_of((text.as_py() or "").encode())
                found = find(numbers)
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                collapsed.append(collapse(words, found).decode())
            made = [pa.array(runs, pa.list_(RUN_TYPE)), pa.array(collapsed, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*names, runs_col, collapsed_col])

    return docs.mapInArrow(returning(run), schema)


def greatest(runs: Column) -> Column:
    """The run with the greatest length / period, exactly; ties go to the smallest start, then period."""

    def order(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        later = (a["start"] > b["start"]) | ((a["start"] == b["start"]) & (a["period"] > b["period"]))
        return F.when(left > right, -1).when(left < right, 1).when(later, 1).otherwise(-1)

    return F.get(F.array_sort(runs, order), 0)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents' words, a tenth of them with a periodic end that follows from doc_id.

    With h = crc32(doc_id) and h % 10 = 0, words from the place h // 10 % n on repeat the p words from there.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    changed = docs.filter(h % 10 == 0).select("doc_id", words.alias("_words"))
    changed = one_row_barrier(changed, _n=F.size("_words").cast("long"), _g=F.floor(h / 10).cast("long"))
    n, g = F.col("_n"), F.col("_g")
    changed = changed.withColumn("_a", F.when(n > 0, g % n).otherwise(0))
    changed = changed.withColumn("_p", F.lit(1) + F.floor((n - F.col("_a")) / (3 + g % 8)).cast("long"))
    repeated = F.transform(
        F.col("_words"),
        lambda word, i: F.when(i < F.col("_a"), word).otherwise(F.get("_words", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int"))),
    )
    return docs.filter(h % 10 != 0).select("doc_id", "text").unionByName(changed.select("doc_id", F.array_join(repeated, " ").alias("text")))


def digests(docs: DataFrame) -> DataFrame:
    """Per document the number of runs, the greatest one, and digests of all runs and of the collapsed text."""
    found = find_runs(with_planted_runs(docs.select("doc_id", "text")))
    listed = F.concat_ws("", F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])))
    best = F.col("_best")
    made = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        greatest(F.col("runs")).alias("_best"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return made.select(
        "doc_id",
        "n_runs",
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
