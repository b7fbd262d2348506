"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. Marks. From a bounded sample of labelled rows, words and word beginnings that are found in toxic
   texts beyond chance, and those found beyond chance in others.
2. Voters. Lexicons (a short general one and groups of marks) and patterns vote toxic, clean or
   nothing on each sampled text.
3. Label model. Expectation maximisation estimates every voter's accuracy given the unseen label, and
   the correlations between voters beyond it; correlated voters share their weight. Its posterior is
   the training label.
4. Classifier. Logistic regression on the presence of marks and on a few proportions, fitted to the
   posterior. It alone scores texts, whole, without their votes or labels.

Counting marks and voting run on all tasks; marks, vote rows and weights, bounded by parameters, meet
on the driver. Scoring is a map over Arrow batches without a shuffle.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, bounded_sample, one_row_barrier

PER_LABEL = 8_000  # sampled texts of each label
MARKS = 2_000  # marks of each direction
BEYOND_CHANCE = 30.0  # log-likelihood ratio of a mark
PRECISE = 0.9  # share of toxic texts among those with a lexicon mark
GROUPS = 8  # lexicons a kind of mark is dealt into
BEGINNINGS = (4, 5, 6)
ROUNDS = 40
THRESHOLD = 0.3

# Common insults of English, the general lexicon.
INSULTS = {
    "idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown",
    "dumb", "fool", "garbage", "ugly", "vermin", "filth", "imbecile", "jerk", "creep", "freak",
}

WORDS = re.compile(r"[^\W\d_]+")
CAPITALS = re.compile(r"[A-Z]")


def marks_of(word: str) -> list[str]:
    """A word and its beginnings, as marks."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) >= n)]


def proportions(text: str, n_words: int) -> list[float]:
    """Shares that say something about tone: exclamations, capitals, and whether there is text at all."""
    size = max(1, len(text))
    return [min(1.0, 20 * text.count("!") / size), len(CAPITALS.findall(text)) / size, 1.0 if n_words else 0.0]


PROPORTIONS = 3


def _count_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per mark the toxic and other texts of a batch that hold it."""
    for batch in batches:
        toxic, other = Counter(), Counter()
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            found = set()
            for word in set(WORDS.findall(text.lower())):
                found.update(marks_of(word))
            (toxic if label else other).update(found)
        names = list(toxic.keys() | other.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([toxic[n] for n in names], pa.int64()), pa.array([other[n] for n in names], pa.int64())],
            names=["mark", "n_toxic", "n_other"],
        )


class Voters:
    """The voters as columns of a vote row: 1 toxic, -1 clean, 0 nothing."""

    def __init__(self, lexicon: dict[str, int], other: set[str]):
        self.lexicon, self.other = lexicon, other  # mark to its group; marks of other texts
        self.n_groups = 1 + max(lexicon.values(), default=-1)
        self.n = self.n_groups + 6

    def vote(self, text: str) -> np.ndarray:
        words = WORDS.findall(text.lower())
        marks = set()
        for word in set(words):
            marks.update(marks_of(word))
        votes = np.zeros(self.n, dtype=np.int8)
        hits = [m for m in marks if m in self.lexicon]
        for mark in hits:
            votes[self.lexicon[mark]] = 1
        general = sum(word in INSULTS for word in words)
        times = sum(any(m in self.lexicon for m in marks_of(word)) for word in words) if hits else 0
        g = self.n_groups
        votes[g] = 1 if general else 0
        votes[g + 1] = 1 if general > 1 else -1 if not general and not hits else 0
        votes[g + 2] = 1 if times >= 2 else -1 if times == 0 else 0
        votes[g + 3] = 1 if times * 50 >= max(1, len(words)) and times else -1 if not times else 0
        votes[g + 4] = -1 if len(marks & self.other) > 2 and not hits else 0
        votes[g + 5] = 1 if hits and text.count("!") > 2 else 0
        return votes


class LabelModel:
    """Accuracies of voters given an unseen label, and correlations that remain.

    ``table[y, j, v]`` is the probability that voter j votes v (-1, 0, 1) on a text of label y. A voter
    whose votes go with others' even within a label counts for the less the more they do.
    """

    def __init__(self, votes: np.ndarray, weights: np.ndarray, prior: float):
        n, m = votes.shape
        self.prior = prior
        self.correlation = np.eye(m)
        # Voters that always vote alike are one voter from the start.
        deviation = np.maximum(votes.std(axis=0), 1e-9)
        centred = (votes - votes.mean(axis=0)) / deviation
        alike = np.maximum(centred.T @ centred / max(1, n) > 0.95, np.eye(m, dtype=bool))
        self.sharing = 1.0 / alike.sum(axis=1)
        hot = np.stack([(votes == v).astype(np.float64) for v in (-1, 0, 1)], axis=2)
        lean = votes @ self.sharing
        posterior = np.where(lean > 0, 0.9, np.where(lean < 0, 0.02, prior))
        for step in range(ROUNDS):
            self.table = np.empty((2, m, 3))
            for y, share in ((0, 1 - posterior), (1, posterior)):
                mass = share * weights
                self.table[y] = (np.tensordot(mass, hot, axes=(0, 0)) + 0.5) / (mass.sum() + 1.5)
            if step % 10 == 9:
                self._correlate(votes, weights, posterior)
            self.prior = float(np.clip(np.average(posterior, weights=weights), 1e-4, 1 - 1e-4))
            posterior = self.posterior(votes)
        self.accuracy = self.table[1, :, 2], self.table[0, :, 0]

    def _correlate(self, votes: np.ndarray, weights: np.ndarray, posterior: np.ndarray) -> None:
        values = np.array([-1.0, 0.0, 1.0])
        expected = self.table @ values
        covariance = np.zeros_like(self.correlation)
        for y, share in ((0, 1 - posterior), (1, posterior)):
            mass = (share * weights)[:, None]
            residual = votes - expected[y]
            covariance += (residual * mass).T @ residual
        deviation = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
        self.correlation = covariance / np.outer(deviation, deviation)
        self.sharing = 1.0 / np.maximum(1.0, np.maximum(self.correlation, 0).sum(1))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        ratio = np.log(self.table[1]) - np.log(self.table[0])
        voters = np.arange(votes.shape[1])
        logit = math.log(self.prior / (1 - self.prior)) + (ratio[voters, votes + 1] * self.sharing).sum(1)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _logistic(rows: list[np.ndarray], dense: np.ndarray, goal: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Weights of presence features, proportions and intercept: full-batch Adam, ridge-penalised."""
    place = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    theta = np.zeros(n + PROPORTIONS + 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    design = np.column_stack([dense, np.ones(len(rows))])
    weights = weights / weights.sum()
    for step in range(1, 301):
        score = np.bincount(place, theta[column], minlength=len(rows)) + design @ theta[n:]
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - goal) * weights
        gradient = np.concatenate([np.bincount(column, error[place], minlength=n), error @ design])
        gradient[:-1] += 1e-5 * theta[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta


def one_of_copies(sample: DataFrame) -> DataFrame:
    """One row per label and smallest hash of three words, so that copies do not count as evidence again."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))
    rows = one_row_barrier(sample, _words=words)
    places = F.sequence(F.lit(1), F.size("_words") - 2)
    least = F.array_min(F.transform(places, lambda i: F.xxhash64(F.slice("_words", i, 3))))
    keyed = rows.withColumn("_key", F.when(F.size("_words") > 2, least).otherwise(F.xxhash64("text"))).drop("_words")
    kept = keyed.groupBy("_key", "toxic").agg(F.min(F.struct("doc_id", "text")).alias("_row"))
    return kept.select("_row.doc_id", "_row.text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, seed: int = 4) -> bytes:
    """A classifier from (doc_id, text) and (doc_id, toxic) rows; null labels are left out.

    The sample is drawn on identifiers and labels; only its own texts are fetched. With no row, or rows of one label only, the classifier gives the share of toxic rows.
    """
    known = labels.filter(F.col("toxic").isNotNull()).select("doc_id", "toxic")
    rows = docs.select("doc_id").join(known, "doc_id")
    totals = {r["toxic"]: r["n"] for r in rows.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    if len(totals) < 2:
        return pickle.dumps(({}, np.array([0.0] * PROPORTIONS + [30.0 if prior else -30.0])))
    ids = bounded_sample(rows, "toxic", per_label, seed).distinct()
    # At most per_label rows of each label: small by that bound.
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    sample = sample.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    sample = one_of_copies(sample).repartition(12, "doc_id").persist()
    taken = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_other = taken.get(1, 0), taken.get(0, 0)

    counts = sample.mapInArrow(_count_marks, "mark string, n_toxic long, n_other long")
    counts = counts.groupBy("mark").agg(F.sum("n_toxic").alias("a"), F.sum("n_other").alias("b"))
    share = n_toxic / max(1, n_toxic + n_other)
    both, expected = F.col("a") + F.col("b"), (F.col("a") + F.col("b")) * share
    term = lambda k, e: F.when(k > 0, k * F.log(k / e)).otherwise(0.0)
    counts = counts.withColumn("beyond", 2 * (term(F.col("a"), expected) + term(F.col("b"), both - expected)))
    counts = counts.filter(F.col("beyond") > BEYOND_CHANCE).withColumn("toxic", F.col("a") > expected)
    best = lambda side: counts.filter(side).orderBy(F.desc("beyond"), "mark").limit(MARKS).collect()
    toxic, other = best(F.col("toxic")), best(~F.col("toxic"))

    kind = lambda mark: len(mark) - 1 if mark.endswith("*") else 0
    odds = (1 - prior) * n_toxic / (prior * max(1, n_other))  # undoes the sampling by label
    precise = [r["mark"] for r in toxic if r["a"] >= PRECISE * (r["a"] + r["b"] * odds)]
    kinds = sorted({kind(m) for m in precise})
    lexicon = {m: kinds.index(kind(m)) * GROUPS + place % GROUPS for place, m in enumerate(precise)}
    voters = Voters(lexicon, {r["mark"] for r in other if not r["mark"].endswith("*")})
    index = {mark: n for n, mark in enumerate([*precise, *(r["mark"] for r in other)])}

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes, marks, shares = [], [], []
            for text in batch.column("text").to_pylist():
                words = set(WORDS.findall(text.lower()))
                votes.append(voters.vote(text).tobytes())
                marks.append(sorted({index[m] for w in words for m in marks_of(w) if m in index}))
                shares.append(proportions(text, len(words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(votes, pa.binary()), pa.array(marks, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float64()))],
                names=["doc_id", "toxic", "votes", "marks", "shares"],
            )

    described = sample.mapInArrow(describe, "doc_id long, toxic int, votes binary, marks array<int>, shares array<double>").collect()
    sample.unpersist()
    described.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["votes"]))
    votes = np.array([np.frombuffer(r["votes"], np.int8) for r in described]).astype(np.int64)
    # Weights restore the share of toxic rows that sampling by label changed.
    weights = np.array([prior / max(1, n_toxic) if r["toxic"] else (1 - prior) / max(1, n_other) for r in described])
    posterior = LabelModel(votes, weights / weights.mean(), prior).posterior(votes)
    found = [np.array(r["marks"], dtype=np.int64) for r in described]
    theta = _logistic(found, np.array([r["shares"] for r in described]), posterior, weights, len(index))
    return pickle.dumps(({m: float(theta[n]) for m, n in index.items()}, theta[len(index) :]))


class Scorer:
    """The linear classifier on whole texts; words already seen are remembered up to a bound."""

    REMEMBERED = 200_000

    def __init__(self, content: bytes):
        self.weight, self.rest = pickle.loads(content)
        self.seen: dict[str, tuple[str, ...]] = {}

    def _marks(self, word: str) -> tuple[str, ...]:
        found = self.seen.get(word)
        if found is None:
            found = tuple(m for m in marks_of(word) if m in self.weight)
            if len(self.seen) >= self.REMEMBERED:
                self.seen.clear()
            self.seen[word] = found
        return found

    def score(self, text: str) -> float:
        words = set(WORDS.findall(text.lower()))
        marks: set[str] = set()
        for word in words:
            found = self._marks(word)
            if found:
                marks.update(found)
        total = sum(self.weight[m] for m in sorted(marks)) + float(np.dot(proportions(text, len(words)), self.rest[:-1])) + float(self.rest[-1])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def score(docs: DataFrame, model: bytes, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Add the toxicity of the whole text, 0 to 1.

    A null text is scored as the empty one. Every row, repeated or not, gives one row; all other columns
    stay; ``score_col`` must be a new name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    place = names.index(text_col)
    schema = docs.withColumn(score_col, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            made = pa.array([scorer.score(t.as_py() or "") for t in batch.column(place)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*names, score_col])

    return docs.mapInArrow(run, schema)
