"""Quality by naive Bayes support vectors: n-gram indicators scaled by class evidence, a linear hinge loss.

1. Indicators. A text shows which n-grams it holds: 1 to 4 neighbouring bytes, and words and pairs of words
   (runs of letters lower-cased, their spelling hashed), each as a bucket of a fixed hash table. Two, three
   and four equal words in a row also have buckets that do not depend on the word.
2. Log-count ratios. A bounded sample of each label's texts is counted: r = log((p + 1) / sum(p + 1)) -
   log((q + 1) / sum(q + 1)), with p and q the texts of either class that show an indicator. The sample is
   drawn on identifiers, so only its own texts are fetched; counts are summed within tasks first.
3. Support vectors. The sample's texts give rows of r in the place of the indicators they show; dual
   coordinate descent fits the hinge loss, each class weighted to count alike.
4. Probability. Margins of texts held out in the fit's own folds give a logistic curve, with the classes in
   their true shares.

Scoring is a map over Arrow batches without a shuffle: a sum of weights over the buckets a text shows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import bounded_sample, returning

BITS = 18  # buckets of the hash table
BYTE_GRAMS = (1, 2, 3, 4)
REPEATS = 3  # n-grams of one word repeated, whichever it is, have buckets of their own from 2 words on
PER_LABEL = 4_000  # sampled texts of each label
INDICATORS = 1 << 14  # buckets that the sample's rows keep: those with the most evidence
BEYOND_CHANCE = 10.8  # log-likelihood ratio of a bucket that is kept
COST = 1.0  # of a unit of hinge loss in a class, over the weights' norm
PASSES = 15
FOLDS = 2
THRESHOLD = 0.3

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
PIECE = 1 << 20  # bytes of a text that are looked at together; neighbours overlap


def _buckets(values: np.ndarray, kind: int) -> np.ndarray:
    """Hash numbers of one kind into the table."""
    return (((values + np.uint64(kind)) * _MULTIPLIER) >> np.uint64(64 - BITS)).astype(np.int64)


class Indicators:
    """Marks the buckets of a text, piece by piece, so that memory does not grow with the text."""

    def __init__(self):
        self.shown = np.zeros(1 << BITS, dtype=bool)

    def of(self, text: bytes) -> np.ndarray:
        """The buckets that the text shows, in order."""
        self.shown[:] = False
        start = 0
        while start < len(text):
            end = start + PIECE
            if end < len(text):  # cut between words where there is a space
                space = text.rfind(b" ", start + PIECE // 2, end)
                end = space + 1 if space >= 0 else end
            self._mark(np.frombuffer(text, np.uint8, min(end, len(text)) - start, start))
            if end < len(text):  # the byte n-grams across the border
                self._byte_grams(np.frombuffer(text, np.uint8, min(end + 3, len(text)) - max(0, end - 3), max(0, end - 3)))
            start = end
        return np.flatnonzero(self.shown)

    def _byte_grams(self, data: np.ndarray) -> None:
        grams = data.astype(np.uint64)
        for n in BYTE_GRAMS:
            if n > 1:
                if len(grams) < 2:
                    return
                grams = (grams[:-1] << np.uint64(8)) | data[n - 1 :]
            self.shown[_buckets(grams, n << 40)] = True

    def _mark(self, data: np.ndarray) -> None:
        self._byte_grams(data)
        inside = _IN_WORD[data]
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        starts = edges[::2]
        if not len(starts):
            return
        # A word's hash: bytes times powers of an odd number, summed; the powers begin again at each word.
        place = np.arange(len(data), dtype=np.int64)
        lengths = np.diff(np.append(edges, len(data)) if len(edges) % 2 else edges)[::2]
        first = np.zeros(len(data), dtype=np.int64)
        first[starts] = starts
        offset = (place - np.maximum.accumulate(first)) & 63
        terms = np.where(inside, (_LOWER[data].astype(np.uint64) + np.uint64(1)) * _POWERS[offset], np.uint64(0))
        words = np.add.reduceat(terms, starts) + lengths.astype(np.uint64)
        self.shown[_buckets(words, 5 << 40)] = True
        if len(words) > 1:
            self.shown[_buckets(words[:-1] * _MULTIPLIER ^ words[1:], 6 << 40)] = True
            again = words[1:] == words[:-1]
            for n in range(2, 2 + REPEATS):
                if not again.any():
                    break
                self.shown[_buckets(np.array([n], dtype=np.uint64), 7 << 40)] = True
                again = again[1:] & again[:-1]


with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(64, 0xD6E8FEB86659FD93, dtype=np.uint64))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of either class show each bucket, over a whole task."""
    seen, counts, indicators = np.zeros(2, dtype=np.int64), np.zeros((2, 1 << BITS), dtype=np.int64), Indicators()
    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("label").to_pylist()):
            counts[label][indicators.of(text.as_py().encode())] += 1
            seen[label] += 1
    some = np.flatnonzero(counts.any(axis=0))
    bucket = np.append(some, -1)  # -1: the number of texts
    yield pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), *(pa.array(np.append(counts[c][some], seen[c]), pa.int64()) for c in (0, 1))],
        names=["bucket", "n_0", "n_1"],
    )


def ratios(counts: np.ndarray) -> np.ndarray:
    """Log-count ratio of every bucket from the (2, buckets) counts of the classes, smoothed by one."""
    smooth = counts + 1.0
    share = smooth / smooth.sum(axis=1, keepdims=True)
    return np.log(share[1]) - np.log(share[0])


def evidence(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of every bucket against independence of the classes."""
    both = counts.sum(axis=0)
    out = np.zeros(counts.shape[1])
    for c in (0, 1):
        for observed, whole in ((counts[c], both), (totals[c] - counts[c], totals.sum() - both)):
            expected = whole * totals[c] / max(1, totals.sum())
            out += 2 * np.where(observed > 0, observed * np.log(np.maximum(observed, 1e-300) / np.maximum(expected, 1e-300)), 0)
    return out


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, goal: np.ndarray, cost: np.ndarray, passes: int = PASSES) -> np.ndarray:
    """Weights (the last is the intercept) of the hinge loss over rows of scaled indicators.

    ``rows`` are places into ``scale``; ``goal`` is -1 or 1; ``cost`` bounds each row's dual variable. One
    dual variable is optimised at a time, in a seeded order, and the weights follow.
    """
    weights = np.zeros(len(scale) + 1)
    dual = np.zeros(len(rows))
    values = [np.append(scale[r], 1.0) for r in rows]
    places = [np.append(r, len(scale)) for r in rows]
    norm = np.array([float(v @ v) for v in values])
    drawn = np.random.default_rng(11)
    for _ in range(passes):
        moved = 0.0
        for i in drawn.permutation(len(rows)).tolist():
            gradient = goal[i] * float(weights[places[i]] @ values[i]) - 1.0
            updated = min(max(dual[i] - gradient / norm[i], 0.0), cost[i])
            step = updated - dual[i]
            if step:
                dual[i] = updated
                weights[places[i]] += step * goal[i] * values[i]
                moved = max(moved, abs(step))
        if moved < 1e-4 * cost.max():
            break
    return weights


def _logistic_curve(margin: np.ndarray, label: np.ndarray, mass: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the probability of label 1 by the margin: Newton steps on a penalised likelihood."""
    theta, design = np.array([1.0, 0.0]), np.column_stack([margin, np.ones(len(margin))])
    # Targets off 0 and 1, so that separable margins give a finite slope.
    target = np.where(label == 1, 1 - 1 / (label.sum() + 2), 1 / ((1 - label).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        gradient = design.T @ (mass * (p - target)) + 1e-3 * theta
        curve = (design * (mass * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        theta = theta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 1e-3)), float(theta[1])


def fit_rows(rows: list[np.ndarray], scale: np.ndarray, label: np.ndarray, prior: float) -> tuple[np.ndarray, float, float]:
    """(weights, slope, offset) from sampled rows; ``prior`` is the true share of label 1."""
    goal = np.where(label == 1, 1.0, -1.0)
    shares = np.array([max(1, int((label == c).sum())) for c in (0, 1)])
    cost = COST / shares[label]
    fold = np.arange(len(rows)) % FOLDS
    margin = np.zeros(len(rows))
    for f in range(FOLDS):
        learn, left = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        weights = dual_coordinate_descent([rows[i] for i in learn], scale, goal[learn], cost[learn])
        margin[left] = [scale[rows[i]] @ weights[rows[i]] + weights[-1] for i in left]
    mass = np.where(label == 1, prior, 1 - prior) / shares[label] * len(rows)
    slope, offset = _logistic_curve(margin, label, mass)
    return dual_coordinate_descent(rows, scale, goal, cost), slope, offset


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_label: int = PER_LABEL, seed: int = 11) -> bytes:
    """A classifier from (doc_id, text) and (doc_id, label) rows; rows with a null label are left out.

    It is fitted to at most ``per_label`` rows of each label, whose whole texts are read; their rows of at most
    INDICATORS places each meet on the driver. A label above 0 is 1. Null texts count as
    empty. With no row, or rows of one label only, the classifier gives the share of label 1.
    """
    known = labels.filter(F.col(label_col).isNotNull()).select("doc_id", (F.col(label_col) > 0).cast("int").alias("label"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = docs.select("doc_id").join(known, "doc_id")
    shares = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    prior = shares.get(1, 0) / max(1, sum(shares.values()))
    if len(shares) < 2:
        return pickle.dumps((np.zeros(1 << BITS, dtype=np.float32), 30.0 if prior else -30.0, 1.0, 0.0))
    ids = bounded_sample(rows, "label", per_label, seed).distinct()
    # At most per_label rows of each label: small by that bound.
    sample = materialise(texts.join(F.broadcast(ids), "doc_id").select("doc_id", "label", "text"), "quality-sample")
    counted = sample.mapInArrow(returning(_count), "bucket int, n_0 long, n_1 long")
    table = counted.groupBy("bucket").agg(F.sum("n_0").alias("n_0"), F.sum("n_1").alias("n_1")).toArrow()
    counts, totals = np.zeros((2, 1 << BITS)), np.zeros(2)
    bucket = table.column("bucket").to_numpy()
    for c in (0, 1):
        n = table.column(f"n_{c}").to_numpy()
        counts[c][bucket[bucket >= 0]] = n[bucket >= 0]
        totals[c] = n[bucket < 0].sum()
    beyond = evidence(counts, totals)
    best = np.argsort(-beyond, kind="stable")[:INDICATORS]
    chosen = np.sort(best[beyond[best] > BEYOND_CHANCE])
    place = np.full(1 << BITS, -1, dtype=np.int32)
    place[chosen] = np.arange(len(chosen))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators = Indicators()
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                found = place[indicators.of(text.as_py().encode())]
                rows.append(found[found >= 0].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())], names=["doc_id", "label", "row"])

    taken = sample.mapInArrow(describe, "doc_id long, label int, row binary").collect()
    taken.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["label"], r["row"]))
    rows = [np.frombuffer(r["row"], np.int32) for r in taken]
    weights, slope, offset = fit_rows(rows, ratios(counts)[chosen], np.array([r["label"] for r in taken]), prior)
    whole = np.zeros(1 << BITS, dtype=np.float32)
    whole[chosen] = weights[:-1] * ratios(counts)[chosen]
    return pickle.dumps((whole, float(weights[-1]), slope, offset))


def score(docs: DataFrame, model: bytes, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Add the probability of label 1 of the whole text, 0 to 1.

    A null text is scored as the empty one, which has the intercept's probability; texts may be of any
    length. Every row, repeated or not, gives one row, so ties get equal scores; all other columns stay;
    ``score_col`` must not be among them (ValueError). An empty table gives an empty table.
    """
    if score_col in docs.columns:
        raise ValueError(f"column {score_col!r} is already there")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index(text_col)
    schema = docs.withColumn(score_col, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept, slope, offset = pickle.loads(shared.value)
        indicators = Indicators()
        for batch in batches:
            margins = [float(weights[indicators.of((t.as_py() or "").encode())].sum(dtype=np.float64)) + intercept for t in batch.column(at)]
            made = 1 / (1 + np.exp(-np.clip(slope * np.array(margins) + offset, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.float64())], names=[*names, score_col])

    return docs.mapInArrow(returning(run), schema)
