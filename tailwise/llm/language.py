"""Language of a text by a string kernel: blended n-gram presence, Nyström landmarks, ridge regression.

Two passages are as alike as the n-grams (1 to 4 letters) present in both, weighted by length and
normalised. Kernel ridge regression, one language against the rest, runs in the space of a few hundred
landmark passages (Nyström); landmarks and solution collapse into one matrix, so a block of passages is
scored by one matrix product. A text is scored over all its passages, each by its letters.

The classifier is fitted on a bounded sample of labelled rows (``PER_LANGUAGE`` texts of each language,
in one task); scoring is a map over Arrow batches without a shuffle.
"""

from __future__ import annotations

import functools
import hashlib
import io
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, returning

PER_LANGUAGE = 400  # labelled texts a language
LANDMARKS = 96  # landmark passages a language
TRAIN_PASSAGES = 8  # passages of a sampled text used in fitting, drawn over the whole of it
PASSAGE = 2_000  # letters and word gaps a passage
BLOCK = 64  # passages a matrix product
RIDGE = 1e-2
UNKNOWN = "und"

# Hashed positions for the n-grams of each length, and their weight in the blend.
BITS = (10, 12, 13, 14)
WEIGHTS = (0.5, 1.0, 1.5, 1.5)
STARTS = tuple(int(x) for x in np.cumsum([0] + [1 << b for b in BITS]))
SIZE = STARTS[-1]
GAP = 32


@functools.cache
def _letters() -> np.ndarray:
    """Code point to itself if it is a letter, else to the gap."""
    table = np.full(0x110000, GAP, dtype=np.uint32)
    for point in range(0x110000):
        if not 0xD800 <= point < 0xE000 and chr(point).isalpha():
            table[point] = point
    return table


@functools.cache
def _blend() -> np.ndarray:
    return np.concatenate([np.full(1 << b, w, dtype=np.float32) for b, w in zip(BITS, WEIGHTS)])


def points(text: str) -> np.ndarray:
    """Letters of the lower-cased text, every run of other characters as one gap."""
    mapped = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    keep = np.ones(len(mapped), dtype=bool)
    keep[1:] = (mapped[1:] != GAP) | (mapped[:-1] != GAP)
    return mapped[keep]


def presence(passages: list[np.ndarray]) -> np.ndarray:
    """One row per passage: 1 where a hashed n-gram occurs."""
    made = np.zeros((len(passages), SIZE), dtype=np.float32)
    for row, passage in zip(made, passages):
        key = passage * np.uint32(0x9E3779B1)
        for n, bits in enumerate(BITS):
            if n:
                if len(passage) <= n:
                    break
                key = (key[:-1] ^ (key[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + passage[n:] * np.uint32(0x9E3779B1)
            row[STARTS[n] + (key * np.uint32(0xC2B2AE35) >> np.uint32(32 - bits))] = 1.0
    return made


def features(passages: list[np.ndarray]) -> np.ndarray:
    """Presence rows whose dot products are the normalised kernel."""
    made = presence(passages)
    made *= np.sqrt(_blend())
    made /= np.maximum(np.sqrt(np.einsum("ij,ij->i", made, made)), 1e-9)[:, None]
    return made


def passages_of(text: str) -> list[np.ndarray]:
    """The whole text in passages; none if it has no letter."""
    whole = points(text)
    if not len(whole) or (whole == GAP).all():
        return []
    return np.array_split(whole, max(1, round(len(whole) / PASSAGE)))


def _drawn(n: int, most: int, key: bytes) -> np.ndarray:
    """At most ``most`` of n places in order, drawn by a hash of the key."""
    seed = int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little")
    return np.arange(n) if n <= most else np.sort(np.random.default_rng(seed).choice(n, most, replace=False))


class Model:
    """Languages in order, and the matrix that turns features into one-against-rest scores."""

    def __init__(self, languages: list[str], matrix: np.ndarray, offset: np.ndarray):
        self.languages, self.matrix, self.offset = languages, matrix, offset

    @classmethod
    def fit(cls, texts: list[str], languages: list[str]) -> Model:
        """Ridge regression on Nyström features; ``texts`` are the bounded sample."""
        names = sorted(set(languages))
        blocks, targets = [], []
        for text, language in zip(texts, languages):
            whole = passages_of(text)
            found = [whole[i] for i in _drawn(len(whole), TRAIN_PASSAGES, text.encode("utf-8", "surrogatepass"))]
            blocks += found
            targets += [names.index(language)] * len(found)
        if not blocks:
            return cls([], np.zeros((SIZE, 0), np.float32), np.zeros(0, np.float32))
        targets = np.array(targets)
        own = [np.flatnonzero(targets == c) for c in range(len(names))]
        chosen = np.concatenate([places[_drawn(len(places), LANDMARKS, name.encode())] for name, places in zip(names, own)])
        landmarks = features([blocks[i] for i in chosen])
        values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
        whiten = vectors / np.sqrt(np.maximum(values, 1e-6))
        share = 1.0 / np.bincount(targets, minlength=len(names))
        gram = np.zeros((len(chosen), len(chosen)))
        moment = np.zeros((len(chosen), len(names)))
        mean, mean_y, mass = np.zeros(len(chosen)), np.zeros(len(names)), 0.0
        for start in range(0, len(blocks), BLOCK):
            part = slice(start, start + BLOCK)
            near = (features(blocks[part]) @ landmarks.T).astype(np.float64) @ whiten
            goal = np.where(targets[part, None] == np.arange(len(names)), 1.0, -1.0)
            weight = share[targets[part]][:, None]
            gram += (near * weight).T @ near
            moment += (near * weight).T @ goal
            mean += (near * weight).sum(0)
            mean_y += (goal * weight).sum(0)
            mass += weight.sum()
        mean, mean_y = mean / mass, mean_y / mass
        gram -= mass * np.outer(mean, mean)
        moment -= mass * np.outer(mean, mean_y)
        solution = np.linalg.solve(gram + RIDGE * np.eye(len(chosen)), moment)
        matrix = landmarks.T.astype(np.float64) @ (whiten @ solution)
        return cls(names, matrix.astype(np.float32), (mean_y - mean @ solution).astype(np.float32))

    def scores(self, passages: list[np.ndarray]) -> np.ndarray:
        """One-against-rest scores (about -1 to 1), block by block."""
        parts = [features(passages[s : s + BLOCK]) @ self.matrix + self.offset for s in range(0, len(passages), BLOCK)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)), np.float32)

    def predict(self, texts: Iterable[str], n_texts: int) -> tuple[list[str], list[float], list[float]]:
        """Language, its share of the score, and the largest raw score of any passage.

        ``und``, 0 and -1 without a letter. Texts are taken one by one.
        """
        names, shares = [], []
        cut, owner, sizes = [], [], []
        totals = np.zeros((n_texts, max(1, len(self.languages))))
        weight = np.zeros(n_texts)
        raw = np.full(n_texts, -1.0)

        def flush() -> None:
            if cut and self.languages:
                scores = self.scores(cut)
                np.maximum.at(raw, owner, scores.max(1))
                likely = np.clip((scores + 1) / 2, 1e-3, 1)
                np.add.at(totals, owner, likely / likely.sum(1, keepdims=True) * np.array(sizes)[:, None])
            np.add.at(weight, owner, sizes)
            cut.clear(), owner.clear(), sizes.clear()

        for n, text in enumerate(texts):
            for passage in passages_of(text):
                cut.append(passage)
                owner.append(n)
                sizes.append(len(passage))
                if len(cut) >= BLOCK:
                    flush()
        flush()
        for total, mass in zip(totals, weight):
            best = int(total.argmax())
            known = mass > 0 and self.languages
            names.append(self.languages[best] if known else UNKNOWN)
            shares.append(float(min(1.0, total[best] / mass)) if known else 0.0)
        return names, shares, raw.tolist()

    def dump(self) -> bytes:
        held = io.BytesIO()
        np.savez(held, languages=np.array(self.languages, dtype="U"), matrix=self.matrix, offset=self.offset)
        return held.getvalue()

    @classmethod
    def load(cls, content: bytes) -> Model:
        held = np.load(io.BytesIO(content))
        return cls([str(x) for x in held["languages"]], held["matrix"], held["offset"])


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, seed: int = 5) -> bytes:
    """A model from (doc_id, text, lang) rows; rows with a null language are left out.

    Its size depends on the number of languages alone (about 120 kB each).
    """
    known = labelled.filter(F.col("lang").isNotNull())
    chosen = bounded_sample(known.select("doc_id", "lang"), "lang", per_language, seed)
    # At most per_language rows for each language: small by that bound.
    texts = known.join(F.broadcast(chosen.distinct()), ["doc_id", "lang"], "left_semi")
    texts = texts.select(F.coalesce("text", F.lit("")).alias("text"), "lang", "doc_id")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            rows += zip(batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist(), batch.column("text").to_pylist())
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
        model = Model.fit([r[2] for r in rows], [r[1] for r in rows])
        yield pa.RecordBatch.from_arrays([pa.array([model.dump()], pa.binary())], names=["model"])

    fitted = texts.repartition(1).mapInArrow(train, "model binary").collect()
    return fitted[0]["model"] if fitted else Model.fit([], []).dump()


def predict(docs: DataFrame, model: bytes, text_col: str = "text", raw_col: str | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1), from the whole text alone.

    A text that is null, empty or without a letter gives ``und`` and 0, as does a model fitted on no
    labelled text. Languages that tie go by name. ``raw_col`` names one more column: the largest
    one-against-rest score of any passage, -1 where the language is ``und``. Every row, repeated or not,
    gives one row; all other columns stay, so the new names must not be among them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    place = names.index(text_col)
    added = ["lang_pred", "score"] + ([raw_col] if raw_col else [])
    schema = docs.withColumns({c: F.lit("") if c == "lang_pred" else F.lit(0.0) for c in added}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model.load(shared.value)
        for batch in batches:
            languages, *scores = fitted.predict((t.as_py() or "" for t in batch.column(place)), batch.num_rows)
            made = [pa.array(languages, pa.string()), *[pa.array(s, pa.float64()) for s in scores]][: len(added)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*names, *added])

    return docs.mapInArrow(returning(run), schema)
