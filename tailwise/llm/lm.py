"""Language model scores: hashed maximum entropy with a class-factored softmax.

A word's leaf is the word itself (the most frequent ones), a bucket of words by their ending, the end
of the text, or the unknown word. Leaves in order of frequency form classes:

    P(word | history) = P(class | history) P(leaf | class, history) P(word | leaf)

The first two factors are softmaxes over hashed n-gram and skip features of the leaves before; the third
is the word's share of its leaf's training tokens, and 1 for a leaf of one word. All words known from
training and one unknown word add up to 1. A training word seen once was unknown to the rest of
the training texts, so it trains the unknown leaf.

Jobs: (1) texts become blocks of local word numbers, with the block's distinct words and their training
counts; (2) counts are added up per word, a row per block and word; (3) counts and leaves return to the
blocks, which then hold one byte a token and lie by training round; (4) in every round a fixed number of
workers make gradient steps over a fixed number of blocks, parameters are averaged per part, and the next
round goes on from there with a smaller step, so rounds grow with the input and cores do not matter; (5) blocks are scored in numpy batches. The vocabulary is only ever joined; the parameters (some
MB whatever the input) are all that is broadcast.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path, materialise
from .common import returning

BLOCK_BYTES = 16 << 20
WIDTH = 16  # classes, and leaves a class
BUCKETS = 64
UNKNOWN, END = 0, 1  # the first two leaves
TOP = WIDTH * WIDTH - BUCKETS - 2
LEAF_BITS = 8
ROWS = (1 << 15, 1 << 16)  # hashed parameter rows of the two softmaxes
# Places before the token whose leaves make up a feature.
CLASS_FEATURES = ((1,), (2,), (3,), (1, 2), (1, 3))
LEAF_FEATURES = ((1,), (2,), (3,), (1, 2))
OUTSIDE = WIDTH * WIDTH  # stands for the places before a text
ROUND_BLOCKS = 16  # blocks between two averages of the parameters ...
ROUND_WORKERS = 8  # ... and the workers that share them
SPREAD = 64  # tasks the workers of a round are dealt over
BATCH = 1 << 16
RATE = 0.25
PARTS = 32  # pieces a parameter table is averaged in


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to blocks of local word numbers, numbered by falling frequency."""
    made = TaskContext.get().partitionId() << 32
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + BLOCK_BYTES, side="right")))
            yield _block(batch.slice(start, stop - start), made)
            made += 1
            start = stop


def _block(batch: pa.RecordBatch, number: int) -> pa.RecordBatch:
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(batch.column("text").cast(pa.large_string())))
    lists = pc.ascii_split_whitespace(texts)
    empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
    lengths = np.where(empty, 0, pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = lists.filter(pa.array(~empty)).flatten().dictionary_encode()
    held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
    local = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = len(flat.dictionary)
    training = np.bincount(local[np.repeat(~held, lengths)], minlength=words)
    order = np.argsort(-np.bincount(local, minlength=words), kind="stable")
    rank = np.empty(words, dtype=np.int64)
    rank[order] = np.arange(words)
    # Bytes of one significance together: the high ones are mostly zero and compress away.
    planes = rank[local].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            one(batch.column("doc_id").to_pylist(), pa.int64()),
            one(held.tolist(), pa.bool_()),
            one(lengths, pa.int64()),
            pa.array([planes], pa.large_binary()).cast(pa.binary()),
            one(flat.dictionary.cast(pa.string()).take(pa.array(order)), pa.string()),
            one(training[order], pa.int64()),
        ],
        names=["block", "doc_ids", "held_out", "lengths", "planes", "words", "training"],
    )


BLOCK_SCHEMA = "block long, doc_ids array<long>, held_out array<boolean>, lengths array<long>, planes binary, words array<string>, training array<long>"


def _encode(leaf_mass: dict[int, int], n_tokens: int, n_types: int, n_docs: int):
    """A block and the counts and leaves of its words to one byte a token and the sums per text."""
    base_total = np.log10(n_tokens + n_types + 1.0)

    def run(block: pa.Table, known: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.table({name: pa.array([], kind) for name, kind in ENCODED})
        lengths = np.array(block.column("lengths")[0].as_py(), dtype=np.int64)
        held = np.array(block.column("held_out")[0].as_py(), dtype=bool)
        planes = np.frombuffer(block.column("planes")[0].as_py(), dtype=np.uint8)
        local = planes.reshape(4, -1).T.copy().view("<u4").ravel()
        n_words = block.column("n_words")[0].as_py()
        count, leaf = np.zeros(n_words, dtype=np.int64), np.zeros(n_words, dtype=np.int64)
        packed = known.column("place_leaf").to_numpy()
        place = packed >> LEAF_BITS
        count[place] = known.column("count").to_numpy()
        leaf[place] = packed & ((1 << LEAF_BITS) - 1)
        mass = np.array([leaf_mass.get(i, 0) for i in range(WIDTH * WIDTH)], dtype=np.float64)
        single = (leaf < 2 + TOP) | (count == 0)
        inside = np.where(single, 0.0, np.log10(np.maximum(count, 1) / np.maximum(mass[leaf], 1.0)))
        base = np.log10(count + 1.0)
        # Tokens with an end after every text.
        ends = np.cumsum(lengths + 1) - 1
        word = np.ones(len(local) + len(lengths), dtype=bool)
        word[ends] = False
        starts = ends - lengths

        def per_text(values: np.ndarray, at_end: float) -> np.ndarray:
            every = np.full(len(word), at_end)
            every[word] = values
            return np.add.reduceat(every, starts)

        leaves = np.full(len(word), END, dtype=np.uint8)
        leaves[word] = leaf[local]
        once = np.zeros(len(word), dtype=bool)
        once[word] = count[local] == 1
        known_end = 1.0 if n_docs else 0.0
        return pa.table(
            {
                "block": block.column("block"),
                "round": block.column("round"),
                "worker": block.column("worker"),
                "doc_ids": block.column("doc_ids"),
                "held_out": block.column("held_out"),
                "lengths": block.column("lengths"),
                "leaves": pa.array([leaves.tobytes()], pa.binary()),
                "once": pa.array([np.packbits(once).tobytes()], pa.binary()),
                "n_known": pa.array([per_text((count[local] > 0).astype(float), known_end)], pa.list_(pa.float64())),
                "inside": pa.array([per_text(inside[local], 0.0)], pa.list_(pa.float64())),
                "base": pa.array([per_text(base[local], np.log10(n_docs + 1.0)) - (lengths + 1) * base_total], pa.list_(pa.float64())),
            }
        )

    return run


ENCODED = [
    ("block", pa.int64()), ("round", pa.int32()), ("worker", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())),
    ("leaves", pa.binary()), ("once", pa.binary()), ("n_known", pa.list_(pa.float64())), ("inside", pa.list_(pa.float64())), ("base", pa.list_(pa.float64())),
]
ENCODED_SCHEMA = (
    "block long, round int, worker int, doc_ids array<long>, held_out array<boolean>, lengths array<long>, leaves binary, once binary, "
    "n_known array<double>, inside array<double>, base array<double>"
)


class Layout:
    """Where leaves sit: class and place in the class, by falling frequency; empty places are barred."""

    def __init__(self, mass: np.ndarray):
        order = np.argsort(-mass, kind="stable")
        at = np.empty(len(mass), dtype=np.int64)
        at[order] = np.arange(len(mass))
        self.group, self.place = (at // WIDTH).astype(np.int32), (at % WIDTH).astype(np.int32)
        ordered = mass[order].reshape(WIDTH, WIDTH)
        with np.errstate(divide="ignore"):
            self.class_bias = np.maximum(np.log(ordered.sum(1) / max(1.0, mass.sum())), -60).astype(np.float32)
            self.leaf_bias = np.maximum(np.log(ordered / np.maximum(ordered.sum(1, keepdims=True), 1e-9)), -60).astype(np.float32)


class Model:
    """The two parameter tables; without training it is the frequency of leaves."""

    def __init__(self, layout: Layout, tables: list[np.ndarray] | None = None):
        self.layout = layout
        self.tables = tables if tables is not None else [np.zeros((n, WIDTH), np.float32) for n in ROWS]

    @staticmethod
    def _rows(parts: list[np.ndarray], salt: int, n: int) -> np.ndarray:
        key = np.full(len(parts[0]), salt * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
        for part in parts:
            key = (key ^ part) * np.uint32(0x85EBCA6B)
            key ^= key >> np.uint32(13)
        return ((key * np.uint32(0xC2B2AE35)) >> np.uint32(32 - (n.bit_length() - 1))).astype(np.uint16)

    def features(self, leaves: np.ndarray, inside_text: np.ndarray, group: np.ndarray) -> tuple[list, list]:
        """Parameter rows of every token, for its class and for its leaf within the class."""
        before = {}
        for k in (1, 2, 3):
            shifted = np.full(len(leaves), OUTSIDE, dtype=np.uint32)
            shifted[k:] = leaves[:-k]
            shifted[inside_text < k] = OUTSIDE
            before[k] = shifted
        wanted = group.astype(np.uint32)
        first = [self._rows([before[k] for k in f], n + 1, ROWS[0]) for n, f in enumerate(CLASS_FEATURES)]
        second = [self._rows([before[k] for k in f] + [wanted], n + 101, ROWS[1]) for n, f in enumerate(LEAF_FEATURES)]
        return first, second

    def _softmax(self, which: int, rows: list[np.ndarray], bias: np.ndarray) -> np.ndarray:
        total = self.tables[which][rows[0]]
        for r in rows[1:]:
            total += self.tables[which][r]
        total += bias
        total -= total.max(axis=1, keepdims=True)
        np.exp(total, out=total)
        total /= total.sum(axis=1, keepdims=True)
        return total

    def forward(self, target: np.ndarray, rows: tuple[list, list]) -> tuple[np.ndarray, np.ndarray]:
        """Distributions over classes, and over the leaves of each target's class."""
        layout = self.layout
        return (
            self._softmax(0, rows[0], layout.class_bias),
            self._softmax(1, rows[1], layout.leaf_bias[layout.group[target]]),
        )

    def log10(self, leaves: np.ndarray, inside_text: np.ndarray) -> np.ndarray:
        """log10 P(leaf | history) of every token."""
        made = np.empty(len(leaves))
        group, place = self.layout.group, self.layout.place
        for start in range(0, len(leaves), BATCH):
            low = max(0, start - 3)
            part = slice(start - low, None)
            seen, inner = leaves[low : start + BATCH], inside_text[low : start + BATCH]
            rows = self.features(seen, inner, group[seen])
            rows = [r[part] for r in rows[0]], [r[part] for r in rows[1]]
            target = seen[part]
            classes, within = self.forward(target, rows)
            at = np.arange(len(target))
            chance = classes[at, group[target]].astype(np.float64) * within[at, place[target]]
            made[start : start + BATCH] = np.log10(np.maximum(chance, 1e-30))
        return made

    def train(self, leaves: np.ndarray, inside_text: np.ndarray, target: np.ndarray, pace: list[np.ndarray], rate: float = RATE) -> None:
        """Adagrad steps over the tokens of some texts, a batch at a time."""
        group, place = self.layout.group, self.layout.place
        for start in range(0, len(leaves), BATCH):
            low = max(0, start - 3)
            part = slice(start - low, None)
            goal = target[start : start + BATCH]
            shown = np.concatenate([leaves[low:start], goal])
            rows = self.features(leaves[low : start + BATCH], inside_text[low : start + BATCH], group[shown])
            rows = [r[part] for r in rows[0]], [r[part] for r in rows[1]]
            classes, within = self.forward(goal, rows)
            at = np.arange(len(goal))
            classes[at, group[goal]] -= 1
            within[at, place[goal]] -= 1
            for which, error in ((0, classes), (1, within)):
                for r in rows[which]:
                    order = np.argsort(r, kind="stable")
                    touched, first = np.unique(r[order], return_index=True)
                    gradient = np.add.reduceat(error[order], first, axis=0)
                    pace[which][touched] += gradient * gradient
                    self.tables[which][touched] -= rate * gradient / np.sqrt(pace[which][touched] + 1e-6)


def _positions(lengths: np.ndarray) -> np.ndarray:
    """Place of every token in its text."""
    sizes = lengths + 1
    starts = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) - np.repeat(starts, sizes)


def deal(blocks: list[int]) -> list[tuple[int, int, int]]:
    """(block, round, worker): blocks in a mixed order, the same number to every round and worker."""
    mixed = sorted(blocks, key=lambda b: hashlib.blake2b(str(b).encode(), digest_size=8).digest())
    rounds = -(-len(mixed) // ROUND_BLOCKS)
    return [(b, n % rounds, n // rounds % ROUND_WORKERS) for n, b in enumerate(mixed)]


def _trainer(shared, layout: Layout, rate: float):
    def learn(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        model = Model(layout, [t.copy() for t in shared.value])
        pace = [np.zeros_like(t) for t in model.tables]
        seen = 0
        for row in rows:
            lengths = np.array(row["lengths"].as_py(), dtype=np.int64)
            held = np.array(row["held_out"].as_py(), dtype=bool)
            taken = np.repeat(~held, lengths + 1)
            leaves = np.frombuffer(row["leaves"].as_py(), dtype=np.uint8)[taken]
            once = np.unpackbits(np.frombuffer(row["once"].as_py(), dtype=np.uint8), count=len(taken))[taken]
            target = np.where(once > 0, np.uint8(UNKNOWN), leaves)
            model.train(leaves, _positions(lengths[~held]), target, pace, rate)
            seen += len(leaves)
        if seen:
            for which, table in enumerate(model.tables):
                for part, values in enumerate(np.array_split(table, PARTS)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([which * PARTS + part], pa.int32()), pa.array([float(seen)]), pa.array([values.tobytes()], pa.binary())],
                        names=["part", "weight", "values"],
                    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ({name: batch.column(name)[n] for name in batch.schema.names} for batch in batches for n in range(batch.num_rows))
        for _, own in itertools.groupby(rows, key=lambda row: row["worker"].as_py()):
            yield from learn(own)

    return run


def _average(table: pa.Table) -> pa.Table:
    """The mean of one part over the workers, weighted by their tokens."""
    weights = table.column("weight").to_numpy()
    total = sum(np.frombuffer(v.as_py(), np.float32).astype(np.float64) * w for v, w in zip(table.column("values"), weights))
    mean = (total / weights.sum()).astype(np.float32)
    return pa.table({"part": table.column("part")[:1], "values": pa.array([mean.tobytes()], pa.binary())})


def train(encoded: DataFrame, layout: Layout, rounds: int) -> list[np.ndarray]:
    """One pass over all training tokens in rounds; parameters are averaged after each round.

    Steps start from the rate over the root of the round, as the sums of squares of all rounds would have it.
    """
    spark = encoded.sparkSession
    model = Model(layout)
    needed = encoded.select("round", "worker", "block", "lengths", "held_out", "leaves", "once")
    for n in range(rounds):
        shared = spark.sparkContext.broadcast(model.tables)
        part = needed.filter(F.col("round") == n).drop("round")
        dealt = part.repartition(SPREAD, "worker").sortWithinPartitions("worker", "block")
        trainer = _trainer(shared, layout, RATE / (n + 1) ** 0.5)
        learned = dealt.mapInArrow(trainer, "part int, weight double, values binary")
        means = learned.groupBy("part").applyInArrow(_average, "part int, values binary").collect()
        shared.unpersist()
        if means:
            pieces = {r["part"]: np.frombuffer(r["values"], np.float32).reshape(-1, WIDTH) for r in means}
            model.tables = [np.concatenate([pieces[w * PARTS + p] for p in range(PARTS)]) for w in range(2)]
    return model.tables


def _scorer(shared, layout: Layout):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(layout, shared.value)
        for batch in batches:
            for row in range(batch.num_rows):
                lengths = np.array(batch.column("lengths")[row].as_py(), dtype=np.int64)
                leaves = np.frombuffer(batch.column("leaves")[row].as_py(), dtype=np.uint8)
                logs = model.log10(leaves, _positions(lengths))
                starts = np.cumsum(lengths + 1) - lengths - 1
                score = np.add.reduceat(logs, starts) + np.array(batch.column("inside")[row].as_py())
                known = np.array(batch.column("n_known")[row].as_py()).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_ids")[row].values,
                        batch.column("held_out")[row].values,
                        pa.array(lengths + 1),
                        pa.array(known),
                        batch.column("base")[row].values,
                        pa.array(score),
                    ],
                    names=names,
                )

    return run


def score(docs: DataFrame) -> DataFrame:
    """One row per row of (doc_id, text, held_out): token counts, unigram score and the model's score.

    Learning takes the rows that are not held out; a null ``held_out`` counts as held out. Columns: doc_id,
    held_out, n_tokens (words and one end), n_known, train_tokens, base_score (add-one unigram), score;
    both are log10 probabilities. Null, empty and blank texts are an end alone. Repeated rows count as
    often as they occur. Without any training row all words are unknown and the model is uniform
    over what is left. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("held_out", F.lit(True)).alias("held_out")
    )
    blocks = materialise(rows.mapInArrow(returning(_blocks), BLOCK_SCHEMA), "lm-blocks")

    heard = blocks.select(F.explode(F.arrays_zip("words", "training")).alias("w")).select(F.col("w.words").alias("word"), F.col("w.training").alias("n"))
    totals = heard.filter("n > 0").groupBy("word").agg(F.sum("n").alias("count"))
    totals = materialise(totals, "lm-counts")
    # A fixed number of words.
    top = [r["word"] for r in totals.orderBy(F.desc("count"), "word").limit(TOP).collect()]
    places = spark.createDataFrame([(w, 2 + n) for n, w in enumerate(top)], "word string, top int")
    bucket = F.lit(2 + TOP) + F.pmod(F.xxhash64(F.expr("right(word, 2)")), F.lit(BUCKETS)).cast("int")
    leafed = totals.join(F.broadcast(places), "word", "left").select("word", "count", F.coalesce("top", bucket).alias("leaf"))
    masses = leafed.groupBy("leaf").agg(F.sum("count").alias("all"), F.sum(F.when(F.col("count") == 1, 1).otherwise(0)).alias("once"), F.count("*").alias("n")).collect()
    trained = F.size(F.filter("held_out", lambda h: ~h))
    n_docs = blocks.agg(F.sum(trained)).first()[0] or 0
    leaf_mass = {r["leaf"]: r["all"] for r in masses}
    n_tokens = sum(leaf_mass.values()) + n_docs
    n_types = sum(r["n"] for r in masses) + (1 if n_docs else 0)
    mass = np.zeros(WIDTH * WIDTH)
    for r in masses:
        mass[r["leaf"]] = max(0.5, r["all"] - r["once"])
    mass[UNKNOWN], mass[END] = max(0.5, sum(r["once"] for r in masses)), max(0.5, n_docs)
    layout = Layout(mass)

    placed = blocks.select(F.col("block").alias("of"), F.posexplode("words").alias("place", "word"))
    packed = (F.col("place").cast("long") * (1 << LEAF_BITS) + F.col("leaf")).alias("place_leaf")
    known = placed.join(leafed, "word").select("of", packed, "count")
    # A number for every 16 MB of text.
    dealt = deal([r["block"] for r in blocks.select("block").collect()])
    rounds = 1 + max((n for _, n, _ in dealt), default=-1)
    turns = F.broadcast(spark.createDataFrame(dealt, "block long, round int, worker int"))
    bare = blocks.select("block", "doc_ids", "held_out", "lengths", "planes", F.size("words").alias("n_words")).join(turns, "block")
    encoded = bare.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_encode(leaf_mass, n_tokens, n_types, n_docs), ENCODED_SCHEMA)
    # By round, so that a round reads its own blocks only.
    path = fresh_path(spark, "lm-encoded")
    encoded.write.partitionBy("round").parquet(path)
    encoded = spark.read.schema(encoded.schema).parquet(path)

    shared = spark.sparkContext.broadcast(train(encoded, layout, rounds))
    scored = encoded.mapInArrow(
        _scorer(shared, layout), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.withColumn("train_tokens", F.lit(n_tokens).cast("long"))
