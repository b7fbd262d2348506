"""Near duplicates: the Jaccard join of word shingles by MinHash bands, verified exactly.

Every text becomes the set of its 5-word shingles. Texts with equal sets are one class with a number of
copies, so copies are never paired. Fixed banding stands in for an LSH forest: of each class every tree
(band) keeps a label of its MinHash values; no tries are kept. Two classes with the wanted similarity share a band of d values in at
least one of t trees with probability 1 - (1 - s^d)^t: d is the largest, up to a bound, that reaches the target
recall, one for all data, and classes that share a label meet.

A pair may meet in several trees; it is looked at in the first one only, which both sides' labels tell.
So no pair is ever a row: a unit of work is one label (or a pair of blocks of a frequent label), and it
returns for each class the number of its links and one edge of the unit's spanning forest. Units are
found on labels alone; only classes that have someone to meet in a unit send their text there, where
the shingle sets are compared exactly. Links of different texts are all counted, however many.

Classes of linked texts are the connected components of the spanning edges, found by label propagation
with pointer jumping; each round is written to the shared folder.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import maybe_among, returning, texts_of

SHINGLE = 5
SIMILARITY = 0.8
TREES = 32
FULL_PREFIX = 8
RECALL = 0.99999
BLOCK = 512  # classes of one label in a block
CHUNK = 1 << 19  # bytes of text hashed at a time

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def prefix_length(similarity: float = SIMILARITY, trees: int = TREES, recall: float = RECALL, full: int = FULL_PREFIX) -> int:
    """The longest prefix, shortened from ``full``, that reaches the target recall."""
    for length in range(full, 0, -1):
        if 1 - (1 - similarity**length) ** trees >= recall:
            return length
    raise ValueError("more trees are needed for this recall")


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    made = []
    for base in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
        powers = np.full(n, base, dtype=np.uint64)
        powers[0] = 1
        made.append(np.multiply.accumulate(powers))
    return made[0], made[1]


def _word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased) and the text each belongs to; ``starts`` are text offsets."""
    space = _SPACE[data]
    begin = np.empty(len(data), dtype=bool)
    begin[0] = True
    begin[1:] = space[:-1]
    begin[starts[starts < len(data)]] = True
    begin &= ~space
    first = np.flatnonzero(begin)
    stop = np.empty(len(data), dtype=bool)
    stop[-1] = True
    stop[:-1] = space[1:]
    inner = starts[(starts > 0) & (starts <= len(data))] - 1
    stop[inner] = True
    last = np.flatnonzero(stop & ~space)
    # Sum of byte * base^place over each word, brought to place 0 by the inverse power.
    powers, inverses = _powers(CHUNK) if len(data) <= CHUNK else _powers.__wrapped__(len(data))
    powers, inverses = powers[: len(data)], inverses[: len(data)]
    sums = np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)
    total = sums[last] - np.where(first > 0, sums[first - 1], np.uint64(0))
    words = _mix(total * inverses[first] + (last - first + 1).astype(np.uint64))
    return words, np.searchsorted(starts, first, side="right") - 1


def shingle_sets(offsets: np.ndarray, data: memoryview) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text.

    A text of one to four words has one shingle, all its words; a text without a word has none.
    """
    buffer = np.frombuffer(data, dtype=np.uint8)
    n, at = len(offsets) - 1, 0
    while at < n:
        to = at + 1
        while to < n and offsets[to + 1] - offsets[at] <= CHUNK:
            to += 1
        part = buffer[offsets[at] : offsets[to]]
        if not len(part):
            for _ in range(at, to):
                yield np.zeros(0, np.uint64)
            at = to
            continue
        # Empty texts share their offset with the next one, which owns the words.
        words, owner = _word_hashes(part, offsets[at:to] - offsets[at])
        bounds = np.searchsorted(owner, np.arange(to - at + 1))
        rolled = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
        for k in range(SHINGLE):
            rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + words[k : k + len(rolled)]
        rolled = _mix(rolled)
        for low, high in zip(bounds[:-1], bounds[1:]):
            if high - low >= SHINGLE:
                yield np.unique(rolled[low : high - SHINGLE + 1])
            elif high > low:
                short = np.array([high - low], dtype=np.uint64)
                for word in words[low:high]:
                    short = _mix(short * _BASE + word)
                yield short
            else:
                yield np.zeros(0, np.uint64)
        at = to


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a shingle set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


class Forest:
    """Prefix labels of signatures, one per tree."""

    def __init__(self, trees: int, length: int, seed: int = 3):
        draw = np.random.default_rng(seed)
        self.trees, self.length = trees, length
        self.flip = draw.integers(0, 1 << 32, trees * length, dtype=np.uint32)[:, None]
        self.odd = (draw.integers(0, 1 << 32, trees * length, dtype=np.uint32) | np.uint32(1))[:, None]

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        low = (shingles >> np.uint64(16)).astype(np.uint32)
        least = np.full(len(self.flip), 0xFFFFFFFF, dtype=np.uint32)
        for start in range(0, len(low), 4096):
            np.minimum(least, ((low[start : start + 4096] ^ self.flip) * self.odd).min(axis=1), out=least)
        return least

    def labels(self, signatures: np.ndarray) -> np.ndarray:
        """One 64-bit label per tree for every row of signatures."""
        parts = signatures.reshape(len(signatures), self.trees, self.length).astype(np.uint64)
        made = np.broadcast_to(np.arange(1, self.trees + 1, dtype=np.uint64), parts.shape[:2])
        for k in range(self.length):
            made = _mix(made * _BASE + parts[:, :, k])
        return made.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch], trees: int, length: int) -> Iterator[pa.RecordBatch]:
    forest = Forest(trees, length)
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, sizes, signatures = [], [], np.zeros((batch.num_rows, trees * length), np.uint32)
        for n, shingles in enumerate(shingle_sets(*texts_of(batch.column("text")))):
            keys.append(set_key(shingles))
            sizes.append(len(shingles))
            if len(shingles):
                signatures[n] = forest.signature(shingles)
        labels = forest.labels(signatures)
        listed = pa.ListArray.from_arrays(pa.array(np.arange(0, labels.size + 1, trees), pa.int32()), pa.array(labels.ravel()))
        ids, texts = batch.column("doc_id"), batch.column("text")
        unnumbered = pc.if_else(pc.is_null(ids), texts, pa.scalar(None, texts.type))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), listed, unnumbered],
            names=["doc_id", "set_key", "n_shingles", "labels", "unnumbered"],
        )


def in_units(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows sorted by ``names`` as one table per combination, across batches."""
    held, held_key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        change = np.zeros(batch.num_rows, dtype=bool)
        change[0] = True
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        bounds = [*np.flatnonzero(change), batch.num_rows]
        for low, high in zip(bounds[:-1], bounds[1:]):
            key = tuple(int(column[low]) for column in columns)
            if key != held_key and held:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(low, high - low))
    if held:
        yield held_key, pa.Table.from_batches(held)


UNIT = ["label", "block_a", "block_b"]


def _label_rows(table: pa.Table) -> np.ndarray:
    return table.column("labels").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)


def _new_pairs(labels: np.ndarray, tree: int, side: np.ndarray, apart: bool) -> np.ndarray:
    """Which pairs (i < j) meet here for the first time, as a square matrix of booleans."""
    n = len(labels)
    fresh = np.triu(np.ones((n, n), dtype=bool), 1)
    if apart:
        fresh &= side[:, None] != side[None, :]
    for earlier in range(tree):
        column = labels[:, earlier]
        fresh &= column[:, None] != column[None, :]
    return fresh


def _find_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep of every unit the classes that meet another one there for the first time."""
    made: list[pa.Table] = []
    rows = 0
    for (_, block_a, block_b), table in in_units(batches, UNIT):
        labels = _label_rows(table)
        side = table.column("side").to_numpy()
        fresh = _new_pairs(labels, table.column("tree")[0].as_py(), side, block_a != block_b)
        keep = fresh.any(axis=0) | fresh.any(axis=1)
        if keep.any():
            made.append(table.filter(pa.array(keep)).drop_columns(["labels"]))
            rows += made[-1].num_rows
        if rows > 5_000:
            yield from pa.concat_tables(made).combine_chunks().to_batches()
            made, rows = [], 0
    if made:
        yield from pa.concat_tables(made).combine_chunks().to_batches()


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    n = len(sets)
    made = np.zeros((n, n), dtype=np.float64)
    if n <= 6:
        for i in range(n):
            for j in range(i + 1, n):
                made[i, j] = made[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return made
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 2048
    for start in range(0, int(shared.sum()), width):
        low, high = np.searchsorted(column, [start, start + width])
        block = np.zeros((n, width), dtype=np.float32)
        block[owner[low:high], column[low:high] - start] = 1
        made += block @ block.T
    return made


def _verify_unit(table: pa.Table, apart: bool, similarity: float) -> pa.Table | None:
    """Links and spanning edges of one unit, from the whole texts."""
    text = table.column("text").combine_chunks()
    text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
    sets, places, known = [], [], set()
    keys = table.column("set_key").to_pylist()
    for n, shingles in enumerate(shingle_sets(*texts_of(text))):
        # Rows that share their identifier with a class's first document have another key.
        if set_key(shingles) == keys[n] and keys[n] not in known:
            known.add(keys[n])
            sets.append(shingles)
            places.append(n)
    if len(places) < 2:
        return None
    keys = [keys[p] for p in places]
    labels = _label_rows(table)[places]
    side = table.column("side").to_numpy()[places]
    copies = table.column("copies").to_numpy()[places]
    fresh = _new_pairs(labels, table.column("tree")[0].as_py(), side, apart)
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    both = overlaps(sets)
    # |A & B| >= s |A | B| in whole numbers, the threshold in thousandths.
    linked = fresh & (both * 1000 >= round(similarity * 1000) * (sizes[:, None] + sizes[None, :] - both))
    if not linked.any():
        return None
    linked |= linked.T
    n_links = linked @ copies
    # Spanning forest by breadth-first search; the smallest key of a tree is its root.
    root = np.full(len(keys), -1)
    for start in sorted(range(len(keys)), key=keys.__getitem__):
        if root[start] < 0 and n_links[start]:
            reached = np.zeros(len(keys), dtype=bool)
            edge = reached.copy()
            edge[start] = True
            while edge.any():
                reached |= edge
                edge = linked[edge].any(axis=0) & ~reached
            root[reached] = start
    some = np.flatnonzero(n_links)
    return pa.table(
        {
            "set_key": pa.array([keys[i] for i in some], pa.binary()),
            "n_links": pa.array(n_links[some], pa.int64()),
            "root": pa.array([keys[root[i]] for i in some], pa.binary()),
        }
    )


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, rows = [], 0
        for (_, block_a, block_b), table in in_units(batches, UNIT):
            found = _verify_unit(table, block_a != block_b, similarity)
            if found is not None:
                made.append(found)
                rows += found.num_rows
            if rows > 5_000:
                yield from pa.concat_tables(made).combine_chunks().to_batches()
                made, rows = [], 0
        if made:
            yield from pa.concat_tables(made).combine_chunks().to_batches()

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, component) from (a, b) edges: the component is its smallest node.

    Every round each node takes the smallest label among its neighbours and then its label's label;
    labels only shrink, and the rounds end when none does.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("next")).union(edges.select("b", "a"))
    both = materialise(both.distinct(), "near-edges")
    labels = both.groupBy("node").agg(F.least(F.min("next"), F.first("node")).alias("label"))
    labels = materialise(labels, "near-labels")
    while True:
        told = both.join(labels.withColumnRenamed("node", "next"), "next").groupBy("node").agg(F.min("label").alias("heard"))
        lower = labels.join(told, "node").select("node", "label", F.least("label", "heard").alias("lower"))
        above = labels.select(F.col("node").alias("lower"), F.col("label").alias("jump"))
        new = lower.join(above, "lower").select("node", F.least("lower", "jump").alias("new"), "label")
        new = materialise(new, "near-labels")
        labels = new.select("node", F.col("new").alias("label"))
        if new.filter(F.col("new") != F.col("label")).isEmpty():
            return labels.withColumnRenamed("label", "component")


def _classified(docs: DataFrame, similarity: float, trees: int, recall: float) -> DataFrame:
    """The rows of :func:`near_duplicates`, with ``class_key``, equal within a class, and the ``unnumbered`` texts."""
    length = prefix_length(similarity, trees, recall)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    signed = rows.mapInArrow(
        returning(lambda batches: _signed(batches, trees, length)),
        "doc_id long, set_key binary, n_shingles long, labels array<long>, unnumbered string",
    )
    signed = materialise(signed, "near-signed")
    classes = signed.filter("n_shingles > 0").groupBy("set_key").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("rep_id"), F.first("labels").alias("labels")
    )
    classes = materialise(classes, "near-classes")

    met = classes.select("set_key", F.posexplode("labels").alias("tree", "label"))
    met = met.withColumn("n", F.count("*").over(Window.partitionBy("label"))).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    met = met.withColumn("blocks", blocks).withColumn("side", F.pmod(F.hash("set_key"), "blocks").cast("int"))
    met = met.join(classes.select("set_key", "labels"), "set_key")
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(
        "label", F.least("side", "other").alias("block_a"), F.greatest("side", "other").alias("block_b"), "side", "tree", "set_key", "labels"
    )
    units = met.repartition(*UNIT).sortWithinPartitions(*UNIT)
    units = units.mapInArrow(returning(_find_units), "label long, block_a int, block_b int, side int, tree int, set_key binary")
    units = materialise(units, "near-units")

    wanted = materialise(units.select("set_key").distinct().join(classes, "set_key"), "near-wanted")
    # Texts move only where their identifier may be wanted.
    asked = maybe_among(rows, "doc_id", wanted.select("rep_id")).filter("_maybe").drop("_maybe")
    texts = asked.join(wanted.filter("rep_id IS NOT NULL").withColumnRenamed("rep_id", "doc_id"), "doc_id").drop("doc_id")
    # Classes without any identifier bring their text along, one of their equal sets.
    nameless = wanted.filter("rep_id IS NULL").drop("rep_id")
    own = signed.filter("doc_id IS NULL").join(nameless, "set_key", "left_semi").groupBy("set_key").agg(F.first("unnumbered").alias("text"))
    texts = texts.unionByName(nameless.join(own, "set_key"))
    ready = units.join(texts, "set_key").repartition(*UNIT).sortWithinPartitions(*UNIT)
    links = ready.mapInArrow(returning(_verify(similarity)), "set_key binary, n_links long, root binary")
    links = materialise(links, "near-links")

    joined = components(links.filter("set_key <> root").select(F.col("set_key").alias("a"), F.col("root").alias("b")))
    ids = classes.join(joined, classes["set_key"] == joined["node"]).groupBy("component").agg(F.min("rep_id").alias("class_id"))
    linked = joined.join(ids, "component").select(F.col("node").alias("set_key"), "class_id", "component")
    totals = links.groupBy("set_key").agg(F.sum("n_links").alias("far"))
    known = classes.select("set_key", "copies", "rep_id").join(linked, "set_key", "left").join(totals, "set_key", "left")
    known = known.select("set_key", F.coalesce("class_id", "rep_id").alias("class_id"), F.coalesce("component", "set_key").alias("class_key"), (F.coalesce("far", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return signed.join(known, "set_key", "left").select(
        "doc_id",
        F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "n_shingles",
        "class_key",
        "unnumbered",
    )


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its class of linked texts and how many it is linked to.

    Columns: ``doc_id``, ``class_id`` (the smallest doc_id of the class), ``n_links`` (other rows whose
    similarity is at least the threshold, copies included), ``n_shingles``. Words are compared with A-Z
    lower-cased. Null, empty and blank texts have no shingle and no link: their class is their own
    doc_id. Null identifiers are allowed; a class of nothing else has a null class_id. Repeated rows are
    copies of each other. Texts may be of any length; an empty table gives an empty result; other
    columns are ignored.
    """
    found = _classified(docs, similarity, trees, recall)
    return found.select("doc_id", "class_id", "n_links", "n_shingles")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each class stays, with all columns: the one whose identifier names the class.

    In a class without identifiers the row with the smallest text hash stays, and rows without identifier
    and shingle all stay. Identifiers must be unique within equal texts, and rows without one must differ in
    text: rows that repeat both stay or go together (take exact copies out first).
    """
    found = materialise(_classified(docs, SIMILARITY, TREES, RECALL), "near-found")
    kept = found.filter(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias("_kept")).distinct()
    # Identifiers of which no row goes stay without a shuffle of their texts.
    going = found.filter(F.col("doc_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("class_id"))).select("doc_id")
    told = maybe_among(docs, "doc_id", going)
    numbered = told.filter("NOT _maybe AND doc_id IS NOT NULL").drop("_maybe")
    numbered = numbered.unionByName(told.filter("_maybe").drop("_maybe").join(kept, F.col("doc_id") == F.col("_kept"), "left_semi"))
    digest = lambda text: F.sha2(F.coalesce(text, F.lit("")), 256)
    nameless = found.filter("doc_id IS NULL AND class_id IS NULL").withColumn("_digest", digest(F.col("unnumbered")))
    least = nameless.filter("n_shingles > 0").groupBy("class_key").agg(F.min("_digest").alias("_kept")).select("_kept")
    least = least.unionByName(nameless.filter("n_shingles = 0").select(F.col("_digest").alias("_kept"))).distinct()
    unnumbered = docs.filter(F.col("doc_id").isNull())
    return numbered.unionByName(unnumbered.join(least, digest(F.col("text")) == F.col("_kept"), "left_semi"))
