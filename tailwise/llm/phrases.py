"""Collocations: frequent phrases of 2 to 5 words and their association, by partitioned suffix trees.

Counts come from suffix trees over words, cut at five words and partitioned vertically, so that no tree
covers the corpus:

1. Buckets. One pass counts words and pairs of neighbouring words in hash buckets, an upper bound of every
   word's and pair's count; a second one counts triples whose pairs are frequent. A phrase that is frequent
   enough lies in buckets that are, so a suffix may be cut where a pair's or triple's bucket is not. One
   bit a bucket is sent to the tasks; the number of buckets follows the corpus up to PAIR_BUCKETS, beyond
   which fewer suffixes are cut and the result is the same.
2. Prefix groups. The buckets of first words are packed into groups within a budget of suffixes. A first
   word above the budget is extended: its suffixes are dealt by their first two words, and those of a pair
   above the budget by the whole suffix.
3. Suffixes. Every place of the texts gives its suffix, cut; equal ones are counted within a task, by
   bounded parts, before they are moved to their group.
4. Subtrees. Each group builds its subtree on its own, level by level as arrays: the nodes of a level are the
   distinct prefixes of its leaves, and every node's count is the sum of the leaf totals below. A phrase whose suffixes lie in several groups (above an extended prefix)
   is added up over these.

The rest is joins and windows over frequent phrases.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import returning, small_batches

LONGEST = 5  # words of a phrase
LEAST_COUNT = 100
BUCKETS = 1 << 18  # of words, and of pairs where sizes matter
PAIR_BUCKETS = 1 << 27  # of pairs where only frequency matters, at most; a bit each
BYTES_A_BUCKET = 16  # of text, for each of these
CHUNK = 1 << 16  # buckets that are moved as one row
BUDGET = 500_000  # suffixes of a group, before equal ones are counted
HELD = 1 << 22  # pairs whose buckets a task holds before it passes them on
HELD_LEAVES = 400_000  # distinct suffixes a task holds before it passes them on
SLICE = 4 << 20  # bytes of text that are made into arrays together
UNKNOWN = "und"

# Upper case is lowered, separators become a byte that UTF-8 never uses; it parts pieces as a token of its own.
_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(bytes(range(65, 91)) + _SEPARATORS, bytes(range(97, 123)) + b"\xff" * len(_SEPARATORS))
_CUT = b"\xff"


class Tokens:
    """The words of one language in a batch, in order, as numbers into a list; 0 parts pieces."""

    def __init__(self, texts: list[bytes], lang: str):
        joined = _CUT.join(texts).translate(_TABLE).replace(_CUT, b" \xff ")
        found = pa.array([_CUT, *joined.split()], pa.large_binary()).dictionary_encode()
        self.words: list[bytes] = found.dictionary.to_pylist()
        self.places = found.indices.to_numpy()
        self.hashes, self.word_bucket = _word_buckets(self.words, lang)
        self.is_word = self.places != 0

    def pair_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """For every place but the last, a hash of its word and the next, and whether both are words of a piece."""
        hashes = self.hashes[self.places]
        return _pair_hashes(hashes[:-1], hashes[1:]), self.is_word[:-1] & self.is_word[1:]

    def triple_hashes(self, pairs: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every place but the last two, a hash of three words, and whether both their pairs are linked."""
        return _pair_hashes(pairs[:-1], self.hashes[self.places[2:]]), linked[:-1] & linked[1:]


def _word_buckets(words: list[bytes], lang: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and buckets of a language's words."""
    seed = zlib.crc32(lang.encode())
    hashes = np.array([zlib.crc32(w, seed) for w in words], dtype=np.uint64)
    return hashes, (_mixed(hashes) % np.uint64(BUCKETS)).astype(np.int64)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


def _word_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hashes of single words among those of pairs."""
    return _pair_hashes(np.uint64(1) << np.uint64(40), hashes)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes & np.uint64(buckets - 1)).astype(np.int64)


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, Tokens]]:
    """The tokens of each language of a batch with columns (lang, text), a slice of whole texts at a time."""
    texts: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        text = (text.as_py() or "").encode()
        texts.setdefault(lang, []).append(text)
        sizes[lang] = sizes.get(lang, 0) + len(text)
        if sizes[lang] > SLICE:
            yield lang, Tokens(texts.pop(lang), lang)
            sizes[lang] = 0
    for lang, listed in texts.items():
        yield lang, Tokens(listed, lang)


WORDS, SIZED_PAIRS, PAIRS, TOTAL = 0, 1, 2, 3  # kinds of rows that the counting pass gives
COUNTED = "kind int, chunk int, lang string, n long, places binary, counts binary"


def _chunks(kind: int, buckets: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
    """Rows of sorted buckets and their counts, CHUNK buckets each."""
    chunk = buckets // CHUNK
    edges = np.flatnonzero(np.diff(chunk, prepend=-1, append=-1))
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
        part = counts[low:high]
        size = np.uint8 if part.max() < 256 else np.uint64
        yield kind, int(chunk[low]), None, int(high - low), (buckets[low:high] % CHUNK).astype(np.uint16).tobytes(), part.astype(size).tobytes()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "chunk", "lang", "n", "places", "counts"])


class Held:
    """Buckets of pairs or triples, held until there are enough to be counted together."""

    def __init__(self, buckets: int, least: int):
        self.buckets, self.least = buckets, min(least, 255)
        self.parts: list[np.ndarray] = []

    def add(self, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(_bucket(hashes, self.buckets).astype(np.uint32))
        if sum(map(len, self.parts)) >= HELD:
            yield from self.pass_on()

    def pass_on(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            found, counts = np.unique(np.concatenate(self.parts), return_counts=True)
            self.parts.clear()
            # Only whether a bucket is frequent matters, so a count need not pass the least one.
            yield _rows(list(_chunks(PAIRS, found.astype(np.int64), np.minimum(counts, self.least))))


def _count(batches: Iterator[pa.RecordBatch], pair_buckets: int, least: int) -> Iterator[pa.RecordBatch]:
    """Bucket counts of a task's words and pairs, and its number of words by language."""
    words, sized = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    totals: dict[str, int] = {}
    held = Held(pair_buckets, least)
    for batch in batches:
        for lang, tokens in _by_language(batch):
            occurrences = np.bincount(tokens.places, minlength=len(tokens.words))
            totals[lang] = totals.get(lang, 0) + int(occurrences[1:].sum())
            words += np.bincount(tokens.word_bucket[1:], occurrences[1:], minlength=BUCKETS).astype(np.int64)
            hashes, inside = tokens.pair_hashes()
            sized += np.bincount(_bucket(hashes[inside], BUCKETS), minlength=BUCKETS)
            yield from held.add(hashes[inside])
            yield from held.add(_word_hashes(tokens.hashes[tokens.places[tokens.is_word]]))
    rows = [(TOTAL, -1, lang, n, None, None) for lang, n in totals.items()]
    for kind, counts in ((WORDS, words), (SIZED_PAIRS, sized)):
        some = np.flatnonzero(counts)
        rows += _chunks(kind, some, counts[some])
    yield _rows(rows)
    yield from held.pass_on()


def _count_triples(batches: Iterator[pa.RecordBatch], groups: Groups, least: int) -> Iterator[pa.RecordBatch]:
    """Bucket counts of a task's triples that frequent pairs make up."""
    held = Held(groups.pair_buckets, least)
    for batch in batches:
        for _, tokens in _by_language(batch):
            hashes, inside = tokens.pair_hashes()
            linked = inside & groups.frequent.holds(hashes)
            triples, joined = tokens.triple_hashes(hashes, linked)
            yield from held.add(triples[joined])
    yield from held.pass_on()


def _add_chunks(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Sums of the chunks that reach a task, added as they come; pairs' sums as a bit a bucket."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for kind, chunk, n, places, counts in zip(*(batch.column(c).to_pylist() for c in ("kind", "chunk", "n", "places", "counts"))):
            total = sums.setdefault((kind, chunk), np.zeros(CHUNK, dtype=np.int64))
            total[np.frombuffer(places, np.uint16)] += np.frombuffer(counts, f"u{len(counts) // n}").astype(np.int64)
    made = [np.packbits(t >= least) if kind == PAIRS else t for (kind, _), t in sums.items()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in sums], pa.int32()), pa.array([c for _, c in sums], pa.int32()), pa.array([m.tobytes() for m in made], pa.binary())],
        names=["kind", "chunk", "content"],
    )


class Bits:
    """Which buckets are frequent, a bit each."""

    def __init__(self, buckets: int):
        self.buckets, self.bits = buckets, np.zeros(buckets // 8, dtype=np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        bucket = _bucket(hashes, self.buckets)
        return (self.bits[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8)) & 1 > 0


def _added(counted: DataFrame, least: int, wholes: dict[int, np.ndarray]) -> None:
    """Add up the chunks of a counting pass on all tasks and put them into the arrays of their kinds."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _add_chunks(batches, min(least, 255))

    chunks = counted.filter(F.col("kind") != TOTAL).select("kind", "chunk", "n", "places", "counts")
    for row in chunks.repartition(32, "kind", "chunk").mapInArrow(add, "kind int, chunk int, content binary").collect():
        whole = wholes[row["kind"]]
        content = np.frombuffer(row["content"], whole.dtype)
        low = row["chunk"] * len(content)
        whole[low : low + len(content)] = content


class Groups:
    """What a task needs to cut suffixes and to choose their group; its size is bounded by the numbers of buckets."""

    def __init__(self, counted: DataFrame, pair_buckets: int, budget: int, least: int):
        words, pairs = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
        self.pair_buckets, self.frequent = pair_buckets, Bits(pair_buckets)
        self.triples = Bits(pair_buckets)
        _added(counted, least, {WORDS: words, SIZED_PAIRS: pairs, PAIRS: self.frequent.bits})
        self.heavy, self.heavy_pair = words > budget, pairs > budget
        sizes = np.where(self.heavy | (words < least), 0, words)
        self.of_word = (np.maximum(np.cumsum(sizes) - 1, 0) // budget).astype(np.int32)
        self.first = int(self.of_word[-1]) + 1  # the groups of heavy words come after
        self.more = max(1, int(words[self.heavy].sum()) // budget)

    def count_triples(self, texts: DataFrame, least: int) -> None:
        shared = texts.sparkSession.sparkContext.broadcast(self)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _count_triples(batches, shared.value, least)

        _added(texts.mapInArrow(returning(count), COUNTED), least, {PAIRS: self.triples.bits})


def _cut_suffixes(tokens: Tokens, groups: Groups, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where suffixes begin, how many words stay, and their group (-1: by the whole suffix)."""
    frequent = groups.frequent.holds(_word_hashes(tokens.hashes))
    frequent[0] = False
    hashes, inside = tokens.pair_hashes()
    linked = inside & groups.frequent.holds(hashes)
    triples, joined = tokens.triple_hashes(hashes, linked)
    none = np.zeros(longest + 1, dtype=bool)
    third = np.concatenate([joined & groups.triples.holds(triples), none])
    start = np.flatnonzero(frequent[tokens.places])
    going = np.concatenate([linked, none])[start]
    length = 1 + going.astype(np.int64)
    for ahead in range(longest - 2):
        going &= third[start + ahead]
        length += going
    bucket = tokens.word_bucket[tokens.places[start]]
    pair = np.concatenate([hashes, np.zeros(1, dtype=np.uint64)])[start]
    # A heavy word on its own is one leaf.
    below = groups.heavy[bucket] & (length > 1)
    dealt = groups.first + (pair % np.uint64(groups.more)).astype(np.int64)
    dealt = np.where(groups.heavy_pair[_bucket(pair, BUCKETS)], -1, dealt)
    return start, length, np.where(below, dealt, groups.of_word[bucket])


def _leaves(tokens: Tokens, groups: Groups, longest: int) -> Iterator[tuple[bytes, int, int]]:
    """Distinct cut suffixes of a slice, their number, and their group."""
    start, length, group = _cut_suffixes(tokens, groups, longest)
    if not len(start):
        return
    padded = np.concatenate([tokens.places, np.zeros(longest, dtype=tokens.places.dtype)]).astype(np.int64)
    codes = padded[start]
    for ahead in range(1, longest):
        following = np.where(length > ahead, padded[start + ahead], 0)
        codes = np.unique(codes * len(tokens.words) + following, return_inverse=True)[1]
    _, first, number = np.unique(codes, return_index=True, return_counts=True)
    words = tokens.words
    rows = padded[start[first][:, None] + np.arange(longest)]
    for row, n, count, chosen in zip(rows.tolist(), length[first].tolist(), number.tolist(), group[first].tolist()):
        suffix = b" ".join([words[w] for w in row[:n]])
        yield suffix, count, chosen if chosen >= 0 else groups.first + zlib.crc32(suffix) % groups.more


def suffixes(texts: DataFrame, groups: Groups, longest: int = LONGEST) -> DataFrame:
    """Cut suffixes of (lang, text) rows with their number within a part of a task, a group a row: (grp, lang, suffixes, counts)."""
    shared = texts.sparkSession.sparkContext.broadcast(groups)  # bounded by the numbers of buckets

    def pass_on(held: dict[str, dict[bytes, list[int]]]) -> Iterator[pa.RecordBatch]:
        for lang, leaves in held.items():
            group = np.array([g for _, g in leaves.values()], dtype=np.int32)
            order = np.argsort(group, kind="stable")
            listed, counts = list(leaves), np.array([n for n, _ in leaves.values()], dtype=np.int64)[order]
            ends = np.flatnonzero(np.diff(group[order], append=-1)) + 1 if len(order) else order
            offsets = pa.array([0, *ends.tolist()], pa.int32())
            columns = [
                pa.array(group[order][ends - 1], pa.int32()),
                pa.array([lang] * len(ends), pa.string()),
                pa.ListArray.from_arrays(offsets, pa.array([listed[n].decode() for n in order.tolist()], pa.string())),
                pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["grp", "lang", "suffixes", "counts"])
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[bytes, list[int]]] = {}
        for batch in batches:
            for lang, tokens in _by_language(batch):
                leaves = held.setdefault(lang, {})
                for suffix, n, group in _leaves(tokens, shared.value, longest):
                    known = leaves.get(suffix)
                    if known is None:
                        leaves[suffix] = [n, group]
                    else:
                        known[0] += n
                if sum(map(len, held.values())) > HELD_LEAVES:
                    yield from pass_on(held)
        yield from pass_on(held)

    return texts.mapInArrow(returning(run), "grp int, lang string, suffixes array<string>, counts array<long>")


class Subtree:
    """A suffix tree over words of one prefix group and language, cut at ``longest`` words.

    It is kept as arrays, a level at a time: row n of ``words`` is the n-th leaf's words, 0 after its end.
    """

    def __init__(self, suffixes: pa.Array, totals: np.ndarray):
        listed = pc.split_pattern(suffixes, " ")
        length = pc.list_value_length(listed).to_numpy(zero_copy_only=False)
        found = pc.list_flatten(listed).dictionary_encode()
        self.names: list[str] = found.dictionary.to_pylist()
        self.words = np.zeros((len(suffixes), int(length.max())), dtype=np.int32)
        row = np.repeat(np.arange(len(suffixes)), length)
        self.words[row, np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)] = found.indices.to_numpy() + 1
        self.length, self.totals = length, totals

    def levels(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(depth, a leaf below each node, counts) of the nodes of every level, from leaf totals."""
        leaf, node = np.arange(len(self.length)), np.zeros(len(self.length), dtype=np.int64)
        for depth in range(1, self.words.shape[1] + 1):
            alive = self.length[leaf] >= depth
            leaf, node = leaf[alive], node[alive]
            key = node * (len(self.names) + 1) + self.words[leaf, depth - 1]
            _, first, node = np.unique(key, return_index=True, return_inverse=True)
            # Sums of whole numbers below 2^53 are exact in doubles.
            yield depth, leaf[first], np.bincount(node, self.totals[leaf]).astype(np.int64)

    def phrase(self, leaf: int, depth: int) -> str:
        return " ".join([self.names[w - 1] for w in self.words[leaf, :depth].tolist()])


def _build(part: pa.Table, heavy: np.ndarray, heavy_pair: np.ndarray, least: int) -> pa.Table:
    """Counts of the phrases in one group's subtrees; those below ``least`` go where no other group adds to them."""
    langs, phrases, depths, counts = [], [], [], []
    for lang in pc.unique(part.column("lang")).to_pylist():
        own = part.filter(pc.equal(part.column("lang"), lang))
        leaves = [pc.list_flatten(own.column(c)).combine_chunks() for c in ("suffixes", "counts")]
        tree = Subtree(leaves[0], leaves[1].to_numpy())
        hashes, bucket = _word_buckets([w.encode() for w in tree.names], lang)
        for depth, leaf, count in tree.levels():
            first = tree.words[leaf, 0] - 1
            spread = heavy[bucket[first]]  # other groups may hold suffixes of the node's prefix
            if depth > 1:
                pair = _pair_hashes(hashes[first], hashes[tree.words[leaf, 1] - 1])
                spread &= heavy_pair[_bucket(pair, BUCKETS)]
            kept = np.flatnonzero((count >= least) | spread)
            phrases += [tree.phrase(n, depth) for n in leaf[kept].tolist()]
            counts += count[kept].tolist()
            depths += [depth] * len(kept)
            langs += [lang] * len(kept)
    return pa.table({"lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.string()), "words": pa.array(depths, pa.int32()), "f": pa.array(counts, pa.int64())})


def phrase_counts(docs: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words with a count of ``least`` or more, and the words of each language.

    Returns (lang, phrase, words, f) and (lang, n). A null text has no word; a null language is ``und``.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    pair_buckets = 1 << max(CHUNK.bit_length(), min(PAIR_BUCKETS.bit_length() - 1, (size // BYTES_A_BUCKET).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _count(batches, pair_buckets, least)

    passed = materialise(texts.mapInArrow(returning(count), COUNTED), "phrase-buckets")
    totals = passed.filter(F.col("kind") == TOTAL).groupBy("lang").agg(F.sum("n").alias("n"))
    groups = Groups(passed, pair_buckets, budget, least)
    groups.count_triples(texts, least)
    heavy, heavy_pair = groups.heavy, groups.heavy_pair

    def build(part: pa.Table) -> pa.Table:
        return _build(part, heavy, heavy_pair, least)

    leaves = suffixes(texts, groups, longest)
    nodes = leaves.groupBy("grp").applyInArrow(build, "lang string, phrase string, words int, f long")
    counted = nodes.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return materialise(counted, "phrase-counts"), totals


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) in decimal numbers of 38 digits; counts up to 10^17 stay exact."""
    big = lambda c: c.cast("decimal(18,0)")
    return F.call_function("div", (big(a) * big(n)).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)"), (big(left) * big(right)).cast("decimal(38,0)"))


def collocations(docs: DataFrame, top: int = 2000, least: int = LEAST_COUNT, longest: int = LONGEST, budget: int = BUDGET) -> DataFrame:
    """Each language's best phrases, from (lang, text) rows: (lang, rank, phrase, a, l, r, n, score).

    A phrase is scored by its weakest cut into two parts (ties: the first). Phrases that occur only within
    one longer frequent phrase are left out. Repeated rows count again; empty, blank and null texts have no
    words; texts are taken whole, whatever their length. Ties in score go to the greater count, then to the
    phrase in byte order. Other columns of ``docs`` are not looked at. An empty table gives no rows.
    """
    counts, totals = phrase_counts(docs, least, longest, budget)
    candidates = counts.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    # A longer phrase with the same count has a part one word longer than the candidate with that count.
    cut_last = F.col("phrase").substr(F.lit(1), F.length("phrase") - F.instr(F.reverse("phrase"), " "))
    cut_first = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    longer = candidates.filter("words > 2")
    inside = longer.select("lang", cut_last.alias("phrase"), "a").unionByName(longer.select("lang", cut_first.alias("phrase"), "a"))
    kept = candidates.join(inside, ["lang", "phrase", "a"], "left_anti")
    words = F.split("phrase", " ")
    cuts = kept.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "*",
        F.array_join(F.slice(words, 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("k") + 1, longest), " ").alias("right"),
    )
    part = lambda side, count: counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(count))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(totals, "lang")
    cuts = cuts.withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    weakest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = weakest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
