"""Byte-level BPE: texts to token numbers and back, by a segment tree over pair ranks.

A text is cut at the vocabulary's special tokens, then into pieces by the published split pattern.
The merges of a piece run on a segment tree whose leaves are the ranks of adjacent pairs, joined
with their places: the root is the leftmost lowest-rank merge, and a merge changes three leaves, each
in logarithmic time, so a piece of n bytes takes O(n log n) however long it is. Pieces repeat, so each
worker keeps a bounded table of those already encoded; the others of a stretch of texts are encoded
together, one tree a row of an array (a long piece on its own).

No text crosses tasks: encoding and decoding are maps over Arrow batches without a shuffle.
"""

from __future__ import annotations

import functools
import json
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release_memory, returning

# Fixed value: the published split pattern of the vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

CACHED_PIECES = 100_000  # pieces remembered by a worker, and as many from before
CACHED_LENGTH = 48  # longest piece remembered, in characters
CHUNK = 65_536  # pieces of a text handled at a time
STRETCH = 1 << 19  # characters of texts whose pieces are looked up together
TOGETHER = 4_096  # pieces encoded in one array
WIDTHS = (4, 8, 16, 32, 64)  # leaves of the trees that are encoded together
NEVER = 1 << 62


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(shown)))
    return letters


def token_bytes(data: dict) -> dict[int, bytes]:
    """The bytes of every number of a parsed tokenizer file."""
    value = {letter: b for b, letter in byte_letters().items()}
    known = {i: bytes(value[c] for c in token) for token, i in data["model"]["vocab"].items()}
    return known | {t["id"]: t["content"].encode() for t in data["added_tokens"]}


class Vocabulary:
    """A byte-level BPE vocabulary from the text of a tokenizer file."""

    def __init__(self, content: str):
        data = json.loads(content)
        model = data["model"]
        if model["type"] != "BPE" or data["pre_tokenizer"]["type"] != "ByteLevel" or data.get("normalizer"):
            raise ValueError("a byte-level BPE vocabulary without normalizer is needed")
        if data["pre_tokenizer"]["add_prefix_space"] or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in data["added_tokens"]):
            raise ValueError("prefix spaces and stripping special tokens are not supported")
        letters = byte_letters()
        ids = model["vocab"]
        self.start = [ids[letters[b]] for b in range(256)]
        self.bytes_of = token_bytes(data)
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault(ids[left] << 20 | ids[right], (rank, ids[left + right]))
        keys = np.array(list(self.merges), dtype=np.int64)
        order = np.argsort(keys)
        self.pairs = keys[order]
        self.ranks = np.array([self.merges[k][0] for k in keys.tolist()], dtype=np.int64)[order]
        self.merged = np.zeros(1 + max(self.ranks, default=0), dtype=np.int64)  # by rank
        self.merged[self.ranks] = np.array([self.merges[k][1] for k in keys.tolist()], dtype=np.int64)[order]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}

    def encode_piece(self, piece: bytes) -> list[int]:
        """Merge the bytes of one piece until no adjacent pair has a rank."""
        symbols = [self.start[b] for b in piece]
        n = len(symbols)
        if n < 2:
            return symbols
        bits = (n - 2).bit_length()
        size = 1 << bits
        merges = self.merges
        tree = [NEVER] * (2 * size)
        for i in range(n - 1):
            found = merges.get(symbols[i] << 20 | symbols[i + 1])
            if found is not None:
                tree[size + i] = found[0] << bits | i
        for v in range(size - 1, 0, -1):
            a, b = tree[2 * v], tree[2 * v + 1]
            tree[v] = a if a < b else b
        following = list(range(1, n + 1))
        previous = list(range(-1, n - 1))

        def put(place: int, key: int) -> None:
            v = size + place
            if tree[v] == key:
                return
            tree[v] = key
            while v > 1:
                a, b = tree[v], tree[v ^ 1]
                least = a if a < b else b
                v >>= 1
                if tree[v] == least:
                    return
                tree[v] = least

        def rank(left: int, right: int) -> int:
            found = merges.get(symbols[left] << 20 | symbols[right])
            return NEVER if found is None else found[0] << bits | left

        while tree[1] != NEVER:
            i = tree[1] & (size - 1)
            j = following[i]
            symbols[i] = merges[symbols[i] << 20 | symbols[j]][1]
            symbols[j] = -1
            k = following[i] = following[j]
            if j < n - 1:
                put(j, NEVER)
            if k < n:
                previous[k] = i
                put(i, rank(i, k))
            else:
                put(i, NEVER)
            if previous[i] >= 0:
                put(previous[i], rank(previous[i], i))
        return [s for s in symbols if s >= 0]


    def _rank_keys(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Leaf values of pairs of symbols: rank and place, or NEVER."""
        if not len(self.pairs):
            return np.full(len(left), NEVER)
        pair = left << 20 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.ranks[at] << 8 | place, NEVER)

    def encode_together(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Packed numbers of pieces of 2 to ``width`` + 1 bytes: the same trees, one a row."""
        m, stride = len(pieces), 2 * width
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=m)
        row = np.repeat(np.arange(m), lengths)
        column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        line = width + 2  # places of a row: the symbols, one past the end, and one before the start
        symbols = np.full(m * line, -1, dtype=np.int64)
        symbols[row * line + column] = np.array(self.start, dtype=np.int64)[np.frombuffer(b"".join(pieces), np.uint8)]
        following = np.tile(np.arange(1, line + 1), m)
        previous = np.tile(np.arange(-1, line - 1), m)
        tree = np.full(m * stride, NEVER)
        some = np.flatnonzero(column < lengths[row] - 1)
        left = row[some] * line + column[some]
        tree[row[some] * stride + width + column[some]] = self._rank_keys(symbols[left], symbols[left + 1], column[some])
        levels = tree.reshape(m, stride)
        half = width
        while half > 1:
            np.minimum(levels[:, half : 2 * half : 2], levels[:, half + 1 : 2 * half : 2], out=levels[:, half // 2 : half])
            half //= 2
        rows = np.flatnonzero(levels[:, 1] != NEVER)
        while len(rows):
            root = tree[rows * stride + 1]
            i, base, first = root & 255, rows * line, rows * stride + width
            j = following[base + i]
            k = following[base + j]
            symbols[base + i] = self.merged[root >> 8]
            symbols[base + j] = -1
            following[base + i] = k
            before = previous[base + i]
            more, some = k < lengths[rows], before >= 0
            previous[(base + k)[more]] = i[more]
            # Three leaves change: the right symbol's is gone, those of the new pairs get their ranks.
            places = [j, i, before[some]]
            held = [rows, rows, rows[some]]
            inside = j < width  # the last symbol has no leaf
            tree[(first + j)[inside]] = NEVER
            mine = np.full(len(rows), NEVER)
            mine[more] = self._rank_keys(symbols[(base + i)[more]], symbols[(base + k)[more]], i[more])
            at_i = i < width
            tree[(first + i)[at_i]] = mine[at_i]
            b = base[some]
            tree[first[some] + before[some]] = self._rank_keys(symbols[b + before[some]], symbols[b + i[some]], before[some])
            held[0], places[0] = rows[inside], j[inside]
            held[1], places[1] = rows[at_i], i[at_i]
            start = np.concatenate(held) * stride
            node = np.concatenate(places) + width
            while len(node) and node[0] > 1:  # all leaves are on one level
                node >>= 1
                tree[start + node] = np.minimum(tree[start + 2 * node], tree[start + 2 * node + 1])
            rows = rows[tree[rows * stride + 1] != NEVER]
        kept = symbols >= 0
        ends = np.cumsum(kept.reshape(m, line).sum(axis=1)) * 4
        packed = symbols[kept].astype("<u4").tobytes()
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Packed numbers of every piece."""
        made: list[bytes] = [b""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for n, piece in enumerate(pieces):
            width = next((w for w in WIDTHS if len(piece) <= w + 1), 0) if len(piece) > 1 else 0
            if width:
                classes.setdefault(width, []).append(n)
            else:
                ids = self.encode_piece(piece)
                made[n] = struct.pack(f"<{len(ids)}I", *ids)
        for width, places in classes.items():
            for some in batched(places, TOGETHER):
                for n, packed in zip(some, self.encode_together([pieces[n] for n in some], width)):
                    made[n] = packed
        return made


class Pieces:
    """Piece to its packed token numbers, bounded: when the table is full it becomes the older one."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __len__(self) -> int:
        return len(self.newer)

    def of(self, cuts: list[list[str]]) -> dict[str, bytes]:
        """A table with all pieces of the cuts."""
        wanted = set().union(*cuts)
        found = {}
        for table in (self.newer, self.older):
            for piece in wanted & table.keys():
                found[piece] = table[piece]
            wanted -= found.keys()
        unseen = list(wanted)
        made = dict(zip(unseen, self.vocabulary.encode_pieces([p.encode() for p in unseen])))
        found |= made
        for piece, packed in found.items():
            if len(piece) <= CACHED_LENGTH and piece not in self.newer:
                if len(self.newer) >= CACHED_PIECES:
                    self.older, self.newer = self.newer, {}
                self.newer[piece] = packed
        return found


class Encoder:
    """Whole texts to packed token numbers."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pieces = Pieces(vocabulary)
        self.split = regex.compile(SPLIT)
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.assigned: set[str] = set()
        self.library_split = None

    def _known(self, text: str) -> bool:
        """Whether all characters were assigned when Python's character tables were made.

        Later characters may be letters to one Unicode table and not yet to another.
        """
        new = set(text) - self.assigned
        self.assigned |= {c for c in new if unicodedata.category(c) != "Cn"}
        return new <= self.assigned

    def _cut(self, text: str) -> Iterator[list[str]]:
        if not text.isascii() and not self._known(text):
            if self.library_split is None:
                from tokenizers.pre_tokenizers import ByteLevel

                self.library_split = ByteLevel(add_prefix_space=False).pre_tokenize_str
            yield [text[a:b] for _, (a, b) in self.library_split(text)]
        elif len(text) < 8 * CHUNK:
            yield self.split.findall(text)
        else:
            for found in batched(self.split.finditer(text), CHUNK):
                yield [m.group() for m in found]

    def _parts(self, text: str) -> Iterator[list[str] | bytes]:
        """The pieces of a text in order, by chunks, and packed numbers of special tokens between them."""
        parts = self.special.split(text) if self.special and self.special.search(text) else [text]
        for n, part in enumerate(parts):
            if n % 2:
                yield struct.pack("<I", self.vocabulary.special[part])
            else:
                yield from self._cut(part)

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Packed numbers of whole texts, in order; pieces are looked up for a stretch of texts at a time."""
        waiting: list[list[list[str] | bytes]] = []
        made: list[bytes] = []  # of the text being cut
        size = 0
        for text in texts:
            parts: list[list[str] | bytes] = []
            for part in self._parts(text):
                parts.append(part)
                size += len(part) if isinstance(part, bytes) else 8 * len(part)
                if size > STRETCH:
                    # What is complete goes on; the cut part of this text keeps its numbers only.
                    *whole, begun = self._packed([*waiting, parts])
                    for n, packed in enumerate(whole):
                        yield b"".join([*made, packed]) if n == 0 and made else packed
                    made = [begun] if whole or not made else [*made, begun]
                    waiting, parts, size = [], [], 0
            if made:
                yield b"".join([*made, *self._packed([parts])])
                made = []
            else:
                waiting.append(parts)
        yield from self._packed(waiting)

    def _packed(self, texts: list[list[list[str] | bytes]]) -> list[bytes]:
        table = self.pieces.of([part for parts in texts for part in parts if not isinstance(part, bytes)])
        return [b"".join([part if isinstance(part, bytes) else b"".join(map(table.__getitem__, part)) for part in parts]) for parts in texts]

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))


@functools.lru_cache(maxsize=1)
def encoder_of(content: str) -> Encoder:
    """The worker's encoder; it outlives a task, and so do the pieces it remembers."""
    return Encoder(Vocabulary(content))


@functools.lru_cache(maxsize=1)
def bytes_table(content: str) -> list[bytes]:
    """The bytes of every number up to the greatest one; a worker that decodes keeps nothing else."""
    known = token_bytes(json.loads(content))
    return [known.get(i, b"") for i in range(max(known) + 1)]


def read_vocabulary(path: str) -> str:
    """The content of a tokenizer file (some MB, the same for every input)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Replace the text column by the packed token numbers of the whole text.

    ``vocabulary`` is the content of a tokenizer file. ``ids_col`` is binary: the numbers as
    little-endian unsigned 32-bit integers. A null or empty text gives no numbers. Special tokens in a
    text become their number. Every row, repeated or not, gives one row, an empty table an empty one; all
    other columns stay; ``ids_col`` must not be among them (ValueError).
    """
    if ids_col in docs.columns and ids_col != text_col:
        raise ValueError(f"column {ids_col!r} is already there")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    kept = [c for c in docs.columns if c != text_col]
    rows = docs.select(*kept, F.coalesce(F.col(text_col), F.lit("")).alias(text_col))
    schema = rows.drop(text_col).withColumn(ids_col, F.lit(b"")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            packed = pa.array(encoder.encode_all(t.as_py() for t in batch.column(len(kept))), pa.large_binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed.cast(pa.binary())], names=[*kept, ids_col])
            del packed
            release_memory()  # the pieces of a batch leave gaps that would add up

    return rows.mapInArrow(returning(run), schema)


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add the text of packed token numbers; bytes that are not UTF-8 become U+FFFD.

    Null numbers give the empty text, and a number outside the vocabulary gives nothing, as in the
    library. ``text_col`` must be a new name (ValueError).
    """
    if text_col in encoded.columns:
        raise ValueError(f"column {text_col!r} is already there")
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    names = encoded.columns
    schema = encoded.withColumn(text_col, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bytes_table(shared.value)
        for batch in batches:
            made = []
            for packed in batch.column(names.index(ids_col)):
                ids = np.frombuffer(packed.as_py() or b"", "<u4").tolist()
                try:
                    whole = b"".join(map(table.__getitem__, ids))
                except IndexError:
                    whole = b"".join(table[i] for i in ids if i < len(table))
                made.append(whole.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=[*names, text_col])

    return encoded.mapInArrow(returning(run), schema)


def n_tokens(ids: Column) -> Column:
    """How many numbers a packed column holds."""
    return (F.octet_length(ids) / 4).cast("long")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of tokens and the digests of its numbers and of the decoded text."""
    vocabulary = read_vocabulary(path)
    done = decode(encode(docs.select("doc_id", "text"), vocabulary), vocabulary)
    return done.select(
        "doc_id",
        n_tokens(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
