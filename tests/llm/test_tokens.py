import hashlib
import random
import struct

import pytest
from tailwise.llm import bpe
from tailwise.llm.queries import op2_bpe, vocabulary_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    made = tokenizers.Tokenizer.from_file(vocabulary_path())
    made.no_truncation(), made.no_padding()
    return made


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(bpe.read_vocabulary(vocabulary_path())))


def numbers(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_random_texts_agree_with_the_library(library, encoder):
    draw = random.Random(3)
    letters = [chr(c) for c in [*range(128)] * 3 + [*range(128, 0x600), 0x2003, 0x2019, 0x4E00, 0x1F600, 0x88F, 0x1E6C0]]
    letters += ["<|endoftext|>", " the", "ing ", "   ", "'ll", "é"]
    for _ in range(600):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 50)))
        assert numbers(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("text", ["", "a", "ab" * 20_000, " " * 5_000, "x" * 9_999, "word " * 200_000])
def test_long_and_short_texts(library, encoder, text):
    assert numbers(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids


def naive(vocabulary, piece):
    """Scan for the lowest rank, leftmost first, until nothing merges."""
    symbols = [vocabulary.start[b] for b in piece]
    while True:
        ranked = [(vocabulary.merges[a << 20 | b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a << 20 | b in vocabulary.merges]
        if not ranked:
            return symbols
        (_, new), i = min(ranked)
        symbols[i : i + 2] = [new]


def test_segment_tree_merges_like_a_scan(encoder):
    draw = random.Random(5)
    for _ in range(300):
        piece = bytes(draw.choice(b"aaabetinors ") for _ in range(draw.randint(1, 40)))
        assert encoder.vocabulary.encode_piece(piece) == naive(encoder.vocabulary, piece)


def test_the_remembered_pieces_are_bounded(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 10)
    made = bpe.Encoder(encoder.vocabulary)
    made.encode(" ".join(f"w{n}" for n in range(500)))
    assert len(made.pieces) <= 10 and len(made.pieces.older) <= 10


def test_query_against_the_library(spark, sf, library):
    rows = {r.doc_id: r for r in op2_bpe(spark, sf).collect()}
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for r in texts:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        got = rows[r.doc_id]
        assert got.n_tokens == len(ids)
        assert got.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_odd_rows(odd_documents, no_documents):
    vocabulary = bpe.read_vocabulary(vocabulary_path())
    done = bpe.decode(bpe.encode(odd_documents, vocabulary), vocabulary)
    texts = sorted(r.text or "" for r in odd_documents.select("text").collect())
    assert sorted(r.decoded for r in done.select("decoded").collect()) == texts
    assert bpe.decode(bpe.encode(no_documents, vocabulary), vocabulary).count() == 0
