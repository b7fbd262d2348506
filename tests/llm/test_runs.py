import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tailwise.llm import runs
from tailwise.llm.queries import op12_runs

SF = "/root/testdata/sf0.01"
EMPTY = hashlib.sha256(b"").hexdigest()


def slow(words):
    """Every stretch of every period, by definition."""
    n, found = len(words), []
    for period in range(1, n // 4 + 1):
        place = period
        while place < n:
            if words[place] != words[place - period]:
                place += 1
                continue
            start = place - period
            while place < n and words[place] == words[place - period]:
                place += 1
            length = place - start
            smaller = any(all(words[i] == words[i - p] for i in range(start + p, place)) for p in range(1, period))
            if length >= max(6, 4 * period) and not smaller:
                found.append((start, length, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def numbers(words):
    known = {}
    return np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 40)), max_size=5))
def test_runs_equal_the_slow_search(blocks):
    words = [w for block, n in blocks for w in (block * n)[:n]]
    assert runs.find(np.array(words, dtype=np.int64)) == slow(words)


def test_random_texts_and_touching_runs():
    drawn = random.Random(5)
    for _ in range(400):
        words = [drawn.randrange(2) for _ in range(drawn.randrange(60))]
        assert runs.find(np.array(words, dtype=np.int64)) == slow(words)
    assert runs.find(np.array([0] * 5, dtype=np.int64)) == []
    assert runs.find(np.array([0] * 6, dtype=np.int64)) == [(0, 6, 1)]
    assert runs.find(np.array([0, 1] * 4 + [1] * 6, dtype=np.int64)) == [(0, 8, 2), (7, 7, 1)]


def test_long_texts_stay_cheap():
    started = time.perf_counter()
    for words in ([0] * 50_000, [0, 1, 2] * 20_000, [w for i in range(6_000) for w in (1, 2, 3, 4, 9 + i)]):
        assert len(runs.find(np.array(words, dtype=np.int64))) <= 1
    assert time.perf_counter() - started < 20


def expected(doc_id, text):
    """The contract's columns, straight from its words."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = slow_by_lag(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    collapsed = " ".join(w for i, w in enumerate(words) if i not in dropped)
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, collapsed)]
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *digest)


def slow_by_lag(words):
    """Like slow(), with each diagonal read at once."""
    row, n, found = numbers(words), len(words), []
    for q in range(1, n // 4 + 1):
        match = np.concatenate([[0], (row[q:] == row[:-q]).astype(np.int8), [0]])
        edges = np.flatnonzero(np.diff(match))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = e - s + q
            if length >= max(6, 4 * q) and not any(np.array_equal(row[s + p : s + length], row[s : s + length - p]) for p in range(1, q)):
                found.append((s, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_query_against_its_contract(spark):
    got = {r.doc_id: r for r in op12_runs(spark, SF).collect()}
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts) == 1000
    with_runs = 0
    for doc in texts:
        r = got[doc.doc_id]
        want = expected(doc.doc_id, doc.text)
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == want
        with_runs += r.n_runs > 0
    assert with_runs > 40


def test_odd_rows(odd_documents, no_documents):
    rows = runs.find_runs(odd_documents).collect()
    assert len(rows) == 10
    found = {r.doc_id: r for r in rows}
    assert found[2].runs == [] and found[2].collapsed == "" and found[4].collapsed == ""
    assert [tuple(r) for r in found[5].runs] == [(0, 32000, 8)] == [tuple(r) for r in found[6].runs]
    assert found[5].collapsed == "alpha beta gamma delta epsilon zeta eta theta"
    assert found[1].size == "x" and found[1].kept == "x"
    assert runs.find_runs(no_documents).count() == 0
    for taken in ("label", "hash"):
        with pytest.raises(ValueError):
            runs.find_runs(odd_documents, runs_col=taken)
    digests = {r.doc_id: r for r in runs.digests(odd_documents).collect()}
    assert digests[2].n_runs == 0 and digests[2].start is None and digests[2].runs_sha256 == EMPTY == digests[3].collapsed_sha256
