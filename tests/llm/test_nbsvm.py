import zlib

import numpy as np
import pytest
from tailwise.llm import nbsvm
from tailwise.llm.queries import op11_nbsvm

SF = "/root/testdata/sf0.01"


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_held_out_labels(spark):
    rows = {r.doc_id: r for r in op11_nbsvm(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows.values())
    assert all(r.predicted == int(r.score >= 0.3) for r in rows.values())
    held = [i for i in labels if rows[i].held_out]
    good = [rows[i].predicted for i in held if labels[i]]
    poor = [rows[i].predicted for i in held if not labels[i]]
    assert np.mean(good) > 0.98 and np.mean(poor) < 0.2


def test_fit_against_a_slow_solution():
    """The dual coordinate descent reaches the minimum that plain subgradient steps approach."""
    drawn = np.random.default_rng(3)
    label = np.arange(60) % 2
    rows = [np.flatnonzero(drawn.random(12) < np.where(np.arange(12) < 4, 0.2 + 0.4 * c, 0.3)).astype(np.int32) for c in label]
    scale, cost = drawn.normal(size=12), np.full(60, 0.5)
    goal = np.where(label == 1, 1.0, -1.0)
    dense = np.zeros((60, 13))
    dense[:, 12] = 1
    for i, r in enumerate(rows):
        dense[i, r] = scale[r]

    def loss(w):
        return 0.5 * w @ w + (cost * np.maximum(0, 1 - goal * (dense @ w))).sum()

    slow, best = np.zeros(13), np.inf
    for step in range(1, 60000):
        active = goal * (dense @ slow) < 1
        slow = slow - (slow - (cost * goal * active) @ dense) / (step + 20)
        best = min(best, loss(slow))
    fast = nbsvm.dual_coordinate_descent(rows, scale, goal, cost, passes=2000)
    assert abs(loss(fast) - best) < 1e-3 * best


def test_counts_and_ratios_by_hand():
    texts = ["good text", "good words", "BAD!!! text", ""]
    shown = [set(nbsvm.Indicators().of(t.encode()).tolist()) for t in texts]
    assert shown[3] == set()
    # Equal words in other letters' case share their word, not their byte n-grams.
    assert len(set(nbsvm.Indicators().of(b"GOOD").tolist()) & shown[0]) >= 1
    counts = np.zeros((2, 1 << nbsvm.BITS))
    for places, c in zip(shown, (1, 1, 0, 0)):
        counts[c][list(places)] += 1
    p, q = counts[1] + 1, counts[0] + 1
    assert np.allclose(nbsvm.ratios(counts), np.log((p / p.sum()) / (q / q.sum())))


def test_pieces_show_what_the_whole_text_shows(monkeypatch):
    text = ("Some words, and more!! of them | in " * 40).encode() + b"x" * 300 + "é è".encode() * 50
    whole = nbsvm.Indicators().of(text)
    monkeypatch.setattr(nbsvm, "PIECE", 64)
    parts = nbsvm.Indicators().of(text)
    missing = set(whole.tolist()) - set(parts.tolist())
    # Only a pair of words across a border, or a word longer than a piece, may be told apart.
    assert len(missing) <= 4


def test_odd_rows(spark, odd_documents, no_documents):
    docs = odd_documents.drop("score").withColumnRenamed("n_chars", "label_")
    labels = spark.createDataFrame([(1, 1), (3, 0), (7, 1), (8, 0), (8, None), (99, 1)], "doc_id long, quality int")
    model = nbsvm.fit(docs, labels)
    rows = nbsvm.score(docs, model).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1  # null as empty
    assert len({r.score for r in rows if r.doc_id == 1}) == 1 and len({r.score for r in rows if r.doc_id in (5, 6)}) == 1
    assert nbsvm.score(no_documents.drop("score"), model).count() == 0
    with pytest.raises(ValueError):
        nbsvm.score(odd_documents, model)
    for kept, value in ((1, 1.0), (0, 0.0)):
        alone = nbsvm.fit(docs, labels.filter(f"quality = {kept}"))
        assert all(abs(r.score - value) < 1e-6 for r in nbsvm.score(docs, alone).collect())
    nothing = nbsvm.fit(no_documents, labels.limit(0))
    assert nbsvm.score(docs, nothing).count() == 10
