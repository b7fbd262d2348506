import math
import zlib
from collections import Counter

import numpy as np
import pytest
from tailwise.llm import language, lm, toxicity
from tailwise.llm.queries import op4_toxicity, op5_language, op6_lm

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_language_on_held_out_documents(spark, documents):
    rows = op5_language(spark, SF).collect()
    assert len(rows) == len(documents)
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == documents[r.doc_id].lang for r in rows if r.held_out]
    assert np.mean(held) > 0.97


def test_language_odd_rows(odd_documents, no_documents):
    plain = odd_documents.select("doc_id", "text", "lang")
    model = language.fit(plain)
    rows = language.predict(plain, model).collect()
    assert len(rows) == 10
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in rows)
    assert {r.lang_pred for r in rows if r.doc_id == 7} == {"de"}
    assert language.predict(no_documents.select("doc_id", "text"), model).count() == 0
    nothing = language.fit(plain.limit(0))
    assert {(r.lang_pred, r.score) for r in language.predict(plain, nothing).collect()} == {("und", 0.0)}


def test_language_learns_from_whole_texts_and_drawn_landmarks(monkeypatch):
    made = []
    features = language.features
    monkeypatch.setattr(language, "features", lambda passages: made.append(passages) or features(passages))
    letter = lambda n: chr(0x4E00 + n)
    text = "".join(letter(n) * language.PASSAGE for n in range(40))
    texts = [text] + [letter(100 + n) * 50 for n in range(200)]
    language.Model.fit(texts, ["a"] * len(texts))
    landmarks = {int(p[0]) - 0x4E00 for p in made[0]}
    learned = {int(p[0]) - 0x4E00 for passages in made[1:] for p in passages}
    assert len(landmarks) == language.LANDMARKS and max(landmarks) > 100 + language.LANDMARKS
    assert len(learned) == 208 and 7 < max(n for n in learned if n < 100)


def test_language_kernel_counts_common_ngrams():
    a, b = language.points("abc"), language.points("abd")
    made = language.presence([a, b])
    # a, b, ab are in both; c, bc, abc and d, bd, abd in one.
    assert (made[0] * made[1]).sum() == 3 and made.sum(1).tolist() == [6.0, 6.0]


def test_toxicity_on_held_out_documents(spark, documents):
    rows = op4_toxicity(spark, SF).collect()
    assert len(rows) == len(documents)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) and r.predicted == int(r.score >= 0.3) for r in rows)
    clean = [r.predicted for r in rows if r.held_out and labels.get(r.doc_id) == 0]
    toxic = [r.predicted for r in rows if r.held_out and labels.get(r.doc_id) == 1 and documents[r.doc_id].lang == "en"]
    assert np.mean(clean) < 0.02 and np.mean(toxic) > 0.9


def test_toxicity_odd_rows(spark, odd_documents, no_documents):
    from pyspark.sql import functions as F

    plain = odd_documents.select("doc_id", "text")
    for label in (F.lit(None).cast("int"), F.lit(0), F.lit(1), (F.col("doc_id") % 2).cast("int")):
        model = toxicity.fit(plain, plain.select("doc_id", label.alias("toxic")))
        rows = toxicity.score(plain, model).collect()
        assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(no_documents.select("doc_id", "text"), model).count() == 0


def test_label_model_finds_good_voters():
    draw = np.random.default_rng(2)
    label = draw.random(4000) < 0.3
    accuracies = [0.95, 0.9, 0.9, 0.6]
    votes = np.stack([np.where(draw.random(4000) < a, np.where(label, 1, -1), np.where(label, -1, 1)) for a in accuracies], axis=1)
    votes = np.column_stack([votes, votes[:, 3], votes[:, 3]])  # a poor voter's copies
    model = toxicity.LabelModel(votes, np.ones(4000), 0.3)
    assert np.mean((model.posterior(votes) > 0.5) == label) > 0.95
    assert model.accuracy[0][0] > model.accuracy[0][3] and model.correlation[3, 4] > 0.9


def test_language_model_against_counts(spark, documents):
    rows = {r.doc_id: r for r in op6_lm(spark, SF).collect()}
    assert len(rows) == len(documents)
    counts, n = Counter(), 0
    tokens = {i: [*(d.text or "").encode().lower().split(), None] for i, d in documents.items()}
    for i, words in tokens.items():
        if remainder(i, 7) != 2:
            counts.update(words)
            n += len(words)
    total = {True: [0.0, 0.0], False: [0.0, 0.0]}
    for i, words in tokens.items():
        r = rows[i]
        base = sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in words)
        assert r.n_tokens == len(words) and r.n_known == sum(counts[w] > 0 for w in words) and r.train_tokens == n
        assert r.held_out == (remainder(i, 7) == 2) and abs(r.base_score - base) < 1e-6 * abs(base) and r.score < 0
        total[r.held_out][0] += r.score
        total[r.held_out][1] += base
    assert all(model > base for model, base in total.values())


def test_language_model_is_a_distribution():
    mass = np.random.default_rng(1).random(lm.WIDTH**2) * 100
    model = lm.Model(lm.Layout(mass), [np.random.default_rng(k).normal(size=(n, lm.WIDTH)).astype(np.float32) for k, n in enumerate(lm.ROWS)])
    history = np.array([7, 40, 90], dtype=np.uint8)
    chance = 0.0
    for leaf in range(lm.WIDTH**2):
        tokens = np.append(history, np.uint8(leaf))
        chance += 10 ** model.log10(tokens, np.arange(4))[-1]
    assert abs(chance - 1) < 1e-4


def test_language_model_odd_rows(odd_documents, no_documents):
    from pyspark.sql import functions as F

    plain = odd_documents.select("doc_id", "text", (F.col("doc_id") == 7).alias("held_out"))
    rows = lm.score(plain).collect()
    assert len(rows) == 10 and {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {1}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [True]
    nothing = lm.score(plain.withColumn("held_out", F.lit(True))).collect()
    assert {r.train_tokens for r in nothing} == {0} and {r.n_known for r in nothing} == {0}
    assert lm.score(no_documents.select("doc_id", "text", F.lit(False).alias("held_out"))).count() == 0


def test_language_model_rounds_grow_with_the_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(lm, "ROUND_BLOCKS", 2)
    made, trainer = [], lm._trainer
    monkeypatch.setattr(lm, "_trainer", lambda *given: made.append(given) or trainer(*given))
    docs = spark.createDataFrame([(n, f"some words of text number {n} and more", n % 7 == 2) for n in range(60)], "doc_id long, text string, held_out boolean")
    for blocks in (6, 10):
        made.clear()
        assert lm.score(docs.repartition(blocks)).count() == 60
        assert len(made) == blocks // 2


def test_blocks_are_dealt_evenly():
    for n in (0, 1, 16, 17, 100):
        dealt = lm.deal([k << 32 for k in range(n)])
        shares = Counter((turn, worker) for _, turn, worker in dealt)
        assert sorted(b for b, _, _ in dealt) == [k << 32 for k in range(n)]
        assert len({turn for turn, _ in shares}) == -(-n // lm.ROUND_BLOCKS)
        assert max(shares.values(), default=0) <= lm.ROUND_BLOCKS // lm.ROUND_WORKERS
