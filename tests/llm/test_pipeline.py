import corpus_pipeline
import pytest
from tailwise.llm import bpe, exact, near
from tailwise.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def staged(spark, sf, tmp_path_factory):
    """Every stage's input and output, written and read again."""
    docs, made = spark.read.parquet(f"{sf}/documents.parquet"), []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(n))
        stage(spark, docs, sf).write.parquet(path)
        made.append((name, docs, spark.read.parquet(path)))
        docs = made[-1][2]
    return made


def test_stages_return_documents(staged):
    assert all(after.columns == ["doc_id", "text", "lang", "source", "n_chars"] for _, _, after in staged[:-1])
    assert all(after.count() > 0 for _, _, after in staged)


def test_language_keeps_texts_with_letters(staged):
    _, before, after = staged[0]
    assert after.count() > 0.95 * before.count()


def test_language_keeps_texts_that_mix_known_languages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    by = {}
    for r in docs.orderBy("doc_id").collect():
        by[r.lang] = (by.get(r.lang, "") + " " + (r.text or ""))[:4000]
    assert len(by) == 4
    mixed = " ".join(by[name] for name in sorted(by))
    rows = [(10**9, mixed, None, "s", len(mixed)), (10**9 + 1, "Съешь ещё этих мягких французских булок " * 60, None, "s", 2400)]
    more = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = corpus_pipeline.known_language(spark, more, sf).filter(f"doc_id >= {10**9}").collect()
    assert [(r.doc_id, r.text) for r in kept] == [(10**9, mixed)]


def test_one_of_each_group_of_copies_stays(staged):
    _, before, after = staged[1]
    kept = {r.doc_id for r in exact.exact_duplicates(before).filter("kept").collect()}
    assert {r.doc_id for r in after.collect()} == kept
    _, before, after = staged[2]
    classes = {r.class_id for r in near.near_duplicates(before).collect()}
    assert {r.doc_id for r in after.collect()} == classes


def test_tokens_decode(staged):
    _, before, after = staged[4]
    assert after.count() == before.count() and after.filter("not round_trip").count() == 0


def test_tokens_take_one_worker_a_task(spark, sf, odd_documents, monkeypatch):
    plans, write = [], corpus_pipeline.materialise

    def written(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(corpus_pipeline, "materialise", written)
    done = corpus_pipeline.tokenised(spark, odd_documents, sf)
    plans.append(done._jdf.queryExecution().executedPlan().toString())
    assert [plan.count("MapInArrow") for plan in plans] == [1, 1]


def test_tokens_of_odd_rows(spark, sf, odd_documents):
    vocabulary = bpe.read_vocabulary(vocabulary_path())
    ids = ["doc_id", "lang", "source", "n_chars", "ids"]
    done = corpus_pipeline.tokenised(spark, odd_documents, sf)
    assert done.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "round_trip"]
    got = [tuple(r) for r in done.select(ids).collect()]
    assert sorted(got, key=repr) == sorted((tuple(r) for r in bpe.encode(odd_documents, vocabulary).select(ids).collect()), key=repr)
    assert done.filter("round_trip AND n_tokens = octet_length(ids) / 4").count() == len(got) == odd_documents.count()


def test_run_gives_the_last_stage(spark, sf, staged):
    columns = ["doc_id", "n_tokens", "n_chars"]
    got = sorted(map(tuple, corpus_pipeline.run(spark, sf).select(columns).collect()))
    assert got == sorted(map(tuple, staged[-1][2].select(columns).collect()))


def test_stages_take_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0
