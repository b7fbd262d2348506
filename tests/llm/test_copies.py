import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tailwise.llm import exact, near
from tailwise.session import materialise


def test_radix_trie_finds_equal_strings_only():
    draw = random.Random(1)
    for ordered in (False, True):
        texts = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 6))) for _ in range(300)]
        texts = sorted(texts) if ordered else texts
        trie, first = exact.RadixTrie(ordered), {}
        for n, text in enumerate(texts):
            assert trie.insert(text, n) == first.setdefault(text, n)


def test_sorted_insertion_keeps_one_path():
    trie = exact.RadixTrie(ordered=True)
    for n in range(1000):
        trie.insert(b"%06d" % n, n)
    size, stack = 0, [trie.root]
    while stack:
        node = stack.pop()
        size += 1
        stack += node.children.values()
    assert size < 80


def test_exact_rows(odd_documents, no_documents):
    rows = exact.exact_duplicates(odd_documents).collect()
    assert len(rows) == 10
    by = defaultdict(list)
    for r in rows:
        by[r.text_sha256].append(r)
    for group in by.values():
        ids = [r.doc_id for r in group]
        keep = max((i for i in ids if i is not None), default=None)
        assert all(r.keep_id == keep and r.group_size == len(group) for r in group)
        assert sum(r.kept for r in group) == 1
        assert [r.doc_id for r in group if r.kept] == [keep]
    assert exact.exact_duplicates(no_documents).count() == 0


def test_kept_rows_come_back_whole(odd_documents):
    kept = exact.without_duplicates(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(["1", "3", "4", "6", "7", "8", "None"])


def test_a_hot_text_over_many_partitions(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the same', concat('text ', id)) as text").repartition(9)
    rows = exact.exact_duplicates(df).filter("group_size > 1").collect()
    assert {(r.keep_id, r.group_size) for r in rows} == {(3999, 1334)} and sum(r.kept for r in rows) == 1


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_force(rows):
    """Class and number of links of every row, comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 10 * both >= 8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    smallest = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        smallest[find(i)].append(doc)
    return sorted((doc, min(smallest[find(i)]), links[i]) for i, (doc, _) in enumerate(rows))


@pytest.fixture(scope="module")
def edited():
    """Texts with one to three edits each, copies, short texts, a frequent passage."""
    draw = random.Random(7)
    words = [f"w{n}" for n in range(400)]
    passage = " ".join(draw.choice(words) for _ in range(60))
    rows = []
    for base in range(12):
        text = [draw.choice(words) for _ in range(draw.choice([6, 30, 120, 300]))]
        for _ in range(draw.randint(1, 9)):
            other = list(text)
            for _ in range(draw.randint(0, 3)):
                other[draw.randrange(len(other))] = draw.choice(words)
            rows.append((len(rows), " ".join(other)))
    for n in range(40):
        rows.append((len(rows), passage + " " + " ".join(draw.choice(words) for _ in range(draw.randint(5, 40)))))
    for text in ("one two", "one two", "ONE two", "three", "one two three four five"):
        rows.append((len(rows), text))
    return rows


@pytest.mark.parametrize("block", [512, 4])
def test_near_against_brute_force(spark, edited, block, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", block)
    df = spark.createDataFrame(edited, "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in near.near_duplicates(df).collect())
    assert got == brute_force(edited)


def test_near_query_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    from tailwise.llm.queries import op3_near_join

    assert sorted((r.doc_id, r.class_id, r.n_links) for r in op3_near_join(spark, sf).collect()) == brute_force(rows)


def test_near_odd_rows(odd_documents, no_documents):
    rows = near.near_duplicates(odd_documents).collect()
    assert len(rows) == 10
    by = {(r.doc_id, r.n_shingles): r for r in rows}
    assert [r.class_id for r in rows if r.doc_id in (5, 6)] == [5, 5]
    assert all(r.class_id == r.doc_id and r.n_links == 0 for r in rows if r.n_shingles == 0)
    assert all(r.n_links == 1 for r in rows if r.doc_id in (1, 5, 6)) and len(by) == 9
    assert near.near_duplicates(no_documents).count() == 0


def test_prefix_is_shortened_until_the_recall_is_met():
    length = near.prefix_length(0.8, 32, 0.99999)
    miss = lambda d: (1 - 0.8**d) ** 32
    assert 1 - miss(length) >= 0.99999 > 1 - miss(length + 1)
    with pytest.raises(ValueError):
        near.prefix_length(0.8, 1, 0.999)


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).selectExpr("id as a", "id + 1 as b")
    assert {r.component for r in near.components(edges).collect()} == {0}


def test_near_rows_without_identifier_are_linked(spark):
    words = [f"w{n}" for n in range(40)]
    changed = lambda at, word: " ".join(words[:at] + [word] + words[at + 1 :])
    other = [f"v{n}" for n in range(40)]
    rows = [(1, " ".join(words)), (None, changed(0, "x")), (None, changed(39, "y")), (None, " ".join(other)), (None, " ".join(other[:-1] + ["z"])), (None, ""), (7, "short one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit("extra"))
    got = near.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == sorted(
        [("1", "1", 2), ("None", "1", 2), ("None", "1", 2), ("None", "None", 1), ("None", "None", 1), ("None", "None", 0), ("7", "7", 0)]
    )
    kept = sorted((str(r.doc_id), r.text[:2]) for r in near.one_of_each(docs).collect())
    assert kept == [("1", "w0"), ("7", "sh"), ("None", ""), ("None", "v0")]


def test_keys_that_are_surely_not_among_others(spark):
    from tailwise.llm.common import maybe_among

    rows = spark.range(3000).selectExpr("if(id = 7, null, id) as k", "id as n")
    members = spark.range(0, 3000, 3).selectExpr("if(id = 6, null, id) as m")
    got = {r.n: r._maybe for r in maybe_among(rows, "k", members).collect()}
    assert len(got) == 3000 and not got[7]
    assert all(got[n] for n in range(0, 3000, 3) if n != 6)
    assert sum(got.values()) < 1300
    assert not any(r._maybe for r in maybe_among(rows, "k", members.limit(0)).collect())


def shuffled_rows(df):
    """Rows of each shuffle of an executed plan that carry a text."""
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            node = node.executedPlan()
            name = node.nodeName()
        if "QueryStage" in name:
            todo.append(node.plan())
            continue
        if name == "Exchange" and "text" in [a.name() for a in iterated(node.output())]:
            found += node.metrics().apply("shuffleRecordsWritten").value()
        todo += list(iterated(node.children()))
    return found


def iterated(sequence):
    return [sequence.apply(n) for n in range(sequence.size())]


@pytest.mark.parametrize("run", [exact.without_duplicates, near.one_of_each])
def test_texts_that_stay_are_not_shuffled(spark, run):
    """Fifty copies or near copies among 2000 texts: the others stay where they are."""
    draw = random.Random(5)
    rows = [(n, " ".join(f"w{draw.randrange(5000)}" for _ in range(40)) + f" {n}") for n in range(1950)]
    edit = (lambda text: text) if run is exact.without_duplicates else (lambda text: text.upper() + " x")
    rows += [(1950 + n, edit(text)) for n, text in rows[:50]]
    df = materialise(spark.createDataFrame(rows, "doc_id long, text string"), "texts")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = run(df)
        assert len(kept.collect()) == 1950
        assert shuffled_rows(kept) < 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
