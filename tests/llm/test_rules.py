import pytest
from tailwise.llm import html, mix, oracle, quality, urls
from tailwise.llm.queries import QUERIES
from tests_compare import check_sql


@pytest.mark.parametrize("name", sorted(oracle.STATEMENTS))
def test_query_matches_sql(spark, sf, name):
    check_sql(QUERIES[name](spark, sf), sf, oracle.STATEMENTS[name])


def water_filled(sizes, weights, epochs):
    total, clamped = sum(sizes), set()
    while True:
        open_weight = sum(w for i, w in enumerate(weights) if i not in clamped)
        left = total - sum(epochs * sizes[i] for i in clamped)
        shares = [epochs * s if i in clamped else weights[i] * left / open_weight for i, s in enumerate(sizes)]
        above = {i for i, s in enumerate(sizes) if shares[i] > epochs * s and i not in clamped}
        if not above:
            return shares
        clamped |= above


@pytest.mark.parametrize("sizes", [[10, 500, 500, 40], [0, 0], [7], [1, 1, 1, 9000], [100, 0, 30]])
def test_targets(spark, sizes):
    weights = [[5.0, 2.0, 1.0][i % 3] for i in range(len(sizes))]
    df = spark.createDataFrame([(f"s{i}", s, w) for i, (s, w) in enumerate(zip(sizes, weights))], "source string, source_size long, weight double")
    got = [r.target for r in mix.targets(df, 3).orderBy("source").collect()]
    expected = water_filled(sizes, weights, 3) if sum(sizes) else [0.0] * len(sizes)
    assert got == pytest.approx(expected)


def test_mix_odd_rows(odd_documents, no_documents):
    rows = mix.mix(odd_documents, (5, 2, 1)).collect()
    assert len(rows) == 10
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert sum(r.taken for r in own) == round(own[0].target) and all(0 <= r.taken <= 3 * r["size"] for r in own)
    assert rows and sorted(map(tuple, rows), key=str) == sorted(map(tuple, mix.mix(odd_documents, (5, 2, 1)).collect()), key=str)
    assert mix.mix(no_documents, (5, 2, 1)).count() == 0


def test_mixed_documents_hold_the_words_taken(odd_documents):
    docs = odd_documents.select("doc_id", "text", "lang", "source", "n_chars")
    taken = mix.mix(docs, (5, 2, 1)).agg({"taken": "sum"}).first()[0]
    made = mix.mixed_documents(docs, (5, 2, 1))
    assert made.columns == docs.columns
    assert made.select(mix.word_count(made.text).alias("n")).agg({"n": "sum"}).first()[0] == taken


def plain_counts(text):
    words = text.encode().split()
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered.update(range(i, i + 8))
    return len(words), len(covered)


def test_quality_counts(spark):
    texts = ["a b c d e f g h " * 3, "x y " * 30, "one two three", "", None, "a b c d e f g h z a b c d e f g h i " + "k l m n o p q r"]
    df = spark.createDataFrame([(n, "h", t) for n, t in enumerate(texts)], "doc_id long, source string, text string")
    for r in quality.assess(df).collect():
        assert (r.n_words, r.n_repeat_words) == plain_counts(texts[r.doc_id] or "")


def test_frequent_lines_deplete(spark):
    own = [f"own line {n} with words that only this text has and some more to say {n}" for n in range(60)]
    shared = "subscribe to our letter and read the terms of use before you go on from here"
    rows = [(n, "h", f"{shared}\n{own[n]}\nand a second line of other words, so that most of text number {n} is left over" if n < 40 else shared + ("\n" + shared) * 1 + f"\nw{n} " * 1) for n in range(60)]
    rows += [(100 + n, "other", f"{shared}\n{own[n]} again") for n in range(15)]
    got = {r.doc_id: r for r in quality.assess(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert all(got[n].kept and got[n].n_left < got[n].n_words for n in range(40))
    assert not any(got[n].kept for n in range(40, 60))
    assert all(got[100 + n].n_left == got[100 + n].n_words for n in range(15))


@pytest.mark.parametrize("n_clean", [0, 100, 700])
def test_clean_documents_do_not_let_boilerplate_through(spark, n_clean):
    lines = "\n".join(["accept all cookies and read our terms before you go on", "share this page with your friends on every network"])
    rows = [(n, "h", f"{lines}\nonly {n}a here") for n in range(60)]
    rows += [(1000 + n, "h", f"a clean text number {n} that says what no other one of this host says, twenty words or more, w{n} x{n} y{n} z{n}") for n in range(n_clean)]
    got = {r.doc_id: r for r in quality.assess(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert {got[n].n_left for n in range(60)} == {3} and not any(got[n].kept for n in range(60))
    assert all(got[1000 + n].kept and got[1000 + n].n_left == got[1000 + n].n_words for n in range(n_clean))


def test_quality_odd_rows(odd_documents, no_documents):
    rows = quality.assess(odd_documents).collect()
    assert len(rows) == 10 and not any(r.kept for r in rows)
    assert quality.assess(no_documents).count() == 0


@pytest.mark.parametrize(
    "url, host, path",
    [
        ("http://A.Example.COM/en/1?x#y", "a.example.com", "/en/1"),
        ("x://h", "h", ""),
        ("x://h?q=/a", "h", ""),
        ("no scheme", "", ""),
        (None, "", ""),
        ("a://b://c/d", "b:", "//c/d"),
        ("://ÄB/ü", "Äb", "/ü"),
    ],
)
def test_url_parts(spark, url, host, path):
    df = spark.createDataFrame([(url,)], "url string")
    row = df.select(urls.host_of(df.url).alias("h"), urls.path_of(df.url).alias("p")).first()
    assert (row.h, row.p) == (host, path)


def test_reputation_shrinks_towards_the_domain(spark):
    outcomes = [("bad.spam.net", 1)] * 30 + [("good.fine.com", 0)] * 60 + [("one.fine.com", 1)] + [("also.spam.net", 1)] * 20
    outcomes = spark.createDataFrame(outcomes, "host string, bad int")
    pages = [(1, "http://bad.spam.net/x"), (2, "http://new.spam.net/"), (3, "http://one.fine.com/"), (4, None), (5, "http://good.fine.com/en/"), (5, "http://good.fine.com/en/")]
    pages = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "'x' as host", "'y' as verdict")
    got = {r.page_id: r for r in urls.judge(pages, [("fine.com/en/", "block")], outcomes).collect()}
    assert urls.judge(pages, [], outcomes).count() == 6
    assert (got[1].verdict, got[3].verdict, got[5].verdict, got[5].rule) == ("block", "allow", "block", "fine.com/en/")
    assert got[2].bad_rate > 0.8 and got[3].bad_rate < 0.5 and got[4].host == ""
    assert urls.judge(pages.limit(0), [], outcomes.limit(0)).count() == 0
    assert {r.verdict for r in urls.judge(pages, [], outcomes.limit(0)).collect()} == {"allow"}


@pytest.mark.parametrize(
    "host, domain, suffix",
    [
        ("www.fine.co.uk", "fine.co.uk", "co.uk"),
        ("fine.com.au", "fine.com.au", "com.au"),
        ("co.uk", "co.uk", "co.uk"),
        ("a.b.example.com", "example.com", "com"),
        ("shop.disco.uk", "disco.uk", "uk"),
        ("www.co.com", "co.com", "com"),
        ("127.0.0.1:80", "127.0.0.1:80", "127.0.0.1:80"),
        ("local", "local", "local"),
        ("", "", ""),
    ],
)
def test_registered_domains(spark, host, domain, suffix):
    df = spark.createDataFrame([(host,)], "host string")
    assert tuple(df.select(urls.domain_of(df.host), urls.suffix_of(df.host)).first()) == (domain, suffix)


def test_bad_hosts_do_not_block_others_of_a_country_suffix(spark):
    bad = [(f"spam{n}.co.uk", 1) for n in range(40) for _ in range(30)]
    good = [(f"good{n}.co.uk", 0) for n in range(60) for _ in range(30)] + [(f"g{n}.com", 0) for n in range(60) for _ in range(30)]
    outcomes = spark.createDataFrame(bad + good, "host string, bad int")
    pages = spark.createDataFrame([(1, "http://fine.co.uk/"), (2, "http://spam1.co.uk/"), (3, "http://new.spam1.co.uk/")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge(pages, [], outcomes).collect()}
    assert got == {1: "allow", 2: "block", 3: "block"}


MENU = "<ul class='menu'><li><a href=a>Home</a></li><li><a href=b>About us</a></li></ul>"
ARTICLE = "<h1>A title</h1><p>First <b>bold</b> paragraph, long enough to count as text &amp; more of it, on and on.</p><p>Short.</p>"
TEXT = "A title\nFirst bold paragraph, long enough to count as text & more of it, on and on.\nShort."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>t</title></head><body><nav>{MENU}</nav><article>{ARTICLE}</article><footer>end</footer></body></html>",
        f"<body>{MENU}<div id=content>{ARTICLE}</div><div class='sidebar'>buy this now, all of you who read it here today and tomorrow</div>",
        f"<script>var a='</p><p>x';</script><main>{ARTICLE}<aside>aside</aside><form>send<input></form></main><section id=comments><p>I like it very much indeed</p></section>",
        f"<article>{ARTICLE}<!-- <p>no</p> --><style>p{{}}</style>",
        f"<div class='cookie-notice'>We use cookies for many reasons that we list at length in this text here</div>{ARTICLE}",
    ],
)
def test_pages(page):
    assert html.main_text(page) == TEXT


def test_page_odd_rows(spark):
    pages = [(1, None), (2, ""), (3, "   "), (4, "<<<>>"), (5, "plain words only"), (5, "plain words only"), (6, "<p>" * 5000 + "deep &#x41;&nbsp;b" )]
    df = spark.createDataFrame(pages, "page_id long, html string").selectExpr("*", "'u' as url")
    got = html.extract(df)
    assert got.columns == ["page_id", "url", "text"]
    texts = sorted((r.page_id, r.text) for r in got.collect())
    assert [t for i, t in texts if i in (1, 2, 3)] == ["", "", ""]
    assert [t for i, t in texts if i >= 5] == ["plain words only", "plain words only", "deep A b"]
    assert html.extract(df.limit(0)).count() == 0


def test_query_texts_are_the_articles(spark, sf):
    from tailwise.llm.queries import op9_html_text

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    import html as entities
    import re

    for r in op9_html_text(spark, sf).collect():
        page = pages[r.page_id]
        body = page[page.find("<article>") : page.find("</article>")]
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


LONG = "Body text in plain blocks, long enough to be the main text of this page, and it goes on for a while."


@pytest.mark.parametrize(
    "page",
    [
        f"<body><article><a href=x>Read this story</a></article><div><div>{LONG}</div><div>Short.</div></div>",
        f"<body><div><div>{LONG}</div><div>Short.</div></div><article><p>Teaser: a short story</p></article>",
        f"<article><div>{LONG}</div><p>Short.</p></article><article class='comment odd'><p>{LONG}</p></article>",
        f"<article hidden><p>{LONG}</p></article><main class=has-sidebar><div>{LONG}</div><p>Short.</p></main>",
        f"<article><div>{LONG}</div><p>Short.</p></article><article><p>More</p></article>",
    ],
)
def test_windows_choose_where_articles_are_marked(page):
    assert html.main_text(page) == f"{LONG}\nShort."


def test_a_mark_is_a_weight():
    short = "A text of about sixty letters that a page marks as the main one of all."
    page = f"<div>{LONG * 3}</div>"
    assert html.main_text(f"{page}<article><p>{short}</p></article>") == f"{LONG * 3}\n{short}"
    assert html.main_text(f"{page}{'<br><div></div>' * 4}<section><p>{short}</p></section>") == LONG * 3


PAGE = f"<h1>A title</h1><p>{LONG}</p>"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div class='no-sidebar'>{PAGE}</div>", f"A title\n{LONG}"),
        (f"<div class='page search-enabled comments-open'>{PAGE}</div>", f"A title\n{LONG}"),
        (f"<div class='alert alert-story'>{PAGE}</div><p>ok</p>", f"A title\n{LONG}\nok"),
        (f"<div class='site-sidebar'>{LONG}</div><div>{PAGE}</div>", f"A title\n{LONG}"),
        (f"<article><p>{LONG}</p><aside>{LONG}</aside><p>Short end, of note.</p></article>", f"{LONG}\nShort end, of note."),
        (f"<div><p>{LONG}</p><aside>{LONG}</aside><p>Short end, of note.</p></div>", f"{LONG}\nShort end, of note."),
        (f"<article><h1>A title</h1><div class='share bar'>send</div><p>{LONG}</p></article>", f"A title\n{LONG}"),
        (f"<div><h1>A title</h1><form>send</form><p>{LONG}</p></div>", f"A title\n{LONG}"),
        (f"<div><p>{LONG} <button>more</button> and <span class='ad'>buy</span>end.</p></div>", f"{LONG} and end."),
        (f"<ul><li class='promo'>buy<li>{LONG}</ul>", LONG),
        (f"<div class='comments'><p>{LONG * 20}</p></div><p>{LONG}</p>", LONG),
        (f"<div><div><p>{LONG}</p></div><div class='sidebar'>x</div><div>Copyright</div></div>", LONG),
    ],
)
def test_names_and_removed_children_take_no_main_text(page, text):
    assert html.main_text(page) == text


def test_page_columns_that_clash(spark):
    df = spark.createDataFrame([(1, "<p>x</p>", "y")], "page_id long, html string, text string")
    with pytest.raises(ValueError, match="text"):
        html.extract(df)


def test_long_page_is_read_whole():
    page = "<div>" + f"<p>{LONG}</p>" * 20000 + "</div>"
    assert html.main_text(page).count(LONG) == 20000
