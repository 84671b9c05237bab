"""Language, byte BPE, HTML, URL rules: against simple versions and on hard inputs."""

import hashlib
import html
import random
import re

import numpy as np
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from martloom.llm import byte_bpe, html_text, language_id, url_filter
from martloom.llm.queries import SITE_RULES, llm_oracles, llm_queries
from martloom.llm.token_rollup import _encoding

SF = "/root/testdata/sf0.001"
LETTERS = "aaaabbbcde  \n\n\t'sStTlL12é😀.,!?\x1c\x85 　"


def rows_of(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


# --- language -----------------------------------------------------------------------------------

def test_held_out_accuracy(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out")
    right, total = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 100 and right / total > 0.98


def test_language_ignores_labels_of_what_it_predicts(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    network = language_id.fit(documents)
    assert network is not None
    same = language_id.fit(documents.withColumn(
        "lang", F.when(language_id.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))))
    assert same.languages == network.languages and np.array_equal(same.weights, network.weights)


def test_fast_path_equals_a_plain_convolution():
    """Pair tables, the training path and a convolution byte by byte give one answer."""
    pick = np.random.default_rng(2)
    widths, n = language_id.WIDTHS, 3
    network = language_id.Network(
        ["a", "b", "c"], [pick.normal(size=(w, 256, language_id.FILTERS)).astype(np.float32) for w in widths],
        pick.normal(size=(len(widths) * language_id.FILTERS, 3)).astype(np.float32), pick.normal(size=3).astype(np.float32))
    windows = pick.integers(0, 256, (n, language_id.WINDOW)).astype(np.uint8)
    span = language_id.WINDOW - max(widths) + 1
    pooled = np.array([[max(0, *(sum(f[k, w[at + k], c] for k in range(len(f))) for at in range(span)))
                        for f in network.filters for c in range(language_id.FILTERS)] for w in windows])
    logits = pooled @ network.weights + network.bias
    want = np.exp(logits - logits.max(axis=1, keepdims=True))
    want /= want.sum(axis=1, keepdims=True)
    assert np.allclose(network.probabilities(windows, network.pair_tables()), want, atol=1e-3)
    assert np.allclose(network.pooled(windows)[0], pooled, atol=1e-3)


def test_every_language_is_learned(spark, docs):
    """More languages than any fixed number, one id for all rows of a language, ids that are null."""
    rows = [(None if n % 2 else 1, f"word{n} " * 9 + str(k), f"l{n:03d}", "s") for n in range(300) for k in range(2)]
    network = language_id.fit(docs(rows))
    assert network.languages == sorted({r[2] for r in rows})


def test_language_edges(spark, docs):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    network = language_id.fit(documents)
    got = rows_of(language_id.predict(docs([
        (1, None), (2, ""), (3, "12 345 ..."), (4, "the thing that is with them and was not here"), (5, "Ñ"),
        (6, "der und die das ist nicht " * 20_000), (None, "the")]), network))
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == "en" and got[6][0] == "de" and 1 / len(network.languages) <= got[6][1] <= 1 and got[5][0] in network.languages
    assert None in got
    assert language_id.fit(documents.limit(0)) is None
    assert rows_of(language_id.predict(docs([(1, "abc")]), None)) == {1: ("und", 0.0)}
    assert language_id.identify(documents.limit(0)).count() == 0
    twice = docs([(7, "and the"), (7, "and the")]).withColumn("score", F.lit(5)).withColumn("lang_pred", F.lit("x"))
    assert language_id.predict(twice, network).count() == 2


# --- byte BPE -----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBPE()


def test_bpe_equals_the_library(bpe):
    library, pick = _encoding("byte_bpe_50k"), random.Random(1)
    texts = ["".join(pick.choice(LETTERS) for _ in range(pick.randint(0, 80))) for _ in range(1500)]
    texts += [" " * 3000, "a" * 2000, "ab" * 3000, "<|endoftext|>", "I'd've 'S's"]
    for text in texts:
        ids = bpe.encode(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_edits_reencode_near_the_edit_only(bpe):
    library, pick = _encoding("byte_bpe_50k"), random.Random(2)
    state, text = byte_bpe.EditableText(bpe), ""
    for step in range(300):
        a = pick.randint(0, len(text))
        b = min(len(text), a + pick.randint(0, 5))
        new = "".join(pick.choice(LETTERS) for _ in range(pick.randint(0, 9)))
        if step % 3 == 0:
            a = b = len(text)
        state.edit(a, b, new)
        text = text[:a] + new + text[b:]
        assert state.ids() == library.encode_ordinary(text)
    long = byte_bpe.EditableText(bpe, "some words here, " * 2000)
    assert long.edit(17_000, 17_003, "xyz") < 12 and long.append(" more") < 8
    table = byte_bpe.PrefixTable(bpe.vocabulary, b"abcabcxyz" * 300)
    assert table.edit(900, 903, b"qq") < 400
    assert table.last == byte_bpe.PrefixTable(bpe.vocabulary, table.data).last


def test_bpe_rows(spark, docs, bpe):
    library = _encoding("byte_bpe_50k")
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    got, texts = rows_of(llm_queries()["op2_byte_bpe"](spark, SF)), rows_of(documents.select("doc_id", "text"))
    assert set(got) == set(texts)
    for doc, (text,) in texts.items():
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        assert got[doc] == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                            hashlib.sha256((text or "").encode()).hexdigest())
    edge = docs([(1, None), (2, ""), (None, "x"), (3, "é" * 50_000), (3, "é" * 50_000)]).withColumn("ids", F.lit("clash"))
    encoded = byte_bpe.encode_texts(edge)
    assert encoded.count() == 5 and rows_of(encoded)[1][0] == 0
    assert rows_of(byte_bpe.decode_ids(encoded))[3] == ("é" * 50_000,)
    assert byte_bpe.encode_texts(edge.limit(0)).count() == 0


# --- HTML ---------------------------------------------------------------------------------------

def test_main_text_of_all_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in html_text.extract_main_text(pages).collect()}
    for page in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        inner = re.sub(r"</?(p|h1|br)>", " ", inner).replace("<b>", "").replace("</b>", "")
        want = " ".join(html.unescape(inner).split())
        assert (got[page.page_id].text, got[page.page_id].n_chars) == (want, len(want))


PROSE = "A sentence, with commas, that is long enough to be read as a paragraph of the text."


@pytest.mark.parametrize("page, want", [
    ("", ""), ("   ", ""), ("plain, no markup &amp; so on", "plain, no markup & so on"),
    ("<script>var a = '<p>x</p>'", ""),
    (f"<div class='layout-sidebar'><nav><a href=x>a</a></nav><main><article><header>by me</header><h1>Title</h1>"
     f"<p>{PROSE}</p><form><label>name</label></form><div class=ad-box>{PROSE}</div><p>Last<br>one</p>"
     f"<section class=comments><article><p>{PROSE}</p></article></section></article></main><footer>x</footer></div>",
     f"Title {PROSE} Last one"),
    (f"<body><div id=menu><ul><li><a href=1>one</a><li><a href=2>two</a></ul></div><div class=content><h2>Head</h2>"
     f"<p>{PROSE}<p>{PROSE}</div><div id=comments><p>{PROSE}</p></div><div class=cookie-notice>{PROSE}</div>",
     f"Head {PROSE} {PROSE}"),
    (f"<article><p>a&nbsp;b &lt;i&gt; {PROSE}</p><ul><li>x</li><li>y</li></ul><ul class=toc><li><a href=1>one</a>"
     "<li><a href=2>two</a><li><a href=3>three</a></ul></article>", f"a b <i> {PROSE} x y"),
    ("<p>a < b, 5<6 and c > d</p>", "a < b, 5<6 and c > d"),
    # Names of places do not take prose out of an article; names of notices, and links or little text in it, do.
    (f"<article><p class='related-work'>{PROSE}</p><p class=search>{PROSE}</p><h2 class=header>Head</h2>"
     f"<p class='cookie-notice'>{PROSE}</p><p class=related><a href=1>{PROSE}</a></p><p class=share>Share</p>"
     f"<blockquote class=login>{PROSE}<form>{PROSE}</form></blockquote><p>{PROSE}</p></article>",
     f"{PROSE} {PROSE} Head {PROSE}"),
    (f"<article><p>one<b>two</b>three {PROSE}<!-- <p>no</p> --></p></article>", f"onetwothree {PROSE}"),
])
def test_page(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    # Names of wrappers and articles, with no <article> that is left.
    (f"<div class='page with-sidebar'><div class='content'><p>{PROSE}</p><p>{PROSE}</p></div>"
     "<div class=sidebar><p>Other</p></div></div>", f"{PROSE} {PROSE}"),
    (f"<div class='has-header'><div class='no-comments post'><p>{PROSE}</p></div></div>", PROSE),
    (f"<body><article class='post category-search'><h1>Title</h1><p>{PROSE}</p><p>Short</p></article></body>",
     f"Title {PROSE} Short"),
    (f"<main><article id=a class='post tag-advertising'><p>{PROSE}</p></article><p>More</p></main>", PROSE),
    # What they name stays out where the text is elsewhere, be it longer or not.
    (f"<div class=content><p>{PROSE}</p></div><div id=comments><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></div>", PROSE),
    (f"<article><p>{PROSE}</p></article><div class='left-sidebar'><p>{PROSE}</p><p>{PROSE}</p></div>", PROSE),
    (f"<div class='x-sidebar' style='display: none'><p>{PROSE}</p></div><p>Text, read.</p>", "Text, read."),
    # Short paragraphs and headings next to the best container.
    (f"<body><div class=a><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></div><h2>Head</h2><p>Short one</p><h3>Next</h3><p>{PROSE}</p>"
     f"<p>It ends.</p><p><a href=1>Log on.</a></p><div class=footer><p>{PROSE}</p></div></body>",
     f"{PROSE} {PROSE} {PROSE} {PROSE} Head Short one Next {PROSE} It ends."),
])
def test_page_without_a_plain_article(page, want):
    assert html_text.main_text(page) == want


def test_html_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>some, text</p>"), (3, "u", "<div>" * 5000 + "deep, text")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = html_text.extract_main_text(pages).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [
        (0, "some, text", 10), (1, "", 0), (1, "", 0), (3, "deep, text", 10)]
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


# --- URL rules ----------------------------------------------------------------------------------

def judged(url, rules):
    """The rules by string functions."""
    after = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host, rest = re.match(r"([^/?#]*)([^?#]*)", after, re.S).groups()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for name, verdict in rules:
        domain, slash, path = name.partition("/")
        if (host == domain or host.endswith("." + domain)) and rest.startswith(slash + path):
            fits.append((-len(name), name, verdict))
    best = min(fits) if fits else (0, None, "allow")
    return host, rest, best[1], best[2]


def test_url_rules_equal_sql_and_strings(spark):
    assert not compare(llm_queries()["op7_url_filters"](spark, SF), duck(SF), llm_oracles()["op7_url_filters"])
    rules = [(r.name, r.verdict) for r in SITE_RULES]
    pick = random.Random(3)
    parts = ["http://", "https://", "://", "example.net", "EXAMPLE.com", ".", "a", "net", "org", "/", "/en/", "/de/",
             "/fr/", "?", "#", "x.net/y", "é", " ", "\n", "notexample.net"]
    urls = [None, "", "net/", "http://net", "http://net/", "http://a.netÿ/"] + [
        "".join(pick.choice(parts) for _ in range(pick.randint(1, 9))) for _ in range(1500)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit("clash"))
    got = rows_of(url_filter.judge_urls(pages, SITE_RULES))
    for k, url in enumerate(urls):
        assert got[k] == judged(url, rules), url
    assert url_filter.judge_urls(pages.limit(0), SITE_RULES).count() == 0
    assert set(r.verdict for r in url_filter.judge_urls(pages, []).collect()) == {"allow"}


def test_many_globs_in_several_words():
    names = [f"ads{k}.*.example/x*y" for k in range(60)] + ["*/**/banner/**"]
    automaton = url_filter.Automaton([url_filter.glob_rule(n, "block") for n in names])
    assert automaton.words > 5

    def found(host, path):
        k = automaton.match([b"." + host + bytes([url_filter.BORDER]) + path])[0]
        return automaton.rules[k].name if k >= 0 else None
    assert found(b"ads7.eu.example", b"/xaay") == "ads7.*.example/x*y"
    assert found(b"www.ads59.a.b.example", b"/xy") == "ads59.*.example/x*y"
    assert found(b"ads7.example", b"/xy") is None and found(b"ads7.eu.example", b"/xyz") is None
    assert found(b"any.host", b"/a/banner/b") == "*/**/banner/**" and found(b"", b"") is None
