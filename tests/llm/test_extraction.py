"""Extraction on written pages, and on the given pages against their article element."""

import html
import re
import time

import pytest
from pyspark.sql import types as T

from driftwise.llm.extraction import extract_main_text, main_text

LONG = "This sentence is a part of the article and has some length. " * 4
NOISE = """<html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>"</script></head><body class="has-sidebar">
<header><a href="/">Site</a></header><nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>
<div id="cookie-notice">We use cookies for a very long and dull list of reasons which nobody reads at all.</div>
<div class="ad">Buy this now, it is cheap and good and you need it.</div>%s
<aside>About the author, a long text about many things that are no article.</aside>
<form><label>Mail</label><input name=a><button>Go</button></form>
<section class="comments"><article class="comment"><p>First! I liked this one a lot, it is so very good to read.</p></article></section>
<footer>&copy; 2020 a site</footer></body></html>"""


@pytest.mark.parametrize(
    ("body", "text"),
    [
        (f"<article><h1>Title</h1><p>{LONG}</p><p>Ja.</p></article>", f"Title {LONG}Ja."),
        (f"<main><article><header><h1>A &amp; B</h1></header><p>{LONG}<br>x<b>y</b>z</article></main>", f"A & B {LONG}xyz"),
        (f"<div id=content><h1>T</h1><p>{LONG}</p><p>Ja.</p><ul><li>one<li>two</ul></div>", f"T {LONG}Ja. one two"),
        (f"<div class=wrap><div><h2>A</h2><section><p>{LONG}</p><p>{LONG}</p></section><section><p>{LONG}</p></section></div></div>", f"A {LONG}{LONG}{LONG}"),
        (f"<article><p><b>{LONG}<p>un<i>closed</article>", f"{LONG}unclosed"),
        (f"<article><p>{LONG}</p><div class='share'>Share</div><div class='comments'><p>{LONG}</p></div></article>", LONG),
        (f"<article><p>a&nbsp;&#65;&lt;b&gt; \n\t c</p><table><tr><td>1<td>2</table>{LONG}</article>", f"a A<b> c 1 2 {LONG}"),
        (f"<article class='post widget'><div class='entry-header'><h1 class='page-header'>T</h1></div><p>{LONG}</article>", f"T {LONG}"),
        ("", ""),
    ],
)
def test_noise_goes_and_the_article_stays(body, text):
    assert main_text(NOISE % body) == text.strip()


@pytest.mark.parametrize("source", [None, "", "   ", "<", "<p", "<!--", "</p>", "<html><body><nav>x</nav>", "<script>x"])
def test_pages_without_text(source):
    assert main_text(source) in ("", "<", "<p")


def test_plain_text_and_cut_off_pages():
    assert main_text("just text") == "just text"
    assert main_text(f"<html><body><article><p>{LONG}</p><p>and the en") == f"{LONG}and the en"


def test_time_is_linear():
    began = time.time()
    for piece in ("<a ", "<p>", "<div>", "</div>", "<!--", '<a b="', "<b><p>", "<script>", "&amp", "<li>x"):
        main_text(piece * 20_000)
    assert time.time() - began < 60


@pytest.mark.parametrize("quote", ["'", '"'])
def test_attribute_values_of_any_length(quote):
    uri = f"{quote}data:image/png;base64,{'iVBORw0KGgo>' * 9000}{quote}"
    for page in (
        f"<article><p>{LONG}</p><img src={uri} alt=x><p>Ja.</p></article>",
        f"<img src={uri}><div class=menu data-x={uri}>Menu, a long one with words and no links.</div><article><p>{LONG}</p><p>Ja.</p></article>",
    ):
        assert main_text(NOISE % page) == f"{LONG}Ja."


def test_time_is_linear_in_open_quotes():
    began = time.time()
    for piece in ('<a b="', "<a b='\"", '<a ""="', "<a b=\"' c='", "<a '\"'\"", "<a" + "x" * 40):
        main_text(piece * 20_000)
    main_text("<" + "a" * 300_000)
    assert time.time() - began < 20


@pytest.mark.parametrize("end", ["</script>", "</SCRIPT >", "</Script>"])
def test_letters_that_lower_makes_longer(end):
    page = f"<html><head><title>{'İ' * 40}stanbul</title></head><body><script>var a = 1{end}<article><p>İ {LONG}</article>"
    assert main_text(page) == f"İ {LONG}".strip()


SIDE = "<div class=sidebar><p>About us, a text of some words without a link.</p></div>"
TALK = "<div class=comments><p>First! I liked this one a lot, it is so very good to read.</p></div>"


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='has-sidebar'><div><h2>T</h2><p>{LONG}</p><p>{LONG}</p></div>{SIDE}{TALK}</div>",
        f"<div class='layout sidebar-right'><div class=widget-wrap><h2>T</h2><p>{LONG}</p><p>{LONG}</p></div>{SIDE}{TALK}</div>",
        f"<article class='post comments-off'><h2>T</h2><p>{LONG}</p><p>{LONG}</p></article>{SIDE}",
        f"<article class='post tag-feedback'><h2>T</h2><p>{LONG}</p><p>{LONG}</p>{TALK}</article>",
        f"<article class='post category-discussion related-2'><h2>T</h2><p>{LONG}</p><p>{LONG}</p></article>",
        f"<article class='post discussion'><h2>T</h2><p>{LONG}</p><p>{LONG}</p></article>",
        f"<div class='hidden md:block'><h2>T</h2><p>{LONG}</p><p>{LONG}</p></div><p hidden>{LONG}</p>",
        f"<div data-x='{{\"a\": \" class=ad hidden \"}}'><h2>T</h2><p>{LONG}</p><p>{LONG}</p></div>{SIDE}",
        f"<div class=discussion><h2>T</h2><p>{LONG}</p><p>{LONG}</p></div>",
    ],
)
def test_names_of_a_layout_or_a_subject_do_not_drop_the_text(page):
    assert main_text(f"<body>{page}</body>") == f"T {LONG}{LONG}".strip()


def test_long_comments_do_not_replace_the_article():
    talk = f"<div class=comments>{f'<p>{LONG}</p>' * 30}</div>"
    for tag in ("article", "div"):
        assert main_text(f"<body><{tag}><p>{LONG}</p><p>Ja.</p></{tag}>{talk}{SIDE}") == f"{LONG}Ja."
    side = f"<div class=sidebar>{f'<p>{LONG}</p>' * 5}</div>"
    assert main_text(f"<body><article><p>{LONG}</p></article>{side}") == LONG.strip()
    for hidden in ("hidden", "HIDDEN=''", "style='color:red; display : none'", "aria-hidden=true"):
        assert main_text(f"<body><div {hidden}>{talk}</div><p>{LONG}</p>") == LONG.strip()


def test_marks_alone_do_not_empty_a_page():
    assert main_text(f"<body><div class=comments><article class=comment><p>{LONG}</p></article><article class=reply><p>{LONG}</p></article></div>") == f"{LONG}{LONG}".strip()


CONTROLS = "<label for=a>Your mail</label><input id=a name=a><select><option>One<option>Two</select><button>Send</button>"


@pytest.mark.parametrize(
    "page",
    [
        f"<form id=f method=post><nav>Menu</nav><article><h2>T</h2><p>{LONG}</p><p>{LONG}</p></article>{CONTROLS}</form><p>Made by us.</p>",
        f"<form id=f method=post><div><h2>T</h2><p>{LONG}</p><p>{LONG}</p></div><div>{CONTROLS}</div>{TALK}</form>",
        f"<object><div><h2>T</h2><p>{LONG}</p><p>{LONG}</p></div></object>",
        f"<div><h2>T</h2><p>{LONG}</p><p>{LONG}</p><form><p>Write to us.</p>{CONTROLS}</form></div>",
        f"<article><h2>T</h2><p>{LONG}</p><p>{LONG}</p></article><form><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p>{CONTROLS}</form>",
    ],
)
def test_a_page_inside_a_form(page):
    assert main_text(f"<body>{page}</body>") == f"T {LONG}{LONG}".strip()


def test_formulas_and_pull_quotes_stay():
    formula = "<math><mi>a</mi><mo>=</mo><mn>1</mn><annotation encoding='application/x-tex'>a = 1</annotation></math>"
    quote = "<aside><p>A quote.</p></aside><aside class=sidebar><p>About us.</p></aside>"
    assert main_text(f"<body><article><p>{LONG}so {formula}.</p>{quote}</article><aside>{LONG}</aside>") == f"{LONG}so a=1. A quote."


def test_time_is_linear_on_mixed_broken_markup():
    def seconds(n):
        pages = [a * n + b * n for a, b in (("<span>", "</i>"), ("<b>", "<li>"), ("<div><span>", "</section>"), ("<p><i>", "<td></b>"))]
        pages += ["<header>" * n, "<b><body>" * n, "<ul><b><li>" * n, "<table><tr><td><i>" * n, "<form><p>x" * n]
        began = time.process_time()
        for page in pages:
            main_text(page)
        return time.process_time() - began

    seconds(1_000)
    assert seconds(40_000) < 6 * seconds(10_000) + 1


def test_given_pages(spark, sf_dir):
    """Their article is a known element; its text is what stands there without tags."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    rows = extract_main_text(pages).collect()
    assert len(rows) == len(source)
    for r in rows:
        article = re.search(r"(?s)<article>(.*?)</article>", source[r.page_id])[1]
        spaced = re.sub(r"(?i)</?(?:p|h1|br)>", " ", article)
        wanted = html.unescape(re.sub(r"<[^>]*>", "", spaced))
        assert r.text == " ".join(wanted.split()) and r.n_chars == len(r.text)


def test_nulls_repeats_clashing_names_and_empty_tables(spark):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])
    df = spark.createDataFrame([(None, None, None), (1, "u", "<p>a b"), (1, "u", "<p>a b")], schema)
    df = df.selectExpr("*", "1 AS text", "2 AS n_chars", "3 AS `a.b`")
    assert [tuple(r) for r in extract_main_text(df).collect()] == [(None, None, "", 0)] + [(1, "u", "a b", 3)] * 2
    assert extract_main_text(df.limit(0)).collect() == []
