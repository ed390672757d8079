"""Extraction of known articles under many layouts, and of every page of the given table."""

import re
from html import unescape

import pytest

from hypothesis import given, settings, strategies as st

from worklens.llm import html_text

LONG = "Words of an article that go on for quite a while, as the sentences of articles do."


@pytest.fixture(scope="module")
def nodes(spark):
    return html_text.train(spark)


def test_labelled_table_is_learned(nodes):
    for page in html_text.LABELLED_PAGES:
        found = html_text.blocks(page)
        for b, x in zip(found, html_text.features(found)):
            assert html_text.kept(nodes, x) == (b.label == "1"), (b, x)


def test_given_pages(spark, nodes):
    """These pages have one article element; what it holds, block by block, is the main text."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    wrong = 0
    for r in html_text.extract(pages, nodes).collect():
        inside = re.search(r"(?s)<article>(.*?)(</article>|$)", r.html)[1]
        parts = (" ".join(unescape(re.sub(r"<[^>]*>", " ", p)).split())
                 for p in re.split(r"</?(?:p|h1|li|ul)\b[^>]*>", inside))
        wrong += r.text.split("\n") != [p for p in parts if p]
        assert r.n_chars == len(r.text)
    assert wrong == 0


@pytest.mark.parametrize("page", [
    f"<body><header><a href=/>Site</a></header><div id='content'><h1>T</h1><p>{LONG}<p>Short.<p>{LONG}"
    f"</div><div class='sidebar'><p>{LONG}</div></body>",
    f"<nav><a>x</a></nav><main><h1>T</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
    f"<section class=comments><p>{LONG}</p></section></main><footer>{LONG}</footer>",
    f"<article><h1>T</h1><p>{LONG}</p><p>Short.</p><aside>{LONG}</aside><form><p>Your mail</p></form>"
    f"<p>{LONG}</p></article><div class='cookie-consent'><p>{LONG}</p></div>",
    f"<article><h1>T</h1><!-- <p>no</p> --><p>{LONG}<script>if (a<b) '</p>'</script></p>"
    f"<style>p{{}}</style><p>Short.<div class='ad'>{LONG}</div><p>{LONG}</article><footer>x",
])
def test_layouts(nodes, page):
    assert html_text.main_text(page, nodes) == f"T\n{LONG}\nShort.\n{LONG}"


@pytest.mark.parametrize("page,text", [
    ("", ""), ("<article>a&nbsp;&amp;\n b<br>c</article>", "a & b c"), ("<article>x<p>y < z</article>", "x\ny < z"),
    ("<article>a<b>b</b>c <i>d</i></article>", "abc d"), ("<article>x<!-- y", "x"),
    ("<article>x<script>y", "x"), ("<article>x <a href='y", "x"), ("<article title='a>b'>x</article>", "x"),
    ("<p>" * 5000 + "</p>" * 5000, ""), ("<" * 5000, "<" * 5000), ("<article><div hidden>a</div>b", "b"),
])
def test_odd_markup(nodes, page, text):
    out = html_text.main_text(page, nodes)
    assert out == text or page.startswith("<<")


def test_edges(spark, nodes):
    page = "<article>" + "<p>word word word</p>" * 50_000 + "</article>"
    rows = [(1, "u", None, 1), (2, "u", "", 2), (3, None, page, 3), (3, None, page, 3), (4, "v", "a퟿", 4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    out = {r.page_id: r for r in html_text.extract(df, nodes).collect()}
    assert out[1].text == out[2].text == "" and out[3].n_chars == 50_000 * 15 - 1
    assert html_text.extract(df, nodes).count() == 5
    assert html_text.extract(df.where("false"), nodes).count() == 0


def said(page):
    return "\n".join(b.text for b in html_text.blocks(page))


def test_stray_quotes_hide_nothing():
    assert said("<p title=it's>First words here.</p><p>Don't stop.</p><p>End.</p>") == (
        "First words here.\nDon't stop.\nEnd.")
    assert said("<p data-x=5\">One</p><p>\"Two\"</p>") == 'One\n"Two"'
    assert said("<p title=\"a > b\">One</p><p 'x>Two</p><p a='never>Three") == "One\nTwo\nThree"
    assert said("<p a=b=\"c>One</p><p>\"</p>") == 'One\n"'
    assert said("<!-->One<!-- a > b --!>Two") == "OneTwo"


def test_inline_elements_that_are_not_seen():
    assert said("<p>a<span style='display: none'>hid</span>b") == "ab"
    assert said("<p>a <span class=ad>Buy <span>now</span></span> b") == "a b"
    assert said("<p>a <b class=x hidden>no</b>b <i aria-hidden=true>no") == "a b"
    assert said("<div>a <span hidden>no<p>no</p></span>b</div><p>c") == "a\nb\nc"
    assert said("<div>a <span hidden>never closed</div><p>b") == "a\nb"
    assert said("<div class=x hidden>no</div><p data-hidden=1>yes") == "yes"


def test_any_depth():
    deep = "<div>" * 5000
    assert said(deep + "<div hidden>no</div>yes" + "</div>" * 5000 + "<p>end") == "yes\nend"
    found = html_text.blocks(deep + "<nav><p>menu</nav><p>text")
    assert [b.boilerplate for b in found] == [1, 0]
    html_text.blocks(deep + "</x>" * 200_000)  # linear: an unopened name is not looked for


ATTRIBUTES = st.sampled_from(
    ["", " a=1", " a='>'", ' a="<p>"', " a=it's", ' a=5"', ' "', " '", " a = 'x y'", " a=b=\"c",
     " a", "/", " a='x'b"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(
    st.sampled_from(["one", "two ", " 3 < 4", "it's", 'say "so"', "&amp;", "<!-- no > -->", "a=b"]),
    st.builds(lambda n, a: f"<{n}{a}>", st.sampled_from("p div b span li h1 section".split()),
              ATTRIBUTES),
    st.builds(lambda n: f"</{n}>", st.sampled_from("p div b span li h1 section".split())))))
def test_text_of_random_markup(parts):
    """The same characters in the same order as the standard library's parser reports."""
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def handle_data(self, data):
            seen.append(data)

    page, seen = "".join(parts) + " ", []
    parser = Plain()
    parser.feed(page)
    parser.close()
    assert "".join(said(page).split()) == "".join("".join(seen).split())
