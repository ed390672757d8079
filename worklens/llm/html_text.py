"""HTML extraction: flat text blocks classified by a decision tree.

A page becomes its text blocks in order. Each block has its word count and link density, those of
its neighbours, and what its enclosing elements say: a heading, an article, or something whose tag,
class, id or role names a menu, footer, sidebar, notice, advert, form or comment. A decision tree,
trained by Spark on the small labelled pages below, keeps or drops each block.

Defined results: a NULL page is an empty page and gives an empty text; malformed markup never fails
(an unclosed comment, script or tag hides the rest of the page, as in a browser; a quote that opens
no value or is never closed hides nothing); elements may be nested to any depth; hidden inline
elements and inline adverts are left out of their block, other inline elements belong to it; inside a block
white space becomes one space and character references are decoded; kept blocks are joined by one
line feed; equal pages give equal texts; other columns pass through; no rows give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from worklens.llm.common import bounded_batches

# -- fixed values: kinds of elements -----------------------------------------------------------

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s "
    "samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style noscript template iframe object svg math canvas audio video "
                   "select textarea button option datalist".split())
RAW = frozenset("script style noscript template iframe svg math canvas textarea select title "
                "xmp".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset".split())
ARTICLE = frozenset("article main".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: words in class, id and role
BAD_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adbox banner sponsor sponsored promo promotion nav "
    "navbar navigation menu menubar breadcrumb breadcrumbs footer header masthead topbar toolbar "
    "sidebar aside widget related recommended share sharing social cookie cookies consent gdpr notice "
    "alert popup modal overlay comment comments respond reply replies disqus login signup subscribe "
    "subscription newsletter form search pagination pager copyright legal disclaimer contentinfo "
    "complementary".split())
GOOD_WORDS = frozenset("article content post entry story main body text".split())

#: names of inline elements that are adverts; other inline elements belong to their block
ADVERT_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adbox sponsor sponsored promo promotion".split())

# a quote opens a value only right after the equals sign; elsewhere, and where it is never closed,
# it is an ordinary character
_VALUE = r"\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+"
_MARKUP = re.compile(
    r"<(?:!--(?P<comment>)|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    rf"(?P<rest>(?:[^>=]++|=\s*+(?:{_VALUE})?+)*+)>|[!?/][^>]*>)")
_ATTRIBUTE = re.compile(rf"([^\s/>=]+)(?:\s*=\s*({_VALUE})?)?")
_COMMENT_END = re.compile("--!?>")
_WORD = re.compile(r"[a-z]+")


class Block(NamedTuple):
    text: str
    words: int
    links: float  # share of the words inside links
    article: int
    boilerplate: int
    heading: int
    good: int
    label: str | None


class _Element(NamedTuple):
    name: str
    article: int
    boilerplate: int
    heading: int
    good: int
    hidden: bool
    label: str | None


def blocks(html: str) -> list[Block]:
    """The page's text blocks in order, hidden elements left out. Linear in the page."""
    found: list[Block] = []
    stack = [_Element("", 0, 0, 0, 0, False, None)]
    opened: Counter[str] = Counter()  # how many of each name are on the stack
    muted: list | None = None  # inline element whose text is left out: name, depth in it, stack size
    texts: list[str] = []
    linked: list[str] = []
    in_link = False

    def flush() -> None:
        if texts:
            text = " ".join(unescape("".join(texts)).split())
            if text:
                words = len(text.split(" "))
                of_links = len(unescape(" ".join(linked)).split())
                top = stack[-1]
                found.append(Block(text, words, min(1.0, of_links / words), top.article,
                                   top.boilerplate, top.heading, top.good, top.label))
            texts.clear()
            linked.clear()

    at, lower = 0, None
    while at < len(html):
        tag = _MARKUP.search(html, at)
        text = html[at:tag.start() if tag else len(html)]
        if tag is None:  # text up to the end, or up to a tag that is never closed
            cut = re.search(r"<[a-zA-Z/!?]", text)
            text = text[:cut.start()] if cut else text
        if text and not stack[-1].hidden and muted is None:
            texts.append(text)
            if in_link:
                linked.append(text)
        if tag is None:
            break
        at = tag.end()
        if tag["comment"] is not None:
            end = _COMMENT_END.search(html, tag.start() + 2)
            at = end.end() if end else len(html)
            continue
        if tag["name"] is None:
            continue
        name = tag["name"].lower()
        if name in INLINE:
            if name == "a":
                in_link = not tag["close"]
            if name == "br":
                texts.append(" ")
            elif muted is not None and muted[0] == name:
                muted[1] += -1 if tag["close"] else 1
                if not muted[1]:
                    muted = None
            elif muted is None and not tag["close"] and name not in VOID and _unseen(tag["rest"]):
                muted = [name, 1, len(stack)]
            continue
        flush()
        in_link = False
        if tag["close"]:
            if opened[name]:
                while True:
                    last = stack.pop().name
                    opened[last] -= 1
                    if last == name:
                        break
                if muted is not None and len(stack) < muted[2]:
                    muted = None  # ends with the block it was opened in
            continue
        if name in RAW and not tag["rest"].endswith("/"):
            lower = html.lower() if lower is None else lower
            end = lower.find(f"</{name}", at) if len(lower) == len(html) else -1
            if len(lower) != len(html):  # letters that change length in lower case
                closing = re.compile(f"</{name}", re.IGNORECASE).search(html, at)
                end = closing.start() if closing else -1
            close = html.find(">", end) if end >= 0 else -1
            at = len(html) if close < 0 else close + 1
            continue
        if name in VOID or tag["rest"].endswith("/"):
            continue
        if (name in ("p", "li", "td", "th", "tr", "dt", "dd") and stack[-1].name == name
                or stack[-1].name == "p"):
            opened[stack.pop().name] -= 1
            if muted is not None and len(stack) < muted[2]:
                muted = None
        stack.append(_opened(name, tag["rest"], stack[-1]))
        opened[name] += 1
    flush()
    return found


def _attributes(rest: str) -> dict[str, str]:
    """Names in lower case and values of a tag; the first of equal names counts."""
    said: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(rest):
        bare = value[1:-1] if value[:1] in ("'", '"') else value
        said.setdefault(name.lower(), bare.lower())
    return said


def _is_hidden(said: dict[str, str]) -> bool:
    return ("hidden" in said or said.get("aria-hidden") == "true"
            or "display:none" in said.get("style", "").replace(" ", ""))


def _named(said: dict[str, str]) -> set[str]:
    return set(_WORD.findall(" ".join(said.get(k, "") for k in ("class", "id", "role"))))


def _unseen(rest: str) -> bool:
    """Whether an inline element is hidden or an advert."""
    said = _attributes(rest) if rest.strip() else {}
    return bool(said) and (_is_hidden(said) or bool(_named(said) & ADVERT_WORDS))


def _opened(name: str, rest: str, above: _Element) -> _Element:
    boilerplate, good, hidden, label = above.boilerplate, above.good, above.hidden, above.label
    article = above.article or int(name in ARTICLE)
    if name in BOILERPLATE or name == "header" and not above.article:
        boilerplate = 1
    if name in HIDDEN:
        hidden = True
    if rest.strip():
        said = _attributes(rest)
        if name not in ("html", "body"):
            words = _named(said)
            boilerplate = int(boilerplate or (bool(words & BAD_WORDS) and name not in ARTICLE))
            good = int(good or bool(words & GOOD_WORDS))
        hidden = hidden or _is_hidden(said)
        label = said.get("data-keep", label)
    return _Element(name, article, boilerplate, int(above.heading or name in HEADING), good, hidden,
                    label)


FEATURES = ("words", "links", "words before", "links before", "words after", "links after",
            "article", "boilerplate", "heading", "content class")


def features(found: list[Block]) -> list[list[float]]:
    """Of each block, with its neighbours' counts; -1 words beyond the page's ends."""
    rows = []
    for i, b in enumerate(found):
        before = found[i - 1] if i else None
        after = found[i + 1] if i + 1 < len(found) else None
        rows.append([
            float(b.words), b.links,
            float(before.words) if before else -1.0, before.links if before else 0.0,
            float(after.words) if after else -1.0, after.links if after else 0.0,
            float(b.article), float(b.boilerplate), float(b.heading), float(b.good)])
    return rows


# -- the tree ----------------------------------------------------------------------------------

#: The labelled table: pages whose blocks are marked ``data-keep`` 1 (main text) or 0.
_LONG = "This is a sentence of the article with a good many words that nobody would put in a menu. "
LABELLED_PAGES = (
    # article element; short paragraphs between long ones belong to it
    "<nav data-keep=0><ul><li><a>Home</a><li><a>News</a><li><a>About us</a></ul></nav>"
    "<div class=ad data-keep=0>Buy one now and save.</div>"
    f"<article data-keep=1><h1>A title</h1><p>{_LONG * 3}<p>Of.<p>{_LONG}<p>Short one.<p>{_LONG * 2}"
    "<p>See <a>this link</a> there.</article><footer data-keep=0>&copy; Somebody. All rights.</footer>",
    "<header data-keep=0><h1>Site name</h1><p>The best of all sites on the web</header>"
    f"<article data-keep=1><header><h1>Title of it</h1></header><p>{_LONG}<ul><li>One<li>Two words</ul>"
    f"<p>{_LONG * 4}</article><aside data-keep=0><h3>Related</h3><p>{_LONG}<a>More</a></aside>"
    f"<div class=comments data-keep=0><h2>Comments</h2><p>{_LONG}<p>I like it.</div>",
    "<div class=cookie-notice data-keep=0>We use cookies to make this better for you.</div>"
    f"<main data-keep=1><h2>Word</h2><p>{_LONG}<p>Yes.</main>"
    "<form data-keep=0><p>Name<p>Send us a message about anything at all you may like</form>",
    "<article data-keep=1><p>One short text.</article><footer data-keep=0>Contact</footer>",
    f"<article data-keep=1><p>{_LONG}<div class=share data-keep=0>Share this</div><p>End.</article>",
    "<article data-keep=1><p><a>A whole paragraph that is a link</a><p>Two</article>",
    # no article element, but a class that says so
    "<div id=menu data-keep=0><a>One</a> <a>Two</a></div>"
    f"<div class=post-content data-keep=1><h1>Title</h1><p>{_LONG}<p>Short.<p>{_LONG * 2}</div>"
    f"<div id=sidebar data-keep=0><h3>About</h3><p>{_LONG}</div><div id=footer data-keep=0>Imprint</div>",
    f"<div class=content data-keep=1><p>Few words.<p>{_LONG}</div><div class=banner data-keep=0>{_LONG}</div>",
    # nothing that helps: long texts without links, and what stands between them
    "<div data-keep=0><a>Home</a></div><div data-keep=0><a>Shop</a> <a>Cart</a></div>"
    f"<h1 data-keep=1>A title here</h1><p data-keep=1>{_LONG * 3}<p data-keep=1>{_LONG * 2}"
    f"<p data-keep=1>Indeed.<p data-keep=1>{_LONG * 2}<p data-keep=0><a>Next page</a>"
    "<p data-keep=0>Copyright 2001",
    "<table><tr><td data-keep=0><a>Index</a><td data-keep=0><a>Help</a></table>"
    f"<p data-keep=1>{_LONG * 2}<p data-keep=1>{_LONG}<div data-keep=0><a>Back</a></div>",
    f"<h2 data-keep=1>Heading of it</h2><p data-keep=1>{_LONG}<p data-keep=0>Printed today",
    f"<p data-keep=1>{_LONG}", "<p data-keep=1>A short page, nothing else.",
)


class Node(NamedTuple):
    """A split (left if the feature is at most the limit) or, with feature -1, a verdict."""

    feature: int
    limit: float
    left: int
    right: int
    keep: bool


def train(spark: SparkSession, pages: tuple[str, ...] = LABELLED_PAGES, depth: int = 6) -> list[Node]:
    """Fit Spark's decision tree on the labelled blocks and return its nodes."""
    rows = []
    for page in pages:
        found = blocks(page)
        rows += [(x, float(b.label)) for b, x in zip(found, features(found)) if b.label in ("0", "1")]
    table = spark.createDataFrame(rows, "x array<double>, label double").coalesce(1)
    learner = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=1, seed=3)
    model = learner.fit(table.select("label", array_to_vector("x").alias("features")))
    nodes: list[Node] = []

    def add(node) -> int:
        at = len(nodes)
        nodes.append(Node(-1, 0.0, 0, 0, bool(node.prediction() == 1.0)))
        if node.subtreeDepth():
            split = node.split()
            left, right = add(node.leftChild()), add(node.rightChild())
            nodes[at] = Node(split.featureIndex(), split.threshold(), left, right, nodes[at].keep)
        return at

    add(model._call_java("rootNode"))
    return nodes


def kept(nodes: list[Node], x: list[float]) -> bool:
    node = nodes[0]
    while node.feature >= 0:
        node = nodes[node.left if x[node.feature] <= node.limit else node.right]
    return node.keep


def main_text(html: str, nodes: list[Node]) -> str:
    found = blocks(html)
    return "\n".join(b.text for b, x in zip(found, features(found)) if kept(nodes, x))


def extract(pages: DataFrame, nodes: list[Node] | None = None, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points); columns of these names are replaced."""
    bounded_batches(pages.sparkSession)
    tree = [tuple(n) for n in (nodes or train(pages.sparkSession))]
    rest = pages.drop(*({"text", "n_chars"} - {html}))
    names = [F.col(f"`{c}`") for c in rest.columns if c not in ("text", "n_chars")]

    @F.arrow_udf("string")
    def run(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = [Node(*n) for n in tree]
        for texts in column:
            yield pa.array([main_text(t or "", own) for t in texts.to_pylist()], pa.string())

    extracted = rest.select(*names, run.asNondeterministic()(F.col(html).cast("string")).alias("text"))
    return extracted.withColumn("n_chars", F.length("text").cast("long"))
