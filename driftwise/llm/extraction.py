"""Main text of web pages by composite text density.

Every DOM node gets its characters per tag, adjusted for links: the ratio is weighted by a
logarithm of (characters per link character) x (tags per link tag), whose base grows with the
share of link text in the node and in the whole body. A node's density sum adds up its
children's densities; the node with the largest sum holds the article. The smallest density on
the path from it to the body is the threshold: siblings along the path join if they reach it.

Parts that are no article by their element, role, class or id (menus, site headers, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments, hidden parts) are left
out before densities are computed. Names of a state or a subject (``has-sidebar``,
``comments-off``, ``tag-feedback``) are no marks, and an ``article`` is marked only by a whole
name. A marked part that holds most of the body's unlinked text stays and its density decides;
if no text is left but there is some, marks do not count (a short notice stays out). If the best node lies in an ``article`` (or ``main``), that
element is the result, so that its title and short paragraphs stay.

A form (or ``object``) goes, with its labels and controls, unless the page is written inside of
it: then it holds the ``article`` or most of the unlinked text, and only its controls go. Formulas
and an ``aside`` of an article (a pull quote) stay; the source notes of a formula are markup.

Defined results: null and empty html, and pages without text, give an empty text; a null id or
url is passed on; repeated rows are extracted alike; an empty table gives no rows; broken or
cut-off markup is read as far as it goes; of nodes with equal sums the denser, then the first in
page order is taken; pages of any length are read whole, in time linear in their length.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwise.llm.batches import in_batches

# Element names of the HTML standard by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes noembed xmp template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
TEXT_BLOCKS = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul".split())
DROPPED = frozenset(
    "annotation annotation-xml aside audio button canvas datalist dialog footer form head input label legend menu nav "
    "object select svg video".split()
) | RAW
#: Dropped, unless the whole page is written inside of them.
WRAPPERS = frozenset("form object".split())
#: A new element of the key ends an open one of the values.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"),
    "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"), "option": ("option",),
}
SCOPES = frozenset("ul ol dl table td th article body div section main aside nav header footer form blockquote".split())
# Words in a class, id or role that mark a part as no article.
BOILERPLATE = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment "
    "comments complementary consent contentinfo cookie cookies copyright dialog discussion disqus feedback footer "
    "footnav gdpr header login masthead menu menubar modal nav navbar navigation navigationbar newsletter notice "
    "notices overlay pager pagination popup promo promoted promotion recommended recommendations related replies "
    "reply respond responses search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe "
    "subscription toolbar topbar widget widgets".split()
)
#: Words that hold for a part whatever is in it; the others may also name a layout around the article.
FIRM = frozenset(
    "comment comments discussion disqus feedback related recommended recommendations replies reply respond responses".split()
)
# Pieces of a name that say what a part has or is about: before a mark, and at the end of the name.
STATE_BEFORE = frozenset(
    "cat category format has have is no non not status tag taxonomy template term topic type with without".split()
)
STATE_AFTER = frozenset("allowed closed disabled enabled hidden off on open visible".split())
#: Words that never name a layout: a part of few characters with one of them is no article, even if it is all there is.
NOTICES = FIRM | frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising alert consent cookie cookies copyright gdpr modal "
    "newsletter notice notices overlay popup promo promoted promotion share sharing signup social sponsor sponsored "
    "subscribe subscription".split()
)
#: Unlinked characters below which a notice, or what is left beside comments, is no article.
FEW = 250
#: A header part named so holds the title.
TITLED = frozenset("article content entry page post section story title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("html body main".split()) | HEADINGS

# Possessive throughout: a value may have any length, and no character is read again on the way back.
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^<>]*>|<(?P<end>/)?(?P<name>[A-Za-z][^\s/<>]*+)(?P<rest>(?:[^<>"']|"[^"]*+"|'[^']*+')*+)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"']++))?|"[^"]*+"|'[^']*+'""")
_HIDDEN_STYLE = re.compile(r"(?i)display\s*+:\s*+none|visibility\s*+:\s*+hidden")
#: Searched in the page as it is: lower() changes the length of some letters, and so the places after them.
_RAW_END = {name: re.compile(f"(?ai)</{name}") for name in RAW}
_WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z0-9]+")


def _marks(rest: str) -> tuple[bool, list[str]]:
    """Whether the attributes hide the part, and its names."""
    hidden, names = False, []
    for m in _ATTRIBUTE.finditer(rest):
        key, value = (m[1] or "").lower(), (m[2] or "").strip("\"'")
        if key in ("class", "id", "role"):
            names += value.split()
        elif key == "hidden" or key == "aria-hidden" and value.strip().lower() == "true":
            hidden = True
        elif key == "style":
            hidden = hidden or bool(_HIDDEN_STYLE.search(value))
    return hidden, names


def _marking(pieces: list[str]) -> set[str]:
    """Pieces of a name that may mark a part: none behind a word of state."""
    if pieces and pieces[-1] in STATE_AFTER:
        return set()
    end = next((i for i, w in enumerate(pieces) if w in STATE_BEFORE), len(pieces))
    return set(pieces[:end])


class Page:
    """A flat DOM: parents come before their children; ``parts`` are texts and breaks in page order."""

    def __init__(self, source: str) -> None:
        self.tag, self.parent, self.dropped, self.firm = ["html"], [-1], [False], [False]
        #: left out by element or as hidden, whatever it is named
        self.fixed, self.notice = [False], [False]
        #: elements named article or main at or above a node; article alone
        self.in_main, self.in_article = [False], [False]
        #: places on the stack of open elements by name, of blocks, of scopes, of scopes but table cells
        self.open: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.scopes: list[int] = []
        self.wide_scopes: list[int] = []
        #: (node, text); text None marks a block boundary
        self.parts: list[tuple[int, str | None]] = []
        self._read(source)

    def _add(self, tag: str, parent: int, rest: str) -> int:
        drop = tag in DROPPED and not (tag == "aside" and self.in_article[parent])
        firm = fixed = drop and tag not in WRAPPERS
        notice = False
        if rest and not drop and tag not in CONTAINERS:
            fixed, names = _marks(rest)
            pieces = [[w.lower() for w in _WORD.findall(name)] for name in names]
            words = set().union(*map(_marking, pieces))
            if tag == "article":  # only dropped for what it is, not for its place or its subject
                words = {name.lower() for name in names} & FIRM
            firm = fixed or bool(words & FIRM)
            if any(not TITLED.isdisjoint(p) for p in pieces):
                words.discard("header")
            drop = firm or bool(words & BOILERPLATE)
            notice = bool(words & NOTICES)
        if tag == "header":  # the header of an article holds its title
            drop = firm = fixed = not self.in_main[parent]
        self.tag.append(tag)
        self.parent.append(parent)
        self.dropped.append(drop)
        self.firm.append(firm)
        self.fixed.append(fixed)
        self.notice.append(notice)
        self.in_article.append(self.in_article[parent] or tag == "article")
        self.in_main.append(self.in_main[parent] or tag in ("article", "main"))
        return len(self.tag) - 1

    def _push(self, stack: list[int], node: int) -> None:
        tag, place = self.tag[node], len(stack)
        stack.append(node)
        self.open.setdefault(tag, []).append(place)
        if tag in BLOCKS:
            self.blocks.append(place)
        if tag in SCOPES:
            self.scopes.append(place)
            if tag not in ("td", "th"):
                self.wide_scopes.append(place)

    def _pop_to(self, stack: list[int], place: int) -> None:
        """Ends the elements from this place of the stack on; each element is ended once."""
        for node in stack[place:]:
            self.open[self.tag[node]].pop()
        del stack[place:]
        for places in (self.blocks, self.scopes, self.wide_scopes):
            while places and places[-1] >= place:
                places.pop()

    def _last(self, name: str) -> int:
        """Place of the innermost open element of this name; 0 if there is none."""
        places = self.open.get(name)
        return places[-1] if places else 0

    def _read(self, source: str) -> None:
        stack, at = [0], 0
        while at < len(source):
            m = _TAG.search(source, at)
            text = source[at : m.start() if m else len(source)]
            if text:
                self.parts.append((stack[-1], text))
            if not m:
                break
            at = m.end()
            if not m["name"]:
                continue
            name = m["name"].lower()
            if m["end"]:
                self._close(stack, name)
                continue
            if name in BLOCKS:
                self._end_open(stack, "p", "p")
                self.parts.append((stack[-1], None))
            for open_ in ENDS.get(name, ()):
                self._end_open(stack, open_, name)
            if name == "html" and len(stack) > 1 or name == "body" and self._last(name):
                continue
            if name == "br":
                self.parts.append((stack[-1], None))
            node = self._add(name, stack[-1], m["rest"])
            if name in RAW:
                end = _RAW_END[name].search(source, at)
                at = end.start() if end else len(source)
                self._push(stack, node)
            elif name not in VOID and not (m["rest"].endswith("/") and name not in BLOCKS):
                self._push(stack, node)

    def _end_open(self, stack: list[int], tag: str, for_: str) -> None:
        """Ends an open ``tag`` inside the current scope; a table row or part ends over its cells."""
        scopes = self.wide_scopes if for_ in ("tr", "tbody") else self.scopes
        place = self._last(tag)
        if place and place >= (scopes[-1] if scopes else 0):
            self._pop_to(stack, place)
            self.parts.append((stack[-1], None))

    def _close(self, stack: list[int], name: str) -> None:
        block, place = name in BLOCKS, self._last(name)
        # an inline end tag does not reach out of its block
        if place and (block or place > (self.blocks[-1] if self.blocks else 0)):
            self._pop_to(stack, place)
        if block:
            self.parts.append((stack[-1], None))


def _measure(page: Page) -> tuple[list[float], list[float], list[int], list[int]]:
    """Composite density, density sum, characters and link characters of every node."""
    n = len(page.tag)
    chars, links, tags, link_tags = [0] * n, [0] * n, [1] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        p = page.parent[i]
        page.dropped[i] = page.dropped[i] or page.dropped[p]
        in_link[i] = in_link[p] or page.tag[i] == "a"
    for node, text in page.parts:
        if text and not page.dropped[node]:
            size = len(text.strip())
            chars[node] += size
            links[node] += size * in_link[node]
    for i in range(n - 1, 0, -1):
        if not page.dropped[i]:
            p = page.parent[i]
            chars[p] += chars[i]
            links[p] += links[i]
            tags[p] += tags[i]
            link_tags[p] += link_tags[i] + (page.tag[i] == "a")
    body = next((i for i in range(n) if page.tag[i] == "body"), 0)
    body_share = links[body] / max(chars[body], 1)
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        c, lc, t, lt = chars[i], links[i], tags[i], link_tags[i]
        if c and not page.dropped[i]:
            base = math.log(c / max(c - lc, 1) * lc + body_share * c + math.e)
            spread = c / max(lc, 1) * t / max(lt, 1)
            # the base is e at least, so its logarithm is 1 where there are no links
            density[i] = c / t * math.log(max(spread, 1.0)) / max(math.log(base), 1.0)
            if i:
                total[page.parent[i]] += density[i]
    return density, total, chars, links


def _settle_wrappers(page: Page, article: list[bool]) -> None:
    """A form that holds neither the article nor most of the unlinked text goes, like a control."""
    wrappers = [i for i, t in enumerate(page.tag) if t in WRAPPERS]
    if not wrappers:
        return
    holds = list(article)
    for i in range(len(holds) - 1, 0, -1):
        holds[page.parent[i]] = holds[page.parent[i]] or holds[i]
    size = _unlinked(page, page.firm)
    for i in wrappers:
        if not holds[i] and (size[i] < FEW or 2 * size[i] <= size[0]):
            page.firm[i] = page.fixed[i] = True


def _restore_large(page: Page) -> None:
    """A mark on a part that holds the article is a layout name, not a reason to drop it."""
    holds = [t in ("article", "main") and not d for t, d in zip(page.tag, page.dropped)]
    _settle_wrappers(page, holds)
    for i in range(len(page.tag) - 1, 0, -1):
        if not page.firm[i]:
            holds[page.parent[i]] = holds[page.parent[i]] or holds[i]
            if holds[i]:
                page.dropped[i] = False
    if page.dropped != page.fixed:
        _restore_most(page)


def _inherited(page: Page, own: list[bool]) -> list[bool]:
    """What holds for a node or one above it."""
    out = list(own)
    for i in range(1, len(out)):
        out[i] = out[i] or out[page.parent[i]]
    return out


def _unlinked(page: Page, left_out: list[bool]) -> list[int]:
    """Characters outside links in every subtree, without the parts left out."""
    skipped = _inherited(page, [out or t == "a" for out, t in zip(left_out, page.tag)])
    size = [0] * len(page.tag)
    for node, text in page.parts:
        if text and not skipped[node]:
            size[node] += len(text.strip())
    for i in range(len(size) - 1, 0, -1):
        size[page.parent[i]] += size[i]
    return size


def _restore_most(page: Page) -> None:
    """Marked parts with most of the unlinked text stay. Comments do only where next to nothing
    else is, and beside an article nothing outside of it does."""
    every, size = _unlinked(page, page.fixed), _unlinked(page, page.firm)
    if size[0] < FEW and 10 * size[0] < every[0]:
        size = every
    named = [t in ("article", "main") for t in page.tag]
    gone = _inherited(page, page.dropped)
    article = any(n and not g and 10 * c >= size[0] > 0 for n, g, c in zip(named, gone, size))
    inside = _inherited(page, named)
    for i in range(1, len(page.tag)):
        if not page.fixed[i] and 2 * size[i] > size[0] and (inside[i] or not article):
            page.dropped[i] = page.dropped[i] and page.notice[i] and size[i] < FEW
    gone = _inherited(page, page.dropped)
    if every[0] >= FEW and not any(text and not gone[node] and text.strip() for node, text in page.parts):
        page.dropped = list(page.fixed)


def _chosen(page: Page) -> set[int]:
    """Roots of the subtrees that hold the article."""
    density, total, chars, links = _measure(page)
    best = max(range(len(page.tag)), key=lambda i: (total[i], density[i], -i))
    if not chars[best]:
        return set()
    path = [best]
    while path[-1] > 0 and page.tag[path[-1]] != "body":
        path.append(page.parent[path[-1]])
    for wanted in ("article", "main"):
        named = [i for i in path if page.tag[i] == wanted]
        if named:
            return {named[-1]}
    threshold = min(density[i] for i in path)
    roots = {best}
    on_path = set(path)
    for i in range(1, len(page.tag)):
        if page.parent[i] in on_path and page.parent[i] != best and i not in on_path and not page.dropped[i]:
            linked = 2 * links[i] > chars[i]
            if not linked and (density[i] >= threshold or page.tag[i] in TEXT_BLOCKS):
                roots.add(i)
    return roots


def main_text(source: str | None) -> str:
    """The article's text: blocks in page order, joined by one space."""
    if not source:
        return ""
    page = Page(source)
    _restore_large(page)
    roots = _chosen(page)
    inside = [False] * len(page.tag)
    for i in range(len(page.tag)):
        inside[i] = i in roots or (i > 0 and inside[page.parent[i]])
    blocks: list[str] = []
    current: list[str] = []
    for node, text in page.parts:
        if text is None:
            if current:
                blocks.append("".join(current))
                current = []
        elif inside[node] and not page.dropped[node]:
            current.append(html.unescape(text))
    blocks.append("".join(current))
    return " ".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def extract_main_text(
    pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    schema = T.StructType(
        [
            T.StructField("page_id", pages.schema[key].dataType),
            T.StructField("url", pages.schema[url].dataType),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = [main_text(value.as_py()) for value in part["html"]]
                yield pa.RecordBatch.from_arrays(
                    [part["page_id"], part["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=schema.fieldNames(),
                )

    given = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html"))
    return in_batches(given, run, schema)
