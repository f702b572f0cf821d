"""Main text of web pages by tag-path ratios.

A page is read into text pieces, each with its root-to-leaf path of open tags.
Over all pieces of a path the text length and the punctuation are added up and
divided by the number of pieces: the path's text ratio and punctuation ratio.
Both are smoothed over the page (a Gaussian window over neighbouring pieces, then
the mean per path) and fused by multiplication. Paths whose fused ratio reaches a
threshold (a share of the length-weighted mean) are content paths.

What is never content - scripts, forms, menus, footers, known by element or role -
counts for nothing and is left out. A class or id that names an advert, a comment
or the like is evidence only: such an element is left out if no path of its text is
a content path, or if all of its name together hold the smaller part of the page's
text, or if the content is in an article elsewhere; never if it is around the
content node. The content paths of what is left choose the page's content node: the deepest element that holds nearly all
of their text, or the article or main element around it. The node's text is
returned whole, block by block, and with it the headings and text blocks that
stand beside it, on any path: in the page's articles and mains if the node is in
one, else in the whole page. Outside the node only link blocks are left out, that
is blocks more than half of whose text is in links, on a path of which that holds
too.

Fixed values below: elements, roles and names as HTML and its users define them.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are never content.
DROPPED = frozenset("""head script style noscript template iframe object svg math canvas audio video map
nav footer aside form button select option optgroup textarea datalist dialog menu""".split())
#: Elements that stand inside a line; any other starts a block.
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark
q rp rt ruby s samp small span strike strong sub sup time tt u var wbr""".split())
#: Elements that end an open paragraph.
ENDS_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul""".split())
#: Elements that end an open one of the same kind: (start tag, ended, up to).
ENDS_LIKE = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
             "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
             "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
             "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
#: Roles that are never content.
ROLES = frozenset("""navigation banner contentinfo complementary search dialog alertdialog alert menu menubar
toolbar form""".split())
#: Words in a class or id that are evidence against an element.
NAMES = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion
sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead
cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe
comment comments reply replies respond disqus share sharing social related recommended widget""".split())
#: Of these, those that name what readers wrote.
COMMENTS = frozenset("comment comments reply replies respond disqus".split())
#: Words that say of such a name only which or where. With any other word a name is
#: weaker evidence (a class) or a heading's words (an id).
PARTS = frozenset("""area bar block bottom box button buttons center col column container entry form group
header heading icon icons inner item items left link links list main module page pane panel post posts right row
section site slot sub top unit wrap wrapper""".split())
NEGATED = frozenset("has no not with without".split())
#: Page headers: the same, unless they belong to the article.
HEADER_NAMES = frozenset("header topbar".split())
ARTICLE = frozenset("article main".split())
BODY = frozenset("html body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

PUNCTUATION = re.compile(r"[.,;:!?…。、，！？]")
_CUT_TAG = re.compile(r"<[a-zA-Z/!?]")
_NAME = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

#: Share of the length-weighted mean ratio that a content path reaches.
THRESHOLD = 0.2
#: Share of the content paths' text that the content node holds.
HELD = 0.9
#: A link block has more than this share of its text in links.
LINKED = 0.5
#: Gaussian window over neighbouring pieces.
WINDOW = np.exp(-0.5 * np.arange(-2, 3) ** 2.0)


def marked(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    """Whether an element is never content."""
    if tag in DROPPED or tag == "header" and not in_article:
        return True
    if tag in ARTICLE or tag in BODY:
        return False
    for name, value in attrs:
        if name == "role" and value and value.strip().lower() in ROLES:
            return True
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and value and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def named(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> tuple[bool, str] | None:
    """What class and id say against an element: (whether a whole name does, the
    words that do)."""
    if tag in ARTICLE or tag in BODY:
        return None
    names = NAMES if in_article else NAMES | HEADER_NAMES
    weak = None
    for name, value in attrs:
        if not value or name != "class" and (name != "id" or tag in HEADINGS):
            continue
        for one in value.split() if name == "class" else [value]:
            words = _NAME.findall(_CAMEL.sub(" ", one).lower())
            found = " ".join(w for w in words if w in names)
            if not found or words[0] in NEGATED:
                continue
            if all(w in names or w in PARTS or w.isdigit() for w in words):
                return True, found
            if name == "class" and not in_article:
                weak = False, found
    return weak


class Page(HTMLParser):
    """Reads a page into text pieces: (text, path, element, block)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int]] = []  # (tag, element number)
        self.parent, self.tag = [-1], ["#page"]
        self.out_at = 0  # depth from which text is dropped; 0: it isn't
        self.block = 0
        self.pieces: list[tuple[str, str, int, int]] = []
        self.path = ""
        self.article = 0
        self.named: dict[int, tuple[bool, str]] = {}  # by element

    def updatepos(self, i, j):
        return j  # lines aren't counted

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_P and any(t == "p" for t, _ in self.open):
            self.close_to({"p"}, {"table", "td", "th", "button", "caption", "object"})
        if tag in ENDS_LIKE:
            self.close_to(*ENDS_LIKE[tag])
        if tag not in INLINE:
            self.block += 1
        if tag == "br":
            self.handle_data(" ")
        if tag in VOID:
            return
        self.parent.append(self.open[-1][1] if self.open else 0)
        self.tag.append(tag)
        self.open.append((tag, len(self.tag) - 1))
        if not self.out_at and marked(tag, attrs, self.article > 0):
            self.out_at = len(self.open)
        if not self.out_at and (name := named(tag, attrs, self.article > 0)):
            self.named[len(self.tag) - 1] = name
        self.article += tag in ARTICLE
        self.path = ""

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.block += 1
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.cut(k)
                return
            if tag in INLINE and self.open[k][0] not in INLINE:
                return  # an end tag of an inline element closes no block

    def close_to(self, ended, stop):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in ended:
                self.cut(k)
                if ended == {"p"}:
                    return
            elif self.open[k][0] in stop:
                return

    def cut(self, k):
        self.article -= sum(t in ARTICLE for t, _ in self.open[k:])
        del self.open[k:]
        if self.out_at > k:
            self.out_at = 0
        self.path = ""

    def handle_data(self, data):
        if not self.out_at and data:
            if not self.path:
                self.path = "/".join(t for t, _ in self.open)
            self.pieces.append((data, self.path, self.open[-1][1] if self.open else 0, self.block))


def content_paths(pieces: list[tuple[str, str, int, int]], threshold: float) -> set[str]:
    """The paths whose smoothed, fused ratio reaches the threshold."""
    paths = sorted({p[1] for p in pieces})
    number = {p: k for k, p in enumerate(paths)}
    of = np.array([number[p[1]] for p in pieces])
    length = np.array([len(" ".join(p[0].split())) for p in pieces], float)
    marks = np.array([len(PUNCTUATION.findall(p[0])) for p in pieces], float)
    count = np.bincount(of)
    fused = np.ones(len(paths))
    for what in (length, marks + 1):
        ratio = (np.bincount(of, what) / count)[of]
        half = len(WINDOW) // 2
        smooth = (np.convolve(ratio, WINDOW) / np.convolve(np.ones(len(ratio)), WINDOW))[half:half + len(ratio)]
        fused *= np.bincount(of, smooth) / count
    weight = np.bincount(of, length)
    mean = (fused * weight).sum() / max(weight.sum(), 1)
    return {p for p, k in number.items() if fused[k] >= threshold * mean and weight[k]}


def content_node(page: Page, paths: set[str]) -> int:
    """The element that holds nearly all text of the content paths, or the article
    or main element around it."""
    held = np.zeros(len(page.tag))
    for text, path, element, _ in page.pieces:
        if path in paths:
            held[element] += len(text)
    total = held.sum()
    for k in range(len(held) - 1, 0, -1):  # children come after their parents
        held[page.parent[k]] += held[k]
    node = 0
    for k in range(1, len(held)):
        if held[k] >= HELD * total and page.parent[k] == node:
            node = k
    at = node
    while at > 0:
        if page.tag[at] in ARTICLE:
            return at
        at = page.parent[at]
    # Blocks stand beside each other: a single paragraph's node is what holds it.
    while node > 0 and page.tag[node] in (INLINE | ENDS_P) - {"div", "section"}:
        node = page.parent[node]
    return node


def inside_of(page: Page, roots) -> np.ndarray:
    """Which elements are among ``roots`` or inside them."""
    inside = np.zeros(len(page.tag), bool)
    inside[roots] = True
    for k in range(1, len(inside)):  # children come after their parents
        inside[k] |= inside[page.parent[k]]
    return inside


def left_out(page: Page, pieces: list[tuple[str, str, int, int]], threshold: float) -> np.ndarray:
    """Which elements are left out, or inside one that is, by the evidence of names
    and ratios."""
    n = len(page.tag)
    paths = content_paths(pieces, threshold)
    element = [p[2] for p in pieces]
    length = np.array([len(" ".join(p[0].split())) for p in pieces], float)
    in_content = length * [p[1] in paths for p in pieces]
    articles = inside_of(page, [k for k in range(n) if page.tag[k] in ARTICLE])
    elsewhere = np.bincount(element, in_content, n)[articles & ~inside_of(page, list(page.named))].any()

    def held(what):
        out = np.bincount(element, what, n)
        for k in range(n - 1, 0, -1):
            out[page.parent[k]] += out[k]
        return out

    content, in_articles = held(in_content), held(length * articles[element])
    around, at = set(), content_node(page, paths)
    while at > 0:
        around.add(at)
        at = page.parent[at]
    out, groups = [], {}
    for k, (whole, words) in page.named.items():
        if not content[k] or whole and elsewhere and not in_articles[k]:
            out.append(k)
        elif whole and k not in around:
            groups.setdefault(words, []).append(k)
    dropped = inside_of(page, out)
    # What readers wrote goes, however long it is, if there is content beside it.
    for words in [w for w in groups if COMMENTS.intersection(w.split())]:
        more = dropped | inside_of(page, groups[words])
        if (in_content * ~more[element]).any():
            dropped = more
            del groups[words]
    # All of another name are left out or none, while what is left is the larger part.
    rest = length * ~dropped[element]
    share = {words: (rest * inside_of(page, ks)[element]).sum() for words, ks in groups.items()}
    for words in sorted(groups, key=lambda w: (share[w], w)):
        more = dropped | inside_of(page, groups[words])
        if 2 * (rest * more[element]).sum() <= rest.sum():
            dropped = more
    return dropped


def link_blocks(page: Page, pieces: list[tuple[str, str, int, int]], node: int) -> np.ndarray:
    """Which elements' text belongs to link blocks outside ``node``. A heading is
    none, but goes with the links of an element that holds nothing else and more
    of them."""
    n = len(page.tag)
    block, linked, path = np.arange(n), np.zeros(n, bool), np.zeros(n, np.int64)
    number: dict[tuple[int, str], int] = {}
    for k in range(1, n):
        up, tag = page.parent[k], page.tag[k]
        linked[k] = linked[up] or tag == "a"
        if tag in INLINE:
            block[k], path[k] = block[up], path[up]
        else:
            path[k] = number.setdefault((path[up], tag), len(number) + 1)
    heading = inside_of(page, [k for k in range(n) if page.tag[k] in HEADINGS])
    main_heading = inside_of(page, [k for k in range(n) if page.tag[k] == "h1"])
    at = block[[p[2] for p in pieces]]
    length = np.array([len(" ".join(p[0].split())) for p in pieces], float)
    in_links = length * linked[[p[2] for p in pieces]]

    def heavy(of):
        return np.bincount(of, in_links, n) > LINKED * np.bincount(of, length, n)

    links = heavy(at) & heavy(path[at])[path] & ~heading
    text = np.bincount(at, length, n)
    held = np.stack([text * links, text * (heading & ~main_heading), text * ~(links | heading & ~main_heading)])
    for k in range(n - 1, 0, -1):
        held[:, page.parent[k]] += held[:, k]
    out = inside_of(page, np.flatnonzero((held[0] > held[1]) & (held[2] == 0)))
    return (out | links)[block] & ~inside_of(page, [node])


def join(pieces: list[tuple[str, str, int, int]]) -> list[tuple[str, str, int, int]]:
    """Neighbouring pieces of one element and block as one: comments and references
    don't split a text."""
    joined: list[tuple[str, str, int, int]] = []
    for p in pieces:
        if joined and joined[-1][1:] == p[1:]:
            joined[-1] = (joined[-1][0] + p[0], *p[1:])
        else:
            joined.append(p)
    return joined


def main_text(html: str | None, threshold: float = THRESHOLD) -> str:
    """The page's main text, a line for each block; empty if there is none."""
    if not html:
        return ""
    page = Page()
    page.feed(html)
    if _CUT_TAG.match(page.rawdata):  # the page ends inside a tag
        page.rawdata = ""
    page.close()
    joined = join(page.pieces)
    real = [p for p in joined if p[0].strip()]
    if page.named and real:
        out = left_out(page, real, threshold)
        joined = join([p for p in page.pieces if not out[p[2]]])
        real = [p for p in joined if p[0].strip()]
    if not real:
        return ""
    page.pieces = joined
    node = content_node(page, content_paths(real, threshold))
    inside = ~link_blocks(page, real, node)
    articles = inside_of(page, [k for k, tag in enumerate(page.tag) if tag in ARTICLE])
    if articles[node]:
        inside &= articles
    lines: dict[int, list[str]] = {}
    for text, _, element, block in joined:
        if inside[element]:
            lines.setdefault(block, []).append(text)
    found = (" ".join("".join(parts).split()) for parts in lines.values())
    return "\n".join(line for line in found if line)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            threshold: float = THRESHOLD) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row of ``pages``. Row-wise:
    no shuffle. Null and empty pages, and pages of nothing but markup, have an
    empty text; repeated rows stay repeated."""
    ship(pages.sparkSession)
    src = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                       F.col(f"`{html_col}`").cast("string").alias("html"))
    kinds = [f.dataType.simpleString() for f in src.schema.fields]

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py(), threshold) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return src.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
