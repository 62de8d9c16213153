"""Main text of web pages by two-pass block rules (operator 13).

A page is cut into blocks at block-level tags. Elements that never hold the
article (scripts, styles, menus, forms, page headers and footers, sidebars,
comments, and those whose role, class or id says so) are marked; the blocks in
them are boilerplate.

Pass one decides a block by itself: a marked one, or one whose letters are mostly
in links, is bad; a long one rich in stop words is good; a long one almost without
any is bad, unless an article or main element holds it. The rest, short blocks above
all, stays open. (If no block of a page is good, its language is not among the stop
words', and its long blocks are good.) In pass two an open block takes the label of
the nearest decided block of its section, the innermost article, main or page body
around it; of two equally near ones the good wins, and a heading looks ahead only, as
it goes with what follows. Without a decided block in its section an open one is good
in an article or main element; elsewhere it takes the label of the nearest decided
block of the page, and is good on a page without any. If an article or main element
holds good blocks, those outside are bad.

Character references are decoded as browsers do it, white space in a block
becomes one space, and the good blocks are joined by one space. Every page is
parsed whole; each is independent, so there is no shuffle.

Edge cases: null or empty html, and a page without a good block, give an empty
text; cut-off tags, comments and scripts end with the page; a ``<`` that starts no
tag is text; unclosed and misnested elements are closed by their ancestors;
null ids and urls are passed on; repeated rows give repeated results; an empty
table gives an empty result; very long pages are parsed in time and memory
linear in their length. Other columns, whatever they are called, have no effect
and are not returned.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

SHORT = 70  # characters: shorter blocks are never decided by their words
LONG = 140  # characters: at least so many make a block with stop words good
STOPS_HIGH, STOPS_LOW = 0.25, 0.08  # share of stop words among a block's words
LINKS_HIGH = 0.4  # share of a block's characters in links

# Function words of seven languages.
STOP_WORDS = frozenset(
    "a about all also an and are as at be been but by can for from had has have he her his i if in into is it its more no not of on one or "
    "our she so than that the their them then there they this to up was we were what when which who will with would you "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais même ne nous ou par pas pour qu que qui sa se ses "
    "son sont sur un une vous "
    "aber als am an auch auf aus bei bin das dass dem den der des die durch ein eine einem einen einer er es für hat ich ihr im in ist "
    "mit nach nicht noch nur oder sich sie sind so über um und uns von vor war was wie wir zu zum zur "
    "al como con cuando del desde donde el ella ellos entre era es esta este fue ha hay las lo los muy más no nos para pero por sin sobre su "
    "sus también un una y ya "
    "che da dei della di gli non per più sono ao com dos é mas não os uma een het niet op te van voor zijn".split()
)
# Element names.
RAW = frozenset("script style template iframe noembed noframes xmp textarea title noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q ruby rb rp rt s samp small span strike strong sub "
                   "sup time tt u var wbr".split())
BOILER = frozenset("aside audio button canvas datalist dialog fieldset footer form head label legend map menu nav object optgroup option output select "
                   "svg video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SECTIONS = frozenset("article main".split())
# Elements whose start closes an open one of the set (within its parent).
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table tbody thead tfoot select article main body html div section".split())
# Roles, and words of class names and ids, of what is not the article.
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form status".split())
MARKS = frozenset("ad ads advert adverts advertisement advertising adsense alert aside banner breadcrumb breadcrumbs captcha comment comments cookie cookies "
                  "consent copyright disclaimer disqus footer form gdpr hidden login masthead menu modal nav navbar navigation newsletter notice notices "
                  "overlay pager pagination popup promo promotion related replies reply respond search share sharing sidebar signin signup skip social "
                  "sponsor sponsored subscribe subscription toolbar topbar".split())
NOT_MARKS = frozenset("has no with without is not hide show js".split())
NOT_AN_ARTICLE = frozenset("ad ads advert comment promo related reply sponsored".split())
_NOTICE = re.compile(r"©|\bcopyright\b|\ball rights reserved\b|\bcookies?\b", re.I)

_TAG = re.compile(r"<(?:(!--)|([!?/])?([a-zA-Z][^\s/>]*)?)")
_REST = re.compile(r"""(?:[^>=]|=\s*+(?:"[^"]*"|'[^']*'|(?=[^"'])))*+>""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORD = re.compile(r"[^\W\d_]+")
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _marked(name: str, attributes: str, in_section: bool, in_code: bool) -> bool:
    """Whether the attributes say that an element is not part of the article."""
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), unescape(next((v for v in values if v), ""))
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "role" and ROLES.intersection(value.lower().split()):
            return True
        if key == "style" and _INVISIBLE.search(value):
            return True
        # ids of headings and sections are link targets made from their titles; names inside code are of its syntax
        if key == "class" and not in_code or key == "id" and name not in HEADINGS and name not in ("section", "article", "p", "li"):
            for part in value.split():
                words = [w.lower() for w in _NAME.findall(part)]
                if not words or words[0] in NOT_MARKS:
                    continue
                if words[0] in NOT_AN_ARTICLE if name == "article" else not MARKS.isdisjoint(words) or ("header" in words and not in_section):
                    return True
    return False


class Block:
    """A run of text between block-level tags."""

    __slots__ = ("text", "links", "heading", "bad", "section", "in_section", "label")

    def __init__(self, pieces, heading, section, in_section):
        self.bad = all(marked for t, _, marked in pieces if not t.isspace())
        pieces = [p for p in pieces if self.bad or not p[2]]
        self.text = " ".join("".join(t for t, _, _ in pieces).split())
        self.links = sum(len("".join(t.split())) for t, linked, _ in pieces if linked)
        self.heading, self.section, self.in_section, self.label = heading, section, in_section, None


def _raw_end(html: str, name: str, at: int) -> tuple[int, int]:
    """Where a raw element's content ends, and its end tag."""
    close = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
    return (close.start(), close.end()) if close else (len(html), len(html))


def blocks(html: str) -> list[Block]:
    """The page's blocks with text, in page order."""
    out, pieces, stack = [], [], []  # stack: (name, marked, section number, in article or main, in link)
    depth = {}  # how often each element name is open
    sections = 0
    here = ("", False, 0, False, False)

    def flush():
        if any(not t.isspace() for t, _, _ in pieces):
            out.append(Block(pieces, any(depth.get(h) for h in HEADINGS), here[2], here[3]))
        pieces.clear()

    def pop(name):
        nonlocal here
        while stack:
            top = stack.pop()
            depth[top[0]] -= 1
            if top[0] == name:
                break
        here = stack[-1] if stack else ("", False, 0, False, False)

    at, text_from, size = 0, 0, len(html)

    def take(end):
        if end > text_from:
            pieces.append((unescape(html[text_from:end]), here[4], here[1]))

    while at < size:
        m = _TAG.search(html, at)
        if m is None:
            break
        comment, kind, name = m.groups()
        if not comment and not kind and not name or kind == "/" and not name:
            at = m.start() + 1  # no tag: text
            continue
        take(m.start())
        if comment:
            end = html.find("-->", m.end() - 2)
            at = text_from = size if end < 0 else end + 3
            continue
        rest = _REST.match(html, m.end())
        if rest is None:  # an unclosed quote: up to the next bracket
            close = html.find(">", m.end())
            end = size if close < 0 else close + 1
        else:
            end = rest.end()
        at = text_from = end
        if kind in ("!", "?"):
            continue
        name = name.lower()
        if kind == "/":
            if name in ("p", "br") or name not in INLINE:
                flush()
            if depth.get(name):
                pop(name)
            continue
        attributes = html[m.end() : end]
        if name in RAW:
            flush()
            _, at = _raw_end(html, name, end)
            text_from = at
            continue
        if name not in INLINE:
            flush()
            if depth.get("p") and name != "br":
                pop_to = next(e[0] for e in reversed(stack) if e[0] == "p" or e[0] in SCOPES)
                if pop_to == "p":
                    pop("p")
            for other in CLOSED_BY.get(name, ()):
                inner = next((e[0] for e in reversed(stack) if e[0] == other or e[0] in SCOPES), None) if depth.get(other) else None
                if inner == other:
                    pop(other)
        if name in VOID or attributes.endswith("/>"):
            continue
        if name == "a" and depth.get("a"):
            pop("a")
        inside = here[3]
        marked = here[1] or name in BOILER or (name == "header" and not inside)
        if not marked and attributes[:-1].strip() and name not in ("html", "body", "main"):
            marked = _marked(name, attributes[:-1], inside, bool(depth.get("pre") or depth.get("code")))
        section, in_section = here[2], inside
        if name in SECTIONS:
            sections += 1
            section, in_section = sections, True
        here = (name, marked, section, in_section, here[4] or (name == "a" and "href" in attributes.lower()))
        stack.append(here)
        depth[name] = depth.get(name, 0) + 1
    take(size)
    flush()
    return out


def first_pass(block: Block) -> bool | None:
    """Good, bad or open, by the block's own words and links."""
    size = len(block.text)
    if block.bad:
        return False
    if block.links > LINKS_HIGH * len(block.text.replace(" ", "")):
        return False
    if not block.in_section and size < 2 * LONG and _NOTICE.search(block.text):
        return False
    if size < SHORT or block.heading:
        return None
    words = _WORD.findall(block.text.lower())
    stops = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
    if stops >= STOPS_HIGH and size >= LONG:
        return True
    if stops < STOPS_LOW and not block.in_section:
        return False
    return None


def _nearest(decided: list[tuple[int, bool]], at: int, heading: bool) -> bool:
    """Label of the nearest of the decided ``(position, label)``; a heading looks ahead first."""
    k = bisect_left(decided, (at, False))
    after = decided[k] if k < len(decided) else None
    before = decided[k - 1] if k else None
    if before is None or after is None:
        return (after or before)[1]
    if heading or before[1] == after[1]:
        return after[1]
    near, far = at - before[0], after[0] - at
    return before[1] if near < far else after[1] if far < near else True


def classify(found: list[Block]) -> list[Block]:
    """The good blocks, after both passes."""
    for b in found:
        b.label = first_pass(b)
    if not any(b.label or (b.label is None and b.in_section) for b in found):
        for b in found:
            if not b.bad and len(b.text) >= LONG and b.links <= LINKS_HIGH * len(b.text.replace(" ", "")):
                b.label = True
    by_section: dict[int, list] = {}
    for n, b in enumerate(found):
        # a short row of links in an article decides nothing about its neighbours
        if b.label or (b.label is False and not b.bad and (len(b.text) >= LONG or not b.in_section)):
            by_section.setdefault(b.section, []).append((n, b.label))
    page = sorted(d for part in by_section.values() for d in part)
    good = []
    for n, b in enumerate(found):
        if b.label is None:
            if b.section in by_section:
                label = _nearest(by_section[b.section], n, b.heading)
            else:
                label = True if b.in_section or not page else _nearest(page, n, b.heading)
        else:
            label = b.label
        if label:
            good.append(b)
    if any(b.in_section for b in good):
        good = [b for b in good if b.in_section]
    return good


def main_text(html: str | None) -> str:
    return " ".join(b.text for b in classify(blocks(html))) if html else ""


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    rows = pages.select(pages[f"`{page_id}`"].cast("bigint").alias("page_id"), pages[f"`{url}`"].cast("string").alias("url"), pages[f"`{html}`"].cast("string").alias("html"))

    def run(batches):
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def op13_main_text(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
