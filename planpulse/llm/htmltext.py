"""Main text of web pages by tree scoring.

A page becomes a tree of block elements.  Menus, headers, footers, sidebars, notices,
adverts, forms and reader comments leave it by their element, role or class names.  Every
paragraph then passes points for its length and its commas, discounted by its links, to the
containers around it: all of them to the nearest, half to the next, a share to three more.
The container with most points after a discount for its own link density is the article;
siblings that look like parts of it are kept.  All text of the kept nodes is returned.

A page is handled alone, in time linear in its length; nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planpulse.llm.common import rows_batch, ship

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</[^a-zA-Z][^>]*+(?:>|\Z)|</>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_COMMAS = re.compile("[,،、，]")
_SENTENCE = re.compile(r"[.!?…。！？](?:[\"'”’»)\]]*)$")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
#: Elements that never hold text of the article.
DROPPED = RAW | frozenset("noscript template svg math canvas audio video object select button datalist nav footer aside "
                          "menu dialog form header".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre section "
                   "summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article body center dd details div fieldset main section td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start of a key closes an open element of the value, as far as no element of SCOPES is between them.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"},
        "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}}
TABLE = frozenset("table caption td th tr tbody thead tfoot".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar "
                  "status toolbar".split())
#: Last words of class names and ids that mark what is no article.
OUTSIDE = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion "
                    "banner banners sidebar sidebars comment comments disqus discussion respond replies cookie cookies "
                    "consent gdpr notice notices notification notifications alert alerts popup modal overlay menu menus "
                    "nav navbar navigation breadcrumb breadcrumbs footer header masthead share sharing social related "
                    "recommended recommendations newsletter subscribe subscription signup login search searchbox widget "
                    "widgets pagination pager toolbar paywall outbrain taboola skyscraper form commentlist".split())
#: Before such a word the last one says what the element goes with, not what it is.
WITH = frozenset("with no has without hide show after before is not non".split())
SEMANTIC = {"article": 25.0, "main": 10.0}
#: Share of a paragraph's points for the containers around it, nearest first.
LEVELS = (1.0, 1 / 2, 1 / 6, 1 / 9, 1 / 12)


def _names_outside(value: str) -> bool:
    for name in value.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if words and words[-1] in OUTSIDE and not any(w in WITH for w in words[:-1]):
            return True
    return False


def _marked(attributes: str) -> bool:
    """Whether the attributes say that an element is hidden or no part of an article."""
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            if _names_outside(value):
                return True
        elif name == "role":
            if value.strip().lower() in ROLES:
                return True
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


class Page:
    """Block tree of a page: nodes in document order, and runs of text with their node."""

    def __init__(self, source: str):
        self.tag, self.parent, self.drop = ["body"], [-1], [False]
        self.blocks: list[tuple[int, str, int]] = []      # node, text, characters in links
        self.links: list[int] = []                        # nodes, one entry for each link
        self._run: list[str] = []
        self._linked = 0
        self._breaks = 0
        self._stack: list[tuple[str, int, tuple | None]] = []   # open elements, the node of their text, a held run
        self._open: dict[str, int] = {}
        self._link = -1                                   # height of the stack at an open link
        self._read(source)
        self._flush()

    def _node(self) -> int:
        return self._stack[-1][1] if self._stack else 0

    def _flush(self) -> None:
        if self._run:
            text = " ".join("".join(self._run).split())
            if text:
                self.blocks.append((self._node(), text, min(self._linked, len(text))))
            self._run, self._linked = [], 0
        self._breaks = 0

    def _text(self, piece: str) -> None:
        if not piece:
            return
        piece = html.unescape(piece) if "&" in piece else piece
        self._run.append(piece)
        if not piece.isspace():
            self._breaks = 0
            if self._link >= 0:
                self._linked += len(" ".join(piece.split()))

    def _pop(self, height: int) -> None:
        """Close all elements above ``height``."""
        while len(self._stack) > height:
            tag, _, held = self._stack[-1]
            if tag in BLOCKS:
                self._flush()
            elif held is not None:                        # the run around a dropped inline element goes on
                self._run, self._linked = held
            self._stack.pop()
            self._open[tag] -= 1
        if self._link > height:
            self._link = -1

    def _close(self, tags: set[str] | frozenset[str], scope: frozenset[str] | set[str]) -> None:
        if not any(self._open.get(t) for t in tags):
            return
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i][0] in tags:
                return self._pop(i)
            if self._stack[i][0] in scope:
                return None

    def _start(self, tag: str, attributes: str) -> None:
        block = tag in BLOCKS
        if block:
            self._close({"p"}, TABLE | {"button"})
            if tag in HEADINGS:
                self._close(HEADINGS, BLOCKS - HEADINGS)
        if tag in ENDS:
            if tag == "tr" or tag in ("tbody", "tfoot"):
                for _ in range(3):
                    self._close(ENDS[tag], {"table"})
            else:
                self._close(ENDS[tag], SCOPES.get(tag, {"table", "tr", "select"} if tag != "option" else {"select"}))
        if block:
            self._flush()
        here = self._node()
        dropped = tag in DROPPED or (bool(attributes) and _marked(attributes))
        if block or dropped:
            self.tag.append(tag)
            self.parent.append(here)
            self.drop.append(dropped)
            here = len(self.tag) - 1
        held = None
        if dropped and not block:
            held = self._run, self._linked
            self._run, self._linked = [], 0
        self._stack.append((tag, here, held))
        self._open[tag] = self._open.get(tag, 0) + 1
        if tag == "a" and self._link < 0:
            self._link = len(self._stack)
            self.links.append(here)

    def _end(self, tag: str) -> None:
        if not self._open.get(tag):
            return self._flush() if tag == "p" else None
        block = tag in BLOCKS
        for i in range(len(self._stack) - 1, -1, -1):
            t = self._stack[i][0]
            if t == tag:
                return self._pop(i)
            if (not block and t in BLOCKS) or (block and t in TABLE and tag not in TABLE):
                return None
        return None

    def _read(self, s: str) -> None:
        at = 0
        while True:
            lt = s.find("<", at)
            if lt < 0:
                return self._text(s[at:])
            m = _MARKUP.match(s, lt)
            if m is None:                        # a "<" that starts no markup is text
                self._text(s[at:lt + 1])
                at = lt + 1
                continue
            self._text(s[at:lt])
            at = m.end()
            if m.group(2) is None:
                continue
            tag = m.group(2).lower()
            if m.group(1):
                if tag not in ("html", "body", "head"):
                    self._end(tag)
            elif tag in ("html", "body", "head"):
                pass
            elif tag in VOID:
                if tag == "br":
                    self._run.append(" ")
                    self._breaks += 1
                    if self._breaks > 1:
                        self._flush()
                elif tag == "hr":
                    self._close({"p"}, TABLE)
                    self._flush()
            elif tag in RAW:                     # its content is no markup: skip to its end
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(s, at)
                if end is None:
                    return
                at = end.start()
                close = s.find(">", at)
                at = len(s) if close < 0 else close + 1
            elif m.group(3).endswith("/") and tag not in BLOCKS and tag not in ("a", "b", "i", "span"):
                continue
            else:
                self._start(tag, m.group(3))


def main_text(source: str | None) -> str:
    """The article of one page, its blocks in page order joined by one space."""
    if not source:
        return ""
    page = Page(source)
    tag, parent = page.tag, page.parent
    n = len(tag)
    gone = list(page.drop)
    holds = [False] * n                                   # an h1 or main element below
    in_article = [False] * n
    for i in range(n - 1, 0, -1):
        if (holds[i] or tag[i] in ("h1", "main")) and not (gone[i] and tag[i] in DROPPED - {"form"}):
            holds[parent[i]] = True
    kept_header = [False] * n                             # an article's own header: its headings stay
    for i in range(1, n):
        p = parent[i]
        in_article[i] = in_article[p] or tag[i] in ("article", "main")
        if gone[i] and not gone[p] and in_article[p] and tag[i] == "header":
            kept_header[i], gone[i] = True, False
        elif gone[i] and holds[i] and tag[i] not in DROPPED - {"form"}:
            gone[i] = False                               # it wraps the page's main part
        if kept_header[p] and tag[i] not in HEADINGS:
            kept_header[i] = True
        gone[i] = gone[i] or gone[p]
    blocks = [b for b in page.blocks if not gone[b[0]] and not kept_header[b[0]]]
    if not blocks:
        return ""
    size, linked, points = [0] * n, [0] * n, [SEMANTIC.get(t, 0.0) for t in tag]
    for node, text, in_links in blocks:
        size[node] += len(text)
        linked[node] += in_links
        if tag[node] in HEADINGS:
            continue
        worth = (min(len(text) / 100, 3.0) + len(_COMMAS.findall(text)) + (len(text) >= 25)) * (1 - in_links / len(text))
        at, level = node, 0
        while at >= 0 and level < len(LEVELS):
            if tag[at] in CONTAINERS:
                points[at] += worth * LEVELS[level]
                level += 1
            at = parent[at]
    for i in range(n - 1, 0, -1):
        size[parent[i]] += size[i]
        linked[parent[i]] += linked[i]

    def density(i: int) -> float:
        return linked[i] / size[i] if size[i] else 0.0

    score = [points[i] * (1 - density(i)) if tag[i] in CONTAINERS and not gone[i] else -1.0 for i in range(n)]
    best = max(range(n), key=lambda i: (score[i], -i))
    at = best
    while at > 0 and tag[at] not in SEMANTIC:
        at = parent[at]
    best = at if at > 0 else best
    keep = [False] * n
    keep[best] = True
    around = parent[best]
    runs: set[int] = set()                                # kept blocks that lie in ``around`` itself
    if around >= 0:
        least = max(3.0, score[best] / 5)
        for i in range(1, n):
            if parent[i] != around or gone[i] or i == best:
                continue
            if tag[best] in SEMANTIC:
                keep[i] = tag[i] == tag[best] and score[i] >= least
            elif tag[i] in CONTAINERS:
                keep[i] = score[i] >= least
            elif tag[i] not in HEADINGS:
                keep[i] = size[i] > 80 and density(i) < 0.25
        if tag[best] not in SEMANTIC:
            for k, (node, text, in_links) in enumerate(blocks):
                if node == around or (parent[node] == around and tag[node] == "p" and not keep[node]):
                    if in_links == 0 and (len(text) > 80 or _SENTENCE.search(text)):
                        runs.add(k)
            following = False                             # a heading stays with the kept part it stands above
            for i in range(n - 1, 0, -1):
                if parent[i] == around and not gone[i]:
                    if tag[i] in HEADINGS and not linked[i]:
                        keep[i] = following
                    following = keep[i]
    anchors = [0] * n
    for i in page.links:
        anchors[i] += 1
    for i in range(n - 1, 0, -1):
        anchors[parent[i]] += anchors[i]
    for i in range(1, n):
        if keep[parent[i]]:
            menu = tag[i] in ("ul", "ol", "dl", "dir") and anchors[i] >= 3 and density(i) >= 0.8
            keep[i] = not gone[i] and not menu
    return " ".join(text for k, (node, text, _) in enumerate(blocks) if keep[node] or k in runs)


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [main_text(s) for s in batch.column("html").to_pylist()]
        yield rows_batch(_SCHEMA, [batch.column("page_id"), batch.column("url"), found, [len(t) for t in found]])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page: its main text and that text's code points.

    Null or empty html, and pages without an article, give an empty text; pages cut off in
    the middle are read to their end; repeated rows are extracted alike; further columns are
    ignored.  White space (Unicode) inside a block becomes one space.  Of a header inside
    an article its headings stay.  The tree of one page is held in memory, nothing else.
    """
    ship(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")
