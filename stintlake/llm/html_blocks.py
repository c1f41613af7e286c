"""Main text of web pages from flat text blocks, classified by a decision tree.

A page is cut into blocks of text at block-level tags. A block is described by its word count and link density, those of
the blocks before and after it, and by marks of where it stands: inside an article, inside a part whose tag or names
speak of something else (menu, advert, notice, comments, ...), and inside one whose names speak of both ("post-share",
"footer-content"). A small decision tree, grown on the labelled table below, says which blocks are main text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.llm.common import small_batches

# Element names of HTML.
SILENT = "script style noscript template svg math head title textarea select option button iframe object video audio canvas map".split()
RAW = "script style noscript template svg math textarea iframe object title select option button video audio canvas map".split()
# Those that take up room in a line of text.
BOXES = "svg math textarea select button iframe object video audio canvas".split()
INLINE = (
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label link mark meta q rp rt ruby s samp "
    "small source span strike strong sub sup time tt u var wbr"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
ARTICLE, ASIDE = ("article", "main"), ("nav", "header", "footer", "aside", "dialog", "menu")
# Parts that are beside the main text unless they are put around it.
WRAPPER = ("form", "fieldset")
CODE, FOREIGN = ("script", "style"), ("svg", "math")
# Elements that end a paragraph; with html, head and body also what ends an element that is never closed.
BREAKS = (
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul"
).split()
# Words in class, id and role that name parts beside the main text.
ASIDE_NAMES = set(
    "ad ads adbox adsense advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs byline consent "
    "cookie cookies copyright disclaimer dialog footer form gdpr header legal login masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices notification alert pager pagination paywall popup promo promoted promotion recommended "
    "related search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags teaser toolbar "
    "topbar tooltip tracking warning widget widgets complementary contentinfo".split()
)
# Words that name main text, and such as say that a part has or lacks another.
CONTENT_NAMES = set("article articles body content contents copy entry essay main news page post posts story text".split())
ABOUT_NAMES = set("has have no not with without hide show".split())
COMMENT_NAMES = set("comment comments commentlist discussion disqus replies reply respond responses".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
_LOOSE = re.compile(r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>[^>]*)(?:>|\Z)")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in CODE}
_RAW_TAG = {t: re.compile(rf"<(/?){t}(?=[\s/>])((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.I) for t in RAW if t not in CODE}
_BREAK = re.compile(rf"</?(?:{'|'.join([*BREAKS, 'html', 'head', 'body'])})(?=[\s/>])", re.I)
#: Tags around which a block begins; others, known or not, stand in a line.
_BREAKING = {*BREAKS, "html", "head", "body", "caption", "colgroup", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "frameset"}
#: Elements that end the open one before them if its end tag is left out.
_CELLS, _ROWS = ("td", "th"), ("tr", "td", "th")
_ENDLESS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": _CELLS, "th": _CELLS, "tr": _ROWS, "tbody": _ROWS, "tfoot": _ROWS, "thead": _ROWS}


@dataclass
class Block:
    text: str
    words: int
    linked: int
    in_article: bool
    in_aside: bool
    mixed: bool


def _attributes(rest: str) -> dict[str, str]:
    """Attributes of a tag; of several with one name the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _hidden(given: dict[str, str]) -> bool:
    if given.get("hidden", "false").lower() != "false":
        return True
    return given.get("aria-hidden", "").lower() == "true" or "display:none" in "".join(given.get("style", "").lower().split())


def _named(given: dict[str, str]) -> tuple[bool, bool, bool]:
    """Whether the names of an element speak of comments, of another part beside the main text, and of both that and main text.

    Names are read word by word: "cookie-notice" is beside it, "content" is not, and neither is "has-sidebar".
    """
    beside = content = comments = False
    for name in " ".join(given.get(k, "") for k in ("class", "id", "role")).split():
        words = [part.lower() for part in _NAME_PART.findall(name)]
        if words and words[0] in ABOUT_NAMES:
            continue
        beside |= not ASIDE_NAMES.isdisjoint(words)
        content |= not CONTENT_NAMES.isdisjoint(words)
        comments |= not COMMENT_NAMES.isdisjoint(words)
    return comments, beside and not content, beside and content


def _raw_ends(page: str, tag: str) -> dict[int, int]:
    """Where the elements named ``tag`` end, by where they start; those that are never closed are left out."""
    ends, opened = {}, []
    for m in _RAW_TAG[tag].finditer(page):
        if m[1]:
            if opened:
                ends[opened.pop()] = m.end()
        elif tag in FOREIGN and m[2].endswith("/"):
            ends[m.start()] = m.end()
        else:
            opened.append(m.start())
    return ends


def blocks(page: str | None) -> list[Block]:
    """All text blocks of a page in order; text of silent elements is no text.

    A silent element that is never closed ends at the next block, a head there or at the body, a script or style sheet at
    the end of the page. Every open element keeps whether it stands in an article, how firmly it is something else, and
    whether its names say both: 1 by a name or as a form, which an article inside overrules, 2 by its tag or as comments,
    which only a main element overrules, 3 silent or hidden.
    """
    done: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, tuple[bool, int, bool]]] = []
    state, links = (False, 0, False), 0
    raw_ends: dict[str, dict[int, int]] = {}

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                done.append(Block(text, len(text.split(" ")), len(" ".join(linked).split()), state[0], state[1] > 0, state[2]))
            parts.clear()
            linked.clear()

    def back(to: int) -> None:
        """Leave the open elements from number ``to`` on; what they said holds no longer."""
        nonlocal state
        if stack[to][1] != state:
            flush()
        state = stack[to][1]
        del stack[to:]

    at, page = 0, page or ""
    while at < len(page):
        token = _TOKEN.match(page, at)
        if token["text"] == "<":  # no tag as it should be: a quote that is never closed, perhaps
            token = _LOOSE.match(page, at) or token
        start, at = at, token.end()
        if token.re is _TOKEN and (text := token["text"]) is not None:
            if state[1] < 3:
                parts.append(text)
                if links:
                    linked.append(text)
            continue
        if token["tag"] is None:
            continue
        tag, rest = token["tag"].lower(), token["rest"]
        if tag == "a":
            links = 0 if token["end"] else 1
            continue
        if tag in INLINE and tag not in SILENT:
            if tag == "br":
                parts.append(" ")
                linked.append(" ")
            continue
        breaks = tag in _BREAKING
        if breaks:
            flush()
        if token["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    back(i)
                    break
            if breaks:
                links = 0
            continue
        if tag in CODE:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in RAW:
            if tag in BOXES and state[1] < 3:
                parts.append(" ")
            if tag not in raw_ends:
                raw_ends[tag] = _raw_ends(page, tag)
            if (end := raw_ends[tag].get(start)) is None:
                found = _BREAK.search(page, at)
                end = found.start() if found else len(page)
            at = end
            continue
        if breaks:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ("p", "head"):
                    back(i)
                    break
                if stack[i][0] in BREAKS:
                    break
        if tag in VOID or rest.endswith("/"):
            continue
        if tag in _ENDLESS and stack and stack[-1][0] in _ENDLESS[tag]:
            back(len(stack) - 1)
        stack.append((tag, state))
        in_article, aside, mixed = state
        given = _attributes(rest) if rest and not rest.isspace() else {}
        comments, beside, both = _named(given) if given else (False, False, False)
        if tag in ARTICLE and (aside < 2 or tag == "main" and aside < 3):
            in_article, aside, mixed = True, 2 if comments else 0, False
        elif tag in SILENT:
            aside = 3
        elif tag in ASIDE or comments:
            aside = max(aside, 2)
        elif tag in WRAPPER or tag not in ("html", "body") and beside:
            aside = max(aside, 1)
        elif both and tag not in ("html", "body"):
            mixed = True
        if given and _hidden(given):
            aside = 3
        if (in_article, aside, mixed) != state:
            flush()
            state = (in_article, aside, mixed)
    flush()
    return done


FEATURES = "words link_density words_before density_before words_after density_after in_article in_aside mixed".split()
# Labelled blocks: the features in this order, then 1 for main text. Made by hand; the tree knows nothing else.
LABELLED = """
   1 0.00  40 0.00  50 0.00 1 0 0 1
   1 0.00   1 0.00   1 0.00 1 0 0 1
   2 0.00   2 1.00  10 0.10 1 0 0 1
   3 0.00   6 0.00   0 0.00 1 0 0 1
   4 0.50  60 0.00  60 0.00 1 0 0 1
   6 0.00   3 1.00   3 1.00 1 0 0 1
   9 0.00   1 1.00  90 0.00 1 0 0 1
   9 0.60   4 1.00   2 0.00 1 0 0 1
  12 0.50  30 0.00  30 0.00 1 0 0 1
  15 0.10   0 0.00   0 0.00 1 0 0 1
  30 0.30  40 0.00  40 0.00 1 0 0 1
  60 0.00  80 0.00  70 0.00 1 0 0 1
  60 0.00   5 0.00   1 1.00 1 0 0 1
 200 0.05  10 0.00   8 0.50 1 0 0 1
 200 0.60  10 0.00   8 0.00 1 0 0 1
 500 0.00   5 0.00   7 0.30 1 0 0 1
   1 1.00  30 0.00   1 1.00 1 0 0 0
   2 0.95  30 0.00   0 0.00 1 0 0 0
   4 1.00   5 1.00   6 1.00 1 0 0 0
   5 1.00  50 0.00   5 1.00 1 0 0 0
   8 0.90  60 0.00   7 1.00 1 0 0 0
  12 0.85   9 1.00  11 0.90 1 0 0 0
  40 0.90   2 0.00  60 0.00 1 0 0 0
   1 0.00  50 0.00  50 0.00 1 1 0 0
   6 0.00  60 0.00  60 0.00 1 1 0 0
   9 0.60  90 0.00   8 0.60 1 1 0 0
  15 0.00   6 0.00   0 0.00 1 1 0 0
  25 0.10  90 0.00  90 0.00 1 1 0 0
  60 0.00  80 0.00  70 0.00 1 1 0 0
 150 0.00  20 0.00  30 0.00 1 1 0 0
 400 0.05  60 0.00  60 0.00 1 1 0 0
   5 1.00   5 1.00   5 1.00 1 1 0 0
   1 1.00   1 1.00   1 1.00 0 1 0 0
   2 0.00   0 0.00   1 1.00 0 1 0 0
   6 0.30  40 0.00   3 1.00 0 1 0 0
   8 0.00   1 1.00   9 0.00 0 1 0 0
  12 0.00  70 0.00   0 0.00 0 1 0 0
  16 0.00  20 0.00  17 0.00 0 1 0 0
  18 0.00   0 0.00   0 0.00 0 1 0 0
  20 0.10  19 0.00   3 1.00 0 1 0 0
  30 0.00   1 1.00   0 0.00 0 1 0 0
  40 0.00   8 0.00  30 0.00 0 1 0 0
  70 0.00   2 1.00   9 0.00 0 1 0 0
  90 0.20  60 0.00  80 0.00 0 1 0 0
 120 0.00  60 0.00  60 0.00 0 1 0 0
 400 0.00  30 0.00  30 0.00 0 1 0 0
   1 1.00   1 1.00   2 1.00 0 0 0 0
   3 1.00   3 1.00  60 0.00 0 0 0 0
   4 0.00   0 0.00   1 1.00 0 0 0 0
   5 0.00   1 1.00   2 1.00 0 0 0 0
   6 0.00   4 0.00   3 1.00 0 0 0 0
   7 0.00   8 0.00   0 0.00 0 0 0 0
   8 0.50   9 0.60   7 0.40 0 0 0 0
  10 0.20  10 1.00   0 0.00 0 0 0 0
  11 0.00   3 1.00   2 1.00 0 0 0 0
  25 0.90  30 0.80  20 1.00 0 0 0 0
  40 0.70   5 1.00   6 1.00 0 0 0 0
  90 0.80  60 0.00  60 0.00 0 0 0 0
   3 0.00  45 0.00  40 0.00 0 0 0 1
   8 0.00  60 0.00  70 0.00 0 0 0 1
   9 0.00  20 0.00  19 0.00 0 0 0 1
  15 0.00  20 0.00  15 0.00 0 0 0 1
  15 0.00   3 1.00   2 1.00 0 0 0 1
  16 0.00   0 0.00   0 0.00 0 0 0 1
  17 0.05   3 1.00  16 0.00 0 0 0 1
  19 0.00  22 0.00   2 1.00 0 0 0 1
  20 0.00  35 0.00   8 0.00 0 0 0 1
  22 0.00   2 1.00  19 0.00 0 0 0 1
  25 0.10  60 0.00  40 0.10 0 0 0 1
  30 0.00   1 1.00  45 0.00 0 0 0 1
  40 0.05   6 0.00  50 0.00 0 0 0 1
  60 0.00  80 0.00  70 0.00 0 0 0 1
  90 0.20   9 0.00   5 0.50 0 0 0 1
 120 0.00   2 1.00   3 1.00 0 0 0 1
   8 0.00  40 0.95  30 0.90 0 0 0 0
  12 0.00  30 0.95  25 1.00 0 0 0 0
  14 0.00  60 0.90  40 0.95 0 0 0 0
   7 0.00  25 1.00  20 0.90 0 0 0 0
  16 0.00  45 0.95  50 0.95 0 0 0 0
   8 0.00  40 0.00  30 0.00 0 0 0 1
  12 0.00  30 0.05  25 0.00 0 0 0 1
  14 0.00  60 0.10  40 0.00 0 0 0 1
   7 0.00  25 0.00  20 0.00 0 0 0 1
  16 0.00  45 0.00  50 0.10 0 0 0 1
   1 0.00  40 0.00  50 0.00 1 0 1 1
   2 0.00   3 0.00  60 0.00 1 0 1 1
   9 0.00  60 0.00  30 0.00 1 0 1 1
  20 0.00   5 0.00  25 0.00 1 0 1 1
  60 0.05  80 0.00  70 0.00 1 0 1 1
 300 0.00  60 0.00  60 0.00 1 0 1 1
   3 1.00   4 1.00   3 1.00 1 0 1 0
   6 1.00  60 0.00   5 1.00 1 0 1 0
  15 0.00  20 0.00  20 0.00 0 0 1 1
  20 0.00  40 0.00  30 0.00 0 0 1 1
  25 0.00   0 0.00  30 0.00 0 0 1 1
  30 0.05  35 0.00   2 1.00 0 0 1 1
  60 0.00  80 0.00  70 0.00 0 0 1 1
 120 0.10  30 0.00  60 0.00 0 0 1 1
   1 0.00   0 0.00   3 1.00 0 0 1 0
   3 0.00   4 1.00   2 1.00 0 0 1 0
   4 1.00   3 1.00   5 1.00 0 0 1 0
   6 0.00   8 0.00   0 0.00 0 0 1 0
   9 0.30   5 1.00   7 1.00 0 0 1 0
  12 0.00   4 1.00   6 1.00 0 0 1 0
  20 0.80  10 1.00   9 1.00 0 0 1 0
  18 0.00   9 1.00  40 1.00 0 0 1 0
  25 0.20  30 1.00  12 1.00 0 0 1 0
   1 0.00   0 0.00  18 0.00 1 0 0 1
   2 0.00   5 1.00  18 0.00 1 0 0 1
   4 0.00   2 1.00  30 0.00 1 0 0 1
   8 0.00   0 0.00  17 0.00 1 0 0 1
   8 0.00  18 0.00   3 1.00 1 0 0 1
   9 0.10  60 0.00   0 0.00 1 0 0 1
  18 0.00   8 0.00   0 0.00 1 0 0 1
  18 0.00  18 0.00  18 0.00 1 0 0 1
  18 0.00   2 1.00   0 0.00 1 0 0 1
  18 0.05  30 0.00   4 1.00 1 0 0 1
  19 0.00   1 0.00  19 0.00 1 0 0 1
  35 0.00   4 1.00   6 1.00 1 0 0 1
  35 0.20  18 0.00   0 0.00 1 0 0 1
  80 0.00   0 0.00   0 0.00 1 0 0 1
  90 0.00   3 0.00   2 1.00 1 0 0 1
 150 0.00  60 0.00   1 1.00 1 0 0 1
   5 0.00   5 0.00   5 0.00 1 0 0 1
   1 0.00  18 0.00   1 0.00 1 0 0 1
  10 0.40  18 0.00  18 0.00 1 0 0 1
  18 0.00   2 1.00  18 0.00 0 0 0 1
  18 0.00  18 0.00   0 0.00 0 0 0 1
  18 0.00  18 0.00   2 1.00 0 0 0 1
  18 0.00  18 0.00  18 0.00 0 0 0 1
  40 0.00   2 1.00   0 0.00 0 0 0 1
  60 0.00   3 1.00   4 1.00 0 0 0 1
  18 0.00   0 0.00  18 0.00 0 0 0 1
   9 0.00  18 0.00   0 0.00 0 0 0 0
   2 0.00  18 0.00   0 0.00 0 0 0 0
   4 0.00  30 0.00   2 1.00 0 0 0 0
  18 0.00   2 1.00  18 0.00 0 0 1 1
  18 0.00  18 0.00   0 0.00 0 0 1 1
  20 0.00  18 0.00  25 1.00 1 0 0 1
  60 0.00  30 0.00  40 0.95 1 0 0 1
  25 0.00  20 0.95  30 1.00 1 0 0 1
  16 0.00  25 1.00  25 1.00 1 0 0 1
 120 0.00  60 0.00  20 0.90 1 0 0 1
  40 0.00  30 0.00  30 0.95 0 0 0 1
  80 0.05  60 0.00  25 1.00 0 0 0 1
  30 0.00  25 0.00  20 1.00 0 0 0 1
  20 0.00  18 0.00  12 1.00 0 0 0 1
  90 0.00  40 1.00  40 1.00 0 0 0 1
"""


@dataclass(frozen=True)
class Node:
    """A leaf has a label; an inner node sends values up to ``cut`` left."""

    label: int
    feature: int = -1
    cut: float = 0.0
    left: Node | None = None
    right: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 7) -> Node:
    """A classification tree by Gini impurity; of equal splits the first feature and lowest cut win."""
    label = int(2 * y.sum() > len(y))
    if depth == 0 or y.min() == y.max():
        return Node(label)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            low = x[:, f] <= cut
            impurity = sum(len(part) * part.mean() * (1 - part.mean()) for part in (y[low], y[~low]))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, cut, low)
    if best is None:
        return Node(label)
    _, f, cut, low = best
    return Node(label, f, float(cut), grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


@lru_cache(maxsize=1)
def tree() -> Node:
    table = np.array([line.split() for line in LABELLED.strip().splitlines()], float)
    return grow(table[:, :-1], table[:, -1].astype(int))


def is_main(node: Node, row: tuple[float, ...]) -> bool:
    while node.left is not None:
        node = node.left if row[node.feature] <= node.cut else node.right
    return node.label == 1


def main_text(page: str | None) -> str:
    found, node, kept = blocks(page), tree(), []
    shape = [(0, 0.0), *((b.words, min(1.0, b.linked / b.words)) for b in found), (0, 0.0)]
    for i, block in enumerate(found, 1):
        if is_main(node, (*shape[i], *shape[i - 1], *shape[i + 1], block.in_article, block.in_aside, block.mixed)):
            kept.append(block.text)
    return "\n\n".join(kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: ``page_id``, ``url``, ``text`` (blocks with a blank line between) and ``n_chars``, its code points.

    Null and empty pages, and pages without main text, give an empty text. Pages are read whole, whatever their length;
    markup that is cut off or badly nested is read as far as it goes. Repeated rows are read each; other columns, whatever
    their names, are not looked at; an empty table has no rows.
    """
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for found in batches:
            yield pd.Series([main_text(p).encode("utf-8", "replace").decode("utf-8") for p in found], dtype=object)

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), run(F.col(html_col)).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
