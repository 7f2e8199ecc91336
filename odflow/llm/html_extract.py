"""Main text of web pages from flat text blocks.

A page is cut into blocks at block-level tags. A decision tree decides on each block by
its number of words and link density, those of its neighbours, and where it stands. The
tree is grown on the labelled blocks of ``TABLE``. Tags and class names such as ``sidebar``
are inputs of the tree only, through the share of the page that such an element holds: a
wrapper of the whole page is no sidebar, whatever it is called.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

FEATURES = (
    "words",
    "link_share",
    "words_before",
    "link_share_before",
    "words_after",
    "link_share_after",
    # The least share of the page's words that an element around the block holds which is
    # by tag or name a menu, footer, sidebar, advert, form or the like; 1 without any.
    "frame_share",
    "wrap_share",  # the same of such elements that hold an article or main element
    "in_main",  # inside an article or main element
    "in_paragraph",
    "page_share",  # of the page's words
)

# Labelled blocks: the features above, and 1 for main text.
TABLE = (
    # menus and link lists
    (1, 1.0, 0, 0.0, 1, 1.0, 0.02, 1.0, 0, 1, 0.01, 0),
    (1, 1.0, 1, 1.0, 1, 1.0, 0.1, 1.0, 0, 0, 0.01, 0),
    (2, 1.0, 1, 1.0, 9, 0.0, 0.05, 1.0, 0, 1, 0.02, 0),
    (3, 1.0, 2, 1.0, 2, 1.0, 1.0, 1.0, 0, 0, 0.02, 0),
    (6, 1.0, 4, 1.0, 5, 1.0, 1.0, 1.0, 0, 0, 0.04, 0),
    (12, 0.9, 6, 1.0, 7, 1.0, 1.0, 1.0, 0, 0, 0.08, 0),
    (4, 1.0, 60, 0.0, 3, 1.0, 1.0, 1.0, 1, 0, 0.02, 0),
    (5, 1.0, 3, 1.0, 0, 0.0, 1.0, 1.0, 1, 0, 0.04, 0),
    (30, 0.8, 3, 1.0, 4, 1.0, 1.0, 1.0, 0, 0, 0.19, 0),
    (14, 0.7, 20, 0.0, 5, 1.0, 1.0, 1.0, 1, 0, 0.09, 0),
    (6, 1.0, 60, 0.0, 40, 0.0, 1.0, 1.0, 1, 1, 0.02, 0),
    (4, 1.0, 50, 0.0, 0, 0.0, 1.0, 1.0, 0, 1, 0.05, 0),
    (9, 0.9, 45, 0.0, 30, 0.0, 1.0, 1.0, 1, 1, 0.03, 0),
    (15, 0.7, 8, 0.0, 50, 0.0, 1.0, 1.0, 0, 1, 0.06, 0),
    # adverts, notices, forms, sidebars, comments: any length
    (4, 0.0, 1, 1.0, 12, 0.0, 0.3, 1.0, 0, 0, 0.03, 0),
    (9, 0.0, 1, 1.0, 8, 0.0, 0.15, 1.0, 0, 1, 0.07, 0),
    (17, 0.1, 2, 1.0, 6, 0.0, 0.6, 1.0, 0, 0, 0.12, 0),
    (25, 0.0, 90, 0.0, 4, 0.0, 0.25, 1.0, 1, 1, 0.1, 0),
    (40, 0.0, 1, 1.0, 10, 0.0, 0.78, 1.0, 0, 0, 0.23, 0),
    (80, 0.0, 60, 0.0, 40, 0.0, 0.4, 1.0, 0, 1, 0.27, 0),
    (120, 0.0, 8, 0.0, 60, 0.0, 0.02, 1.0, 1, 0, 0.39, 0),
    (3, 0.0, 2, 0.0, 3, 0.0, 0.1, 1.0, 1, 1, 0.02, 0),
    (60, 0.05, 30, 0.0, 0, 0.0, 0.05, 1.0, 1, 0, 0.29, 0),
    # footers
    (7, 0.0, 50, 0.0, 0, 0.0, 0.3, 1.0, 0, 1, 0.04, 0),
    (15, 0.3, 4, 0.0, 0, 0.0, 0.15, 1.0, 0, 0, 0.11, 0),
    (6, 0.0, 80, 0.0, 0, 0.0, 1.0, 1.0, 0, 0, 0.03, 0),
    (4, 0.5, 5, 1.0, 0, 0.0, 1.0, 1.0, 0, 0, 0.03, 0),
    (3, 0.0, 1, 1.0, 2, 1.0, 1.0, 1.0, 0, 0, 0.02, 0),
    (5, 0.0, 0, 0.0, 2, 1.0, 1.0, 1.0, 0, 0, 0.04, 0),
    # site names, imprints and dates without an element that tells
    (1, 0.0, 60, 0.0, 0, 0.0, 1.0, 1.0, 0, 0, 0.01, 0),
    (2, 0.0, 12, 0.0, 0, 0.0, 1.0, 1.0, 0, 0, 0.1, 0),
    (4, 0.0, 30, 0.0, 1, 0.0, 1.0, 1.0, 0, 0, 0.02, 0),
    (3, 0.0, 45, 0.0, 0, 0.0, 1.0, 1.0, 0, 1, 0.03, 0),
    (2, 0.0, 90, 0.0, 5, 0.5, 1.0, 1.0, 0, 1, 0.01, 0),
    (1, 0.0, 30, 0.0, 6, 0.0, 1.0, 1.0, 0, 1, 0.02, 0),
    (4, 0.0, 10, 0.0, 0, 0.0, 1.0, 1.0, 0, 1, 0.1, 0),
    (2, 0.0, 70, 0.0, 40, 0.0, 1.0, 1.0, 0, 1, 0.01, 0),
    (3, 0.0, 120, 0.0, 2, 0.0, 1.0, 1.0, 0, 1, 0.02, 0),
    (2, 0.0, 5, 0.0, 90, 0.0, 1.0, 1.0, 0, 1, 0.02, 0),
    (4, 0.0, 35, 0.0, 60, 0.0, 1.0, 1.0, 0, 1, 0.03, 0),
    (2, 0.0, 0, 0.0, 9, 0.0, 1.0, 1.0, 0, 0, 0.04, 0),
    (3, 0.0, 1, 1.0, 4, 0.0, 1.0, 1.0, 0, 0, 0.02, 0),
    (2, 0.0, 0, 0.0, 60, 0.0, 1.0, 1.0, 0, 0, 0.01, 0),
    (5, 0.0, 3, 1.0, 120, 0.0, 1.0, 1.0, 0, 0, 0.02, 0),
    (9, 0.0, 2, 0.0, 80, 0.0, 1.0, 1.0, 0, 0, 0.03, 0),
    (6, 0.0, 50, 0.0, 45, 0.0, 1.0, 1.0, 0, 0, 0.02, 0),
    (9, 0.0, 70, 0.0, 0, 0.0, 1.0, 1.0, 0, 0, 0.02, 0),
    (7, 0.1, 0, 0.0, 3, 1.0, 1.0, 1.0, 0, 0, 0.05, 0),
    (13, 0.2, 25, 0.0, 0, 0.0, 1.0, 1.0, 0, 0, 0.06, 0),
    (11, 0.0, 4, 0.0, 2, 0.0, 1.0, 1.0, 0, 0, 0.08, 0),
    # article text: short headings, lines of lists and verses
    (1, 0.0, 0, 0.0, 2, 0.0, 1.0, 1.0, 1, 0, 0.01, 1),
    (2, 0.0, 90, 0.0, 80, 0.0, 1.0, 1.0, 1, 1, 0.01, 1),
    (1, 0.0, 30, 0.0, 40, 0.0, 1.0, 1.0, 1, 1, 0.01, 1),
    (2, 0.0, 50, 0.0, 3, 0.0, 1.0, 1.0, 1, 1, 0.02, 1),
    (3, 0.0, 40, 0.0, 0, 0.0, 1.0, 1.0, 1, 1, 0.03, 1),
    (2, 0.0, 3, 0.0, 35, 0.0, 1.0, 1.0, 1, 1, 0.02, 1),
    (1, 0.0, 60, 0.0, 8, 0.0, 1.0, 1.0, 1, 1, 0.01, 1),
    (3, 0.0, 4, 0.0, 60, 0.0, 1.0, 1.0, 1, 0, 0.02, 1),
    (4, 0.0, 75, 0.0, 4, 0.0, 1.0, 1.0, 1, 0, 0.02, 1),
    (5, 0.0, 20, 0.0, 0, 0.0, 1.0, 1.0, 1, 0, 0.03, 1),
    (5, 0.2, 55, 0.0, 1, 1.0, 1.0, 1.0, 1, 1, 0.02, 1),
    (9, 0.0, 85, 0.0, 0, 0.0, 1.0, 1.0, 1, 0, 0.04, 1),
    (13, 0.0, 3, 0.0, 3, 1.0, 1.0, 1.0, 1, 0, 0.1, 1),
    # article text: headings, long and short paragraphs, with links
    (8, 0.0, 10, 0.0, 40, 0.0, 1.0, 1.0, 1, 0, 0.04, 1),
    (6, 0.0, 12, 0.0, 6, 0.0, 1.0, 1.0, 1, 1, 0.04, 1),
    (1, 0.0, 70, 0.0, 50, 0.0, 1.0, 1.0, 1, 0, 0.0, 1),
    (2, 0.0, 3, 0.0, 2, 0.0, 1.0, 1.0, 1, 1, 0.02, 1),
    (3, 0.0, 30, 0.0, 9, 0.0, 1.0, 1.0, 1, 0, 0.02, 1),
    (4, 0.0, 8, 0.0, 0, 0.0, 1.0, 1.0, 1, 1, 0.03, 1),
    (10, 0.0, 2, 1.0, 90, 0.0, 1.0, 1.0, 1, 0, 0.05, 1),
    (60, 0.1, 30, 0.0, 45, 0.0, 1.0, 1.0, 1, 1, 0.24, 1),
    (90, 0.0, 9, 0.0, 80, 0.0, 1.0, 1.0, 1, 0, 0.3, 1),
    (22, 0.4, 70, 0.0, 60, 0.1, 1.0, 1.0, 1, 1, 0.08, 1),
    (300, 0.0, 2, 0.0, 7, 0.0, 1.0, 1.0, 1, 0, 0.45, 1),
    (45, 0.2, 5, 1.0, 5, 1.0, 1.0, 1.0, 1, 1, 0.26, 1),
    # text of pages without an article element
    (60, 0.0, 40, 0.0, 55, 0.0, 1.0, 1.0, 0, 1, 0.22, 1),
    (35, 0.1, 8, 0.0, 60, 0.0, 1.0, 1.0, 0, 1, 0.16, 1),
    (110, 0.0, 3, 1.0, 7, 0.0, 1.0, 1.0, 0, 1, 0.45, 1),
    (18, 0.0, 80, 0.0, 70, 0.0, 1.0, 1.0, 0, 1, 0.06, 1),
    (7, 0.0, 2, 1.0, 85, 0.0, 1.0, 1.0, 0, 1, 0.03, 1),
    (5, 0.0, 60, 0.0, 75, 0.0, 1.0, 1.0, 0, 1, 0.02, 1),
    (25, 0.2, 50, 0.0, 4, 1.0, 1.0, 1.0, 0, 1, 0.13, 1),
    (70, 0.05, 1, 1.0, 2, 1.0, 1.0, 1.0, 0, 1, 0.36, 1),
    # frames that hold an article: teasers in a sidebar, and page wrappers by their names
    (30, 0.1, 20, 0.0, 25, 0.2, 1.0, 0.1, 1, 1, 0.05, 0),
    (15, 0.0, 6, 1.0, 9, 0.0, 1.0, 0.2, 1, 0, 0.03, 0),
    (20, 0.0, 60, 0.0, 70, 0.0, 1.0, 0.15, 1, 1, 0.04, 0),
    (40, 0.0, 9, 0.0, 90, 0.0, 1.0, 0.12, 1, 0, 0.08, 0),
    (8, 0.0, 40, 0.0, 0, 0.0, 1.0, 0.18, 1, 1, 0.14, 0),
    (60, 0.0, 40, 0.0, 30, 0.0, 1.0, 0.45, 1, 1, 0.2, 1),
    (45, 0.0, 5, 0.0, 50, 0.0, 1.0, 0.7, 1, 1, 0.1, 1),
    (30, 0.0, 40, 0.0, 70, 0.0, 1.0, 0.4, 1, 0, 0.15, 1),
    (50, 0.1, 3, 0.0, 0, 0.0, 1.0, 0.5, 1, 0, 0.3, 1),
    (8, 0.0, 30, 0.0, 3, 1.0, 1.0, 0.9, 1, 1, 0.04, 1),
    # frames that are nearly all of the page
    (50, 0.0, 40, 0.0, 60, 0.0, 0.92, 1.0, 0, 1, 0.3, 1),
    (70, 0.0, 3, 1.0, 0, 0.0, 0.96, 1.0, 0, 0, 0.45, 1),
    # last paragraphs and short pages without an article element
    (8, 0.0, 45, 0.0, 0, 0.0, 1.0, 1.0, 0, 1, 0.05, 1),
    (7, 0.0, 60, 0.0, 2, 1.0, 1.0, 1.0, 0, 1, 0.04, 1),
    (6, 0.0, 25, 0.0, 0, 0.0, 1.0, 1.0, 0, 1, 0.1, 1),
    (4, 0.0, 0, 0.0, 0, 0.0, 1.0, 1.0, 0, 1, 1.0, 1),
    (2, 0.0, 0, 0.0, 0, 0.0, 1.0, 1.0, 0, 1, 1.0, 1),
    (3, 0.0, 2, 1.0, 1, 1.0, 1.0, 1.0, 0, 1, 0.6, 1),
    (22, 0.0, 0, 0.0, 40, 0.0, 1.0, 1.0, 0, 0, 0.1, 1),
    (40, 0.0, 45, 0.0, 50, 0.0, 1.0, 1.0, 0, 0, 0.05, 1),
    (9, 0.0, 1, 1.0, 0, 0.0, 1.0, 1.0, 0, 1, 0.9, 1),
    (2, 1.0, 0, 0.0, 0, 0.0, 1.0, 1.0, 0, 1, 1.0, 0),
)

# HTML elements by what they do to text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label "
    "mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
SILENT = frozenset(
    "script style noscript template title textarea select option button iframe object "
    "svg math canvas audio video head".split()
)
RAW = frozenset("script style textarea title iframe noscript template".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
FRAME_TAGS = frozenset("nav footer aside form menu dialog header fieldset".split())
MAIN_TAGS = frozenset("article main".split())
FRAME_WORDS = re.compile(
    r"(?<![a-z0-9])(ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side-bar|widget|menu|"
    r"nav\w*|breadcrumbs?|footer|header|masthead|cookies?|consent|notices?|alert|popup|modal|"
    r"newsletter|subscribe|signup|login|comments?|respond|replies|disqus|share|social|"
    r"related|recommend\w*|toolbar|pagination|skip-link)(?=$|[\s_-])",
    re.I,
)
# Names that tell what an element has, not what it is.
_MODIFIER = re.compile(r"^(?:has|no|with|without|is)[-_]", re.I)
_COMMENTS = re.compile(r"\b(?:comments?|respond|replies|disqus)", re.I)
# Elements that a start tag of the same kind ends.
_ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "tr": {"td", "th", "tr"},
}

_PIECE = re.compile(
    r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>|<[!?][^>]*>|([^<]+|<)",
    re.S,
)
# A tag with a quote that is never closed.
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(
    r"([^\s\"'>/=][^\s\"'>/=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?"
)
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)


def attributes(rest: str) -> tuple[dict[str, str], bool]:
    """Attributes by lower-case name, the first of a name, and whether the tag ends in ``/``.

    A slash that ends an unquoted value belongs to the value.
    """
    found: dict[str, str] = {}
    end, open_value = 0, False
    for m in _ATTRIBUTE.finditer(rest):
        value = next((g for g in m.groups()[1:] if g is not None), "")
        found.setdefault(m[1].lower(), unescape(value))
        end, open_value = m.end(), m[4] is not None
    return found, rest.endswith("/") and not (open_value and end == len(rest))


@dataclass
class Frame:
    """An element that is by tag or name not the page's text."""

    parent: int
    start: int  # words of the page before it
    end: int = -1
    comments: bool = False
    holds_main: bool = False


@dataclass
class Tag:
    name: str
    block: bool
    silent: bool
    frame: int | None  # index of its frame
    main: bool


@dataclass
class Block:
    text: str
    words: int
    linked: int
    frame: int
    in_main: bool
    in_paragraph: bool


class _Page:
    """Open elements, blocks and frames of a page while it is read."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.frames: list[Frame] = []
        self.tags: list[Tag] = []
        self.open: Counter[str] = Counter()  # blocks by name
        self.around: list[str] = []  # names of the open blocks
        self.inline: list[Counter[str]] = [Counter()]  # inline elements of each open block
        self.parts: list[str] = []
        self.linked = self.silent = self.main = self.words = 0
        self.frame = -1

    def flush(self) -> None:
        """End the block of text."""
        found = "".join(self.parts).split()
        if found:
            linked = min(self.linked, len(found))
            self.blocks.append(
                Block(" ".join(found), len(found), linked, self.frame, self.main > 0, self.open["p"] > 0)
            )
            self.words += len(found)
        self.parts.clear()
        self.linked = 0

    def push(self, name: str, rest: str, block: bool) -> None:
        attrs, closed = attributes(rest) if rest else ({}, False)
        if closed:
            return
        frame = self.framed(name, attrs) if block else None
        hidden = "hidden" in attrs or bool(_UNSEEN.search(attrs.get("style", "")))
        tag = Tag(name, block, hidden or name in SILENT, frame, name in MAIN_TAGS)
        self.tags.append(tag)
        self.silent += tag.silent
        self.main += tag.main
        if block:
            self.open[name] += 1
            self.around.append(name)
            self.inline.append(Counter())
        else:
            self.inline[-1][name] += 1
        if frame is not None:
            self.frame = frame
        elif tag.main:
            around = self.frame
            while around >= 0 and not self.frames[around].holds_main:
                self.frames[around].holds_main = not self.frames[around].comments
                around = self.frames[around].parent

    def framed(self, name: str, attrs: dict[str, str]) -> int | None:
        """A new frame, if the element is one by its tag or its names."""
        names = " ".join(attrs.get(a, "") for a in ("class", "id", "role")).split()
        said = " ".join(n for n in names if not _MODIFIER.match(n))
        comments = bool(_COMMENTS.search(said))
        if name in MAIN_TAGS:
            is_frame = comments
        elif name in ("body", "html"):
            is_frame = False
        else:
            words = {w.lower() for w in FRAME_WORDS.findall(said)} | ({name} & FRAME_TAGS)
            # The header of an article is its title.
            is_frame = bool(words - {"header"} if self.main else words)
        if not is_frame:
            return None
        self.frames.append(Frame(self.frame, self.words, comments=comments))
        return len(self.frames) - 1

    def pop(self) -> Tag:
        tag = self.tags.pop()
        self.silent -= tag.silent
        self.main -= tag.main
        if tag.block:
            self.open[tag.name] -= 1
            self.around.pop()
            self.inline.pop()
        else:
            self.inline[-1][tag.name] -= 1
        if tag.frame is not None:
            self.frames[tag.frame].end = self.words
            self.frame = self.frames[tag.frame].parent
        return tag

    def close(self, name: str, block: bool) -> None:
        """End the innermost element of a name; an inline one only within its block."""
        if self.open[name] if block else self.inline[-1][name]:
            while self.pop().name != name:
                pass

    def end_implied(self, name: str) -> None:
        """A block's start ends a paragraph, and an item ends the one before."""
        ended = _ENDS.get(name, set()) | {"p"}
        while self.around and self.around[-1] in ended:
            while not self.pop().block:
                pass


def read_page(html: str) -> _Page:
    """The text blocks of a page in order, blank ones left out, and its frames."""
    page = _Page()
    links = at = 0
    raw = None
    while at < len(html):
        if raw:
            end = re.compile(rf"</{raw}\b", re.I).search(html, at)
            at, raw = (end.start() if end else len(html)), None
            continue
        found = _PIECE.match(html, at)
        if not found:  # a tag that never ends
            break
        at = found.end()
        closing, name, rest, text = found.groups()
        if text == "<" and (loose := _LOOSE.match(html, at - 1)):
            (closing, name, rest), text, at = loose.groups(), None, loose.end()
        if text is not None:
            if not page.silent:
                text = unescape(text)
                page.parts.append(text)
                if links:
                    page.linked += len(text.split())
            continue
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            page.parts.append(" ")
            continue
        block = name not in INLINE
        if block:
            page.flush()
        if name == "a":
            links = 0 if closing else 1
        if name in VOID:
            continue
        if closing:
            page.close(name, block)
            continue
        if block:
            page.end_implied(name)
        page.push(name, rest, block)
        if name in RAW:
            raw = name
    page.flush()
    while page.tags:
        page.pop()
    return page


def blocks(html: str) -> list[Block]:
    """The text blocks of a page in order, blank ones left out."""
    return read_page(html).blocks


def _shares(page: _Page) -> tuple[np.ndarray, np.ndarray]:
    """``frame_share`` and ``wrap_share`` by frame; a last row for blocks in none."""
    least = np.ones((2, len(page.frames) + 1))
    for i, frame in enumerate(page.frames):  # parents come first
        least[:, i] = least[:, frame.parent]
        kind = int(frame.holds_main)
        share = (frame.end - frame.start) / max(page.words, 1)
        least[kind, i] = min(least[kind, i], share)
    return least[0], least[1]


def features(page: _Page) -> np.ndarray:
    """One row of ``FEATURES`` per block."""
    found = page.blocks
    own = np.array([(b.words, b.linked / b.words) for b in found], float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    frame = np.array([b.frame for b in found], np.int64)
    around = np.stack([share[frame] for share in _shares(page)], 1)
    place = np.array([(b.in_main, b.in_paragraph) for b in found], float).reshape(-1, 2)
    before = np.concatenate([edge, own[:-1]])[: len(own)]
    after = np.concatenate([own[1:], edge])[: len(own)]
    of_page = own[:, :1] / max(page.words, 1)
    return np.concatenate([own, before, after, around, place, of_page], 1)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> tuple | int:
    """A decision tree by Gini impurity: ``(feature, threshold, low, high)`` or a label."""
    share = y.mean()
    if depth == 0 or share in (0.0, 1.0):
        return int(share >= 0.5)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for threshold in (values[1:] + values[:-1]) / 2:
            low = x[:, f] < threshold
            impurity = sum(
                part.sum() * y[part].mean() * (1 - y[part].mean()) for part in (low, ~low)
            )
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, float(threshold), low)
    if best is None:
        return int(share >= 0.5)
    _, f, threshold, low = best
    return f, threshold, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def default_tree() -> tuple | int:
    table = np.array(TABLE, float)
    return grow(table[:, :-1], table[:, -1])


def decide(tree: tuple | int, row: np.ndarray) -> int:
    while not isinstance(tree, int):
        f, threshold, low, high = tree
        tree = low if row[f] < threshold else high
    return tree


def main_text(html: str, tree: tuple | int) -> str:
    """The main text of one page: its chosen blocks, joined by one blank."""
    page = read_page(html)
    rows = features(page)
    return " ".join(b.text for b, row in zip(page.blocks, rows, strict=True) if decide(tree, row))


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page; no shuffle.

    Character references are decoded, white space within a block is one blank, and the
    chosen blocks stand in page order. A null or empty page, or one without main text,
    gives an empty text. Nothing is cut; rows that repeat give repeated rows.
    """
    rows = pages.select(id_col, url_col, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = default_tree()
        for batch in batches:
            texts = [main_text(h.as_py() or "", tree) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                [id_col, url_col, "text", "n_chars"],
            )

    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (id_col, url_col)]
    return rows.mapInArrow(run, ", ".join([*kinds, "text string", "n_chars bigint"]))
