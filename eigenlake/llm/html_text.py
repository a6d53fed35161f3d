"""The main text of web pages by tag-path ratios.

The text of a page is cut into blocks, each under the path of tags that leads to it. Text
length, punctuation and link share are summed up per path and page and fused into one ratio (after Wu
et al., "Web news extraction via path ratios", 2013), which is smoothed over neighbouring
blocks in page order; blocks over a share of the page's mean ratio are its content. A list or table counts as one
block with all its text. Inside an element that the markup names as content a block counts with the whole element, unless it
is an entry of a menu of links.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eigenlake.llm.text import string_parts

# A block is kept from this share of the page's mean ratio, weighted by text length.
KEPT_SHARE = 0.15
# Factor of paths through an element that the markup itself names as content.
NAMED_CONTENT = 4.0
# Elements in a path at most.
DEPTH = 256
# A named part that holds this share of the page's text is no side matter, whatever its name.
MAIN_SHARE = 0.5
# So many blocks of one path or list that are nothing but links make a menu.
MENU_LINKS, LINK_SHARE = 8, 0.9
# Weights of a block and its neighbours, nearest first.
SMOOTHING = (1.0, 0.6, 0.14)

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[A-Za-z][^\s/>]*+)(?P<rest2>[^>]*)>"
    r"|<[!?][^>]*>",
    re.DOTALL,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HEADING = re.compile(r"/h[1-6](?:\.[^/]*)?$")
PUNCTUATION = re.compile(r"[.,;:!?…。，！？]")

# Elements whose content is no text of the page.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
# Elements that hold no article text.
APART = {
    "nav", "footer", "aside", "form", "button", "select", "option", "datalist", "dialog", "menu", "head",
    "svg", "canvas", "audio", "video", "object", "fieldset", "label", "input",
}
# Classes, ids and roles that name such parts, as a whole or by their last word (cookie-notice). Where another word of
# a name is one of these (ad-slot), the part's share of the text decides.
APART_NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner",
    "cookie", "cookies", "consent", "gdpr", "notice", "alert", "notification", "popup", "modal", "overlay",
    "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "sidebar", "aside",
    "related", "recommended", "recommendations", "trending", "breadcrumb", "breadcrumbs", "menu", "nav", "navbar",
    "navigation", "footer", "comment", "comments", "reply", "replies", "respond", "disqus", "widget", "pagination",
    "pager", "toolbar", "search", "masthead", "topbar", "skip", "contentinfo", "complementary", "dialog",
}
# Of these, the ones for parts where readers write.
READERS = {"comment", "comments", "reply", "replies", "respond", "disqus"}
# First and last words that turn a name's meaning round (no-sidebar, comment-enabled, ad-free).
TURNING_FIRST = {"no", "non", "not", "without", "has", "with"}
TURNING_LAST = {"free", "enabled", "disabled", "allowed", "open", "closed", "off"}
CONTENT = {"article", "main"}
# Lists and tables, and what makes a table part of the layout when it stands inside.
UNITS = {"ul", "ol", "dl", "table"}
LAYOUT = {"p", "div", "section", "table", "h1", "h2", "h3", "h4", "h5", "h6"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr", "nobr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# An opening tag ends these open elements, up to the next container.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}


def naming(names: list[str]) -> tuple[bool, bool, bool]:
    """Whether class, id and role name a side part for certain, perhaps, and one of readers."""
    certain = perhaps = readers = False
    for name in " ".join(names).split():
        words = [part.lower() for part in PARTS.findall(name)]
        if not words or words[0] in TURNING_FIRST or words[-1] in TURNING_LAST:
            continue
        hits = APART_NAMES.intersection(words)
        last = words[-1] in hits or name.lower() in APART_NAMES
        certain, perhaps, readers = certain or last, perhaps or bool(hits), readers or bool(hits & READERS)
    return certain, perhaps, readers


class Element(NamedTuple):
    """An open element: its path, and what holds for the text inside."""

    name: str
    path: str
    # Side matter for certain; side matter where readers write.
    apart: bool
    readers: bool
    # Path of the content element around, number of the list or table and of the part that its size judges (or -1).
    content: str
    unit: int
    part: int


class Block(NamedTuple):
    path: str
    text: str
    # Characters in links.
    linked: int
    content: str
    unit: int
    part: int
    apart: bool


ROOT = Element("", "", False, False, "", -1, -1)


class Page:
    """Blocks of a page in order; those of certain side matter only if they stand in an article or main element."""

    def __init__(self, source: str) -> None:
        self.blocks: list[Block] = []
        self.open: list[Element] = []
        # The part around each part; whether a list or table is layout.
        self.parts: list[int] = []
        self.layout: list[bool] = []
        self.links, self.text, self.linked = 0, [], 0
        at = 0
        while True:
            token = TOKEN.search(source, at)
            self.add(source[at : token.start() if token else len(source)])
            if token is None:
                break
            at = token.end()
            name = (token["name"] or token["name2"] or "").lower()
            if not name:
                continue
            if token["close"] or token["close2"]:
                self.close(name)
                continue
            rest = token["rest"] if token["name"] else token["rest2"]
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
                at = end.end() if end else len(source)
                continue
            self.start(name, rest)
        self.flush()

    @property
    def here(self) -> Element:
        return self.open[-1] if self.open else ROOT

    def add(self, raw: str) -> None:
        here = self.here
        if raw and not (here.apart and (here.readers or not here.content)):
            text = html.unescape(raw) if "&" in raw else raw
            self.text.append(text)
            if self.links:
                self.linked += len(text.strip())

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            here = self.here
            self.blocks.append(Block(here.path, text, self.linked, here.content, here.unit, here.part, here.apart))
        self.text, self.linked = [], 0

    def start(self, name: str, rest: str) -> None:
        if name in INLINE:
            self.links += name == "a"
            return
        if name == "br":
            self.text.append(" ")
            return
        self.flush()
        self.links = 0
        if name in VOID:
            return
        if name in ENDS:
            ended, limits = ENDS[name]
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i].name in limits:
                    break
                if self.open[i].name in ended:
                    del self.open[i:]
        elif self.open and self.open[-1].name == "p":
            self.open.pop()
        around = self.here
        names = [a or b or c for a, b, c in NAMED.findall(rest)] if rest else []
        certain, perhaps, readers = naming(names) if names and name not in ("html", "body") else (False, False, False)
        # A header outside the article is the site's; an article inside another is a comment on it.
        comment = name == "article" and "/article" in around.path
        apart = around.apart or name in APART or certain or comment or (name == "header" and not around.content)
        part = around.part
        if perhaps and not apart:
            self.parts.append(part)
            part = len(self.parts) - 1
        unit = around.unit
        if unit >= 0 and name in LAYOUT:
            self.layout[unit] = True
        if name in UNITS and (unit < 0 or self.layout[unit]):
            self.layout.append(False)
            unit = len(self.layout) - 1
        # Paths end at a depth that no article reaches, so that their lengths stay bounded.
        label = f"{around.path}/{name}" + (f".{' '.join(names)}" if names else "") if len(self.open) < DEPTH else around.path
        content = label if name in CONTENT else around.content
        self.open.append(Element(name, label, apart, around.readers or readers or comment, content, unit, part))

    def close(self, name: str) -> None:
        if name in INLINE:
            self.links = max(0, self.links - (name == "a"))
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].name == name:
                self.flush()
                self.links = 0
                del self.open[i:]
                return


def article_blocks(page: Page) -> list[Block]:
    """The blocks that no name or element marks as side matter.

    An article or main element inside side matter (an unclosed menu, a form around the page) counts if there is
    no other and most of the text is in it; a part with a doubtful name stays if most of the text is.
    """
    free = [b for b in page.blocks if not b.apart]
    size = sum(len(b.text) for b in free)
    if not any(b.content for b in free):
        inside = sum(len(b.text) for b in page.blocks) - size
        if inside > size:
            free, size = page.blocks, size + inside
    held = [0] * len(page.parts)
    for block in free:
        part = block.part
        while part >= 0:
            held[part] += len(block.text)
            part = page.parts[part]
    small = [h < MAIN_SHARE * size for h in held]
    for i, around in enumerate(page.parts):
        small[i] = small[i] or (around >= 0 and small[around])
    return [b for b in free if b.part < 0 or not small[b.part]]


def _ratio(size: int, marks: int, count: int, linked: int) -> float:
    """Logs of text and of punctuation per block, times the unlinked share."""
    return math.log1p(size / count) * (1 + math.log1p(marks / count)) * (1 - linked / size)


def path_ratios(blocks: list[Block], layout: list[bool]) -> tuple[list[object], dict, dict[str, float]]:
    """The group of every block (its path, or its list or table), and the fused ratio of every group and content element."""
    sums: dict[object, list[float]] = {}
    whole: dict[str, list[int]] = {}
    keys: list[object] = []
    for block in blocks:
        # A list or table is one block of the text of all its entries.
        key = block.unit if block.unit >= 0 and not layout[block.unit] else block.path
        keys.append(key)
        marks, linked = len(PUNCTUATION.findall(block.text)), min(block.linked, len(block.text))
        entry = sums.setdefault(key, [0, 0, 0, 0, 0, NAMED_CONTENT if block.content else 1.0])
        entry[0] += len(block.text)
        entry[1] += marks
        entry[2] += linked
        entry[3] += 1
        entry[4] += linked >= LINK_SHARE * len(block.text)
        if block.content:
            entry = whole.setdefault(block.content, [0, 0, 0])
            entry[0] += len(block.text)
            entry[1] += marks
            entry[2] += 1
    fused = {}
    for key, (size, marks, linked, count, links, factor) in sums.items():
        menu = links >= MENU_LINKS and linked >= LINK_SHARE * size and not (isinstance(key, str) and HEADING.search(key))
        fused[key] = (factor * _ratio(size, marks, 1 if isinstance(key, int) else count, linked), menu)
    return keys, fused, {path: NAMED_CONTENT * _ratio(*entry, 0) for path, entry in whole.items()}


def main_text(source: str | None) -> str:
    """Article text of a page: white space in a block is one space, blocks are joined by one."""
    page = Page(source) if source else None
    blocks = article_blocks(page) if page else []
    if not blocks:
        return ""
    keys, fused, named = path_ratios(blocks, page.layout)
    # Neighbours are blocks or whole lists and tables.
    first = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1] or isinstance(keys[i], str)]
    spans = list(zip(first, [*first[1:], len(keys)], strict=True))
    raw = [fused[keys[a]][0] for a, _ in spans]
    smooth = []
    for i in range(len(raw)):
        total = weight = 0.0
        for gap, share in enumerate(SMOOTHING):
            for j in {i - gap, i + gap}:
                # Text outside a content element is no neighbour of what is inside.
                if 0 <= j < len(raw) and blocks[spans[j][0]].content == blocks[spans[i][0]].content:
                    total += share * raw[j]
                    weight += share
        smooth.append(total / weight)
    sizes = [sum(len(b.text) for b in blocks[a:b]) for a, b in spans]
    bound = KEPT_SHARE * sum(s * size for s, size in zip(smooth, sizes, strict=True)) / sum(sizes)
    kept = []
    for (a, b), r, s in zip(spans, raw, smooth, strict=True):
        content, menu = blocks[a].content, fused[keys[a]][1]
        # Smoothing lifts short content blocks; it must not lift blocks of a path made of links.
        if (content and named[content] >= bound and not menu) or (s >= bound and r > 0.02 * bound):
            kept += blocks[a:b]
    return " ".join(block.text for block in kept)


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html, ...)``.

    ``text`` is empty for null or empty html, or without content; ``n_chars`` counts code points.
    Rows may repeat; other columns are not read.
    """
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for part in string_parts(batch.column(2)):
                found = [main_text(source.as_py()) for source in part]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(part)),
                        batch.column(1).slice(row, len(part)),
                        pa.array(found, pa.string()),
                        pa.array([len(text) for text in found], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )
                row += len(part)

    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", F.col("html").cast("string")).mapInArrow(run, schema)
