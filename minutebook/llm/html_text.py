"""Main text of web pages by block rules in two passes.

A page is cut into blocks at its block-level tags. First pass: each block is classified alone. What lies in a part that is never
article text (nav, page header, footer, aside, form, or an element whose class, id or role says menu, advert, comments, notice
and the like) and blocks that are mostly links are dropped; long blocks with enough stop words are kept; long blocks without are dropped, or inside an
article undecided; short blocks stay undecided. Second pass: undecided blocks take the label of the nearest decided neighbours. Where those
differ, headings look ahead and others side with the nearer (of equally near ones with the one before); inside an article the kept one counts, so
that a run there goes only between two dropped blocks. Borders of an article or main element count as kept text seen from inside and are never crossed, and what
lies outside of it is dropped if the page has one.

White space inside a block becomes one space (a single br too, two in a row end the block); scripts, styles, comments of the
markup and form controls are skipped whole.

Defined results: a NULL or empty page, or one without main text, gives an empty text; broken tags and unclosed elements end with the page;
repeated rows are each extracted; other columns play no part; no rows give no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

# Elements whose content is never text of the page.
SKIPPED = {
    "script", "style", "noscript", "template", "title", "textarea", "select", "button", "svg", "math", "iframe", "object", "canvas",
    "audio", "video", "option", "datalist",
}
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"}
CONTENT = {"article", "main"}
CONTAINERS = BOILERPLATE | CONTENT | {
    "div", "section", "ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "tr", "td", "th", "li", "dd", "dt", "blockquote", "figure", "details",
    "center", "address", "hgroup",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BREAKS = CONTAINERS | HEADINGS | {"p", "pre", "hr", "caption", "figcaption", "summary", "legend", "html", "head", "body", "frameset"}
READERS = frozenset("comment comments disqus respond reply replies discussion".split())
# Words in class, id or role that mark a part as something other than the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead comment comments disqus respond reply replies discussion notice notices cookie cookies consent gdpr "
    "popup modal overlay newsletter subscribe subscription signup share sharing social related recommended recommendations pagination pager widget "
    "toolbar login search copyright legal disclaimer alert skip contentinfo complementary dialog form header topbar".split()
)
# Frequent short words of the languages at hand.
STOP_WORDS = frozenset(
    "the of and to in a is that it for as was with be by on not he this are or his from at which but have an had they you were their one all we can "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um "
    "de la le les et des en un une du est que dans qui par pour au sur pas plus ce il sont avec ou se son elle mais nous aux ne cette "
    "el los las y del por con una su para lo como más o pero sus al ya todo esta entre cuando muy sin sobre también me hasta hay donde no se".split()
)
SHORT = 70  # characters of an undecided block
LEAST_STOP_WORDS = 0.1
MOST_LINKS, MOST_LINKS_INSIDE = 0.4, 0.8  # share of a block's characters in links; inside an article, links in a sentence are text

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
MARKED = re.compile(r"(?i)\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
HIDDEN = re.compile(r"(?i)(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true")
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    region: int  # number of the article or main element around it; 0 outside
    boilerplate: bool
    heading: bool
    label: str = ""


def _mark(attributes: str) -> int:
    """2 for readers' comments and hidden parts, 1 for other marks, 0 for none."""
    if not attributes.strip():
        return 0
    if HIDDEN.search(attributes):
        return 2
    words = {w for m in MARKED.findall(attributes) for w in re.split(r"[^a-z]+", m.lower())}
    return 2 if words & READERS else int(not MARKS.isdisjoint(words))


class _Page:
    """The blocks of one page, as its tags come by."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, int, int]] = []  # name, boilerplate, region: as they were outside
        # boilerplate: 1 if only marked so, which an article inside overrules; 2 if nothing does
        self.boilerplate, self.region, self.regions = 0, 0, 0
        self.parts: list[str] = []
        self.linked, self.in_link, self.breaks = 0, False, 0
        self.heading = self.marked = False  # of the block at hand

    def add(self, text: str) -> None:
        text = html.unescape(text) if "&" in text else text
        self.parts.append(text)
        if text.strip():
            self.breaks = 0
            if self.in_link:
                self.linked += len(" ".join(text.split()))

    def finish(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(text, self.linked, self.region, self.boilerplate > 0 or self.marked, self.heading))
        self.parts, self.linked, self.breaks = [], 0, 0

    def open(self, name: str, rest: str) -> None:
        if name == "br":
            self.breaks += 1
            self.parts.append(" ")
            if self.breaks > 1:
                self.finish()
        elif name == "a":
            self.in_link = True
        elif name in BREAKS:
            self.finish()
            self.in_link = False
            self.heading, mark = name in HEADINGS, _mark(rest)
            self.marked = mark > 0 and name not in CONTAINERS
            if name not in CONTAINERS or rest.endswith("/"):
                return
            self.stack.append((name, self.boilerplate, self.region))
            if name in CONTENT and self.boilerplate < 2 and not mark and not self.region:
                self.regions += 1
                self.boilerplate, self.region = 0, self.regions
            elif name in BOILERPLATE and not (name == "header" and self.region):
                self.boilerplate = 2
            else:
                self.boilerplate = max(self.boilerplate, mark)

    def close(self, name: str) -> None:
        if name == "a":
            self.in_link = False
        elif name in BREAKS:
            self.finish()
            self.in_link = self.heading = self.marked = False
            for depth in range(len(self.stack) - 1, -1, -1):
                if self.stack[depth][0] == name:
                    _, self.boilerplate, self.region = self.stack[depth]
                    del self.stack[depth:]
                    break


def page_blocks(page: str) -> list[Block]:
    """The blocks of a page in order."""
    found, at, end, lowered = _Page(), 0, len(page), None
    while at < end:
        tag = TOKEN.search(page, at)
        if tag is None:
            found.add(page[at:])
            break
        if tag.start() > at:
            found.add(page[at:tag.start()])
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            continue
        if tag["end"] or tag["end2"]:
            found.close(name)
        elif name in SKIPPED:
            lowered = page.lower() if lowered is None and page.isascii() else lowered
            close = lowered.find(f"</{name}", at) if lowered is not None else _find(page, f"</{name}", at)
            if close >= 0:
                at = close
            elif name in ("script", "style"):
                break
        else:
            found.open(name, tag["rest"] or "")
    found.finish()
    return found.blocks


def _find(page: str, what: str, at: int) -> int:
    close = re.compile(re.escape(what), re.I).search(page, at)
    return close.start() if close else -1


def classify(blocks: list[Block]) -> None:
    """Set the labels good or bad."""
    inside = any(b.region and not b.boilerplate for b in blocks)
    for b in blocks:
        size = len(b.text)
        if b.boilerplate or (inside and not b.region) or b.linked > (MOST_LINKS_INSIDE if b.region else MOST_LINKS) * size:
            b.label = "bad"
        elif size < SHORT:
            b.label = "bad" if b.linked and not b.region else ""
        else:
            words = WORD.findall(b.text.lower())
            dense = words and sum(w in STOP_WORDS for w in words) >= LEAST_STOP_WORDS * len(words)
            b.label = "good" if dense else "" if b.region else "bad"
    # Nearest decided neighbours, and how far they are. A page's ends count as boilerplate, those of an article as text; inside an
    # article only its own blocks count.
    n = len(blocks)
    before, after = [("bad", 1)] * n, [("bad", 1)] * n
    for near, order, step in ((before, range(n), -1), (after, range(n - 1, -1, -1), 1)):
        for k in order:
            j = k + step
            if not (0 <= j < n and blocks[j].region == blocks[k].region):
                near[k] = ("good" if blocks[k].region else "bad", 1)
            elif blocks[j].label:
                near[k] = (blocks[j].label, 1)
            else:
                near[k] = (near[j][0], near[j][1] + 1)
    for k, b in enumerate(blocks):
        if not b.label:
            (left, far_left), (right, far_right) = before[k], after[k]
            if b.region:  # a run between two bad blocks is bad
                b.label = "good" if "good" in (left, right) else "bad"
            else:
                b.label = right if b.heading or far_right < far_left else left


def main_text(page: str | None) -> str:
    """The main text: the blocks that are kept, two line feeds between them."""
    if not page:
        return ""
    blocks = page_blocks(page)
    classify(blocks)
    return "\n\n".join(b.text for b in blocks if b.label == "good")


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select("page_id", "url", "html")
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(extract, f"page_id {kind}, url string, text string, n_chars long")
