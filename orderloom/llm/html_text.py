"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into flat text blocks at block-level tags. A block is described by its words and link density, those of
its neighbours, and three marks: whether it lies in page furniture (nav, footer, aside, a form, a page header, reader
comments), in article content, or in an element whose class or id names furniture. A decision tree, grown on the small
labelled table below, keeps or drops each block: furniture goes, content stays whatever stands beside it, elsewhere link
lists go, and what is only named like furniture goes where it is short. Script, style and other non-text elements are never blocks.

A name counts by its last word (``page-header``, not ``page-header-fixed`` or ``has-sidebar``), never on article or main,
and inside an article only if it is one for adverts, sharing, notices of cookies and the like. A named element, header or form that
holds more than half of the page's unlinked words, and all of its article if it has one, marks nothing.

Pages are read once from left to right, whatever their length and however broken. A quote opens an attribute's value only after an
equals sign, and only if it is closed somewhere; a tag that never ends takes the rest of the page. Null and empty pages, and
pages without kept blocks, have the empty text. Repeated pages are extracted each on its own. Tags left open end with the
page; stray end tags are ignored. An empty table gives an empty one. Other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_OPEN = re.compile(r"<(?=[a-zA-Z/!?])")
_STOP = re.compile(r"[=>]")
_SPACE = re.compile(r"\s*+")
_WORD = re.compile(r"\S+")
# Elements whose content is no text, inline elements, furniture by element and by class or id.
SILENT = frozenset("script style noscript template svg iframe object head select textarea button math canvas".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
FURNITURE = frozenset("nav footer aside form menu dialog".split())
CONTAINERS = frozenset("div section article main header ul ol table figure body html td tr blockquote".split()) | FURNITURE
ADVERTS = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs consent cookie cookies newsletter popup promo promotion "
    "related share sharing sidebar signup social sponsor sponsored sponsors subscribe".split()
)
LAYOUT = frozenset("banner disclaimer footer header masthead menu nav navbar navigation notice toolbar widget widgets".split())
COMMENTS = frozenset("comment comments replies".split())
STATES = frozenset("has is no not with without".split())
#: Words that add nothing to an advert's or comment's name before them, and what related things are called.
HOLDERS = frozenset("area bar body box block buttons container content form icons inner item list section slot thread unit wrapper".split())
RELATED = frozenset("articles items links list pages posts stories".split())
_NAMES = re.compile(r"(?i)\b(?:class|id|role)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_PIECES = re.compile(r"[_-]+")


def named(names: str, inside: bool) -> str:
    """What the classes and ids of an element call it: ``comments``, ``named`` (like furniture), or nothing."""
    found = ""
    for token in names.lower().split():
        pieces = [piece for piece in _PIECES.split(token) if piece]
        if not pieces or pieces[0] in STATES:
            continue
        last = pieces[-1]
        if len(pieces) > 1 and (last in HOLDERS or pieces[0] in ADVERTS and last in (RELATED if pieces[0] == "related" else LAYOUT)):
            last = pieces[0]
        if last in COMMENTS:
            return "comments"
        if last in ADVERTS or last in LAYOUT and not inside:
            found = "named"
    return found


@dataclass
class Block:
    text: str
    words: int
    linked: int
    furniture: bool
    content: bool
    named: bool = False

    @property
    def density(self) -> float:
        return self.linked / self.words


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Where the tag ends whose name ends at ``at``; -1 if it never does. last: where each quote stands last."""
    while m := _STOP.search(page, at):
        at = m.end()
        if m[0] == ">":
            return at
        at = _SPACE.match(page, at).end()
        quote = page[at : at + 1]
        if quote in last:
            at = page.index(quote, at + 1) + 1 if at < last[quote] else at + 1
    return -1


class _Frames:
    """Open elements, and the stretches of blocks that the closed ones have marked."""

    def __init__(self):
        self.open: list[list] = []  # name, mark, first block, content inside
        self.count: dict[str, int] = {}  # open elements by name
        self.marks: dict[str, int] = {}  # and by mark
        self.stretches: list[tuple[str, int, int, bool]] = []

    def push(self, name: str, mark: str, at: int) -> None:
        self.open.append([name, mark, at, False])
        self.count[name] = self.count.get(name, 0) + 1
        self.marks[mark] = self.marks.get(mark, 0) + 1

    def pop(self, at: int) -> str:
        name, mark, first, content = frame = self.open.pop()
        self.count[name] -= 1
        self.end(frame, at)
        if self.open and (content or mark == "content"):
            self.open[-1][3] = True
        return name

    def end(self, frame: list, at: int) -> None:
        """The frame marks nothing beyond this block."""
        _, mark, first, content = frame
        self.marks[mark] -= 1
        if mark and first < at:
            self.stretches.append((mark, first, at, content))
        frame[1] = ""
        self.marks[""] = self.marks.get("", 0) + 1


def blocks(page: str) -> list[Block]:
    """Flat text blocks in page order; white space inside is one space, none is empty."""
    found: list[Block] = []
    frames = _Frames()
    parts: list[str] = []
    linked = links = 0
    silent = ""
    last = {quote: page.rfind(quote) for quote in "\"'"}

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            found.append(Block(text, len(text.split(" ")), linked, False, False))
        parts.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text and not silent:
            parts.append(text)
            if links:
                linked += len(_WORD.findall(text))

    done = 0
    while opened := _OPEN.search(page, done):
        at = opened.start()
        say(page[done:at])
        m = _NAME.match(page, at + 1)
        if not m:
            if page.startswith("<!--", at):
                done = page.find("-->", at + 4) + 3
            elif page.startswith("<![CDATA[", at):
                done = at + 9
                continue
            else:  # a declaration, or an end tag without a name
                done = page.find(">", at) + 1
            if done <= at:
                done = len(page)
            continue
        done = _tag_end(page, m.end(), last)
        if done < 0:
            done = len(page)
            break
        end, name, inner = page[at + 1] == "/", m[1].lower(), page[m.end() : done - 1]
        if silent:
            if name == silent and end:
                silent = ""
            elif name == "body" and silent == "head":
                silent = ""
            else:
                continue
        if name in SILENT and not end and not inner.endswith("/"):
            silent = name
            if name in ("script", "style"):  # raw text: only its own end tag counts
                stop = re.compile(f"</{name}", re.I).search(page, done)
                done = stop.start() if stop else len(page)
            continue
        if name == "a":
            links = max(0, links - 1) if end else 1
        if name == "br":
            say(" ")
        if name in INLINE or name in SILENT:
            continue
        close()
        if name not in CONTAINERS:
            continue
        if end:
            if frames.count.get(name):
                while frames.pop(len(found)) != name:
                    pass
                links = 0
        elif not inner.endswith("/"):
            names = " ".join(filter(None, (g for n in _NAMES.finditer(inner) for g in n.groups())))
            inside = frames.marks.get("content", 0) > 0
            if name in ("article", "main"):
                if not frames.marks.get("comments") and not frames.marks.get("furniture"):
                    for frame in frames.open:  # furniture named, or left open, before the article
                        if frame[1] == "named":
                            frames.end(frame, len(found))
                called = named(names, inside)
                frames.push(name, called if called == "comments" and inside else "content", len(found))
            elif name == "form" or name == "header" and not inside:
                frames.push(name, "wrapping", len(found))
            elif name in FURNITURE:
                frames.push(name, "furniture", len(found))
            else:
                frames.push(name, "" if name in ("body", "html") else named(names, inside), len(found))
    if not silent:
        say(page[done:])
    close()
    while frames.open:
        frames.pop(len(found))
    _mark(found, frames.stretches)
    return found


def _mark(found: list[Block], stretches: list[tuple[str, int, int, bool]]) -> None:
    """Sets the marks of the blocks from the stretches of the elements that hold them."""
    plain = [0]
    for block in found:
        plain.append(plain[-1] + max(0, block.words - block.linked))
    article = any(mark == "content" for mark, *_ in stretches)
    depth = {mark: [0] * (len(found) + 1) for mark in ("furniture", "content", "named")}
    for mark, first, end, holds_article in stretches:
        if mark in ("named", "wrapping") and 2 * (plain[end] - plain[first]) > plain[-1] and (holds_article or not article):
            continue
        row = depth["furniture" if mark in ("wrapping", "comments") else mark]
        row[first] += 1
        row[end] -= 1
    for mark, row in depth.items():
        open_ = 0
        for block, change in zip(found, row):
            open_ += change
            setattr(block, mark, open_ > 0)


# Small labelled table: words, link density, words and density of the block before and after, furniture, content; label.
_UNNAMED = (
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0), (1, 1.0, 1, 1.0, 8, 0.0, 1, 0, 0),
    (3, 1.0, 2, 1.0, 2, 1.0, 1, 0, 0), (2, 1.0, 3, 1.0, 1, 1.0, 0, 0, 0), (4, 0.8, 3, 1.0, 5, 1.0, 0, 0, 0),
    (8, 0.0, 1, 1.0, 11, 0.0, 1, 0, 0), (12, 0.0, 60, 0.0, 0, 0.0, 1, 0, 0), (30, 0.1, 40, 0.0, 12, 0.0, 1, 0, 0),
    (45, 0.0, 80, 0.0, 50, 0.0, 1, 1, 0), (25, 0.0, 90, 0.0, 5, 0.0, 1, 1, 0), (6, 0.0, 70, 0.0, 20, 0.0, 1, 1, 0),
    (15, 0.2, 1, 1.0, 30, 0.0, 1, 0, 0), (60, 0.0, 8, 0.0, 3, 0.0, 1, 0, 0), (5, 0.0, 2, 0.0, 1, 1.0, 1, 0, 0),
    (4, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0), (3, 0.0, 2, 1.0, 0, 0.0, 0, 0, 0), (7, 0.6, 60, 0.0, 4, 0.9, 0, 0, 0),
    (10, 0.9, 30, 0.0, 50, 0.0, 0, 0, 0), (5, 0.0, 4, 0.0, 6, 0.0, 0, 0, 1), (2, 0.0, 0, 0.0, 3, 0.5, 0, 0, 0),
    (11, 0.0, 8, 0.0, 70, 0.0, 0, 1, 1), (9, 0.0, 1, 1.0, 45, 0.0, 0, 1, 1), (70, 0.0, 11, 0.0, 120, 0.0, 0, 1, 1),
    (120, 0.05, 70, 0.0, 1, 0.0, 0, 1, 1), (1, 0.0, 120, 0.0, 8, 0.0, 0, 1, 1), (2, 0.0, 1, 0.0, 12, 0.0, 0, 1, 1),
    (8, 0.0, 2, 0.0, 60, 0.0, 0, 1, 1), (3, 0.0, 9, 0.0, 12, 0.1, 0, 1, 1), (20, 0.5, 60, 0.0, 80, 0.0, 0, 1, 1),
    (6, 1.0, 40, 0.0, 90, 0.0, 0, 1, 1), (4, 0.0, 0, 0.0, 0, 0.0, 0, 1, 1), (15, 0.3, 5, 0.0, 12, 0.0, 0, 1, 1),
    (40, 0.0, 3, 0.0, 60, 0.0, 0, 0, 1), (90, 0.1, 40, 0.0, 2, 0.0, 0, 0, 1), (60, 0.0, 90, 0.0, 12, 0.0, 0, 0, 1),
    (14, 0.0, 60, 0.0, 50, 0.0, 0, 0, 1), (25, 0.0, 1, 1.0, 30, 0.0, 0, 0, 1), (35, 0.2, 20, 0.0, 6, 0.0, 0, 0, 1),
    # content before, between and after link-dense blocks
    (80, 0.0, 60, 0.0, 1, 1.0, 0, 1, 1), (4, 0.0, 70, 0.0, 1, 1.0, 0, 1, 1), (12, 0.0, 1, 1.0, 2, 1.0, 0, 1, 1),
    (40, 0.1, 50, 0.0, 6, 0.8, 0, 1, 1), (3, 0.0, 0, 0.0, 5, 0.9, 0, 1, 1), (30, 0.0, 4, 1.0, 3, 0.5, 0, 1, 1),
    (3, 1.0, 40, 0.0, 2, 1.0, 0, 1, 1), (2, 1.0, 3, 1.0, 2, 1.0, 0, 1, 1), (7, 0.6, 1, 1.0, 0, 0.0, 0, 1, 1),
    (3, 0.0, 1, 1.0, 2, 1.0, 0, 1, 1), (4, 0.0, 2, 1.0, 1, 1.0, 0, 1, 1), (2, 0.0, 3, 1.0, 0, 0.0, 0, 1, 1),
    # pages without article or main: headings, list items and paragraphs, short and long, also beside links
    (6, 0.0, 1, 1.0, 60, 0.0, 0, 0, 1), (2, 0.0, 1, 1.0, 8, 0.0, 0, 0, 1), (3, 0.0, 0, 0.0, 50, 0.0, 0, 0, 1),
    (1, 0.0, 0, 0.0, 4, 0.0, 0, 0, 1), (4, 0.0, 50, 0.0, 30, 0.0, 0, 0, 1), (1, 0.0, 3, 0.0, 2, 0.0, 0, 0, 1),
    (2, 0.0, 1, 0.0, 3, 0.0, 0, 0, 1), (9, 0.0, 40, 0.0, 0, 0.0, 0, 0, 1), (12, 0.1, 12, 0.0, 12, 0.0, 0, 0, 1),
    (3, 0.0, 40, 0.0, 1, 1.0, 0, 0, 1), (2, 0.0, 6, 0.0, 3, 1.0, 0, 0, 1), (60, 0.0, 40, 0.0, 1, 1.0, 0, 0, 1),
    (14, 0.0, 1, 1.0, 1, 1.0, 0, 0, 1), (45, 0.0, 2, 1.0, 3, 1.0, 0, 0, 1), (20, 0.0, 1, 1.0, 0, 0.0, 0, 0, 1),
    (1, 0.0, 1, 1.0, 2, 0.0, 0, 0, 1), (3, 0.0, 2, 1.0, 1, 0.0, 0, 0, 1), (4, 0.0, 1, 1.0, 5, 0.1, 0, 0, 1),
    (1, 0.0, 1, 0.0, 1, 0.0, 0, 0, 1), (2, 0.0, 2, 0.0, 2, 0.0, 0, 0, 1), (3, 0.0, 1, 0.0, 2, 0.0, 0, 0, 1),
    (1, 0.0, 2, 0.0, 3, 0.0, 0, 0, 1), (2, 0.0, 1, 0.0, 0, 0.0, 0, 0, 1), (1, 0.0, 2, 0.0, 1, 1.0, 0, 0, 1),
    (16, 0.0, 0, 0.0, 2, 1.0, 0, 0, 1), (30, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1), (5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1),
    # and what is none of these there: link lists, and a word or two among them
    (1, 1.0, 5, 0.0, 1, 1.0, 0, 0, 0), (2, 1.0, 60, 0.0, 0, 0.0, 0, 0, 0), (1, 1.0, 0, 0.0, 40, 0.0, 0, 0, 0),
    (15, 0.9, 20, 0.9, 18, 1.0, 0, 0, 0), (30, 0.7, 40, 0.0, 60, 0.0, 0, 0, 0), (1, 0.0, 1, 1.0, 1, 1.0, 0, 0, 0),
)
# The same with whether an element's name marks it, before the label: adverts, notices and sharing, and long text.
_NAMED = (
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 1, 0), (3, 0.0, 0, 0.0, 40, 0.0, 0, 0, 1, 0), (8, 0.0, 1, 1.0, 11, 0.0, 0, 0, 1, 0),
    (12, 0.0, 60, 0.0, 0, 0.0, 0, 0, 1, 0), (20, 0.1, 2, 1.0, 8, 0.0, 0, 0, 1, 0), (30, 0.0, 40, 0.0, 12, 0.0, 0, 0, 1, 0),
    (45, 0.0, 1, 1.0, 60, 0.0, 0, 0, 1, 0), (70, 0.0, 1, 1.0, 3, 0.0, 0, 0, 1, 0), (2, 0.0, 60, 0.0, 70, 0.0, 0, 1, 1, 0),
    (2, 0.0, 70, 0.0, 2, 0.0, 0, 1, 1, 0), (3, 0.0, 20, 0.0, 0, 0.0, 0, 1, 1, 0), (2, 0.0, 1, 0.0, 2, 0.0, 0, 1, 1, 0), (4, 0.0, 3, 0.0, 1, 1.0, 0, 1, 1, 0),
    (9, 0.0, 80, 0.0, 50, 0.0, 0, 1, 1, 0), (25, 0.0, 90, 0.0, 5, 0.0, 0, 1, 1, 0), (45, 0.0, 30, 0.0, 80, 0.0, 0, 1, 1, 0),
    (60, 0.0, 70, 0.0, 20, 0.0, 0, 1, 1, 0), (15, 0.5, 60, 0.0, 60, 0.0, 0, 1, 1, 0), (6, 1.0, 70, 0.0, 70, 0.0, 0, 1, 1, 0),
    (160, 0.9, 20, 0.0, 30, 0.0, 0, 0, 1, 0), (110, 0.0, 9, 0.0, 90, 0.0, 0, 0, 1, 1), (150, 0.05, 1, 1.0, 120, 0.0, 0, 0, 1, 1),
    (220, 0.0, 80, 0.0, 0, 0.0, 0, 0, 1, 1), (130, 0.0, 90, 0.0, 70, 0.0, 0, 1, 1, 1), (180, 0.0, 60, 0.0, 100, 0.0, 0, 1, 1, 1),
)
LABELLED = (*((*row[:-1], 0, row[-1]) for row in _UNNAMED), *_NAMED)


def grow(rows, depth: int = 6):
    """Decision tree by Gini impurity: a label, or (feature, threshold, tree below or equal, tree above)."""
    labels = [r[-1] for r in rows]
    share = sum(labels) / len(labels)
    if depth == 0 or share in (0, 1):
        return int(share >= 0.5)
    best = None
    for k in range(len(rows[0]) - 1):
        values = sorted({r[k] for r in rows})
        for low, high in zip(values, values[1:]):
            cut = (low + high) / 2
            sides = [[r[-1] for r in rows if (r[k] > cut) == above] for above in (False, True)]
            impurity = sum(2 * sum(s) * (len(s) - sum(s)) / len(s) for s in sides)
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, k, cut
    if best is None:
        return int(share >= 0.5)
    _, k, cut = best
    return k, cut, *(grow([r for r in rows if (r[k] > cut) == above], depth - 1) for above in (False, True))


def decide(tree, features) -> int:
    while not isinstance(tree, int):
        tree = tree[3] if features[tree[0]] > tree[1] else tree[2]
    return tree


def main_text(page: str, tree) -> str:
    found = blocks(page)
    kept = []
    for k, b in enumerate(found):
        beside = [(x.words, x.density) if x else (0, 0.0) for x in (found[k - 1] if k else None, found[k + 1] if k + 1 < len(found) else None)]
        if decide(tree, (b.words, b.density, *beside[0], *beside[1], int(b.furniture), int(b.content), int(b.named))):
            kept.append(b.text)
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    tree = grow(LABELLED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page or "", tree) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64(), size=len(texts))],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
