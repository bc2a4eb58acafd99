"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped into lines, one for each block of the page. A line weighs as
many characters as it has, none if it stands in an element that never holds main
text (menus, page headers, footers, sidebars, forms, reader comments), is mostly links or
is a notice of rights. Such lines keep their places, so a menu of ten items is ten lines
of nothing between two stretches. Elements that
their class, id or role marks as side matter, notices or adverts weigh
nothing either, unless they hold more than the rest of the page: a word can be wrong.
They stay marked next to an article that ``share`` allows as main text. A block is ``width`` lines in a row; its value is the sum of
their weights. Going down the page, the text begins where the values surge over
the threshold and ends where they dive to nothing; lines between the two points
are a stretch. The threshold is ``surge`` characters, or a quarter of the largest
block where that is less, so a short page isn't lost. Stretches count by their text, ``share`` of the largest, or, with a quarter of
that, by their density: lines at least half as long as those of the largest. Tags that name an article only
refine the borders: a stretch that is mostly inside of them is widened or cut to the
whole of these articles. Any other stretch stays as it is. An article in an element
that is skipped is skipped too, if the element has an end tag of its own.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.llm.common import name


@dataclass(frozen=True)
class Settings:
    width: int = 3
    surge: int = 86
    share: float = 0.2  # a stretch with less of the largest stretch's text isn't main text


# Element names of the markup language by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|iframe|svg|canvas|object|math"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split()
)
NEVER = frozenset("head title nav footer aside form menu dialog select button fieldset option audio video map".split())
CLOSES = {x: frozenset([x]) for x in ("li", "tr", "option")} | {x: frozenset(["dt", "dd"]) for x in ("dt", "dd")} | {x: frozenset(["td", "th"]) for x in ("td", "th")}
# Words in class, id or role that tell what an element is for.
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb "
    "breadcrumbs sidebar aside complementary footer contentinfo masthead cookie cookies consent gdpr notice notices banner alert popup modal "
    "overlay newsletter subscribe subscription signup login search share sharing social related recommended recommendations bio "
    "pagination pager toolbar widget widgets copyright skip hidden".split()
)
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond".split())
TOP = frozenset("html body main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words that say where or what kind of box a marked element is.
PLACES = frozenset(
    "site page main top bottom left right primary secondary global inner outer box bar container wrapper wrap area block section list item items link links slot unit label title panel row column columns holder x "
    "post posts user users reader readers article author entry story blog button buttons policy form forms thread count body content text".split()
)
# Of these, what can mark an article that isn't the page's.
OTHER = frozenset("ad ads advert advertisement sponsored promo related recommended comment comments reply replies teaser".split())
RIGHTS = re.compile(r"(?:\W|\d)*(?:copyright|\(c\)|all rights reserved|powered by)\b.{0,160}|\W*©.{0,160}", re.I | re.S)
NAME = re.compile(r"[a-zA-Z][^\s/<>]*")
REST = re.compile(r"""([^<>"']*+(?:(?:"[^"]*+"|'[^']*+')[^<>"']*+)*+)>""")  # of a tag, quoted parts whole
RAW_END = {x: re.compile(rf"</{x}\b[^>]*>", re.I) for x in RAW.split("|")}
MARK = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
UNSEEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none|visibility\s*:\s*hidden""", re.I)


@dataclass
class Skip:
    """An element that never holds main text, or that is marked by words alone."""

    hard: bool
    closed: bool = False  # by its own end tag


@dataclass
class Line:
    text: str
    weight: int
    article: int  # the outermost article it is in; 0 for none
    mark: Skip | None = None  # the outermost marked element it is in


def _marked(value: str, words: frozenset[str]) -> bool:
    """Whether a token of a class, id or role says nothing else than such words, and where they are."""
    for token in value.lower().split():
        parts = {w for w in re.split(r"[^a-z]+", token) if w}
        if not words.isdisjoint(parts) and parts <= words | PLACES:
            return True
    return False


def _skipped(tag: str, attributes: str, inside: bool) -> Skip | None:
    if tag in TOP:
        return None
    if tag in NEVER or (tag == "header" and not inside):
        return Skip(True)
    if not attributes:
        return None
    if UNSEEN.search(attributes):
        return Skip(True)
    values = [m[1] or m[2] or m[3] or "" for m in MARK.finditer(attributes)]
    if tag == "article":
        return None if OTHER.isdisjoint({w for v in values for w in re.split(r"[^a-z]+", v.lower())}) else Skip(False)
    if tag in HEADINGS:
        return None
    if any(_marked(v, COMMENTS) for v in values):
        return Skip(True)
    words = MARKED if inside else MARKED | {"header"}
    return Skip(False) if any(_marked(v, words) for v in values) else None


class Page:
    """Lines of a page, and the elements open at a place."""

    def __init__(self) -> None:
        self.lines: list[Line] = []
        self.stack: list[tuple[str, Skip | None]] = []
        self.places: dict[str, list[int]] = {}  # where in the stack a tag is open
        self.blocks: list[int] = []  # where elements are open that aren't inline
        self.skips: list[Skip] = []  # open ones
        self.hard = self.links = self.depth = self.articles = 0
        self.outer: dict[int, list[Skip]] = {}  # elements skipped around an article
        self.around = 0  # number of these for the open article, and of the hard ones
        self.hard_around = 0
        self.parts: list[str] = []
        self.linked = 0
        self.unseen = False  # text that is skipped since the last line

    def text(self, raw: str) -> None:
        if raw and self.hard == self.hard_around:
            self.parts.append(raw)
            if self.links:
                self.linked += len(raw)
        elif raw and not raw.isspace():
            self.unseen = True

    def flush(self) -> None:
        if self.parts:
            raw = "".join(self.parts)
            text = " ".join(html.unescape(raw).split())
            if text:
                side = not self.depth and (2 * self.linked > len(raw) or RIGHTS.fullmatch(text))
                mark = self.skips[self.around] if len(self.skips) > self.around else None
                self.lines.append(Line(text, 0 if side else len(text), self.articles if self.depth else 0, mark))
        elif self.unseen:
            self.lines.append(Line("", 0, 0))
        self.parts, self.linked, self.unseen = [], 0, False

    def open(self, tag: str, attributes: str) -> None:
        if tag not in INLINE:
            self.flush()
            if self.stack and (self.stack[-1][0] in CLOSES.get(tag, ())):
                self.pop()
            elif any(t == "p" for t, _ in self.stack[-4:]) and all(t in INLINE or t == "p" for t, _ in self.stack[-1:]):
                while self.stack and (self.stack[-1][0] in INLINE or self.stack[-1][0] == "p"):
                    if self.pop() == "p":
                        break
        if tag in VOID or attributes.endswith("/"):
            return
        skip = _skipped(tag, attributes, self.depth > 0)
        if tag in ("article", "main"):
            if not self.depth and not skip:
                self.articles += 1
                self.outer[self.articles] = list(self.skips)
                self.around, self.hard_around = len(self.skips), self.hard
            self.depth += not skip or self.depth > 0
        if skip:
            self.flush()
            self.skips.append(skip)
            self.hard += skip.hard
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, skip))
        self.links += tag == "a"

    def pop(self) -> str:
        tag, skip = self.stack.pop()
        self.places[tag].pop()
        if tag not in INLINE:
            self.blocks.pop()
        if skip:
            self.flush()
            self.skips.pop()
            self.hard -= skip.hard
        self.links -= tag == "a"
        if tag in ("article", "main") and self.depth:
            self.depth -= 1
            if not self.depth:
                self.around = self.hard_around = 0
        return tag

    def close(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        places = self.places.get(tag)
        if not places or (tag in INLINE and self.blocks and self.blocks[-1] > places[-1]):
            return
        if skip := self.stack[places[-1]][1]:
            skip.closed = True
        i = places[-1]
        while len(self.stack) > i:
            self.pop()


def _tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """Markup of a page in order: (start, end, tag, whether it ends the element, attributes), in one pass.

    The tag is empty for comments and declarations, and "!" for an element whose content isn't text.
    """
    at, n, close = 0, len(page), -1
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = n if end < 0 else end + 3
            yield start, at, "", False, ""
            continue
        if close < start and (close := page.find(">", start)) < 0:  # no tag ends any more, but a comment may begin
            start = page.find("<!--", start)
            if start < 0:
                return
            at = start
            continue
        ends = page.startswith("/", start + 1)
        named = NAME.match(page, start + 1 + ends)
        if named is None:
            if page[start + 1 : start + 2] in ("!", "?", "/"):
                at = close + 1
                yield start, at, "", False, ""
            else:
                at = start + 1
            continue
        rest = REST.match(page, named.end())
        at = rest.end() if rest else close + 1
        tag = named[0].lower()
        if tag in RAW_END and not ends:
            end = RAW_END[tag].search(page, at)
            at = end.end() if end else n
            yield start, at, "!", False, ""
        else:
            yield start, at, tag, ends, page[named.end() : at - 1].strip()


def _read(page: str) -> Page:
    p, at = Page(), 0
    for start, end, tag, ends, attributes in _tags(page):
        p.text(page[at:start])
        at = end
        if tag == "!":
            p.flush()
        elif tag and ends:
            p.close(tag)
        elif tag:
            p.open(tag, attributes)
    p.text(page[at:])
    p.flush()
    return p


def lines_of(page: str, s: Settings = Settings()) -> list[Line]:
    """Lines without those of closed elements that skip an article with them, and of marked ones that are less than the rest."""
    p = _read(page)
    for line in p.lines:
        # an element that never ends doesn't hold the article after it
        around = [x for x in p.outer.get(line.article, ()) if x.closed]
        if any(x.hard for x in around):
            line.text, line.weight = "", 0
        elif around:
            line.mark = around[0]
    held: Counter[int] = Counter()
    for line in p.lines:
        held[id(line.mark) if line.mark else 0] += line.weight
    total, inside = held.total(), sum(x.weight for x in p.lines if x.article and not x.mark)
    for line in p.lines:
        if line.mark:
            own = held[id(line.mark)]
            if 2 * own <= total or (inside and inside >= s.share * own):
                line.text, line.weight = "", 0
    return p.lines


def extract(page: str, s: Settings = Settings()) -> str:
    """The main text of a page, its blocks joined by one space; empty if there is none."""
    lines = lines_of(page, s)
    weight = np.array([x.weight for x in lines], np.int64)
    if not weight.any():
        return ""
    block = np.convolve(weight, np.ones(s.width, np.int64))[s.width - 1 :]  # from a line downwards
    surge = min(s.surge, int(block.max()) // 4)
    stretches: list[tuple[int, int]] = []
    at = 0
    while at < len(lines):
        if block[at] <= surge or weight[at] == 0:
            at += 1
            continue
        end = at
        while end < len(lines) and block[end] > 0:  # the dive: nothing in a whole block
            end += 1
        stretches.append((at, end))
        at = end
    sums = [int(weight[a:b].sum()) for a, b in stretches]
    dense = [n / np.count_nonzero(weight[a:b]) for (a, b), n in zip(stretches, sums, strict=True)]
    most, usual = max(sums), dense[int(np.argmax(sums))]
    kept: set[int] = set()
    articles: set[int] = set()
    for (a, b), n, d in zip(stretches, sums, dense, strict=True):
        if n < s.share * most and (4 * n < s.share * most or 2 * d < usual):
            continue
        inside = sum(int(weight[i]) for i in range(a, b) if lines[i].article)
        if 2 * inside > n:
            articles.update(lines[i].article for i in range(a, b) if lines[i].article)
        else:
            kept.update(range(a, b))
    return " ".join(x.text for i, x in enumerate(lines) if weight[i] > 0 and (i in kept or x.article in articles))


def main_text(
    pages: DataFrame, html_col: str = "html", out: str = "text", keep: list[str] | None = None, settings: Settings = Settings()
) -> DataFrame:
    """The columns ``keep`` (all, if not given) with ``out``, the main text of the whole page.

    A null or empty page, and one without text, gives the empty string. A column
    named like ``out`` is replaced. Rows are worked on by themselves, so repeated
    rows give equal results; an empty table gives an empty result.
    """
    columns = [c for c in (pages.columns if keep is None else keep) if c != out]
    numbered = [name(c).alias(f"c{i}") for i, c in enumerate(columns)]
    kept = pages.select(*numbered, F.coalesce(name(html_col).cast("string"), F.lit("")).alias("page"))
    schema = T.StructType([*kept.schema.fields[:-1], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(t.as_py(), settings) for t in b.column(len(columns))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], [f.name for f in schema.fields])

    return kept.mapInArrow(run, schema).toDF(*columns, out)
