"""Main text of web pages from parser events and smoothed text-to-tag ratios.

The standard library's parser streams events. Each block of text becomes a line with its characters
and its tags; the ratios of lines are smoothed with a Gaussian, and a threshold (their standard
deviation, at most their mean) clusters them into content and the rest.

- Subtrees that are never main text by their element or role (menus, forms, scripts, ...) give no
  lines. Class names and ids that say so clearly (adverts, comments, ...) take a subtree out unless an
  article lies in it. Names that also have other uses (share, header, notice, ...) only raise a
  doubt: the clustering decides whether the subtree's text is content, and a heading of the article
  always stays.
- The content lines choose the region: the articles they lie in, or else the smallest element that
  holds them all and every heading (never a heading, list, paragraph or the like itself).
- All lines of an article are kept. Without one, runs of lines that are links only go where the
  clustering calls most of them no content, and so does a closing line of copyright with its year.

Defined results: a missing or empty page has the empty text; broken nesting is repaired the way
browsers do for paragraphs and list items; character references are decoded; every run of white
space is one space; repeated rows and rows with null columns are rows like others, an empty table
gives an empty one, and all other columns stay as they are, but for one that is named like the
result and is replaced by it. A page takes time in proportion to its length, however deep it nests.
Pages are handled one by one, whole, within their rows' tasks: no shuffle.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element and class names of the web.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp "
    "rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_NEVER = frozenset(
    "script style head title nav footer aside form noscript iframe svg button select textarea "
    "template dialog menu object canvas audio video option datalist".split())
_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar "
                   "alertdialog form note".split())
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo "
    "sidebar sidebars menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie "
    "cookies consent popup modal overlay newsletter subscribe subscription comment comments "
    "commentlist disqus reply replies widget widgets toolbar pagination pager skip login "
    "signup".split())
_DOUBTFUL = frozenset(
    "banner header notice notices notification alert promotion share sharing social related "
    "recommended search copyright legal".split())
_LINK_LINES = 3  # so many lines of links in a row are a menu
_RIGHTS = re.compile(r"(?:©|\(c\)|copyright)[\s©(c)]*(?:19|20)\d\d", re.I)
_CLOSES = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
           "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]),
           "th": frozenset(["td", "th"]), "option": frozenset(["option"])}
_SCOPES = frozenset("ul ol dl table article section main div body".split())

_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are parts of a text, so never all of it.
_PARTS = _INLINE | _HEADINGS | frozenset(
    "p pre ul ol li dl dt dd blockquote figure figcaption address details summary caption hgroup "
    "header".split())

#: Width of the smoothing in lines.
SIGMA = 1.0


class _Lines(HTMLParser):
    """Collects lines (text, tags, innermost element, linked characters) and, by the number of an
    element, its name, parent, last descendant, outermost article and outermost main."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # name, number, never main text
        self.count: dict[str, int] = {}
        self.names, self.parents, self.last = ["page"], [0], [0]
        self.article, self.main = [0], [0]
        self.named: dict[int, bool] = {}  # elements with a telling name: clearly so?
        self.doubted: list[int] = []  # the open ones of them
        self.never = self.tags = self.linked = 0
        self.text: list[str] = []
        self.lines: list[tuple[str, int, int, int]] = []

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            at = self.open[-1][1] if self.open else 0
            self.lines.append((text, self.tags, at, self.linked))
        self.text, self.tags, self.linked = [], 0, 0

    def leave(self, at: int) -> None:
        for tag, number, never in self.open[at:]:
            self.never -= never
            self.count[tag] -= 1
            self.last[number] = len(self.names) - 1
        del self.open[at:]
        while self.doubted and (not self.open or self.doubted[-1] > self.open[-1][1]):
            self.doubted.pop()

    def unwanted(self, tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> bool:
        """Whether an element is never main text; notes those with a telling name."""
        if tag in _NEVER:
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        if tag == "header":
            return not inside
        for key, value in attrs:
            if key == "hidden" or key == "role" and (value or "").lower() in _ROLES:
                return True
            if key in ("class", "id") and value:
                words = "".join(c if c.isalnum() else " " for c in value.lower()).split()
                if not _NAMES.isdisjoint(words):
                    self.named[len(self.names)] = True
                elif not _DOUBTFUL.isdisjoint(words):
                    self.named.setdefault(len(self.names), False)
        return False

    def enter(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        number, parent = len(self.names), self.open[-1][1] if self.open else 0
        article, main = self.article[parent], self.main[parent]
        never = self.unwanted(tag, attrs, bool(article or main))
        if tag in ("article", "main"):  # what holds the article is no menu, whatever its name
            for n in self.doubted:
                self.named.pop(n, None)
            self.doubted.clear()
        if tag in _HEADINGS and (article or main):
            self.doubted = [n for n in self.doubted if self.named.get(n, True) or
                            self.named.pop(n, None)]
        if number in self.named:
            self.doubted.append(number)
        self.open.append((tag, number, never))
        self.count[tag] = self.count.get(tag, 0) + 1
        self.names.append(tag)
        self.parents.append(parent)
        self.last.append(number)
        self.article.append(article or number * (tag == "article"))
        self.main.append(main or number * (tag == "main"))
        self.never += never

    def handle_starttag(self, tag, attrs):
        if tag not in _INLINE:
            self.flush()
            if tag == "p" or tag not in _VOID:
                for i in range(len(self.open) - 1, -1, -1):  # an open paragraph ends here
                    if self.open[i][0] == "p":
                        self.leave(i)
                        break
                    if self.open[i][0] in _SCOPES:
                        break
            closes = _CLOSES.get(tag, ())
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in closes:
                    self.leave(i)
                elif self.open[i][0] in _SCOPES:
                    break
        elif tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag not in _VOID:
            self.enter(tag, attrs)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag in ("svg", "path", "use"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in _INLINE:
            self.flush()
        self.tags += 1
        if not self.count.get(tag):
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.leave(i)
                break
            if tag in _INLINE and self.open[i][0] not in _INLINE:
                break

    def handle_data(self, data):
        if not self.never:
            self.text.append(data)
            if self.count.get("a"):
                self.linked += len("".join(data.split()))


def smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing with a kernel that ends at three deviations and at the borders."""
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-k * k / (2 * sigma * sigma)) for k in range(reach + 1)]
    out = []
    for i in range(len(values)):
        near = range(max(0, i - reach), min(len(values), i + reach + 1))
        out.append(sum(values[j] * kernel[abs(i - j)] for j in near)
                   / sum(kernel[abs(i - j)] for j in near))
    return out


def content_lines(ratios: list[float], sigma: float = SIGMA, alone: bool = False) -> list[bool]:
    """Lines whose smoothed ratio reaches the threshold; never none of them. With ``alone`` their
    own ratio must reach it too, without the help of the lines around."""
    level = smoothed(ratios, sigma)
    mean = sum(level) / len(level)
    spread = math.sqrt(sum((x - mean) ** 2 for x in level) / len(level))
    threshold = min(mean, spread, max(level)) if spread else min(mean, max(level))
    return [x >= threshold and (not alone or r >= threshold) for x, r in zip(level, ratios)]


def _clustered(lines: list[tuple[str, int, int, int]], alone: bool = False) -> list[bool]:
    ratios = [len(text) / max(1, tags) for text, tags, _, _ in lines]
    return content_lines(ratios, alone=alone) if lines else []


def _without_named(parser: _Lines) -> list[tuple[str, int, int, int]]:
    """Lines outside of elements that are named as something else than main text."""
    def outside(out: set[int]) -> list[tuple[str, int, int, int]]:
        gone = [False] * len(parser.names)
        for n in range(1, len(gone)):  # parents come before their children
            gone[n] = gone[parser.parents[n]] or n in out
        return [line for line in parser.lines if not gone[line[2]]]

    out = {n for n, clearly in parser.named.items() if clearly}
    doubtful = [n for n, clearly in parser.named.items() if not clearly]
    if doubtful:
        lines = outside(out)
        placed = sorted(zip((n for _, _, n, _ in lines), (len(text) for text, *_ in lines),
                            _clustered(lines, alone=True)))
        at = [n for n, _, _ in placed]
        sizes = [0, *accumulate(size for _, size, _ in placed)]
        content = [0, *accumulate(size * is_content for _, size, is_content in placed)]
        for n in doubtful:
            first, behind = bisect_left(at, n), bisect_right(at, parser.last[n])
            if 2 * (content[behind] - content[first]) <= sizes[behind] - sizes[first]:
                out.add(n)
    return outside(out)


def _without_menus(lines: list[tuple[str, int, int, int]], chosen: list[bool]) -> list[str]:
    """Texts of lines but those of menus and rights that no name gives away."""
    kept, i = [], 0
    links = [linked > 0 and linked >= len("".join(text.split())) for text, _, _, linked in lines]
    while i < len(lines):
        run = i
        while run < len(lines) and links[run]:
            run += 1
        if run - i >= _LINK_LINES and 2 * sum(chosen[i:run]) < run - i:
            i = run
            continue
        run = max(run, i + 1)
        kept += range(i, run)
        i = run
    while kept and _RIGHTS.match(lines[kept[-1]][0]):
        kept.pop()
    return [lines[k][0] for k in kept]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    parser.leave(0)
    lines = _without_named(parser)
    if not lines:
        return ""
    chosen = _clustered(lines)
    regions = {parser.article[n] or parser.main[n] for (_, _, n, _), content in zip(lines, chosen)
               if content} - {0}
    if regions:
        return " ".join(text for text, _, n, _ in lines
                        if parser.article[n] in regions or parser.main[n] in regions)
    heading = [False] * len(parser.names)
    for n in range(1, len(heading)):
        heading[n] = heading[parser.parents[n]] or parser.names[n] in _HEADINGS
    held = [n for (_, _, n, _), content in zip(lines, chosen) if content or heading[n]]
    region, most = min(held), max(held)
    while region and (parser.last[region] < most or parser.names[region] in _PARTS):
        region = parser.parents[region]
    kept = [(line, content) for line, content in zip(lines, chosen)
            if not region or region <= line[2] <= parser.last[region]]
    return " ".join(_without_menus(*map(list, zip(*kept))))


def extract(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """The columns of ``pages`` without ``html``, and the main text in ``into``."""
    rest = [c for c in pages.columns if c not in (html, into)]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = pa.array([main_text(x.as_py()) for x in part.column(len(rest))], pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], texts], [*rest, into])

    kinds = "".join(f"`{c}` {t}, " for c, t in pages.select(*rest).dtypes)
    return pages.select(*rest, F.col(html)).mapInArrow(batches, f"{kinds}`{into}` string")
