"""HTML extraction: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The standard library's parser streams events into lines, one for each block of text, with the tags
met in it. Ratios of text to tags are smoothed over neighbouring lines and split into two clusters;
the dense lines mark the content region, the smallest container that holds nearly all of their
text. All lines of that region which don't belong to page furniture are its text. Around it, lists
of links go as furniture too; headings, sibling sections and all other lines stay.

Furniture is told by element names, roles, ``hidden`` and words of class and id. Words that also name
parts of articles or whole layouts ("header", "related", "with-sidebar") are checked: what holds an
article isn't furniture, nor is a dense or titling part of the region.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import map_text

#: Element names.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset("article body div main section td blockquote".split())
FURNITURE = frozenset("head title nav header footer aside form menu dialog".split())
#: Elements inside a line whose content isn't text of it.
MUTE = frozenset("script style noscript template button select textarea iframe object svg canvas audio video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end unclosed when another of theirs, or a block around them, begins or ends.
LOOSE = frozenset("p li dd dt td th tr option".split())
#: Elements of a page's head; any other element ends an unclosed head.
HEAD = frozenset("head title script style noscript template meta link base html".split())
REGIONS = frozenset("article main".split())
#: Words of class and id that mark page furniture wherever they stand.
_CERTAIN = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|breadcrumbs?|byline-share|comments?|consent|cookies?|disqus|gdpr|modal|newsletter|"
    r"notices?|pagination|popup|promo\w*|replies|respond|skip|sponsor\w*|subscribe)(?:$|[\s_-])"
).search
#: Words that mark furniture, but also layouts around an article.
_LAYOUT = re.compile(r"(?:^|[\s_-])(?:footer|masthead|menu|nav\w*|sidebar)(?:$|[\s_-])").search
#: Words that mark furniture, but also parts of an article.
_PART = re.compile(r"(?:^|[\s_-])(?:banner|header|recommend\w*|related|share|sharing|social|toolbar|widget)(?:$|[\s_-])").search
#: Names of an article's own parts, in which those words mark nothing.
_OWN = re.compile(r"(?:post|article|entry|story|section|content|chapter)[_-]+header|related[_-]+works?(?![a-z])").sub
_ROLES = frozenset("alert banner complementary contentinfo dialog menu navigation search".split())
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden").search
#: Standard deviation, in lines, of the smoothing; and the share of dense text that a region holds.
SIGMA, REACH, SHARE = 1.0, 2, 0.9
_KERNEL = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(-REACH, REACH + 1)]

#: What an element is marked as: nothing, a layout or a part of an article perhaps, furniture.
PLAIN, LAYOUT, PART, OUT = range(4)


class Line(NamedTuple):
    text: str
    tags: int
    node: int
    kind: str  # heading, prose, or links when all its text is linked


def mark_of(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    mark = OUT if tag in FURNITURE else PLAIN
    for name, value in attrs:
        if name == "hidden":
            return OUT
        if not value or tag in ("html", "body"):
            continue
        value = value.lower()
        if name == "style" and _UNSEEN(value) or name == "role" and value in _ROLES and tag not in REGIONS:
            return OUT
        if name in ("class", "id") and tag not in REGIONS:
            value = _OWN("", value)
            mark = max(mark, OUT if _CERTAIN(value) else LAYOUT if _LAYOUT(value) else PART if _PART(value) else PLAIN)
    return mark


class _Lines(HTMLParser):
    """Collects the page's lines, and its elements as a tree of nodes in page order, a parent before its children."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = 0
        self.plain = False  # whether the line has text outside links
        self.link: int | None = None  # depth at which a link began
        self.muted = 0  # depth from which text doesn't count, or 0
        # by node: parent, element, mark
        self.parent, self.names, self.marks = [-1], [""], [PLAIN]
        self.open: list[tuple[str, int]] = [("", 0)]  # open elements that matter here, with their nodes
        self.count: Counter[str] = Counter()  # how many of a name are open

    # declarations end at the next ">", also those that the parser would raise on or put out as text

    def parse_html_declaration(self, i):
        raw = self.rawdata
        if raw.startswith("<!--", i):
            return self.parse_comment(i)
        end = raw.find(">", i)
        inner = raw.find("[", i, end) if end >= 0 else -1
        if inner >= 0 and (close := re.compile(r"\]\s*>|\]\]>").search(raw, inner)):
            return close.end()
        return len(raw) if end < 0 else end + 1

    def parse_comment(self, i, report=1):
        raw = self.rawdata
        if raw.startswith(("<!-->", "<!--->"), i):
            return raw.index(">", i) + 1
        close = re.compile(r"--!?>").search(raw, i + 4)
        return close.end() if close else len(raw)

    def parse_pi(self, i):
        end = self.rawdata.find(">", i)
        return len(self.rawdata) if end < 0 else end + 1

    def parse_starttag(self, i):
        """A tag that never ends takes the rest of the page with it."""
        return super().parse_starttag(i) if self.rawdata.find(">", i) >= 0 else len(self.rawdata)

    def parse_endtag(self, i):
        return super().parse_endtag(i) if self.rawdata.find(">", i) >= 0 else len(self.rawdata)

    def end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                name, node = next(x for x in reversed(self.open) if x[0] not in MUTE)
                self.lines.append(Line(text, self.tags, node, "heading" if name in HEADINGS else "prose" if self.plain else "links"))
                self.tags = 0
            self.parts = []
            self.plain = False

    def push(self, tag: str, mark: int) -> None:
        self.parent.append(self.open[-1][1])
        self.open.append((tag, len(self.names)))
        self.names.append(tag)
        self.marks.append(mark)
        self.count[tag] += 1

    def shut(self, depth: int) -> None:
        for tag, _ in self.open[depth:]:
            self.count[tag] -= 1
        del self.open[depth:]
        if self.link is not None and self.link > depth:
            self.link = None
        if self.muted >= depth:
            self.muted = 0

    def handle_starttag(self, tag, attrs):
        if tag not in HEAD and self.count["head"]:
            self.shut(next(k for k, (name, _) in enumerate(self.open) if name == "head"))
        block = tag in BLOCKS
        if block:
            self.end_line()
            last = len(self.open) - 1
            while last and self.open[last][0] not in BLOCKS:
                last -= 1
            while last and (self.open[last][0] == "p" or self.open[last][0] == tag and tag in LOOSE):
                self.shut(last)
                last -= 1
        self.tags += 1
        if tag == "a":
            self.link = len(self.open)
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        mark = mark_of(tag, attrs) if attrs or tag in FURNITURE else PLAIN
        mute = tag in MUTE or not block and mark > PLAIN
        if block or mute or self.count[tag]:
            self.push(tag, mark)
            if mute and not self.muted:
                self.muted = len(self.open) - 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in MUTE:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.link = None
        if tag in BLOCKS:
            self.end_line()
        if not self.count[tag]:
            return
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.open[depth][0]
            if name == tag:
                self.shut(depth)
                return
            if name not in LOOSE and (tag in LOOSE or tag not in BLOCKS and name in BLOCKS):
                return  # a stray end tag doesn't close what stands around it

    def handle_data(self, data):
        if self.muted:
            return
        self.parts.append(data)
        if self.link is None and not self.plain and not data.isspace():
            self.plain = True


def smoothed(ratios: list[float]) -> list[float]:
    n, out = len(ratios), []
    for i in range(n):
        low, high = max(0, i - REACH), min(n, i + REACH + 1)
        k = _KERNEL[low - i + REACH : high - i + REACH]
        out.append(sum(map(float.__mul__, k, ratios[low:high])) / sum(k))
    return out


def threshold(values: list[float]) -> float:
    """Bound between two clusters of one dimension, by Lloyd's iteration from the extremes."""
    low, high = min(values), max(values)
    bound = (low + high) / 2
    for _ in range(20):
        a = [v for v in values if v < bound]
        b = [v for v in values if v >= bound]
        new = (sum(a) / len(a) + sum(b) / len(b)) / 2 if a and b else bound
        if new == bound:
            break
        bound = new
    return bound


class Page:
    """The tree of a parsed page; sums run over it by node number, so nesting costs nothing."""

    def __init__(self, parser: _Lines) -> None:
        self.lines, self.parent, self.names, marks = parser.lines, parser.parent, parser.names, parser.marks
        n = len(self.names)
        in_region = [False] * n
        self.out = [False] * n
        titles = [False] * n  # in a header of an article, whose headings stay
        for k in range(1, n):
            up, name = self.parent[k], self.names[k]
            in_region[k] = in_region[up] or name in REGIONS
            titles[k] = titles[up] or name == "header" and in_region[up] and not self.out[up]
            self.out[k] = self.out[up] or marks[k] == OUT and not (titles[k] and not titles[up])
        self.gone = [self.out[x.node] or titles[x.node] and x.kind != "heading" for x in self.lines]
        chars = self.sums([0 if gone else len(x.text) for x, gone in zip(self.lines, self.gone, strict=True)])
        holds = [name in REGIONS and not out for name, out in zip(self.names, self.out, strict=True)]
        for k in range(n - 1, 0, -1):
            holds[self.parent[k]] |= holds[k]
        # the outermost node that layout or part words mark, unless it holds an article or, as a layout, most of the text
        self.group = [-1] * n
        for k in range(1, n):
            self.group[k] = self.group[self.parent[k]]
            if self.group[k] < 0 and marks[k] in (LAYOUT, PART) and not holds[k] and not (marks[k] == LAYOUT and 2 * chars[k] > chars[0]):
                self.group[k] = k
        self.is_part = [m == PART for m in marks]

    def sums(self, of_lines: list[int]) -> list[int]:
        """Sums of the lines' values below each node."""
        out = [0] * len(self.names)
        for line, value in zip(self.lines, of_lines, strict=True):
            out[line.node] += value
        for k in range(len(out) - 1, 0, -1):
            out[self.parent[k]] += out[k]
        return out

    def text(self) -> str:
        open_lines = [not gone and self.group[x.node] < 0 for x, gone in zip(self.lines, self.gone, strict=True)]
        if not any(open_lines):
            return ""
        ratios = smoothed([len(x.text) / max(1, x.tags) if is_open else 0.0 for x, is_open in zip(self.lines, open_lines, strict=True)])
        bound = threshold([r for r, is_open in zip(ratios, open_lines, strict=True) if is_open])
        mass = self.sums([len(x.text) if r >= bound and o else 0 for x, r, o in zip(self.lines, ratios, open_lines, strict=True)])
        # of the containers that hold enough, the last is the innermost
        region = [k for k in range(1, len(mass)) if mass[k] and mass[k] >= SHARE * mass[0] and self.names[k] in CONTAINERS]
        chosen = max((k for k in region if self.names[k] in REGIONS), default=max(region, default=0))
        sides = self.sides(chosen)
        parts = self.parts_of_region(chosen, sides, bound)
        prose = {sides[x.node] for x, is_open in zip(self.lines, open_lines, strict=True) if is_open and x.kind == "prose"}
        kept = []
        for x, is_open in zip(self.lines, open_lines, strict=True):
            side = sides[x.node]
            if (is_open or self.group[x.node] in parts) and (side == chosen or x.kind != "links" or side >= 0 and side in prose):
                kept.append(x.text)
        return "\n\n".join(kept)

    def sides(self, chosen: int) -> list[int]:
        """For each node its outermost container that doesn't hold the region; the region itself inside it; -1 if there is none."""
        around, k = set(), self.parent[chosen]
        while k >= 0:
            around.add(k)
            k = self.parent[k]
        out = [-1] * len(self.names)
        if chosen == 0:
            return [0] * len(out)
        for k in range(1, len(out)):
            up = out[self.parent[k]]
            out[k] = up if up >= 0 else k if k == chosen or k not in around and self.names[k] in CONTAINERS else -1
        return out

    def parts_of_region(self, chosen: int, sides: list[int], bound: float) -> set[int]:
        """Groups inside the region that part words mark and that are text of it: headings, or dense prose."""
        tally: dict[int, list[int]] = {}
        for x, gone in zip(self.lines, self.gone, strict=True):
            g = self.group[x.node]
            if g >= 0 and not gone and self.is_part[g] and sides[g] == chosen:
                all_chars, linked, dense, headed = tally.setdefault(g, [0, 0, 0, 0])
                is_dense = x.kind == "prose" and len(x.text) / max(1, x.tags) >= bound
                n = len(x.text)
                tally[g] = [all_chars + n, linked + n * (x.kind == "links"), dense + n * is_dense, headed + n * (x.kind == "heading")]
        return {g for g, (n, linked, dense, headed) in tally.items() if not linked and (headed == n or 2 * (dense + headed) >= n and dense)}


def main_text(html: str | None) -> str:
    """The main text of a page: blocks in page order joined by two line ends; empty for null or empty pages.

    Any string is a page: broken, unclosed and unknown markup isn't put out and doesn't raise. Time and
    memory grow with a page's length, however deep its elements are nested.
    """
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    return Page(parser).text()


def extract_text(df: DataFrame, html_col: str = "html", out_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append the main text of each whole page.

    A null or empty page has an empty text, and an empty table gives no rows. Rows are neither dropped
    nor merged, ids may be null or repeated; a column named like ``out_col`` is replaced.
    """

    def make():
        return lambda pages: [[main_text(p) for p in pages]]

    return map_text(df, html_col, f"`{out_col}` string", make, df.columns if keep is None else keep)


def page_texts(pages: DataFrame) -> DataFrame:
    texts = extract_text(pages.select("page_id", "url", "html"), keep=["page_id", "url"])
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
