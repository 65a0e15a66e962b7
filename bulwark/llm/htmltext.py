"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The standard library's parser streams events. Block tags end a line. A line has its text, the tags inside it, and
the container it stands in; text inside menus, headers, footers, sidebars, notices, adverts, forms, scripts and
reader comments counts for nothing. Text-to-tag ratios are smoothed along the lines between such parts, or along a
whole article, and stretches whose smoothed ratio reaches the page's standard deviation are content regions.
"""

from __future__ import annotations

import math
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The names that HTML gives to these parts, and words that pages use for them in class and id.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template noscript head title iframe object svg canvas select button textarea label legend datalist".split())
CHROME = frozenset("nav header footer aside menu dialog".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark meter q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices popup modal newsletter subscribe signup nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar widget header masthead footer comment comments disqus respond reply replies share sharing social related "
    "recommended login search".split()
)
#: Of these, words for adverts and readers' comments: they mean the same on every tag and however much text they have.
SURE = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored comment comments disqus respond reply replies".split())
#: A name that begins so says how a wrapper is laid out, not what it is.
LAYOUT = frozenset("no has with without".split())
#: Text that no mark on its own element may take away.
TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p".split())
CONTENT = frozenset("article main".split())
#: Sections that reopen content inside a page header of their own.
SECTIONS = frozenset("article main section div form body td".split())

SIGMA = 2.0
#: What a line's ratio counts for in an element that has a marked word as part of a longer name only.
LOWERED = 0.1
#: What a ratio counts for outside the articles and mains that hold most of a page's text.
OUTSIDE = 0.1
#: A line of this ratio is full text; longer ones must not raise the threshold above it.
FULL = 100.0
#: So many lines in a row that are mostly links are a list of links.
LINKS = 3
#: A form that holds more of a page's text than this is the page's own wrapper.
FORM = 2 / 3
FEED = 1 << 16


class Line(NamedTuple):
    text: str
    tags: int
    container: int
    inside: bool  # an article or main
    region: int  # rises at each part that is left out
    links: int
    linked: float  # share of the characters that stand in links
    marks: tuple[int, ...]  # places in Lines.marks


class Mark:
    """A form, or an element with a marked class or id. Whether the mark holds is known at the page's end."""

    def __init__(self, weight: float, sure: bool, inside: bool, share: float = 0.5):
        self.weight, self.sure, self.inside = weight, sure, inside  # weight 0: left out
        self.share = share  # of the page's text; an element that holds more is no mere part of it
        self.holds_content = False
        self.chars = 0


class Lines(HTMLParser):
    """Lines of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, tuple[int, ...]]] = []  # tag, left out from here on, container, marks
        self.lines: list[Line] = []
        self.marks: list[Mark] = []
        self.parts: list[str] = []
        self.tags = 0
        self.containers = 0
        self.regions = 0
        self.links, self.linked = 0, 0
        self.tags_open: Counter[str] = Counter()

    def left_out(self) -> bool:
        return bool(self.open) and self.open[-1][1]

    def inside(self) -> bool:
        return self.tags_open["article"] + self.tags_open["main"] > 0

    def cut(self, i: int) -> None:
        """Close the open elements from place i on."""
        for x in self.open[i:]:
            self.tags_open[x[0]] -= 1
        del self.open[i:]

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, _, container, marks = self.open[-1] if self.open else ("", False, 0, ())
            linked = self.linked / (len(text) - text.count(" "))
            self.lines.append(Line(text, self.tags, container, self.inside(), self.regions, self.links, linked, marks))
        self.parts, self.tags = [], 0
        self.links, self.linked = 0, 0

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE and tag not in HIDDEN:
            self.end_line()
        self.tags += 1
        self.links += tag == "a"
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        # HTML lets these stay open: a new one ends the last.
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
            self.close_open(tag)
        _, out, container, marks = self.open[-1] if self.open else ("", False, 0, ())
        if (tag in SECTIONS or tag in CHROME) and not (tag == "td" and self.inside()):  # data tables are part of their article
            self.containers += 1
            container = self.containers
        if not out and self.is_chrome(tag, attrs):
            out = True
            self.regions += tag not in HIDDEN and tag not in INLINE
        if not out and tag in CONTENT:
            for m in marks:
                self.marks[m].holds_content = True
        mark = None if out else self.mark(tag, attrs)
        if mark is not None and tag in INLINE:  # no line of its own
            out = mark.weight == 0
        elif mark is not None:
            marks = (*marks, len(self.marks))
            self.marks.append(mark)
        self.open.append((tag, out, container, marks))
        self.tags_open[tag] += 1

    def close_open(self, tag: str) -> None:
        """Close an open tag of this kind if nothing but inline tags and paragraphs stands inside it."""
        for i in range(len(self.open) - 1, -1, -1) if self.tags_open[tag] else ():
            if self.open[i][0] == tag:
                self.cut(i)
                return
            if self.open[i][0] not in INLINE and self.open[i][0] != "p":
                return

    def is_chrome(self, tag: str, attrs) -> bool:
        if tag in HIDDEN or tag in CHROME:
            return not (tag == "header" and self.inside())
        if tag in ("html", "body") or tag in CONTENT:
            return False
        for name, value in attrs:
            value = (value or "").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES):
                return True
            if name == "style" and "display:none" in value.replace(" ", ""):
                return True
        return False

    def mark(self, tag: str, attrs) -> Mark | None:
        """A mark leaves out where marked words are a whole class or id, and lowers where they are part of one.

        Headings and paragraphs bear none. An id in an article, or on a section, is an anchor and may name a topic.
        """
        if tag in ("html", "body") or tag in CONTENT or tag in TEXTUAL:
            return None
        inside, weight, sure = self.inside(), 1.0, False
        if tag == "form" or ("role", "form") in attrs:
            return Mark(0.0, False, inside, FORM)
        for name, value in attrs:
            if name not in ("class", "id"):
                continue
            for one in (value or "").lower().split():
                words = one.replace("_", "-").strip("-").split("-")
                if words[0] in LAYOUT or MARKED.isdisjoint(words):
                    continue
                whole = MARKED.issuperset(words)
                if whole and not SURE.isdisjoint(words):
                    weight, sure = 0.0, True
                elif name == "id" and tag == "section":
                    continue
                else:
                    weight = min(weight, 0.0 if whole and not (name == "id" and inside) else LOWERED)
        return Mark(weight, sure, inside) if weight < 1 else None

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE and tag not in HIDDEN:
            self.end_line()
        for i in range(len(self.open) - 1, -1, -1) if self.tags_open[tag] else ():
            if self.open[i][0] == tag:
                self.cut(i)
                return
            if self.open[i][0] in CONTENT and tag not in ("body", "html", *SECTIONS):
                return  # a stray end tag doesn't close the article around it

    def handle_data(self, data):
        if not self.left_out():
            self.parts.append(data)
            if self.links and self.tags_open["a"]:
                self.linked += sum(map(len, data.split()))

    def finish(self) -> None:
        self.close()
        self.end_line()
        for line in self.lines:
            for m in line.marks:
                self.marks[m].chars += len(line.text)

    def weights(self) -> list[float]:
        """What each line's ratio counts for; 0: left out.

        A mark is void if its element holds an article or main, or most of the page's text (a form: two thirds, as pages
        may stand in one whole); the latter doesn't hold for adverts and comments, nor beside an article.
        """
        total = sum(len(x.text) for x in self.lines)
        has_content = any(x.inside for x in self.lines)
        void = [m.holds_content or not m.sure and m.chars > m.share * total and (m.inside or not has_content) for m in self.marks]
        return [min((self.marks[m].weight for m in x.marks if not void[m]), default=1.0) for x in self.lines]


def smoothed(values: list[float], sigma: float) -> list[float]:
    """Gaussian smoothing; the kernel is cut at three sigma and renormalised at both ends."""
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        low, high = max(0, i - reach), min(len(values), i + reach + 1)
        weights = kernel[low - i + reach : high - i + reach]
        out.append(sum(w * v for w, v in zip(weights, values[low:high], strict=True)) / sum(weights))
    return out


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """Blocks of the content regions of one page, joined by empty lines."""
    page = Lines()
    for i in range(0, len(html or ""), FEED):
        page.feed(html[i : i + FEED])
    page.finish()
    lines, weights = page.lines, page.weights()
    inside = sum(len(x.text) for x, w in zip(lines, weights, strict=True) if x.inside and w)
    if 2 * inside >= sum(len(x.text) for x, w in zip(lines, weights, strict=True) if w):
        weights = [w if x.inside else w * OUTSIDE for x, w in zip(lines, weights, strict=True)]
    return "\n\n".join(lines[i].text for i in content(lines, weights, sigma))


def runs(lines: list[Line], weights: list[float]) -> list[list[int]]:
    """Places of lines outside articles that follow each other without a part between them that is left out; lists of links apart."""
    stretches: list[tuple[bool, list[int]]] = []
    before = None
    for i, (line, weight) in enumerate(zip(lines, weights, strict=True)):
        if not weight or line.inside:
            before = None
            continue
        key = (line.region, line.linked > 0.5)
        if key != before:
            stretches.append((line.linked > 0.5, []))
        stretches[-1][1].append(i)
        before = key
    sizes = container_sizes(lines, weights)
    out: list[list[int]] = []
    joins = False  # the last run may go on
    for linked, places in stretches:
        apart = linked and is_list(lines, places, sizes)
        if joins and not apart and lines[out[-1][-1]].region == lines[places[0]].region and all(weights[out[-1][-1] : places[0]]) and not any(
            x.inside for x in lines[out[-1][-1] : places[0]]
        ):
            out[-1] += places
        else:
            out.append(places)
        joins = not apart
    return out


def container_sizes(lines: list[Line], weights: list[float]) -> dict[int, int]:
    sizes: dict[int, int] = {}
    for line, weight in zip(lines, weights, strict=True):
        sizes[line.container] = sizes.get(line.container, 0) + (weight > 0)
    return sizes


def is_list(lines: list[Line], places: list[int], sizes: dict[int, int]) -> bool:
    """Whether neighbouring lines that are mostly links are a list of links: so many, or all of their containers."""
    whole = len(places) >= sum(sizes[c] for c in {lines[i].container for i in places})
    return len(places) >= LINKS or whole and sum(lines[i].links for i in places) > 1


def articles(lines: list[Line], weights: list[float]) -> list[list[int]]:
    """Places of lines in articles and mains, whatever is left out between them; text outside begins another group."""
    out: list[list[int]] = []
    goes_on = False
    for i, (line, weight) in enumerate(zip(lines, weights, strict=True)):
        if weight and line.inside:
            if not goes_on:
                out.append([])
            out[-1].append(i)
        goes_on = line.inside if weight else goes_on
    return out


def content(lines: list[Line], weights: list[float], sigma: float = SIGMA) -> list[int]:
    """Places of the content lines.

    Ratios are smoothed along each run, across its containers, and along each article, across adverts in it. Of a run,
    content are lines that reach the page's standard deviation, those between two such lines, and the others of their
    containers there. Of an article that has such a line all is content, but for links at its two ends that are a list
    or stand in a container of their own.
    """
    groups = [(run, False) for run in runs(lines, weights)] + [(places, True) for places in articles(lines, weights)]
    parts = [(run, whole, smoothed([min(FULL, len(lines[i].text) / (lines[i].tags + 1)) * weights[i] for i in run], sigma)) for run, whole in groups]
    every = [r for *_, ratio in parts for r in ratio]
    if not every:
        return []
    mean = sum(every) / len(every)
    least = math.sqrt(sum((r - mean) ** 2 for r in every) / len(every))
    sizes, kept = container_sizes(lines, weights), []
    for run, whole, ratio in parts:
        high = [k for k, r in enumerate(ratio) if r >= least and not (whole and lines[run[k]].linked > 0.5)]
        if whole and not high and all(r >= least for r in ratio):
            high = list(range(len(run)))  # nothing but links, and the page has nothing better
        if not high:
            continue
        found = {lines[run[k]].container for k in high}
        if not whole:
            kept += [i for k, i in enumerate(run) if high[0] <= k <= high[-1] or lines[i].container in found]
            continue
        kept += run[high[0] : high[-1] + 1]
        for end in (run[: high[0]], run[high[-1] + 1 :]):
            linked: list[int] = []
            for i in [*end, None]:
                if i is not None and lines[i].linked > 0.5:
                    linked.append(i)
                    continue
                if linked and not is_list(lines, linked, sizes) and any(lines[j].container in found for j in linked):
                    kept += linked
                linked = []
                kept += [i] if i is not None else []
    return sorted(kept)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Columns of pages but the html, plus text and n_chars (code points). Nothing is shuffled.

    The smoothed ratio selects the content of every page. Where <article> and <main> hold most of the text, ratios
    outside them count for a tenth. White space is what str.split takes for it.
    Defined cases: null, empty and textless html give ''; unclosed and stray tags are tolerated; html of any length
    is read whole, fed in pieces; input columns text and n_chars are replaced.
    """
    added = ("text", "n_chars")
    position = pages.columns.index(html_col)
    kept = [i for i, c in enumerate(pages.columns) if c.lower() not in added and i != position]
    schema = T.StructType([pages.schema.fields[i] for i in kept] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(position)]
            columns = [b.column(i) for i in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.names)

    return pages.mapInArrow(run, schema)
