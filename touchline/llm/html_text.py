"""Main text of HTML pages by text-to-tag ratios of lines.

The events of the standard library's parser are cut into lines at block tags, since pages often have no line breaks of
their own. Lines of parts that are never content (navigation, footers, forms, adverts, comments and so on, by tag or
by the words of class, id and role) are left out. Every other line gets the ratio of its text to its tags, links not
counted as text. The ratios are smoothed with a Gaussian, and a threshold between their two clusters tells content
lines; the containers that hold them are the content region, short lines included.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 1.5  # standard deviation of the smoothing, in lines

# The element names of HTML by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "script style template noscript head title iframe object svg math canvas audio video nav footer aside form button "
    "select option textarea dialog menu datalist".split()
)
CONTAINERS = frozenset("article main section div td th body center".split())
# Words of class, id and role that mark parts which aren't content.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies disqus footer header masthead menu menubar modal nav navbar navigation "
    "newsletter notice notices pagination popup promo promotion related search share sharing sidebar social sponsor "
    "sponsored subscribe toolbar widget".split()
)
_WORDS = re.compile(r"[A-Za-z]+")


class _Lines(HTMLParser):
    """Collects (text, text outside links, tags, container, whether inside an article) per line."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int]] = []  # tag, whether it drops its content, container
        self.names: Counter[str] = Counter()
        self.dropping = self.links = self.articles = self.containers = 0
        self.lines: list[tuple[str, int, int, int, bool]] = []
        self.parts: list[str] = []
        self.own = self.tags = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.own, self.tags, self._container(), self.articles > 0))
        self.parts, self.own, self.tags = [], 0, 0

    def _container(self) -> int:
        return self.open[-1][2] if self.open else 0

    def _drops(self, tag: str, attrs) -> bool:
        if tag in DROPPED:
            return True
        if tag == "header":
            return not self.articles
        if tag in ("html", "body", "article", "main") and not self.articles:
            marked = {"comment", "comments"}
        elif tag in INLINE:
            return False
        else:
            marked = MARKS - {"header"} if self.articles else MARKS
        named = " ".join(value for name, value in attrs if name in ("class", "id", "role") and value)
        return any(word.lower() in marked for word in _WORDS.findall(named))

    def _pop(self) -> str:
        tag, drops, _ = self.open.pop()
        self.names[tag] -= 1
        self.dropping -= drops
        self.links -= tag == "a"
        self.articles -= tag in ("article", "main")
        return tag

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self._end_line()
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        if tag in ("article", "main") and self.dropping:
            # A part that was never closed doesn't swallow the article.
            at = next(i for i, (_, drops, _) in enumerate(self.open) if drops)
            inner = any(name in ("article", "main") for name, _, _ in self.open[at:])
            if not inner and not self._drops(tag, attrs):
                while len(self.open) > at:
                    self._pop()
        elif tag not in INLINE and self.open and self.open[-1][0] == "p":
            self._pop()
        drops = self._drops(tag, attrs)
        # Everything in an article is one container.
        container = self._container()
        if tag in CONTAINERS and not self.articles:
            self.containers += 1
            container = self.containers
        self.open.append((tag, drops, container))
        self.names[tag] += 1
        self.dropping += drops
        self.links += tag == "a"
        self.articles += tag in ("article", "main")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self._end_line()
        self.tags += 1
        if self.names[tag] > 0:
            while self._pop() != tag:
                pass

    def handle_data(self, data):
        if not self.dropping:
            self.parts.append(data)
            if not self.links:
                self.own += len(data)

    def close(self):
        super().close()
        self._end_line()


def lines_of(html: str) -> list[tuple[str, int, int, int, bool]]:
    parser = _Lines()
    try:
        parser.feed(html)
        parser.close()
    except AssertionError:  # how the parser reports a marked section it doesn't know
        parser = _Lines()
        parser.feed(html.replace("<![", "&lt;!["))
        parser.close()
    return parser.lines


def smoothed(ratios: np.ndarray, spread: float = SPREAD) -> np.ndarray:
    """Weighted mean of each ratio and its neighbours; the weights of those beyond the ends are left out."""
    reach = int(3 * spread)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / spread) ** 2)
    middle = slice(reach, reach + len(ratios))
    return np.convolve(ratios, kernel)[middle] / np.convolve(np.ones(len(ratios)), kernel)[middle]


def threshold(values: np.ndarray) -> float:
    """A value half-way between the means of the values above and below it."""
    cut = float(values.mean())
    for _ in range(100):
        above = values >= cut
        if above.all():
            return cut
        new = float(values[above].mean() + values[~above].mean()) / 2
        if new == cut:
            break
        cut = new
    return min(cut, float(values.max()))


def main_text(html: str) -> str:
    """The main text of a page: its blocks in order, joined by blanks, each with single blanks inside; empty if none."""
    lines = lines_of(html)
    if not lines:
        return ""
    ratios = np.array([own / max(1, tags) for _, own, tags, _, _ in lines], np.float64)
    values = np.log1p(smoothed(ratios))
    content = values >= threshold(values)
    articles = {line[3] for line, chosen in zip(lines, content) if chosen and line[4]}
    # Where articles hold content, what is outside of them isn't; else any container of a content line is.
    regions = articles or {line[3] for line, chosen in zip(lines, content) if chosen}
    return " ".join(line[0] for line in lines if line[3] in regions)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``; NULL html is empty. Repeated rows stay; extra columns go."""

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), 200):
                some = batch.slice(start, 200)
                texts = [main_text(html) if html else "" for html in some["html"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some["page_id"], some["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id BIGINT, url STRING, text STRING, n_chars BIGINT")
