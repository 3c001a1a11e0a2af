"""Main text of web pages from parser events, by text-to-tag ratio.

The standard library's parser reports tags and text one after the other; no tree is
built. Each block becomes a line with its text, the number of tags in it and the
share of its text inside links: elements ``a`` with an address, up to their end tag or,
without one, to the next block or ``a``. A line's value is the logarithm of its characters
per tag, less what links hold unless it lies in a marked article. Lines inside menus, headers, footers, sidebars, notices,
adverts, forms, scripts and reader comments, told by their tags, roles and class
words, have the value 0, as have lines outside the article where a page marks one.
The values are smoothed with a Gaussian; runs of lines above a threshold, which is a
share of the page's mean, are the content regions, and their lines with a value of
their own are the text. Where a page marks its article, all lines of the article that are no such
box are text. Inside it a class or id only tells a box if the whole name does: ``related-posts``, not
``related-work``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches

SIGMA = 1.0
# Lines count as content from this share of the mean smoothed value on, on pages that mark no article.
THRESHOLD = 0.4

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary"
    " table tbody tfoot thead tr ul".split()
)
SPACED = frozenset("br td th option img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(["article", "main"])
NOT_CONTENT = frozenset(
    "script style noscript template iframe object svg canvas audio video map head title nav menu aside footer form"
    " button select textarea input label fieldset dialog search datalist".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar toolbar alert alertdialog dialog status".split()
)
NOT_CONTENT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu"
    " breadcrumb breadcrumbs header masthead topbar footer sidebar aside widget cookie cookies consent gdpr notice notices"
    " banner alert popup modal overlay newsletter subscribe signup login share sharing social related recommended comment"
    " comments disqus pagination pager toolbar skip hidden".split()
)
# Words for the boxes themselves; names of nothing but these and the words above are boxes inside an article, too.
BOX_WORDS = frozenset(
    "box block wrapper wrap container inner outer bar link links button buttons icon icons posts stories area slot unit zone panel"
    " section group main top bottom left right article articles page post site content media form text inline".split()
)
COMMENT_WORDS = frozenset("comment comments disqus".split())
# A section of an article may have these names, too, so they tell comments with another sign only: a word or a list.
MAYBE_COMMENT_WORDS = frozenset("respond replies reply discussion".split())
COMMENT_SIGNS = frozenset("thread threads list form box forum board count toggle button".split())
COMMENT_TAGS = frozenset(["ol", "ul", "li"])
_NAME_WORDS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
_NEGATED = re.compile(r"\b(?:no|has|with|without|hide)[-_]\w+")


class _Lines(HTMLParser):
    """Collects lines: text, tags, characters inside links, whether it may be content, whether in the article."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool, bool]] = []
        self.open: list[tuple[str, str]] = []  # tag, and why it is no content: "", "x" or "comment"
        self.places: dict[str, list[int]] = {}  # of each tag, where it lies in ``open``
        self.blocks: list[str] = []  # the open blocks, innermost last
        self.barred = self.articles = self.comments = 0
        self.link = self.crossed = False  # inside a link; inside it, past the bounds of a block
        self.crossing: list[tuple[int, int]] = []  # lines and their characters past such bounds, of links if an end tag comes
        self.crossing_chars = 0
        self.parts: list[str] = []
        self.tags = self.link_chars = 0
        self.left_out = False  # text that cannot be content

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text or self.left_out:
            if self.crossing_chars:
                self.crossing.append((len(self.lines), self.crossing_chars))
            self.lines.append((text, self.tags, self.link_chars, text != "", self.articles > 0))
            self.tags = 0
        self.parts, self.link_chars, self.left_out = [], 0, False
        self.crossing_chars = 0
        self.crossed = self.link

    def _end_link(self, by_tag: bool) -> None:
        """Without an end tag, what follows the link's own block was not meant to be in it."""
        if by_tag:
            self.link_chars += self.crossing_chars
            for place, chars in self.crossing:
                text, tags, links, ok, inside = self.lines[place]
                self.lines[place] = text, tags, links + chars, ok, inside
        self.link, self.crossed, self.crossing, self.crossing_chars = False, False, [], 0

    def _why(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        given = {k: v or "" for k, v in attrs}
        words, boxes = set(), set()
        if tag not in ("html", "body") and (named := f"{given.get('class', '')} {given.get('id', '')}").strip():
            names = [{w.lower() for w in _NAME_WORDS.findall(name)} for name in _NEGATED.sub(" ", named).split()]
            words = set().union(*names)
            for name in names:
                if name <= NOT_CONTENT_WORDS | BOX_WORDS:
                    boxes |= name & NOT_CONTENT_WORDS
        maybe = words & MAYBE_COMMENT_WORDS
        if words & COMMENT_WORDS or maybe and (len(maybe) > 1 or words & COMMENT_SIGNS or tag in COMMENT_TAGS):
            return "comment"
        if tag in ARTICLE:
            return ""
        if tag in NOT_CONTENT or given.get("role", "").lower() in ROLES:
            return "x"
        if "hidden" in given or given.get("aria-hidden") == "true":
            return "x"
        # Inside the article a header holds its title.
        if self.articles and (tag == "header" or tag in ("h1", "h2", "h3", "h4", "h5", "h6")):
            return ""
        if self.articles:
            return "x" if boxes - {"header"} else ""
        return "x" if tag == "header" or words & NOT_CONTENT_WORDS else ""

    def _push(self, tag: str, why: str) -> None:
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in BLOCKS:
            self.blocks.append(tag)
        self.open.append((tag, why))
        self.comments += why == "comment"
        self.barred += bool(why)
        self.articles += tag in ARTICLE and not self.barred

    def _pop(self) -> str:
        tag, why = self.open.pop()
        self.places[tag].pop()
        if tag in BLOCKS:
            self.blocks.pop()
        self.comments -= why == "comment"
        self.articles -= tag in ARTICLE and not self.barred
        self.barred -= bool(why)
        if tag == "a":
            self._end_link(by_tag=False)
        return tag

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in BLOCKS:
            self._flush()
        elif tag in SPACED:
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        if tag in ARTICLE and self.barred and not self.comments:
            # A box before the article that was never closed.
            while self.barred:
                self._pop()
        if tag == "a":
            self._end_link(by_tag=False)
            self.link = any(name == "href" for name, _ in attrs)
        self._push(tag, self._why(tag, attrs))

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        elif tag in SPACED:
            self.parts.append(" ")
        self.tags += 1
        place = (self.places.get(tag) or [-1])[-1]
        if tag in ("p", "li") and self.blocks[-1:] != [tag]:
            place = -1  # these may be left open; a stray end must not close what is around them
        if place >= 0:
            if tag == "a":
                self._end_link(by_tag=True)
            while len(self.open) > place:
                self._pop()

    def handle_data(self, data: str) -> None:
        if self.barred:
            self.left_out |= not data.isspace()
        else:
            self.parts.append(data)
            if self.crossed:
                self.crossing_chars += len(data.strip())
            elif self.link:
                self.link_chars += len(data.strip())

    def close(self) -> None:
        super().close()
        self._flush()


def main_text(html: str) -> str:
    """The main text of one page: its blocks, joined by an empty line."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    lines = parser.lines
    has_article = any(ok and inside for _, _, _, ok, inside in lines)
    values = np.array([
        math.log1p(max(0, len(text) - (0 if inside else links)) / (1 + tags)) if ok and (inside or not has_article) else 0.0
        for text, tags, links, ok, inside in lines
    ])
    if not values.any():
        return ""
    if has_article:
        return "\n\n".join(lines[i][0] for i in np.flatnonzero(values > 0).tolist())
    reach = int(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    smooth = np.convolve(values, kernel / kernel.sum())[reach : reach + len(values)]
    least = THRESHOLD * smooth[values > 0].mean()
    return "\n\n".join(lines[i][0] for i in np.flatnonzero((smooth >= least) & (values > 0)).tolist())


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html or "") for html in batch.column("html").to_pylist()]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
        yield pa.record_batch(columns, names=["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Character references are decoded, white space within a block becomes one blank, and
    blocks are joined in page order by an empty line. A null or empty page, or one
    without content, has an empty text. Null ids and addresses are kept, repeated rows
    give repeated results, and other columns are ignored. There is no shuffle.
    """
    in_small_batches(pages)
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    return rows.mapInArrow(_extracted, "page_id bigint, url string, text string, n_chars bigint")
