"""HTML pages to segments, links and frames in one pass over each page, by the standard tokenizer."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.text import is_archived, rate_limited, strip_toolbar
from strandline.functions.urls import is_binary
from strandline.values import BINARY_SUFFIXES, HIDDEN_PARENTS

# Tags without content, of HTML5 and before it.
_VOID = frozenset([
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta", "param", "source", "track", "wbr",
    "basefont", "bgsound", "command", "frame", "image", "isindex", "nextid", "spacer",
])
PARSED = "struct<segments:array<string>,links:array<string>,frames:array<string>>"
_TYPE = pa.struct([(x, pa.list_(pa.string())) for x in ("segments", "links", "frames")])


class _Page(HTMLParser):
    """Text runs with a visible parent, hrefs of links, srcs of frames before those of iframes."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[str] = ["[document]"]
        self.run: list[str] = []
        self.segments: list[str] = []
        self.links: list[str] = []
        self.frames: list[str] = []
        self.inline: list[str] = []

    def flush(self):
        if self.run:
            text = "".join(self.run)
            self.run = []
            if self.open[-1] not in HIDDEN_PARENTS:
                self.segments.append(text)

    def handle_starttag(self, tag, attrs):
        self.flush()
        found = dict(attrs)  # of attributes given twice the last
        if tag in ("a", "area") and "href" in found:
            self.links.append((found["href"] or "").strip())
        elif tag == "frame" and found.get("src"):
            self.frames.append(found["src"])
        elif tag == "iframe" and found.get("src"):
            self.inline.append(found["src"])
        if tag not in _VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.flush()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i] == tag:
                del self.open[i:]
                return

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_data(self, data):
        self.run.append(data)


def parse_page(html: str) -> dict:
    page = _Page()
    page.feed(html)
    page.close()
    page.flush()
    return {"segments": page.segments, "links": page.links, "frames": page.frames + page.inline}


def _parse(values: pa.Array) -> pa.Array:
    return pa.array([None if v is None else parse_page(v) for v in values.to_pylist()], _TYPE)


def parse_html(html: Column) -> Column:
    """struct<segments, links, frames>; null for null."""
    return F.arrow_udf(_parse, PARSED)(html)


def page_store(pages: DataFrame, url: str = "url", html: str = "html", suffixes=BINARY_SUFFIXES, ordinal: str | None = None) -> DataFrame:
    """(url, segments, links, frames) of the archived, non-binary pages of a store, each url's page parsed once.

    Of several pages of a url one that does not say that requests were limited counts, and of these the last by ``ordinal`` (without
    one: by a hash of the page). Only numbers of pages are shuffled to tell which go; pages are not, while those are few.
    """
    place = F.col(ordinal) if ordinal else F.xxhash64(html)
    kept = pages.where(~is_binary(F.col(url), suffixes) & is_archived(F.col(html))).select(F.col(url).alias("url"), F.col(html).alias("html"), F.struct((~rate_limited(F.col(html))).alias("whole"), place.alias("place"), F.monotonically_increasing_id().alias("row")).alias("at"))
    best = kept.groupBy("url").agg(F.max("at").alias("best"), F.count("*").alias("n")).where("n > 1").select(F.col("url").alias("_url"), "best")
    last = kept.join(best, (F.col("url") == F.col("_url")) & (F.col("at") != F.col("best")), "left_anti")
    return last.select("url", parse_html(strip_toolbar(F.col("html"))).alias("p")).select("url", "p.segments", "p.links", "p.frames")
