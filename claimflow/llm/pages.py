"""Main text of web pages by site template removal (operator 5).

Each page is read into blocks and element subtrees. All subtrees are counted
per host, over its distinct pages, by digest and by *path*, the kinds and names
of the elements from the root down to them. Those that recur on ``MIN_PAGES`` pages
or more are the site's templates, if their place allows: outside of the article or
main part that a page marks, always, so each of a site's menus, footers and notices
goes although other pages of the site have others; on pages that mark none, if they
are ``MIN_SHARE`` of the host's pages that have anything at their path; within an
article, where pages may well quote the same passage, if they are ``MIN_SHARE`` of
all the host's pages. Templates are deleted from every page of their host. Then
elements go that by kind, role, class or id are no part of an article, and where a
page marks its article or main part, what lies outside of it.

A page's text is its blocks in order, character references decoded, white
space within a block turned into one space, joined by line feeds. Null and
empty pages have an empty text. A null url, or one without ``://``, has the
empty host. Rows that repeat come out as often; identical pages of a host
count once. Null page ids are kept; columns other than the three are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .html_text import Page
from .urls import url_parts

MIN_PAGES, MIN_SHARE = 5, 0.8
#: Where a subtree stands: on a page that marks no article, outside of it, within it.
UNMARKED, OUTSIDE, INSIDE = range(3)
#: Pages read at a time.
SLICE = 256


def _place(digest: int, path: int) -> int:
    """A subtree at a path, in one number."""
    return digest ^ path


def main_text(page: Page, templates: set[int]) -> str:
    if not page.blocks:
        return ""
    stay = ~np.array([b[2] for b in page.blocks])
    for digest, path, _, start, end in page.subtrees:
        if _place(digest, path) in templates:
            stay[start:end] = False
    claim = np.array([b[1] for b in page.blocks])
    stay &= claim >= claim[stay].max(initial=0)
    return "\n".join(b[0] for b, keep in zip(page.blocks, stay) if keep)


def template_blocks(page: Page, templates: set[int]) -> int:
    """How many of the page's blocks are its site's template."""
    gone = np.zeros(len(page.blocks), bool)
    for digest, path, _, start, end in page.subtrees:
        gone[start:end] |= _place(digest, path) in templates
    return int(gone.sum())


_PLACES = "array<struct<place:bigint,path:bigint,area:int>>"


def places(page: Page) -> list[tuple[int, int, int]]:
    """(place, path, area) of the page's subtrees, each once."""
    marked = any(claim >= 2 for _, claim, _ in page.blocks)
    return sorted({(_place(digest, path), path, (INSIDE if inside else OUTSIDE) if marked else UNMARKED)
                   for digest, path, inside, _, _ in page.subtrees})


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, len(batch), SLICE):
            yield batch.slice(lo, SLICE)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        found = [places(Page(s or "")) for s in batch.column("html").to_pylist()]
        bounds = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
        flat = np.array([x for f in found for x in f], np.int64).reshape(-1, 3)
        parts = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1]), pa.array(flat[:, 2], pa.int32())],
                                           names=["place", "path", "area"])
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("content"), pa.ListArray.from_arrays(bounds, parts)],
                                         names=["host", "content", "places"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        texts = [main_text(Page(s or ""), set(t or ())) for s, t in
                 zip(batch.column("html").to_pylist(), batch.column("templates").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                         names=["page_id", "url", "text"])


def _templates(seen: DataFrame) -> DataFrame:
    """(host, place) of the site templates, from the distinct pages (host, content, places)."""
    sizes = seen.groupBy("host").agg(F.count("*").alias("pages"))
    # a page's paths and its subtrees at them, counted side by side: (path, null) and (path, place)
    paths = F.transform(F.array_distinct(F.transform("places", lambda p: p["path"])), lambda p: F.struct(
        F.lit(None).cast("bigint").alias("place"), p.alias("path"), F.lit(None).cast("int").alias("area")))
    counted = seen.select("host", F.explode(F.concat("places", paths)).alias("x")).groupBy(
        "host", "x.path", "x.place", "x.area").agg(F.count("*").alias("n"))
    counted = materialize(counted.where(F.col("n") >= MIN_PAGES), "places")
    layouts = counted.where(F.col("place").isNull()).select("host", "path", F.col("n").alias("layout"))
    of = F.when(F.col("area") == INSIDE, F.col("pages")).when(F.col("area") == UNMARKED, F.col("layout")).otherwise(0)
    often = (counted.where(F.col("place").isNotNull()).join(layouts, ["host", "path"]).join(sizes, "host")
             .where(F.col("n") >= MIN_SHARE * of))
    return materialize(often.select("host", "place").distinct(), "templates")


def site_templates(pages: DataFrame) -> DataFrame:
    """(host, content, templates): of each distinct page (host, content, html) its subtrees that are its
    site's templates. A page's list has its own only, however many the site has."""
    seen = materialize(pages.select("host", "content", "html").mapInArrow(
        _subtrees, f"host string, content bigint, places {_PLACES}"), "subtrees")
    distinct = materialize(seen.groupBy("host", "content").agg(F.first("places").alias("places")), "distinct-pages")
    own = distinct.select("host", "content", F.explode("places.place").alias("place")).join(
        _templates(distinct), ["host", "place"])
    return materialize(own.groupBy("host", "content").agg(F.collect_set("place").alias("templates")), "page-templates")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: page_id, url, text."""
    host, _ = url_parts(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"),
                        host.alias("host"), F.xxhash64(F.coalesce(F.col(html), F.lit(""))).alias("content"))
    # pages meet their templates by a shuffle, at every size: the templates grow with the pages
    joined = rows.join(site_templates(rows).hint("merge"), ["host", "content"], "left")
    kind = dict(rows.dtypes)["page_id"]
    return joined.select("page_id", "url", "html", "templates").mapInArrow(
        _texts, f"page_id {kind}, url string, text string")
