"""Links of pages: extraction, resolution and filtering, without leaving the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslink.functions.markup import ATTRIBUTE, INSIDE, VALUE, unescape
from corpuslink.functions.urls import is_ok_to_follow, process_link

# A page is read piece by piece, so nothing inside a comment, a value or a text element is taken
# for a tag: comments, elements whose content is text, all other start tags. What is not closed
# ends with the page.
_PIECE = (
    r"(?is)<!--.*?(?:--!?>|\z)"
    rf"|<(script|style|textarea|title)(?=[\s/>]){INSIDE}>.*?(?:</\1\s*>|\z)"
    rf"|<[a-z][^\s/>]*+{INSIDE}>"
)
# Attributes are consumed one by one from the tag's start, so a value of another one is never read.
_HREF = rf"""(?is)^<a[\s/]++(?:(?!href\s*+=){ATTRIBUTE}[\s/]*+)*+href\s*+=[\s=]*+({VALUE})"""


def hrefs(html: Column) -> Column:
    """Link targets of a page in document order; anchors without a target are left out."""
    pieces = F.regexp_extract_all(html, F.lit(_PIECE), F.lit(0))
    with_target = F.filter(pieces, lambda a: a.rlike(_HREF))
    return F.transform(
        with_target,
        lambda a: unescape(F.regexp_replace(F.regexp_extract(a, _HREF, 1), r"""(?s)^(["'])(.*)\1$""", "$2")),
    )


def page_links(pages: DataFrame) -> DataFrame:
    """``(page_id, url, pos, href)``: one row per link, ``pos`` counts from 0 within a page."""
    return pages.select("page_id", "url", F.posexplode(hrefs(F.col("html"))).alias("pos", "href"))


def resolved_links(links: DataFrame) -> DataFrame:
    """Add ``target``: the absolute link without fragment, null if it cannot be told."""
    return links.withColumn("target", process_link(F.col("url"), F.col("href")))


def followable_links(links: DataFrame, domain: str, excluded_prefixes: Sequence[str] = ()) -> DataFrame:
    """Resolved links a crawl limited to ``domain`` may follow."""
    return links.where(is_ok_to_follow(F.col("target"), domain, excluded_prefixes))


def link_table(pages: DataFrame, domain: str, excluded_prefixes: Sequence[str] = ()) -> DataFrame:
    """``(src, pos, dst)`` of every followable link."""
    found = followable_links(resolved_links(page_links(pages)), domain, excluded_prefixes)
    return found.select(F.col("url").alias("src"), "pos", F.col("target").alias("dst"))
