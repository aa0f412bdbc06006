"""Sitemap scan: stored XML documents to page urls and nested sitemaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.html import unescape
from shelfwise.functions.text import clean

# A location inside <url> or <sitemap>; any namespace prefix.
_ENTRY = r"(?is)<(?:[\w.\-]+:)?{kind}\b[^>]*>.*?<(?:[\w.\-]+:)?loc\b[^>]*>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</(?:[\w.\-]+:)?loc\s*>"


def locations(xml: Column, kind: str) -> Column:
    found = F.regexp_extract_all(xml, F.lit(_ENTRY.format(kind=kind)), F.lit(1))
    return F.filter(F.transform(found, lambda u: clean(unescape(u))), lambda u: u.isNotNull())


def entries(sitemaps: DataFrame, url_column: str, xml_column: str) -> DataFrame:
    """Rows (from_url, to_url, kind): pages and nested sitemaps of every document."""
    x = F.col(xml_column)
    both = F.concat(
        F.transform(locations(x, "sitemap"), lambda u: F.struct(F.lit("sitemap").alias("kind"), u.alias("to_url"))),
        F.transform(locations(x, "url"), lambda u: F.struct(F.lit("page").alias("kind"), u.alias("to_url"))),
    )
    return sitemaps.select(F.col(url_column).alias("from_url"), F.explode(both).alias("e")).select(
        "from_url", "e.to_url", "e.kind")
