"""Sitemaps: the addresses of one document, and the crawl of an index over a table of fetched documents."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from docstrata.functions.urls import clean_url, same_origin
from docstrata.runtime import staged

_TAG = re.compile(r"<(/?)(?:[\w.-]+:)?([A-Za-z][\w.-]*)[^<>]*?(/?)>|<!\[CDATA\[(.*?)\]\]>|<!--.*?-->", re.S)


def locations(xml: str) -> list[str]:
    """Texts of loc elements directly in url or sitemap, any namespace prefix, in order; a cut-off document gives what it has."""
    stack: list[str] = []
    found: list[str] = []
    text: list[str] | None = None
    at = 0
    for m in _TAG.finditer(xml):
        if text is not None:
            text.append(html.unescape(xml[at : m.start()]))
            if m[4] is not None:
                text.append(m[4])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            if name == "loc" and text is not None:
                if value := "".join(text).strip():
                    found.append(value)
                text = None
            if name in stack:
                del stack[len(stack) - 1 - stack[::-1].index(name) :]
        elif not m[3]:
            if name == "loc" and stack and stack[-1] in ("url", "sitemap"):
                text = []
            stack.append(name)
    if text is not None and (value := ("".join(text) + html.unescape(xml[at:])).strip()):
        found.append(value)
    return found


@F.pandas_udf(ArrayType(StringType()))
def _locations(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else locations(t))


def scan(xml: Column) -> Column:
    """array of addresses; posexplode keeps their order."""
    return _locations.asNondeterministic()(xml)


class CrawlError(RuntimeError):
    """The root sitemap is missing."""


def crawl(documents: DataFrame, seed: str, allowed_origin: str | None = None, max_depth: int = 3) -> DataFrame:
    """(url, depth): pages reached from the seed over documents (url, xml).

    Breadth first: '.xml' addresses are followed once each, within the origin and depth; others are pages, once per
    mention. A missing child is skipped, a missing root raises. Each level is a join; no address comes to the driver.
    """
    edges = staged(documents.select(clean_url(F.col("url")).alias("parent"), F.explode(scan(F.col("xml"))).alias("loc")).select("parent", clean_url(F.col("loc")).alias("url")).where("url <> ''"), "sitemap-edges")
    spark = documents.sparkSession
    root = spark.range(1).select(clean_url(F.lit(seed)).alias("url"))
    if documents.where(F.col("xml").isNotNull()).select(clean_url(F.col("url")).alias("url")).join(F.broadcast(root), "url", "left_semi").isEmpty():
        raise CrawlError(seed)
    level, visited, pages = root, root, None
    for depth in range(max_depth + 1):
        reached = edges.join(level.withColumnRenamed("url", "parent"), "parent").select("url")
        found = reached.where(~F.col("url").endswith(".xml")).withColumn("depth", F.lit(depth))
        pages = found if pages is None else pages.unionByName(found)
        inner = reached.where(F.col("url").endswith(".xml"))
        if allowed_origin is not None:
            inner = inner.where(same_origin(F.col("url"), F.lit(allowed_origin)))
        level = staged(inner.distinct().join(visited, "url", "left_anti"), "sitemap-level")
        if level.isEmpty():
            break
        visited = visited.unionByName(level)
    return pages
