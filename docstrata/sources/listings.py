"""Listings of pages: file trees of a repository, release tags, bullet lists of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstrata.functions.titles import version
from docstrata.functions.urls import clean_url

TREE = "struct<truncated: boolean, tree: array<struct<type: string, path: string>>>"


class ListingError(ValueError):
    """The listing is cut off or no listing."""


def tree_entries(listings: DataFrame, json: str, strict: bool = True) -> DataFrame:
    """(type, path) besides the other columns, from listings as JSON. Cut-off or malformed ones raise, or are left out."""
    rows = listings.withColumn("_t", F.from_json(json, TREE))
    bad = F.col("_t").isNull() | F.col("_t.tree").isNull() | F.coalesce("_t.truncated", F.lit(False)) | F.exists("_t.tree", lambda e: e.isNull() | e["path"].isNull())
    if strict and not rows.where(bad).isEmpty():
        raise ListingError("a listing is truncated or malformed")
    rows = rows.where(~bad)
    return rows.select(*[c for c in listings.columns if c != json], F.inline("_t.tree"))


def tree_pages(entries: DataFrame, prefix: str, suffixes: tuple[str, ...] = (".md",)) -> DataFrame:
    """Adds slug: files below the prefix with one of the suffixes, without both."""
    pattern = "(?:" + "|".join(s.replace(".", r"\.") for s in suffixes) + r")\z"
    rest = F.substr(F.col("path"), F.lit(len(prefix) + 1))
    return entries.where((F.col("type") == "blob") & F.startswith("path", F.lit(prefix)) & F.col("path").rlike(pattern)).withColumn("slug", F.regexp_replace(rest, pattern, "")).where("slug <> ''")


def localized_pages(pages: DataFrame, locales: list[str], wanted: list[str] | None = None, default: str = "en") -> DataFrame:
    """Adds locale and page: the first segment when it is a locale; index and readme pages stand for their directory ('intro' at the top)."""
    head = F.split_part("slug", F.lit("/"), F.lit(1))
    is_locale = head.isin(*locales) & F.contains("slug", F.lit("/"))
    rest = F.when(is_locale, F.substr(F.col("slug"), F.length(head) + 2)).otherwise(F.col("slug"))
    page = F.when(F.lower(rest).isin("index", "readme"), "intro").otherwise(F.regexp_replace(rest, r"(?i)/(?:index|readme)\z", ""))
    rows = pages.withColumn("locale", F.when(is_locale, head).otherwise(default)).withColumn("page", page)
    return rows.where(F.col("locale").isin(*wanted)) if wanted is not None else rows


def release_version(json: Column) -> Column:
    """The version of a release's tag, from its JSON."""
    return version(F.get_json_object(json, "$.tag_name"))


def bullet_links(text: Column, hosts: list[str], path: str = "/docs/") -> Column:
    """array<struct(label, url)> of '- [label](url)' lines to Markdown pages of the hosts below the path."""
    pattern = r"(?m)^\s*[-*]\s+\[([^\[\]\n]*)\]\(([^()\s]+)\)"
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("label"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("url"))
    allowed = r"^https?://(?:" + "|".join(h.replace(".", r"\.") for h in hosts) + ")" + path + r"[^?#]*\.md(?:[?#].*)?\z"
    return F.transform(F.filter(pairs, lambda p: p["url"].rlike(allowed)), lambda p: F.struct(p["label"].alias("label"), clean_url(p["url"]).alias("url")))
