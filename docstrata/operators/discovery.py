"""Discovery: from addresses, file trees and bullet lists to page records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docstrata.functions.urls import clean_url, first_group, markdown_twin, page_violations, parent_group, same_origin, slug_below
from docstrata.operators.lifecycle import first_wins
from docstrata.runtime import small, staged

PAGE = ("source", "slug", "source_url", "source_md_url", "source_id", "page_group", "ordinal")


def from_addresses(found: DataFrame, site: str | Column, prefix: str = "", groups: str = "parent", root: str = "index") -> DataFrame:
    """Page records from (source, url, ordinal): addresses of the site below the prefix; groups are 'parent' or 'first' segments.

    The site is one for all rows or a column of found. Rows whose site is null are in none.
    """
    clean, site = clean_url(F.col("url")), F.lit(site)
    rows = found.where(same_origin(clean, site)).withColumn("slug", slug_below(F.col("url"), site, prefix, root)).where("slug is not null")
    group = parent_group(F.col("slug")) if groups == "parent" else first_group(F.col("slug"))
    return rows.select("source", "slug", clean.alias("source_url"), markdown_twin(F.col("url")).alias("source_md_url"), F.col("slug").alias("source_id"), group.alias("page_group"), "ordinal")


def checked(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid pages, quarantined ones with their violations)."""
    marked = pages.withColumn("violations", page_violations(*(F.col(c) for c in ("slug", "source_url", "source_md_url", "source_id"))))
    return marked.where(F.size("violations") == 0).drop("violations"), marked.where(F.size("violations") > 0)


def merged(channels: list[DataFrame]) -> DataFrame:
    """One page per slug from several channels; earlier channels win, within one the first mention does."""
    whole = None
    for n, c in enumerate(channels):
        c = c.withColumn("_channel", F.lit(n))
        whole = c if whole is None else whole.unionByName(c)
    by = Window.partitionBy("source", "slug").orderBy("_channel", "ordinal", "source_url")
    return whole.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n", "_channel")


def required(pages: DataFrame, what: str) -> DataFrame:
    """The pages, or an error where there are none."""
    if pages.isEmpty():
        raise LookupError(f"no pages discovered: {what}")
    return pages


def followed_redirects(slugs: DataFrame, redirects: DataFrame) -> DataFrame:
    """(slug, target): redirects (slug, target; one a slug) followed to their end however long, a cycle to where it closes.

    A round is a join of what still moves, so there are as many as the longest chain has links.
    """
    hops = staged(redirects.select(F.col("slug").alias("target"), F.col("target").alias("_to")), "redirects")
    moving, ended = slugs.select("slug", F.col("slug").alias("target"), F.array("slug").alias("seen")), None
    while True:
        onward = F.col("_to").isNotNull() & ~F.array_contains("seen", F.col("_to"))
        step = staged(moving.join(small(hops), "target", "left").select("slug", "target", "seen", F.when(onward, F.col("_to")).alias("_to")), "redirects-round")
        done = step.where("_to is null").select("slug", "target")
        ended = done if ended is None else ended.unionByName(done)
        moving = step.where("_to is not null").select("slug", F.col("_to").alias("target"), F.array_append("seen", F.col("_to")).alias("seen"))
        if moving.isEmpty():
            return ended


def resolved_slugs(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """(slug, target): the first known of the slug itself, below 'guides/', its last segment and the whole with '_' for '-'."""
    s = F.col("slug")
    tries = F.array(s, F.concat(F.lit("guides/"), s), F.replace(F.element_at(F.split(s, "/"), -1), F.lit("-"), F.lit("_")), F.replace(s, F.lit("-"), F.lit("_")))
    tried = wanted.select("slug", F.posexplode(tries).alias("n", "target"))
    hit = tried.join(known.select(F.col("slug").alias("target")).distinct(), "target", "left_semi")
    best = hit.groupBy("slug").agg(F.min(F.struct("n", "target")).alias("b"))
    return wanted.select("slug").distinct().join(best, "slug", "left").select("slug", F.col("b.target").alias("target"))


__all__ = ["PAGE", "checked", "first_wins", "followed_redirects", "from_addresses", "merged", "required", "resolved_slugs"]
