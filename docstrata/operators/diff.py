"""Snapshot diff with two rename passes over (source, slug, title, source_url, source_id, hash) tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstrata.functions.titles import canonical_title, usable_title
from docstrata.runtime import small, staged

COLUMNS = ("source", "change_type", "slug", "old_slug", "title", "source_url", "matched_by")


def _pairs(sides: DataFrame, key: Column, matched_by: str, wanted: Column | None = None) -> DataFrame:
    """(source, slug, old_slug, matched_by) of one-sided rows whose key no other row of its side has; counts combine before the shuffle."""
    new = F.col("side") == "added"
    keyed = sides.withColumn("_key", key).where("_key is not null and _key <> ''")
    keyed = keyed.withColumn("_wanted", wanted if wanted is not None else F.lit(True))
    by = keyed.groupBy("source", "_key").agg(
        F.count_if(new).alias("n_new"), F.count_if(~new).alias("n_old"), F.max(F.when(new, F.col("slug"))).alias("slug"),
        F.max(F.when(~new, F.col("slug"))).alias("old_slug"), F.bool_and("_wanted").alias("ok"),
    )
    return by.where("n_new = 1 and n_old = 1 and ok").select("source", "slug", "old_slug", F.lit(matched_by).alias("matched_by"))


def _rest(sides: DataFrame, pairs: DataFrame) -> DataFrame:
    taken = pairs.select("source", F.inline(F.array(F.struct(F.lit("added").alias("side"), F.col("slug")), F.struct(F.lit("removed").alias("side"), F.col("old_slug").alias("slug")))))
    return sides.join(taken, ["source", "side", "slug"], "left_anti")


def diff(old: DataFrame, new: DataFrame, baseline: DataFrame | None = None) -> DataFrame:
    """The changes from old to new, one row each.

    change_type is added, removed, modified or renamed (matched_by source_id or title). Sources without a baseline give
    none: pass their list as baseline (source), else the sources of old count. Blank ids never match; titles match in
    canonical form when long enough and not generic. A match needs to be unique on both sides. A rename by id shows the
    new title (the old one if it is blank), one by title the old one. Nulls compare as blank.
    """
    known = (baseline if baseline is not None else old).select("source").distinct()
    fields = ("title", "source_url", "source_id", "hash")
    a = old.select("source", "slug", *(F.coalesce(F.col(c), F.lit("")).alias(f"old_{c}") for c in fields), F.lit(True).alias("in_old"))
    b = new.join(small(known), "source", "left_semi").select("source", "slug", *(F.coalesce(F.col(c), F.lit("")).alias(f"new_{c}") for c in fields), F.lit(True).alias("in_new"))
    side = F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "removed").when(F.col("old_hash") != F.col("new_hash"), "modified")
    pick = lambda c: F.when(F.col("in_new").isNull(), F.col(f"old_{c}")).otherwise(F.col(f"new_{c}")).alias(c)
    both = a.join(b, ["source", "slug"], "full_outer").select("source", "slug", side.alias("side"), pick("title"), pick("source_url"), pick("source_id")).where("side is not null")
    both = staged(both, "diff")

    sides = both.where("side <> 'modified'")
    by_id = staged(_pairs(sides, F.when(F.trim("source_id") != "", F.col("source_id")), "source_id"), "by-id")
    left = _rest(sides, by_id)
    canonical = canonical_title(F.col("title"))
    by_title = staged(_pairs(left, canonical, "title", usable_title(canonical)), "by-title")
    pairs = by_id.unionByName(by_title)
    news = both.where("side = 'added'").select("source", "slug", F.col("title").alias("new_title"), "source_url")
    olds = both.where("side = 'removed'").select("source", F.col("slug").alias("old_slug"), F.col("title").alias("old_title"))
    shown = F.when((F.col("matched_by") == "source_id") & (F.col("new_title") != ""), F.col("new_title")).otherwise(F.col("old_title"))
    renamed = pairs.join(news, ["source", "slug"]).join(olds, ["source", "old_slug"]).select("source", F.lit("renamed").alias("change_type"), "slug", "old_slug", shown.alias("title"), "source_url", "matched_by")
    plain = _rest(left, by_title).unionByName(both.where("side = 'modified'")).select("source", F.col("side").alias("change_type"), "slug", F.lit(None).cast("string").alias("old_slug"), "title", "source_url", F.lit(None).cast("string").alias("matched_by"))
    return plain.unionByName(renamed).select(*COLUMNS)


def totals(changes: DataFrame) -> DataFrame:
    """(source, added, removed, modified, renamed, total, is_empty)."""
    kind = F.col("change_type")
    counts = changes.groupBy("source").agg(*(F.count_if(kind == k).alias(k) for k in ("added", "removed", "modified", "renamed")), F.count("*").alias("total"))
    return counts.withColumn("is_empty", F.col("total") == 0)


def drift(pages: DataFrame, old: DataFrame) -> DataFrame:
    """(source, slug, drift): slugs that are new to or gone from the last snapshot; nothing is fetched."""
    fresh = pages.select("source", "slug").distinct().join(old.select("source", "slug"), ["source", "slug"], "left_anti").withColumn("drift", F.lit("new"))
    gone = old.select("source", "slug").distinct().join(pages.select("source", "slug"), ["source", "slug"], "left_anti").withColumn("drift", F.lit("gone"))
    return fresh.unionByName(gone)
