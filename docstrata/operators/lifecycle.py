"""One refresh of a source's snapshot: carry-forward, stamps, write and delete sets, guards, gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docstrata.functions.canonical import stripped

MOST_DELETED = 0.5


class GuardError(RuntimeError):
    """A refresh would lose pages it should not."""


def first_wins(pages: DataFrame, order: str = "ordinal") -> DataFrame:
    """The first row of each (source, slug) in discovery order; equal places are settled by the other columns."""
    ties = [c for c in pages.columns if c not in ("source", "slug", order)]
    by = Window.partitionBy("source", "slug").orderBy(F.col(order).asc_nulls_last(), *ties)
    return pages.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def duplicate_slugs(pages: DataFrame) -> DataFrame:
    """(source, slug, copies) of slugs that occur more than once."""
    return pages.groupBy("source", "slug").agg(F.count("*").alias("copies")).where("copies > 1")


def carried_forward(fetched: DataFrame, failed: DataFrame, old: DataFrame) -> DataFrame:
    """New entries, with the old entry of each page whose fetch failed; a failed page without one has none.

    Adds carried (boolean). A page that was both fetched and reported as failed counts as fetched.
    """
    kept = old.join(failed.select("source", "slug").distinct(), ["source", "slug"], "left_semi").join(fetched.select("source", "slug"), ["source", "slug"], "left_anti")
    columns = [c for c in fetched.columns if c in old.columns]
    return fetched.select(*columns, F.lit(False).alias("carried")).unionByName(kept.select(*columns, F.lit(True).alias("carried")))


def stamped(entries: DataFrame, old: DataFrame, now: str) -> DataFrame:
    """entries (source, slug, hash, ...) with last_updated and is_written.

    A page with an unchanged hash keeps its time; new and changed ones, and ones whose time was empty, get now. Pages are
    written when they are new or changed.
    """
    before = old.select("source", "slug", F.col("hash").alias("old_hash"), F.col("last_updated").alias("old_updated"))
    same = F.col("hash").eqNullSafe(F.col("old_hash")) & F.col("old_hash").isNotNull()
    at = F.to_timestamp(F.lit(now))
    joined = entries.drop("last_updated").join(before, ["source", "slug"], "left")
    return joined.withColumn("last_updated", F.when(same & F.col("old_updated").isNotNull(), F.col("old_updated")).otherwise(at)).withColumn("is_written", ~same).drop("old_hash", "old_updated")


def deletions(old: DataFrame, discovered: DataFrame) -> DataFrame:
    """(source, slug) of pages that are no longer discovered. A page that was discovered but not fetched stays."""
    return old.select("source", "slug").distinct().join(discovered.select("source", "slug"), ["source", "slug"], "left_anti")


def deletion_ratios(old: DataFrame, discovered: DataFrame) -> DataFrame:
    """(source, old_pages, deleted, ratio, is_blocked): blocked when strictly more than half would go."""
    marks = discovered.select("source", "slug", F.lit(1).alias("there")).distinct()
    by = old.select("source", "slug").distinct().join(marks, ["source", "slug"], "left").groupBy("source")
    counted = by.agg(F.count("*").alias("old_pages"), F.count_if(F.col("there").isNull()).alias("deleted"))
    return counted.withColumn("ratio", F.round(F.col("deleted") / F.col("old_pages"), 6)).withColumn("is_blocked", F.col("deleted") > F.col("old_pages") * MOST_DELETED)


def guard(old: DataFrame, discovered: DataFrame, force: bool = False) -> None:
    """Raises GuardError for duplicate slugs, for sources that lost all pages, and without force for too many deletions."""
    twice = duplicate_slugs(discovered).orderBy("source", "slug").limit(10).collect()
    if twice:
        raise GuardError("duplicate slugs: " + ", ".join(f"{r.source}/{r.slug}" for r in twice))
    ratios = deletion_ratios(old, discovered)
    lost = ratios.where("deleted = old_pages").join(discovered.select("source").distinct(), "source", "left_anti").limit(10).collect()
    if lost:
        raise GuardError("no pages discovered: " + ", ".join(sorted(r.source for r in lost)))
    if not force and (blocked := ratios.where("is_blocked").limit(10).collect()):
        raise GuardError("too many deletions: " + ", ".join(sorted(r.source for r in blocked)))


def gates(changes: DataFrame, sources: DataFrame, old: DataFrame) -> DataFrame:
    """(source, is_baseline, has_changes, saves, logs): whether a run writes its snapshot and its change log.

    A snapshot is saved for a baseline, a change or another version (sources.version against old_version, null or blank
    as no version); a log entry needs generate_whats_new, pages before, and a change.
    """
    before = old.groupBy("source").agg(F.count("*").alias("old_pages"))
    changed = changes.groupBy("source").agg(F.count("*").alias("changes"))
    rows = sources.join(before, "source", "left").join(changed, "source", "left")
    n, c = F.coalesce("old_pages", F.lit(0)), F.coalesce("changes", F.lit(0))
    new_version = ~F.coalesce(F.nullif(stripped(F.col("version")), F.lit("")), F.col("old_version")).eqNullSafe(F.col("old_version")) if "old_version" in sources.columns else F.lit(False)
    return rows.select("source", (n == 0).alias("is_baseline"), (c > 0).alias("has_changes"), ((n == 0) | (c > 0) | new_version).alias("saves"), (F.coalesce("generate_whats_new", F.lit(False)) & (n > 0) & (c > 0)).alias("logs"))


def run_statistics(metadata: DataFrame) -> DataFrame:
    """(source, run_id, discovered, fetched, failed, failed_pages, duration_s, completed): the workers of a run together.

    failed_pages counts distinct, trimmed, non-blank names; a run's duration is its longest worker's.
    """
    names = F.filter(F.transform("failed_pages", stripped), lambda s: s.isNotNull() & (s != ""))
    by = metadata.withColumn("_names", names).groupBy("source", "run_id")
    # distinct names combine within each task before the shuffle
    totals = by.agg(*(F.sum(c).alias(c) for c in ("discovered", "fetched", "failed")), F.round(F.max("duration_s"), 3).alias("duration_s"), F.max("completed").alias("completed"), F.every(F.coalesce("failed", F.lit(0)) == 0).alias("all_fresh"))
    named = metadata.select("source", "run_id", F.explode(names).alias("name")).distinct().groupBy("source", "run_id").agg(F.count("*").alias("failed_pages"))
    return totals.join(named, ["source", "run_id"], "left").withColumn("failed_pages", F.coalesce("failed_pages", F.lit(0)))


def resolved_versions(sources: DataFrame, probed: DataFrame, old: DataFrame) -> DataFrame:
    """(source, version): the probe's, else the last run's, else the configured one, else a dash."""
    rows = sources.select("source", F.col("version").alias("configured")).join(probed.select("source", F.col("version").alias("probed")), "source", "left").join(old.select("source", F.col("version").alias("before")), "source", "left")
    value = lambda c: F.nullif(F.nullif(stripped(F.col(c)), F.lit("")), F.lit("—"))
    return rows.select("source", F.coalesce(value("probed"), value("before"), value("configured"), F.lit("—")).alias("version"))
