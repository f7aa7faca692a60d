"""A refresh of all sources at once: baseline, conversion, assets, carry-forward, diff, guards, commit, log.

Snapshots are versions of one table below a root: version=N is written from version N-1 and counts once its marker file
is there, so a run that died is run again over its own remains. Sources are columns of one job; a source that a guard
stops keeps its last snapshot and is reported, the others go on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.functions.assets import AssetRules, download_plan, prunable, references, rewrite
from docstrata.functions.text import content_hash, day_key
from docstrata.operators.diff import COLUMNS, diff
from docstrata.operators.discovery import required
from docstrata.operators.lifecycle import carried_forward, deletion_ratios, deletions, duplicate_slugs, gates, stamped
from docstrata.runtime import filesystem, small, staged

SNAPSHOT = "source string, slug string, title string, page_group string, source_url string, source_id string, hash string, last_updated timestamp"


@dataclass
class Store:
    """Snapshot versions and the change log below a root folder."""

    spark: SparkSession
    root: str

    def _path(self, version: int) -> str:
        return f"{self.root.rstrip('/')}/snapshots/version={version}"

    def version(self) -> int:
        """The last complete version, 0 for none."""
        fs, at = filesystem(self.spark, f"{self.root.rstrip('/')}/snapshots")
        if not fs.exists(at):
            return 0
        found = [int(s.getPath().getName().partition("=")[2]) for s in fs.listStatus(at)]
        return max((v for v in found if fs.exists(filesystem(self.spark, f"{self._path(v)}/_SUCCESS")[1])), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        v = self.version() if version is None else version
        return self.spark.read.schema(SNAPSHOT).parquet(self._path(v)) if v else self.spark.createDataFrame([], SNAPSHOT)

    def write(self, snapshot: DataFrame, version: int) -> None:
        columns = [c.split()[0] for c in SNAPSHOT.split(", ")]
        snapshot.select(*columns).write.mode("overwrite").parquet(self._path(version))

    def log(self, changes: DataFrame, now: str, version: int) -> None:
        """The changes of a version under their UTC day; logging a version again replaces it."""
        rows = changes.select(*COLUMNS, F.lit(now).cast("timestamp").alias("changed_at")).withColumns({"change_date": day_key(F.col("changed_at")), "version": F.lit(version)})
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("change_date", "version").parquet(f"{self.root.rstrip('/')}/changes")

    def changes(self) -> DataFrame:
        path = f"{self.root.rstrip('/')}/changes"
        fs, at = filesystem(self.spark, path)
        schema = ", ".join(f"{c} string" for c in COLUMNS) + ", changed_at timestamp, change_date string, version int"
        return self.spark.read.schema(schema).parquet(path) if fs.exists(at) else self.spark.createDataFrame([], schema)


@dataclass
class Result:
    """What a refresh did: its version (None when nothing was saved), changes, and the sources that were stopped with why."""

    version: int | None
    changes: DataFrame
    stopped: dict[str, str] = field(default_factory=dict)
    carried: int = 0
    report: DataFrame | None = None  # see run_report
    media: DataFrame | None = None  # what to download
    unused: DataFrame | None = None  # files that no page refers to


def stopped_sources(old: DataFrame, pages: DataFrame, force: bool = False) -> dict[str, str]:
    """Sources that must not be refreshed: duplicate slugs, no pages left, or without force more than half of them gone."""
    why: dict[str, str] = {}
    ratios = deletion_ratios(old, pages)
    if not force:
        why |= {r.source: "too many deletions" for r in ratios.where("is_blocked").toLocalIterator()}
    gone = old.select("source").distinct().join(pages.select("source").distinct(), "source", "left_anti")
    why |= {r.source: "no pages discovered" for r in gone.toLocalIterator()}
    return why | {r.source: "duplicate slugs" for r in duplicate_slugs(pages).select("source").distinct().toLocalIterator()}


def staged_media(texts: DataFrame, rules: AssetRules, files: DataFrame | None = None, all_fresh: bool = False) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(texts with rewritten references and new hashes, download plan, files to prune) from (source, slug, text, hash)."""
    refs = references(texts.select(F.concat_ws("/", "source", "slug").alias("page"), "text"), "text", rules).drop("text")
    plan = download_plan(refs, "page", rules.subdir)
    changed = rewrite(F.col("text"), F.col("slug"), rules)
    done = texts.withColumn("text", F.when(F.col("text").rlike(rules.pattern), changed).otherwise(F.col("text"))).withColumn("hash", content_hash(F.col("text")))
    return done, plan, prunable(files, refs, all_fresh) if files is not None else None


def asset_results(plan: DataFrame, fetched: DataFrame, present: DataFrame) -> DataFrame:
    """(asset_path, outcome): written, cached (the file is there with that digest) or failed, from (asset_path, digest) tables."""
    rows = plan.select("asset_path").join(fetched.select("asset_path", F.col("digest").alias("new")), "asset_path", "left").join(present.select("asset_path", F.col("digest").alias("old")), "asset_path", "left")
    return rows.select("asset_path", F.when(F.col("new").isNull(), "failed").when(F.col("new").eqNullSafe(F.col("old")), "cached").otherwise("written").alias("outcome"))


def selected(sources: DataFrame, only: Sequence[str]) -> list[str]:
    """The names as sources have them, in their order and once each; LookupError for unknown ones and for an empty list."""
    wanted = list(dict.fromkeys(only))
    known = {r[0] for r in sources.where(F.col("source").isin(wanted)).select("source").distinct().collect()} if wanted else set()
    if missing := [s for s in wanted if s not in known]:
        raise LookupError("unknown sources: " + ", ".join(missing))
    if not wanted:
        raise LookupError("no sources selected")
    return wanted


def run_report(discovered: DataFrame, entries: DataFrame, old: DataFrame, changes: DataFrame) -> DataFrame:
    """(source, discovered, fetched, carried, written, deleted, added, removed, modified, renamed): what a run did to each source it saw.

    entries (source, slug, hash, carried) is the new snapshot. Written are pages that are new or changed, deleted those of
    the old snapshot that are no longer discovered.
    """
    per = lambda rows, *aggs: rows.groupBy("source").agg(*aggs)
    seen = per(discovered.select("source", "slug").distinct(), F.count("*").alias("discovered"))
    same = entries.join(old.select("source", "slug", F.col("hash").alias("_old")), ["source", "slug"], "left")
    kept = per(same, F.count_if(~F.col("carried")).alias("fetched"), F.count_if("carried").alias("carried"), F.count_if(F.col("_old").isNull() | ~F.col("hash").eqNullSafe(F.col("_old"))).alias("written"))
    gone = per(deletions(old, discovered), F.count("*").alias("deleted"))
    kinds = ("added", "removed", "modified", "renamed")
    changed = per(changes, *(F.count_if(F.col("change_type") == k).alias(k) for k in kinds))
    whole = seen
    for side in (kept, gone, changed):
        whole = whole.join(side, "source", "full_outer")
    numbers = ("discovered", "fetched", "carried", "written", "deleted", *kinds)
    return whole.select("source", *(F.coalesce(c, F.lit(0)).alias(c) for c in numbers))


def refresh(
    store: Store, pages: DataFrame, fetched: DataFrame, sources: DataFrame, now: str, convert: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None, force: bool = False,
    only: Sequence[str] | None = None, media: AssetRules | None = None, files: DataFrame | None = None,
) -> Result:
    """One run over discovered pages (source, slug, source_url, source_id, page_group) and fetched texts.

    fetched has (source, slug, title, hash), or whatever convert turns into that and its failures. A page without a text
    keeps its old entry; without one it is left out, but is not deleted. A run without changes writes nothing, and one
    that discovered nothing at all is refused. With only, the sources named are refreshed and the others keep their
    snapshot. With media, references in text (fetched then has that column) are rewritten before it is hashed, and the
    result says what to download and which of files (asset_path) nothing refers to any more.
    """
    version = store.version()
    whole = store.read(version)
    left_out = None
    if only is not None:
        names = small(store.spark.createDataFrame([(s,) for s in selected(sources, only)], "source string"))
        pages, fetched, sources = (t.join(names, "source", "left_semi") for t in (pages, fetched, sources))
        left_out = whole.join(names, "source", "left_anti")
        whole = whole.join(names, "source", "left_semi")
    old = whole
    required(pages, "refresh")
    good, _ = convert(fetched) if convert else (fetched, None)
    plan = unused = None
    if media is not None:
        fresh = pages.select("source", "slug").distinct().join(good.select("source", "slug"), ["source", "slug"], "left_anti").isEmpty()
        good, plan, unused = staged_media(good, media, files, all_fresh=fresh)
        good = staged(good, "media-texts")
    stopped = stopped_sources(old, pages, force)
    names = small(store.spark.createDataFrame([(s,) for s in stopped], "source string"))
    live = pages.join(names, "source", "left_anti").select("source", "slug", "source_url", "source_id", "page_group")
    texts = good.select("source", "slug", "title", "hash")
    entries = live.join(texts, ["source", "slug"])
    failed = live.select("source", "slug").join(texts.select("source", "slug"), ["source", "slug"], "left_anti")
    kept = staged(carried_forward(entries.withColumn("last_updated", F.lit(None).cast("timestamp")), failed, old), "entries")
    base = old.join(names, "source", "left_anti")
    changes = staged(diff(base, kept, baseline=base.select("source")), "changes")
    gate = gates(changes, sources, base).join(kept.select("source").distinct(), "source", "left_semi")
    held = old.join(names, "source", "left_semi")
    held = held if left_out is None else held.unionByName(left_out)
    report = run_report(live, kept, base, changes)
    if gate.where("saves").isEmpty():
        return Result(None, changes, stopped, report=report, media=plan, unused=unused)
    store.write(stamped(kept.drop("carried"), base, now).unionByName(held, allowMissingColumns=True), version + 1)
    logged = changes.join(small(gate.where("logs").select("source")), "source", "left_semi")
    if not logged.isEmpty():
        store.log(logged, now, version + 1)
    return Result(version + 1, changes, stopped, kept.where("carried").count(), report, plan, unused)


def last_seen(column: str, now: str) -> Column:
    """Seconds between a time and now."""
    return F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(column)
