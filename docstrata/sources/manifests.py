"""Manifest JSON and page files: tolerant reading, sorted writing, atomic exports."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.functions.canonical import stripped
from docstrata.functions.urls import slug_violation
from docstrata.runtime import staged

ENTRY = "slug: string, title: string, group: string, source_url: string, source_md_url: string, source_id: string, hash: string, last_updated: string"
SCHEMA = f"struct<version: string, last_updated: string, files: map<string, struct<{ENTRY}>>, fetch_metadata: struct<last_fetch_completed: string, fetch_duration_seconds: double, total_pages_discovered: int, total_pages_fetched: int, total_pages_failed: int, failed_pages: array<string>>>"
TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z\z"
REQUIRED = ("title", "source_url", "source_md_url", "source_id", "hash")


def entry_faults(key: Column, e: Column) -> Column:
    """array of what is wrong with a manifest entry under its key; empty for a valid one. Blank times are allowed."""
    missing = [F.when(e[c].isNull() | (stripped(e[c]) == ""), f"{c} missing") for c in REQUIRED if c != "title"]
    return F.array_compact(F.array(
        F.when(~key.eqNullSafe(e["slug"]), "key is not the slug"), F.concat(F.lit("slug "), slug_violation(e["slug"])), *missing,
        F.when(e["title"].isNull(), "title missing"), F.when(~e["hash"].rlike(r"^[0-9a-f]{64}\z"), "hash malformed"),
        F.when((F.coalesce(e["last_updated"], F.lit("")) != "") & ~e["last_updated"].rlike(TIME), "last_updated malformed"),
    ))


def read_manifests(texts: DataFrame, source: str = "source", text: str = "value") -> tuple[DataFrame, DataFrame]:
    """(entries, states) from one manifest text per source.

    Unknown keys are dropped. A text that is no object, or has one faulty entry, is no baseline at all: its entries are
    left out and states (source, has_baseline, version, last_updated) says so. A run time or version that is null or
    holds a line break falls back to '' and a dash.
    """
    parsed = texts.withColumn("_m", F.from_json(text, SCHEMA, {"mode": "PERMISSIVE"}))
    pairs = F.map_entries("_m.files")
    faulty = F.exists(pairs, lambda p: F.size(entry_faults(p["key"], p["value"])) > 0)
    ok = F.col("_m.files").isNotNull() & ~F.coalesce(faulty, F.lit(True))
    tidy = lambda c, other: F.when(c.isNull() | c.rlike(r"[\r\n]"), other).otherwise(c)
    states = parsed.select(source, ok.alias("has_baseline"), tidy(F.col("_m.version"), "—").alias("version"), tidy(F.col("_m.last_updated"), "").alias("last_updated"))
    entries = parsed.where(ok).select(source, F.explode(pairs).alias("p")).select(source, "p.value.*")
    return entries, states


def corpus(spark: SparkSession, root: str) -> DataFrame:
    """(path, text): every Markdown file below a folder, path relative to it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    path = F.regexp_replace("path", r"^.*?" + root.removeprefix("file://").rstrip("/").replace(".", r"\.") + "/", "")
    return files.where(F.lower("path").rlike(r"\.(?:md|markdown)\z")).select(path.alias("path"), F.decode("content", "UTF-8").alias("text"))


def asset_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, digest, length): every file below a folder, for comparison with planned assets."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", F.sha2("content", 256).alias("digest"), "length")


def replace_file(path: str | Path, text: str) -> None:
    """The file holds the old or the new text, never a part: a sibling is written, then renamed."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    sibling = path.with_name(f"{path.name}.{os.getpid()}_{uuid.uuid4().hex[:8]}.tmp")
    try:
        sibling.write_text(text, encoding="utf-8")
        sibling.replace(path)
    finally:
        sibling.unlink(missing_ok=True)


def manifest_json(entries: Iterable[dict], version: str, updated: str) -> str:
    """One source's manifest as JSON: entries by slug, two blanks, letters as they are, a final line end."""
    files = {e["slug"]: e for e in sorted(entries, key=lambda e: e["slug"])}
    return json.dumps({"version": version, "last_updated": updated, "files": files}, indent=2, ensure_ascii=False) + "\n"


def write_pages(pages: DataFrame, gone: DataFrame, root: str) -> DataFrame:
    """(slug, outcome) of an export of pages as files below a folder that every executor sees; tasks write their own rows.

    pages has (slug, text, is_written): a page is written when it is new or changed, and when its file is missing; else it
    is kept. Files of gone (slug) are deleted. Slugs that could lead out of the folder are refused. Run prune_empty after it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = Path(root.removeprefix("file://"))
        for rows in batches:
            done = []
            for slug, text, wanted, fault, goes in zip(rows["slug"], rows["text"], rows["is_written"], rows["fault"], rows["goes"], strict=True):
                path = base / f"{slug}.md"
                if fault is not None:
                    done.append("refused")
                elif goes:
                    done.append("deleted" if path.exists() else "absent")
                    path.unlink(missing_ok=True)
                elif wanted or not path.exists():
                    done.append("written" if wanted else "restored")
                    replace_file(path, text or "")
                else:
                    done.append("kept")
            yield pd.DataFrame({"slug": rows["slug"], "outcome": done})

    some = pages.select("slug", "text", F.coalesce("is_written", F.lit(True)).alias("is_written"), F.lit(False).alias("goes"))
    left = gone.join(pages.select("slug"), "slug", "left_anti").select("slug", F.lit(None).cast("string").alias("text"), F.lit(False).alias("is_written"), F.lit(True).alias("goes"))
    rows = some.unionByName(left).where("slug is not null").withColumn("fault", slug_violation(F.col("slug")))
    return staged(rows.mapInPandas(run, "slug string, outcome string"), "export")


def prune_empty(root: str) -> list[str]:
    """Removes the folders below root in which nothing is left, deepest first; root itself stays. The names of those removed."""
    base = Path(root.removeprefix("file://"))
    gone = []
    for at, _, _ in os.walk(base, topdown=False):
        here = Path(at)
        if here != base and not any(here.iterdir()):
            here.rmdir()
            gone.append(str(here.relative_to(base)))
    return gone
