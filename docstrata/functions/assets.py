"""References to assets: extraction, download plan, rewriting."""

from __future__ import annotations

import posixpath
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docstrata.functions.urls import asset_path


@dataclass(frozen=True)
class AssetRules:
    """Where a source's assets are and which references count. Prefixes end in '/', subdir is one path segment."""

    subdir: str
    prefixes: tuple[str, ...]
    base_url: str = ""
    strip_depth: int = 0
    extensions: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        if not self.subdir or self.subdir in (".", "..") or re.search(r"[/\\]", self.subdir):
            raise ValueError("subdir must be one safe path segment")
        if not self.prefixes or any(not p.endswith("/") for p in self.prefixes):
            raise ValueError("every prefix must end in '/'")
        if self.strip_depth < 0 or (self.base_url and not self.base_url.endswith("/")):
            raise ValueError("strip_depth must not be negative and base_url must end in '/'")

    @property
    def pattern(self) -> str:
        return "(" + "|".join(map(re.escape, self.prefixes)) + r")([^\s)\"'<>]+)"


def references(texts: DataFrame, text: str, rules: AssetRules) -> DataFrame:
    """Adds (ref_pos, raw, asset_path, url): one row per reference that counts, in the order of the text, from 0."""
    whole = F.regexp_extract_all(text, F.lit(rules.pattern), F.lit(0))
    rows = texts.select(*texts.columns, F.posexplode(whole).alias("ref_pos", "raw"))
    prefix = F.regexp_extract("raw", rules.pattern, 1)
    rest = F.regexp_replace(F.regexp_extract("raw", rules.pattern, 2), r"(?s)[?#].*\z", "")
    rows = rows.withColumn("_rest", rest).withColumn("_prefix", prefix)
    if rules.extensions is not None:
        rows = rows.where(F.lower(F.regexp_extract("_rest", r"[^/.](\.[^./]*)\z", 1)).isin(*rules.extensions))
    inner = F.col("_rest")
    if rules.strip_depth:
        rows = rows.where(F.size(F.split("_rest", "/")) > rules.strip_depth)
        parts = F.split("_rest", "/")
        inner = F.array_join(F.slice(parts, rules.strip_depth + 1, F.size(parts)), "/")
    rows = rows.withColumn("asset_path", asset_path(inner)).where("asset_path is not null")
    url = F.concat(F.lit(rules.base_url), F.col("asset_path")) if rules.base_url else F.concat("_prefix", "_rest")
    return rows.withColumn("url", url).drop("_rest", "_prefix")


def download_plan(refs: DataFrame, order: str, subdir: str) -> DataFrame:
    """(asset_path, url, local_path): the first reference to each path, by page order, then position."""
    first = Window.partitionBy("asset_path").orderBy(order, "ref_pos")
    return refs.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("asset_path", "url", F.concat(F.lit(subdir + "/"), F.col("asset_path")).alias("local_path"))


def prunable(files: DataFrame, refs: DataFrame, all_fresh: bool) -> DataFrame:
    """Files (asset_path) that no page refers to. None where a page was not fetched anew or nothing is referred to."""
    used = refs.select("asset_path").distinct()
    if not all_fresh or used.isEmpty():
        return files.where("false")
    return files.join(used, "asset_path", "left_anti")


def rewritten_refs(text: str, slug: str, rules: AssetRules) -> str:
    """References that count become links relative to the page; relative ones no longer match, so it is idempotent."""
    base = posixpath.dirname(slug) or "."

    def change(m: re.Match[str]) -> str:
        rest = re.split(r"[?#]", m[2], maxsplit=1)[0]
        if rules.extensions is not None and posixpath.splitext(rest)[1].lower() not in rules.extensions:
            return m[0]
        parts = rest.split("/")
        if len(parts) <= rules.strip_depth or "\\" in rest:
            return m[0]
        path = posixpath.normpath("/".join(parts[rules.strip_depth :]))
        if path in (".", "..") or path.startswith(("../", "/")):
            return m[0]
        return posixpath.relpath(f"{rules.subdir}/{path}", base)

    return re.sub(rules.pattern, change, text)


def rewrite(text: Column, slug: Column, rules: AssetRules) -> Column:
    @F.pandas_udf(StringType())
    def changed(texts: pd.Series, slugs: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else rewritten_refs(t, s or "", rules) for t, s in zip(texts, slugs, strict=True)])

    return changed(text, slug)
