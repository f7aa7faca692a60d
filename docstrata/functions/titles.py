"""Titles and versions as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docstrata.functions.canonical import stripped

SHORTEST_TITLE = 4
# Canonical titles that identify no page.
GENERIC_TITLES = """overview, settings, features, introduction, getting started, reference, index, home, configuration, usage, setup,
guide, quickstart, troubleshooting, examples, installation, api reference, readme, changelog, about, help, support, contributing,
license, prerequisites, migration, quick start, glossary, summary, notes, status, faqs, tutorials, samples, releases, limitations,
dependencies"""
GENERIC = tuple(" ".join(t.split()) for t in GENERIC_TITLES.split(","))


@F.pandas_udf(StringType())
def _folded(titles: pd.Series) -> pd.Series:
    return titles.map(lambda t: None if t is None else t.casefold())


def canonical_title(title: Column, ascii_only: bool = False) -> Column:
    """Case-folded, without surrounding blanks, final punctuation and page extensions. ascii_only spares the Python pass."""
    folded = F.lower(title) if ascii_only else F.when(title.rlike(r"^\p{ASCII}*\z"), F.lower(title)).otherwise(_folded(title))
    return stripped(F.regexp_replace(F.regexp_replace(stripped(folded), r"[.,!?]+\z", ""), r"(?:\.html|\.md|\.htm)+\z", ""))


def usable_title(canonical: Column) -> Column:
    """Long enough and not generic, so that two pages sharing it are likely one."""
    return (F.length(canonical) >= SHORTEST_TITLE) & ~canonical.isin(*GENERIC)


def version(raw: Column) -> Column:
    """The first semantic version in a text, else the text without one leading 'v' and one 'V'; null for blank."""
    text = stripped(raw)
    found = F.regexp_extract(text, r"(\d+\.\d+\.\d+(?:-[0-9A-Za-z.-]+)?)", 1)
    bare = stripped(F.regexp_replace(F.regexp_replace(text, "^v", ""), "^V", ""))
    return F.coalesce(F.nullif(found, F.lit("")), F.nullif(bare, F.lit("")))


def version_parts(text: Column) -> Column:
    """struct(major, minor, patch, pre) of a semantic version, null for other texts."""
    part = lambda n: F.regexp_extract(text, r"^(\d+)\.(\d+)\.(\d+)(?:-([0-9A-Za-z.-]+))?\z", n)
    return F.when(part(1) != "", F.struct(part(1).try_cast("int").alias("major"), part(2).try_cast("int").alias("minor"), part(3).try_cast("int").alias("patch"), F.nullif(part(4), F.lit("")).alias("pre")))
