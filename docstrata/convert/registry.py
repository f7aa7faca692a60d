"""Converters by dialect, and their use on columns."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from docstrata.convert.dialects import astro, components, mdx, vitepress
from docstrata.convert.html_docs import html_to_markdown
from docstrata.functions.links import rewritten
from docstrata.functions.markdown import is_markdown, title
from docstrata.functions.text import content_hash
from docstrata.runtime import staged

DIALECTS: dict[str, Callable[[str], str]] = {"html": html_to_markdown, "vitepress": vitepress, "mdx": mdx, "components": components, "astro": astro, "markdown": lambda t: t}
_RESULT = StructType([StructField("text", StringType()), StructField("error", StringType())])


def register(name: str, convert: Callable[[str], str]) -> None:
    """Adds a dialect: text in, Markdown out."""
    DIALECTS[name] = convert


def converted(text: Column, dialect: str) -> Column:
    """struct(text, error): an exception is the page's error, not the job's."""
    change = DIALECTS[dialect]

    def one(t: str | None) -> tuple[str | None, str | None]:
        if t is None:
            return None, "no text"
        try:
            return change(t), None
        except Exception as e:
            return None, f"{type(e).__name__}: {e}"[:500]

    def batch(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(t) for t in texts], columns=["text", "error"])

    return F.pandas_udf(batch, _RESULT).asNondeterministic()(text)


def rewritten_links(text: Column, slug: Column, known: Column, site: Column) -> Column:
    """Site links become relative where their page is in known (array of slugs of the page's own links), else upstream; without a site a text stays."""

    def batch(texts: pd.Series, slugs: pd.Series, knowns: pd.Series, sites: pd.Series) -> pd.Series:
        out = []
        for t, s, k, base in zip(texts, slugs, knowns, sites, strict=True):
            have = frozenset(() if k is None else k)
            out.append(t if t is None or base is None else rewritten(t, s or "", have.__contains__, base))
        return pd.Series(out, dtype=object)

    return F.pandas_udf(batch, StringType())(text, slug, known, site)


_SITE_LINK = r"\]\(\s*<?((?:[A-Za-z][A-Za-z0-9+.-]*:)?/[^)\s>]*)"


def linked(rows: DataFrame, key: str, pages: DataFrame, text: str = "text") -> DataFrame:
    """Site links of the texts rewritten: rows have key (unique), source, slug, site (may be null: no site) and the text.

    Links to pages (source, slug) become relative, others of the site upstream addresses. Only the slugs that a text
    links to travel with it; a key has one row however many.
    """
    base = F.rtrim("site", F.lit("/"))
    href = rows.where(F.col("site").isNotNull()).select(key, "source", base.alias("_base"), F.explode(F.regexp_extract_all(text, F.lit(_SITE_LINK), F.lit(1))).alias("_href"))
    path = F.when(F.startswith("_href", F.concat("_base", F.lit("/"))), F.substr(F.col("_href"), F.length("_base") + 1)).otherwise(F.col("_href"))
    wanted = href.select(key, "source", F.regexp_replace(F.regexp_replace(F.regexp_replace(path, r"(?s)[?#].*\z", ""), r"^/+|/+\z", ""), r"\.md\z", "").alias("slug"))
    wanted = wanted.select(key, "source", F.when(F.col("slug") == "", "index").otherwise(F.col("slug")).alias("slug")).distinct()
    known = wanted.join(pages.select("source", "slug").distinct(), ["source", "slug"]).groupBy(key).agg(F.collect_set("slug").alias("_known"))
    done = rows.join(known, key, "left")
    changed = rewritten_links(F.col(text), F.col("slug"), F.col("_known"), F.col("site"))
    return done.withColumn(text, changed).drop("_known")


def validated(docs: DataFrame, dialect: str, body: str = "body", key: str | None = None, pages: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(pages with text, hash and title; failures with their error), from one staged conversion.

    A conversion runs once a row: its result is a table before it is checked, hashed and titled. With pages and the key
    of docs, which then have source, slug and site, the links of converted texts are rewritten as well.
    """
    done = staged(docs.withColumn("_c", converted(F.col(body), dialect)).withColumns({"text": F.col("_c.text"), "error": F.col("_c.error")}).drop("_c", body), "converted")
    if pages is not None:
        done = staged(linked(done, key, pages), "linked")
    valid = F.col("error").isNull() & is_markdown(F.col("text"))
    pages = done.where(valid).drop("error").withColumn("hash", content_hash(F.col("text"))).withColumn("title", title(F.col("text"), F.lit("Untitled")))
    failures = done.where(~F.coalesce(valid, F.lit(False))).withColumn("error", F.coalesce("error", F.lit("not Markdown"))).drop("text")
    return pages, failures
