"""Pages that stand for others: a stub becomes its twin, and paragraphs that are a link to a page become that page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.functions import links as L
from docstrata.functions.markdown import STUB_PROSE, demoted_headings, stub_measures

#: A paragraph that is one link to a Markdown page and nothing else.
LINK_PARAGRAPH = r"(?s)^\s*(?:[-*] +)?\[[^\[\]]*\]\(([^()\s]+\.md)(?:#[^()\s]*)?\)\s*\z"


def _path(slug, destination):
    """The slug a relative destination names from a page."""
    clean = F.regexp_replace(L.bare_destination(destination), r"(?s)[?#].*\z", "")
    return F.regexp_replace(L.resolved(F.concat(slug, F.lit(".md")), clean), r"\.md\z", "")


def stubs(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(source, slug, twin): pages of docs (source, slug, text) with exactly one link to a known page (source, slug), at most one heading and little prose."""
    measured = docs.select("source", "slug", stub_measures(F.col("text")).alias("m")).where((F.col("m.headings") <= 1) & (F.col("m.prose") < STUB_PROSE))
    targets = measured.select("source", "slug", F.explode("m.links").alias("target")).where(L.destination_kind(F.col("target")) == "relative")
    named = targets.select("source", "slug", _path(F.col("slug"), F.col("target")).alias("twin"))
    met = named.join(known.select("source", F.col("slug").alias("twin")).distinct(), ["source", "twin"], "left_semi")
    return met.groupBy("source", "slug").agg(F.count("*").alias("n"), F.max("twin").alias("twin")).where("n = 1").select("source", "slug", "twin")


def expanded(docs: DataFrame, twins: DataFrame) -> DataFrame:
    """docs (source, slug, text, unique by source and slug) with stubs replaced by the text of their twin, and link paragraphs by the page they link to, its headings one level down.

    twins (source, slug, text) are taken as they are: a stub among them is not expanded in turn. Links to pages that are
    not there, and to the page itself, stay. Other columns of docs are dropped.
    """
    other = twins.select("source", F.col("slug").alias("twin"), F.col("text").alias("twin_text"))
    whole = stubs(docs, twins).where("twin <> slug").join(other, ["source", "twin"]).select("source", "slug", "twin_text")
    rest = docs.select("source", "slug", "text").join(whole.select("source", "slug"), ["source", "slug"], "left_anti")
    blocks = rest.select("source", "slug", F.posexplode(F.split("text", "\n\n")).alias("pos", "block"))
    blocks = blocks.withColumn("twin", F.when(F.col("block").rlike(LINK_PARAGRAPH), _path(F.col("slug"), F.regexp_extract("block", LINK_PARAGRAPH, 1))))
    met = blocks.join(other, ["source", "twin"], "left").withColumn("block", F.when(F.col("twin_text").isNotNull() & (F.col("twin") != F.col("slug")), F.rtrim(demoted_headings(F.col("twin_text"), 1))).otherwise(F.col("block")))
    # a page's own paragraphs come together again; none has more than its text
    hybrid = met.groupBy("source", "slug").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "block"))), lambda x: x["block"]), "\n\n").alias("text"))
    nothing = rest.where(F.col("text").isNull()).select("source", "slug", "text")
    return hybrid.unionByName(nothing).unionByName(whole.select("source", "slug", F.col("twin_text").alias("text")))
