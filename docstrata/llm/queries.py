"""Queries of the training-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.llm import extract, leaks, packing, prose, residue
from docstrata.runtime import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    docs, runs = table(spark, d, "raw_docs"), table(spark, d, "run_metadata")
    bodies = residue.residue_records(docs.select("raw_id", "source", "body"), "raw_id", "source", "body").where("is_residue")
    elements = residue.bad_elements(runs.select("meta_id", "failed_pages"), "meta_id", "failed_pages")
    return bodies.select(F.lit("raw_docs").alias("table_name"), F.col("raw_id").alias("record_id"), F.lit(-1).alias("elem_pos")).unionByName(elements.select(F.lit("run_metadata").alias("table_name"), F.col("meta_id").alias("record_id"), "elem_pos"))


def p2_clean_docs(spark: SparkSession, d: str) -> DataFrame:
    """raw_docs without residue and null bodies."""
    docs = table(spark, d, "raw_docs").select("raw_id", "source", "body")
    return residue.without_residue(docs, "raw_id", "source", "body").select("raw_id", F.length("body").alias("chars"))


def p2_clean_lists(spark: SparkSession, d: str) -> DataFrame:
    """run_metadata.failed_pages without elements that are no slugs."""
    runs = table(spark, d, "run_metadata").select("meta_id", "failed_pages")
    return residue.without_bad_elements(runs, "failed_pages").select("meta_id", F.size("failed_pages").alias("pages"), F.array_join("failed_pages", "\n").alias("failed_pages"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    done = extract.converted(table(spark, d, "raw_docs").select("raw_id", "body"), "body")
    return done.select("raw_id", F.explode("markups").alias("markup"))


def p5_text(spark: SparkSession, d: str) -> DataFrame:
    """The clean text of every body."""
    return extract.converted(table(spark, d, "raw_docs").select("raw_id", "body"), "body").select("raw_id", "clean_text")


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    windows = [(r[0], r[1]) for r in table(spark, d, "pack_windows").select("window_id", "capacity").orderBy("window_id").collect()]
    return packing.packed(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", windows)


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers of each capacity are."""
    return packing.fill(p6_containers(spark, d), table(spark, d, "pack_windows"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    docs, items = table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "eval_items").select("item_id", "text")
    return leaks.leaks(docs, "doc_id", "text", items, "item_id", "text")


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """How many documents contain each item that leaked, by suite."""
    found = p7_found(spark, d).groupBy("item_id").agg(F.count("*").alias("documents"))
    return found.join(table(spark, d, "eval_items").select("item_id", "suite"), "item_id")


def p8_stats(spark: SparkSession, d: str) -> DataFrame:
    """Statistics, outlier score and verdict of every document with a text."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    return prose.scored_documents(docs, "doc_id", "text", "lang", table(spark, d, "common_words"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return prose.not_prose(p8_stats(spark, d)).select("doc_id")


QUERIES = {q.__name__: q for q in (p2_found, p2_clean_docs, p2_clean_lists, p5_found, p5_text, p6_containers, p6_fill, p7_found, p7_items, p8_found, p8_stats)}
SQL: dict[str, str] = {}
