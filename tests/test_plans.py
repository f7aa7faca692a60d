"""Plans: columns and filters reach the scan, no cross joins, one run of each text function."""

import re

import pytest
from pyspark.sql import functions as F

from docstrata.functions import links
from docstrata.operators.ledger import ChangeFeed
from docstrata.operators.snapshots import snapshots


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    wide = ", ".join(f"'x' as extra{n}" for n in range(5))
    made = {
        "files": f"select id as run_id, 'a' as source, 's' as slug, 't' as title, 'i' as source_id, 'h' as hash, timestamp'2025-01-01' as loaded_at, {wide} from range(10)",
        "runs": "select id as run_id, 'a' as source, timestamp'2025-01-01' as started, timestamp'2025-01-01' as completed, 'ok' as outcome from range(10)",
        "entries": f"select id as entry_id, 'a' as source, 's' as slug, 'h' as hash, '' as last_updated, timestamp'2025-01-01' as arrived_at, {wide} from range(10)",
        "docs": f"select id, 'a' as source, '[x](y.md)' as body, {wide} from range(10)",
    }
    for name, sql in made.items():
        spark.sql(sql).write.parquet(f"file://{tmp_path}/{name}")
    return lambda name: spark.read.parquet(f"file://{tmp_path}/{name}")


def test_only_needed_columns_are_read(tables):
    text = plan(snapshots(tables("files"), tables("runs")))
    assert "extra0" not in text and "title" not in text
    backlog = tables("entries").selectExpr("source", "arrived_at as after", "array(struct(arrived_at as started, entry_id as run_id)) as runs")
    text = plan(ChangeFeed.intake(None, tables("entries").where("arrived_at > timestamp'2025-01-01'"), backlog))
    assert "extra0" not in text and not re.search("CartesianProduct|NestedLoop", text) and re.search(r"PushedFilters: \[[^\]]*GreaterThan\(arrived_at", text)


def test_filters_reach_the_scan(tables):
    text = plan(tables("docs").where("source = 'a'").select("id", links.links(F.col("body")).alias("l")))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(source,a\)", text)


def test_text_functions_run_once(tables):
    assert plan(tables("docs").select("id", F.inline(links.links(F.col("body"))))).count("ArrowEvalPython") == 1
