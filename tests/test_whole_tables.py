"""Registered queries take all rows of their tables, not those of one source or shape."""

import pytest

import __spark_entry__ as entry

SLUGS = ("index", "guide", "a/b")


@pytest.fixture
def folder(spark, tmp_path):
    homes = [(s, f"https://docs.{s}.example") for s in ("ovenlark", "tarnbox", "mossgate")]
    pages = [(s, p, home if p == "index" else f"{home}/{p}/?x=1#top", n) for s, home in homes for n, p in enumerate(SLUGS)]
    bodies = ["<h2>T</h2><p>x</p>", "<ul><li>x</li></ul>", "<table><tr><td>x</td></tr></table>", "<h1>T</h1>", "# T\n\nx\n", None]
    raw = [(n, "tarnbox", "guide", b) for n, b in enumerate(bodies)]
    made = {"raw_docs": (raw, "raw_id long, source string, slug string, body string"), "doc_sources": (homes, "source string, home_url string"), "pages": (pages, "source string, slug string, source_url string, ordinal int")}
    for name, (data, columns) in made.items():
        spark.createDataFrame(data, columns).write.parquet(f"file://{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_addresses_of_every_source_are_discovered(spark, folder, rows):
    got = rows(entry.queries()["address_discovery"](spark, folder))
    assert got == sorted((s, p, n) for s in ("ovenlark", "tarnbox", "mossgate") for n, p in enumerate(SLUGS))


def test_pages_of_the_top_level_are_in_the_trees(spark, folder, rows):
    got = rows(entry.queries()["tree_discovery"](spark, folder))
    assert got == sorted((s, p, n) for s in ("ovenlark", "tarnbox", "mossgate") for n, p in enumerate(SLUGS))


def test_every_body_is_converted_and_every_page_or_failure_reported(spark, folder, rows):
    queries = entry.queries()
    assert [r[0] for r in rows(queries["html_to_markdown"](spark, folder), "raw_id")] == [0, 1, 2, 3, 4]
    pages = rows(queries["converted_pages"](spark, folder), "raw_id", "title")
    failed = rows(queries["html_conversion_failures"](spark, folder))
    assert (0, "T") in pages and (3, "T") in pages
    assert sorted([r[0] for r in pages] + [r[0] for r in failed]) == [0, 1, 2, 3, 4]
