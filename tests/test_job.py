import time

import pytest
from pyspark.sql import functions as F

from docstrata.convert.dialects import components
from docstrata.convert.registry import validated
from docstrata.functions import fences, links
from docstrata.functions.assets import AssetRules
from docstrata.operators.refresh import Store, asset_results, refresh, staged_media

PAGES = "source string, slug string, source_url string, source_id string, page_group string"


def pages(spark, *slugs, source="a"):
    return spark.createDataFrame([(source, s, f"https://x/{s}", f"id-{s.removesuffix('2')}", "g") for s in slugs], PAGES)


def texts(spark, source="a", **bodies):
    return spark.createDataFrame([(source, s, b) for s, b in bodies.items()] or [("none", "none", None)], "source string, slug string, body string")


def test_a_source_over_several_runs(spark, tmp_path, rows):
    store = Store(spark, f"file://{tmp_path}/s")
    sources = spark.createDataFrame([("a", True, "1"), ("b", True, "1")], "source string, generate_whats_new boolean, version string")
    convert = lambda docs: validated(docs, "html")
    page = lambda t: f"<h1>{t}</h1><p>x</p>"
    run = lambda p, t, now, **k: refresh(store, p, t, sources, now, convert, **k)

    first = run(pages(spark, "p", "q", "r"), texts(spark, p=page("P"), q=page("Q"), r=page("R")), "2025-01-01T00:00:00Z")
    assert first.version == 1 and first.changes.count() == 0 and store.changes().count() == 0  # a baseline logs nothing
    again = run(pages(spark, "p", "q", "r"), texts(spark, p=page("P"), q=page("Q"), r=page("R")), "2025-01-02T00:00:00Z")
    assert again.version is None and store.version() == 1
    third = run(pages(spark, "p2", "q", "r", "new"), texts(spark, p2=page("P"), q=page("Q changed"), r="plain text"), "2025-01-03T00:00:00Z")
    assert third.version == 2 and third.carried == 1
    assert rows(third.changes, "change_type", "slug", "matched_by") == [("modified", "q", None), ("renamed", "p2", "source_id")]
    stamps = {r.slug: r.d for r in store.read().select("slug", F.date_format("last_updated", "dd").alias("d")).collect()}
    assert stamps == {"p2": "03", "q": "03", "r": "01"}
    assert rows(store.changes(), "change_type", "change_date", "version") == [("modified", "2025-01-03", 2), ("renamed", "2025-01-03", 2)]
    stopped = run(pages(spark, "q"), texts(spark, q=page("Q changed")), "2025-01-04T00:00:00Z")
    assert stopped.stopped == {"a": "too many deletions"} and stopped.version is None and store.read().count() == 3
    both = run(pages(spark, "q").unionByName(pages(spark, "z", source="b")), texts(spark, source="b", z=page("Z")), "2025-01-05T00:00:00Z")
    assert both.version == 3 and rows(store.read().groupBy("source").count()) == [("a", 3), ("b", 1)]
    forced = run(pages(spark, "q"), texts(spark, q=page("Q changed")), "2025-01-06T00:00:00Z", force=True)
    assert forced.stopped == {"b": "no pages discovered"} and rows(store.read(), "source", "slug") == [("a", "q"), ("b", "z")]


def test_selected_sources_and_refused_runs(spark, tmp_path, rows):
    store = Store(spark, f"file://{tmp_path}/s")
    sources = spark.createDataFrame([("a", True, "1"), ("b", True, "1")], "source string, generate_whats_new boolean, version string")
    entry = lambda *r: spark.createDataFrame(list(r), "source string, slug string, title string, hash string")
    both = pages(spark, "p").unionByName(pages(spark, "z", source="b"))
    refresh(store, both, entry(("a", "p", "P", "1"), ("b", "z", "Z", "1")), sources, "2025-01-01T00:00:00Z")
    one = refresh(store, both, entry(("a", "p", "P", "2"), ("b", "z", "Z", "2")), sources, "2025-01-02T00:00:00Z", only=["b", "b"])
    assert rows(store.read(), "source", "hash") == [("a", "1"), ("b", "2")]
    assert [r.asDict() for r in one.report.collect()] == [{"source": "b", "discovered": 1, "fetched": 1, "carried": 0, "written": 1, "deleted": 0, "added": 0, "removed": 0, "modified": 1, "renamed": 0}]
    for only, why in ((["c"], "unknown sources: c"), ([], "no sources")):
        with pytest.raises(LookupError, match=why):
            refresh(store, both, entry(), sources, "2025-01-03T00:00:00Z", only=only)
    with pytest.raises(LookupError, match="no pages discovered"):
        refresh(store, both.where("false"), entry(), sources, "2025-01-03T00:00:00Z")
    assert store.version() == 2


def test_media_stage_of_a_run(spark, tmp_path, rows):
    store, rules = Store(spark, f"file://{tmp_path}/s"), AssetRules("media", ("/img/",), base_url="https://c/")
    sources = spark.createDataFrame([("a", True, "1")], "source string, generate_whats_new boolean, version string")
    texts_of = lambda *r: spark.createDataFrame(list(r), "source string, slug string, title string, text string, hash string")
    files = spark.createDataFrame([("p.png",), ("old.png",)], "asset_path string")
    done = refresh(store, pages(spark, "x/y", "z"), texts_of(("a", "x/y", "X", "![i](/img/p.png)", "h"), ("a", "z", "Z", "none", "h")), sources, "2025-01-01T00:00:00Z", media=rules, files=files)
    assert rows(done.media, "url") == [("https://c/p.png",)] and rows(done.unused) == [("old.png",)]
    assert rows(store.read().where(F.col("hash") == F.sha2(F.lit("![i](../media/p.png)"), 256)), "slug") == [("x/y",)]
    half = refresh(store, pages(spark, "x/y", "z"), texts_of(("a", "z", "Z", "none", "h")), sources, "2025-01-02T00:00:00Z", media=rules, files=files)
    assert rows(half.unused) == []  # a page was not fetched, so nothing is known to be unused


def test_links_of_converted_pages(spark, rows):
    docs = spark.createDataFrame([(1, "a", "g/x", "https://h", "# T\n\n[a](/g/y) [b](/none)"), (2, "a", "g/y", None, "# U\n\n[a](/g/x)"), (3, "b", "g/y", "https://b", None)], "id long, source string, slug string, site string, body string")
    good, bad = validated(docs, "markdown", key="id", pages=docs)
    assert rows(good, "id", "text") == [(1, "# T\n\n[a](./y.md) [b](https://h/none)"), (2, "# U\n\n[a](/g/x)")] and rows(bad, "id") == [(3,)]


def test_stubs(spark, rows):
    from docstrata.operators import stubs

    long = "# L\n\n" + "word " * 100
    docs = spark.createDataFrame([("a", "s", "See [t](./t.md)."), ("a", "t", "# T\n\nbody"), ("a", "u", "[x](gone.md)"), ("a", "two", "[t](t.md) [s](s.md)"), ("a", "self", "[x](self.md)"), ("a", "h", long + "\n\n[t](t.md)\n\nend"), ("b", "s", "[t](t.md)"), ("a", "n", None), ("a", "e", "")], "source string, slug string, text string")
    assert rows(stubs.stubs(docs, docs)) == [("a", "s", "t"), ("a", "self", "self")]
    got = {(r.source, r.slug): r.text for r in stubs.expanded(docs, docs).collect()}
    assert got == {(r.source, r.slug): r.text for r in docs.collect()} | {("a", "s"): "# T\n\nbody", ("a", "h"): long + "\n\n## T\n\nbody\n\nend"}
    assert stubs.expanded(docs.where("false"), docs).count() == 0


def test_snapshots_from_a_stream(spark, tmp_path, rows):
    from docstrata.streaming.updater import MissingVersion, SnapshotUpdater

    updater = SnapshotUpdater(spark, f"file://{tmp_path}/v", "source string, slug string, n long", ("n",), buckets=4)
    batch = lambda *r: spark.createDataFrame([("a", s, n) for s, n in r], "source string, slug string, n long")
    updater.fold(batch(*((f"p{k}", 1) for k in range(20))), 0)
    updater.fold(batch(("p3", 2), ("p3", 1), ("new", 1)), 1)
    updater.fold(batch(("p3", 2), ("p3", 1), ("new", 1)), 1)  # run again
    want = sorted([("a", f"p{k}", 2 if k == 3 else 1) for k in range(20)] + [("a", "new", 1)], key=repr)
    assert rows(updater.latest(), "source", "slug", "n") == want
    assert len(list((tmp_path / "v" / "version=2").glob("bucket=*"))) <= 2  # only what the batch touched is written
    updater.fold(batch(), 2)
    assert rows(updater.latest(), "source", "slug", "n") == want
    (tmp_path / "v" / "version=2" / "_SUCCESS").unlink()
    with pytest.raises(MissingVersion):
        updater.fold(batch(("p1", 9)), 3)
    with pytest.raises(MissingVersion):
        updater.at(7)


def test_media(spark, rows):
    rules = AssetRules("media", ("/img/",), base_url="https://c/")
    df = spark.createDataFrame([("a", "x/y", "![i](/img/p.png)", "h"), ("a", "z", "none", "h")], "source string, slug string, text string, hash string")
    done, plan, prune = staged_media(df, rules, spark.createDataFrame([("p.png",), ("old.png",)], "asset_path string"), all_fresh=True)
    assert rows(done, "slug", "text") == [("x/y", "![i](../media/p.png)"), ("z", "none")] and rows(plan, "url") == [("https://c/p.png",)] and rows(prune) == [("old.png",)]
    made = lambda *r: spark.createDataFrame(list(r), "asset_path string, digest string")
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "asset_path string")
    assert rows(asset_results(wanted, made(("a", "1"), ("b", "2")), made(("a", "1"), ("b", "x")))) == [("a", "cached"), ("b", "written"), ("c", "failed")]


#: Budgets in seconds for adversarial inputs on an unhurried machine; a slow one gets four times as long.
BUDGETS = {
    "shield unclosed fences": (2.0, lambda: fences.shielded("```js\n" * 20_000, "component")),
    "spans of unclosed fences": (2.0, lambda: fences.indented_spans("```js\n" * 20_000)),
    "rewrite unterminated links": (2.0, lambda: links.rewritten("[x](/a" * 8_000, "p", lambda s: True, "https://s")),
    "rewrite unterminated angle links": (2.0, lambda: links.rewritten("[x](</a" * 8_000, "p", lambda s: True, "https://s")),
    "rewrite link openers": (2.0, lambda: links.rewritten("](" * 8_000, "p", lambda s: True, "https://s")),
    "malformed component tags": (5.0, lambda: components('<Card title="x' * 20_000)),
    "unclosed components": (5.0, lambda: components("<Note>" * 20_000)),
    "long unterminated links": (2.0, lambda: links.links_of("[a](b " * 12_000)),
    "restore blocks": (1.0, lambda: fences.restored("".join(f"\x02{n}\x03" for n in range(20_000)), ["x"] * 20_000)),
    "mask backticks": (0.05, lambda: links.masked("`" * 8_000)),
}


@pytest.mark.parametrize("name", BUDGETS)
def test_budgets(name):
    most, run = BUDGETS[name]
    took = []
    for _ in range(2):
        t = time.process_time()
        run()
        took.append(time.process_time() - t)
    assert min(took) < 4 * most
