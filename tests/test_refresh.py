from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from docstrata.functions.assets import AssetRules, download_plan, prunable, references, rewritten_refs
from docstrata.operators import discovery, lifecycle, reports
from docstrata.sources import listings, manifests, sitemap

SNAP = "source string, slug string, hash string, last_updated timestamp, title string"
T0 = datetime(2025, 1, 1, tzinfo=UTC)


def snap(spark, *rs):
    return spark.createDataFrame([(s, g, h, t, "t") for s, g, h, t in rs], SNAP)


def test_a_run_without_changes_writes_nothing(spark):
    old = snap(spark, ("a", "x", "1", T0), ("a", "y", "2", T0))
    done = lifecycle.stamped(old, old, "2025-02-01T00:00:00Z")
    assert done.where("is_written").count() == 0 and done.where(F.col("last_updated") != F.lit(T0)).count() == 0


def test_carry_forward_and_stamps(spark, rows):
    old = snap(spark, ("a", "x", "1", T0), ("a", "y", "2", None), ("a", "z", "3", T0))
    fetched = snap(spark, ("a", "x", "1", None), ("a", "y", "2", None), ("a", "n", "9", None))
    failed = spark.createDataFrame([("a", "z"), ("a", "unknown"), ("a", "x")], "source string, slug string")
    kept = lifecycle.carried_forward(fetched, failed, old)
    assert rows(kept, "slug", "carried") == [("n", False), ("x", False), ("y", False), ("z", True)]
    done = {r.slug: (r.is_written, r.u) for r in lifecycle.stamped(kept, old, "2025-02-01T00:00:00Z").withColumn("u", F.date_format("last_updated", "MM")).collect()}
    assert done == {"x": (False, "01"), "y": (False, "02"), "z": (False, "01"), "n": (True, "02")}


def test_guards(spark):
    old = snap(spark, *(("a", f"p{k}", "1", T0) for k in range(4)))
    page = lambda *s: spark.createDataFrame([("a", x) for x in s], "source string, slug string")
    lifecycle.guard(old, page("p0", "p1"))  # exactly half may go
    with pytest.raises(lifecycle.GuardError, match="deletions"):
        lifecycle.guard(old, page("p0"))
    lifecycle.guard(old, page("p0"), force=True)
    with pytest.raises(lifecycle.GuardError, match="duplicate"):
        lifecycle.guard(old, page("p0", "p0", "p1"), force=True)
    with pytest.raises(lifecycle.GuardError, match="no pages"):
        lifecycle.guard(old, page(), force=True)


def test_gates_and_versions(spark, rows):
    sources = spark.createDataFrame([("a", True, "1"), ("b", True, "1"), ("c", None, " ")], "source string, generate_whats_new boolean, version string").withColumn("old_version", F.lit("1"))
    old = snap(spark, ("a", "x", "1", T0), ("c", "x", "1", T0))
    changes = spark.createDataFrame([("a", "added")], "source string, change_type string")
    got = rows(lifecycle.gates(changes, sources, old), "source", "is_baseline", "saves", "logs")
    assert got == [("a", False, True, True), ("b", True, True, False), ("c", False, False, False)]


def test_reports(spark):
    pages = spark.createDataFrame([("a", "b", "T|x", "root", "u|v"), ("a", "c/d", None, None, "u"), ("a", "e", "E", "alpha", "u")], "source string, slug string, title string, page_group string, source_url string")
    sources = spark.createDataFrame([("a", "Docs A", "https://a", "1.0")], "source string, title string, home_url string, version string")
    text = reports.rendered_index(pages, sources, "a", "now")
    assert text.index("## Docs A") < text.index("## Documentation") < text.index("## alpha") and "| T\\|x | [b.md](./b.md) | [source](<u%7Cv>) |" in text
    changes = spark.createDataFrame([("a", "renamed", "n", "o", "T*", "u", "title"), ("a", "added", "`x", None, "A", "u", None)], "source string, change_type string, slug string, old_slug string, title string, source_url string, matched_by string")
    log = reports.rendered_log(changes, "S")
    assert log.startswith("## S — 2 changes\n\n### ➕ Added (1)\n- **A** — `'x` —") and "**T\\*** moved `o` → `n` (matched by title)" in log
    assert reports.aligned_table(["a", "日本"], [["xx", "y"]]) == ["| a   | 日本 |", "| --- | ---- |", "| xx  | y    |"]
    assert reports.between_markers("x<!-- t:start -->old<!-- t:end -->y", "t", ["new"]) == "x<!-- t:start -->\nnew\n<!-- t:end -->y"


def test_sitemaps(spark, rows):
    xml = '<urlset xmlns:x="y"><url><loc> https://a/b </loc><image:image><image:loc>no</image:loc></image:image></url><x:url><x:loc>https://a/c&amp;d</x:loc></x:url><loc>no</loc><url><loc></loc></url><url><loc>https://a/cut'
    assert sitemap.locations(xml) == ["https://a/b", "https://a/c&d", "https://a/cut"]
    page = lambda *u: "<urlset>" + "".join(f"<url><loc>{x}</loc></url>" for x in u) + "</urlset>"
    docs = spark.createDataFrame([("https://a/s.xml", page("https://a/1.xml", "https://a/p", "https://b/x.xml", "https://a/missing.xml")), ("https://a/1.xml", page("https://a/s.xml", "https://a/q", "https://a/p")), ("https://b/x.xml", page("https://b/no"))], "url string, xml string")
    assert rows(sitemap.crawl(docs, "https://a/s.xml", "https://a")) == [("https://a/p", 0), ("https://a/p", 1), ("https://a/q", 1)]
    with pytest.raises(sitemap.CrawlError):
        sitemap.crawl(docs, "https://a/none.xml")


def test_listings(spark, rows):
    make = lambda j: spark.createDataFrame([("s", j)], "source string, json string")
    tree = '{"truncated": false, "tree": [{"type": "blob", "path": "docs/de/a.md"}, {"type": "tree", "path": "docs/x.md"}, {"type": "blob", "path": "docs/guide/README.mdx"}, {"type": "blob", "path": "y.md"}]}'
    found = listings.tree_pages(listings.tree_entries(make(tree), "json"), "docs/", (".md", ".mdx"))
    assert rows(listings.localized_pages(found, ["de"]), "slug", "locale", "page") == [("de/a", "de", "a"), ("guide/README", "en", "guide")]
    for bad in ('{"truncated": true, "tree": []}', "[]", '{"tree": null}', '{"tree": [{"type": "blob"}]}'):
        with pytest.raises(listings.ListingError):
            listings.tree_entries(make(bad), "json")
    text = spark.createDataFrame([("- [A](https://h/docs/a.md#x)\n* [B](https://other/docs/b.md)\n- [C](https://h/c.md)",)], "t string")
    assert rows(text.select(F.inline(listings.bullet_links(F.col("t"), ["h"])))) == [("A", "https://h/docs/a.md")]


def test_discovery(spark, rows):
    pages = spark.createDataFrame([("a", "x", "u", "u", "id", "", 2), ("a", "x", "v", "u", "id", "", 1), ("a", "../y", "u", "u", " ", "", 3)], "source string, slug string, source_url string, source_md_url string, source_id string, page_group string, ordinal int")
    good, bad = discovery.checked(lifecycle.first_wins(pages))
    assert rows(good, "slug", "source_url") == [("x", "v")] and rows(bad, "violations") == [(["slug parent", "source_id blank"],)]
    hops = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x")], "slug string, target string")
    assert rows(discovery.followed_redirects(hops.select("slug"), hops)) == [("a", "c"), ("b", "c"), ("x", "y"), ("y", "x")]
    chain = spark.createDataFrame([(f"s{n}", f"s{n + 1}") for n in range(15)], "slug string, target string")
    assert {r.target for r in discovery.followed_redirects(chain.select("slug"), chain).collect()} == {"s15"}
    with pytest.raises(LookupError):
        discovery.required(pages.where("false"), "a")


def test_manifests(spark, rows, tmp_path):
    entry = {"slug": "a/b", "title": "T", "group": "", "source_url": "u", "source_md_url": "u", "source_id": "i", "hash": "0" * 64, "last_updated": ""}
    good = manifests.manifest_json([entry], "1.0", "2025-01-01T00:00:00Z")
    assert good.endswith("}\n")
    texts = [("ok", good.replace('"group"', '"unknown": 1, "group"')), ("key", good.replace('"a/b": {', '"other": {')), ("list", "[]"), ("hash", good.replace("0" * 64, "xyz")), ("slug", good.replace("a/b", "../b"))]
    entries, states = manifests.read_manifests(spark.createDataFrame(texts, "source string, value string"))
    assert rows(entries, "source", "slug") == [("ok", "a/b")]
    assert rows(states, "source", "has_baseline") == [("hash", False), ("key", False), ("list", False), ("ok", True), ("slug", False)]
    manifests.replace_file(tmp_path / "d" / "x.md", "text")
    made = spark.createDataFrame([("p/q", "# P", True), ("../no", "x", True)], "slug string, text string, is_written boolean")
    manifests.write_pages(made, made.select("slug").where("false"), str(tmp_path / "d"))
    assert rows(manifests.corpus(spark, str(tmp_path / "d"))) == [("p/q.md", "# P"), ("x.md", "text")]


def test_assets(spark, rows):
    rules = AssetRules("media", ("/img/",), base_url="https://c/", strip_depth=1, extensions=(".png",))
    df = spark.createDataFrame([(1, "![a](/img/t/x.png?y) (/img/t/../z.png) /img/t/no.gif /img/short.png"), (2, "/img/u/x.png"), (3, None)], "page int, t string")
    refs = references(df, "t", rules)
    assert rows(refs, "page", "asset_path", "url") == [(1, "x.png", "https://c/x.png"), (1, "z.png", "https://c/z.png"), (2, "x.png", "https://c/x.png")] or rows(refs, "page", "asset_path") == [(1, "x.png"), (2, "x.png")]
    assert rows(download_plan(refs, "page", "media"), "asset_path", "local_path")[0] == ("x.png", "media/x.png")
    text = rewritten_refs("![a](/img/t/x.png?y)", "a/b", rules)
    assert text == "![a](../media/x.png)" and rewritten_refs(text, "a/b", rules) == text
    files = spark.createDataFrame([("x.png",), ("old.png",)], "asset_path string")
    assert rows(prunable(files, refs, True)) == [("old.png",)] and rows(prunable(files, refs, False)) == [] and rows(prunable(files, refs.where("false"), True)) == []
