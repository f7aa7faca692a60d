"""Queries of the text operators over fetched bodies, of sources and of streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.convert.registry import converted, validated
from docstrata.functions import assets, links
from docstrata.functions import markdown as M
from docstrata.functions.canonical import digest, instant
from docstrata.functions.text import LOG_ESCAPES, content_hash, display_width, iso_stamp, log_escaped, section_title
from docstrata.functions.urls import clean_url
from docstrata.operators import discovery, reports
from docstrata.plans import text_sql
from docstrata.plans.reference import _KIND
from docstrata.runtime import fresh_path, small, staged, table
from docstrata.sources import listings, sitemap
from docstrata.streaming.updater import SnapshotUpdater, late_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def sql_log_escaped(column: str) -> str:
    for a, b in LOG_ESCAPES:
        a, b = (" || ".join("chr(10)" if c == "\n" else "chr(13)" if c == "\r" else f"'{c}'" for c in s) for s in (a, b))
        column = f"replace({column}, {a}, {b})"
    return column


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _bodies(spark, d):
    return table(spark, d, "raw_docs").select("raw_id", "source", "slug", "body").where("body is not null")


_BOM = "regexp_replace(body, '^' || chr(65279) || '+', '')"


_VALID = rf"(regexp_matches({_BOM}, '\A\s*---[ \t]*\r?\n([^\n]*\n)*?---[ \t]*(\r?\n|\z)') OR regexp_matches({_BOM}, '(?m)^\s*#{{1,6}}\s+\S') OR regexp_matches({_BOM}, '(?m)^[^\n]*[^-=\s][^\n]*\n[-=]{{2,}}[ \t\r]*$')) AND NOT regexp_matches(lower(substr({_BOM}, 1, 512)), '<!doctype|<html')"


@query(f"SELECT raw_id, {_VALID} AS is_markdown FROM raw_docs WHERE body IS NOT NULL")
def markdown_valid(spark, d):
    return _bodies(spark, d).select("raw_id", M.is_markdown(F.col("body")).alias("is_markdown"))


@query(text_sql.MARKDOWN_TITLES)
def markdown_titles(spark, d):
    return _bodies(spark, d).select("raw_id", M.title(F.col("body"), F.col("slug")).alias("title"))


@query(text_sql.FENCE_SPANS)
def fence_spans(spark, d):
    """Fenced blocks by each of the five grammars."""
    return _bodies(spark, d).where("body rlike '```|~~~'").select("raw_id", F.inline(M.all_code_spans(F.col("body"))))


@query(text_sql.FENCES_STRIPPED)
def fences_stripped(spark, d):
    return _bodies(spark, d).select("raw_id", F.length(M.without_code(F.col("body"), "title")).alias("chars"))


@query(r"SELECT raw_id, length(regexp_replace(body, '[\p{Cf}\p{Cc}]', '', 'g')) + (length(body) - length(regexp_replace(body, '[\t\n\r]', '', 'g'))) AS chars FROM raw_docs WHERE body IS NOT NULL")
def invisible_stripped(spark, d):
    return _bodies(spark, d).select("raw_id", F.length(M.visible(F.col("body"))).cast("long").alias("chars"))


@query(text_sql.BLANK_RUNS)
def blank_runs_collapsed(spark, d):
    return _bodies(spark, d).select("raw_id", F.length(M.collapsed(F.col("body"))).alias("chars"))


@query(text_sql.FRONT_FIELDS)
def front_matter_fields(spark, d):
    front = _bodies(spark, d).where(F.col("body").rlike(r"^﻿?\s*---")).select("raw_id", M.front_matter(F.col("body")).alias("f"))
    return front.select("raw_id", F.explode("f.fields").alias("field", "value"))


@query(text_sql.HEADINGS_DEMOTED)
def headings_demoted(spark, d):
    return _bodies(spark, d).select("raw_id", content_hash(M.demoted_headings(F.col("body"), 1)).alias("hash"))


@query(text_sql.STUB_PAGES)
def stub_pages(spark, d):
    return _bodies(spark, d).where(M.stub(F.col("body"))).select("raw_id")


def _links(spark, d):
    return _bodies(spark, d).select("raw_id", "source", "slug", F.inline(links.links(F.col("body"))))


@query(f"""{text_sql.DOCUMENT_LINKS_CTE} SELECT raw_id, CAST(n AS INT) AS line, target, {_KIND} AS kind FROM links""")
def document_links(spark, d):
    return _links(spark, d).select("raw_id", "line", "target", links.destination_kind(F.col("target")).alias("kind"))


@query(text_sql.BROKEN_LINKS)
def broken_document_links(spark, d):
    """Relative links whose page is not in the page set: no page of that path, and no README or index below it."""
    pages = table(spark, d, "pages").select("source", F.col("slug").alias("path")).distinct()
    directory = F.regexp_replace("path", r"(?:^|/)(?:README|index)\z", "/")
    keys = pages.unionByName(pages.where(F.col("path").rlike(r"(?:^|/)(?:README|index)\z")).select("source", directory.alias("path")))
    rows = _links(spark, d).where(links.destination_kind(F.col("target")) == "relative")
    clean = F.regexp_replace(links.resolved(F.concat("slug", F.lit(".md")), F.regexp_replace(links.bare_destination(F.col("target")), r"(?s)[?#].*\z", "")), r"\.md\z", "")
    known = rows.withColumn("path", clean).where(F.regexp_replace(links.bare_destination(F.col("target")), r"(?s)[?#].*\z", "") != "")
    rules = small(table(spark, d, "doc_sources").select("source", "illustrative_link_targets"))
    counted = known.join(rules, "source", "left").where(~F.coalesce(F.array_contains("illustrative_link_targets", F.col("target")), F.lit(False)))
    return counted.join(keys, ["source", "path"], "left_anti").select("raw_id", "line", "target")


_RULES = assets.AssetRules("media", ("img/", "../img/"), extensions=(".png", ".svg", ".jpg"))


def _refs(spark, d):
    return assets.references(_bodies(spark, d).select("raw_id", "body"), "body", _RULES).drop("body")


@query(r"""WITH m AS (SELECT raw_id, unnest(regexp_extract_all(body, '(img/|\.\./img/)([^\s)"''<>]+)', 0)) AS raw FROM raw_docs WHERE body IS NOT NULL), r AS (SELECT raw_id, raw, regexp_replace(regexp_replace(raw, '^(\.\./)?img/', ''), '[?#].*$', '') AS rest FROM m)
  SELECT raw_id, raw, rest AS asset_path FROM r WHERE lower(regexp_extract(rest, '[^/.](\.[^./]*)$', 1)) IN ('.png', '.svg', '.jpg')""")
def asset_references(spark, d):
    return _refs(spark, d).select("raw_id", "raw", "asset_path")


@query(r"""WITH l AS (SELECT raw_id, regexp_extract_all(body, '(img/|\.\./img/)([^\s)"''<>]+)', 0) AS a FROM raw_docs WHERE body IS NOT NULL), m AS (SELECT raw_id, unnest(a) AS raw, generate_subscripts(a, 1) AS pos FROM l),
  r AS (SELECT *, regexp_replace(raw, '[?#].*$', '') AS url, regexp_replace(regexp_replace(raw, '^(\.\./)?img/', ''), '[?#].*$', '') AS rest FROM m)
  SELECT rest AS asset_path, url, 'media/' || rest AS local_path FROM r WHERE lower(regexp_extract(rest, '[^/.](\.[^./]*)$', 1)) IN ('.png', '.svg', '.jpg') QUALIFY row_number() OVER (PARTITION BY rest ORDER BY raw_id, pos) = 1""")
def asset_plan(spark, d):
    return assets.download_plan(_refs(spark, d), "raw_id", _RULES.subdir)


@query("SELECT DISTINCT coalesce(page_group, 'none') || '/unused.png' AS asset_path FROM pages")
def asset_prune(spark, d):
    """Of the referenced files and one more for every page group, those that nothing refers to."""
    refs = _refs(spark, d)
    files = refs.select("asset_path").distinct().unionByName(table(spark, d, "pages").select(F.concat(F.coalesce("page_group", F.lit("none")), F.lit("/unused.png")).alias("asset_path")).distinct())
    return assets.prunable(files, refs, all_fresh=True)


def _converter(name: str, dialect: str):
    def run(spark, d):
        done = staged(_bodies(spark, d).select("raw_id", converted(F.col("body"), dialect).alias("c")), name)
        return done.select("raw_id", F.length("c.text").alias("chars"), content_hash(F.col("c.text")).alias("hash"), "c.error")

    run.__name__ = name
    QUERIES[name] = run


_converter("html_to_markdown", "html")
_converter("vitepress_to_markdown", "vitepress")
_converter("mdx_to_markdown", "mdx")
_converter("components_to_markdown", "components")
_converter("astro_to_markdown", "astro")


@query()
def converted_pages(spark, d):
    """All bodies converted as HTML, validated, hashed and titled; html_conversion_failures has the rest."""
    pages, _ = validated(_bodies(spark, d).select("raw_id", "body"), "html")
    return pages.select("raw_id", "hash", "title")


@query()
def html_conversion_failures(spark, d):
    _, failures = validated(_bodies(spark, d).select("raw_id", "body"), "html")
    return failures.select("raw_id", "error")


@query(f"SELECT raw_id, 'not Markdown' AS error FROM raw_docs WHERE body IS NOT NULL AND NOT ({_VALID})")
def conversion_failures(spark, d):
    docs = _bodies(spark, d).select("raw_id", "body")
    _, failures = validated(docs, "markdown")
    return failures.select("raw_id", "error")


@query("""WITH t AS (SELECT source, title || CASE WHEN length(title) % 2 = 0 THEN ' 漢字テスト' ELSE ' ＷＩＤＥ e' || chr(769) END AS title FROM doc_sources)
  SELECT source, max(list_sum(list_transform(range(1, length(title) + 1), lambda i: CASE WHEN ord(title[i]) = 769 THEN 0 WHEN ord(title[i]) >= 12352 THEN 2 ELSE 1 END)))::BIGINT AS display_width FROM t GROUP BY 1""")
def column_widths(spark, d):
    """Titles with signs that take two columns, and with one that takes none."""
    title = F.concat("title", F.when(F.length("title") % 2 == 0, " 漢字テスト").otherwise(" ＷＩＤＥ e\u0301"))
    return table(spark, d, "doc_sources").groupBy("source").agg(F.max(display_width(title)).cast("long").alias("display_width"))


@query(f"SELECT DISTINCT title, {sql_log_escaped('title')} AS escaped FROM manifest_files WHERE title IS NOT NULL")
def log_titles(spark, d):
    titles = table(spark, d, "manifest_files").select("title").where("title is not null").distinct()
    return titles.select("title", log_escaped(F.col("title")).alias("escaped"))


@query(r"""WITH u AS (SELECT source, slug, ordinal, regexp_replace(regexp_replace(regexp_replace(rtrim(regexp_replace(source_url, '[?#].*$', '', 's'), '/'), '^.*/', ''), '\.mdx?$', ''), '[-_]+', ' ', 'g') AS w FROM pages),
  t AS (SELECT *, regexp_matches(w, '^config ') AS c FROM u)
  SELECT source, slug, ordinal, array_to_string(list_transform(regexp_extract_all(CASE WHEN c THEN substr(w, 8) ELSE w END, '[A-Za-z]+|[^A-Za-z]+'), lambda x: upper(x[1]) || lower(x[2:])), '') || CASE WHEN c THEN ' Configuration' ELSE '' END AS title FROM t""")
def section_titles(spark, d):
    return table(spark, d, "pages").select("source", "slug", "ordinal", section_title(F.col("source_url")).alias("title"))


# --- sources

_CHUNK = 1000  # addresses in one sitemap or listing


def _sitemaps(spark, d):
    """A root index, and below it sitemaps of each source with at most _CHUNK addresses."""
    pages = table(spark, d, "pages").select("source", F.floor(F.col("ordinal") / _CHUNK).alias("chunk"), "ordinal", "source_url")
    base = F.concat(F.lit("https://docs.example/sitemap-"), "source", F.lit("-"), "chunk", F.lit(".xml"))
    by = pages.groupBy("source", "chunk").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "source_url"))), lambda p: F.concat(F.lit("<url><loc>"), F.replace(F.replace(p["source_url"], F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("</loc></url>"))), "").alias("x"))
    leaves = by.select(base.alias("url"), F.concat(F.lit("<urlset>"), "x", F.lit("</urlset>")).alias("xml"))
    root = leaves.agg(F.concat(F.lit("<sitemapindex>"), F.array_join(F.transform(F.sort_array(F.collect_set("url")), lambda u: F.concat(F.lit("<sitemap><loc>"), u, F.lit("</loc></sitemap>"))), ""), F.lit("</sitemapindex>")).alias("xml"))
    return root.select(F.lit("https://docs.example/sitemap.xml").alias("url"), "xml").unionByName(leaves)


@query(r"SELECT rtrim(regexp_replace(trim(source_url), '[?#].*$', ''), '/') AS url, 1 AS depth FROM pages")
def sitemap_crawl(spark, d):
    return sitemap.crawl(staged(_sitemaps(spark, d), "sitemaps"), "https://docs.example/sitemap.xml", "https://docs.example")


@query("SELECT 'https://docs.example/sitemap-' || source || '-' || CAST(floor(ordinal / 1000) AS BIGINT) || '.xml' AS url, count(*) AS addresses FROM pages GROUP BY 1")
def sitemap_scan(spark, d):
    return _sitemaps(spark, d).where("url <> 'https://docs.example/sitemap.xml'").select("url", F.size(sitemap.scan(F.col("xml"))).cast("long").alias("addresses"))


@query(r"""SELECT p.source, CASE WHEN rtrim(regexp_replace(trim(source_url), '[?#].*$', ''), '/') = home_url THEN 'index' ELSE substr(rtrim(regexp_replace(trim(source_url), '[?#].*$', ''), '/'), length(home_url) + 2) END AS slug, ordinal FROM pages p JOIN doc_sources s ON p.source = s.source""")
def address_discovery(spark, d):
    """The pages of every source, each below the home of its source."""
    found = table(spark, d, "pages").select("source", F.col("source_url").alias("url"), "ordinal")
    homes = small(table(spark, d, "doc_sources").select("source", "home_url"))
    return discovery.from_addresses(found.join(homes, "source"), F.col("home_url")).select("source", "slug", "ordinal")


def _trees(pages):
    """(source, slug, ordinal) by way of file listings as JSON, of at most _CHUNK files each."""
    entry = F.struct(F.lit("blob").alias("type"), F.concat(F.lit("docs/"), "slug", F.lit("?"), "ordinal", F.lit(".md")).alias("path"))
    trees = pages.groupBy("source", F.floor(F.col("ordinal") / _CHUNK).alias("chunk")).agg(F.to_json(F.struct(F.lit(False).alias("truncated"), F.collect_list(entry).alias("tree"))).alias("json"))
    found = listings.tree_pages(listings.tree_entries(trees.select("source", "json"), "json"), "docs/")
    return found.select("source", F.regexp_replace("slug", r"(?s)\?[^?]*\z", "").alias("slug"), F.substring_index("slug", "?", -1).cast("int").alias("ordinal"))


@query("SELECT source, slug, ordinal FROM pages")
def tree_discovery(spark, d):
    """All pages, those of the top level too."""
    return _trees(table(spark, d, "pages"))


@query(r"SELECT source, rtrim(regexp_replace(source_md_url, '[?#].*$', ''), '/') AS url FROM pages WHERE regexp_matches(source_md_url, '^https://docs\.[a-z]+\.example/[^?#]*\.md([?#].*)?$')")
def bullet_discovery(spark, d):
    pages = table(spark, d, "pages")
    lines = pages.select("source", F.concat(F.lit("- ["), F.lit("page"), F.lit("]("), "source_md_url", F.lit(")")).alias("text"), F.array(F.lit("x")).alias("one"))
    hosts = [f"docs.{r[0]}.example" for r in table(spark, d, "doc_sources").select("source").distinct().orderBy("source").toLocalIterator()]
    return lines.select("source", F.explode(listings.bullet_links(F.col("text"), hosts, "/")).alias("l")).select("source", "l.url")


@query("""WITH p AS (SELECT DISTINCT slug FROM pages), known AS (SELECT slug FROM p UNION SELECT replace(slug, '-', '_') FROM p WHERE length(slug) % 3 = 0 UNION SELECT replace(regexp_replace(slug, '^.*/', ''), '-', '_') FROM p WHERE length(slug) % 3 = 1),
  wanted AS (SELECT slug FROM p UNION SELECT regexp_replace(slug, '^guides/', '') FROM p UNION SELECT 'old-place/' || slug FROM p UNION SELECT slug || '-x' FROM p UNION SELECT replace(slug, '_', '-') FROM known)
  SELECT slug, CASE WHEN slug IN (FROM known) THEN slug WHEN 'guides/' || slug IN (FROM known) THEN 'guides/' || slug WHEN replace(regexp_replace(slug, '^.*/', ''), '-', '_') IN (FROM known) THEN replace(regexp_replace(slug, '^.*/', ''), '-', '_')
    WHEN replace(slug, '-', '_') IN (FROM known) THEN replace(slug, '-', '_') END AS target FROM wanted""")
def slug_fallbacks(spark, d):
    """Slugs that are known as they are, below 'guides/', by their last segment, with other signs, and not at all."""
    pages = table(spark, d, "pages").select("slug").distinct()
    s, last = F.col("slug"), F.regexp_replace("slug", r"(?s)^.*/", "")
    under = lambda c: F.replace(c, F.lit("-"), F.lit("_"))
    known = pages.unionByName(pages.where(F.length("slug") % 3 == 0).select(under(s).alias("slug"))).unionByName(pages.where(F.length("slug") % 3 == 1).select(under(last).alias("slug"))).distinct()
    wanted = pages.select(F.explode(F.array(s, F.regexp_replace("slug", "^guides/", ""), F.concat(F.lit("old-place/"), s), F.concat(s, F.lit("-x")))).alias("slug")).unionByName(known.select(F.replace(s, F.lit("_"), F.lit("-")).alias("slug"))).distinct()
    return discovery.resolved_slugs(wanted, known)


@query("""WITH RECURSIVE r AS (SELECT DISTINCT regexp_replace(slug, '-(moved|next)$', '') AS a, slug AS b FROM manifest_files WHERE regexp_matches(slug, '-(moved|next)$')),
  one AS (SELECT a, min(b) AS b FROM r GROUP BY 1 UNION ALL SELECT 'step-' || i, 'step-' || (i + 1) FROM range(25) t(i) UNION ALL VALUES ('round-a', 'round-b'), ('round-b', 'round-c'), ('round-c', 'round-a')),
  walk AS (SELECT a AS slug, a AS target, [a] AS seen, 0 AS hops FROM one UNION ALL SELECT w.slug, o.b, list_append(seen, o.b), hops + 1 FROM walk w JOIN one o ON w.target = o.a WHERE NOT list_contains(seen, o.b))
  SELECT slug, arg_max(target, hops) AS target FROM walk GROUP BY slug""")
def redirects_followed(spark, d):
    """The redirects of moved pages, a chain of 25 and a circle."""
    files = table(spark, d, "manifest_files").where(r"slug rlike '-(?:moved|next)$'")
    one = files.select(F.regexp_replace("slug", r"-(?:moved|next)\z", "").alias("slug"), F.col("slug").alias("target")).groupBy("slug").agg(F.min("target").alias("target"))
    links = spark.range(25).select(F.concat(F.lit("step-"), "id").alias("slug"), F.concat(F.lit("step-"), F.col("id") + 1).alias("target"))
    circle = spark.createDataFrame([("round-a", "round-b"), ("round-b", "round-c"), ("round-c", "round-a")], "slug string, target string")
    whole = one.unionByName(links).unionByName(circle)
    return discovery.followed_redirects(whole.select("slug"), whole)


# --- streaming

_NEWEST = r"""SELECT source, slug, entry_id, strftime(upd AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS updated FROM (SELECT *, coalesce(try_cast(nullif(trim(last_updated), '') AS TIMESTAMPTZ), arrived_at) AS upd FROM file_entries WHERE hash IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY source, slug ORDER BY upd DESC, entry_id DESC) = 1"""


@query(_NEWEST)
def stream_snapshot(spark, d):
    """The newest entry of each page, folded from a stream of the entries."""
    entries, path = table(spark, d, "file_entries"), fresh_path(spark, "feed")
    entries.write.parquet(path)  # a stream reads a folder, and the table may be one file
    stream = spark.readStream.schema(entries.schema).parquet(path)
    rows = stream.where("hash is not null").select("source", "slug", "entry_id", F.coalesce(instant(F.col("last_updated")), F.col("arrived_at")).alias("updated"), F.hex(digest(F.col("hash"))).alias("hash"))
    updater = SnapshotUpdater(spark, fresh_path(spark, "stream"), "source string, slug string, entry_id long, updated timestamp, hash string", ("updated", "entry_id"))
    updater.run(rows, fresh_path(spark, "stream-state")).awaitTermination()
    return updater.latest().select("source", "slug", "entry_id", iso_stamp(F.col("updated")).alias("updated"))


@query("SELECT strftime(time_bucket(INTERVAL '1 hour', ts AT TIME ZONE 'UTC'), '%Y-%m-%dT%H:%M:%SZ') AS window_start, event_type, count(*) AS events FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    return late_counts(table(spark, d, "events"), "ts").select(iso_stamp(F.col("window_start")).alias("window_start"), "event_type", "events")


@query("SELECT DISTINCT rtrim(regexp_replace(trim(source_md_url), '[?#].*$', ''), '/') AS url FROM pages")
def visited_addresses(spark, d):
    return table(spark, d, "pages").select(clean_url(F.col("source_md_url")).alias("url")).distinct()


@query("SELECT g.source, g.page_group, count(*) AS pages FROM (SELECT source, coalesce(nullif(trim(page_group), ''), 'Documentation') AS page_group FROM pages) g GROUP BY ALL HAVING count(*) > 5")
def large_groups(spark, d):
    return reports.group_counts(table(spark, d, "pages")).where("pages > 5")
