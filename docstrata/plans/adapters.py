"""Queries of whole adapter steps, on documents made from the page table so that SQL can say what must come out."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docstrata.convert.registry import converted, linked
from docstrata.functions import fences, links
from docstrata.functions import text as X
from docstrata.functions.assets import AssetRules, rewrite
from docstrata.functions.text import content_hash
from docstrata.operators import discovery, lifecycle, refresh, reports, stubs
from docstrata.operators.snapshots import last_snapshots
from docstrata.plans.reference import _ESC, _SLUG, _SNAPS
from docstrata.runtime import small, staged, table
from docstrata.sources import fetch, listings, manifests

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _keys(spark, d):
    """(source, slug, home): every page once, with the site of its source."""
    homes = small(table(spark, d, "doc_sources").select("source", F.col("home_url").alias("home")))
    return table(spark, d, "pages").select("source", "slug").distinct().join(homes, "source")


_KEYS = "k AS (SELECT DISTINCT p.source, p.slug, home_url AS home FROM pages p JOIN doc_sources s ON p.source = s.source)"


def _filled(template: str) -> str:
    """A template with {slug} and {home} as SQL: text and columns joined by ||."""
    out, rest = [], template
    while rest:
        cut = min((i for i in (rest.find("{slug}"), rest.find("{home}"), rest.find("{base}")) if i >= 0), default=len(rest))
        if cut:
            out.append("'" + rest[:cut].replace("'", "''") + "'")
        if cut < len(rest):
            out.append({"{slug}": "slug", "{home}": "home", "{base}": "regexp_replace(slug, '^.*/', '')"}[rest[cut : cut + 6]])
        rest = rest[cut + 6 :]
    return " || ".join(out).replace("\n", "' || chr(10) || '")


def _column(template: str):
    return F.replace(F.replace(F.lit(template), F.lit("{slug}"), F.col("slug")), F.lit("{home}"), F.col("home"))


# --- hooks: convert, then rewrite the links of what came out

_LINKED = "# T\n\n[a]({home}/{slug}?x=1#top) [b](/no/such-page) [c]({home}/none) [d](/{slug}.md)\n\n```\n[e](/{slug})\n```\n"
_RELINKED = "# T\n\n[a](./{base}.md?x=1#top) [b]({home}/no/such-page) [c]({home}/none) [d](./{base}.md)\n\n```\n[e](/{slug})\n```\n"
_TEXT_DIALECTS = ("markdown", "vitepress", "mdx", "components", "astro")


@query(f"WITH {_KEYS} SELECT source, slug, dialect, {_filled(_RELINKED)} AS text FROM k, (VALUES {', '.join(f'({chr(39)}{x}{chr(39)})' for x in _TEXT_DIALECTS)}) v(dialect)")
def adapter_hooks(spark, d):
    """Pages with links to themselves and to pages that are not there, through every text dialect's hook."""
    docs, whole = _keys(spark, d).withColumn("body", _column(_LINKED)), None
    pages = docs.select("source", "slug")
    for x in _TEXT_DIALECTS:
        rows = docs.select("source", "slug", F.concat_ws("/", "source", "slug").alias("key"), F.col("home").alias("site"), F.col("body"))
        rows = staged(rows.withColumn("text", converted(F.col("body"), x)["text"]).drop("body"), "hook")
        done = linked(rows, "key", pages).select("source", "slug", F.lit(x).alias("dialect"), "text")
        whole = done if whole is None else whole.unionByName(done)
    return whole


# --- converters: what each makes of a page with its constructs

_PAIRS = {
    "html": (
        '<html><body><nav>menu</nav><main><h1>{slug}</h1><p>See <a href="{home}/x">the <b>page</b></a>, <code>a_b</code> and <em>more</em>.</p><ul><li>one</li><li>two</li></ul><pre><code class="language-js">a &lt; "{slug}"\n c</code></pre><table><tr><th>k</th><th>v</th></tr><tr><td>{slug}</td><td>x|y</td></tr></table><blockquote><p>q</p></blockquote><ol><li>first</li></ol></main><footer>f</footer><script>x()</script></body></html>',
        '# {slug}\n\nSee [the **page**]({home}/x), `a_b` and *more*.\n\n- one\n- two\n\n```js\na < "{slug}"\n c\n```\n\n| k | v |\n| --- | --- |\n| {slug} | x\\|y |\n\n> q\n\n1. first\n',
    ),
    "vitepress": (
        "---\ntitle: {slug}\n---\n\n::: tip Note well\nBody of {slug}.\n:::\n\nState <Badge type=\"info\" text=\"beta\" /> here.\n\n::: unknown\n{slug}\n:::\n\n```md\n::: tip\n```\n\n::: warning\nnever closed\n",
        "# {slug}\n\n> [!TIP]\n> **Note well**\n>\n> Body of {slug}.\n\nState beta here.\n\n{slug}\n\n```md\n::: tip\n```\n\n::: warning\nnever closed\n",
    ),
    "mdx": (
        "---\ntitle: {slug}\n---\nimport X from \"y\"\n\n:::note[Heads up]\nBody of {slug}.\n:::\n\n{/* a -- b */}\n\n```js\nimport Y from \"{slug}\"\n```\n\nEnd.\n",
        "# {slug}\n\n> [!NOTE]\n> **Heads up**\n>\n> Body of {slug}.\n\n<!-- a == b -->\n\n```js\nimport Y from \"{slug}\"\n```\n\nEnd.\n",
    ),
    "components": (
        "# {slug}\n\n<Note>\n  Body of {slug}.\n</Note>\n\n<Card title=\"C\" href=\"{home}/a\">\n  Inside\n</Card>\n\n<Steps>\n  <Step title=\"One\">\n    do\n  </Step>\n  <Step title=\"Two\">\n    it\n  </Step>\n</Steps>\n\n<Tabs>\n  <Tab title=\"A\">\n    {slug}\n  </Tab>\n</Tabs>\n\n```\n<Note>\n```\n",
        "# {slug}\n\n> [!NOTE]\n> Body of {slug}.\n\n**[C]({home}/a)**\n\nInside\n\n1. **One**\n\n   do\n2. **Two**\n\n   it\n\n**A**\n\n{slug}\n\n```\n<Note>\n```\n",
    ),
    "astro": (
        "---\ntitle: x\n---\n\n# {slug}\n\n<WarningTip>\n  Mind {slug}.\n</WarningTip>\n\n<ToggleSection title=\"More\">\n  Body\n</ToggleSection>\n\n<FileTree tree={[{name: \"src\", children: [{name: \"{slug}\", comment: \"it\"}]}, {name: \"b.md\"}]} />\n\n<ConfigTable options={[{key: \"k\", type: \"string\", description: \"A | {slug}\"}]} />\n\n<PricingCard name=\"Pro\" subtitle=\"For teams\" price=\"$20\" interval=\"/month\" ctaLabel=\"Go\" ctaHref=\"{home}/x\">\n- one\n</PricingCard>\n\n<ModelDetails name=\"m\" description=\"Fast\" data={{features: [{title: \"Speed\", value: true}, {title: \"Size\", value: 3}]}} />\n\n<PlanFeatureMatrix data={{plans: [{id: \"a\", label: \"A\"}, {id: \"b\"}], sections: [{title: \"S\", features: [{name: \"{slug}\", availability: {a: true, b: false}}, {name: \"y\", availability: {a: \"beta\"}}]}]}} />\n\n<GlossaryTable options={[{key: \"t\", href: \"{home}/t\", appliesTo: \"all\", description: \"d\"}]} />\n\n<TableWrapper><table><tr><th align=\"right\">h</th><th>i</th></tr><tr><td>{slug}</td></tr></table></TableWrapper>\n\n<MainIcon />\n\n```\n<FileTree tree={[]} />\n```\n",
        "# {slug}\n\n> [!WARNING]\n> Mind {slug}.\n\n<details>\n<summary>More</summary>\n\nBody\n\n</details>\n\n```text\nsrc\n  {slug}  # it\nb.md\n```\n\n| Key | Type | Description |\n| --- | --- | --- |\n| `k` | `string` | A \\| {slug} |\n\n### Pro ($20/month)\n\nFor teams\n\n[Go]({home}/x)\n\n- one\n\n### `m`\n\nFast\n\n- **Speed**: Supported\n- **Size**: 3\n\n### S\n\n| Feature | A | b |\n| --- | --- | --- |\n| {slug} | Supported | Not supported |\n| y | beta | — |\n\n| Term | Applies to | Definition |\n| --- | --- | --- |\n| [t]({home}/t) | all | d |\n\n| h | i |\n| ---: | --- |\n| {slug} |  |\n\n```\n<FileTree tree={[]} />\n```\n",
    ),
}


def _pair(dialect: str) -> None:
    source, target = _PAIRS[dialect]

    def run(spark, d):
        docs = _keys(spark, d).select("source", "slug", converted(_column(source), dialect).alias("c"))
        return docs.select("source", "slug", "c.text")

    run.__name__ = f"{dialect}_constructs"
    query(f"WITH {_KEYS} SELECT source, slug, {_filled(target)} AS text FROM k")(run)


for _d in _PAIRS:
    _pair(_d)


# --- stubs

_DOCS = """k AS (SELECT DISTINCT source, slug FROM pages), n AS (SELECT *, lead(slug) OVER (PARTITION BY source ORDER BY slug) AS next, length(slug) % 3 AS kind, length(slug) - length(replace(slug, '/', '')) AS depth FROM k),
  docs AS (SELECT source, slug, next, kind, CASE kind WHEN 0 THEN '# Stub' || chr(10) || chr(10) || 'See [x](' || repeat('../', depth) || coalesce(next, 'no-such-page') || '.md).'
    WHEN 1 THEN '# Page ' || slug || chr(10) || chr(10) || 'Text of ' || slug || '.' ELSE '# Mixed' || chr(10) || chr(10) || '[y](' || repeat('../', depth) || coalesce(next, 'no-such-page') || '.md#top)' || chr(10) || chr(10) || 'End.' END AS text FROM n)"""


def _stub_docs(spark, d):
    keys = table(spark, d, "pages").select("source", "slug").distinct()
    n = keys.withColumn("next", F.lead("slug").over(Window.partitionBy("source").orderBy("slug"))).withColumn("kind", F.length("slug") % 3)
    up = F.repeat(F.lit("../"), F.size(F.split("slug", "/")) - 1)
    to = F.concat(up, F.coalesce("next", F.lit("no-such-page")), F.lit(".md"))
    text = F.when(F.col("kind") == 0, F.concat(F.lit("# Stub\n\nSee [x]("), to, F.lit(")."))).when(F.col("kind") == 1, F.concat(F.lit("# Page "), "slug", F.lit("\n\nText of "), "slug", F.lit("."))).otherwise(F.concat(F.lit("# Mixed\n\n[y]("), to, F.lit("#top)\n\nEnd.")))
    return n.select("source", "slug", text.alias("text"))


@query(f"WITH {_DOCS} SELECT source, slug, next AS twin FROM docs WHERE kind IN (0, 2) AND next IS NOT NULL")
def stub_twins(spark, d):
    """Pages that are hardly more than one link to a known page; those whose link leads nowhere are none."""
    docs = _stub_docs(spark, d)
    return stubs.stubs(docs, docs.select("source", "slug"))


@query(f"WITH {_DOCS} SELECT a.source, a.slug, CASE WHEN a.kind IN (0, 2) AND b.slug IS NOT NULL THEN b.text ELSE a.text END AS text FROM docs a LEFT JOIN docs b ON a.source = b.source AND a.next = b.slug")
def stubs_expanded(spark, d):
    docs = _stub_docs(spark, d)
    return stubs.expanded(docs, docs)


_LONG = "rpad('A long paragraph.', 400, ' more')"


@query(f"""WITH {_DOCS}, long AS (SELECT source, slug, next, kind, text || chr(10) || chr(10) || {_LONG} AS text FROM docs)
  SELECT a.source, a.slug, CASE WHEN a.kind = 2 AND b.slug IS NOT NULL THEN '# Mixed' || chr(10) || chr(10) || regexp_replace(b.text, '^#', '##') || chr(10) || chr(10) || 'End.' || chr(10) || chr(10) || {_LONG} ELSE a.text END AS text FROM long a LEFT JOIN long b ON a.source = b.source AND a.next = b.slug""")
def hybrid_pages(spark, d):
    """Pages with prose of their own, in which a paragraph that is a link becomes the page it links to."""
    docs = _stub_docs(spark, d).withColumn("text", F.concat("text", F.lit("\n\n"), F.rpad(F.lit("A long paragraph."), 400, " more")))
    return stubs.expanded(docs, docs)


# --- runs

@query("SELECT source, slug, ordinal FROM pages WHERE source IN (SELECT source FROM doc_sources ORDER BY source LIMIT 7)")
def sources_selected(spark, d):
    """The pages of the sources a run is asked for."""
    sources = table(spark, d, "doc_sources")
    first = [r[0] for r in sources.select("source").orderBy("source").limit(7).collect()]
    names = spark.createDataFrame([(s,) for s in refresh.selected(sources, [*first, first[0]])], "source string")
    return table(spark, d, "pages").join(small(names), "source", "left_semi").select("source", "slug", "ordinal")


@query(f"""{_SNAPS}, disc AS (SELECT DISTINCT source, slug FROM pages), got AS (SELECT n.* FROM new n WHERE length(slug) % 5 <> 0),
  kept AS (SELECT source, slug, hash, false AS carried FROM got UNION ALL SELECT source, slug, hash, true FROM old o WHERE length(slug) % 5 = 0 AND EXISTS (SELECT 1 FROM new n WHERE n.source = o.source AND n.slug = o.slug)),
  s AS (SELECT source FROM disc UNION SELECT source FROM kept UNION SELECT source FROM old)
  SELECT source, (SELECT count(*) FROM disc x WHERE x.source = s.source) AS discovered, (SELECT count(*) FROM kept x WHERE x.source = s.source AND NOT carried) AS fetched, (SELECT count(*) FROM kept x WHERE x.source = s.source AND carried) AS carried,
    (SELECT count(*) FROM kept x LEFT JOIN old o ON x.source = o.source AND x.slug = o.slug WHERE x.source = s.source AND (o.slug IS NULL OR o.hash IS NULL OR x.hash IS DISTINCT FROM o.hash)) AS written,
    (SELECT count(*) FROM old o WHERE o.source = s.source AND NOT EXISTS (SELECT 1 FROM disc x WHERE x.source = o.source AND x.slug = o.slug)) AS deleted FROM s""")
def run_report(spark, d):
    """What a run in which one page of five could not be fetched did to each source."""
    old, new = last_snapshots(table(spark, d, "manifest_files"), table(spark, d, "mirror_runs"))
    lost = F.length("slug") % 5 == 0
    kept = lifecycle.carried_forward(new.where(~lost), new.where(lost).select("source", "slug"), old)
    changes = spark.createDataFrame([], "source string, change_type string")
    report = refresh.run_report(table(spark, d, "pages"), kept, old, changes)
    return report.select("source", "discovered", "fetched", "carried", "written", "deleted")


@query("SELECT p.source, p.slug, ordinal, CASE WHEN contains(p.slug, '/') THEN split_part(p.slug, '/', 1) ELSE 'root' END AS page_group, p.slug AS source_id FROM pages p")
def address_groups(spark, d):
    """Discovery whose groups are the first segments of addresses."""
    homes = small(table(spark, d, "doc_sources").select("source", "home_url"))
    found = table(spark, d, "pages").select("source", F.col("slug"), "ordinal").join(homes, "source").select("source", F.concat("home_url", F.lit("/"), "slug").alias("url"), "ordinal", "home_url")
    return discovery.from_addresses(found, F.col("home_url"), groups="first").select("source", "slug", "ordinal", "page_group", "source_id")


@query("""WITH p AS (SELECT source, ordinal, CASE ordinal % 4 WHEN 0 THEN 'de/' || slug WHEN 1 THEN 'fr/' || slug || '/index' WHEN 2 THEN slug || '/README' ELSE slug END AS slug FROM pages)
  SELECT source, ordinal, slug, CASE WHEN regexp_matches(slug, '^(de|fr)/') THEN slug[:2] ELSE 'en' END AS locale, CASE WHEN lower(rest) IN ('index', 'readme') THEN 'intro' ELSE regexp_replace(rest, '(?i)/(index|readme)$', '') END AS page FROM (SELECT *, regexp_replace(slug, '^(de|fr)/', '') AS rest FROM p)""")
def localized_pages(spark, d):
    n, s = F.col("ordinal") % 4, F.col("slug")
    pages = table(spark, d, "pages").select("source", "ordinal", F.when(n == 0, F.concat(F.lit("de/"), s)).when(n == 1, F.concat(F.lit("fr/"), s, F.lit("/index"))).when(n == 2, F.concat(s, F.lit("/README"))).otherwise(s).alias("slug"))
    return listings.localized_pages(pages, ["de", "fr", "en"]).select("source", "ordinal", "slug", "locale", "page")


# --- values

@query("SELECT source, coalesce(nullif(regexp_extract(trim(version), '(\\d+\\.\\d+\\.\\d+(-[0-9A-Za-z.-]+)?)', 1), ''), nullif(trim(regexp_replace(regexp_replace(trim(version), '^v', ''), '^V', '')), '')) AS version FROM doc_sources")
def release_versions(spark, d):
    """Versions by way of a release's JSON."""
    rows = table(spark, d, "doc_sources").select("source", F.to_json(F.struct(F.col("version").alias("tag_name"))).alias("json"))
    return rows.select("source", listings.release_version(F.col("json")).alias("version"))


@query("SELECT issue_id, CASE WHEN line % 7 = 0 THEN NULL WHEN line % 7 = 1 THEN NULL WHEN line > 0 THEN line END AS number FROM link_issues")
def positive_numbers(spark, d):
    """Line numbers as padded text, some negative, some no numbers."""
    n = F.col("line")
    spelled = F.when(n % 7 == 0, F.concat(n.cast("string"), F.lit(" lines"))).when(n % 7 == 1, (-n).cast("string")).otherwise(F.concat(F.lit(" "), n.cast("string"), F.lit("\n")))
    return table(spark, d, "link_issues").select("issue_id", X.positive_int(spelled).alias("number"))


@query("""SELECT source, array_to_string(list_sort(list_distinct([source, 'pages', CASE WHEN length(source) % 2 = 0 THEN 'assets' ELSE 'pages' END])), ',') AS selected, CASE WHEN length(source) % 3 = 0 THEN 'zzz' ELSE '' END AS unknown FROM doc_sources""")
def list_selections(spark, d):
    """Comma-separated choices with repeats, blanks, capitals and unknown names."""
    sources = table(spark, d, "doc_sources").select("source")
    known = ["assets", "pages", *(r[0] for r in sources.collect())]
    wanted = F.concat(F.lit(" Pages, ,"), F.upper("source"), F.lit(",pages,"), F.when(F.length("source") % 2 == 0, "assets").otherwise(""), F.when(F.length("source") % 3 == 0, ",zzz").otherwise(""))
    chosen = sources.select("source", X.list_selection(wanted, known).alias("s"))
    return chosen.select("source", F.array_join("s.selected", ",").alias("selected"), F.array_join("s.unknown", ",").alias("unknown"))


@query("SELECT meta_id, CAST(least(30.0, 2.0 * pow(2, worker)) AS DOUBLE) AS backoff, CASE WHEN worker % 2 = 0 AND duration_s IS NOT NULL THEN CAST(greatest(0, least(30, round(duration_s - 20, 2))) AS DOUBLE) END AS wait FROM run_metadata")
def retry_waits(spark, d):
    rows = table(spark, d, "run_metadata")
    header = F.when(F.col("worker") % 2 == 0, F.concat(F.lit(" "), F.round(F.col("duration_s") - 20, 2).cast("string"))).otherwise("Wed, 21 Oct 2015 07:28:00 GMT")
    return rows.select("meta_id", X.backoff_seconds(F.col("worker") + 1).cast("double").alias("backoff"), X.retry_after(header).alias("wait"))


@query("SELECT source, trim(title, '\"''') AS plain, CASE WHEN generate_whats_new THEN 'Supported' WHEN NOT generate_whats_new THEN 'Not supported' ELSE title END AS shown FROM doc_sources")
def field_values(spark, d):
    """Quoted front matter values, and truth values as a table shows them."""
    quote = F.when(F.length("title") % 2 == 0, '"').otherwise("'")
    return table(spark, d, "doc_sources").select("source", X.yaml_unquoted(F.concat(F.lit(" "), quote, "title", quote)).alias("plain"), X.availability(F.coalesce(F.initcap(F.col("generate_whats_new").cast("string")), "title")).alias("shown"))


# --- texts

@query("SELECT raw_id, sha256(body) AS hash FROM raw_docs WHERE body IS NOT NULL")
def fences_restored(spark, d):
    """Blocks shielded and restored by every grammar in turn: the text as it was."""
    def through(texts: pd.Series) -> pd.Series:
        def one(t: str) -> str:
            for g in fences.GRAMMARS:
                t = fences.restored(*fences.shielded(t, g))
            return t

        return texts.map(one)

    return table(spark, d, "raw_docs").where("body is not null").select("raw_id", content_hash(F.pandas_udf(through, "string")(F.col("body"))).alias("hash"))


_REL = r"""regexp_replace(regexp_replace(target0, '^<(.*)>$', '\1'), '[?#].*$', '', 's')"""


@query(rf"""WITH RECURSIVE t AS (SELECT issue_id, source, regexp_replace(trim(file), '^docs/', '') AS file, trim(target) AS target0 FROM link_issues WHERE trim(file) <> '' AND target IS NOT NULL AND trim(target) <> ''),
  r AS (SELECT issue_id, regexp_replace(file, '[^/]*$', '') || {_REL} AS path FROM t WHERE {_REL} <> '' AND NOT regexp_matches({_REL}, '^(/|[A-Za-z][A-Za-z0-9+.-]*:|[?#])')),
  n AS (SELECT issue_id, regexp_replace(path, '(^|/)(\./)+', '\1', 'g') AS path FROM r UNION ALL SELECT issue_id, regexp_replace(path, '(^|/)[^/]+/\.\./', '\1') FROM n WHERE regexp_matches(path, '(^|/)[^./][^/]*/\.\./')),
  f AS (SELECT issue_id, path FROM n WHERE NOT regexp_matches(path, '(^|/)[^./][^/]*/\.\./')),
  k AS (SELECT DISTINCT source || '/' || slug || '.md' AS path FROM pages UNION SELECT DISTINCT source || '/' || regexp_replace(slug, '(README|index)$', '') FROM pages WHERE regexp_matches(slug, '(^|/)(README|index)$'))
  SELECT f.issue_id, k.path IS NOT NULL AS is_known FROM f LEFT JOIN k ON f.path = k.path WHERE NOT starts_with(f.path, '../')""")
def link_targets(spark, d):
    """Relative targets of link issues against the page set: those that lead to a page or a directory's page, and those that do not."""
    pages = table(spark, d, "pages")
    keys = pages.select(F.concat("source", F.lit("/"), "slug", F.lit(".md")).alias("path")).unionByName(pages.where(F.col("slug").rlike(r"(?:^|/)(?:README|index)\z")).select(F.concat("source", F.lit("/"), F.regexp_replace("slug", r"(?:README|index)\z", "")).alias("path"))).distinct()
    issues = table(spark, d, "link_issues").where((F.trim("file") != "") & (links.destination_kind(F.col("target")) == "relative"))
    clean = F.regexp_replace(links.bare_destination(F.col("target")), r"(?s)[?#].*\z", "")
    rows = issues.where(clean != "").select("issue_id", links.resolved(F.regexp_replace(F.trim("file"), "^docs/", ""), clean).alias("path")).where("path is not null")
    return rows.join(keys.withColumn("k", F.lit(True)), "path", "left").select("issue_id", F.col("k").isNotNull().alias("is_known"))


_RULES = AssetRules("media", ("img/", "../img/"), extensions=(".png", ".svg", ".jpg"))


@query(r"""WITH b AS (SELECT raw_id, regexp_replace(body, '(\.\./img/|img/)([^\s)"''<>?#]+\.(png|svg|jpg))([?#][^\s)"''<>]*)?', '<@>\2', 'g') AS body, repeat('../', length(slug) - length(replace(slug, '/', ''))) || 'media/' AS up FROM raw_docs WHERE body IS NOT NULL)
  SELECT raw_id, sha256(replace(body, '<@>', up)) AS hash FROM b""")
def asset_links(spark, d):
    """References to assets of every body made relative to its page."""
    rows = table(spark, d, "raw_docs").where("body is not null")
    return rows.select("raw_id", content_hash(rewrite(F.col("body"), F.col("slug"), _RULES)).alias("hash"))


@query("""WITH p AS (SELECT DISTINCT slug, length(slug) % 4 AS n FROM pages)
  SELECT slug, CASE n WHEN 0 THEN 'failed' WHEN 1 THEN 'cached' ELSE 'written' END AS outcome FROM p""")
def asset_outcomes(spark, d):
    """Planned files of which some could not be fetched, some are there as they are, some differ, some are new."""
    plan = table(spark, d, "pages").select(F.col("slug").alias("asset_path")).distinct().withColumn("n", F.length("asset_path") % 4)
    fetched = plan.where("n > 0").select("asset_path", F.sha2("asset_path", 256).alias("digest"))
    present = plan.where("n in (0, 1, 2)").select("asset_path", F.when(F.col("n") == 2, "other").otherwise(F.sha2("asset_path", 256)).alias("digest"))
    return refresh.asset_results(plan.select("asset_path"), fetched, present).withColumnRenamed("asset_path", "slug")


@query(f"""{_SNAPS}, e AS (SELECT source, {_SLUG.format("slug")} AS slug, title, source_url, hash FROM new WHERE length(source) % 3 <> 0)
  SELECT source, slug, coalesce(title, '') AS title, source_url, sha256(slug) AS hash FROM e""")
def manifests_read(spark, d):
    """Manifests as JSON, one a source, read back; that of every third source has a faulty entry and is no baseline."""
    _, new = last_snapshots(table(spark, d, "manifest_files"), table(spark, d, "mirror_runs"))
    bad = (F.length("source") % 3 == 0)
    entry = F.struct(F.when(bad, "other").otherwise(F.col("slug")).alias("slug"), F.coalesce("title", F.lit("")).alias("title"), F.lit("g").alias("group"), "source_url", F.lit("u").alias("source_md_url"), F.lit("i").alias("source_id"), F.sha2("slug", 256).alias("hash"), F.lit("2025-01-01T00:00:00Z").alias("last_updated"), F.lit("x").alias("unknown"))
    texts = new.where("source_url is not null").groupBy("source").agg(F.to_json(F.struct(F.lit("1").alias("version"), F.map_from_entries(F.collect_list(F.struct("slug", entry))).alias("files"))).alias("value"))
    entries, _ = manifests.read_manifests(texts)
    return entries.select("source", "slug", "title", "source_url", "hash")


# --- fetching

@query("""WITH p AS (SELECT DISTINCT slug, length(slug) % 6 AS n FROM pages)
  SELECT slug, CASE n WHEN 2 THEN 'HTTP 404' WHEN 3 THEN 'HTTP 503' WHEN 4 THEN 'ConnectionError: reset' WHEN 5 THEN 'body over the size limit' END AS error, CAST(CASE n WHEN 1 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 3 ELSE 1 END AS INT) AS attempts, CASE n WHEN 0 THEN 'é ' || slug WHEN 1 THEN 'ü ' || slug END AS text FROM p""")
def fetch_outcomes(spark, d):
    """Addresses of which some answer at once, some at the second attempt and in another charset, some never, some with too much."""
    pages = table(spark, d, "pages").select("slug").distinct()
    policy = fetch.Policy(delay=0.0, most_bytes=1000)

    def connect():
        seen: dict[str, int] = {}

        def get(url: str) -> fetch.Reply:
            n, slug = len(url) % 6, url
            seen[url] = seen.get(url, 0) + 1
            if n == 0:
                return fetch.Reply(200, f"\ufeffé {slug}".encode())
            if n == 1:
                return fetch.Reply(429, headers={"Retry-After": "0"}) if seen[url] == 1 else fetch.Reply(200, f"ü {slug}".encode("latin-1"), {"Content-Type": "text/plain; charset=ISO-8859-1"})
            if n == 4:
                raise ConnectionError("reset")
            return fetch.Reply(404) if n == 2 else fetch.Reply(503) if n == 3 else fetch.Reply(200, b"x" * 1001)

        return get

    return fetch.fetched(pages, "slug", connect, policy).select("slug", "error", "attempts", "text")


_TITLE = "coalesce(s.title, s.source)"


@query(f"""{_SNAPS}, g AS (SELECT source, coalesce(nullif(trim(page_group), ''), 'Documentation') AS page_group, slug, coalesce(title, '') AS title, coalesce(source_url, '') AS url FROM new),
  l AS (SELECT source, page_group, dense_rank() OVER (PARTITION BY source ORDER BY page_group <> 'root', page_group) AS group_pos, slug, '| ' || {_ESC} || ' | [' || slug || '.md](./' || slug || '.md) | [source](<' || replace(replace(replace(replace(replace(url, '<', '%3C'), '>', '%3E'), chr(10), '%0A'), chr(13), '%0D'), '|', '%7C') || '>) |' AS line FROM g)
  SELECT s.source, 0 AS group_pos, '# ' || {_TITLE} || ' — Documentation Index' || chr(10) AS text FROM doc_sources s WHERE s.source IN (SELECT source FROM new)
  UNION ALL SELECT l.source, group_pos, '## ' || CASE WHEN page_group = 'root' THEN any_value({_TITLE}) ELSE trim(regexp_replace(page_group, '\\s+', ' ', 'g')) END || chr(10) || chr(10) || '| Page | Local | Source |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg(line, chr(10) ORDER BY slug) || chr(10) FROM l JOIN doc_sources s ON l.source = s.source GROUP BY l.source, group_pos, page_group""")
def index_documents(spark, d):
    """The index of every source as parts in order, from its last snapshot."""
    _, new = last_snapshots(table(spark, d, "manifest_files"), table(spark, d, "mirror_runs"))
    return reports.index_parts(new, table(spark, d, "doc_sources"))
