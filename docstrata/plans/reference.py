"""Queries of the mirror's own operators over the tables, and the SQL each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docstrata.functions import links as L
from docstrata.functions import text as X
from docstrata.functions import titles as T
from docstrata.functions import urls as U
from docstrata.functions.canonical import digest, instant, plain_slug, stripped
from docstrata.operators import diff as D
from docstrata.operators import discovery, lifecycle, reports
from docstrata.operators.snapshots import last_snapshots, snapshot, successful_runs
from docstrata.runtime import small, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_CLEAN = r"rtrim(regexp_replace(trim({0}), '[?#].*$', '', 's'), '/')"
_DIGEST = r"nullif(regexp_replace(lower(trim({0}, chr(32) || chr(9) || chr(10) || chr(13))), '^[a-z][a-z0-9_/-]*\s*[:=]\s*', ''), '')"
_SLUG = r"regexp_replace(regexp_replace(regexp_replace({0}, '^(\s|/|\./)+', ''), '[\s/]+$', ''), '\.md$', '')"
_ID = "nullif(trim(source_id, chr(32) || chr(9) || chr(10)), '')"
_RUNS = "runs AS (SELECT run_id, source, started, row_number() OVER (PARTITION BY source ORDER BY started, run_id) AS seq, count(*) OVER (PARTITION BY source) AS n FROM mirror_runs WHERE outcome = 'ok')"


def _snap(name: str, back: int) -> str:
    return f"""{name} AS (SELECT * FROM (SELECT r.source, {_SLUG.format("slug")} AS slug, title, page_group, source_url, {_ID} AS source_id, {_DIGEST.format("hash")} AS hash, last_updated,
      row_number() OVER (PARTITION BY r.source, {_SLUG.format("slug")} ORDER BY loaded_at DESC NULLS LAST, {_DIGEST.format("hash")} DESC NULLS LAST, {_ID} DESC NULLS LAST, title DESC NULLS LAST, page_group DESC NULLS LAST, source_url DESC NULLS LAST, last_updated DESC NULLS LAST) AS k
      FROM manifest_files m JOIN runs r ON m.run_id = r.run_id WHERE r.seq = r.n - {back}) WHERE k = 1)"""


def _newest(spark: SparkSession, d: str) -> DataFrame:
    return snapshot(table(spark, d, "manifest_files"), table(spark, d, "mirror_runs"))


def _old_new(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return last_snapshots(table(spark, d, "manifest_files"), table(spark, d, "mirror_runs"))


_SNAPS = f"WITH {_RUNS}, {_snap('old', 1)}, {_snap('new', 0)}"

# --- URLs and slugs


@query(f"SELECT source, slug, ordinal, {_CLEAN.format('source_md_url')} AS url, lower(regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)) AS host FROM pages")
def url_canonical(spark, d):
    return table(spark, d, "pages").select("source", "slug", "ordinal", U.clean_url(F.col("source_md_url")).alias("url"), U.host(F.col("source_url")).alias("host"))


@query("SELECT lower(regexp_extract(source_md_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)) AS host, count(*) AS pages FROM pages GROUP BY 1")
def url_host_counts(spark, d):
    return table(spark, d, "pages").groupBy(U.host(F.col("source_md_url")).alias("host")).agg(F.count("*").alias("pages"))


@query("SELECT p.source, slug, ordinal, (source_md_url = rtrim(home_url, '/') OR starts_with(source_md_url, rtrim(home_url, '/') || '/')) AS inside FROM pages p JOIN doc_sources s ON p.source = s.source")
def url_same_origin(spark, d):
    sites = small(table(spark, d, "doc_sources").select("source", "home_url"))
    return table(spark, d, "pages").join(sites, "source").select("source", "slug", "ordinal", U.same_origin(F.col("source_md_url"), F.col("home_url")).alias("inside"))


@query("SELECT issue_id, replace(replace(replace(replace(replace(target, '<', '%3C'), '>', '%3E'), chr(10), '%0A'), chr(13), '%0D'), '|', '%7C') AS safe FROM link_issues")
def url_safe(spark, d):
    return table(spark, d, "link_issues").select("issue_id", U.safe_url(F.col("target")).alias("safe"))


@query(f"""SELECT p.source, p.slug, ordinal, CASE WHEN contains(p.slug, '/') THEN regexp_replace(p.slug, '/[^/]*$', '') ELSE '' END AS parent, CASE WHEN contains(p.slug, '/') THEN split_part(p.slug, '/', 1) ELSE 'root' END AS first,
  CASE WHEN {_CLEAN.format('source_url')} = home_url THEN 'index' WHEN starts_with(source_url, home_url || '/') THEN substr({_CLEAN.format('source_url')}, length(home_url) + 2) END AS from_url FROM pages p JOIN doc_sources s ON p.source = s.source""")
def slug_parts(spark, d):
    sites = small(table(spark, d, "doc_sources").select("source", "home_url"))
    s = F.col("slug")
    return table(spark, d, "pages").join(sites, "source").select("source", "slug", "ordinal", U.parent_group(s).alias("parent"), U.first_group(s).alias("first"), U.slug_below(F.col("source_url"), F.col("home_url")).alias("from_url"))


@query(f"SELECT source, slug, ordinal, CASE WHEN regexp_matches({_CLEAN.format('source_md_url')}, '\\.mdx?$') THEN {_CLEAN.format('source_md_url')} ELSE {_CLEAN.format('source_md_url')} || '.md' END AS twin FROM pages")
def url_markdown_twin(spark, d):
    return table(spark, d, "pages").select("source", "slug", "ordinal", U.markdown_twin(F.col("source_md_url")).alias("twin"))


@query("SELECT p.source, slug, ordinal, rtrim(home_url, '/') || CASE WHEN regexp_replace(slug, '(^|/)(index|README)$', '') = '' THEN '' ELSE '/' || regexp_replace(slug, '(^|/)(index|README)$', '') END AS url FROM pages p JOIN doc_sources s ON p.source = s.source")
def url_of_page(spark, d):
    sites = small(table(spark, d, "doc_sources").select("source", "home_url"))
    return table(spark, d, "pages").join(sites, "source").select("source", "slug", "ordinal", U.page_url(F.col("home_url"), F.col("slug")).alias("url"))


@query(r"""SELECT v AS violation, count(*) AS rows FROM (SELECT CASE WHEN slug IS NULL OR trim(slug) = '' THEN 'blank' WHEN slug <> trim(slug, chr(32) || chr(9) || chr(10) || chr(13)) THEN 'padded' WHEN length(slug) > 200 THEN 'long'
  WHEN NOT regexp_full_match(slug, '[A-Za-z0-9._/-]+') THEN 'sign' WHEN starts_with(slug, '/') THEN 'absolute' WHEN list_contains(split(slug, '/'), '..') THEN 'parent' WHEN ends_with(slug, '/') THEN 'trailing' WHEN list_contains(split(slug, '/'), '') THEN 'empty' END AS v FROM manifest_files) GROUP BY 1""")
def slug_violations(spark, d):
    return table(spark, d, "manifest_files").groupBy(U.slug_violation(F.col("slug")).alias("violation")).agg(F.count("*").alias("rows"))


@query("SELECT source, slug, ordinal, (source_id IS NULL OR trim(source_id) = '') AS blank_id FROM pages WHERE source_id IS NULL OR trim(source_id) = '' OR source_id <> trim(source_id)")
def page_quarantine(spark, d):
    _, bad = discovery.checked(table(spark, d, "pages"))
    return bad.select("source", "slug", "ordinal", F.array_contains("violations", "source_id blank").alias("blank_id"))


@query("SELECT source, slug, source_url, source_md_url, source_id, page_group, ordinal FROM pages QUALIFY row_number() OVER (PARTITION BY source, slug ORDER BY ordinal NULLS LAST, source_url NULLS FIRST, source_md_url NULLS FIRST, source_id NULLS FIRST, page_group NULLS FIRST) = 1")
def slug_first_wins(spark, d):
    return lifecycle.first_wins(table(spark, d, "pages"))


@query("SELECT source, slug, count(*) AS copies FROM pages GROUP BY 1, 2 HAVING count(*) > 1")
def slug_duplicates(spark, d):
    return lifecycle.duplicate_slugs(table(spark, d, "pages"))


@query("""WITH p AS (SELECT source, slug, min(ordinal) AS o FROM pages GROUP BY 1, 2), n AS (SELECT *, lead(slug) OVER (PARTITION BY source, regexp_replace(slug, '/?[^/]*$', '') ORDER BY o, slug) AS other FROM p)
  SELECT source, slug, './' || regexp_replace(other, '^.*/', '') || '.md' AS link FROM n WHERE other IS NOT NULL""")
def relative_links(spark, d):
    pages = table(spark, d, "pages").groupBy("source", "slug").agg(F.min("ordinal").alias("o"))
    by = Window.partitionBy("source", U.parent_group(F.col("slug"))).orderBy("o", "slug")
    n = pages.withColumn("other", F.lead("slug").over(by)).where("other is not null")
    return n.select("source", "slug", F.concat(U.relative_path(F.col("other"), F.col("slug")), F.lit(".md")).alias("link"))


# --- groups, indexes, totals


@query("SELECT source, coalesce(nullif(trim(page_group), ''), 'Documentation') AS page_group, count(*) AS pages FROM pages GROUP BY 1, 2")
def group_page_counts(spark, d):
    return reports.group_counts(table(spark, d, "pages"))


_ESC = "title"
for _a, _b in X.TITLE_ESCAPES:
    _lit = lambda s: "chr(10)" if s == "\n" else "chr(13)" if s == "\r" else "'" + s + "'"
    _ESC = f"replace({_ESC}, {_lit(_a)}, {_lit(_b)})"


@query(f"""{_SNAPS}, g AS (SELECT source, coalesce(nullif(trim(page_group), ''), 'Documentation') AS page_group, slug, coalesce(title, '') AS title, coalesce(source_url, '') AS url FROM new)
  SELECT source, page_group, dense_rank() OVER (PARTITION BY source ORDER BY page_group <> 'root', page_group) AS group_pos, slug, '| ' || {_ESC} || ' | [' || slug || '.md](./' || slug || '.md) | [source](<' || replace(replace(replace(replace(replace(url, '<', '%3C'), '>', '%3E'), chr(10), '%0A'), chr(13), '%0D'), '|', '%7C') || '>) |' AS line FROM g""")
def index_order(spark, d):
    return reports.index_lines(_newest(spark, d))


@query(f"""{_SNAPS} SELECT s.source, s.title, coalesce(p.n, 0) AS pages, strftime(r.last AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS last_completed, coalesce(nullif(trim(s.version), ''), '—') AS version
  FROM doc_sources s LEFT JOIN (SELECT source, count(*) AS n FROM new GROUP BY 1) p ON s.source = p.source LEFT JOIN (SELECT source, max(completed) AS last FROM mirror_runs WHERE outcome = 'ok' GROUP BY 1) r ON s.source = r.source""")
def source_stats(spark, d):
    stats = reports.source_stats(table(spark, d, "doc_sources"), _newest(spark, d), table(spark, d, "mirror_runs"))
    return stats.withColumn("last_completed", F.date_format("last_completed", "yyyy-MM-dd HH:mm:ss"))


@query(f"{_SNAPS} SELECT source, count(*) AS pages FROM new GROUP BY ROLLUP (source)")
def source_totals(spark, d):
    counts = _newest(spark, d).groupBy("source").agg(F.count("*").alias("pages"))
    return reports.with_total(counts)


# --- hashes, titles, versions, times


@query("SELECT doc_id, sha256(text) AS hash FROM documents")
def content_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", X.content_hash(F.col("text")).alias("hash"))


@query("SELECT sha256(text) AS hash, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_content(spark, d):
    return table(spark, d, "documents").groupBy(X.content_hash(F.col("text")).alias("hash")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1")


@query(f"SELECT run_id, source, {_SLUG.format('slug')} AS slug, count(*) AS rows, count(DISTINCT {_DIGEST.format('hash')}) AS digests FROM manifest_files GROUP BY 1, 2, 3 HAVING count(*) > 1")
def repeated_entries(spark, d):
    rows = table(spark, d, "manifest_files").select("run_id", "source", plain_slug(F.col("slug")).alias("slug"), digest(F.col("hash")).alias("h"))
    return rows.groupBy("run_id", "source", "slug").agg(F.count("*").alias("rows"), F.count_distinct("h").alias("digests")).where("rows > 1")


_CANON = r"trim(regexp_replace(regexp_replace(lower(trim(title)), '[.,!?]+$', ''), '(\.html|\.md|\.htm)+$', ''))"
_GENERIC = ", ".join(f"'{t}'" for t in T.GENERIC)


@query(f"SELECT DISTINCT title, {_CANON} AS canonical, (length({_CANON}) >= 4 AND {_CANON} NOT IN ({_GENERIC})) AS usable FROM manifest_files WHERE title IS NOT NULL")
def title_canonical(spark, d):
    titles = table(spark, d, "manifest_files").select("title").where("title is not null").distinct()
    c = T.canonical_title(F.col("title"))
    return titles.select("title", c.alias("canonical")).withColumn("usable", T.usable_title(F.col("canonical")))


@query(r"SELECT source, coalesce(nullif(regexp_extract(trim(version), '(\d+\.\d+\.\d+(-[0-9A-Za-z.-]+)?)', 1), ''), nullif(trim(regexp_replace(regexp_replace(trim(version), '^v', ''), '^V', '')), '')) AS version FROM doc_sources")
def version_extract(spark, d):
    return table(spark, d, "doc_sources").select("source", T.version(F.col("version")).alias("version"))


@query("SELECT run_id, strftime(started AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(started AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M UTC') AS stamp, strftime(started AT TIME ZONE 'UTC', '%Y-%m-%d') AS day FROM mirror_runs")
def run_stamps(spark, d):
    at = F.col("started")
    return table(spark, d, "mirror_runs").select("run_id", X.iso_stamp(at).alias("iso"), X.log_stamp(at).alias("stamp"), X.day_key(at).alias("day"))


@query("SELECT entry_id, strftime(try_cast(nullif(trim(last_updated), '') AS TIMESTAMPTZ) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS at FROM file_entries")
def entry_instants(spark, d):
    return table(spark, d, "file_entries").select("entry_id", X.iso_stamp(instant(F.col("last_updated"))).alias("at"))


@query(f"SELECT DISTINCT title, {_ESC} AS escaped, replace(title, '`', chr(39)) AS code, replace(regexp_replace(trim(title), '\\s+', ' ', 'g'), '|', '\\|') AS cell FROM manifest_files WHERE title IS NOT NULL")
def title_escapes(spark, d):
    t = F.col("title")
    return table(spark, d, "manifest_files").select("title").where("title is not null").distinct().select("title", X.title_escaped(t).alias("escaped"), X.code_safe(t).alias("code"), X.table_cell(t).alias("cell"))


@query(r"SELECT DISTINCT title, regexp_replace(regexp_replace(lower(trim(title)), '[^\pL\pN_\s-]', '', 'g'), '\s', '-', 'g') AS anchor FROM manifest_files WHERE title IS NOT NULL")
def heading_anchors(spark, d):
    return table(spark, d, "manifest_files").select("title").where("title is not null").distinct().select("title", X.heading_anchor(F.col("title")).alias("anchor"))


@query("""WITH t AS (SELECT source, slug, title, min(doc_id) AS pos FROM documents WHERE title IS NOT NULL AND slug IS NOT NULL AND source IS NOT NULL GROUP BY ALL), n AS (SELECT source, slug, title, row_number() OVER (PARTITION BY source, title ORDER BY pos) AS k FROM t)
  SELECT source, slug, CASE WHEN k = 1 THEN title ELSE title || '-' || k END AS unique_anchor FROM n""")
def repeated_anchors(spark, d):
    docs = table(spark, d, "documents").where("title is not null and slug is not null and source is not null").groupBy("source", "slug", "title").agg(F.min("doc_id").alias("pos"))
    return reports.occurrence_anchors(docs, "source", "title", "pos").select("source", "slug", "unique_anchor")


@query("SELECT run_id, page_group, slug, (lag(page_group) OVER w IS NULL OR lag(page_group) OVER w IS DISTINCT FROM page_group) AS starts_group FROM (SELECT DISTINCT run_id, page_group, slug FROM manifest_files WHERE page_group IS NOT NULL) WINDOW w AS (PARTITION BY run_id ORDER BY slug, page_group)")
def group_headers(spark, d):
    rows = table(spark, d, "manifest_files").where("page_group is not null").select("run_id", "page_group", "slug").distinct().withColumn("pos", F.struct("slug", "page_group"))
    return reports.heading_changes(rows, "run_id", "page_group", "pos").drop("pos")


# --- snapshot diff

_DIFF = f"""{_SNAPS},
  ups AS (SELECT * FROM new a WHERE EXISTS (SELECT 1 FROM old o WHERE o.source = a.source) AND NOT EXISTS (SELECT 1 FROM old b WHERE b.source = a.source AND b.slug = a.slug)),
  downs AS (SELECT * FROM old a WHERE NOT EXISTS (SELECT 1 FROM new b WHERE b.source = a.source AND b.slug = a.slug)),
  r1 AS (SELECT u.source, u.slug, v.slug AS old_slug, CASE WHEN coalesce(u.title, '') <> '' THEN u.title ELSE coalesce(v.title, '') END AS title, u.source_url, 'source_id' AS matched_by FROM ups u JOIN downs v ON u.source = v.source AND u.source_id = v.source_id
    WHERE (SELECT count(*) FROM ups x WHERE x.source = u.source AND x.source_id = u.source_id) = 1 AND (SELECT count(*) FROM downs x WHERE x.source = u.source AND x.source_id = u.source_id) = 1),
  u2 AS (SELECT *, {_CANON} AS c FROM ups u WHERE NOT EXISTS (SELECT 1 FROM r1 WHERE r1.source = u.source AND r1.slug = u.slug)),
  d2 AS (SELECT *, {_CANON} AS c FROM downs v WHERE NOT EXISTS (SELECT 1 FROM r1 WHERE r1.source = v.source AND r1.old_slug = v.slug)),
  r2 AS (SELECT u.source, u.slug, v.slug AS old_slug, v.title, u.source_url, 'title' AS matched_by FROM u2 u JOIN d2 v ON u.source = v.source AND u.c = v.c
    WHERE length(v.c) >= 4 AND v.c NOT IN ({_GENERIC}) AND (SELECT count(*) FROM u2 x WHERE x.source = u.source AND x.c = u.c) = 1 AND (SELECT count(*) FROM d2 x WHERE x.source = u.source AND x.c = u.c) = 1),
  ren AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2),
  ch AS (SELECT source, 'renamed' AS change_type, slug, old_slug, title, coalesce(source_url, '') AS source_url, matched_by FROM ren
    UNION ALL SELECT source, 'added', slug, NULL, coalesce(title, ''), coalesce(source_url, ''), NULL FROM ups u WHERE NOT EXISTS (SELECT 1 FROM ren WHERE ren.source = u.source AND ren.slug = u.slug)
    UNION ALL SELECT source, 'removed', slug, NULL, coalesce(title, ''), coalesce(source_url, ''), NULL FROM downs v WHERE NOT EXISTS (SELECT 1 FROM ren WHERE ren.source = v.source AND ren.old_slug = v.slug)
    UNION ALL SELECT a.source, 'modified', a.slug, NULL, coalesce(a.title, ''), coalesce(a.source_url, ''), NULL FROM new a JOIN old b ON a.source = b.source AND a.slug = b.slug WHERE coalesce(a.hash, '') <> coalesce(b.hash, ''))"""


@query(f"{_DIFF} SELECT * FROM ch")
def snapshot_changes(spark, d):
    return D.diff(*_old_new(spark, d))


@query(f"{_DIFF} SELECT source, count(*) FILTER (change_type = 'added') AS added, count(*) FILTER (change_type = 'removed') AS removed, count(*) FILTER (change_type = 'modified') AS modified, count(*) FILTER (change_type = 'renamed') AS renamed, count(*) AS total, false AS is_empty FROM ch GROUP BY 1")
def change_totals(spark, d):
    return D.totals(D.diff(*_old_new(spark, d)))


def _log(column: str) -> str:
    text = column
    for a, b in X.LOG_ESCAPES:
        lit = lambda s: " || ".join("chr(10)" if c == "\n" else "chr(13)" if c == "\r" else f"'{c}'" for c in s)
        text = f"replace({text}, {lit(a)}, {lit(b)})"
    return text


_URL = "replace(replace(replace(replace(replace(source_url, '<', '%3C'), '>', '%3E'), chr(10), '%0A'), chr(13), '%0D'), '|', '%7C')"


@query(f"""{_DIFF} SELECT source, change_type, CAST(CASE change_type WHEN 'added' THEN 1 WHEN 'modified' THEN 2 WHEN 'renamed' THEN 3 ELSE 4 END AS BIGINT) AS section_pos, CASE WHEN change_type = 'renamed' THEN CASE WHEN matched_by = 'source_id' THEN '0' ELSE '1' END || old_slug ELSE slug END AS sort_slug,
  '- **' || {_log('title')} || '**' || CASE WHEN change_type = 'renamed' THEN ' moved `' || old_slug || '` → `' || slug || '` (matched by ' || matched_by || ')' ELSE ' — `' || slug || '`' END || ' — [source](<' || {_URL} || '>)' || CASE WHEN change_type = 'removed' THEN ' (no longer in the source; possibly deprecated)' ELSE '' END AS line FROM ch""")
def change_log_lines(spark, d):
    return reports.log_lines(D.diff(*_old_new(spark, d)))


@query(f"{_SNAPS} SELECT source, slug, 'new' AS drift FROM (SELECT DISTINCT source, slug FROM pages) p WHERE NOT EXISTS (SELECT 1 FROM new o WHERE o.source = p.source AND o.slug = p.slug) UNION ALL SELECT source, slug, 'gone' FROM new o WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE o.source = p.source AND o.slug = p.slug)")
def structural_drift(spark, d):
    return D.drift(table(spark, d, "pages"), _newest(spark, d))


# --- refresh of a snapshot

_FAILED = """fl AS (SELECT DISTINCT m.source, x AS slug FROM run_metadata m JOIN runs r ON m.run_id = r.run_id AND r.seq = r.n, unnest(failed_pages) AS u(x) WHERE x IS NOT NULL),
  got AS (SELECT * FROM new a WHERE NOT EXISTS (SELECT 1 FROM fl WHERE fl.source = a.source AND fl.slug = a.slug))"""


def _refresh(spark, d):
    old, new = _old_new(spark, d)
    last = small(successful_runs(table(spark, d, "mirror_runs")).where("seq = last_seq").select("run_id"))
    failed = table(spark, d, "run_metadata").join(last, "run_id").select("source", F.explode("failed_pages").alias("slug")).where("slug is not null").distinct()
    return old, new.join(failed, ["source", "slug"], "left_anti"), failed


@query(f"{_SNAPS}, {_FAILED} SELECT source, slug, hash, false AS carried FROM got UNION ALL SELECT source, slug, hash, true FROM old o WHERE EXISTS (SELECT 1 FROM fl WHERE fl.source = o.source AND fl.slug = o.slug) AND NOT EXISTS (SELECT 1 FROM got g WHERE g.source = o.source AND g.slug = o.slug)")
def carry_forward(spark, d):
    old, fetched, failed = _refresh(spark, d)
    return lifecycle.carried_forward(fetched, failed, old).select("source", "slug", "hash", "carried")


@query(f"""{_SNAPS} SELECT a.source, a.slug, (b.hash IS NULL OR b.hash IS DISTINCT FROM a.hash) AS is_written, CASE WHEN b.hash IS NOT NULL AND b.hash = a.hash AND b.last_updated IS NOT NULL THEN strftime(b.last_updated AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') ELSE '2025-12-01T00:00:00Z' END AS last_updated FROM new a LEFT JOIN old b ON a.source = b.source AND a.slug = b.slug""")
def stamp_last_updated(spark, d):
    old, new = _old_new(spark, d)
    return lifecycle.stamped(new, old, "2025-12-01T00:00:00Z").select("source", "slug", "is_written", X.iso_stamp(F.col("last_updated")).alias("last_updated"))


@query(f"{_SNAPS} SELECT a.source, a.slug FROM new a LEFT JOIN old b ON a.source = b.source AND a.slug = b.slug WHERE b.hash IS NULL OR b.hash IS DISTINCT FROM a.hash")
def write_set(spark, d):
    old, new = _old_new(spark, d)
    return lifecycle.stamped(new, old, "2025-12-01T00:00:00Z").where("is_written").select("source", "slug")


@query(f"{_SNAPS} SELECT source, slug FROM old o WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE o.source = p.source AND o.slug = p.slug)")
def delete_set(spark, d):
    return lifecycle.deletions(_old_new(spark, d)[0], table(spark, d, "pages"))


@query(f"""{_SNAPS}, c AS (SELECT o.source, count(*) AS n, count(*) FILTER (NOT EXISTS (SELECT 1 FROM new p WHERE o.source = p.source AND o.slug = p.slug)) AS gone FROM old o GROUP BY 1)
  SELECT source, n AS old_pages, gone AS deleted, round(gone / n, 6) AS ratio, gone > n * 0.5 AS is_blocked FROM c""")
def delete_ratio(spark, d):
    old, new = _old_new(spark, d)
    return lifecycle.deletion_ratios(old, new)


@query(f"""{_DIFF}, c AS (SELECT s.source, coalesce((SELECT count(*) FROM old o WHERE o.source = s.source), 0) AS n, coalesce((SELECT count(*) FROM ch WHERE ch.source = s.source), 0) AS k, generate_whats_new AS g FROM doc_sources s)
  SELECT source, n = 0 AS is_baseline, k > 0 AS has_changes, n = 0 OR k > 0 AS saves, coalesce(g, false) AND n > 0 AND k > 0 AS logs FROM c""")
def run_gates(spark, d):
    old, new = _old_new(spark, d)
    return lifecycle.gates(D.diff(old, new), table(spark, d, "doc_sources"), old)


@query("""WITH m AS (SELECT source, run_id, sum(discovered) AS discovered, sum(fetched) AS fetched, sum(failed) AS failed, round(max(duration_s), 3) AS duration_s, bool_and(coalesce(failed, 0) = 0) AS all_fresh FROM run_metadata GROUP BY 1, 2),
  f AS (SELECT source, run_id, count(DISTINCT trim(x, chr(32) || chr(9) || chr(10) || chr(13))) AS n FROM run_metadata, unnest(failed_pages) AS u(x) WHERE trim(x, chr(32) || chr(9) || chr(10) || chr(13)) <> '' GROUP BY 1, 2)
  SELECT m.source, m.run_id, CAST(discovered AS BIGINT) AS discovered, CAST(fetched AS BIGINT) AS fetched, CAST(failed AS BIGINT) AS failed, duration_s, all_fresh, coalesce(f.n, 0) AS failed_pages FROM m LEFT JOIN f ON m.source = f.source AND m.run_id = f.run_id""")
def run_stats(spark, d):
    return lifecycle.run_statistics(table(spark, d, "run_metadata")).drop("completed")


@query("""WITH s AS (SELECT source, nullif(nullif(trim(version), ''), '—') AS v, length(source) AS n FROM doc_sources)
  SELECT source, coalesce(CASE WHEN n % 3 = 0 THEN '9.' || n || '.0' END, CASE WHEN n % 2 = 0 THEN '1.' || n END, v, '—') AS version FROM s""")
def versions_resolved(spark, d):
    """Sources with a probed version (some blank), with one of the run before, with the configured one, and with none."""
    sources = table(spark, d, "doc_sources")
    n = F.length("source")
    probed = sources.where(n % 3 < 2).select("source", F.when(n % 3 == 0, F.concat(F.lit("9."), n, F.lit(".0"))).otherwise(" ").alias("version"))
    before = sources.where(n % 2 == 0).select("source", F.concat(F.lit("1."), n).alias("version"))
    return lifecycle.resolved_versions(sources, probed, before)


# --- links

_RAW = r"trim(regexp_replace(trim(target), '^<(.*)>$', '\1'))"
_EXT = "|".join(L.EXTERNAL_SCHEMES)
_KIND = f"CASE WHEN {_RAW} = '' OR regexp_matches({_RAW}, '^[?#]') OR starts_with({_RAW}, '//') OR regexp_matches({_RAW}, '(?i)^({_EXT}):') OR target IS NULL THEN NULL WHEN starts_with({_RAW}, '/') THEN 'site-absolute' ELSE 'relative' END"


@query(f"SELECT {_KIND} AS kind, count(*) AS links FROM link_issues GROUP BY 1")
def link_kinds(spark, d):
    return table(spark, d, "link_issues").groupBy(L.destination_kind(F.col("target")).alias("kind")).agg(F.count("*").alias("links"))


@query(f"SELECT issue_id, replace(url_decode(replace(trim(regexp_replace({_RAW}, '[?#].*$', '', 's')), '+', '%2B')), '%2B', '+') AS path FROM link_issues WHERE {_KIND} = 'relative'")
def link_paths(spark, d):
    return table(spark, d, "link_issues").where(L.destination_kind(F.col("target")) == "relative").select("issue_id", U.unescaped_path(F.col("target")).alias("path"))


@query("SELECT file, count(*) AS issues, min(line) AS first_line FROM link_issues WHERE trim(file) <> '' GROUP BY 1")
def issues_by_file(spark, d):
    return reports.issues_by_file(table(spark, d, "link_issues"))


@query("SELECT l.issue_id, list_contains(illustrative_link_targets, target) AS is_exempt FROM link_issues l JOIN doc_sources s ON l.source = s.source WHERE target IS NOT NULL")
def link_exemptions(spark, d):
    rules = small(table(spark, d, "doc_sources").select("source", "illustrative_link_targets"))
    return table(spark, d, "link_issues").where("target is not null").join(rules, "source").select("issue_id", F.array_contains("illustrative_link_targets", F.col("target")).alias("is_exempt"))


# --- sets


@query("SELECT source, slug FROM pages EXCEPT SELECT source, slug FROM documents")
def pages_without_document(spark, d):
    return table(spark, d, "pages").select("source", "slug").subtract(table(spark, d, "documents").select("source", "slug"))


@query("SELECT source, slug FROM pages INTERSECT SELECT source, slug FROM raw_docs")
def pages_fetched(spark, d):
    return table(spark, d, "pages").select("source", "slug").intersect(table(spark, d, "raw_docs").select("source", "slug"))


@query("""SELECT source, slug, channel FROM (SELECT source, slug, 0 AS channel, min(ordinal) AS o, min(source_url) AS u FROM pages WHERE page_group IS NOT NULL AND trim(page_group) <> '' GROUP BY 1, 2 UNION ALL SELECT source, slug, 1, min(ordinal), min(source_url) FROM pages GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY source, slug ORDER BY channel, o, u) = 1""")
def merged_channels(spark, d):
    pages = table(spark, d, "pages")
    one = lambda p, n: p.groupBy("source", "slug").agg(F.min("ordinal").alias("ordinal"), F.min("source_url").alias("source_url")).withColumn("channel", F.lit(n))
    return discovery.merged([one(pages.where(stripped(F.col("page_group")) != ""), 0), one(pages, 1)]).select("source", "slug", "channel")


@query("SELECT source, count(DISTINCT source_id) AS ids, count(*) FILTER (WHERE c = 1) AS unique_ids FROM (SELECT source, source_id, count(*) AS c FROM pages WHERE trim(source_id) <> '' GROUP BY 1, 2) GROUP BY 1")
def unique_keys(spark, d):
    by = table(spark, d, "pages").where(F.trim("source_id") != "").groupBy("source", "source_id").agg(F.count("*").alias("c"))
    return by.groupBy("source").agg(F.count("*").alias("ids"), F.count_if(F.col("c") == 1).alias("unique_ids"))


@query("""SELECT source, max_by(run_id, started) AS run_id, max_by(outcome, started) AS outcome FROM mirror_runs GROUP BY 1""")
def latest_runs(spark, d):
    return table(spark, d, "mirror_runs").groupBy("source").agg(F.max_by("run_id", "started").alias("run_id"), F.max_by("outcome", "started").alias("outcome"))


@query("""SELECT page_group AS section, source AS feature, count(*) FILTER (WHERE outcome = 'yes') AS yes, count(*) FILTER (WHERE outcome = 'no') AS no FROM (SELECT DISTINCT coalesce(page_group, '') AS page_group, source, slug, CASE WHEN hash IS NULL THEN 'no' ELSE 'yes' END AS outcome FROM manifest_files) GROUP BY 1, 2""")
def plan_matrix(spark, d):
    rows = table(spark, d, "manifest_files").select(F.coalesce("page_group", F.lit("")).alias("section"), F.col("source").alias("feature"), "slug", F.when(F.col("hash").isNull(), "no").otherwise("yes").alias("plan")).distinct()
    counted = rows.groupBy("section", "feature", "plan").agg(F.count("*").alias("value"))
    return reports.feature_matrix(counted, ["yes", "no"]).na.fill(0, ["yes", "no"])
