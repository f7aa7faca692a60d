"""Queries of the general data problems (p1, p3, p4) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docstrata.operators import ledger, orphans, snapshots
from docstrata.runtime import fresh_path, table


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_links(*(table(spark, d, t) for t in ("link_issues", "manifest_files", "mirror_runs", "doc_sources", "link_reasons")))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("issue_id", "field", "kind")


def p1_weekly(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(_orphans(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return ledger.due_entries(spark, table(spark, d, "file_entries"), table(spark, d, "mirror_runs"), fresh_path(spark, "ledger"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.snapshot_changes(table(spark, d, "manifest_files"), table(spark, d, "mirror_runs"))


def p4_totals(spark: SparkSession, d: str) -> DataFrame:
    """Changes per source, run and kind."""
    return p4_found(spark, d).groupBy("source", "run_id", "change_type").count().withColumnRenamed("count", "pages")


QUERIES = {q.__name__: q for q in (p1_found, p1_weekly, p3_found, p4_found, p4_totals)}

_DIGEST = r"""nullif(regexp_replace(lower(trim({0}, chr(32) || chr(9) || chr(10) || chr(13))), '^[a-z][a-z0-9_/-]*\s*[:=]\s*', ''), '')"""
_SLUG = r"""regexp_replace(regexp_replace(regexp_replace({0}, '^(\s|/|\./)+', ''), '[\s/]+$', ''), '\.md$', '')"""

_P4 = rf"""
WITH ok AS (SELECT run_id, source, row_number() OVER (PARTITION BY source ORDER BY started, run_id) AS seq, count(*) OVER (PARTITION BY source) AS n FROM mirror_runs WHERE outcome = 'ok'),
snap AS (
  SELECT ok.source, seq, n, {_SLUG.format("slug")} AS slug, {_DIGEST.format("hash")} AS h, nullif(trim(source_id, chr(32) || chr(9) || chr(10)), '') AS sid,
    row_number() OVER (PARTITION BY ok.source, seq, {_SLUG.format("slug")} ORDER BY loaded_at DESC NULLS LAST, {_DIGEST.format("hash")} DESC NULLS LAST, source_id DESC NULLS LAST) AS k
  FROM manifest_files m JOIN ok ON m.run_id = ok.run_id),
page AS (SELECT * FROM snap WHERE k = 1),
ups AS (SELECT * FROM page a WHERE seq > 1 AND NOT EXISTS (SELECT 1 FROM page b WHERE b.source = a.source AND b.seq = a.seq - 1 AND b.slug = a.slug)),
downs AS (SELECT source, seq + 1 AS seq, slug, sid FROM page a WHERE seq < n AND NOT EXISTS (SELECT 1 FROM page b WHERE b.source = a.source AND b.seq = a.seq + 1 AND b.slug = a.slug)),
ren AS (
  SELECT u.source, u.seq, u.slug, v.slug AS old_slug FROM ups u JOIN downs v ON u.source = v.source AND u.seq = v.seq AND u.sid = v.sid
  WHERE (SELECT count(*) FROM ups x WHERE x.source = u.source AND x.seq = u.seq AND x.sid = u.sid) = 1 AND (SELECT count(*) FROM downs x WHERE x.source = u.source AND x.seq = u.seq AND x.sid = u.sid) = 1),
alls AS (
  SELECT source, seq, 'renamed' AS change_type, slug, old_slug FROM ren
  UNION ALL SELECT source, seq, 'added', slug, '' FROM ups a WHERE NOT EXISTS (SELECT 1 FROM ren r WHERE r.source = a.source AND r.seq = a.seq AND r.slug = a.slug)
  UNION ALL SELECT source, seq, 'removed', slug, '' FROM downs a WHERE NOT EXISTS (SELECT 1 FROM ren r WHERE r.source = a.source AND r.seq = a.seq AND r.old_slug = a.slug)
  UNION ALL SELECT b.source, b.seq, 'changed', b.slug, '' FROM page a JOIN page b ON a.source = b.source AND a.slug = b.slug AND b.seq = a.seq + 1 WHERE a.h <> b.h)
SELECT alls.source, ok.run_id, change_type, slug, old_slug FROM alls JOIN ok ON alls.source = ok.source AND alls.seq = ok.seq
"""

_P3 = rf"""
WITH ok AS (SELECT run_id, source, started, row_number() OVER (PARTITION BY source ORDER BY started, run_id) AS seq FROM mirror_runs WHERE outcome = 'ok'),
e AS (SELECT entry_id, source, slug, {_DIGEST.format("hash")} AS h, arrived_at, coalesce(try_cast(nullif(trim(last_updated), '') AS TIMESTAMPTZ), arrived_at) AS upd FROM file_entries),
st AS (
  SELECT ok.source, seq, run_id, slug, entry_id, h FROM e JOIN ok ON e.source = ok.source AND arrived_at <= started WHERE h IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY ok.source, seq, slug ORDER BY upd DESC, entry_id DESC) = 1)
SELECT a.run_id, a.entry_id FROM st a LEFT JOIN st b ON a.source = b.source AND a.slug = b.slug AND b.seq = a.seq - 1 WHERE b.h IS NULL OR b.h <> a.h
"""

_P1 = rf"""
WITH RECURSIVE ok AS (SELECT run_id, source, completed, row_number() OVER (PARTITION BY source ORDER BY completed, run_id) AS seq FROM mirror_runs WHERE outcome = 'ok'),
page0 AS (SELECT DISTINCT ok.source, ok.completed, {_SLUG.format("slug")} AS slug FROM manifest_files m JOIN ok ON m.run_id = ok.run_id),
page AS (SELECT source, completed, slug FROM page0 UNION SELECT source, completed, regexp_replace(slug, '(README|index)$', '') FROM page0 WHERE regexp_matches(slug, '(^|/)(README|index)$')),
i AS (
  SELECT issue_id, source, checked_at, reason, nullif(regexp_replace(trim(file), '^(\./)+', ''), '') AS file, regexp_replace(trim(target), '^<(.*)>$', '\1') AS raw,
    regexp_replace(regexp_replace(trim(target), '^<(.*)>$', '\1'), '[?#].*$', '', 's') AS written FROM link_issues),
paths AS (
  SELECT issue_id, checked_at, 'file' AS field, file AS path FROM i WHERE file IS NOT NULL
  UNION ALL
  SELECT issue_id, checked_at, 'target', regexp_replace(regexp_replace(file, '[^/]*$', ''), '^docs/', '') || replace(url_decode(replace(written, '+', '%2B')), '%2B', '+') FROM i LEFT JOIN doc_sources s ON i.source = s.source
  WHERE file IS NOT NULL AND written <> '' AND NOT regexp_matches(raw, '^(/|[A-Za-z][A-Za-z0-9+.-]*:)') AND NOT coalesce(list_contains(illustrative_link_targets, written), false)),
norm AS (
  SELECT issue_id, checked_at, field, regexp_replace(path, '(^|/)(\./)+', '\1', 'g') AS path FROM paths
  UNION ALL
  SELECT issue_id, checked_at, field, regexp_replace(path, '(^|/)[^/]+/\.\./', '\1') FROM norm WHERE regexp_matches(path, '(^|/)[^./][^/]*/\.\./')),
fin AS (SELECT issue_id, checked_at, field, regexp_replace(path, '^docs/', '') AS path FROM norm WHERE NOT regexp_matches(path, '(^|/)[^./][^/]*/\.\./')),
ref AS (SELECT *, split_part(path, '/', 1) AS src, CASE WHEN path LIKE '%.md' THEN regexp_replace(substr(path, length(split_part(path, '/', 1)) + 2), '\.md$', '') WHEN path LIKE '%/' THEN substr(path, length(split_part(path, '/', 1)) + 2) ELSE '?' END AS slug, path LIKE '%/' AS dir FROM fin),
state AS (
  SELECT issue_id, field, (SELECT max(completed) FROM ok WHERE ok.source = src AND completed <= checked_at) AS snap,
    (SELECT count(*) FROM page p WHERE p.source = src AND p.slug = ref.slug AND p.completed <= checked_at) AS before,
    (SELECT count(*) FROM page p WHERE p.source = src AND p.slug = ref.slug AND p.completed > checked_at) AS after,
    (SELECT max(completed) FROM page p WHERE p.source = src AND p.slug = ref.slug AND p.completed <= checked_at) AS seen FROM ref)
SELECT issue_id, field, CASE WHEN before > 0 THEN 'deleted' WHEN after > 0 THEN 'late' ELSE 'missing' END AS kind FROM state WHERE seen IS NULL OR seen <> snap
UNION ALL
SELECT issue_id, 'reason', CASE WHEN r.reason IS NULL THEN 'missing' WHEN retired_at <= checked_at THEN 'deleted' ELSE 'late' END
FROM i LEFT JOIN link_reasons r ON lower(trim(i.reason)) = lower(trim(r.reason)) WHERE nullif(trim(i.reason), '') IS NOT NULL AND (r.reason IS NULL OR retired_at <= checked_at OR checked_at < active_from)
"""

SQL = {
    "p1_found": _P1,
    "p1_weekly": f"SELECT strftime(date_trunc('week', checked_at AT TIME ZONE 'UTC'), '%Y-%m-%d') AS week, field, kind, count(*) AS orphans FROM ({_P1}) f JOIN link_issues l USING (issue_id) GROUP BY ALL",
    "p3_found": _P3,
    "p4_found": _P4,
    "p4_totals": f"SELECT source, run_id, change_type, count(*) AS pages FROM ({_P4}) GROUP BY ALL",
}
