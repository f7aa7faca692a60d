"""SQL of the text queries: the grammars of fences and what rests on them, over tables of lines.

Written from the definitions, not from the scanners: every fence line is joined with the lines behind it that could close
it, and a recursive walk goes from block to block.
"""

from __future__ import annotations

_LINES = """
b AS (SELECT raw_id, slug, body FROM raw_docs WHERE body IS NOT NULL),
split AS (SELECT raw_id, string_split(body, chr(10)) AS x FROM b),
line0 AS (SELECT raw_id, unnest(x) AS line, generate_subscripts(x, 1) AS n FROM split),
lines AS (SELECT raw_id, n, line, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY raw_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM line0),
fences AS (SELECT raw_id, n, start, start + length(line) AS stop, regexp_extract(line, '^[ \\t]*') AS pad, regexp_extract(line, '^[ \\t]*(`{3,}|~{3,})', 1) AS run, regexp_replace(line, '^[ \\t]*(`{3,}|~{3,})', '') AS info FROM lines WHERE regexp_matches(line, '^[ \\t]*(`{3,}|~{3,})'))"""

#: grammar -> (condition on what stands before, condition on a closer c of an opener o, order of closers, begins with its line, condition on openers)
_FEWER = "regexp_matches(o.pad, '^ {0,3}$') AND regexp_matches(c.pad, '^ {0,3}$')"
_FLUSH = "o.pad = '' AND c.pad = ''"
_LONGER = "c.run[1] = o.run[1] AND length(c.run) >= length(o.run)"
_GRAMMARS = {
    "title": (_FLUSH, "c.run = o.run[:3]", "c.n", False, "true"),
    "block": (_FLUSH, "starts_with(o.run, c.run)", "length(c.run) DESC, c.n", False, "true"),
    "indented": (_FEWER, "starts_with(o.run, c.run)", "length(c.run) DESC, c.n", False, "true"),
    "component": ("true", _LONGER, "c.n", True, "NOT (o.run[1] = '`' AND contains(o.info, '`'))"),
    "link": (_FEWER, _LONGER, "c.n", True, "regexp_matches(o.pad, '^ {0,3}$')"),
}


def _spans(g: str) -> str:
    pads, closes, order, with_pad, opens = _GRAMMARS[g]
    pair = f"SELECT o.raw_id, o.n, o.start + {'0' if with_pad else 'length(o.pad)'} AS a, c.n AS last, c.stop AS b, row_number() OVER (PARTITION BY o.raw_id, o.n ORDER BY {order}) AS k FROM fences o JOIN fences c ON o.raw_id = c.raw_id AND c.n > o.n AND trim(c.info, chr(32) || chr(9) || chr(13)) = '' AND {closes} AND {pads} WHERE {opens}"
    if g == "link":  # an opener without a closer is closed by the end of the text
        pair += " UNION ALL SELECT o.raw_id, o.n, o.start, 1000000000, length(b.body), 1000000000 FROM fences o JOIN b ON o.raw_id = b.raw_id WHERE " + opens
    best = f"best_{g} AS (SELECT raw_id, n, arg_min(a, k) AS a, arg_min(last, k) AS last, arg_min(b, k) AS b FROM ({pair}) p GROUP BY raw_id, n)"
    walk = f"walk_{g} AS (SELECT raw_id, (SELECT min(n) FROM best_{g} x WHERE x.raw_id = d.raw_id) AS n FROM (SELECT DISTINCT raw_id FROM best_{g}) d UNION ALL SELECT w.raw_id, (SELECT min(x.n) FROM best_{g} x WHERE x.raw_id = w.raw_id AND x.n > y.last) FROM walk_{g} w JOIN best_{g} y ON w.raw_id = y.raw_id AND w.n = y.n)"
    return f"{best}, {walk}, spans_{g} AS (SELECT raw_id, a, b, best_{g}.n, last FROM walk_{g} JOIN best_{g} USING (raw_id, n))"


def _with(*grammars: str) -> str:
    return f"WITH RECURSIVE {_LINES.strip()}, " + ", ".join(_spans(g) for g in grammars)


#: Lines that are in no block of a grammar.
def _outside(g: str) -> str:
    return f"SELECT * FROM lines l WHERE NOT EXISTS (SELECT 1 FROM spans_{g} s WHERE s.raw_id = l.raw_id AND l.n BETWEEN s.n AND s.last)"


FENCE_SPANS = _with(*_GRAMMARS) + " " + " UNION ALL ".join(f"SELECT raw_id, '{g}' AS grammar, CAST(a AS INT) AS start, CAST(b AS INT) AS \"end\" FROM spans_{g}" for g in _GRAMMARS)

FENCES_STRIPPED = _with("title") + " SELECT b.raw_id, CAST(length(body) - coalesce(sum(least(s.b + 1, length(body)) - a), 0) AS INT) AS chars FROM b LEFT JOIN spans_title s ON b.raw_id = s.raw_id GROUP BY b.raw_id, body"

BLANK_RUNS = _with("block") + r""",
cuts AS (SELECT raw_id, a, b FROM spans_block UNION ALL SELECT raw_id, length(body), length(body) FROM b),
gaps AS (SELECT raw_id, coalesce(lag(b) OVER (PARTITION BY raw_id ORDER BY a, b), 0) AS f, a AS t, b FROM cuts)
SELECT b.raw_id, CAST(sum(length(regexp_replace(substr(body, f + 1, t - f), '\n{3,}', chr(10) || chr(10), 'g')) + g.b - g.t) AS INT) AS chars FROM gaps g JOIN b USING (raw_id) GROUP BY b.raw_id"""

HEADINGS_DEMOTED = _with("component") + r""",
free AS (SELECT raw_id, n FROM (""" + _outside("component") + r""") o),
new AS (SELECT l.raw_id, l.n, CASE WHEN f.n IS NOT NULL AND regexp_matches(line, '^ {0,3}#{1,6}[ \t]+\S') THEN repeat('#', least(6, length(regexp_extract(line, '^ *(#+)', 1)) + 1)) || regexp_replace(line, '^ *#+', '') ELSE line END AS line FROM lines l LEFT JOIN free f ON l.raw_id = f.raw_id AND l.n = f.n)
SELECT raw_id, sha256(string_agg(line, chr(10) ORDER BY n)) AS hash FROM new GROUP BY raw_id"""

#: Front matter's last line: the first line of three dashes behind one at the top.
_FRONT = r"""
top AS (SELECT raw_id, min(n) AS n FROM lines WHERE trim(replace(line, chr(65279), ''), chr(32) || chr(9) || chr(13)) <> '' GROUP BY 1),
front AS (SELECT t.raw_id, t.n AS first, (SELECT min(e.n) FROM lines e WHERE e.raw_id = t.raw_id AND e.n > t.n AND regexp_matches(e.line, '^---[ \t]*\r?$')) AS last FROM top t JOIN lines l ON t.raw_id = l.raw_id AND t.n = l.n WHERE regexp_matches(replace(l.line, chr(65279), ''), '^\s*---[ \t]*\r?$')),
field AS (SELECT l.raw_id, l.n, f.last, regexp_extract(line, '^([A-Za-z_][\w.-]*)[ \t]*:[ \t]*([^\n]*?)[ \t\r]*$', 1) AS key, regexp_extract(line, '^([A-Za-z_][\w.-]*)[ \t]*:[ \t]*([^\n]*?)[ \t\r]*$', 2) AS value FROM lines l JOIN front f ON l.raw_id = f.raw_id AND l.n > f.first AND l.n < f.last)"""

MARKDOWN_TITLES = _with("title") + "," + _FRONT + r""",
named AS (SELECT raw_id, arg_min(trim(value, '"'''), n) AS title FROM field WHERE lower(key) = 'title' AND trim(value, ' "''') <> '' GROUP BY raw_id),
below AS (SELECT o.* FROM (""" + _outside("title") + r""") o LEFT JOIN front f ON o.raw_id = f.raw_id WHERE f.last IS NULL OR o.n > f.last),
atx AS (SELECT raw_id, arg_min(trim(regexp_replace(trim(regexp_extract(replace(line, chr(65279), ''), '^ {0,3}#{1,6}[ \t]+(\S[^\n]*)$', 1), chr(32) || chr(9) || chr(13)), '\s#+$', ''), chr(32) || chr(9) || chr(13)), n) AS title FROM below WHERE regexp_matches(replace(line, chr(65279), ''), '^ {0,3}#{1,6}[ \t]+\S') GROUP BY raw_id),
pair AS (SELECT raw_id, n, line, lag(line) OVER (PARTITION BY raw_id ORDER BY n) AS above FROM below),
under AS (SELECT raw_id, arg_min(trim(above, chr(32) || chr(9) || chr(13)), n) AS title FROM pair WHERE regexp_matches(line, '^[-=]{2,}[ \t\r]*$') AND trim(above, chr(32) || chr(9) || chr(13) || '-=') <> '' GROUP BY raw_id)
SELECT b.raw_id, coalesce(named.title, nullif(atx.title, ''), under.title, slug) AS title FROM b LEFT JOIN named USING (raw_id) LEFT JOIN atx USING (raw_id) LEFT JOIN under USING (raw_id)"""

_INLINE_LINK = r"""\]\(\s*(<[^<>\n]+>|[^\s()]+(?:\([^\s()]*\)[^\s()]*)*)(?:\s+(?:"[^"]*"|''[^'']*''|\([^()]*\)))?\s*\)"""

#: Links of the lines outside fences, inline code blanked out: runs of three, two and one backticks, each up to the next as long.
DOCUMENT_LINKS_CTE = _with("link") + r""",
seen AS (SELECT raw_id, n, regexp_replace(regexp_replace(line, '(^|[^`])``[^`]+``', '\1 ', 'g'), '(^|[^`])`[^`]+`', '\1 ', 'g') AS line FROM (""" + _outside("link") + rf""") o),
links AS (SELECT raw_id, n, unnest(regexp_extract_all(line, '{_INLINE_LINK}', 1)) AS target FROM seen
  UNION ALL SELECT raw_id, n, regexp_extract(line, '^ {{0,3}}\[[^\]\n]+\]:\s*(<[^<>\n]+>|\S+)(?:\s+(?:"[^"]*"|''[^'']*''|\([^()]*\)))?\s*$', 1) FROM seen WHERE regexp_matches(line, '^ {{0,3}}\[[^\]\n]+\]:\s*(<[^<>\n]+>|\S+)(?:\s+(?:"[^"]*"|''[^'']*''|\([^()]*\)))?\s*$')
  UNION ALL SELECT raw_id, n, unnest(regexp_extract_all(line, '(?i)\b(?:href|src)\s*=\s*"([^"]*)"', 1)) FROM seen
  UNION ALL SELECT raw_id, n, unnest(regexp_extract_all(line, '(?i)\b(?:href|src)\s*=\s*''([^'']*)''', 1)) FROM seen)"""

#: Every field of front matter whose lines are fields, fields one level below, items and comments only.
FRONT_FIELDS = _with("title") + "," + _FRONT + r""",
inner_field AS (SELECT l.raw_id, l.n, regexp_extract(line, '^[ \t]+([A-Za-z_][\w.-]*)[ \t]*:[ \t]+([^\n]*?)[ \t\r]*$', 1) AS key, regexp_extract(line, '^[ \t]+([A-Za-z_][\w.-]*)[ \t]*:[ \t]+([^\n]*?)[ \t\r]*$', 2) AS value FROM lines l JOIN front f ON l.raw_id = f.raw_id AND l.n > f.first AND l.n < f.last),
odd AS (SELECT DISTINCT l.raw_id FROM lines l JOIN front f ON l.raw_id = f.raw_id AND l.n > f.first AND l.n < f.last WHERE trim(line, chr(32) || chr(9) || chr(13)) <> '' AND NOT regexp_matches(line, '^\s*#') AND NOT regexp_matches(line, '^[A-Za-z_][\w.-]*[ \t]*:') AND NOT regexp_matches(line, '^[\s-]')),
outer_of AS (SELECT i.raw_id, i.n, (SELECT arg_max(key, f.n) FROM field f WHERE f.raw_id = i.raw_id AND f.n < i.n AND f.key <> '') AS outer_key FROM inner_field i WHERE i.key <> ''),
both_kinds AS (SELECT raw_id, n, key AS field, value FROM field WHERE key <> '' AND value <> '' UNION ALL SELECT i.raw_id, i.n, outer_key || '.' || i.key, i.value FROM inner_field i JOIN outer_of o ON i.raw_id = o.raw_id AND i.n = o.n WHERE outer_key IS NOT NULL)
SELECT raw_id, field, arg_max(trim(value, '"'''), n) AS value FROM both_kinds WHERE raw_id NOT IN (FROM odd) AND raw_id IN (SELECT raw_id FROM front WHERE last IS NOT NULL) GROUP BY ALL"""

#: Pages with one link to a Markdown file, at most one heading and little prose beside them, below their front matter.
STUB_PAGES = r"""WITH t AS (SELECT raw_id, regexp_replace(regexp_replace(body, '^' || chr(65279) || '+', ''), '\A\s*---[ \t]*\r?\n([^\n]*\n)*?---[ \t]*(\r?\n|\z)', '') AS body FROM raw_docs WHERE body IS NOT NULL)
  SELECT raw_id FROM t WHERE len(regexp_extract_all(body, '\[[^\[\]]*\]\([^()\s]+\.md(#[^()\s]*)?\)')) = 1 AND len(regexp_extract_all(body, '(?m)^ {0,3}#{1,6}[ \t]+\S[^\n]*$')) <= 1
  AND length(trim(regexp_replace(body, '(?m)\[([^\[\]]*)\]\([^()]*\)|^ {0,3}#{1,6}[^\n]*$', '\1', 'g'), chr(32) || chr(9) || chr(10) || chr(13))) < 300"""

#: Relative links of the bodies that lead to no page, and to no README or index below what they name.
BROKEN_LINKS = DOCUMENT_LINKS_CTE + r""",
rel AS (SELECT l.raw_id, n, target, r.source, regexp_replace(r.slug, '[^/]*$', '') || regexp_replace(regexp_replace(target, '^<(.*)>$', '\1'), '[?#].*$', '', 's') AS path FROM links l JOIN raw_docs r ON l.raw_id = r.raw_id JOIN doc_sources d ON r.source = d.source
  WHERE NOT regexp_matches(regexp_replace(target, '^<(.*)>$', '\1'), '^(/|[A-Za-z][A-Za-z0-9+.-]*:|[?#]|$)') AND NOT coalesce(list_contains(illustrative_link_targets, target), false)),
walk AS (SELECT raw_id, n, target, source, regexp_replace(path, '(^|/)(\./)+', '\1', 'g') AS path FROM rel UNION ALL SELECT raw_id, n, target, source, regexp_replace(path, '(^|/)[^/]+/\.\./', '\1') FROM walk WHERE regexp_matches(path, '(^|/)[^./][^/]*/\.\./')),
have AS (SELECT DISTINCT source, slug AS path FROM pages UNION SELECT DISTINCT source, regexp_replace(slug, '(^|/)(README|index)$', '/') FROM pages WHERE regexp_matches(slug, '(^|/)(README|index)$'))
SELECT raw_id, CAST(n AS INT) AS line, target FROM walk w WHERE NOT regexp_matches(path, '(^|/)[^./][^/]*/\.\./') AND NOT EXISTS (SELECT 1 FROM have h WHERE h.source = w.source AND h.path = regexp_replace(w.path, '\.md$', ''))"""
