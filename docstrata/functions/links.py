"""Links of Markdown texts: extraction, destination kinds, resolution and rewriting."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Callable
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from docstrata.functions import fences
from docstrata.functions.canonical import stripped

# Schemes that lead out of the mirror.
EXTERNAL_SCHEMES = ("http", "https", "mailto", "ftp", "data", "javascript", "tel", "sms", "irc", "git", "ssh", "vscode", "cursor", "vscodium", "windsurf", "zed", "codex")

_TITLE = r"(?:\s+(?:\"[^\"]*\"|'[^']*'|\([^()]*\)))?"
_INLINE = re.compile(r"\]\(\s*(<[^<>\n]+>|[^\s()]+(?:\([^\s()]*\)[^\s()]*)*)" + _TITLE + r"\s*\)")
_REFERENCE = re.compile(r"^ {0,3}\[[^\]\n]+\]:\s*(<[^<>\n]+>|\S+)" + _TITLE + r"\s*$")
_ATTRIBUTE = re.compile(r"\b(?:href|src)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", re.I)
_TICKS = re.compile(r"`+")


def masked(line: str) -> str:
    """Inline code blanked out, at the same length: a run of backticks pairs with the next run as long."""
    ticks = [m.span() for m in _TICKS.finditer(line)]
    partner, nearest = [], {}  # seen from the end of the line
    for a, b in reversed(ticks):
        partner.append(nearest.get(b - a))
        nearest[b - a] = b
    seen, done = [], 0
    for (a, _), end in zip(ticks, reversed(partner), strict=True):
        if end is not None and a >= done:
            seen += (line[done:a], " " * (end - a))
            done = end
    return "".join(seen) + line[done:]


def links_of(text: str) -> list[tuple[int, str]]:
    """(line, destination) of inline, reference and attribute links outside code, in order; lines count from 1."""
    covered: set[int] = set()
    for a, b in fences.link_spans(text) if "```" in text or "~~~" in text else []:
        first = text.count("\n", 0, a)
        covered.update(range(first, first + text.count("\n", a, b) + 1))
    found = []
    for n, line in enumerate(text.replace("\r\n", "\n").split("\n")):
        if n in covered or not ("](" in line or "]:" in line or "=" in line):
            continue
        seen = masked(line)
        found += [(n + 1, m[1]) for m in _INLINE.finditer(seen)]
        if r := _REFERENCE.match(seen):
            found.append((n + 1, r[1]))
        found += [(n + 1, m[1] if m[1] is not None else m[2]) for m in _ATTRIBUTE.finditer(seen)]
    return found


_ROWS = ArrayType(StructType([StructField("line", IntegerType()), StructField("target", StringType())]))


@F.pandas_udf(_ROWS)
def _links(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else links_of(t))


def links(text: Column) -> Column:
    """array<struct(line, target)>; use inline() for rows."""
    return _links.asNondeterministic()(text)  # else the filter that inline() implies runs it again


def bare_destination(destination: Column) -> Column:
    return stripped(F.regexp_replace(stripped(destination), r"(?s)^<(.*)>\z", "$1"))


def destination_kind(destination: Column) -> Column:
    """null for none of the mirror's (blank, anchor, query, protocol-relative, external), else site-absolute, malformed, relative."""
    bare = bare_destination(destination)
    external = r"(?i)^(?:" + "|".join(EXTERNAL_SCHEMES) + "):"
    malformed = bare.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*(?:\[[^\]/?#]*(?:[/?#]|\z)|^[^\[]*\])")
    return F.when(bare.isNull() | (bare == "") | bare.rlike(r"^[#?]") | F.startswith(bare, F.lit("//")) | bare.rlike(external), None).when(F.startswith(bare, F.lit("/")), "site-absolute").when(malformed, "malformed").otherwise("relative")


def resolved(page: Column, path: Column) -> Column:
    """The path a relative link names, from the root of the mirror; null where it leads above it. A final '/' stays."""
    whole = F.concat(F.regexp_replace(page, r"[^/]*\z", ""), path)
    steps = F.aggregate(
        F.split(whole, "/"), F.array().cast("array<string>"),
        lambda acc, s: F.when(acc.isNull() | s.isin("", "."), acc).when(s != "..", F.concat(acc, F.array(s))).when(F.size(acc) == 0, F.lit(None)).otherwise(F.slice(acc, 1, F.size(acc) - 1)),
    )
    directory = F.when(whole.rlike(r"(?:^|/)\.{0,2}\z"), "/").otherwise("")
    return F.concat(F.array_join(steps, "/"), directory)


def rewritten(text: str, page: str, known: Callable[[str], bool], site: str) -> str:
    """Links to the site outside code become relative where the page is known, else upstream addresses; idempotent.

    A query or anchor stays. Candidates are found by their first sign and read once, so malformed ones cost no more.
    """
    base = posixpath.dirname(page)

    def change(m: re.Match[str]) -> str:
        raw = m[1]
        bare = raw[1:-1].strip() if raw.startswith("<") else raw
        path = bare.removeprefix(site.rstrip("/")) if bare.startswith(site.rstrip("/") + "/") else bare
        if not path.startswith("/") or path.startswith("//"):
            return m[0]
        try:
            parts = urlsplit(path)
        except ValueError:
            return m[0]
        slug = parts.path.strip("/").removesuffix(".md") or "index"
        tail = (f"?{parts.query}" if parts.query else "") + (f"#{parts.fragment}" if parts.fragment else "")
        if known(slug):
            link = posixpath.relpath(slug, base or ".") + ".md" + tail
            link = link if link.startswith(".") else "./" + link
        else:
            link = site.rstrip("/") + parts.path + tail
        return m[0].replace(raw, link, 1)

    return fences.outside(text, fences.component_spans(text), lambda t: _INLINE.sub(change, t) if "](" in t else t)
