"""Markdown semantics: validity, titles, blank runs, invisible characters, front matter, headings, stubs."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, MapType, StringType, StructField, StructType

from docstrata.functions import fences
from docstrata.functions.canonical import stripped

FRONT = re.compile(r"\A\s*---[ \t]*\r?\n(?P<fields>(?:[^\n]*\n)*?)---[ \t]*(?:\r?\n|\Z)")
FIELD = re.compile(r"^(?P<key>[A-Za-z_][\w.-]*)[ \t]*:[ \t]*(?P<value>[^\n]*?)[ \t\r]*$")
NESTED = re.compile(r"^[ \t]+(?P<key>[A-Za-z_][\w.-]*)[ \t]*:[ \t]+(?P<value>[^\n]*?)[ \t\r]*$")
ATX = re.compile(r"^ {0,3}(?P<marks>#{1,6})[ \t]+(?P<title>\S[^\n]*)$", re.M)
STUB_PROSE = 300
FILE_EXTENSIONS = (".md", ".markdown")


def is_markdown(text: Column) -> Column:
    """Has front matter at the start or a heading anywhere, and no HTML marker in the first 512 characters."""
    bare = F.regexp_replace(text, "^﻿+", "")
    front = bare.rlike(r"(?s)\A\s*---[ \t]*\r?\n(?:[^\n]*\n)*?---[ \t]*(?:\r?\n|\z)")
    heading = bare.rlike(r"(?md)(?U)^\s*#{1,6}\s+\S") | bare.rlike(r"(?md)^[-=\s&&[^\n]]*+[^-=\s][^\n]*+\n[-=]{2,}[ \t\r]*$")
    marked = F.lower(F.substring(bare, 1, 512)).rlike(r"<!doctype|<html")
    return (front | heading) & ~marked


def split_front(text: str) -> tuple[dict[str, str], str]:
    """({field: value, with one nested level as 'outer.inner'}, the text below). A rule at the top is no front matter."""
    text = text.lstrip("\ufeff")
    m = FRONT.match(text)
    if not m:
        return {}, text
    fields, outer = {}, ""
    for line in m["fields"].split("\n"):
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if (f := FIELD.match(line)) :
            outer = f["key"]
            if f["value"]:
                fields[outer] = f["value"].strip("\"'")
        elif (n := NESTED.match(line)) and outer:
            fields[f"{outer}.{n['key']}"] = n["value"].strip("\"'")
        elif not line[:1].isspace() and not line.startswith("-"):
            return {}, text
    return (fields, text[m.end() :]) if fields or not m["fields"].strip() else ({}, text)


def title_of(text: str, fallback: str = "Untitled") -> str:
    """Front matter's title, else the first ATX heading outside fences, else the first underlined one, else the fallback."""
    text = text.lstrip("﻿")
    m = FRONT.match(text)
    if m:
        for line in m["fields"].split("\n"):
            f = FIELD.match(line)
            if f and f["key"].lower() == "title" and (t := f["value"].strip().strip("\"'")):
                return t
        text = text[m.end() :]
    body = fences.without(text, fences.title_spans(text))
    if h := ATX.search(body):
        return re.sub(r"\s#+$", "", h["title"].strip()).strip()
    above = ""
    for line in body.split("\n"):
        if above.strip(" \t\r-=") and re.fullmatch(r"[-=]{2,}[ \t\r]*", line):
            return above.strip()
        above = line
    return fallback


def blank_runs_collapsed(text: str) -> str:
    return fences.outside(text, fences.block_spans(text), lambda t: re.sub(r"\n{3,}", "\n\n", t)) if "\n\n\n" in text else text


def visible(text: Column) -> Column:
    """Without control and format characters other than tab and line ends."""
    return F.regexp_replace(text, r"[\p{Cf}\p{Cc}&&[^\t\n\r]]", "")


def has_h1(text: str) -> bool:
    body = fences.without(text, fences.component_spans(text))
    return any(m["marks"] == "#" for m in ATX.finditer(body))


def with_heading(fields: dict[str, str], body: str) -> str:
    """The body below a heading made of the title fields where it has none of its own."""
    title = fields.get("title") or fields.get("hero.name") or fields.get("hero.title")
    return body if not title or has_h1(body) else f"# {title}\n\n{body.lstrip()}"


def demoted(text: str, by: int) -> str:
    """Headings outside fences go down by so many levels, to six at most."""
    down = lambda m: "#" * min(6, len(m["marks"]) + by) + m[0].lstrip()[len(m["marks"]) :]
    return fences.outside(text, fences.component_spans(text), lambda t: ATX.sub(down, t))


_PAGE_LINK = re.compile(r"\[[^\[\]]*\]\(([^()\s]+\.md(?:#[^()\s]*)?)\)")


def stub_parts(text: str) -> tuple[list[str], int, int]:
    """(destinations of links to Markdown pages, headings, characters of prose beside links and headings)."""
    _, body = split_front(text)
    prose = re.sub(r"\[([^\[\]]*)\]\([^()]*\)|^ {0,3}#{1,6}[^\n]*$", r"\1", body, flags=re.M)
    return _PAGE_LINK.findall(body), len(ATX.findall(body)), len(prose.strip())


def is_stub(text: str) -> bool:
    """One link to a Markdown page, at most one heading and little prose: it may stand for the page it links to (operators/stubs.py asks whether that is known)."""
    links, headings, prose = stub_parts(text)
    return len(links) == 1 and headings <= 1 and prose < STUB_PROSE


def _udf(kind, function):
    def mapped(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else function(t))

    return F.pandas_udf(mapped, kind)


_title = _udf(StringType(), lambda t: title_of(t, ""))
_collapsed = _udf(StringType(), blank_runs_collapsed)
_demoted = {n: _udf(StringType(), lambda t, n=n: demoted(t, n)) for n in range(1, 6)}
_stub = _udf(BooleanType(), is_stub)
_h1 = _udf(BooleanType(), has_h1)


def _front_rows(texts: pd.Series) -> pd.DataFrame:
    pairs = [({}, None) if t is None else split_front(t) for t in texts]
    return pd.DataFrame({"fields": [f for f, _ in pairs], "body": [b for _, b in pairs]})


_front = F.pandas_udf(_front_rows, StructType([StructField("fields", MapType(StringType(), StringType())), StructField("body", StringType())]))
_SPANS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
_spans = {g: _udf(_SPANS, lambda t, s=s: s(t)) for g, s in fences.GRAMMARS.items()}
_stripped = {g: _udf(StringType(), lambda t, s=s: fences.without(t, s(t))) for g, s in fences.GRAMMARS.items()}


def title(text: Column, fallback: Column) -> Column:
    return F.coalesce(F.nullif(_title(text), F.lit("")), fallback)


def collapsed(text: Column) -> Column:
    """Runs of blank lines outside fences become one blank line; texts without such runs stay in the JVM."""
    return F.when(F.contains(text, F.lit("\n\n\n")), _collapsed(text)).otherwise(text)


def front_matter(text: Column) -> Column:
    """struct(fields, body)."""
    return _front.asNondeterministic()(text)


def demoted_headings(text: Column, by: int) -> Column:
    return _demoted[by](text)


@F.pandas_udf(StructType([StructField("links", ArrayType(StringType())), StructField("headings", IntegerType()), StructField("prose", IntegerType())]))
def _stub_parts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(None, None, None) if t is None else stub_parts(t) for t in texts], columns=["links", "headings", "prose"])


def stub_measures(text: Column) -> Column:
    """struct(links, headings, prose)."""
    return _stub_parts.asNondeterministic()(text)


def stub(text: Column) -> Column:
    return _stub(text)


def h1(text: Column) -> Column:
    return _h1(text)


def code_spans(text: Column, grammar: str) -> Column:
    """array<struct(start, end)> of the fenced blocks; explode it for rows."""
    return _spans[grammar].asNondeterministic()(text)


@F.pandas_udf(ArrayType(StructType([StructField("grammar", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])))
def _all_spans(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else [(g, a, b) for g, spans in fences.GRAMMARS.items() for a, b in spans(t)])


def all_code_spans(text: Column) -> Column:
    """array<struct(grammar, start, end)> of the fenced blocks by every grammar, in one pass over the texts."""
    return _all_spans.asNondeterministic()(text)


def without_code(text: Column, grammar: str) -> Column:
    return _stripped[grammar](text)


def is_page_file(path: Column) -> Column:
    return F.lower(path).rlike(r"\.(?:md|markdown)\z")


def is_blank(c: Column) -> Column:
    return c.isNull() | (stripped(c) == "")
