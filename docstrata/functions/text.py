"""Hashes, times, escapes and small text functions."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from docstrata.functions.canonical import stripped

# Escapes of titles in index tables, in the order they are applied.
TITLE_ESCAPES = (("\\", "\\\\"), ("&", "&amp;"), ("|", "\\|"), ("[", "\\["), ("]", "\\]"), ("*", "\\*"), ("_", "\\_"), ("`", "\\`"), ("<", "&lt;"), (">", "&gt;"), ("\n", " "), ("\r", " "))
LOG_ESCAPES = (("\\", "\\\\"), ("&", "&amp;"), ("*", "\\*"), ("_", "\\_"), ("[", "\\["), ("]", "\\]"), ("<", "&lt;"), (">", "&gt;"), ("\r\n", " "), ("\n", " "), ("\r", " "))
AVAILABILITY = {"true": "Supported", "false": "Not supported"}


def _replaced(c: Column, pairs) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def content_hash(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def iso_stamp(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def log_stamp(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm 'UTC'")


def day_key(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd")


def title_escaped(title: Column) -> Column:
    return _replaced(title, TITLE_ESCAPES)


@F.pandas_udf(StringType())
def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else html.unescape(t))


def log_escaped(text: Column) -> Column:
    """Entities are read first, then Markdown signs are escaped; only texts with '&' leave the JVM."""
    return _replaced(F.when(F.contains(text, F.lit("&")), _unescaped(text)).otherwise(text), LOG_ESCAPES)


def code_safe(text: Column) -> Column:
    return F.replace(text, F.lit("`"), F.lit("'"))


def table_cell(text: Column) -> Column:
    return F.replace(F.regexp_replace(stripped(text), r"(?U)\s+", " "), F.lit("|"), F.lit("\\|"))


def width_of(text: str) -> int:
    """Columns a text takes on a terminal: wide and full-width characters take two, combining ones none."""
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


@F.pandas_udf(IntegerType())
def _width(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else width_of(t)).astype("Int32")


def display_width(text: Column) -> Column:
    return F.when(text.rlike(r"^\p{ASCII}*\z"), F.length(text)).otherwise(_width(text))


def heading_anchor(heading: Column) -> Column:
    """The anchor a heading gets on common code hosts."""
    kept = F.regexp_replace(F.lower(stripped(heading)), r"(?U)[^\w\s-]", "")
    return F.regexp_replace(kept, r"(?U)\s", "-")


@F.pandas_udf(StringType())
def _title_case(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else t.title())


def section_title(url: Column) -> Column:
    """A title from the last path segment: 'config-x' is 'X Configuration', other dashes are blanks, each word capital."""
    last = F.element_at(F.split(F.rtrim(F.regexp_replace(url, r"(?s)[?#].*\z", ""), F.lit("/")), "/"), -1)
    words = F.regexp_replace(F.regexp_replace(last, r"\.mdx?\z", ""), "[-_]+", " ")
    return F.when(words.rlike("^config "), F.concat(_title_case(F.substr(words, F.lit(8))), F.lit(" Configuration"))).otherwise(_title_case(words))


def availability(value: Column) -> Column:
    shown = F.when(F.lower(value) == "true", AVAILABILITY["true"]).when(F.lower(value) == "false", AVAILABILITY["false"])
    return F.coalesce(shown, value)


def yaml_unquoted(value: Column) -> Column:
    return F.regexp_replace(stripped(value), r"^[\"']+|[\"']+\z", "")


def positive_int(value: Column) -> Column:
    number = stripped(value).try_cast("int")
    return F.when(number > 0, number)


def list_selection(wanted: Column, known: list[str]) -> Column:
    """struct(selected, unknown) of a comma-separated list: distinct and sorted; 'all' stands for every known name."""
    names = F.array_distinct(F.filter(F.transform(F.split(wanted, ","), lambda x: F.lower(stripped(x))), lambda x: x != ""))
    every = F.array(*(F.lit(k) for k in sorted(known)))
    return F.struct(F.when(F.array_contains(names, "all"), every).otherwise(F.array_sort(F.array_intersect(names, every))).alias("selected"), F.array_sort(F.array_except(names, F.array_union(every, F.array(F.lit("all"))))).alias("unknown"))


def backoff_seconds(attempt: Column, base: float = 2.0, cap: float = 30.0) -> Column:
    """The longest wait before a retry, attempts counted from 1; the jitter factor of 0.5 to 1.5 is the caller's."""
    return F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(2.0), attempt - 1))


def retry_after(header: Column, cap: float = 30.0) -> Column:
    """A numeric Retry-After within 0 and the cap, null for others."""
    seconds = stripped(header).try_cast("double")
    return F.when(seconds.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(cap), seconds)))
