"""Template residue and error-page text.

Lines are normalised and counted by host over its different bodies; the ones that recur through them are boilerplate and
are subtracted, unless they are evidence themselves. A record is excluded when it has an unfilled slot outside code, or
when all its residual says (headings and tags aside) is an error or refusal message, filler, or a notice that scripts are
needed: at least one sentence is evidence and none is content (llm/evidence.py).
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType

from docstrata.functions.scan import between, elements
from docstrata.llm.code_spans import without_code
from docstrata.llm.evidence import CONTENT, EVIDENCE, FUNCTION, MOCK_MARKS, judged, monotone, words_of
from docstrata.llm.markup import FRONT, plain_lines
from docstrata.llm.slots import HINT, has_slot
from docstrata.runtime import heavy_join, small, staged

_ASIDE = r"title|h[1-6]|head|style|script"
_TAG = re.compile(r"<[/!]?[A-Za-z][^<>]*>")
_INLINE = re.compile(r"</?(?:a|abbr|b|big|em|font|i|mark|s|small|span|strong|sub|sup|u)(?=[\s>/])[^<>]*>", re.I)
_CODE = re.compile(r"</?(?:code|kbd|samp|tt)(?=[\s>/])[^<>]*>", re.I)
_HEADING = re.compile(r" {0,3}#{1,6}[ \t]|\\(?:sub)*section\*?\{[^{}]*\}[ \t]*\Z")
_UNDERLINE = re.compile(r" {0,3}(?:={3,}|-{3,})[ \t]*\Z")
_FENCE = re.compile(r"[ \t>]*(?:```|~~~)")
_BREAK = re.compile(r"(?<=[.!?])[\"')\]]*\s+|(?<=\w)\s-\s")
#: What shows code; it is content.
SHOWN = "```"
#: A run of words without an end is judged in parts of so many.
PART = 40


def _is_heading(line: str) -> bool:
    if _HEADING.match(line):
        return True
    wiki = line.strip()
    return wiki[:1] == "=" == wiki[-1:] and bool(wiki.strip("= \t"))


def _parts(line: str) -> Iterator[str]:
    for sentence in _BREAK.split(line):
        if len(sentence) < 5 * PART:
            yield sentence
        else:
            words = sentence.split()
            yield from (" ".join(words[a : a + PART]) for a in range(0, len(words), PART))


def sentences(text: str) -> Iterator[str]:
    """The sentences of a text outside front matter, comments, titles, headings, styles and scripts; block tags end sentences."""
    text = plain_lines(text)
    if text.startswith("---"):
        text = FRONT.sub("", text, count=1)
    if "<" in text:
        text = elements(between(text, "<!--", "-->", lambda _: "\n"), _ASIDE, "\n")
        text = _TAG.sub("\n", _CODE.sub("`", _INLINE.sub("", text)))
    above = ""
    for line in text.split("\n"):
        if above and not _UNDERLINE.match(line):
            yield from _parts(above)
        above = ""
        if _FENCE.match(line):
            yield SHOWN
        elif not _is_heading(line) and not _UNDERLINE.match(line):
            above = html.unescape(line).strip() if "&" in line else line.strip()
    if above:
        yield from _parts(above)


def says_nothing(text: str) -> bool:
    """At least one sentence is evidence and none is content. A text of headings only says nothing of either kind: it is no residue."""
    low = text.lower()
    marked = any(m in low for m in MOCK_MARKS)
    any_evidence = False
    for sentence in sentences(text):
        kind = CONTENT if sentence == SHOWN else judged(sentence, marked)
        if kind == CONTENT:
            if marked or sentence == SHOWN or not FUNCTION.isdisjoint(words_of(sentence)) or not monotone([w for x in sentences(text) for w in words_of(x)]):
                return False
            marked, kind = True, judged(sentence, True)
            if kind == CONTENT:
                return False
        any_evidence |= kind == EVIDENCE
    return any_evidence


@functools.lru_cache(100_000)
def _line_says_nothing(line: str) -> bool:
    return says_nothing(line)


def residual(body: str, recurrent: list[int]) -> str:
    """The body without its recurrent lines (numbers of lines, from 0), save those that are evidence themselves."""
    drop = frozenset(recurrent)
    return "\n".join(x for n, x in enumerate(body.split("\n")) if n not in drop or _line_says_nothing(x))


def is_residue(body: str | None, slotted: bool = True, recurrent: list[int] | None = None) -> bool:
    """The verdict on a record. slotted: the body may have a slot; recurrent: numbers of its boilerplate lines."""
    if body is None:
        return False
    if slotted and has_slot(without_code(plain_lines(body))[0]):
        return True
    return says_nothing(body if recurrent is None or not len(recurrent) else residual(body, recurrent))


#: A slug in any spelling: path segments of letters, digits and simple signs.
_SLUG = re.compile(r"\s*(?:\./|/)*[\w.~%+-]+(?:/+[\w.~%+-]+)*/*\s*\Z")
_NO_SLUG = re.compile(r"(?i)\s*(?:undefined|null|nan|none|tbd|todo|your-[a-z-]*-?here)\s*\Z")


def is_bad_element(element: str | None) -> bool:
    """An element of a list of slugs is an unfilled slot, an empty value or a text of evidence. Blank ones are neither."""
    if element is None or not element.strip():
        return False
    if _NO_SLUG.match(element) or has_slot(element):
        return True
    if _SLUG.match(element):
        return False
    return says_nothing(element)


@F.pandas_udf(BooleanType())
def _residue_udf(body: pd.Series, slotted: pd.Series, recurrent: pd.Series) -> pd.Series:
    return pd.Series([is_residue(b, s, r) for b, s, r in zip(body, slotted, recurrent, strict=True)], dtype="boolean")


@F.pandas_udf(ArrayType(BooleanType()))
def _elements_udf(elements: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else [is_bad_element(e) for e in x] for x in elements])


#: A line recurs when it is in at least RECURS_IN different bodies, and the lower bound (at CONFIDENCE standard errors) of its share of them is at least the asked one.
RECURS_IN, CONFIDENCE = 3, 1.96


def line_hashes(body: Column) -> Column:
    """array of the hashes of the normalised lines: lower case, runs of digits as 0, of blanks as one blank. Blank lines are 0."""
    normal = F.regexp_replace(F.regexp_replace(F.lower(body), r"\d+", "0"), r" [ \t\r\f]+|[\t\r\f]+ *", " ")
    return F.transform(F.split(normal, "\n"), lambda x: F.when(F.trim(x) == "", F.lit(0).cast("long")).otherwise(F.xxhash64(F.trim(x))))


def boilerplate(docs: DataFrame, host: str, body: str, share: float = 0.02) -> DataFrame:
    """(host, records, recurrent): of each host the number of its records and the sorted hashes of its recurrent lines.

    Copies of a body count once. A host has at most (mean lines of a body) / share recurrent lines; one with fewer than
    three different bodies has none, as nothing recurs in them. Null hosts and bodies have no row.
    """
    known = docs.where(F.col(body).isNotNull() & F.col(host).isNotNull())
    marked = known.select(host, F.xxhash64(body).alias("__b"), F.array_distinct(line_hashes(F.col(body))).alias("__lines"))
    totals = staged(known.groupBy(host).agg(F.count_distinct(F.xxhash64(body)).alias("__of"), F.count("*").alias("records")), "hosts")
    counted = marked.select(host, "__b", F.explode("__lines").alias("h")).where("h <> 0").groupBy(host, "h").agg(F.count_distinct("__b").alias("n")).where(F.col("n") >= RECURS_IN)
    counted = staged(counted, "recurrent-lines")
    of, z = F.col("__of"), CONFIDENCE
    p = F.col("n") / of
    least = (p + z * z / (2 * of) - z * F.sqrt(p * (1 - p) / of + z * z / (4 * of * of))) / (1 + z * z / of)
    often = counted.join(small(totals), host).where(least >= share)
    return totals.select(host, "records").join(small(often.groupBy(host).agg(F.sort_array(F.collect_list("h")).alias("recurrent"))), host, "left")


def residue_records(docs: DataFrame, key: str, host: str, body: str) -> DataFrame:
    """Adds is_residue to the records (false where the body is null), in place of a column of that name.

    Records without a host have no boilerplate; repeated records are judged alike; an empty body says nothing and is none.
    """
    docs = docs.drop("is_residue")
    found = staged(boilerplate(docs.select(host, body), host, body), "boilerplate").withColumnsRenamed({host: "__host", "recurrent": "__recurrent", "records": "__n"})
    judge = _residue_udf.asNondeterministic()  # else a filter on the verdict runs it again
    lines = line_hashes(F.col(body))
    places = F.when(F.col("__recurrent").isNotNull(), F.filter(F.transform(lines, lambda x, n: F.when(F.array_contains("__recurrent", x), n)), lambda n: n.isNotNull()))
    verdict = lambda rows: rows.withColumn("is_residue", judge(F.col(body), F.coalesce(F.col(body).rlike(HINT), F.lit(False)), places)).drop("__host", "__recurrent", "__n")
    known = small(found)
    if known is not found:
        return verdict(docs.join(known, F.col(host) == F.col("__host"), "left"))
    alone = docs.where(F.col(host).isNull() | F.col(body).isNull()).withColumn("__recurrent", F.lit(None).cast("array<bigint>"))
    shared = heavy_join(docs.where(F.col(body).isNotNull()).withColumn("__host", F.col(host)), found, ["__host"], "__n")
    return verdict(alone).unionByName(verdict(shared))


def bad_elements(records: DataFrame, key: str, elements: str) -> DataFrame:
    """(key, elem_pos) of the elements that are no slugs, positions counted from 0. Null and empty lists have none."""
    some = records.where(F.size(elements) > 0).select(key, _elements_udf.asNondeterministic()(elements).alias("bad"))
    return some.select(key, F.posexplode("bad").alias("elem_pos", "is_bad")).where("is_bad").select(key, "elem_pos")


def without_residue(docs: DataFrame, key: str, host: str, body: str) -> DataFrame:
    """The records that are content; those with a null body are not."""
    return residue_records(docs, key, host, body).where(~F.col("is_residue") & F.col(body).isNotNull()).drop("is_residue")


def without_bad_elements(records: DataFrame, elements: str) -> DataFrame:
    """The records with the elements that are no slugs taken out of the list; the others keep their order."""
    bad = F.when(F.size(elements) > 0, _elements_udf(elements))
    kept = F.filter(F.arrays_zip(F.col(elements).alias("e"), F.col("_bad").alias("b")), lambda x: ~x["b"])
    return records.withColumn("_bad", bad).withColumn(elements, F.when(F.col("_bad").isNull(), F.col(elements)).otherwise(F.transform(kept, lambda x: x["e"]))).drop("_bad")
