"""Per-document text statistics and outlier scores.

Each statistic's values are ranked exactly within a language: distinct values with their counts are sorted by range
partitions, partition offsets turn local into global ranks, and ranks give empirical tail probabilities. Their logarithms
are summed over the statistics for the low tail, the high tail and the tail each statistic's skew points to; the largest
sum is the outlier score.

A document is no running prose when less than half of its words stand in full sentences. The candidates for that come from
the score, by a bound that loses none at any frequency of junk: the low-tail sum is at least the logarithm that
sentence_share alone gives, and for a document below one half that tail holds at most the language's rows below one half.
So every such document scores at least -log(share of its language's rows below one half), whatever the language's size.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from docstrata.llm.code_spans import cut, fence_spans
from docstrata.runtime import heavy_join, small, staged

STATISTICS = ("words", "mean_word_length", "symbol_ratio", "line_punctuation", "common_share", "sentence_share")
#: A sentence has so many words, of which at least this share are common words of any listed language.
SENTENCE_WORDS, SENTENCE_COMMON = 4, 0.12
#: The largest share that is less than a half; rounding does not lift a share to a half.
BELOW_HALF = 0.4999

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+(?:[.,:]\d+)*")
_BREAK = re.compile(r"\n[ \t]*\n")
_STOP = re.compile(r"[.!?…](?=[\"'”’»)\]*_]*(?:\s|\Z))|[。！？]")
# scripts that put no blanks between words: each sign is a word
_DENSE = re.compile("[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff]")
_DENSE_WORD = re.compile(_DENSE.pattern + "|" + _WORD.pattern.replace(r"[^\W\d_]", r"[^\W\d_" + _DENSE.pattern[1:]))
_LETTER = re.compile(r"[^\W\d_]")
_FOREIGN = re.compile("[\u0370-\U0003ffff]")
_CODE = re.compile(r"=>|\(\)|\);|[{};]\s*\Z|\t|\|.*\||^\s*(?:def|export|const)\b|\w+\.\w+\(", re.M)
_END = re.compile(r"[.!?…。！？:;][\"'”’»)\]*_]*\s*\Z")


def _sentence_words(block: str, common: frozenset[str], word: re.Pattern[str] = _WORD, share: float = SENTENCE_COMMON) -> int:
    """Words of a lower-case block's full sentences. A block is lines without blank lines; its last words need an end sign too."""
    count = at = 0
    for m in _STOP.finditer(block):
        sentence = block[at : m.start()]
        at = m.end()
        words = word.findall(sentence)
        n = len(words)
        if n >= SENTENCE_WORDS and sum(map(common.__contains__, words)) >= share * n and not _CODE.search(sentence):
            count += n
    return count


def statistics(text: str | None, common: frozenset[str]) -> tuple | None:
    """(words, mean_word_length, symbol_ratio, line_punctuation, common_share, sentence_share); None for null.

    Shares of a text without words or lines are 0. Sentences may span lines, be list items or be quoted; headings,
    fenced code, table rows and lines with signs of code are none. Texts in other than Latin letters, of which no common
    words are listed, need none in a sentence; scripts without blanks have a word a sign.
    """
    if text is None:
        return None
    body = text.lower().replace("\r\n", "\n")
    word, need = _WORD, SENTENCE_COMMON
    if not body.isascii() and 2 * len(_FOREIGN.findall(body)) > len(_LETTER.findall(body)):
        word, need = _DENSE_WORD if _DENSE.search(body) else _WORD, 0.0
    words = word.findall(body)
    n = len(words)
    dense = len("".join(body.split()))
    letters = sum(map(len, words))
    lines = [x for x in body.split("\n") if x and not x.isspace()]
    ended = sum(_END.search(x[-8:]) is not None for x in lines)
    hits = sum(map(common.__contains__, words))
    spans = fence_spans(body)
    if spans:
        body = cut(body, spans, "\n\n")
    if "#" in body or "|" in body:
        body = "\n".join("" if x[:1] in ("#", "|") else x for x in body.split("\n"))
    sentences = sum(_sentence_words(b, common, word, need) for b in _BREAK.split(body) if b)
    share = lambda a, b: round(a / b, 4) if b else 0.0
    return n, share(letters, n), share(dense - letters, dense), share(ended, len(lines)), share(hits, n), min(share(sentences, n), BELOW_HALF) if 2 * sentences < n else share(sentences, n)


def language(c: Column) -> Column:
    """Two or three small letters of a language tag; 'und' where there are none."""
    base = F.lower(F.regexp_extract(F.trim(c), r"^([A-Za-z]{2,3})(?:[-_].*)?\z", 1))
    return F.when(base.isNull() | (base == ""), "und").otherwise(base)


def with_statistics(docs: DataFrame, text: str, common_words: DataFrame) -> DataFrame:
    """Adds the statistics. common_words (word) must be a word list, at most 100,000 rows."""
    listed = [r[0].lower() for r in common_words.select("word").where("word is not null").distinct().limit(100_001).collect()]
    if len(listed) > 100_000:
        raise ValueError("common_words is no word list")
    common = docs.sparkSession.sparkContext.broadcast(frozenset(listed))
    kind = StructType([StructField(s, LongType() if s == "words" else DoubleType()) for s in STATISTICS])

    @F.pandas_udf(kind)
    def measure(texts: pd.Series) -> pd.DataFrame:
        known = common.value
        return pd.DataFrame([statistics(t, known) or (None,) * len(STATISTICS) for t in texts], columns=list(STATISTICS))

    kept = [c for c in docs.columns if c not in STATISTICS]
    done = docs.select(*kept, measure.asNondeterministic()(F.col(text)).alias("__s"))  # so that no filter on its result runs it again
    return done.select(*kept, *(F.col(f"__s.{s}").alias(s) for s in STATISTICS))


def tail_probabilities(values: DataFrame) -> DataFrame:
    """(lang, stat, value, n, low, high, total): the shares of a group's rows at or below, at or above each value.

    values has (lang, stat, value). Groups are counted before they are sorted, so a value that a third of the rows have
    is one row; the sort is by ranges of (lang, stat, value), and no group is ever in one task.
    """
    counted = values.groupBy("lang", "stat", "value").agg(F.count("*").alias("n"))
    ranged = staged(counted.repartitionByRange("lang", "stat", "value").withColumn("part", F.spark_partition_id()), "ranks")
    sums = ranged.groupBy("lang", "stat", "part").agg(F.sum("n").alias("part_n"))
    group = Window.partitionBy("lang", "stat")
    offsets = sums.select("lang", "stat", "part", (F.sum("part_n").over(group.orderBy("part")) - F.col("part_n")).alias("offset"), F.sum("part_n").over(group).alias("total"))
    within = Window.partitionBy("lang", "stat", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranged.join(small(offsets), ["lang", "stat", "part"]).withColumn("upto", F.col("offset") + F.sum("n").over(within))
    return ranked.select("lang", "stat", "value", "n", (F.col("upto") / F.col("total")).alias("low"), ((F.col("total") - F.col("upto") + F.col("n")) / F.col("total")).alias("high"), "total")


def outlier_scores(measured: DataFrame, rows: str) -> DataFrame:
    """(rows, score, ranked_of) from (rows, lang, statistics), where rows numbers the distinct statistics of a key."""
    pairs = F.array(*(F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("value")) for s in STATISTICS))
    long = measured.select(rows, "lang", F.inline(pairs))
    skews = small(long.groupBy("lang", "stat").agg(F.skewness("value").alias("skew")))
    tails = staged(tail_probabilities(long).join(skews, ["lang", "stat"], "left"), "tails")
    low, high = -F.log("low"), -F.log("high")
    side = F.when(F.col("skew") < 0, low).otherwise(high)
    joined = heavy_join(long, tails, ["lang", "stat", "value"], "n")
    of = lambda c, s: F.max(F.when(F.col("stat") == s, c))  # noqa: E731  (repeated rows have equal values)
    total = lambda c: sum((of(c, s) for s in STATISTICS[1:]), of(c, STATISTICS[0]))
    summed = joined.groupBy(rows).agg(total(low).alias("l"), total(high).alias("h"), total(side).alias("s"), F.max("total").alias("ranked_of"))
    return summed.select(rows, F.greatest("l", "h", "s").alias("score"), "ranked_of")


def scored_documents(docs: DataFrame, key: str, text: str, lang: str, common_words: DataFrame) -> DataFrame:
    """(key, lang, statistics, score, ranked_of, least_score). lang is reduced to its language; null texts have no row.

    least_score is what every document of the language with less than half of its words in sentences scores at least,
    null where there is none. Repeated rows repeat, and each counts in the ranks; a key with several texts has a score for each.
    """
    rows = docs.where(F.col(text).isNotNull()).select(key, language(F.col(lang)).alias("lang"), text)
    measured = with_statistics(rows, text, common_words)
    measured = staged(measured.withColumn("__row", F.xxhash64(key, "lang", *STATISTICS)).drop(text), "statistics")
    below = measured.groupBy("lang").agg((F.count_if(F.col("sentence_share") <= BELOW_HALF) / F.count("*")).alias("below"))
    bounds = small(below.select("lang", F.when(F.col("below") > 0, -F.log("below")).alias("least_score")))  # at most one row a language
    return measured.join(outlier_scores(measured, "__row"), "__row").drop("__row").join(bounds, "lang", "left").select(key, "lang", *STATISTICS, "score", "ranked_of", "least_score")


def not_prose(scored: DataFrame) -> DataFrame:
    """Documents of which less than half of the words stand in full sentences: of those with the score for it, the ones that are checked to. Texts without a sign are none."""
    candidates = scored.where(F.col("score") >= F.col("least_score") - 1e-9)
    return candidates.where((F.col("sentence_share") <= BELOW_HALF) & ((F.col("words") > 0) | (F.col("symbol_ratio") > 0)))
