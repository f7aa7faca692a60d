"""Evaluation texts leaking into training text.

A prefix-filtered set join of five-word shingles. Every passage that counts contains a window of 15 words with at most one
edit or of 20 with at most two (an item of fewer words: itself, with one edit from ten words on). An edit destroys at most
five shingles, so of the shingles of a window, ordered by how many documents have them, the rarest five per edit and one
more must hold one that stands in the document: these are the prefix, and only they are joined. A hit brings the words
around it along, and the window is verified exactly, from the shared shingle to both sides.

Items and documents are tables throughout. The documents are scanned once for the counts and once for the join, whatever
the number of items; they never shuffle, only hits do. Before anything leaves a scan it must pass a bitmap of the wanted
shingles, whose size is bounded (at most 2^30 bits), and which only spares work: what passes wrongly finds no partner.
"""

from __future__ import annotations

import html
import re
import unicodedata

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from docstrata.runtime import HEAVY_SHARE, small, staged

SHINGLE = 5
#: (words of a window, edits it may have).
WINDOWS = ((15, 1), (20, 2))
#: Words before and behind a shingle that a window around it can reach, with room for words that are added.
BEFORE, BEHIND = 17, 17
_REACH = max(size for size, _ in WINDOWS) - SHINGLE
#: Bits of the bitmap for each wanted shingle, and how many it has at least and at most (powers of two).
BITS_EACH, LEAST_BITS, MOST_BITS = 64, 15, 30

_WORD = re.compile(r"[^\W_]+")
# scripts that put no blanks between words: each sign is a word
_DENSE = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
_HAS_DENSE = re.compile(f"[{_DENSE}]")
_DENSE_WORD = re.compile(rf"[{_DENSE}]|[^\W_{_DENSE}]+")
_TAG = re.compile(r"</?[A-Za-z][^<>\n]*>|<!--[^<>]*-->")
_URL = re.compile(r"\]\([^()\n]*\)|\]\[[^\[\]\n]*\]|\\(?:emph|text\w\w|href|item|cite)\b")
_LINE = re.compile(r"^[ \t]*(?:[>|#*+-]+[ \t]*)*(?:\(?(?:[a-zA-Z]|\d{1,5})[.):|][ \t]+|\d{1,5}[ \t]{2,}|L\d{1,5}:?[ \t]+|\[\d+\][ \t]+)?", re.M)
_BROKEN = re.compile(r"([^\W\d_])[-­]\n[ \t>|#*]*([^\W\d_])")
_HIDDEN = re.compile("[­​-‏⁠﻿]")


def words(text: str) -> list[str]:
    """The words of a text in order, regardless of case, punctuation, spacing, line prefixes and markup."""
    if "\r" in text:
        text = text.replace("\r\n", "\n")
    dense = False
    if not text.isascii():
        text = _HIDDEN.sub("", unicodedata.normalize("NFKC", text))
        dense = _HAS_DENSE.search(text) is not None
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "](" in text or "][" in text or "\\" in text:
        text = _URL.sub(" ", text)
    if "-\n" in text:
        text = _BROKEN.sub(r"\1\2", text)
    return (_DENSE_WORD if dense else _WORD).findall(_LINE.sub("", text).lower())


class _Numbers(dict):
    """word -> 63 bits of its hash, never 0."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = n = (xxhash.xxh64_intdigest(word) >> 1) or 1
        return n


_numbers = _Numbers()


def numbered(tokens: list[str]) -> np.ndarray:
    return np.fromiter(map(_numbers.__getitem__, tokens), np.int64, len(tokens))


def rolled(numbers: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """The hash of the shingle of that size at each place; 0 where it holds a 0, which is no word."""
    n = len(numbers) - size + 1
    if n <= 0:
        return np.empty(0, np.int64)
    h, whole = np.full(n, size, dtype=np.uint64), np.ones(n, dtype=bool)
    with np.errstate(over="ignore"):
        for j in range(size):
            part = numbers[j : j + n]
            whole &= part != 0
            h = (h ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    h[whole & (h == 0)] = 1
    h[~whole] = 0
    return h.view(np.int64)


def edits_allowed(n: int) -> int:
    """Of an item that is one window."""
    return n // 10


def prefix(frequencies: list[int], n: int) -> list[int]:
    """Places of the shingles of an item of n words that are looked up, given how many documents have each.

    Of every window the rarest, as many as its edits can destroy and one more; those that no document has are left out,
    as they cannot be met.
    """
    order = sorted(range(len(frequencies)), key=lambda p: (frequencies[p], p))
    rank = {p: r for r, p in enumerate(order)}
    windows = [(size, edits) for size, edits in WINDOWS if size <= n] or [(n, edits_allowed(n))]
    taken: set[int] = set()
    for size, edits in windows:
        span, need = max(size - SHINGLE + 1, 1), SHINGLE * edits + 1
        for a in range(max(len(frequencies) - span + 1, 1)):
            taken.update(sorted(range(a, min(a + span, len(frequencies))), key=rank.__getitem__)[:need])
    return sorted(p for p in taken if frequencies[p] > 0)


def _reached(item: list[int], doc: list[int], edits: int) -> list[int]:
    """For 0..edits edits, how many words at the beginning of the item stand at the beginning of doc; changed ones count."""
    best, ends = [], {0: 0}  # diagonal (document minus item place) -> furthest item place with the edits so far
    for _ in range(edits + 1):
        for d, i in ends.items():
            while i < len(item) and i + d < len(doc) and item[i] == doc[i + d]:
                i += 1
            ends[d] = i
        best.append(max(ends.values()))
        onward: dict[int, int] = {}
        for d, i in ends.items():
            # the item's word is changed, is left out, or a word is added
            for di, dd in ((1, 0), (1, -1), (0, 1)):
                if i + di <= len(item):
                    onward[d + dd] = max(onward.get(d + dd, 0), i + di)
        ends = onward
    return best


def agrees(item: list[int], place: int, n: int, doc: list[int], at: int) -> bool:
    """Whether a window of the item counts in the document around a shingle they share.

    item holds words of an item of n words around its shingle at place; doc those of the document around it at at.
    """
    size = min(SHINGLE, n)
    windows = [(w, e) for w, e in WINDOWS if w <= n] or [(n, edits_allowed(n))]
    most = max(e for _, e in windows)
    left = _reached(item[:place][::-1], doc[:at][::-1], most)
    right = _reached(item[place + size :], doc[at + size :], most)
    return any(left[a] + size + right[e - a] >= w for w, e in windows for a in range(e + 1))


def _flat(texts: pd.Series) -> tuple[np.ndarray, list[int], list[int]]:
    """(numbers of the words of all texts with zeros between them, where each begins, how many it has)."""
    tokens = [words(t) if t else [] for t in texts]
    lengths = [len(t) for t in tokens]
    flat, starts, at = np.zeros(sum(lengths) + SHINGLE * (len(tokens) + 1), np.int64), [], 0
    for t, n in zip(tokens, lengths, strict=True):
        starts.append(at)
        flat[at : at + n] = numbered(t)
        at += n + SHINGLE
    return flat, starts, lengths


class Bitmap:
    """Which shingle hashes are wanted: of those that are, all; of others few. A hash sets two bits, of its lower and its upper half."""

    def __init__(self, bits: int, buckets: list[tuple[int, bytes]]) -> None:
        self.mask = (1 << bits) - 1
        self.data = np.zeros((self.mask + 1) // 8, np.uint8)
        for number, data in buckets:
            self.data[(number - 1) * 4096 : number * 4096] = np.frombuffer(data, np.uint8)

    @classmethod
    def of(cls, hashes: DataFrame, column: str = "h") -> Bitmap:
        """Of a table's distinct hashes; the driver holds the bits, never the hashes."""
        n = hashes.agg(F.count_distinct(column)).first()[0]
        bits = min(max((BITS_EACH * n).bit_length(), LEAST_BITS), MOST_BITS)
        halves = F.array(F.col(column), F.shiftright(column, 32))
        at = F.col("half").bitwiseAND(F.lit((1 << bits) - 1)) + 1
        by = hashes.select(F.explode(halves).alias("half")).groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("data"))
        return cls(bits, [(r.bucket, bytes(r.data)) for r in by.toLocalIterator()])

    def passes(self, h: np.ndarray) -> np.ndarray:
        """The places of the hashes that do."""
        at = h & self.mask
        some = np.flatnonzero(((self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1) & (h != 0))
        at = (h[some] >> 32) & self.mask
        return some[((self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)]


def _seen_udf(bitmap, sizes: list[int]):
    @F.pandas_udf(ArrayType(LongType()))
    def seen(texts: pd.Series) -> pd.Series:
        flat, starts, _ = _flat(texts)
        rows: list = [None] * len(texts)
        for size in sizes:
            h = rolled(flat, size)
            some = bitmap.value.passes(h)
            owner = np.searchsorted(starts, some, side="right") - 1
            ends = np.append(np.flatnonzero(np.diff(owner)) + 1, len(owner))
            for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True) if len(owner) else ():
                o = int(owner[a])
                rows[o] = (rows[o] or []) + list(set(h[some[a:b]].tolist()))
        return pd.Series(rows, dtype=object)

    return seen


_HITS = ArrayType(StructType([StructField("h", LongType()), StructField("at", IntegerType()), StructField("near", ArrayType(LongType()))]))


def _hits_udf(bitmap, sizes: list[int]):
    @F.pandas_udf(_HITS)
    def hits(texts: pd.Series) -> pd.Series:
        flat, starts, lengths = _flat(texts)
        rows: list = [None] * len(texts)
        for size in sizes:
            h = rolled(flat, size)
            some = bitmap.value.passes(h)
            owner = np.searchsorted(starts, some, side="right") - 1
            for q, o in zip(some.tolist(), owner.tolist(), strict=True):
                a, b = starts[o], starts[o] + lengths[o]
                low, high = max(a, q - BEFORE), min(b, q + SHINGLE + BEHIND)
                if rows[o] is None:
                    rows[o] = []
                rows[o].append((int(h[q]), q - low, flat[low:high].tolist()))
        return pd.Series(rows, dtype=object)

    return hits


@F.pandas_udf(ArrayType(LongType()))
def _item_words(texts: pd.Series) -> pd.Series:
    return pd.Series([numbered(words(t)).tolist() if t else [] for t in texts], dtype=object)


@F.pandas_udf(ArrayType(LongType()))
def _item_shingles(items: pd.Series) -> pd.Series:
    return pd.Series([rolled(np.asarray(w, np.int64), min(SHINGLE, len(w))).tolist() if len(w) else [] for w in items], dtype=object)


@F.pandas_udf(ArrayType(IntegerType()))
def _prefix(frequencies: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([prefix(list(f), k) for f, k in zip(frequencies, n, strict=True)], dtype=object)


@F.pandas_udf(BooleanType())
def _agrees(item: pd.Series, place: pd.Series, n: pd.Series, doc: pd.Series, at: pd.Series) -> pd.Series:
    return pd.Series([agrees(i.tolist(), p, k, d.tolist(), q) for i, p, k, d, q in zip(item, place, n, doc, at, strict=True)], dtype=bool)


def _joined(hits: DataFrame, wanted: DataFrame) -> DataFrame:
    """hits (key, h, ...) with wanted (h, docs, ...): by broadcast where that is small, else shuffled by shingle, frequent ones in parts.

    A shingle is frequent when it has more than HEAVY_SHARE of all occurrences, so there are at most 1/HEAVY_SHARE of them.
    """
    known = small(wanted)
    if known is not wanted:
        return hits.join(known, "h").drop("docs")
    by_shingle = wanted.select("h", "docs").distinct()
    part = max(1000, int((by_shingle.agg(F.sum("docs")).first()[0] or 0) * HEAVY_SHARE))
    heavy = F.broadcast(by_shingle.where(F.col("docs") > part).select("h", F.ceil(F.col("docs") / part).cast("int").alias("parts")))
    one = F.coalesce("parts", F.lit(1))
    left = hits.join(heavy, "h", "left").withColumn("salt", F.pmod(F.xxhash64("near", "at"), one).cast("int")).drop("parts")
    right = wanted.join(heavy, "h", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), one - 1))).drop("parts")
    return left.join(right, ["h", "salt"]).drop("salt", "docs")


def leaks(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """(key, item_key): documents that contain an item's text or a passage of it, each pair once.

    Null and empty texts contain nothing, items without a word are in no document, those of fewer than ten words where
    they stand word for word. Repeated documents and items count once; items without a key are left out.
    """
    spark: SparkSession = docs.sparkSession
    known = items.where(F.col(item_key).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_key).alias("__item"), _item_words(item_text).alias("words"))
    known = staged(known.where(F.size("words") > 0).distinct().withColumn("shingles", _item_shingles("words")), "items")
    numbered_items = known.withColumn("n", F.size("words"))
    sizes = sorted(r[0] for r in numbered_items.select(F.least("n", F.lit(SHINGLE)).alias("size")).distinct().collect())  # at most five
    shingles = numbered_items.select("__item", "words", "n", F.posexplode("shingles").alias("p", "h"))
    texts = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("__doc"), F.col(text).alias("__text"))

    seen = _seen_udf(spark.sparkContext.broadcast(Bitmap.of(shingles)), sizes).asNondeterministic()
    counts = staged(texts.select(F.explode(seen("__text")).alias("h")).groupBy("h").agg(F.count("*").alias("docs")), "shingle-counts")

    # one row an item again, with the counts of its shingles in their order
    counted = shingles.select("__item", "words", "n", "p", "h").join(small(counts), "h", "left")
    counted = counted.groupBy("__item", "words", "n").agg(F.sort_array(F.collect_list(F.struct("p", "h", F.coalesce("docs", F.lit(0)).alias("docs")))).alias("s"))
    chosen = counted.withColumn("taken", F.explode(_prefix.asNondeterministic()(F.col("s.docs"), F.col("n"))))
    shingle, place = F.get("s", F.col("taken")), F.least(F.col("taken"), F.lit(_REACH))
    around = F.slice("words", F.col("taken") - place + 1, F.lit(2 * _REACH + SHINGLE))
    wanted = staged(chosen.select(shingle["h"].alias("h"), shingle["docs"].alias("docs"), "__item", "n", place.alias("place"), around.alias("item_words")), "prefixes")

    hits = _hits_udf(spark.sparkContext.broadcast(Bitmap.of(wanted)), sizes).asNondeterministic()
    met = _joined(texts.select("__doc", F.inline(hits("__text"))), wanted)
    found = met.where(_agrees("item_words", "place", "n", "near", "at")).select(F.col("__doc").alias(key), F.col("__item").alias(item_key))
    return found.distinct()
