"""Filling fixed-capacity containers with texts, measured in tokens.

Dynamic programming over the global histogram of lengths chooses bucket boundaries that minimise padding. Containers are
token budgets: plans of bucket slots, largest bucket first and then whatever fits, each plan repeated while its buckets
last. A window is planned in one task from its histogram, which has at most capacity rows; every item finds its container
from its exact rank within its bucket.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from docstrata.functions.search import at_or_before
from docstrata.runtime import small, staged

#: Public byte-level BPE ranks; the file is never copied into the repository.
TOKENIZER = os.environ.get("DOCSTRATA_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: The published split pattern that belongs to these ranks.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BUCKETS = 256
#: Rows of a bucket ranked in one task.
RANKED_ROWS = 1_000_000


@functools.cache
def encoding(path: str, pattern: str = PATTERN):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def with_tokens(docs: DataFrame, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """Adds tokens; null for a null text."""

    @F.pandas_udf(LongType())
    def count(texts: pd.Series) -> pd.Series:
        encode = encoding(tokenizer).encode_ordinary
        return pd.Series([None if t is None else len(encode(t)) for t in texts], dtype="Int64")

    return docs.withColumn("tokens", count.asNondeterministic()(F.col(text)))  # so that a filter on it does not run it again


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper bounds of at most that many buckets with the least total padding (bound minus length), exactly.

    Layer by layer, the best last cut before each length is a query on the lower hull of lines, so a layer is linear.
    """
    sizes = sorted(histogram)
    if len(sizes) <= buckets:
        return sizes
    n = np.cumsum([0] + [histogram[s] for s in sizes]).tolist()
    w = np.cumsum([0] + [histogram[s] * s for s in sizes]).tolist()
    u = len(sizes)
    cost: list[float] = [0.0] + [float("inf")] * u
    cuts: list[list[int]] = []
    for _ in range(buckets):
        hull: list[int] = []
        new, cut, head = [float("inf")] * (u + 1), [0] * (u + 1), 0
        new[0] = 0.0
        for j in range(1, u + 1):
            i = j - 1
            if cost[i] < float("inf"):
                while len(hull) - head >= 2:
                    a, b = hull[-2], hull[-1]
                    ya, yb, yi = cost[a] + w[a], cost[b] + w[b], cost[i] + w[i]
                    if (yi - ya) * (n[b] - n[a]) <= (yb - ya) * (n[i] - n[a]):
                        hull.pop()
                    else:
                        break
                hull.append(i)
            bound = sizes[j - 1]
            while len(hull) - head >= 2 and cost[hull[head + 1]] + w[hull[head + 1]] - bound * n[hull[head + 1]] <= cost[hull[head]] + w[hull[head]] - bound * n[hull[head]]:
                head += 1
            if len(hull) > head:
                i = hull[head]
                new[j], cut[j] = cost[i] + w[i] - bound * n[i] + bound * n[j] - w[j], i
        cost = new
        cuts.append(cut)
    bounds, j = [], u
    for cut in reversed(cuts):
        if j == 0:
            break
        bounds.append(sizes[j - 1])
        j = cut[j]
    return bounds[::-1]


def plans(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(slots by bucket bound, times): containers for counts items of each bound, none above capacity."""
    left = {b: c for b, c in counts.items() if c}
    out = []
    order = sorted(left, reverse=True)
    while order:
        room, plan = capacity, {}
        for b in order:
            if (k := min(room // b, left[b])) > 0:
                plan[b] = k
                room -= k * b
                if room < order[-1]:
                    break
        times = min(left[b] // k for b, k in plan.items())
        out.append((plan, times))
        for b, k in plan.items():
            left[b] -= k * times
        order = [b for b in order if left[b]]
    return out


PLAN = "window_id long, tokens long, bound long, items long, firsts array<long>, repeats array<long>, bases array<long>"


def planned(histogram: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """The plan of one window, whose histogram (window_id, capacity, tokens, count) has at most capacity rows.

    Rows with tokens give the bucket of a size; those without give a bucket's slots: a slot begins at an item's rank in
    its bucket (firsts), takes so many items a container (repeats), and fills containers from a number on (bases).
    """
    window, capacity = int(histogram["window_id"].iloc[0]), int(histogram["capacity"].iloc[0])
    seen = dict(zip(histogram["tokens"].tolist(), histogram["count"].tolist(), strict=True))
    bounds, counts, rows = boundaries(seen, buckets), {}, []
    for size, c in seen.items():
        bound = bounds[int(np.searchsorted(bounds, size))]
        rows.append((window, size, bound, None, None, None, None))
        counts[bound] = counts.get(bound, 0) + c
    slots: dict[int, list[tuple[int, int, int]]] = {b: [] for b in counts}
    base, start = 0, dict.fromkeys(counts, 0)
    for plan, times in plans(counts, capacity):
        for bound, k in plan.items():
            slots[bound].append((start[bound], k, base))
            start[bound] += k * times
        base += times
    rows += [(window, None, b, counts[b], *(list(x) for x in zip(*slots[b], strict=True))) for b in counts]
    return pd.DataFrame(rows, columns=[c.split()[0] for c in PLAN.split(", ")]).astype({"tokens": "Int64", "items": "Int64"})


def packed(docs: DataFrame, key: str, text: str, capacities: Iterable[tuple[int, int]], tokenizer: str = TOKENIZER, buckets: int = BUCKETS) -> DataFrame:
    """(window_id, container, key, piece, tokens) for each (window_id, capacity).

    Only texts of more tokens than the capacity are split: into full pieces and a rest, numbered from 0. Texts without
    tokens (null, empty) take no place; rows that repeat a key are items of their own. The tokenizer's file must be at
    that path on every executor.
    """
    spark = docs.sparkSession
    windows = [(int(w), int(c)) for w, c in capacities]
    if any(c < 1 for _, c in windows):
        raise ValueError("a capacity is at least 1")
    if not windows:
        return spark.createDataFrame([], "window_id long, container long").join(docs.select(key), F.lit(False)).select("window_id", "container", key, F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("tokens"))
    # numbered once, so that rows of one key are spread as well
    sized = staged(with_tokens(docs.select(key, text), text, tokenizer).select(key, "tokens", F.monotonically_increasing_id().alias("__row")).where("tokens > 0"), "tokens")
    caps = F.array(*(F.struct(F.lit(w).cast("long").alias("window_id"), F.lit(c).cast("long").alias("capacity")) for w, c in windows))
    pieces = sized.select(key, "__row", "tokens", F.inline(caps)).select("window_id", key, "__row", "capacity", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("tokens") / F.col("capacity")) - 1)).alias("piece"))
    pieces = pieces.select("window_id", "capacity", key, "__row", "piece", F.least(F.col("capacity"), F.col("tokens") - F.col("piece") * F.col("capacity")).alias("tokens"))

    histogram = pieces.groupBy("window_id", "capacity", "tokens").count()
    plan = staged(histogram.groupBy("window_id").applyInPandas(lambda histogram: planned(histogram, buckets), PLAN), "plans")
    parts = max(1, -(-(plan.agg(F.max("items")).first()[0] or 0) // RANKED_ROWS))
    bucket_of = small(plan.where("tokens is not null").select("window_id", "tokens", "bound"))
    slots = small(plan.where("tokens is null").select("window_id", "bound", "firsts", "repeats", "bases"))

    items = pieces.drop("capacity").join(bucket_of, ["window_id", "tokens"]).withColumn("part", F.pmod(F.xxhash64(key, "__row", "piece"), F.lit(parts)))
    group = ["window_id", "bound", "part"]
    sums = items.groupBy(*group).count()
    before = Window.partitionBy("window_id", "bound").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    ranked = items.withColumn("n", F.row_number().over(Window.partitionBy(*group).orderBy(key, "__row", "piece")) - 1).join(small(offsets), group)
    ranked = ranked.withColumn("rank", F.col("offset") + F.col("n")).join(slots, ["window_id", "bound"])
    ranked = ranked.withColumn("slot", at_or_before(F.col("firsts"), F.col("rank")) - 1)
    of_slot = lambda c: F.get(c, F.col("slot"))
    container = of_slot("bases") + F.floor((F.col("rank") - of_slot("firsts")) / of_slot("repeats"))
    return ranked.select("window_id", container.alias("container"), key, "piece", "tokens")


def bucket_only_fill(histogram: dict[int, int], capacity: int, buckets: int) -> float:
    """The filled share when containers take items of one bucket only, for comparison."""
    bounds, used, tokens = boundaries(histogram, buckets), 0, 0
    counts: dict[int, int] = {}
    for size, c in histogram.items():
        b = bounds[int(np.searchsorted(bounds, size))]
        counts[b] = counts.get(b, 0) + c
        tokens += size * c
    for b, c in counts.items():
        used += -(-c // (capacity // b))
    return tokens / (used * capacity) if used else 1.0


def fill(placed: DataFrame, windows: DataFrame) -> DataFrame:
    """(window_id, capacity, containers, items, tokens, overfull, unused_share)."""
    each = placed.groupBy("window_id", "container").agg(F.sum("tokens").alias("t"), F.count("*").alias("i"))
    by = each.join(small(windows.select("window_id", "capacity")), "window_id").groupBy("window_id", "capacity")
    return by.agg(F.count("*").alias("containers"), F.sum("i").alias("items"), F.sum("t").alias("tokens"), F.count_if(F.col("t") > F.col("capacity")).alias("overfull")).withColumn("unused_share", F.round(1 - F.col("tokens") / (F.col("containers") * F.col("capacity")), 6))
