import random

import numpy as np
import pytest

from docstrata.llm import leaks as K
from docstrata.llm.leaks import agrees, leaks, numbered, prefix, rolled, words

LEXICON = [f"w{n}" for n in range(400)]


def text(r, n):
    return [r.choice(LEXICON) for _ in range(n)]


def brute(item, doc):
    """Whether some passage of at least 15 item words (or the whole item) has at most one edit in ten words: edit distance to every stretch."""
    need = min(15, len(item))
    for a in range(len(item) - need + 1):
        best = [0] * (len(doc) + 1)
        for n, w in enumerate(item[a:], 1):
            row = [n]
            for j, v in enumerate(doc, 1):
                row.append(min(best[j - 1] + (v != w), best[j] + 1, row[j - 1] + 1))
            best = row
            if n >= need and min(best) * 10 <= n:
                return True
    return False


def found(doc, items):
    """Numbers of the items found in a document, by the parts of the operator."""
    d, got = numbered(doc), set()
    for k, item in enumerate(items):
        w = numbered(item)
        size = min(K.SHINGLE, len(w))
        h = rolled(w, size).tolist()
        at = {}
        for q, x in enumerate(rolled(d, size).tolist()):
            at.setdefault(x, []).append(q)
        for p in prefix([len(at.get(x, ())) for x in h], len(w)):
            place = min(p, K._REACH)
            around = w[p - place : p - place + 2 * K._REACH + K.SHINGLE].tolist()
            for q in at[h[p]]:
                low = max(0, q - K.BEFORE)
                if agrees(around, place, len(w), d[low : q + K.SHINGLE + K.BEHIND].tolist(), q - low):
                    got.add(k)
    return sorted(got)


def test_equals_brute_force():
    r = random.Random(11)
    for trial in range(300):
        item = text(r, r.randrange(5, 45))
        a = r.randrange(0, max(1, len(item) - 12))
        part = item[a : a + r.randrange(8, 40)]
        for _ in range(r.randrange(0, 4)):
            k = r.randrange(len(part))
            part = r.choice([part[:k] + ["other"] + part[k + 1 :], part[:k] + part[k + 1 :], part[:k] + ["more"] + part[k:]])
        doc = text(r, 20) + part + text(r, 20)
        want, got = brute(item, doc), found(doc, [item]) == [0]
        assert got == want, (trial, want, " ".join(part))


def test_layout_does_not_matter():
    plain = "the quick brown fox jumps over one lazy dog and then some more words follow it here"
    w = plain.split()
    assert words(plain.upper().replace(" ", "  ")) == w
    assert words("> " + " ".join(w[:8]) + "\n> " + " ".join(w[8:])) == w
    assert words("1. " + " ".join(w[:8]) + "\n2. " + " ".join(w[8:])) == w
    assert words("<p>" + " ".join(f"<b>{x}</b>" for x in w) + "</p>") == w
    assert words(" ".join(f"**{x}**," for x in w)) == w and words(" ".join(f"_{x}_" for x in w)) == w
    assert words("[" + " ".join(w[:5]) + "](http://x.y/z) " + " ".join(w[5:])) == w
    assert words(plain.replace("jumps", "jum-\nps").replace(" fox", "&nbsp;fox")) == w


def test_operator(spark, rows):
    r = random.Random(2)
    items = [text(r, 40) for _ in range(3)]
    base = " ".join(text(r, 30))
    docs = [(1, base + " " + " ".join(items[0])), (2, base + " " + " ".join(items[1][5:25]).upper()), (3, base + " " + " ".join(items[2][:12])), (4, None), (5, ""), (6, " ".join(items[0]) + " " + " ".join(items[2])), (6, " ".join(items[0])), (7, " ".join(LEXICON) * 500), (None, " ".join(items[1]))]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as h")
    it = spark.createDataFrame([(10 + n, " ".join(i), "x") for n, i in enumerate(items)] + [(10, " ".join(items[0]), "x"), (20, None, "x"), (None, "a b c d e f", "x"), (21, "", "x"), (22, "too short", "x")], "item_id long, text string, doc_id string")
    got = rows(leaks(df, "doc_id", "text", it, "item_id", "text"))
    assert got == sorted([(1, 10), (2, 11), (6, 10), (6, 12), (None, 11)], key=repr)
    assert leaks(df.where("false"), "doc_id", "text", it, "item_id", "text").count() == 0
    assert leaks(df, "doc_id", "text", it.where("false"), "item_id", "text").count() == 0


def test_shingles_hold_no_gap():
    assert (rolled(np.array([3, 4, 5, 6, 7, 0, 3, 4, 5, 6, 7])) != 0).tolist() == [True] + [False] * 5 + [True]
    assert rolled(np.array([3, 4])).tolist() == [] and len(rolled(np.array([3, 4]), 2)) == 1


def test_items_of_few_words():
    five, ten = "a b c d e".split(), "k l m n o p q r s t".split()
    assert found(["x"] * 9 + five + ["y"] * 9, [five, ten]) == [0]
    assert found(["x"] * 9 + ten[:4] + ["z"] + ten[5:] + ["y"] * 9, [five, ten]) == [1]
    assert found(["x", *five, "y"], [five]) == [0] and found(["x", *five[:4], "y"], [five]) == []
    assert found(["x", *ten[:5], "z", *ten[6:]], [ten]) == [0] and found(["x", *ten[:4], "z", "z", *ten[6:]], [ten]) == []
    items = ["too short".split(), ["one"], "too short".split(), "a b c d".split()]
    assert found("it is too short".split(), items) == [0, 2] and found("too very short".split(), items) == [] and found("x a b c d".split(), items) == [3]


def test_scripts_without_blanks():
    item, doc = "評価用の文章はこの一文だけで出来ています。", "前置き。評価用の文章はこの一文だけで出来ています。後書き。"
    assert len(words(item)) == 20 and found(words(doc), [words(item)]) == [0]
    assert found(words(doc.replace("一", "二")), [words(item)]) == [0] and found(words("前置き。評価用の。後書き。"), [words(item)]) == []
    assert words("Привет, мир 3") == ["привет", "мир", "3"] and words("가나 다라") == ["가나", "다라"]


def test_short_items_in_the_operator(spark, rows):
    docs = spark.createDataFrame([(1, "it is Too short."), (2, "too very short"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "too short")], "item_id long, text string")
    assert rows(leaks(docs, "doc_id", "text", items, "item_id", "text")) == [(1, 7)]


def test_recall_on_mixed_lengths_by_both_joins(spark, rows, monkeypatch):
    """Documents with passages of items of 3 to 60 words, edited, by broadcast and by the salted join: all that brute force finds."""
    r = random.Random(9)
    items = [text(r, r.choice([3, 5, 7, 10, 14, 15, 22, 60])) for _ in range(60)]
    common = text(r, 6)
    items += [common + text(r, 14) for _ in range(10)]
    docs = []
    for n in range(150):
        item = r.choice(items)
        a = r.randrange(0, max(1, len(item) - 16))
        part = item[a : a + r.randrange(14, 30)]
        for _ in range(r.randrange(0, 3)):
            k = r.randrange(len(part))
            part = part[:k] + r.choice([["other"], [], ["more", part[k]]]) + part[k + 1 :]
        docs.append((n, text(r, 15) + part + text(r, 10) + (common if n % 3 == 0 else [])))
    df = spark.createDataFrame([(n, " ".join(d)) for n, d in docs], "doc_id long, text string")
    it = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    want = sorted(((n, k) for n, d in docs for k, i in enumerate(items) if brute(i, d)), key=repr)
    assert rows(leaks(df, "doc_id", "text", it, "item_id", "text")) == want and len(want) > 60
    monkeypatch.setattr(K, "small", lambda side: side)
    monkeypatch.setattr(K, "HEAVY_SHARE", 0)
    assert rows(leaks(df, "doc_id", "text", it, "item_id", "text")) == want


def test_documents_are_scanned_twice_whatever_the_items(spark, tmp_path):
    r = random.Random(4)
    spark.createDataFrame([(n, " ".join(text(r, 30))) for n in range(20)], "doc_id long, text string").write.parquet(f"file://{tmp_path}/docs")
    df = spark.read.parquet(f"file://{tmp_path}/docs")
    it = spark.createDataFrame([(k, " ".join(text(r, 20))) for k in range(2000)], "item_id long, text string")
    plan = leaks(df, "doc_id", "text", it, "item_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("doc_id#") and plan.count("Relation [doc_id") == 1  # one scan for the join; the counts are staged by another


@pytest.mark.parametrize("n", [9, 10, 15, 19, 20, 33])
def test_prefix_holds_one_of_every_window(n):
    """Whatever the edits of a window destroy, a looked-up shingle is left."""
    r = random.Random(n)
    item = text(r, n)
    frequency = [r.randrange(1, 50) for _ in range(n - 4)]
    taken = set(prefix(frequency, n))
    for size, edits in [w for w in K.WINDOWS if w[0] <= n] or [(n, n // 10)]:
        for a in range(n - size + 1):
            for _ in range(50):
                hit = r.sample(range(a, a + size), edits)
                left = [p for p in range(a, a + size - 4) if not any(p <= x < p + 5 for x in hit)]
                assert not left or taken & set(range(a, a + size - 4)), item
                if edits < 2 or len(left) > 0:
                    assert taken & set(left) or len(left) == 0
