import math
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from docstrata.llm import packing as P
from docstrata.llm import prose as Q

tokenizer = pytest.mark.skipif(not __import__("os").path.exists(P.TOKENIZER), reason="no tokenizer file")


def padding(histogram, bounds):
    return sum(c * (min(b for b in bounds if b >= s) - s) for s, c in histogram.items())


def test_boundaries_are_optimal():
    r = random.Random(4)
    for _ in range(60):
        sizes = r.sample(range(1, 60), r.randrange(1, 10))
        h = {s: r.randrange(1, 9) for s in sizes}
        k = r.randrange(1, 6)
        best = min(padding(h, (*c, max(h))) for c in combinations(sorted(h)[:-1], min(k, len(h)) - 1))
        got = P.boundaries(h, k)
        assert len(got) <= k and padding(h, got) == best


def test_plans_fit_and_use_everything():
    r = random.Random(5)
    for _ in range(50):
        counts = {r.randrange(1, 100): r.randrange(1, 500) for _ in range(r.randrange(1, 12))}
        used = dict.fromkeys(counts, 0)
        for plan, times in P.plans(counts, 100):
            assert sum(b * k for b, k in plan.items()) <= 100 and times > 0
            for b, k in plan.items():
                used[b] += k * times
        assert used == counts


@tokenizer
def test_containers(spark, rows):
    r = random.Random(6)
    data = [(n, " ".join(r.choice("alpha beta gamma delta".split()) for _ in range(r.randrange(1, 90)))) for n in range(300)] + [(1000, None), (1001, ""), (1002, "word " * 5000), (2000, "same key"), (2000, "same key")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as tokens", "2 as container")
    placed = P.packed(df, "doc_id", "text", [(1, 64), (2, 1000)]).collect()
    for w, cap in ((1, 64), (2, 1000)):
        mine = [x for x in placed if x.window_id == w]
        totals, per_doc = {}, {}
        for x in mine:
            totals[x.container] = totals.get(x.container, 0) + x.tokens
            per_doc.setdefault(x.doc_id, []).append((x.piece, x.tokens))
        assert max(totals.values()) <= cap and sorted(totals) == list(range(len(totals)))
        assert 1000 not in per_doc and 1001 not in per_doc and len(per_doc[2000]) == 2
        assert all(t == cap for _, t in sorted(per_doc[1002])[:-1]) and [p for p, _ in sorted(per_doc[1002])] == list(range(len(per_doc[1002])))
        assert all(len(v) == 1 for k, v in per_doc.items() if k not in (2000, 1002) and sum(t for _, t in v) <= cap)
        assert len(totals) <= 1.2 * math.ceil(sum(totals.values()) / cap) + 1
    assert P.packed(df.where("false"), "doc_id", "text", [(1, 64)]).count() == 0 and P.packed(df, "doc_id", "text", []).count() == 0


COMMON = frozenset("the a of is and it to in that der die und le la et el los de".split())


def test_statistics():
    prose = "The reader of a page is glad to see that it works. It is the end of the story, and that is good."
    assert Q.statistics(prose, COMMON)[5] == 1.0 and Q.statistics(prose.lower().replace(". ", ".\n- "), COMMON)[5] == 1.0
    for junk in ("a | b | c\n" * 5, "wide hooks, stale keys, narrow rules, older maps", "```\n" + prose + "\n```", "# The title of a page is here", "def f(a):\n    return a.b()\n", "0a1b2c3d" * 40, "§$%&/()" * 20):
        assert Q.statistics(junk, COMMON)[5] < 0.5, junk
    assert Q.statistics(None, COMMON) is None and Q.statistics("", COMMON) == (0, 0.0, 0.0, 0.0, 0.0, 0.0)
    assert Q.statistics("ab cde!\nf", COMMON)[:4] == (3, 2.0, round(1 / 7, 4), 0.5)


def test_ranks_and_scores_equal_brute_force(spark):
    r = random.Random(7)
    data = [(n, r.choice(["en", "EN-us", "de", None, ""]), " ".join(r.choice("the a of is alpha beta gamma".split()) for _ in range(r.choice([3, 3, 8, 20]))) + r.choice([".", "", " !?"])) for n in range(250)] + [(900, "en", None), (901, "en", ""), (902, "en", "the " * 60_000), (5, "en", "the same key twice is here."), (5, "en", "the same key twice is here.")]
    df = spark.createDataFrame(data, "doc_id long, lang string, text string").selectExpr("*", "1 as words", "2 as stat", "3 as value", "4 as n")
    common = spark.createDataFrame([("en", w) for w in sorted(COMMON)] + [("en", None)], "lang string, word string")
    got = Q.scored_documents(df, "doc_id", "text", "lang", common).collect()
    assert len(got) == len(data) - 1
    for lang in {g.lang for g in got}:
        group = [g for g in got if g.lang == lang]
        sums = {k: [0.0, 0.0, 0.0] for k in range(len(group))}
        for s in Q.STATISTICS:
            values = [g[s] for g in group]
            mean = sum(values) / len(values)
            skew = sum((v - mean) ** 3 for v in values)
            for k, g in enumerate(group):
                low, high = -math.log(sum(v <= g[s] for v in values) / len(values)), -math.log(sum(v >= g[s] for v in values) / len(values))
                for n, x in enumerate((low, high, low if skew < -1e-12 else high)):
                    sums[k][n] += x
        assert all(abs(g.score - max(sums[k])) < 1e-6 and g.ranked_of == len(group) for k, g in enumerate(group))
    assert Q.scored_documents(df.where("false"), "doc_id", "text", "lang", common).count() == 0
    ids = {x.doc_id for x in Q.not_prose(spark.createDataFrame(got)).collect()}
    assert 901 not in ids and 900 not in ids


def test_a_common_junk_page_is_not_prose(spark):
    """A page repeated to half of its language has tail shares near a half and a low score, and is found all the same."""
    prose = ["The reader of a page is glad to see that it works and is in the {} of it.", "It is the end of the {} and of the la et el story."]
    data = [(n, "en", " ".join(prose).format("w" * (n % 7 + 1), "v" * (n % 5 + 1))) for n in range(100)] + [(1000 + n, "en", "wide hooks of stale keys. narrow is the rules, older maps") for n in range(100)]
    common = spark.createDataFrame([("en", w) for w in sorted(COMMON)], "lang string, word string")
    scored = Q.scored_documents(spark.createDataFrame(data, "doc_id long, lang string, text string"), "doc_id", "text", "lang", common).collect()
    assert max(x.score for x in scored if x.doc_id >= 1000) < 5 and {x.ranked_of for x in scored} == {200}
    assert all(x.least_score == pytest.approx(math.log(2)) and x.score >= x.least_score for x in scored if x.doc_id >= 1000)
    assert sorted(x.doc_id for x in Q.not_prose(spark.createDataFrame(scored)).collect()) == list(range(1000, 1100))


def test_every_window_gets_containers(spark, tmp_path, monkeypatch):
    from docstrata.llm import queries

    spark.range(1500).selectExpr("id as window_id", "cast(64 as bigint) as capacity").write.parquet(f"file://{tmp_path}/pack_windows.parquet")
    spark.createDataFrame([(1, "a")], "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries.packing, "packed", lambda docs, key, text, windows: windows)
    assert queries.p6_containers(spark, str(tmp_path)) == [(n, 64) for n in range(1500)]


def test_no_document_below_a_half_scores_below_the_bound(spark):
    """Languages of one row, of junk only, and with junk and ties at any frequency: the candidates hold every document below a half."""
    r = random.Random(12)
    junk, good = ["hooks, keys, rules, maps", "a | b | c", "x = f(y);\n" * 3, "§$%&", "1 2 3"], ["The reader of a page is glad to see that it works.", "It is the end of the story, and that is good."]
    data = [(n, r.choice(["en", "de", "fr"]), " ".join(r.choice(good) for _ in range(r.randrange(1, 4)))) for n in range(80)]
    data += [(100 + n, r.choice(["en", "en", "xx"]), r.choice(junk) * r.randrange(1, 3)) for n in range(120)] + [(300, "yy", junk[0]), (301, "zz", good[0])]
    common = spark.createDataFrame([("en", w) for w in sorted(COMMON)], "lang string, word string")
    scored = spark.createDataFrame(Q.scored_documents(spark.createDataFrame(data, "doc_id long, lang string, text string"), "doc_id", "text", "lang", common).collect())
    want = sorted(x.doc_id for x in scored.collect() if x.sentence_share < 0.5)
    assert sorted(x.doc_id for x in Q.not_prose(scored).collect()) == want and {300, 100} <= set(want) and 301 not in want
    assert Q.not_prose(scored.withColumn("score", F.col("score") - 100)).count() == 0  # rows come by way of the score


def test_shares_of_other_scripts():
    assert Q.statistics("これは本の最初の文です。読者は喜びます。", COMMON)[5] == 1.0
    assert Q.statistics("Читатель рад видеть, что страница работает. Это уже конец его истории.", COMMON)[5] == 1.0
    assert Q.statistics("目次。概要。設定", COMMON)[5] == 0.0 and Q.statistics("ключи правила карты", COMMON)[5] == 0.0
    assert Q.statistics("The end of it is near. " + "wide " * 5, COMMON)[5] > 0.5 > Q.statistics("It is the end. " + "wide " * 4 + "w" * 3, COMMON)[5]
