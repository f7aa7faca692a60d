import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docstrata.functions import fences, links
from docstrata.functions import markdown as M
from docstrata.functions import text as X
from docstrata.functions import titles as T
from docstrata.functions import urls as U


def column(spark, values, make, kind="string"):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    return [r[0] for r in df.orderBy("n").select(make(F.col("v")).alias("x")).collect()]


def test_urls(spark):
    assert column(spark, [" https://a.b/c/?q#f ", "https://a.b///", None], U.clean_url) == ["https://a.b/c", "https://a.b", None]
    assert column(spark, ["https://a.b", "https://a.b/x", "https://a.bc"], lambda c: U.same_origin(c, F.lit("https://a.b/"))) == [True, True, False]
    assert column(spark, ["a<b>|\n"], U.safe_url) == ["a%3Cb%3E%7C%0A"]
    assert column(spark, ["https://a.b/docs/x/y?z", "https://a.b/docs", "https://a.b/docsx"], lambda c: U.slug_below(c, F.lit("https://a.b"), "/docs")) == ["x/y", "index", None]


def test_slug_rules_in_order(spark):
    bad = [None, " ", " a", "a" * 201, "a b", "/a", "a/../b", "a/", "a//b"]
    assert column(spark, bad, U.slug_violation) == ["blank", "blank", "padded", "long", "sign", "absolute", "parent", "trailing", "empty"]
    assert column(spark, ["a", "a" * 200, "a.b/c_d-e", "..."], U.slug_violation) == [None] * 4


def test_paths(spark):
    pairs = [("a/b", "a/c"), ("b", "a/c"), ("a/b/c", "x"), ("a/b", "a/b/c/d"), ("x", "x")]
    df = spark.createDataFrame([(n, *p) for n, p in enumerate(pairs)], "n int, t string, p string").orderBy("n")
    assert [r[0] for r in df.select(U.relative_path(F.col("t"), F.col("p"))).collect()] == ["./b", "../b", "./a/b/c", "../../b", "./x"]
    assert column(spark, ["<a%20b+c?x#y>", "100%"], U.unescaped_path) == ["a b+c", "100%"]
    assert column(spark, ["a/./b?x", "../a", "a/../..", "/a", "a\\b", "."], U.asset_path) == ["a/b", None, None, None, None, None]


def test_titles_and_versions(spark):
    assert column(spark, [" Straße.md.HTML ", "API!?", "Überblick."], T.canonical_title) == ["strasse", "api", "überblick"]
    assert column(spark, ["overview", "abc", "some page"], T.usable_title) == [False, False, True]
    assert column(spark, ["v1.2.3-rc.1 x", "v7", " ", None, "—"], T.version) == ["1.2.3-rc.1", "7", None, None, "—"]
    assert column(spark, ["1.2.3-a"], lambda c: T.version_parts(c)["minor"]) == [2]


def test_small_text_functions(spark):
    assert column(spark, ["a|b*&<"], X.title_escaped) == ["a\\|b\\*&amp;&lt;"]
    assert column(spark, ["a &amp; b_<\r\nc"], X.log_escaped) == ["a &amp; b\\_&lt; c"]
    assert column(spark, ["日本a", "abc"], X.display_width) == [5, 3]
    assert column(spark, ["Hello, Wörld x"], X.heading_anchor) == ["hello-wörld-x"]
    assert column(spark, ["https://x/config-basic-use/", "https://x/it's-here.md"], X.section_title) == ["Basic Use Configuration", "It'S Here"]
    assert column(spark, ["de, en,xx,de", "all"], lambda c: X.list_selection(c, ["en", "de", "fr"])["selected"]) == [["de", "en"], ["de", "en", "fr"]]
    assert column(spark, [1, 3, 9], X.backoff_seconds, "int") == [2.0, 8.0, 30.0]
    assert column(spark, ["5", "-1", "99", "soon"], X.retry_after) == [5.0, 0.0, 30.0, None]
    assert column(spark, ["'a'", ' "b" '], X.yaml_unquoted) == ["a", "b"]


def text_of(text, grammar):
    return [text[a:b] for a, b in fences.GRAMMARS[grammar](text)]


def test_fence_grammars_differ():
    longer = "```js\nx\n````\ny\n```\n"
    assert text_of(longer, "title") == [longer[:-1]] and text_of(longer, "component") == ["```js\nx\n````"]
    shorter = "````\nx\n```\ny\n"
    assert text_of(shorter, "block") == ["````\nx\n```"] and text_of(shorter, "component") == [] and text_of(shorter, "link") == [shorter]
    inner = "  ```\n  x\n  ```\n"
    assert text_of(inner, "block") == [] and text_of(inner, "indented") == ["```\n  x\n  ```"] and text_of(inner, "component") == ["  ```\n  x\n  ```"]
    open_ = "a\n```\nb"
    assert [text_of(open_, g) for g in ("title", "block", "indented", "component")] == [[], [], [], []] and text_of(open_, "link") == ["```\nb"]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="`~ab \n\x02\x030", max_size=80))
def test_shielding_is_reversible(text):
    for g in fences.GRAMMARS:
        spans = fences.GRAMMARS[g](text)
        assert all(a < b <= len(text) for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))
        assert fences.restored(*fences.shielded(text, g)) == text


@pytest.mark.parametrize("pattern", ["```\n", "```js\n", "`", "[a](", "~~~~\n", "# a\n"])
def test_scanners_are_linear(pattern):
    def took(n):
        t = time.process_time()
        for g in fences.GRAMMARS.values():
            g(pattern * n)
        links.links_of(pattern * n)
        M.title_of(pattern * n)
        return time.process_time() - t

    took(100)
    assert min(took(20000) for _ in range(3)) < 9 * max(0.05, min(took(5000) for _ in range(3)))  # four times the input: 4 if linear, 16 if quadratic


def test_markdown(spark):
    good = ["---\ntitle: x\n---\n", "x\n## H\n", "Title\n=====\n", "﻿# a"]
    bad = ["plain", "----\n----\n", "<!DOCTYPE html>\n# x", ""]
    assert column(spark, good + bad, M.is_markdown) == [True] * 4 + [False] * 4
    assert [M.title_of(t, "-") for t in ("---\ntitle: 'A'\n---\n# B", "```\n# no\n```\n# B ##", "Under\n---\n", "x", "---\nother: 1\n---\nUp\n===")] == ["A", "B", "Under", "-", "Up"]
    assert M.split_front("---\na: 1\nhero:\n  name: N\n---\nbody") == ({"a": "1", "hero.name": "N"}, "body")
    assert M.split_front("---\n\nnot fields\n\n---\nx")[0] == {}
    assert M.blank_runs_collapsed("a\n\n\n\nb\n```\n\n\n\n```\n") == "a\n\nb\n```\n\n\n\n```\n"
    assert M.demoted("# a\n```\n# b\n```\n###### c", 2) == "### a\n```\n# b\n```\n###### c"
    assert M.is_stub("# T\n\nSee [x](y.md).") and not M.is_stub("[a](b.md) [c](d.md)")
    assert column(spark, ["a​b\tc\x07"], M.visible) == ["ab\tc"]


def test_links(spark):
    text = 'a [x](y.md "t") `[no](z.md)` ![i](<p q.png>)\n[r]: ref.md\n```\n[no](n.md)\n```\n<a href="h.md">\n[q](r(1).md)'
    assert links.links_of(text) == [(1, "y.md"), (1, "<p q.png>"), (2, "ref.md"), (6, "h.md"), (7, "r(1).md")]
    kinds = column(spark, [None, "", "#a", "?a", "//a", "MAILTO:x", "/a", "a.md", "<b.md>", "http://[::1"], links.destination_kind)
    assert kinds == [None] * 6 + ["site-absolute", "relative", "relative", None]
    assert links.masked("`` a ` b `` `c") == " " * 11 + " `c"
    known = {"a/b", "index"}.__contains__
    once = links.rewritten("[x](/a/b#y) [z](https://s.t/q?r) [i](/) `[x](/a/b)`\n```\n[x](/a/b)\n```", "a/c", known, "https://s.t")
    assert once.startswith("[x](./b.md#y) [z](https://s.t/q?r) [i](../index.md)") and once.endswith("```\n[x](/a/b)\n```")
    assert links.rewritten(once, "a/c", known, "https://s.t") == once


def _by_definition(text, grammar):
    """Fenced blocks line by line, every opener looking ahead on its own."""
    pad = {"title": "", "block": "", "indented": " {0,3}", "component": "[ \\t]*", "link": " {0,3}"}[grammar]
    lines, starts, at = text.split("\n"), [], 0
    for x in lines:
        starts.append(at)
        at += len(x) + 1
    fence = [re.match(rf"({pad})(`{{3,}}|~{{3,}})(.*)\Z", x, re.S) for x in lines]
    spans, n = [], 0
    while n < len(lines):
        m, last = fence[n], None
        if m and not (grammar == "component" and m[2][0] == "`" and "`" in m[3]):
            for run in [m[2][:3]] if grammar == "title" else [m[2][:k] for k in range(len(m[2]), 2, -1)] if grammar in ("block", "indented") else [None]:
                closes = lambda c: c and not c[3].strip() and (c[2] == run if run else c[2][0] == m[2][0] and len(c[2]) >= len(m[2]))  # noqa: E731, B023
                last = next((k for k in range(n + 1, len(lines)) if closes(fence[k])), None)
                if last is not None:
                    break
            else:
                last = len(lines) - 1 if grammar == "link" else None
        if last is None:
            n += 1
            continue
        spans.append((starts[n] + (0 if grammar in ("component", "link") else len(m[1])), starts[last] + len(lines[last])))
        n = last + 1
    return spans


@pytest.mark.parametrize("grammar", fences.GRAMMARS)
def test_fence_grammars_equal_their_definition(grammar):
    r = random.Random(grammar)
    for _ in range(3000):
        text = "\n".join(r.choice(["", "", " ", "   ", "    ", "\t"]) + r.choice("`~x") * r.randrange(2, 6) + r.choice(["", "", "", " ", "js", "a`b"]) for _ in range(r.randrange(1, 9)))
        assert fences.GRAMMARS[grammar](text) == _by_definition(text, grammar), text


def test_masks_equal_their_definition():
    r = random.Random(3)
    for _ in range(3000):
        line = "".join(r.choice(["`", "``", "```", "a", "b "]) for _ in range(r.randrange(1, 14)))
        runs, want, k = [m.span() for m in re.finditer("`+", line)], line, 0
        while k < len(runs):
            a, b = runs[k]
            same = next((j for j in range(k + 1, len(runs)) if runs[j][1] - runs[j][0] == b - a), None)
            if same is not None:
                want = want[:a] + " " * (runs[same][1] - a) + want[runs[same][1] :]
                k = same
            k += 1
        assert links.masked(line) == want, line
