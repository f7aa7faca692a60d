from datetime import UTC, datetime

from docstrata.operators.orphans import OrphanCounts, orphan_links, orphan_report


def at(day, hour=0):
    return datetime(2025, 9, day, hour, tzinfo=UTC)


RUNS = "run_id long, source string, started timestamp, completed timestamp, outcome string, slot int"
FILES = "run_id long, source string, slug string, key string, slot int"
ISSUES = "issue_id long, source string, file string, target string, reason string, checked_at timestamp, kind string, slot int"


def tables(spark, issues, files=None):
    runs = spark.createDataFrame([(1, "s", at(1), at(1, 1), "ok", 0), (2, "s", at(8), at(8, 1), "ok", 0), (3, "s", at(15), at(15, 1), "ok", 0), (4, "s", at(9), at(9, 1), "failed", 0)], RUNS)
    f = files if files is not None else [(1, "s", "always", "k", 1), (2, "s", "/always.md", "k", 1), (3, "s", "always", "k", 1), (1, "s", "dir/early", "k", 1), (3, "s", "dir/late", "k", 1), (1, "s", "dir/README", "k", 1), (2, "s", "dir/README", "k", 1), (4, "s", "failed", "k", 1)]
    sources = spark.createDataFrame([("s", ["./your-page.md"]), ("s", ["./your-page.md"]), ("t", None)], "source string, illustrative_link_targets array<string>")
    reasons = spark.createDataFrame([("code", at(1), None), ("old", at(1), at(5)), ("new", at(20), None), (None, at(1), None)], "reason string, active_from timestamp, retired_at timestamp")
    return spark.createDataFrame(issues, ISSUES), spark.createDataFrame(f, FILES), runs, sources, reasons


def found(spark, issues, files=None):
    return sorted((r.issue_id, r.field, r.kind) for r in orphan_links(*tables(spark, issues, files)).collect())


def issue(n, file=None, target=None, reason=None, when=None):
    return (n, "s", file, target, reason, when or at(10), "x", 3)


def test_kinds_by_moment(spark):
    got = found(spark, [
        issue(1, "s/always.md", "always.md"), issue(2, "docs/s/dir/early.md", "late.md"), issue(3, "./s/always.md", "dir/nowhere.md"),
        issue(4, "s/always.md", "dir/"), issue(5, "s/always.md", "dir/", when=at(16)), issue(6, "s/failed.md", "Always.md"), issue(7, "other/x.md", "../s/always.md"),
        issue(8, "s/always.md", "always.md", when=at(1, 1)), issue(9, "s/always.md", "always.md", when=at(1)),
    ])
    assert got == [
        (2, "file", "deleted"), (2, "target", "late"), (3, "target", "missing"), (5, "target", "deleted"), (6, "file", "missing"), (6, "target", "missing"), (7, "file", "missing"), (9, "file", "late"), (9, "target", "late"),
    ]


def test_targets_are_read_as_url_paths(spark):
    ok = ["<dir/../always.md>", "./always.md#a?b", "always.md?x=1#y", "%61lways.md", "dir//README.md", "dir/./README.md"]
    assert found(spark, [issue(n, "s/always.md", t) for n, t in enumerate(ok)]) == []
    none = ["#a", "?q", "mailto:a@b.c", "https://x.y/z.md", "//x/y.md", "/always.md", "./your-page.md#x", " ", None]
    assert found(spark, [issue(n, "s/always.md", t) for n, t in enumerate(none)]) == []
    bad = ["always", "../../up.md", "100%.md", "a+b.md"]
    assert found(spark, [issue(n, "s/always.md", t) for n, t in enumerate(bad)]) == [(n, "target", "missing") for n in range(4)]


def test_reasons_nulls_and_repeats(spark):
    got = found(spark, [issue(1, None, "x.md", " CODE "), issue(2, " ", "x.md", "old"), issue(3, None, None, "new"), issue(4, None, None, "what"), issue(5, None, None, " "), issue(5, None, None, "what"), issue(6, None, None, "old", at(2)), (7, None, "s/gone.md", None, None, None, "x", 1)])
    assert got == [(2, "reason", "deleted"), (3, "reason", "late"), (4, "reason", "missing"), (5, "reason", "missing")]


def test_a_hot_key_keeps_all_its_rows(spark):
    issues = [issue(n, "s/always.md", "gone.md") for n in range(3000)] + [issue(n, "s/always.md", f"gone{n}.md") for n in range(3000, 3010)]
    df = orphan_links(*tables(spark, issues))
    assert df.count() == 3010
    assert [(r.field, r.kind, r.orphans, r.week) for r in orphan_report(df).collect()] == [("target", "missing", 3010, "2025-09-08")]


def test_odd_paths(spark):
    odd = [".", "..", "/", "s", "s/", "docs/", "docs", "docs/docs/x.md", "\\", "%", "s/../..", "x" * 50_000 + ".md", "s/" + "../" * 2000 + "a.md"]
    got = found(spark, [issue(n, f, ".") for n, f in enumerate(odd)] + [issue(100 + n, "s/always.md", t) for n, t in enumerate([".", "..", "../", "./", "../../../", "<>", "%2e%2e/s/always.md", "%zz.md"])])
    assert [g for g in got if g[1] == "file"] == [(n, "file", "missing") for n in range(len(odd))]
    assert not [g for g in got if g[0] in (105, 106)] and all(g[2] == "missing" for g in got)


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [issue(1, "s/a.md")], []) == [(1, "file", "missing")]


def test_counts_are_kept_and_only_deltas_are_read(spark, tmp_path, rows):
    """Run by run and check by check the kept counts say what counts made of all rows say, and nothing is read twice."""
    import random

    r = random.Random(6)
    pages = [(run, "s", f"p{k}", "k", 1) for run in (1, 2, 3) for k in r.sample(range(12), 6)] + [(2, "s", "dir/index", "k", 1)]
    checks = [issue(n, "s/p%d.md" % r.randrange(14), r.choice(["p%d.md" % r.randrange(14), "dir/", None]), r.choice(["code", "old", "new", "none"]), at(r.randrange(1, 20), r.randrange(3))) for n in range(80)]
    i, f, runs, sources, reasons = tables(spark, checks, pages)
    for step, upto in enumerate((at(1, 2), at(9), at(15), at(20))):
        part = lambda df, c: df.where(df[c] <= upto)  # noqa: E731, B023
        taken = OrphanCounts(spark, f"file://{tmp_path}/o").take(part(i, "checked_at"), f, part(runs, "completed"), sources, reasons)
        known = OrphanCounts(spark, f"file://{tmp_path}/o")
        assert rows(known.orphans(reasons)) == rows(orphan_links(part(i, "checked_at"), f, part(runs, "completed"), sources, reasons)), step
        assert taken["runs"] == (1, 1, 0, 1)[step]
    assert known.take(i, f, runs, sources, reasons) == {"runs": 0, "references": 0}
