from datetime import UTC, datetime

from docstrata.operators.diff import diff, totals
from docstrata.operators.snapshots import last_snapshots, snapshot, snapshot_changes

RUNS = "run_id long, source string, started timestamp, completed timestamp, outcome string"
FILES = "run_id long, source string, slug string, source_id string, hash string, loaded_at timestamp, seq int, starts string"


def at(day, hour=0):
    return datetime(2025, 9, day, hour, tzinfo=UTC)


def runs(spark, *more):
    base = [(1, "a", at(1), at(1, 1), "ok"), (2, "a", at(8), at(8, 1), "failed"), (3, "a", at(15), at(15, 1), "ok"), (4, "a", at(22), at(22, 1), "ok")]
    return spark.createDataFrame([*base, *more], RUNS)


def files(spark, *rs):
    return spark.createDataFrame([(r, "a", slug, sid, h, at(day), 9, "x") for r, slug, sid, h, day in rs], FILES)


def test_changes_between_successful_runs(spark, rows):
    f = files(
        spark,
        (1, "keep", "k", "AA", 2), (1, "gone", "g", "BB", 2), (1, "old/name", " id1 ", "CC", 2), (1, "null", "n", None, 2), (1, "s1", "shared", "x", 2), (1, "s2", "shared", "x", 2),
        (2, "never", "v", "EE", 9),
        (3, "./keep.md", "k", "sha256:aa", 16), (3, "new/name", "id1", "CC", 16), (3, "null/", "n", "DD", 16), (3, "s3", "shared", "x", 16),
        (4, "keep", "k", "bb", 23), (4, "keep", "k", "aa", 22), (4, "new/name", "id1", "CC", 23), (4, "null", "n", "DD", 23), (4, "s3", "shared", "x", 23),
    )
    got = rows(snapshot_changes(f, runs(spark)), "run_id", "change_type", "slug", "old_slug")
    assert got == sorted(
        [(3, "removed", "gone", ""), (3, "renamed", "new/name", "old/name"), (3, "removed", "s1", ""), (3, "removed", "s2", ""), (3, "added", "s3", ""), (4, "changed", "keep", "")], key=repr
    )


def test_empty_run_removes_everything_and_first_run_yields_none(spark, rows):
    f = files(spark, (1, "a", "1", "h", 2), (4, "a", "1", "h", 23))
    assert rows(snapshot_changes(f, runs(spark)), "run_id", "change_type") == [(3, "removed"), (4, "added")]
    assert rows(snapshot_changes(files(spark), runs(spark))) == []


def test_nulls_repeats_and_ties(spark, rows):
    f = files(spark, (1, None, None, None, 2), (1, "p", None, "h", 2), (1, "p", None, "h", 2), (3, "p", "  ", "h", 16), (3, "q", None, "h", 16), (4, "p", None, "a", 23), (4, "p", None, "b", 23), (4, "q", "", "h", 23))
    again = runs(spark, (1, "a", at(1), at(1, 1), "ok"), (9, None, at(1), at(1), "ok"))
    assert rows(snapshot_changes(f, again), "run_id", "change_type", "slug") == [(3, "added", "q"), (4, "changed", "p")]


SNAP = "source string, slug string, title string, source_url string, source_id string, hash string"


def test_diff_pairs_by_id_then_by_title(spark, rows):
    old = spark.createDataFrame([("a", "x", "Read Me First.md", "u", "1", "h"), ("a", "y", "Install the Thing", "u", "2", "h"), ("a", "z", "Overview", "u", "3", "h"), ("a", "m", "M", "u", " ", "h1"), ("a", "d1", "Double", "u", "", "h"), ("a", "d2", "double.", "u", None, "h")], SNAP)
    new = spark.createDataFrame([("a", "x2", "Other", "v", "1", "h"), ("a", "y2", "install the thing!", "v", "22", "h"), ("a", "z2", "Overview", "v", "33", "h"), ("a", "m", "M2", "v", " ", "h2"), ("a", "d3", "DOUBLE", "v", "", "h"), ("b", "n", "New source", "v", "1", "h")], SNAP)
    got = rows(diff(old, new), "change_type", "slug", "old_slug", "title", "matched_by")
    assert ("renamed", "x2", "x", "Other", "source_id") in got
    assert ("renamed", "y2", "y", "Install the Thing", "title") in got
    assert ("modified", "m", None, "M2", None) in got
    assert {g[:2] for g in got if g[0] in ("added", "removed")} == {("added", "z2"), ("removed", "z"), ("added", "d3"), ("removed", "d1"), ("removed", "d2")}
    t = totals(diff(old, new)).first()
    assert (t.renamed, t.modified, t.total) == (2, 1, len(got))


def test_every_slug_lands_in_one_bucket(spark):
    import random

    r = random.Random(3)
    make = lambda: [("a", f"p{k}", f"title {r.randrange(20)}", "u", str(r.randrange(15)), str(r.randrange(3))) for k in r.sample(range(40), 25)]
    old, new = make(), make()
    got = diff(spark.createDataFrame(old, SNAP), spark.createDataFrame(new, SNAP)).collect()
    before, after = {x[1] for x in old}, {x[1] for x in new}
    assert sorted(g.slug for g in got if g.change_type in ("added", "renamed")) == sorted(after - before)
    assert sorted(g.old_slug or g.slug for g in got if g.change_type in ("removed", "renamed")) == sorted(before - after)


def test_last_snapshots_are_those_of_the_last_two_runs(spark, rows, monkeypatch):
    import docstrata.operators.snapshots as S

    columns = ("source_url string", "title string", "page_group string", "last_updated string")
    f = files(spark, (1, "a", "1", "h", 2), (3, "a", "1", "h", 16), (3, "./a.md", "1", "h2", 17), (3, "b", None, None, 16), (4, "b/", "2", "x", 23), (4, None, "3", "y", 23))
    f = f.selectExpr("*", *(f"cast('x' as {c.split()[1]}) as {c.split()[0]}" for c in columns))
    for listed in (1000, 0):
        monkeypatch.setattr(S, "LISTED_RUNS", listed)
        old, new = last_snapshots(f, runs(spark))
        assert rows(old) == rows(snapshot(f, runs(spark), 1)) and rows(new) == rows(snapshot(f, runs(spark)))
        assert rows(old, "slug", "hash") == [("a", "h2"), ("b", None)] and rows(new, "slug") == [("b",)]
