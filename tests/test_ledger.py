from datetime import UTC, datetime

import pytest

from docstrata.operators import ledger as L
from docstrata.operators.ledger import ChangeFeed, StaleLease, WorkLedger, due_entries


def at(day, hour=0):
    return datetime(2025, 9, day, hour, tzinfo=UTC)


RUNS = "run_id long, source string, started timestamp, completed timestamp, outcome string"
ENTRIES = "entry_id long, source string, slug string, hash string, last_updated string, arrived_at timestamp, starts string, seq int"


def runs(spark):
    return spark.createDataFrame([(1, "a", at(2), at(2, 1), "ok"), (2, "a", at(4), None, "failed"), (3, "a", at(6), at(6, 1), "ok"), (4, "b", at(6), at(6), "ok")], RUNS)


def entries(spark, *rs):
    return spark.createDataFrame([(*r, "x", 1) for r in rs], ENTRIES)


def test_leases_expire_and_tokens_fence(spark, tmp_path):
    now = [0.0]
    ledger = WorkLedger(spark, f"file://{tmp_path}/l", now=lambda: now[0])
    ledger.add(["1", "2", "3"])
    first = ledger.lease(2, seconds=10)
    assert first.items == ("1", "2") and ledger.pending() == ["3"]
    now[0] = 11
    other = WorkLedger(spark, f"file://{tmp_path}/l", now=lambda: now[0])
    second = other.lease(3, seconds=10)
    assert second.items == ("1", "2", "3") and second.token > first.token
    with pytest.raises(StaleLease):
        ledger.complete(first)
    other.complete(second)
    assert ledger.done() == ["1", "2", "3"] and ledger.lease(1, 10) is None
    with pytest.raises(StaleLease):
        other.complete(second)


def test_a_failed_attempt_leaves_nothing_twice(spark, tmp_path, rows):
    ledger = WorkLedger(spark, f"file://{tmp_path}/l")
    ledger.add(["1"])
    made = spark.createDataFrame([(1, 7), (1, 8)], "item long, v long")
    dead = ledger.lease(1, 0)  # a worker that died after writing: its lease has run out
    made.write.parquet(ledger.output(dead.token))
    lease = ledger.lease(1, 60)
    made.write.parquet(ledger.output(lease.token))  # and one that tries again within its lease
    ledger.process(lease, made)
    assert rows(ledger.read("item long, v long"), "v") == [(7,), (8,)]


def test_a_stale_worker_cannot_change_published_rows(spark, tmp_path, rows):
    now = [0.0]
    ledger = WorkLedger(spark, f"file://{tmp_path}/l", now=lambda: now[0])
    ledger.add(["1"])
    stale = ledger.lease(1, 10)
    now[0] = 11
    other = WorkLedger(spark, f"file://{tmp_path}/l", now=lambda: now[0])
    fresh = other.lease(1, 10)
    value = lambda v: spark.createDataFrame([(v,)], "v long")
    other.process(fresh, value(222))
    with pytest.raises(StaleLease):
        ledger.process(stale, value(111))
    for reader in (ledger, other, WorkLedger(spark, f"file://{tmp_path}/l")):
        assert rows(reader.read("v long")) == [(222,)] and rows(reader.merged("v long")) == [(222,)]


def test_opening_reads_the_last_state_and_what_came_after(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "STATE_EVERY", 5)
    root = f"file://{tmp_path}/l"
    ledger = WorkLedger(spark, root)
    for n in range(9):
        ledger.add([str(n)])
    lease = ledger.lease(3, 60)
    ledger.complete(lease)
    again = WorkLedger(spark, root)
    assert again._next == 10 and again.done() == ["0", "1", "2"] and again.pending() == ledger.pending() and again.published() == [1]


def test_merged_outputs_are_read_once(spark, tmp_path, rows):
    ledger = WorkLedger(spark, f"file://{tmp_path}/l")
    ledger.add(["1", "2", "3"])
    for n in range(2):
        lease = ledger.lease(1, 60)
        ledger.process(lease, spark.createDataFrame([(n,)], "v long"))
    ledger.merge(lease.token, lambda all_rows: all_rows.selectExpr("v + 10 as v"), "v long")
    ledger.process(ledger.lease(1, 60), spark.createDataFrame([(2,)], "v long"))
    assert rows(ledger.read("v long")) == [(0,), (1,), (2,)] and rows(WorkLedger(spark, f"file://{tmp_path}/l").merged("v long")) == [(10,), (11,), (2,)]


def brute(entry_rows, run_rows):
    """Run by run, over all rows."""
    out = []
    for source in {r[1] for r in run_rows}:
        before = {}
        for run in sorted((r for r in run_rows if r[1] == source and r[4] == "ok"), key=lambda r: r[2]):
            state = {}
            for e in entry_rows:
                if e[1] == source and e[3] and e[5] <= run[2]:
                    key = (e[4] or e[5], e[0])
                    if e[2] not in state or key > state[e[2]][0]:
                        state[e[2]] = (key, e[3])
            out += [(run[0], k[1]) for slug, (k, h) in state.items() if slug not in before or before[slug][1] != h]
            before = state
    return sorted(out, key=repr)


def feed_of(spark, some):
    return entries(spark, *((*e[:4], e[4].strftime("%Y-%m-%dT%H:%M:%SZ") if e[4] else "", e[5]) for e in some))


def drawn(seed, n):
    import random

    r = random.Random(seed)
    return [(k, r.choice("ab"), f"p{r.randrange(6)}", r.choice([None, "x", "y"]), r.choice([None, at(r.randrange(1, 9))]), at(r.randrange(1, 9))) for k in range(n)]


RUN_ROWS = [(1, "a", at(2), at(2), "ok"), (2, "a", at(4), None, "failed"), (3, "a", at(6), at(6), "ok"), (4, "b", at(5), at(6), "ok"), (5, "a", at(9), at(9), "ok"), (6, "b", at(7), at(7), "ok")]


@pytest.mark.parametrize("merge_every", [1, 2, 16])
def test_due_entries_equal_brute_force(spark, tmp_path, rows, monkeypatch, merge_every):
    monkeypatch.setattr(L, "MERGE_EVERY", merge_every)
    some = drawn(5 + merge_every, 80)
    got = due_entries(spark, feed_of(spark, some), spark.createDataFrame(RUN_ROWS, RUNS), f"file://{tmp_path}/l")
    assert rows(got) == brute(some, RUN_ROWS)


def test_a_later_call_reads_only_what_came_since(spark, tmp_path, rows):
    some, root = drawn(8, 120), f"file://{tmp_path}/l"
    early = [r for r in RUN_ROWS if r[2] <= at(6)]
    first = ChangeFeed(spark, root).take(feed_of(spark, [e for e in some if e[5] <= at(6)]), spark.createDataFrame(early, RUNS))
    assert first == sum(e[5] <= at(6) for e in some)
    assert rows(ChangeFeed(spark, root).due()) == brute(some, early)
    again = ChangeFeed(spark, root)
    assert again.take(feed_of(spark, some), spark.createDataFrame(early, RUNS)) == 0  # nothing is pending: nothing is read
    assert again.take(feed_of(spark, some), spark.createDataFrame(RUN_ROWS, RUNS)) == sum(e[5] > at(5) for e in some)  # b was last done on the fifth
    assert rows(again.due()) == brute(some, RUN_ROWS)


def test_work_left_by_a_dead_worker_is_done_once(spark, tmp_path, rows):
    some, root = drawn(9, 60), f"file://{tmp_path}/l"
    dead = ChangeFeed(spark, root)
    dead.ledger.add(["1", "4"])
    dead.ledger.lease(2, 0)
    got = due_entries(spark, feed_of(spark, some), spark.createDataFrame(RUN_ROWS, RUNS), root)
    assert rows(got) == brute(some, RUN_ROWS)


def test_runs_leased_by_another_are_left_to_it(spark, tmp_path, rows):
    some, root = drawn(10, 60), f"file://{tmp_path}/l"
    other = ChangeFeed(spark, root)
    other.ledger.add(["1"])
    other.ledger.lease(1, 3600)
    got = due_entries(spark, feed_of(spark, some), spark.createDataFrame(RUN_ROWS, RUNS), root)
    assert rows(got) == [x for x in brute(some, RUN_ROWS) if x[0] in (4, 6)]  # those of source a wait for its first run


def test_late_offset_spelling_and_null_rows(spark, tmp_path, rows):
    df = entries(
        spark,
        (1, "a", "p", "AA", "2025-09-01T00:00:00Z", at(1)), (2, "a", "p", "sha256:aa ", "2025-09-03 00:00:00Z", at(3)), (3, "a", "p", "bb", "2025-09-03T01:00:00+02:00", at(5)),
        (4, "a", "q", None, None, at(1)), (5, "a", "q", "x", None, at(7)), (6, None, "q", "x", None, at(1)), (7, "a", None, "x", None, at(1)), (8, "a", "r", "x", "", at(2)), (8, "a", "r", "x", "", at(2)), (9, "a", "s", "x", "", None),
    )
    assert rows(due_entries(spark, df, runs(spark), f"file://{tmp_path}/l")) == [(1, 1), (1, 8)]  # 2 has the same digest, 3 is older than 2, 5 comes after the last run
    assert rows(due_entries(spark, entries(spark), runs(spark), f"file://{tmp_path}/m")) == []


def test_empty_tables(spark, tmp_path, rows):
    none = spark.createDataFrame([], RUNS)
    assert rows(due_entries(spark, entries(spark), none, f"file://{tmp_path}/l")) == []
