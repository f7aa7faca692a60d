"""Processing only new or changed records.

``WorkLedger`` is the record of work items: pending, leased, done. Every transition is one numbered file of an append-only
log, created exclusively, so of two writers one loses and reads again; now and then the whole state is written beside it, so
that opening reads the last state and what came after. Leases carry an expiry, after which the item is pending again, and a
fencing token. A lease writes to a folder of its token, whatever is tried again within it, and only the tokens of
completed leases are ever read: a worker whose lease ran out can write what it likes.

``ChangeFeed`` is the processing of a feed of entries by successful runs. Its work items are the runs. It keeps the standing
entry of each page as the lease outputs themselves, merged from time to time, and reads of the feed only what arrived
since the source's last done run.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docstrata.functions.canonical import digest, instant
from docstrata.operators.snapshots import LISTED_RUNS, successful_runs
from docstrata.runtime import filesystem, small, staged

PENDING, LEASED, DONE = "pending", "leased", "done"
#: Transitions between two written states, and leases between two merges of their outputs.
STATE_EVERY, MERGE_EVERY = 100, 16


class StaleLease(RuntimeError):
    """The item has been leased again, or is done, since this lease was given."""


@dataclass(frozen=True)
class Lease:
    token: int
    items: tuple[str, ...]


@dataclass
class _Item:
    state: str = PENDING
    token: int = 0
    until: float = 0.0


@dataclass
class WorkLedger:
    """A ledger of work items below root. The driver holds one entry per item, never per record."""

    spark: SparkSession
    root: str
    now: Callable[[], float] = time.time
    _items: dict[str, _Item] = field(default_factory=dict)
    _token: int = 0
    _next: int = 0
    _merged: int = 0  # the token whose merge holds all outputs before it, 0 for none
    _covered: frozenset[int] = frozenset()

    def __post_init__(self) -> None:
        self.root = self.root.rstrip("/")
        fs, at = filesystem(self.spark, f"{self.root}/states")
        numbers = [int(s.getPath().getName().removesuffix(".json")) for s in fs.listStatus(at)] if fs.exists(at) else []
        if numbers:
            kept = json.loads(self._text(f"{self.root}/states/{max(numbers):012d}.json"))
            self._items = {i: _Item(*x) for i, x in kept["items"].items()}
            self._token, self._next, self._merged, self._covered = kept["token"], max(numbers), kept["merged"], frozenset(kept["covered"])

    def _text(self, path: str) -> str:
        fs, at = filesystem(self.spark, path)
        stream = fs.open(at)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _log(self, n: int) -> str:
        return f"{self.root}/log/{n:012d}.json"

    def refresh(self) -> None:
        """Applies the log entries that were added since the last call."""
        while True:
            path = self._log(self._next)
            fs, at = filesystem(self.spark, path)
            if not fs.exists(at):
                return
            self._apply(json.loads(self._text(path)))
            self._next += 1

    def _apply(self, e: dict) -> None:
        if e["do"] == "add":
            for i in e["items"]:
                self._items.setdefault(i, _Item())
        elif e["do"] == "lease":
            self._token = e["token"]
            for i in e["items"]:
                self._items[i] = _Item(LEASED, e["token"], e["until"])
        elif e["do"] == "done":
            for i in e["items"]:
                self._items[i].state = DONE
        elif e["do"] == "merge":
            self._merged, self._covered = e["token"], frozenset(e["covers"])

    def _write_new(self, path: str, content: dict) -> bool:
        """Whole files appear at once, and never over another: False where there is one."""
        _, at = filesystem(self.spark, path)
        fs, tmp = filesystem(self.spark, f"{self.root}/tmp/{at.getName()}-{time.time_ns()}")
        out = fs.create(tmp, True)
        out.write(bytearray((json.dumps(content) + "\n").encode()))
        out.close()
        fs.mkdirs(at.getParent())
        gateway, hadoop = self.spark.sparkContext._gateway, self.spark.sparkContext._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(at.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(tmp, at, gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e.java_exception):
                raise
            fs.delete(tmp, False)
            return False

    def _append(self, entry: Callable[[], dict | None]) -> dict | None:
        """Writes what entry() says of the present state; where another writer was first, says it again."""
        while True:
            self.refresh()
            if (e := entry()) is None:
                return None
            n = self._next
            if self._write_new(self._log(n), e):
                self.refresh()
                if n % STATE_EVERY == STATE_EVERY - 1:
                    state = {"items": {i: [x.state, x.token, x.until] for i, x in self._items.items()}, "token": self._token, "merged": self._merged, "covered": sorted(self._covered)}
                    if self._next == n + 1:  # else another writer is further on, and this state has no number
                        self._write_new(f"{self.root}/states/{self._next:012d}.json", state)
                return e

    def add(self, items: Iterable[str]) -> None:
        wanted = list(dict.fromkeys(items))
        self._append(lambda: {"do": "add", "items": new} if (new := [i for i in wanted if i not in self._items]) else None)

    def state(self, item: str) -> str:
        """An expired lease counts as pending."""
        i = self._items[item]
        return PENDING if i.state == LEASED and i.until <= self.now() else i.state

    def pending(self) -> list[str]:
        self.refresh()
        return [i for i in self._items if self.state(i) == PENDING]

    def done(self) -> list[str]:
        self.refresh()
        return [i for i in self._items if self.state(i) == DONE]

    def published(self) -> list[int]:
        """The tokens of completed leases."""
        self.refresh()
        return sorted({x.token for x in self._items.values() if x.state == DONE})

    def lease(self, most: int, seconds: float, ready: Callable[[str], bool] = lambda _: True) -> Lease | None:
        """The first pending items that are ready, up to most, under a new token; None if there are none."""
        def entry() -> dict | None:
            some = [i for i in self._items if self.state(i) == PENDING and ready(i)][:most]
            return {"do": "lease", "items": some, "token": self._token + 1, "until": self.now() + seconds} if some else None

        e = self._append(entry)
        return Lease(e["token"], tuple(e["items"])) if e else None

    def complete(self, lease: Lease) -> None:
        """All items of the lease become done, or StaleLease is raised and none does."""
        def entry() -> dict:
            for i in lease.items:
                if self._items[i].state != LEASED or self._items[i].token != lease.token:
                    raise StaleLease(f"{i}: token {lease.token} is not in force")
            return {"do": "done", "items": list(lease.items)}

        self._append(entry)

    def output(self, token: int, name: str = "data") -> str:
        """Where a lease writes the output of that name."""
        return f"{self.root}/{name}/token={token}"

    def process(self, lease: Lease, rows: DataFrame) -> None:
        """Writes the rows under the lease's token and publishes them by completing it. Trying again within the lease replaces them."""
        rows.write.mode("overwrite").parquet(self.output(lease.token))
        self.complete(lease)

    def read(self, schema: str, name: str = "data") -> DataFrame:
        """All published rows of an output."""
        paths = [self.output(t, name) for t in self.published()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def merged(self, schema: str) -> DataFrame:
        """All published rows, those before the last merge in their merged form."""
        paths = [self.output(t) for t in self.published() if t not in self._covered] + ([self.output(self._merged, "merged")] if self._merged else [])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def merge(self, token: int, fold: Callable[[DataFrame], DataFrame], schema: str) -> None:
        """Writes the fold of all published rows under the token of the caller's completed lease; merged() reads it from then on."""
        covers = self.published()
        fold(self.merged(schema)).write.mode("overwrite").parquet(self.output(token, "merged"))
        self._append(lambda: {"do": "merge", "token": token, "covers": covers} if set(covers) >= self._covered else None)


STANDING = "run_id long, source string, slug string, updated timestamp, entry_id long, digest binary, is_due boolean"


def _newest(rows: DataFrame) -> DataFrame:
    best = F.max(F.struct("updated", "entry_id", "digest", "run_id", "is_due"))
    return rows.groupBy("source", "slug").agg(best.alias("b")).select("b.run_id", "source", "slug", "b.updated", "b.entry_id", "b.digest", "b.is_due")


class ChangeFeed:
    """What each successful run of a source takes from a feed of entries: (run_id, entry_id) of the new and changed ones.

    At a run the standing entry of a page is, of its rows with a hash that had arrived when the run started, the one
    updated last (then the largest entry_id). It is due when the page had none at the previous successful run, or one
    with another digest. Rows with null source, slug, hash or arrived_at are never due; repeated rows count once; a run
    without a start takes nothing. The feed is append-only by arrived_at.
    """

    def __init__(self, spark: SparkSession, root: str, lease_seconds: float = 3600) -> None:
        self.spark, self.ledger, self.seconds = spark, WorkLedger(spark, root), lease_seconds

    def intake(self, entries: DataFrame, backlog: DataFrame) -> DataFrame:
        """(wave, run_id, source, slug, updated, entry_id, digest): per run of the backlog the newest row of each page that arrived for it.

        backlog has (source, after, runs): the start of the last done run, and the (started, run_id) still to do in order.
        """
        rows = entries.select("entry_id", "source", "slug", "hash", "last_updated", "arrived_at").where(F.col("arrived_at").isNotNull() & F.col("slug").isNotNull() & F.col("hash").isNotNull())
        numbered = F.transform("runs", lambda r, n: F.struct(r["run_id"].alias("run_id"), r["started"].alias("started"), (n + 1).alias("wave")))
        first = F.get(F.filter(numbered, lambda r: r["started"] >= F.col("arrived_at")), F.lit(0))
        known = rows.join(small(backlog), "source").where(F.col("after").isNull() | (F.col("arrived_at") > F.col("after")))
        updated = F.coalesce(instant(F.col("last_updated")), F.col("arrived_at"))
        taken = known.select("source", "slug", "entry_id", digest(F.col("hash")).alias("digest"), updated.alias("updated"), first.alias("run")).where("run is not null and digest is not null")
        best = F.max(F.struct("updated", "entry_id", "digest"))
        return taken.groupBy("source", "slug", F.col("run.wave").alias("wave"), F.col("run.run_id").alias("run_id")).agg(best.alias("b")).select("wave", "run_id", "source", "slug", "b.updated", "b.entry_id", "b.digest")

    def take(self, entries: DataFrame, runs: DataFrame) -> int:
        """Processes all runs that are not done, each source's next one at a time. The number of feed rows read is returned."""
        ok = successful_runs(runs).where("started is not null").orderBy("started", "run_id").select("run_id", "source", "started").collect()  # runs, not records
        ledger, chains = self.ledger, {}
        for r in ok:
            chains.setdefault(r.source, []).append(r)
        ledger.add(str(r.run_id) for r in ok)
        done = set(ledger.done())
        before = {str(b.run_id): str(a.run_id) for chain in chains.values() for a, b in zip(chain, chain[1:], strict=False)}
        backlog = [(s, max((r.started for r in chain if str(r.run_id) in done), default=None), [(r.started, r.run_id) for r in chain if str(r.run_id) not in done]) for s, chain in chains.items()]
        backlog = [b for b in backlog if b[2]]
        if not backlog:
            return 0
        since = None if any(b[1] is None for b in backlog) else min(b[1] for b in backlog)
        table = self.spark.createDataFrame(backlog, "source string, after timestamp, runs array<struct<started: timestamp, run_id: long>>")
        seen = Observation()
        feed = entries if since is None else entries.where(F.col("arrived_at") > F.lit(since))  # reaches the scan
        batches = staged(self.intake(feed.observe(seen, F.count(F.lit(1)).alias("rows")), table), "intake", partition_by="wave")
        waves = {str(r[1]): n for _, _, todo in backlog for n, r in enumerate(todo, 1)}
        ready = lambda i: i in waves and (i not in before or ledger.state(before[i]) == DONE)
        while lease := ledger.lease(len(waves), self.seconds, ready):
            mine = batches.where(F.col("wave").isin(sorted({waves[i] for i in lease.items})))
            leased = [int(i) for i in lease.items]
            mine = mine.where(F.col("run_id").isin(leased)) if len(leased) <= LISTED_RUNS else mine.join(small(self.spark.createDataFrame([(i,) for i in leased], "run_id long")), "run_id")
            ledger.process(lease, self.changed(mine))
            if len(set(ledger.published()) - ledger._covered) >= MERGE_EVERY:
                ledger.merge(lease.token, _newest, STANDING)
        return seen.get["rows"]

    def changed(self, batch: DataFrame) -> DataFrame:
        """The rows of a batch that become the standing entry of their page, is_due where the digest is another. Of the standing table only the pages of the batch take part."""
        standing = self.ledger.merged(STANDING)
        if self.ledger.published():
            standing = standing.join(small(batch.select("source", "slug")), ["source", "slug"], "left_semi")
        entry = F.struct("updated", "entry_id", "digest")
        both = batch.select("source", "slug", "run_id", entry.alias("new"), F.lit(None).cast("struct<updated: timestamp, entry_id: long, digest: binary>").alias("old"))
        both = both.unionByName(standing.select("source", "slug", F.lit(None).cast("long").alias("run_id"), F.lit(None).cast("struct<updated: timestamp, entry_id: long, digest: binary>").alias("new"), entry.alias("old")))
        merged = both.groupBy("source", "slug").agg(F.max("run_id").alias("run_id"), F.max("new").alias("new"), F.max("old").alias("old"))
        ahead = merged.where("new is not null and (old is null or new > old)")
        return ahead.select("run_id", "source", "slug", "new.updated", "new.entry_id", "new.digest", (F.col("old").isNull() | (F.col("old.digest") != F.col("new.digest"))).alias("is_due"))

    def due(self) -> DataFrame:
        """(run_id, entry_id) of all done runs."""
        return self.ledger.read(STANDING).where("is_due").select("run_id", "entry_id")


def due_entries(spark: SparkSession, entries: DataFrame, runs: DataFrame, root: str) -> DataFrame:
    """Takes what is new for the runs that the ledger below root has not done; (run_id, entry_id) of these and the runs done before."""
    feed = ChangeFeed(spark, root)
    feed.take(entries, runs)
    return feed.due()
