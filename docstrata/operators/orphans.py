"""References to records that do not exist.

``OrphanCounts`` keeps, per key and moment of the key's clock, signed counts: how many references were found there, and how
existence changed (+1 a record appears, -1 it goes). They are maintained from change deltas: a call reads only the snapshots
of runs that are new (and the one before them) and the references that came since the last call. Running sums per key give
the existence count in force at each moment; a key with references and an existence count of zero there is an orphan:
``deleted`` if it existed before, ``late`` if it exists later, ``missing`` if it never does.

A moment is the last clock time (snapshot of a source, change of a code) at or before a reference, so what is kept per key is
bounded by the clock, however many references it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docstrata.functions.canonical import plain_slug, stripped
from docstrata.functions.search import at_or_before
from docstrata.operators.ledger import MERGE_EVERY, WorkLedger
from docstrata.operators.snapshots import LISTED_RUNS, successful_runs
from docstrata.runtime import fresh_path, heavy_join, small, staged

DIRECTORY_PAGES = ("README", "index")


def clock(times: DataFrame) -> DataFrame:
    """(domain, ticks): the sorted times of each domain, from rows (domain, at)."""
    return times.where("at is not null").groupBy("domain").agg(F.sort_array(F.collect_set("at")).alias("ticks"))


#: Before all times of a clock.
NEVER = "0001-01-01T00:00:00Z"


def slotted(rows: DataFrame, ticks: DataFrame, at: str) -> DataFrame:
    """Adds slot: the last tick of the row's domain at or before its time, NEVER where there is none."""
    joined = rows.join(small(ticks), "domain", "left")
    upto = at_or_before(F.col("ticks"), F.col(at))
    return joined.withColumn("slot", F.coalesce(F.when(upto > 0, F.get("ticks", upto - 1)), F.lit(NEVER).cast("timestamp"))).drop("ticks")


def orphan_slots(counts: DataFrame) -> DataFrame:
    """(domain, key, slot, refs, kind) of the orphans, from counts (domain, key, slot, refs, delta)."""
    merged = _summed(counts)
    by_key = Window.partitionBy("domain", "key")
    upto = by_key.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    counted = merged.select("domain", "key", "slot", "refs", F.sum("delta").over(upto).alias("existing"), F.max(F.when(F.col("delta") > 0, F.col("slot"))).over(by_key).alias("last_start"), F.min(F.when(F.col("delta") > 0, F.col("slot"))).over(by_key).alias("first_start"))
    kind = F.when(F.col("first_start") <= F.col("slot"), "deleted").when(F.col("last_start") > F.col("slot"), "late").otherwise("missing")
    return counted.where("refs > 0 and existing <= 0").select("domain", "key", "slot", "refs", kind.alias("kind"))


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("domain", "key", "slot").agg(F.sum("refs").alias("refs"), F.sum("delta").alias("delta")).select("domain", "key", "slot", "refs", "delta")


def page_deltas(files: DataFrame, ok: DataFrame) -> DataFrame:
    """(domain, key, at, delta): pages of a source appearing in and leaving its snapshots, at the runs that are not known yet.

    ok (run_id, source, seq, last_seq, completed, known_seq) numbers the successful runs; of those up to known_seq only the
    last is read, as what the next is compared with. A page README or index also counts for the directory that holds it,
    whose key ends in a slash.
    """
    wanted = ok.where("seq >= known_seq")
    numbers = [r[0] for r in wanted.select("run_id").limit(LISTED_RUNS + 1).collect()]
    files = files.select("run_id", plain_slug(F.col("slug")).alias("key")).where("key is not null")
    if len(numbers) <= LISTED_RUNS:
        files = files.where(F.col("run_id").isin(numbers))  # reaches the scan
    rows = files.join(small(wanted.select("run_id", "source", "seq", "last_seq")), "run_id")
    pages = rows.repartition("source", "key").select(F.col("source").alias("domain"), "key", "seq", "last_seq").distinct()
    of_page = Window.partitionBy("domain", "key").orderBy("seq")
    appears = ~F.lag("seq").over(of_page).eqNullSafe(F.col("seq") - 1)
    goes = (F.col("seq") < F.col("last_seq")) & ~F.lead("seq").over(of_page).eqNullSafe(F.col("seq") + 1)
    moves = F.array(F.when(appears, F.struct(F.col("seq"), F.lit(1).alias("delta"))), F.when(goes, F.struct((F.col("seq") + 1).alias("seq"), F.lit(-1).alias("delta"))))
    changes = pages.withColumn("moves", F.array_compact(moves)).where(F.size("moves") > 0)
    last = F.element_at(F.split("key", "/"), -1)
    keys = F.when(last.isin(*DIRECTORY_PAGES), F.array(F.col("key"), F.expr("substring(key, 1, length(key) - length(element_at(split(key, '/'), -1)))"))).otherwise(F.array("key"))
    deltas = changes.select("domain", F.explode(keys).alias("key"), "moves").select("domain", F.when(F.col("key") == "", "/").otherwise(F.col("key")).alias("key"), F.inline("moves"))
    return deltas.join(small(ok.where("seq > known_seq").select(F.col("source").alias("domain"), "seq", F.col("completed").alias("at"))), ["domain", "seq"]).drop("seq")


def _resolved(path: Column) -> Column:
    """Path segments with '.', '..' and empty ones resolved; null where '..' leads above the root."""
    steps = F.split(path, "/")
    up = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda acc, s: F.when(acc.isNull(), acc).when(s.isin("", "."), acc).when(s != "..", F.concat(acc, F.array(s))).when(F.size(acc) == 0, F.lit(None)).otherwise(F.slice(acc, 1, F.size(acc) - 1)),
    )
    return up


def _page_key(path: Column) -> Column:
    """struct(domain, key) named by a path of the mirror; outside of it both are the path itself."""
    steps = _resolved(path)
    steps = F.when(F.get(steps, F.lit(0)) == "docs", F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(0)))).otherwise(steps)
    slug = F.array_join(F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(0))), "/")
    directory = path.rlike(r"/\z")
    key = F.when(directory, F.concat(slug, F.lit("/"))).when(slug.rlike(r"\.md\z"), F.regexp_replace(slug, r"\.md\z", "")).otherwise(F.concat(F.lit("?"), slug))
    inside = F.size(steps) >= F.when(directory, 1).otherwise(2)
    return F.when(inside, F.struct(F.get(steps, F.lit(0)).alias("domain"), key.alias("key"))).otherwise(F.struct(F.lit("?").alias("domain"), path.alias("key")))


def _unescaped(c: Column) -> Column:
    """Percent-decoded as a URL path: '+' stays, and a broken escape leaves the text as it is."""
    return F.when(c.contains("%"), F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)).otherwise(c)


def link_references(issues: DataFrame, sources: DataFrame) -> DataFrame:
    """(issue_id, field, domain, key, at): the references of link issues.

    file names the page ``source/slug.md``, also below ``docs/``. target is read as a URL path relative to the file's
    directory. reason names a code. Left out, being no references: null and blank values, targets of rows without file,
    and targets that are an anchor or query, have a scheme, start with '/', or are illustrative for the row's source.
    """
    file = F.nullif(stripped(F.col("file")), F.lit(""))
    raw = F.regexp_replace(stripped(F.col("target")), r"^<(.*)>\z", "$1")
    written = F.regexp_replace(raw, r"(?s)[?#].*\z", "")
    exempt = small(sources.groupBy("source").agg(F.flatten(F.collect_set("illustrative_link_targets")).alias("illustrative_link_targets")))
    rows = issues.select("issue_id", "source", "reason", F.col("checked_at").alias("at"), file.alias("file"), raw.alias("raw"), written.alias("written")).join(exempt, "source", "left")
    is_target = F.col("file").isNotNull() & (F.col("written") != "") & ~F.col("raw").rlike(r"^(?:/|[A-Za-z][A-Za-z0-9+.-]*:)") & ~F.coalesce(F.array_contains("illustrative_link_targets", F.col("written")), F.lit(False))
    base = F.regexp_replace(F.regexp_replace(F.col("file"), r"[^/]*\z", ""), r"^(?:\./)*docs/", "")
    file_key = _page_key(F.regexp_replace(F.col("file"), r"^(?:\./)+", ""))
    target_key = _page_key(F.concat(base, _unescaped(F.col("written"))))
    code = F.lower(stripped(F.col("reason")))
    wanted = F.array_compact(F.array(
        F.when(F.col("file").isNotNull(), F.struct(F.lit("file").alias("field"), file_key.alias("k"))),
        F.when(is_target, F.struct(F.lit("target").alias("field"), target_key.alias("k"))),
        F.when(code != "", F.struct(F.lit("reason").alias("field"), F.struct(F.lit(" reason").alias("domain"), code.alias("key")).alias("k"))),
    ))
    return rows.select("issue_id", "at", F.explode(wanted).alias("w")).select("issue_id", "w.field", "w.k.domain", "w.k.key", "at")


def reason_deltas(reasons: DataFrame) -> DataFrame:
    """(domain, key, at, delta): codes coming into use and being retired. A code without active_from has always been."""
    key = F.lower(stripped(F.col("reason")))
    began = F.coalesce(F.col("active_from"), F.lit("0001-01-01T00:00:00Z").cast("timestamp"))
    moves = F.array(F.struct(began.alias("at"), F.lit(1).alias("delta")), F.struct(F.col("retired_at").alias("at"), F.lit(-1).alias("delta")))
    return reasons.where(F.col("reason").isNotNull()).select(F.lit(" reason").alias("domain"), key.alias("key"), F.inline(moves)).where("at is not null")


COUNTS = "domain string, key string, slot timestamp, refs long, delta long"
REFERENCES = "issue_id long, field string, domain string, key string, at timestamp, slot timestamp"


class OrphanCounts:
    """Counts and references below a root folder, kept from call to call; take() brings in what is new.

    Runs must be known before the references that are checked after them, and both only grow at the end: a run by
    completed, a reference by checked_at. Rows with a null checked_at are no references. Codes are few and read each time.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.ledger = spark, WorkLedger(spark, root)

    def take(self, issues: DataFrame, files: DataFrame, runs: DataFrame, sources: DataFrame, reasons: DataFrame, lease_seconds: float = 3600) -> dict[str, int]:
        """Brings in new runs and references as one lease. {"runs", "references"}: how many it took."""
        ok = successful_runs(runs, "completed").where("completed is not null")
        listed = ok.select("run_id", "source", "seq").collect()  # runs, not records
        done = set(self.ledger.done())
        known = {}
        for r in listed:
            if f"run {r.run_id}" in done:
                known[r.source] = max(known.get(r.source, 0), r.seq)
        new_runs = [f"run {r.run_id}" for r in listed if f"run {r.run_id}" not in done]
        mark = max((i.removeprefix("references up to ") for i in done if i.startswith("references")), default=None)
        fresh = issues if mark is None else issues.where(F.col("checked_at") > F.lit(mark).cast("timestamp"))  # reaches the scan
        last = fresh.agg(F.date_format(F.max("checked_at"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")).first()[0]
        items = new_runs + ([f"references up to {last}"] if last else [])
        self.ledger.add(items)
        wanted = set(items)
        lease = self.ledger.lease(len(items), lease_seconds, wanted.__contains__) if items else None
        if lease is None or set(lease.items) != wanted:
            return {"runs": 0, "references": 0}  # all is done, or another has a part of it
        ok = staged(ok.join(small(self.spark.createDataFrame(list(known.items()), "source string, known_seq int")), "source", "left").withColumn("known_seq", F.coalesce("known_seq", F.lit(0))), "runs")
        codes = reason_deltas(reasons)
        moments = ok.select(F.col("source").alias("domain"), F.col("completed").alias("at")).unionByName(codes.select("domain", "at"))
        refs = link_references(fresh.where("checked_at is not null"), sources)
        where = self.ledger.output(lease.token, "references")
        slotted(refs, clock(moments), "at").select(*(c.split()[0] for c in REFERENCES.split(", "))).write.mode("overwrite").parquet(where)
        refs = self.spark.read.schema(REFERENCES).parquet(where)
        counts = refs.groupBy("domain", "key", "slot").agg(F.count("*").alias("refs")).withColumn("delta", F.lit(0).cast("long"))
        moved = page_deltas(files, ok).select("domain", "key", F.col("at").alias("slot"), F.lit(0).cast("long").alias("refs"), F.col("delta").cast("long").alias("delta"))
        self.ledger.process(lease, counts.unionByName(moved))
        if len(set(self.ledger.published()) - self.ledger._covered) >= MERGE_EVERY:
            self.ledger.merge(lease.token, _summed, COUNTS)
        return {"runs": len(new_runs), "references": refs.count()}

    def orphans(self, reasons: DataFrame) -> DataFrame:
        """(issue_id, field, kind, at) of the references taken so far whose record did not exist then, by what is known now."""
        codes = reason_deltas(reasons).select("domain", "key", F.col("at").alias("slot"), F.lit(0).cast("long").alias("refs"), F.col("delta").cast("long").alias("delta"))
        found = staged(orphan_slots(self.ledger.merged(COUNTS).unionByName(codes)), "orphans")
        return heavy_join(self.ledger.read(REFERENCES, "references"), found, ["domain", "key", "slot"], "refs").select("issue_id", "field", "kind", "at")


def orphan_links(issues: DataFrame, files: DataFrame, runs: DataFrame, sources: DataFrame, reasons: DataFrame, root: str | None = None) -> DataFrame:
    """(issue_id, field, kind, at): references of link issues whose page or code does not exist when they were checked.

    root is where the counts are kept; without one they are made from all rows in a folder of this session.
    """
    counts = OrphanCounts(issues.sparkSession, root or fresh_path(issues.sparkSession, "orphan-counts"))
    counts.take(issues, files, runs, sources, reasons)
    return counts.orphans(reasons)


def orphan_report(orphans: DataFrame) -> DataFrame:
    """(week, field, kind, orphans): counts per referring field, kind and week (Monday, UTC)."""
    return orphans.groupBy(F.date_format(F.date_trunc("week", "at"), "yyyy-MM-dd").alias("week"), "field", "kind").agg(F.count("*").alias("orphans"))
