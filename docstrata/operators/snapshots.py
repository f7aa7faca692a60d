"""What changed between consecutive full snapshots.

The snapshot of a run is the set of its rows; consecutive snapshots of a source are full-outer-joined on the plain
slug and compared by digest. The join of every snapshot with the next is done at once: the rows of a page are brought
together once, in the order of their runs, and each meets its neighbour there or finds that side missing. Rows on one side
only are paired as renames where they share an identity that no other one-sided row of that side has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docstrata.functions.canonical import digest, plain_slug, stripped
from docstrata.runtime import small, staged


def successful_runs(runs: DataFrame, by: str = "started") -> DataFrame:
    """(run_id, source, seq, last_seq, started, completed) of the runs with outcome ok, numbered from 1 by the given time. Repeated rows of a run count once."""
    order = Window.partitionBy("source").orderBy(F.col(by).asc_nulls_last(), "run_id")
    ok = runs.where((F.col("outcome") == "ok") & F.col("source").isNotNull() & F.col("run_id").isNotNull()).groupBy("run_id").agg(F.max(F.struct("source", "started", "completed")).alias("r")).select("run_id", "r.*")
    return ok.select(
        "run_id", "source", "started", "completed", F.row_number().over(order).alias("seq"),
        F.count("*").over(Window.partitionBy("source")).alias("last_seq"),
    )


def snapshots(files: DataFrame, runs: DataFrame) -> DataFrame:
    """(source, seq, last_seq, slug, digest, source_id): one row per page of each successful run's snapshot.

    Of rows with one plain slug the one loaded last counts; a null loaded_at comes before all others, and equal times
    are settled by the larger digest and source_id. Blank source_ids are null; rows with a null slug are no pages.
    """
    files = files.select("run_id", "slug", "loaded_at", "hash", "source_id")
    rows = files.join(small(successful_runs(runs).drop("started", "completed")), "run_id").where(F.col("slug").isNotNull())
    rows = rows.select("source", "seq", "last_seq", plain_slug(F.col("slug")).alias("slug"), "loaded_at", digest(F.col("hash")).alias("digest"), F.nullif(stripped(F.col("source_id")), F.lit("")).alias("source_id"))
    best = F.max(F.struct("loaded_at", "digest", "source_id", "last_seq")).alias("b")
    # by page, so that what follows finds all runs of a page in one place; few rows repeat, so there is nothing to combine before
    return rows.repartition("source", "slug").groupBy("source", "slug", "seq").agg(best).select("source", "seq", "b.last_seq", "slug", "b.digest", "b.source_id")


def snapshot_changes(files: DataFrame, runs: DataFrame) -> DataFrame:
    """(source, run_id, change_type, slug, old_slug) from each successful run's predecessor to it.

    change_type is added, removed, changed or renamed; old_slug is '' except for renamed. A page whose digest is null
    on either side is not changed. The first run of a source gives none; an empty run removes everything.
    """
    pages = snapshots(files, runs)
    of_page = Window.partitionBy("source", "slug").orderBy("seq")
    sides = pages.withColumn("before", F.lag(F.struct("seq", "digest")).over(of_page)).withColumn("next", F.lead("seq").over(of_page))
    in_old = F.col("before.seq").eqNullSafe(F.col("seq") - 1)
    came = F.when(F.col("seq") > 1, F.when(~in_old, "added").when(F.col("digest") != F.col("before.digest"), "changed"))
    went = F.when((F.col("seq") < F.col("last_seq")) & ~F.col("next").eqNullSafe(F.col("seq") + 1), "removed")
    events = F.array(F.struct(F.col("seq"), came.alias("change_type")), F.struct((F.col("seq") + 1).alias("seq"), went.alias("change_type")))
    diff = sides.select("source", "slug", "source_id", F.inline(events)).where("change_type is not null").select("source", "seq", "slug", "change_type", "source_id")
    diff = staged(diff, "snapshot-diff")

    sides = diff.where("change_type <> 'changed' and source_id is not null").groupBy("source", "seq", "source_id")
    is_new = F.col("change_type") == "added"
    pairs = sides.agg(F.count_if(is_new).alias("n_new"), F.count_if(~is_new).alias("n_old"), F.max(F.when(is_new, F.col("slug"))).alias("slug"), F.max(F.when(~is_new, F.col("slug"))).alias("old_slug"))
    pairs = staged(pairs.where("n_new = 1 and n_old = 1").select("source", "seq", "slug", "old_slug"), "renames")
    taken = pairs.select("source", "seq", F.explode(F.array(F.struct("slug", F.lit("added").alias("change_type")), F.struct(F.col("old_slug").alias("slug"), F.lit("removed").alias("change_type")))).alias("t")).select("source", "seq", "t.*")
    rest = diff.join(taken, ["source", "seq", "slug", "change_type"], "left_anti").select("source", "seq", "change_type", "slug", F.lit("").alias("old_slug"))
    changes = rest.unionByName(pairs.select("source", "seq", F.lit("renamed").alias("change_type"), "slug", "old_slug"))
    return changes.join(small(successful_runs(runs).select("source", "seq", "run_id")), ["source", "seq"]).select("source", "run_id", "change_type", "slug", "old_slug")


_SNAPSHOT = ("title", "page_group", "source_url", "source_id", "hash", "last_updated")
#: Run numbers up to which a filter on them is written into the scan.
LISTED_RUNS = 1000


def _entry(files: DataFrame):
    """The struct by which the row of a page that counts is the largest."""
    hashed = F.lower(F.regexp_replace(F.lower(stripped(F.col("hash"))), r"^[a-z][a-z0-9_/-]*\s*[:=]\s*", ""))
    return F.struct("loaded_at", F.nullif(hashed, F.lit("")).alias("hash"), F.nullif(stripped(F.col("source_id")), F.lit("")).alias("source_id"), "title", "page_group", "source_url", "last_updated")


def last_snapshots(files: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the snapshot before, the snapshot) of each source's last two successful runs, as snapshot() gives them, from one scan and one exchange."""
    wanted = successful_runs(runs).where("seq >= last_seq - 1").select("run_id", F.col("source"), (F.col("seq") == F.col("last_seq")).alias("is_new"))
    numbers = [r[0] for r in wanted.select("run_id").limit(LISTED_RUNS + 1).collect()]
    files = files.select("run_id", "slug", "title", "page_group", "source_url", "source_id", "hash", "last_updated", "loaded_at")
    if len(numbers) <= LISTED_RUNS:
        files = files.where(F.col("run_id").isin(numbers))
    rows = files.join(small(wanted), "run_id").where("slug is not null").withColumn("e", _entry(files))
    side = lambda new: F.max(F.when(F.col("is_new") if new else ~F.col("is_new"), F.col("e")))
    both = staged(rows.groupBy("source", plain_slug(F.col("slug")).alias("slug")).agg(side(False).alias("old"), side(True).alias("new")), "last-snapshots")
    return tuple(both.where(F.col(s).isNotNull()).select("source", "slug", *(F.col(f"{s}.{c}").alias(c) for c in _SNAPSHOT)) for s in ("old", "new"))


def snapshot(files: DataFrame, runs: DataFrame, back: int = 0) -> DataFrame:
    """(source, slug, title, page_group, source_url, source_id, hash, last_updated): the snapshot of the last successful run of each source, or of one further back.

    hash is the digest as hexadecimal text. Ties are settled as in snapshots(), then by the other columns.
    """
    run = successful_runs(runs).where(F.col("seq") == F.col("last_seq") - back).select("run_id", "source")
    files = files.select("run_id", "slug", "title", "page_group", "source_url", "source_id", "hash", "last_updated", "loaded_at")
    rows = files.join(small(run), "run_id").where("slug is not null")
    return rows.groupBy("source", plain_slug(F.col("slug")).alias("slug")).agg(F.max(_entry(files)).alias("b")).select("source", "slug", *(F.col(f"b.{c}").alias(c) for c in _SNAPSHOT))
