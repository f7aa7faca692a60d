"""Snapshots kept up to date by a stream of fetched entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docstrata.runtime import filesystem, staged


class MissingVersion(RuntimeError):
    """A version that others are built on is lost or unfinished."""


class SnapshotUpdater:
    """Folds batches of entries (source, slug, hash, updated, ...) into a table of the newest entry per page.

    Pages are in buckets by their hash. Batch n writes version=<n + 1> with the buckets that it touches, from the last
    state of these, so a batch that is run again after a failure writes the same version again. The table is the last
    state of every bucket. A version counts once its _SUCCESS file is there; versions number from 1 without a gap.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, order: tuple[str, ...] = ("updated", "hash"), buckets: int = 64) -> None:
        self.spark, self.path, self.schema, self.order, self.buckets = spark, path.rstrip("/"), schema, order, buckets

    def versions(self) -> list[int]:
        fs, root = filesystem(self.spark, self.path)
        found = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(v for v in found if fs.exists(filesystem(self.spark, f"{self.path}/version={v}/_SUCCESS")[1]))

    def _paths(self, version: int, touched: set[int] | None = None) -> list[str]:
        """Where the last states of the buckets (or of those touched) are, up to a version."""
        there = self.versions()
        if missing := sorted(set(range(1, version + 1)) - set(there)):
            raise MissingVersion(f"{self.path}: version {missing[0]}")
        last: dict[int, str] = {}
        for v in range(1, version + 1):
            fs, at = filesystem(self.spark, f"{self.path}/version={v}")
            for s in fs.listStatus(at):
                name = s.getPath().getName()
                if name.startswith("bucket=") and (touched is None or int(name[7:]) in touched):
                    last[int(name[7:])] = f"{self.path}/version={v}/{name}"
        return [last[b] for b in sorted(last)]

    def at(self, version: int, touched: set[int] | None = None) -> DataFrame:
        paths = self._paths(version, touched)
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def fold(self, batch: DataFrame, batch_id: int) -> None:
        columns = [f.name for f in self.at(0).schema]
        bucket = F.pmod(F.xxhash64("source", "slug"), F.lit(self.buckets)).cast("int")
        rows = staged(batch.select(*columns), "batch")
        touched = {r[0] for r in rows.select(bucket.alias("b")).distinct().collect()}  # at most as many as there are buckets
        key = F.struct(*self.order, *[c for c in columns if c not in self.order])
        newest = self.at(batch_id, touched).unionByName(rows).groupBy("source", "slug").agg(F.max(key).alias("e"))
        whole = newest.select("source", "slug", *(F.col(f"e.{c}").alias(c) for c in columns if c not in ("source", "slug")))
        whole.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/version={batch_id + 1}")

    def run(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self.fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def latest(self) -> DataFrame:
        return self.at(max(self.versions(), default=0))


def admitted(reader, files: int = 100):
    """Admission control for a file stream, in place of spacing requests."""
    return reader.option("maxFilesPerTrigger", files)


def late_counts(events: DataFrame, at: str, delay: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """(window_start, event_type, events): tumbling counts; events later than the delay behind the newest are left out."""
    by = events.withWatermark(at, delay).groupBy(F.window(at, width), "event_type")
    return by.agg(F.count("*").alias("events")).select(F.col("window.start").alias("window_start"), "event_type", "events")
