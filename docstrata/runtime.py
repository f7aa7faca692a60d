"""Session helpers: table reading, staging in the shared folder, size-checked broadcast."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side may be broadcast; beyond it the join is left to shuffle.
BROADCAST_ROWS = 100_000
#: Bytes up to which it may.
BROADCAST_BYTES = 64 << 20
#: A key is heavy when it has more than this share of all rows, so there are at most 1/HEAVY_SHARE of them.
HEAVY_SHARE = 0.001

_staged: list[tuple[SparkSession, str]] = []
_shipped: set[str] = set()


@functools.cache
def _package() -> str:
    """The package as an archive in a temporary folder of the driver."""
    home = os.path.dirname(os.path.abspath(__file__))
    return shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="docstrata-"), "docstrata"), "zip", os.path.dirname(home), os.path.basename(home))


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors of a cluster, once a session; local masters share the driver's path."""
    context = spark.sparkContext
    if not context.master.startswith("local") and context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        context.addPyFile(_package())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one only where the setting is absent on a local master (tests)."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="docstrata-")
        spark.conf.set("spark.checkpoint.dir", found)
        _staged.append((spark, found))
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/docstrata-{name}-{uuid.uuid4().hex}"
    _staged.append((spark, path))
    return path


def filesystem(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a URI."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


@atexit.register
def _clean() -> None:
    for spark, path in _staged:
        try:
            fs, at = filesystem(spark, path)
            fs.delete(at, True)
        except Exception:
            pass
    _staged.clear()


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Cut the lineage: the rows as a table in the shared folder, which survives the loss of executors."""
    path = fresh_path(df.sparkSession, name)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint where the side is proven to have at most that many rows and bytes, else the side as it is.

    The side is run once for this: pass a staged frame where that is dear. Bytes are those of the rows as text of JSON,
    which is no less than what a broadcast holds of strings and arrays.
    """
    counted = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("size")).first()
    return F.broadcast(df) if counted.n <= rows and counted.size <= size else df


def heavy_join(big: DataFrame, keyed: DataFrame, on: Sequence[str], n: str) -> DataFrame:
    """Inner join of rows with a side that is unique by key and knows in column n how many rows of big each key has.

    Keys with more than HEAVY_SHARE of all rows are at most 1/HEAVY_SHARE, so they are broadcast and never shuffled;
    in the rest no key has more than that share. big is read twice: pass a table or a staged frame.
    """
    on = list(on)
    total = keyed.agg(F.sum(n)).first()[0] or 0
    cut = max(1000, int(total * HEAVY_SHARE))
    hot = F.broadcast(keyed.where(F.col(n) > cut))
    return big.join(hot, on).unionByName(big.join(hot.select(*on), on, "left_anti").join(keyed.where(F.col(n) <= cut), on))
