"""Update-mode statistics as a table: batch folders, merged into a base from time to time.

Each micro-batch leaves the windows that it changed in ``batch_id=N``. A compaction
merges the folders since the last one with the base (newest row of each window and location),
moves windows that the watermark has closed to ``_closed``, where they are never written
again, and stores the rest as the next version of the base. So the number of
folders is bounded, and a compaction's work follows the open windows and not the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverwatch import schema as S
from riverwatch.sinks import commits, versions
from riverwatch.sinks.versions import _path
from riverwatch.sources.files import BATCH_ID

WINDOW_KEYS = ["window", S.LOCATION_ID]


def latest_window_stats(updates: DataFrame) -> DataFrame:
    """The newest row per (window, location) of rows with a ``batch_id`` (``max_by``: a two-phase
    aggregate, no sort, no window function)."""
    values = [c for c in updates.columns if c not in WINDOW_KEYS + [BATCH_ID]]
    # one max_by for each column keeps the aggregate a hash aggregate
    return updates.groupBy(*WINDOW_KEYS).agg(*[F.max_by(c, BATCH_ID).alias(c) for c in values])


def write_update(batch: DataFrame, batch_id: int, path: str) -> None:
    """A micro-batch's changed windows into its own folder (replaced if the batch is replayed)."""
    commits.begin(batch.sparkSession, path)
    batch.write.mode("overwrite").parquet(f"{path}/{BATCH_ID}={batch_id}")
    commits.commit(batch.sparkSession, path, batch_id)


def _tail(spark: SparkSession, path: str, after: int, schema: T.StructType | None) -> DataFrame | None:
    """The batch folders that count and are not in the base."""
    fs, root = _path(spark, path)
    last = commits.last_commit(spark, path)
    ids = sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(root)
                 if s.getPath().getName().startswith(f"{BATCH_ID}="))
    ids = [i for i in ids if i > after and (last is None or i <= last)]
    if not ids:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.option("basePath", path).parquet(*[f"{path}/{BATCH_ID}={i}" for i in ids])
    return rows.withColumn(BATCH_ID, F.col(BATCH_ID).cast("long"))


def _base(spark: SparkSession, path: str) -> tuple[str | None, int]:
    """(folder of the base, last batch in it)."""
    base = versions.current_version(spark, f"{path}/_base")
    return base, (-1 if base is None else spark.read.parquet(f"{base}/last").first()[0])


def _closed(spark: SparkSession, path: str, base: str | None) -> DataFrame | None:
    """Closed windows of all compactions up to the one that made ``base``."""
    if base is None:
        return None
    number = int(base.rsplit("=", 1)[1])
    rows = spark.read.option("basePath", f"{path}/_closed").parquet(f"{path}/_closed")
    return rows.filter(F.col("compaction") <= number).drop("compaction")


def compact(spark: SparkSession, path: str, watermark: str | None) -> bool:
    """Merge the folders since the last compaction into the base; False if there are none.

    ``watermark``: the query's delay (None: no window ever closes). A window is closed
    when it ends no later than the delay before the latest window's start, which the
    query's watermark has passed by then. Folders are deleted after the new base counts.
    """
    base, last = _base(spark, path)
    tail = _tail(spark, path, last, None)
    if tail is None:
        return False
    upto = tail.agg(F.max(BATCH_ID)).first()[0]
    if upto is None:  # folders without rows
        return False
    rows = tail if base is None else tail.unionByName(spark.read.parquet(f"{base}/open").withColumn(
        BATCH_ID, F.lit(-1).cast("long")))
    newest = latest_window_stats(rows)
    if watermark:
        start = rows.agg(F.max("window.start").alias("s")).select(
            (F.col("s") - F.expr(f"INTERVAL {watermark}")).alias("s")).first()[0]
        done = F.col("window.end") <= F.lit(start)
    else:
        done = F.lit(False)

    def write(to: str) -> None:
        number = to.rsplit("=", 1)[1]
        marked = newest.withColumn("done", F.coalesce(done, F.lit(False)))
        # one pass: the merged rows are written once, dealt by whether they are closed
        marked.write.partitionBy("done").parquet(f"{to}/merged")
        merged = spark.read.schema(marked.schema).parquet(f"{to}/merged")
        merged.filter("NOT done").drop("done").write.parquet(f"{to}/open")
        merged.filter("done").drop("done").write.mode("overwrite").parquet(
            f"{path}/_closed/compaction={number}")
        spark.range(1).select(F.lit(upto).cast("long").alias("last")).write.parquet(f"{to}/last")

    versions.write_version(spark, f"{path}/_base", write, keep=2)
    fs = _path(spark, path)[0]
    for status in fs.listStatus(_path(spark, path)[1]):
        name = status.getPath().getName()
        if name.startswith(f"{BATCH_ID}=") and int(name.split("=")[1]) <= upto:
            fs.delete(status.getPath(), True)
    return True


def read_window_updates(spark: SparkSession, path: str) -> DataFrame:
    """The statistics as they stand: closed windows, and the newest row of every open one.

    A reader that is still at work while a compaction deletes folders fails and can be run again.
    """
    path = path.rstrip("/")
    base, last = _base(spark, path)
    if base is None:
        return latest_window_stats(commits.committed(spark.read.parquet(path), path))
    open_ = spark.read.parquet(f"{base}/open")
    tail = _tail(spark, path, last, open_.schema)
    rows = open_.withColumn(BATCH_ID, F.lit(-1).cast("long"))
    newest = open_ if tail is None else latest_window_stats(rows.unionByName(tail.select(*rows.columns)))
    return _closed(spark, path, base).unionByName(newest)
