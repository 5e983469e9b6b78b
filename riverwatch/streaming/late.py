"""Event-time windows with the late rows kept.

Spark drops rows behind the watermark without a trace. Here one ``foreachBatch``
query deals every reading to one side: on time, late, or without a time. Windows are held
as mergeable states and written once when the watermark passes their end (append mode);
late readings go to a folder of their own. What is counted and what is set aside add up
to the input.

The watermark is the latest event time of all earlier micro-batches less the delay; a reading is
late when its window ended no later than that. Windows close at the end of the micro-batch that
passes them; Spark closes them, and turns rows away, one micro-batch later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riverwatch import schema as S
from riverwatch.functions import timeparse
from riverwatch.sinks import versions
from riverwatch.sources.files import BATCH_ID

KEYS = ["window", S.LOCATION_ID]
LATE, NO_TIME = "late", "no_time"
_VALUES = {"rainfall": S.RAINFALL, "river_level": S.RIVER_LEVEL}
STATES = ("window struct<start: timestamp, end: timestamp>, location_id string, n long, latest timestamp, "
          + ", ".join(f"n_{v} long, sum_{v} double, max_{v} double" for v in _VALUES))


def _states(rows: DataFrame, window: str) -> DataFrame:
    aggs: list[Column] = [F.count(F.lit(1)).alias("n"), F.max("event_time").alias("latest")]
    for name, c in _VALUES.items():
        aggs += [F.count(c).alias(f"n_{name}"), F.sum(c).alias(f"sum_{name}"), F.max(c).alias(f"max_{name}")]
    return rows.groupBy(F.window("event_time", window).alias("window"), S.LOCATION_ID).agg(*aggs)


def _merged(states: DataFrame) -> DataFrame:
    return states.groupBy(*KEYS).agg(*[
        (F.max if c.startswith("max_") or c == "latest" else F.sum)(c).alias(c)
        for c in states.columns if c not in KEYS])


def _stats(states: DataFrame) -> DataFrame:
    """States -> the columns of ``analytics.windowed_stats``."""
    return states.select(
        *KEYS, F.try_divide("sum_rainfall", "n_rainfall").alias("avg_rainfall"), "max_rainfall",
        F.try_divide("sum_river_level", "n_river_level").alias("avg_river_level"), "max_river_level",
        F.col("n").alias("record_count"))


class WindowsWithLateRows:
    """The folder of such a query: ``windows`` and ``late`` (a folder for each micro-batch), and
    ``state/version=N`` (watermark, last batch), written last, which makes them count.

    A batch's ``windows`` are dealt by ``done``: those it closed stay, the open ones are
    deleted once a later batch has taken them over, so the watermark bounds them.
    """

    def __init__(self, spark: SparkSession, out_dir: str, window: str = "5 minutes", delay: str = "10 minutes"):
        self.spark, self.root, self.window, self.delay = spark, out_dir.rstrip("/"), window, delay

    def _state(self) -> tuple[str | None, int, object]:
        """(folder, last batch, watermark) of what has been taken."""
        path = versions.current_version(self.spark, f"{self.root}/state")
        if path is None:
            return None, -1, None
        row = self.spark.read.parquet(f"{path}/last").first()
        return path, row["batch"], row["watermark"]

    def _take(self, batch: DataFrame, batch_id: int) -> None:
        path, last, watermark = self._state()
        if batch_id <= last:
            return  # replayed after it counted
        spark = batch.sparkSession
        rows = batch.withColumn("event_time", timeparse.instant(S.TIMESTAMP)).persist()
        try:
            # F.window drops rows without a time, so they are dealt first
            timed = rows.filter(F.col("event_time").isNotNull()).withColumn(
                "__end", F.window("event_time", self.window)["end"])
            late = F.coalesce(F.col("__end") <= F.lit(watermark).cast("timestamp"), F.lit(False))
            aside = timed.filter(late).drop("__end").withColumn("why", F.lit(LATE)).unionByName(
                rows.filter(F.col("event_time").isNull()).withColumn("why", F.lit(NO_TIME)))
            aside.write.mode("overwrite").parquet(f"{self.root}/late/{BATCH_ID}={batch_id}")
            fresh = _states(timed.filter(~late).drop("__end"), self.window)
            if path is not None:
                fresh = _merged(self._windows(last, False).unionByName(fresh))
            now = rows.agg((F.max("event_time") - F.expr(f"INTERVAL {self.delay}")).alias("w")).select(
                F.greatest("w", F.lit(watermark).cast("timestamp"))).first()[0]
            done = F.coalesce(F.col("window.end") <= F.lit(now).cast("timestamp"), F.lit(False))
            fresh.withColumn("done", done).write.mode("overwrite").partitionBy("done").parquet(self._of(batch_id))
            versions.write_version(spark, f"{self.root}/state", lambda to: spark.range(1).select(
                F.lit(batch_id).cast("long").alias("batch"),
                F.lit(now).cast("timestamp").alias("watermark")).write.parquet(f"{to}/last"))
            if path is not None:
                fs, old = versions._path(spark, f"{self._of(last)}/done=false")
                fs.delete(old, True)
        finally:
            rows.unpersist()

    def _of(self, batch_id: int) -> str:
        return f"{self.root}/windows/{BATCH_ID}={batch_id}"

    def _windows(self, batch_id: int, done: bool) -> DataFrame:
        """The states that one batch left; ``done``: those it closed, else the open ones."""
        rows = self.spark.read.schema(f"{STATES}, done boolean").parquet(self._of(batch_id))
        return rows.filter(F.col("done") == done).drop("done")

    def start(self, readings: DataFrame, available_now: bool = False,
              trigger: str | None = None) -> StreamingQuery:
        """Run over a stream of decoded readings."""
        w = readings.writeStream.foreachBatch(self._take).option(
            "checkpointLocation", f"{self.root}/checkpoint")
        if available_now:
            w = w.trigger(availableNow=True)
        elif trigger:
            w = w.trigger(processingTime=trigger)
        return w.start()

    def closed(self) -> DataFrame:
        """Windows that the watermark has closed; each is written once."""
        rows = self.spark.read.schema(f"{STATES}, done boolean, {BATCH_ID} long").parquet(f"{self.root}/windows")
        return _stats(rows.filter(F.col("done") & (F.col(BATCH_ID) <= self._state()[1])))

    def open(self) -> DataFrame:
        """Windows that may still change, as they stand."""
        return _stats(self._windows(self._state()[1], False))

    def late(self) -> DataFrame:
        """Readings set aside, with ``why`` (late, no_time) and the ``batch_id`` they came in."""
        return self.spark.read.parquet(f"{self.root}/late").filter(F.col(BATCH_ID) <= self._state()[1])
