"""Incremental batch layer: a run reads only what arrived since the last one.

The messages are a stream that is run with ``availableNow``: Spark pins the end
offsets when a run starts and keeps the range of each micro-batch in the
checkpoint, so every scan of a run sees the same rows and the next run starts where it
ended. Each micro-batch's readings are appended to ``flood_risk_data`` and reduced to
mergeable states (counts, sums, extremes, moments), which are merged with those
stored before. The views are cut from the states, so their cost does not grow
with the history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverwatch import schema as S
from riverwatch.functions import timeparse
from riverwatch.functions.rules import RiskThresholds
from riverwatch.operators import analytics as A
from riverwatch.operators.classify import classify_risk
from riverwatch.operators.decode import decode_kafka_batch
from riverwatch.plans.batch import FLOOD_RISK
from riverwatch.session import checkpoint_root
from riverwatch.sinks import versions
from riverwatch.sources.files import BATCH_ID

KEYS = [S.LOCATION_ID, "hour", S.FLOOD_RISK_LEVEL, A.SUMMARY_KIND]
VALUES = {"rain": S.RAINFALL, "temp": S.TEMPERATURE, "river": S.RIVER_LEVEL}
TOP = 10


def partial_states(classified: DataFrame) -> DataFrame:
    """One row of mergeable state for each location, hour, level and for all, in one scan.

    Beside counts, sums and extremes: the number of pairs of rain and river level, their means,
    and the sums of squares and products about these (for the correlation).
    """
    df = classified.select(S.LOCATION_ID, timeparse.hour_of(S.TIMESTAMP).alias("hour"),
                           S.FLOOD_RISK_LEVEL, *VALUES.values())
    keys = KEYS[:3]
    kind = (F.when(F.grouping(S.LOCATION_ID) == 0, F.lit("location"))
            .when(F.grouping("hour") == 0, F.lit("hour"))
            .when(F.grouping(S.FLOOD_RISK_LEVEL) == 0, F.lit("level")).otherwise(F.lit("all")))
    x = F.when(F.col(S.RIVER_LEVEL).isNotNull(), F.col(S.RAINFALL))
    y = F.when(F.col(S.RAINFALL).isNotNull(), F.col(S.RIVER_LEVEL))
    pairs = F.count(x)
    states = [F.count(F.lit(1)).alias("n")]
    for name, c in VALUES.items():
        states += [F.count(c).alias(f"n_{name}"), F.sum(c).alias(f"sum_{name}"),
                   F.min(c).alias(f"min_{name}"), F.max(c).alias(f"max_{name}")]
    states += [pairs.alias("n_pair"), F.avg(x).alias("mean_x"), F.avg(y).alias("mean_y"),
               (F.var_pop(x) * pairs).alias("m2_x"), (F.var_pop(y) * pairs).alias("m2_y"),
               (F.covar_pop(x, y) * pairs).alias("c_xy")]
    return df.groupingSets([[k] for k in keys] + [[]], *keys).agg(kind.alias(A.SUMMARY_KIND), *states)


def merge_states(states: DataFrame) -> DataFrame:
    """States of several parts of the data to one row for each key.

    Means are combined as distances from one of them, so close means lose no digits.
    """
    one = Window.partitionBy(*KEYS)
    near = states.withColumn("at_x", F.max("mean_x").over(one)).withColumn("at_y", F.max("mean_y").over(one))
    n, dx, dy = F.col("n_pair"), F.col("mean_x") - F.col("at_x"), F.col("mean_y") - F.col("at_y")
    sums: list[Column] = [F.sum("n").alias("n")]
    for name in VALUES:
        sums += [F.sum(f"n_{name}").alias(f"n_{name}"), F.sum(f"sum_{name}").alias(f"sum_{name}"),
                 F.min(f"min_{name}").alias(f"min_{name}"), F.max(f"max_{name}").alias(f"max_{name}")]
    total = near.groupBy(*KEYS).agg(
        *sums, F.sum(n).alias("n_pair"), F.max("at_x").alias("at_x"), F.max("at_y").alias("at_y"),
        F.sum(n * dx).alias("sx"), F.sum(n * dy).alias("sy"),
        *[F.sum(c).alias(c) for c in ("m2_x", "m2_y", "c_xy")],
        F.sum(n * dx * dx).alias("qx"), F.sum(n * dy * dy).alias("qy"), F.sum(n * dx * dy).alias("qxy"))

    def moment(own: str, square: str, a: str, b: str) -> Column:
        return (F.col(own) + F.col(square) - F.try_divide(F.col(a) * F.col(b), F.col("n_pair"))).alias(own)

    kept = [c for c in states.columns if c not in ("mean_x", "mean_y", "m2_x", "m2_y", "c_xy")]
    return total.select(
        *kept, (F.col("at_x") + F.try_divide("sx", "n_pair")).alias("mean_x"),
        (F.col("at_y") + F.try_divide("sy", "n_pair")).alias("mean_y"),
        moment("m2_x", "qx", "sx", "sx"), moment("m2_y", "qy", "sy", "sy"), moment("c_xy", "qxy", "sx", "sy"))


def summary_of(states: DataFrame) -> DataFrame:
    """States -> the rows of ``analytics.batch_summary``."""
    def mean(name: str) -> Column:
        return F.try_divide(f"sum_{name}", f"n_{name}")

    spread = F.sqrt(F.col("m2_x")) * F.sqrt(F.col("m2_y"))
    return states.select(
        *KEYS, F.col("n").alias("total_records"), mean("rain").alias("avg_rainfall"),
        F.col("max_rain").alias("max_rainfall"), F.col("min_rain").alias("min_rainfall"),
        mean("temp").alias("avg_temperature"), mean("river").alias("avg_river_level"),
        F.col("max_river").alias("max_river_level"), F.try_divide(F.col("c_xy"), spread).alias("correlation"))


class IncrementalBatch:
    """The folder of an incremental batch layer.

    ``flood_risk_data/batch_id=N/flood_risk_level=L`` (readings), ``state/version=N``
    (states, extremes and the last batch they hold), ``runs`` (a row for each micro-batch with its
    offsets), ``checkpoint``. One run at a time.
    """

    def __init__(self, spark: SparkSession, out_dir: str, thresholds: RiskThresholds = RiskThresholds(),
                 decode: Callable[[DataFrame], DataFrame] = decode_kafka_batch, top: int = TOP):
        self.spark, self.root, self.thresholds = spark, out_dir.rstrip("/"), thresholds
        self.decode, self.top = decode, top

    def _state(self) -> str | None:
        return versions.current_version(self.spark, f"{self.root}/state")

    def last_batch(self) -> int | None:
        """The newest micro-batch that the states hold."""
        state = self._state()
        return None if state is None else self.spark.read.parquet(f"{state}/last").first()[0]

    def _take(self, batch: DataFrame, batch_id: int) -> None:
        last = self.last_batch()
        if last is not None and last >= batch_id:
            return  # replayed after its states were stored
        spark = batch.sparkSession
        own = f"{self.root}/{FLOOD_RISK}/{BATCH_ID}={batch_id}"
        # decoded once: states and extremes are taken from the written rows
        classify_risk(self.decode(batch), self.thresholds).write.mode("overwrite").partitionBy(
            S.FLOOD_RISK_LEVEL).parquet(own)
        rows = spark.read.parquet(own)
        states, top = partial_states(rows), A.extreme_events(rows, self.top)
        before = self._state()
        if before is not None:
            states = merge_states(spark.read.parquet(f"{before}/states").unionByName(states))
            top = A.extreme_events(spark.read.parquet(f"{before}/top").unionByName(top), self.top)

        def write(to: str) -> None:
            states.write.parquet(f"{to}/states")
            top.write.parquet(f"{to}/top")
            spark.range(1).select(F.lit(batch_id).alias("last")).write.parquet(f"{to}/last")

        versions.write_version(spark, f"{self.root}/state", write)

    def run(self, messages: DataFrame) -> int:
        """Take all messages that arrived since the last run; returns how many there were.

        ``messages``: a stream (a topic or a folder). A run that fails is taken up by
        the next one: its finished micro-batches are not read again, and one that
        was cut short replaces what it had written.
        """
        checkpoint_root(self.spark)
        query = (messages.writeStream.foreachBatch(self._take).trigger(availableNow=True)
                 .option("checkpointLocation", f"{self.root}/checkpoint").start())
        query.awaitTermination()
        done = [(p["batchId"], s["description"], str(s["startOffset"]), str(s["endOffset"]), s["numInputRows"])
                for p in query.recentProgress for s in p["sources"] if s["numInputRows"]]
        if done:
            self.spark.createDataFrame(
                done, f"{BATCH_ID} long, source string, start string, end string, n_rows long").coalesce(1).write.mode(
                "append").parquet(f"{self.root}/runs")
        return sum(r[-1] for r in done)

    def summary(self) -> DataFrame | None:
        """``analytics.batch_summary`` of everything taken so far; None before the first message."""
        state = self._state()
        return None if state is None else summary_of(self.spark.read.parquet(f"{state}/states"))

    def views(self) -> dict[str, DataFrame] | None:
        """The batch analytics of everything taken so far, as ``run_batch`` returns them."""
        state = self._state()
        if state is None:
            return None
        out = A.split_summary(self.summary(), ordered=False)
        # a micro-batch that is being written is not in the states yet
        out["flood_risk"] = self.spark.read.parquet(f"{self.root}/{FLOOD_RISK}").filter(
            F.col(BATCH_ID) <= self.last_batch()).drop(BATCH_ID)
        out["extreme_events"] = self.spark.read.parquet(f"{state}/top")
        return out
