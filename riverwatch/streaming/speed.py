"""Speed layer: Structured Streaming over the message stream.

One parsed stream fans out to several queries (ST-8): alerts to JSON
files, raw messages to text files, windowed statistics to a table, and an
optional console monitor. The decode and rule functions are the batch
layer's. Every query has its own checkpoint folder below a shared root, so
a restart resumes from the committed offsets and state.

Time: the reference windows on ``processing_time``, which makes all rows of
a micro-batch share one window and is not reproducible. ``time_col="event"``
windows on the reading's own timestamp instead (the text parsed as a
TIMESTAMP, which a watermark requires; TIMESTAMP_NTZ is refused).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riverwatch import schema as S
from riverwatch.functions import timeparse
from riverwatch.functions.rules import AlertRule
from riverwatch.operators import analytics as A
from riverwatch.operators.classify import flood_alerts
from riverwatch.operators.decode import decode_stream, stamp_processing_time
from riverwatch.sinks import commits, versions
from riverwatch.sources.files import BATCH_ID, read_alerts
from riverwatch.streaming.updates import compact, latest_window_stats, write_update

EVENT_TIME = "event_time"


@dataclass
class SpeedConfig:
    checkpoint_root: str
    alerts_path: str | None = None
    raw_path: str | None = None
    stats_path: str | None = None  # parquet table of the windowed statistics
    # The reference's in-memory table instead: the whole result on the driver, for small state only.
    stats_memory: bool = False
    stats_query_name: str = "realtime_stats"  # name of that table
    # Update mode: merge the batch folders into the base each so many batches (streaming.updates).
    compact_every: int | None = None
    time_col: str = S.PROCESSING_TIME  # or "event"
    window: str = "5 minutes"
    watermark: str = "10 minutes"
    stats_mode: str = "complete"  # complete | update | append
    trigger: str | None = "5 seconds"  # processing-time trigger; None = ASAP
    available_now: bool = False  # process what is there, then stop
    console: str | None = None  # "parsed" (SNK-8) or "raw" (SNK-9)
    stats: bool = True  # start the windowed-statistics query
    keep_nan: bool = False
    alert_rule: AlertRule = field(default_factory=AlertRule)
    alerts_with_processing_time: bool = False
    # Alerts are rare: shuffling only them into this many partitions per
    # micro-batch keeps the sink from writing one tiny file per input
    # partition, while the decode before it stays fully parallel (a
    # coalesce would pull the decode down to this many tasks too).
    alert_files_per_batch: int | None = None
    # One source read for the stateless sinks (alerts, raw archive): a single
    # foreachBatch query persists each micro-batch and writes both, instead
    # of one query (and one Kafka read) per sink. Output goes to one folder
    # per micro-batch (``batch_id=N``), overwritten if the batch is replayed.
    shared_stateless: bool = False
    # State partitions of the windowed statistics: fixed in the checkpoint
    # at the query's first start (later starts keep the stored number).
    # None = the session's spark.sql.shuffle.partitions.
    state_partitions: int | None = None
    # The k latest alerts so far (by timestamp text), a new version per
    # micro-batch (``sinks.versions``), old ones deleted. The serving layer
    # answers "latest alerts" from these k rows instead of scanning every
    # alert file; exact for any n <= k.
    alerts_top_path: str | None = None
    alerts_top_k: int = 10


def parse_stream(raw: DataFrame, keep_raw: bool = False, keep_nan: bool = False) -> DataFrame:
    """P-2/P-3 + P-4: decoded readings stamped with ``processing_time``."""
    return stamp_processing_time(decode_stream(raw, keep_nan=keep_nan, keep_raw=keep_raw))


def alerts_stream(parsed: DataFrame, rule: AlertRule = AlertRule(),
                  with_processing_time: bool = False) -> DataFrame:
    """Stateless: filter + projection (P-6..P-8)."""
    return flood_alerts(parsed, rule, with_processing_time)


def windowed_stats_stream(
    parsed: DataFrame,
    time_col: str = S.PROCESSING_TIME,
    window: str = "5 minutes",
    watermark: str | None = "10 minutes",
) -> DataFrame:
    """A-8 + ST-1..ST-3: watermark, tumbling window, keyed state."""
    df = parsed
    if time_col == "event":
        df = df.withColumn(EVENT_TIME, timeparse.instant(S.TIMESTAMP))
        time_col = EVENT_TIME
    if watermark:
        df = df.withWatermark(time_col, watermark)
    return A.windowed_stats(df, time_col, window)


def _trigger(writer, cfg: SpeedConfig, processing_time: str | None):
    if cfg.available_now:
        return writer.trigger(availableNow=True)
    if processing_time:
        return writer.trigger(processingTime=processing_time)
    return writer


def _ckpt(cfg: SpeedConfig, name: str) -> str:
    return f"{cfg.checkpoint_root.rstrip('/')}/{name}"


def start_alerts_sink(alerts: DataFrame, cfg: SpeedConfig) -> StreamingQuery:
    """SNK-5: append alerts to JSON files; the sink's ``_spark_metadata``
    log makes the output exactly-once across restarts."""
    w = (alerts.writeStream.outputMode("append").format("json")
         .option("path", cfg.alerts_path).option("checkpointLocation", _ckpt(cfg, "alerts")))
    return _trigger(w, cfg, cfg.trigger).start()


def start_raw_archive(raw: DataFrame, cfg: SpeedConfig) -> StreamingQuery:
    """SNK-6: each message unchanged as one text line."""
    text = raw.select(F.col("value").cast("string").alias("value"))
    w = (text.writeStream.outputMode("append").format("text")
         .option("path", cfg.raw_path).option("checkpointLocation", _ckpt(cfg, "raw_messages")))
    return _trigger(w, cfg, cfg.trigger).start()


def _replace_table(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        # Complete mode hands over the whole result each time: a replayed
        # batch becomes one more version of the same content.
        versions.write_version(batch.sparkSession, path, lambda to: batch.write.parquet(to))

    return write


def _versioned_updates(cfg: SpeedConfig) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        # Update mode hands over only the groups that changed.
        write_update(batch, batch_id, cfg.stats_path)
        if cfg.compact_every and (batch_id + 1) % cfg.compact_every == 0:
            compact(batch.sparkSession, cfg.stats_path, cfg.watermark)

    return write


def start_stats_sink(stats: DataFrame, cfg: SpeedConfig) -> StreamingQuery:
    """SNK-7: windowed statistics.

    ``stats_memory``: the reference's in-memory table (complete mode,
    queryable as ``cfg.stats_query_name`` in this session only; results
    live on the driver, so only for small state). Else a table at ``stats_path``:
    complete mode writes a new version of a parquet table per micro-batch
    through ``foreachBatch`` (a distributed write; read it with
    ``sinks.versions.read_current``, which never sees half of one); update mode keeps each batch's
    changed groups in a ``batch_id=N`` folder, merged each ``compact_every``
    batches (read with ``streaming.updates.read_window_updates``); append mode uses the parquet file sink,
    emitting each window once the watermark closes it.
    """
    ck = _ckpt(cfg, "windowed_stats")
    w = stats.writeStream.outputMode(cfg.stats_mode).option("checkpointLocation", ck)
    if cfg.stats_memory:
        w = w.format("memory").queryName(cfg.stats_query_name)
    elif cfg.stats_mode == "append":
        w = w.format("parquet").option("path", cfg.stats_path)
    elif cfg.stats_mode == "update":
        w = w.foreachBatch(_versioned_updates(cfg))
    else:
        w = w.foreachBatch(_replace_table(cfg.stats_path))
    w = _trigger(w, cfg, None)
    if not cfg.state_partitions:
        return w.start()
    conf = stats.sparkSession.conf
    key = "spark.sql.shuffle.partitions"
    before = conf.get(key)
    conf.set(key, str(cfg.state_partitions))  # read once, when the query starts
    try:
        return w.start()
    finally:
        conf.set(key, before)


def _write_top(spark: SparkSession, cfg: SpeedConfig, batch_id: int) -> None:
    """The latest alerts after this batch, as a new version of the index.

    They are the best of the previous version and of the batch's alert files.
    Without a previous version, with one made for fewer rows, or when a batch is
    replayed whose alerts are in it already, all alert files are read instead.
    """
    before = versions.current_version(spark, cfg.alerts_top_path)
    index = spark.read.parquet(before) if before else None
    if index is not None and index.agg(
            F.coalesce(F.min("k") >= cfg.alerts_top_k, F.lit(True))
            & (F.count_if(F.col(BATCH_ID) == batch_id) == 0)).first()[0]:
        own = read_alerts(spark, f"{cfg.alerts_path}/{BATCH_ID}={batch_id}")
        alerts = own.withColumn(BATCH_ID, F.lit(batch_id).cast("long")).unionByName(index.drop("k"))
    else:
        alerts = read_alerts(spark, cfg.alerts_path, with_batch=True, upto=batch_id)
    top = A.recent_alerts(alerts, cfg.alerts_top_k).withColumn(
        "k", F.lit(cfg.alerts_top_k))  # what a reader may ask of the index
    versions.write_version(spark, cfg.alerts_top_path, lambda to: top.write.parquet(to))


def commits_root(cfg: SpeedConfig) -> str:
    """Where the markers of the shared stateless writer are: with the alerts, or with the
    archive if there are no alerts."""
    return cfg.alerts_path or cfg.raw_path


def _stateless_writer(cfg: SpeedConfig) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        commits.begin(batch.sparkSession, commits_root(cfg))
        batch = batch.persist()
        try:
            if cfg.raw_path:
                (batch.select(F.col("value").cast("string").alias("value"))
                 .write.mode("overwrite").text(f"{cfg.raw_path}/batch_id={batch_id}"))
            if cfg.alerts_path:
                alerts = alerts_stream(parse_stream(batch, keep_nan=cfg.keep_nan), cfg.alert_rule,
                                       cfg.alerts_with_processing_time)
                if cfg.alert_files_per_batch:
                    alerts = alerts.repartition(cfg.alert_files_per_batch)
                alerts.write.mode("overwrite").json(f"{cfg.alerts_path}/batch_id={batch_id}")
                if cfg.alerts_top_path:
                    _write_top(batch.sparkSession, cfg, batch_id)
            # archive and alerts count together, once both are whole
            commits.commit(batch.sparkSession, commits_root(cfg), batch_id)
        finally:
            batch.unpersist()

    return write


def start_shared_stateless(raw: DataFrame, cfg: SpeedConfig) -> StreamingQuery:
    """Alerts and raw archive from one read of the source (see
    ``SpeedConfig.shared_stateless``). A micro-batch counts once its marker is
    made, after both are written (``sinks.commits``); ``sources.files.read_alerts`` and
    ``read_archive`` take such batches only."""
    w = (raw.writeStream.foreachBatch(_stateless_writer(cfg))
         .option("checkpointLocation", _ckpt(cfg, "stateless")))
    return _trigger(w, cfg, cfg.trigger).start()


def start_console(df: DataFrame, cfg: SpeedConfig, name: str = "console") -> StreamingQuery:
    """SNK-8 / SNK-9: untruncated console monitor."""
    w = (df.writeStream.outputMode("append").format("console").option("truncate", False)
         .option("checkpointLocation", _ckpt(cfg, name)))
    return _trigger(w, cfg, None).start()


def start_speed_layer(raw: DataFrame, cfg: SpeedConfig) -> list[StreamingQuery]:
    """ST-8: start every configured query on one raw stream.

    By default each query reads the source on its own (Spark shares no scan
    between streaming queries). ``shared_stateless`` serves the alerts and
    the raw archive from one query and one read instead; the windowed
    statistics keep their own query, since they need state and an output
    mode.
    """
    if cfg.alerts_top_path and not cfg.alerts_path:
        raise ValueError("alerts_top_path indexes the alerts of alerts_path, which is not set")
    if cfg.stats and not (cfg.stats_path or cfg.stats_memory):
        raise ValueError("stats needs a stats_path (or stats_memory, which holds them on the driver)")
    parsed = parse_stream(raw, keep_nan=cfg.keep_nan)
    started: list[StreamingQuery] = []
    # index and alert files come from the same micro-batch, so they cannot differ
    together = cfg.shared_stateless or bool(cfg.alerts_top_path)
    try:
        if cfg.console == "raw":
            text = raw.select(F.col("value").cast("string").alias(S.RAW_VALUE))
            started.append(start_console(text, cfg, "console_raw"))
        elif cfg.console:
            started.append(start_console(parsed, cfg))
        if cfg.raw_path and not cfg.shared_stateless:
            started.append(start_raw_archive(raw, cfg))
        if together and (cfg.alerts_path or cfg.raw_path):
            own = cfg if cfg.shared_stateless else replace(cfg, raw_path=None)
            started.append(start_shared_stateless(raw, own))
        elif cfg.alerts_path:
            alerts = alerts_stream(parsed, cfg.alert_rule, cfg.alerts_with_processing_time)
            if cfg.alert_files_per_batch:
                alerts = alerts.repartition(cfg.alert_files_per_batch)
            started.append(start_alerts_sink(alerts, cfg))
        if cfg.stats:
            stats = windowed_stats_stream(parsed, cfg.time_col, cfg.window, cfg.watermark)
            started.append(start_stats_sink(stats, cfg))
    except Exception:
        stop_all(started)
        raise
    return started


def await_all(spark: SparkSession, queries: list[StreamingQuery], timeout: float | None = None,
              poll: float = 0.5) -> None:
    """ST-9: block until every query ends, or ``timeout`` seconds are over in all.

    All queries are watched at once: the first failure of any, or Ctrl+C, stops
    the rest and is raised, also while others are still running (the reference
    waited on the console query only, so a failed alert query went unnoticed)."""
    until = None if timeout is None else time.monotonic() + timeout
    try:
        while True:
            active = [q for q in queries if q.isActive]
            for q in queries:
                if q not in active and q.exception() is not None:
                    q.awaitTermination()  # raises what ended it
            if not active or (until is not None and time.monotonic() >= until):
                return
            active[0].awaitTermination(poll)
    except BaseException:
        stop_all(queries)
        raise


def stop_all(queries: list[StreamingQuery]) -> None:
    for q in queries:
        if q.isActive:
            q.stop()
