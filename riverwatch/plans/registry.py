"""Named queries over the driver's tables and their DuckDB equivalents.

Every query reads the whole ``events`` table of a scale-factor folder
through the readings mapping (``sources.readings``), so its work grows
with the table. Computed doubles that depend on summation order (averages,
correlation) are rounded to 9 decimals on both sides; counts, minima and
maxima are exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverwatch import schema as S
from riverwatch.functions.timeparse import wall_time
from riverwatch.operators import analytics as A
from riverwatch.operators import decode as D
from riverwatch.operators.classify import classify_risk, flood_alerts
from riverwatch.plans.batch import FLOOD_RISK, LOCATION_STATS, run_batch
from riverwatch.plans.incremental import IncrementalBatch
from riverwatch.plans.serving import ServingLayer
from riverwatch.session import work_path
from riverwatch.sinks.batch import encode_messages, write_alerts_json, write_json_view
from riverwatch.sinks.clustered import rows_between, top_rows, write_clustered
from riverwatch.sinks.versions import read_current
from riverwatch.sources import readings as R
from riverwatch.sources.files import read_alerts, read_message_files, read_readings_csv
from riverwatch.streaming.late import WindowsWithLateRows
from riverwatch.streaming.speed import SpeedConfig, await_all, start_speed_layer
from riverwatch.streaming.updates import read_window_updates

DIGITS = 9
DAMAGED_EVENT_TYPE = "error"  # feed records wrapped in a text envelope (undecodable)
CHECK_LOCATION = "LOC003"

Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, cols: list[str], digits: int = DIGITS) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def _text_digest(c: str) -> Column:
    """Sum of 32 bits of each text's MD5: the same for the same rows in any order."""
    return F.sum(F.conv(F.substring(F.md5(F.col(c)), 1, 8), 16, 10).cast("long")).alias("text_digest")


def _millionths(c: str) -> Column:
    return F.sum(F.round(F.col(c) * 1e6).cast("long"))


def _digests() -> list[Column]:
    """Exact sums over the rows of a group, taken from every text and number of a reading."""
    return [_text_digest(S.TIMESTAMP), _millionths(S.RAINFALL).alias("rain_digest"),
            _millionths(S.RIVER_LEVEL).alias("river_digest")]


def _readings(spark: SparkSession, sf_dir: str, parse_once: bool = False) -> DataFrame:
    return R.readings(spark, sf_dir, parse_once)


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = R.load_table(spark, sf_dir, "events")
    damaged: Column = F.col("event_type") == F.lit(DAMAGED_EVENT_TYPE)
    return R.messages_from_events(events, damaged=damaged)


def q_risk_classify(spark, sf_dir):
    return classify_risk(_readings(spark, sf_dir))


def q_risk_distribution(spark, sf_dir):
    return A.risk_distribution(classify_risk(_readings(spark, sf_dir)))


def q_flood_alerts(spark, sf_dir):
    return flood_alerts(_readings(spark, sf_dir, parse_once=True))


def q_location_stats(spark, sf_dir):
    return _round(A.location_stats(_readings(spark, sf_dir)),
                  ["avg_rainfall", "avg_temperature", "avg_river_level"])


def q_hourly_patterns(spark, sf_dir):
    return _round(A.hourly_patterns(_readings(spark, sf_dir)), ["avg_rainfall", "avg_river_level"])


def q_rain_river_corr(spark, sf_dir):
    return _round(A.rain_river_corr(_readings(spark, sf_dir)), ["correlation"])


def q_extreme_events(spark, sf_dir):
    return A.extreme_events(_readings(spark, sf_dir), 10)


def q_high_risk_locations(spark, sf_dir):
    return A.high_risk_locations(classify_risk(_readings(spark, sf_dir, parse_once=True)))


def q_record_count(spark, sf_dir):
    return A.record_count(_readings(spark, sf_dir))


def q_windowed_stats(spark, sf_dir):
    df = _readings(spark, sf_dir).withColumn("__t", wall_time(S.TIMESTAMP))
    out = A.flatten_window(A.windowed_stats(df, "__t", "5 minutes"))
    return _round(out, ["avg_rainfall", "avg_river_level"])


def q_decode_readings(spark, sf_dir):
    out = D.decode_kafka_batch(_feed(spark, sf_dir))
    return out.withColumn(S.KAFKA_TIMESTAMP, F.col(S.KAFKA_TIMESTAMP).cast("timestamp_ntz"))


def q_message_triage(spark, sf_dir):
    return D.triage(_feed(spark, sf_dir))


def q_json_roundtrip(spark, sf_dir):
    events = R.load_table(spark, sf_dir, "events")
    return D.decode_messages(encode_messages(R.readings_from_events(events)))


def q_batch_summary(spark, sf_dir):
    out = A.batch_summary(classify_risk(_readings(spark, sf_dir)))
    return _round(out, ["avg_rainfall", "avg_temperature", "avg_river_level", "correlation"])


def q_reading_time_parts(spark, sf_dir):
    return A.with_time_parts(_readings(spark, sf_dir)).select(S.TIMESTAMP, "hour", "date")


def q_undecodable_messages(spark, sf_dir):
    return D.split_triage(D.triage(_feed(spark, sf_dir)))[1]


def _stored_views(spark: SparkSession, sf_dir: str, *views: str):
    """Batch layer over the decoded feed into a fresh folder under the
    shared checkpoint root, then a serving layer over it. ``views``: only these."""
    out = work_path(spark, "batch")
    events = R.load_table(spark, sf_dir, "events")
    readings = D.decode_kafka_batch(R.messages_from_events(events))
    run_batch(spark, readings, out, run_id="check", **({"views": views} if views else {}))
    return ServingLayer(spark, out)


def q_batch_views_roundtrip(spark, sf_dir):
    return _stored_views(spark, sf_dir).query("risk_summary")


def q_served_high_risk(spark, sf_dir):
    return _stored_views(spark, sf_dir, FLOOD_RISK).query("high_risk")


def q_location_summary_one(spark, sf_dir):
    out = _stored_views(spark, sf_dir, LOCATION_STATS).query("location", location_id=CHECK_LOCATION)
    return _round(out, ["avg_rainfall", "avg_temperature", "avg_river_level"])


def q_recent_alerts(spark, sf_dir):
    alerts_dir = work_path(spark, "alerts")
    write_alerts_json(flood_alerts(_readings(spark, sf_dir, parse_once=True)), alerts_dir)
    return ServingLayer(spark, work_path(spark, "no-batch"), alerts_dir).query("alerts")


def _run_stream(spark, sf_dir, files_per_trigger=None, **cfg_kwargs):
    root = work_path(spark, "stream")
    raw = R.messages_from_events(R.events_stream(spark, sf_dir, files_per_trigger)).select("value")
    cfg = SpeedConfig(checkpoint_root=f"{root}/checkpoints", available_now=True, **{
        k: (f"{root}/{v}" if k.endswith("_path") else v) for k, v in cfg_kwargs.items()})
    await_all(spark, start_speed_layer(raw, cfg))
    return cfg


def q_csv_location_stats(spark, sf_dir):
    """SRC-3: the readings as CSV files whose columns stand in another order, read by name."""
    path = work_path(spark, "csv")
    df = _readings(spark, sf_dir)
    df.select(*reversed(df.columns)).write.option("header", True).csv(path)
    return _round(A.location_stats(read_readings_csv(spark, path)),
                  ["avg_rainfall", "avg_temperature", "avg_river_level"])


def q_decode_with_raw(spark, sf_dir):
    """P-3: readings beside the message text. The text is checked by decoding it once more."""
    out = D.decode_stream(_feed(spark, sf_dir), keep_raw=True)
    again = D.decode_messages(out.select(F.col(S.RAW_VALUE).alias("value")),
                              raw_as=S.RAW_VALUE).withColumnRenamed(S.LOCATION_ID, "from_raw")
    damaged = F.col(S.RAW_VALUE).startswith(R.DAMAGE_ENVELOPE)
    parts = [df.withColumn("side", F.lit(side)).withColumn("damaged", damaged).withColumn(S.LOCATION_ID, F.col(c))
             for side, df, c in (("decoded", out, S.LOCATION_ID), ("raw", again, "from_raw"))]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).groupBy("side", S.LOCATION_ID, "damaged").agg(
        F.count(F.lit(1)).alias("count"), *_digests())


def q_alerts_with_time(spark, sf_dir):
    """P-8: alerts with the time they were processed, which is the clock's: checked to be there."""
    stamped = D.stamp_processing_time(_readings(spark, sf_dir, parse_once=True))
    out = flood_alerts(stamped, with_processing_time=True)
    return out.withColumn("stamped", F.col(S.PROCESSING_TIME).isNotNull()).drop(S.PROCESSING_TIME)


def q_json_distribution(spark, sf_dir):
    """SNK-4: the run-stamped JSON view, read back."""
    out = work_path(spark, "distribution")
    path = write_json_view(A.risk_distribution(classify_risk(_readings(spark, sf_dir))), out,
                           "risk_distribution", "check")
    return spark.read.schema("flood_risk_level string, count long").json(path)


def q_stream_windowed_stats(spark, sf_dir):
    cfg = _run_stream(spark, sf_dir, stats_path="stats", time_col="event")
    out = A.flatten_window(read_current(spark, cfg.stats_path))
    return _round(out, ["avg_rainfall", "avg_river_level"])


def q_stream_alerts(spark, sf_dir):
    cfg = _run_stream(spark, sf_dir, alerts_path="alerts", stats=False)
    return read_alerts(spark, cfg.alerts_path)


def q_stream_raw_archive(spark, sf_dir):
    cfg = _run_stream(spark, sf_dir, raw_path="raw", stats=False)
    return D.decode_messages(read_message_files(spark, cfg.raw_path))


def q_stream_realtime_stats(spark, sf_dir):
    """The reference's default speed-layer windows: processing time,
    complete mode. A location's readings fall into as many windows as there
    are micro-batches in different ones; the windows (the clock) are merged
    into one row for each location by their counts, so the result does not
    depend on how the table came in batches. Written to a parquet table (the
    in-memory table of the reference would hold the whole result on the driver)."""
    cfg = _run_stream(spark, sf_dir, files_per_trigger=1, stats_path="stats")
    n = F.col("record_count")

    def mean(c):
        return (F.sum(F.col(c) * n) / F.sum(F.when(F.col(c).isNotNull(), n))).alias(c)

    out = read_current(spark, cfg.stats_path).groupBy(S.LOCATION_ID).agg(
        mean("avg_rainfall"), F.max("max_rainfall").alias("max_rainfall"),
        mean("avg_river_level"), F.max("max_river_level").alias("max_river_level"),
        F.sum(n).alias("record_count"))
    return _round(out, ["avg_rainfall", "avg_river_level"])


def q_stream_update_stats(spark, sf_dir):
    """Event-time windows in update mode, one file a micro-batch, no watermark (every
    reading counts): each batch writes the windows it changed, the newest row of each is read."""
    cfg = _run_stream(spark, sf_dir, files_per_trigger=1, stats_path="stats", time_col="event",
                      stats_mode="update", watermark=None)
    return _round(A.flatten_window(read_window_updates(spark, cfg.stats_path)),
                  ["avg_rainfall", "avg_river_level"])


def q_stream_fan_out(spark, sf_dir):
    """ST-8: alerts, raw archive and statistics from one stream, one file a micro-batch,
    stopped and started again on the same checkpoints (nothing is read twice)."""
    root = work_path(spark, "stream")
    cfg = SpeedConfig(checkpoint_root=f"{root}/checkpoints", available_now=True,
                      alerts_path=f"{root}/alerts", raw_path=f"{root}/raw", stats_path=f"{root}/stats",
                      time_col="event")
    for _ in range(2):
        raw = R.messages_from_events(R.events_stream(spark, sf_dir, 1)).select("value")
        await_all(spark, start_speed_layer(raw, cfg))
    raw = D.decode_messages(read_message_files(spark, cfg.raw_path))
    windows = read_current(spark, cfg.stats_path)
    parts = [df.agg(F.count("*").alias("count"), *_digests()).withColumn("sink", F.lit(name))
             for name, df in (("alerts", read_alerts(spark, cfg.alerts_path)), ("raw_messages", raw))]
    parts.append(windows.agg(
        F.sum("record_count").alias("count"), _text_digest(S.LOCATION_ID),
        _millionths("max_rainfall").alias("rain_digest"), _millionths("max_river_level").alias("river_digest"))
        .withColumn("sink", F.lit("windowed_readings")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_stream_recent_alerts(spark, sf_dir):
    """V-2 served from the speed layer's per-batch top-k index instead of a
    scan of every alert file (same answer)."""
    cfg = _run_stream(spark, sf_dir, alerts_path="alerts", alerts_top_path="top", stats=False)
    return ServingLayer(spark, work_path(spark, "no-batch"), cfg.alerts_path,
                        cfg.alerts_top_path).query("alerts")


def q_stream_triage(spark, sf_dir):
    """Triage (T-1) as a stream over the damaged feed, to a parquet sink."""
    root = work_path(spark, "stream-triage")
    events = R.events_stream(spark, sf_dir)
    damaged = F.col("event_type") == F.lit(DAMAGED_EVENT_TYPE)
    triaged = D.triage(R.messages_from_events(events, damaged=damaged))
    q = (triaged.writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


def q_clustered_extreme_events(spark, sf_dir):
    """TOP-1 over readings clustered by rain: only files that can hold one of the ten are opened."""
    path = work_path(spark, "clustered")
    write_clustered(_readings(spark, sf_dir), path, [f"-{S.RAINFALL}", f"-{S.RIVER_LEVEL}"], files=16)
    return top_rows(spark, path, 10, A.extreme_events)


def q_clustered_location(spark, sf_dir):
    """V-3 / P-9 look-up: one location's classified readings from the files that hold it."""
    path = work_path(spark, "clustered")
    write_clustered(classify_risk(_readings(spark, sf_dir, parse_once=True)), path,
                    [S.LOCATION_ID, S.TIMESTAMP], files=16)
    return rows_between(spark, path, S.LOCATION_ID, CHECK_LOCATION)


FEED_BATCHES, LATE_BATCHES, LATE_EVERY, LATE_BY = 20, 7, 7, 2


def _fed_in_batches(spark, sf_dir, batches: int, late: bool) -> DataFrame:
    """The messages as a stream of ``batches`` micro-batches or a few more.

    Events are dealt by time; with ``late``, every ``LATE_EVERY``-th comes ``LATE_BY`` batches later. They are
    read once, into a folder for each batch; the batches then arrive one after the other. Each comes as one
    file for every core, which is the source's limit for a micro-batch. A part without rows would leave
    no file, so each part has a row without a message, which the stream leaves out."""
    path, dealt = work_path(spark, "feed"), work_path(spark, "dealt")
    events = R.load_table(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(us), F.max(us)).first()
    at = F.expr(f"((unix_micros(CAST(ts AS TIMESTAMP)) - {low}) * {batches}) div {high - low + 1}")
    if late:
        at = at + F.when(F.col("event_id") % LATE_EVERY == 0, LATE_BY).otherwise(0)
    by_batch = events.select("event_id", "ts", "user_id", "value", "props", at.alias("at")).filter("at IS NOT NULL")
    by_batch.write.partitionBy("at").parquet(dealt)
    by_batch = spark.read.schema(by_batch.schema).parquet(dealt)
    files = spark.sparkContext.defaultParallelism
    blank = spark.range(files).select(F.col("id").alias("file"))
    for k in range(batches + (LATE_BY if late else 0)):  # in order of time, as files arrive
        rows = by_batch.filter(F.col("at") == k).withColumn(
            "file", F.pmod(F.monotonically_increasing_id(), F.lit(files)))
        rows = rows.unionByName(blank, allowMissingColumns=True).repartitionById(files, F.col("file").cast("int"))
        value = F.when(F.col("timestamp").isNotNull(), F.col("value")).alias("value")  # every event dealt has a time
        R.messages_from_events(rows).select(value).write.mode("append").parquet(path)
    return spark.readStream.schema("value binary").option("maxFilesPerTrigger", files).parquet(path).filter(
        "value IS NOT NULL")


def q_stream_compacted_stats(spark, sf_dir):
    """Update mode over 20 micro-batches with a watermark, the batch folders merged each five."""
    root = work_path(spark, "stream")
    cfg = SpeedConfig(checkpoint_root=f"{root}/checkpoints", available_now=True, stats_path=f"{root}/stats",
                      time_col="event", stats_mode="update", compact_every=5)
    await_all(spark, start_speed_layer(_fed_in_batches(spark, sf_dir, FEED_BATCHES, late=False), cfg))
    return _round(A.flatten_window(read_window_updates(spark, cfg.stats_path)), ["avg_rainfall", "avg_river_level"])


def q_stream_append_stats(spark, sf_dir):
    """Spark's own append mode with a watermark that acts: what it closes, late rows left out."""
    root = work_path(spark, "stream")
    cfg = SpeedConfig(checkpoint_root=f"{root}/checkpoints", available_now=True, stats_path=f"{root}/stats",
                      time_col="event", stats_mode="append")
    await_all(spark, start_speed_layer(_fed_in_batches(spark, sf_dir, LATE_BATCHES, late=True), cfg))
    return _round(A.flatten_window(spark.read.parquet(cfg.stats_path)).drop("window_end"),
                  ["avg_rainfall", "avg_river_level"])


def q_stream_live_alerts(spark, sf_dir):
    """ST-6: the processing-time trigger, stopped once all that is there has been taken."""
    root = work_path(spark, "stream")
    cfg = SpeedConfig(checkpoint_root=f"{root}/checkpoints", alerts_path=f"{root}/alerts", stats=False,
                      trigger="1 second")
    raw = R.messages_from_events(R.events_stream(spark, sf_dir)).select("value")
    for query in start_speed_layer(raw, cfg):
        query.processAllAvailable()
        query.stop()
    return read_alerts(spark, cfg.alerts_path)


def q_batch_views_persisted(spark, sf_dir):
    """B-4: the batch layer over its cached input, served after the cache is gone."""
    out = work_path(spark, "batch")
    readings = D.decode_kafka_batch(R.messages_from_events(R.load_table(spark, sf_dir, "events")))
    run_batch(spark, readings, out, run_id="check", materialize=False)
    return ServingLayer(spark, out).query("risk_summary")


def q_stream_late_rows(spark, sf_dir):
    """Append mode with a watermark that acts: windows closed and open, and what came too late."""
    layer = WindowsWithLateRows(spark, work_path(spark, "late"))
    layer.start(D.decode_stream(_fed_in_batches(spark, sf_dir, LATE_BATCHES, late=True)), available_now=True).awaitTermination()
    late = A.windowed_stats(layer.late(), "event_time", layer.window)
    parts = [A.flatten_window(df).withColumn("part", F.lit(name))
             for name, df in (("closed", layer.closed()), ("open", layer.open()), ("late", late))]
    return _round(parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("window_end"),
                  ["avg_rainfall", "avg_river_level"])


def q_incremental_batch(spark, sf_dir):
    """SRC-1, B-1..B-3 over two runs: the second takes only what the first had not."""
    root = work_path(spark, "incremental")
    messages = R.messages_from_events(R.load_table(spark, sf_dir, "events"))
    layer = IncrementalBatch(spark, f"{root}/views")
    for half in range(2):
        messages.filter(F.col("offset") % 2 == half).write.mode("append").parquet(f"{root}/topic")
        layer.run(spark.readStream.schema(messages.schema).parquet(f"{root}/topic"))
    return _round(layer.summary(), ["avg_rainfall", "avg_temperature", "avg_river_level", "correlation"])


def q_triage_sides(spark, sf_dir):
    """T-1: both sides of one triage write, each read from its own folders."""
    path = work_path(spark, "triage")
    D.write_triage(D.triage(_feed(spark, sf_dir)), path)
    sides = [df.withColumn("side", F.lit(name)) for name, df in
             zip(("processed", "set_aside"), D.read_triage(spark, path))]
    return sides[0].unionByName(sides[1])


QUERIES: dict[str, Query] = {
    "risk_classify": q_risk_classify,
    "risk_distribution": q_risk_distribution,
    "flood_alerts": q_flood_alerts,
    "location_stats": q_location_stats,
    "hourly_patterns": q_hourly_patterns,
    "rain_river_corr": q_rain_river_corr,
    "extreme_events": q_extreme_events,
    "high_risk_locations": q_high_risk_locations,
    "record_count": q_record_count,
    "windowed_stats": q_windowed_stats,
    "decode_readings": q_decode_readings,
    "message_triage": q_message_triage,
    "json_roundtrip": q_json_roundtrip,
    "batch_summary": q_batch_summary,
    "reading_time_parts": q_reading_time_parts,
    "undecodable_messages": q_undecodable_messages,
    "batch_views_roundtrip": q_batch_views_roundtrip,
    "served_high_risk": q_served_high_risk,
    "location_summary_one": q_location_summary_one,
    "recent_alerts": q_recent_alerts,
    "csv_location_stats": q_csv_location_stats,
    "decode_with_raw": q_decode_with_raw,
    "alerts_with_time": q_alerts_with_time,
    "json_distribution": q_json_distribution,
    "stream_windowed_stats": q_stream_windowed_stats,
    "stream_alerts": q_stream_alerts,
    "stream_raw_archive": q_stream_raw_archive,
    "stream_update_stats": q_stream_update_stats,
    "stream_fan_out": q_stream_fan_out,
    "stream_realtime_stats": q_stream_realtime_stats,
    "stream_triage": q_stream_triage,
    "stream_recent_alerts": q_stream_recent_alerts,
    "incremental_batch": q_incremental_batch,
    "triage_sides": q_triage_sides,
    "clustered_extreme_events": q_clustered_extreme_events,
    "clustered_location": q_clustered_location,
    "stream_compacted_stats": q_stream_compacted_stats,
    "stream_late_rows": q_stream_late_rows,
    "stream_append_stats": q_stream_append_stats,
    "stream_live_alerts": q_stream_live_alerts,
    "batch_views_persisted": q_batch_views_persisted,
}

# --------------------------------------------------------------------------
# DuckDB side. The readings mapping, written once as a CTE.

READINGS_CTE = """readings AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
         'LOC' || lpad(CAST(user_id % 12 AS VARCHAR), 3, '0') AS location_id,
         CAST((user_id % 12) * 10 AS DOUBLE) AS elevation_m,
         value / 20 AS rainfall_mm_per_hr,
         15 + (event_id % 200) / 10 AS temperature_c,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 18 AS river_level_m,
         event_id, ts, user_id, event_type
  FROM events)"""

RISK_CASE = """CASE WHEN rainfall_mm_per_hr > 7.0 AND river_level_m > 5.0 THEN 'CRITICAL'
            WHEN rainfall_mm_per_hr > 5.0 OR river_level_m > 4.0 THEN 'HIGH'
            WHEN rainfall_mm_per_hr > 3.0 OR river_level_m > 3.5 THEN 'MODERATE'
            ELSE 'LOW' END"""

READING_COLS = '"timestamp", location_id, elevation_m, rainfall_mm_per_hr, temperature_c, river_level_m'


LOCATION_STATS_SQL = f"""SELECT location_id, count(*) AS total_records,
       round(avg(rainfall_mm_per_hr), {DIGITS}) AS avg_rainfall,
       max(rainfall_mm_per_hr) AS max_rainfall, min(rainfall_mm_per_hr) AS min_rainfall,
       round(avg(temperature_c), {DIGITS}) AS avg_temperature,
       round(avg(river_level_m), {DIGITS}) AS avg_river_level,
       max(river_level_m) AS max_river_level
FROM readings GROUP BY location_id"""


def _with(body: str) -> str:
    return f"WITH {READINGS_CTE}\n{body}"


ORACLE_SQL: dict[str, str] = {
    "risk_classify": _with(f"SELECT {READING_COLS}, {RISK_CASE} AS flood_risk_level FROM readings"),
    "risk_distribution": _with(
        f"SELECT {RISK_CASE} AS flood_risk_level, count(*) AS count FROM readings GROUP BY 1 ORDER BY 2 DESC, 1"
    ),
    "flood_alerts": _with(
        """SELECT "timestamp", location_id, rainfall_mm_per_hr, river_level_m, 'FLOOD_ALERT' AS alert_type
           FROM readings WHERE rainfall_mm_per_hr > 5.0 OR river_level_m > 4.5"""
    ),
    "location_stats": _with(LOCATION_STATS_SQL + " ORDER BY location_id"),
    "hourly_patterns": _with(
        f"""SELECT CAST(hour(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS hour,
                  round(avg(rainfall_mm_per_hr), {DIGITS}) AS avg_rainfall,
                  round(avg(river_level_m), {DIGITS}) AS avg_river_level
           FROM readings GROUP BY 1 ORDER BY 1"""
    ),
    "rain_river_corr": _with(
        f"""SELECT round(CASE WHEN stddev_pop(rainfall_mm_per_hr) * stddev_pop(river_level_m) = 0 THEN NULL
                         ELSE covar_pop(rainfall_mm_per_hr, river_level_m)
                              / (stddev_pop(rainfall_mm_per_hr) * stddev_pop(river_level_m)) END, {DIGITS})
                  AS correlation
           FROM readings WHERE rainfall_mm_per_hr IS NOT NULL AND river_level_m IS NOT NULL"""
    ),
    "extreme_events": _with(
        """SELECT "timestamp", location_id, rainfall_mm_per_hr, river_level_m FROM readings
           ORDER BY rainfall_mm_per_hr DESC NULLS LAST, river_level_m DESC NULLS LAST,
                    "timestamp" ASC NULLS FIRST, location_id ASC NULLS FIRST
           LIMIT 10"""
    ),
    "high_risk_locations": _with(
        f"""SELECT location_id, flood_risk_level, count(*) AS count
           FROM (SELECT location_id, {RISK_CASE} AS flood_risk_level FROM readings)
           WHERE flood_risk_level IN ('HIGH', 'CRITICAL')
           GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2"""
    ),
    "record_count": "SELECT count(*) AS total_records FROM events",
    "windowed_stats": _with(
        f"""SELECT time_bucket(INTERVAL '5 minutes', CAST("timestamp" AS TIMESTAMP)) AS window_start,
                  time_bucket(INTERVAL '5 minutes', CAST("timestamp" AS TIMESTAMP)) + INTERVAL '5 minutes' AS window_end,
                  location_id,
                  round(avg(rainfall_mm_per_hr), {DIGITS}) AS avg_rainfall,
                  max(rainfall_mm_per_hr) AS max_rainfall,
                  round(avg(river_level_m), {DIGITS}) AS avg_river_level,
                  max(river_level_m) AS max_river_level,
                  count(*) AS record_count
           FROM readings GROUP BY 1, 2, 3"""
    ),
    # Damaged records (event_type 'error') decode to all-NULL readings.
    "decode_readings": _with(
        f"""SELECT CASE WHEN event_type = '{DAMAGED_EVENT_TYPE}' THEN NULL ELSE "timestamp" END AS "timestamp",
                  CASE WHEN event_type = '{DAMAGED_EVENT_TYPE}' THEN NULL ELSE location_id END AS location_id,
                  CASE WHEN event_type = '{DAMAGED_EVENT_TYPE}' THEN NULL ELSE elevation_m END AS elevation_m,
                  CASE WHEN event_type = '{DAMAGED_EVENT_TYPE}' THEN NULL ELSE rainfall_mm_per_hr END AS rainfall_mm_per_hr,
                  CASE WHEN event_type = '{DAMAGED_EVENT_TYPE}' THEN NULL ELSE temperature_c END AS temperature_c,
                  CASE WHEN event_type = '{DAMAGED_EVENT_TYPE}' THEN NULL ELSE river_level_m END AS river_level_m,
                  ts AS kafka_timestamp
           FROM readings"""
    ),
    "message_triage": _with(
        f"""SELECT 'readings' AS topic, CAST(user_id % 12 AS INTEGER) AS "partition", event_id AS "offset",
                  CASE WHEN event_type = '{DAMAGED_EVENT_TYPE}' THEN NULL ELSE "timestamp" END AS "timestamp",
                  CASE WHEN event_type = '{DAMAGED_EVENT_TYPE}' THEN NULL ELSE rainfall_mm_per_hr END AS rainfall_mm_per_hr,
                  CASE WHEN event_type = '{DAMAGED_EVENT_TYPE}' THEN NULL ELSE river_level_m END AS river_level_m,
                  CASE WHEN event_type = '{DAMAGED_EVENT_TYPE}' THEN NULL
                       WHEN coalesce(rainfall_mm_per_hr, 0) > 5.0 THEN '[ALERT] FLOOD ALERT (High Rainfall!)'
                       ELSE 'Status OK' END AS status,
                  CASE WHEN event_type = '{DAMAGED_EVENT_TYPE}' THEN 'undecodable' END AS problem
           FROM readings"""
    ),
    "json_roundtrip": _with(f"SELECT {READING_COLS} FROM readings"),
}
ORACLE_SQL["batch_views_roundtrip"] = ORACLE_SQL["risk_distribution"]
ORACLE_SQL["served_high_risk"] = ORACLE_SQL["high_risk_locations"]
ORACLE_SQL["location_summary_one"] = _with(
    f"""SELECT * FROM ({LOCATION_STATS_SQL}) WHERE location_id = '{CHECK_LOCATION}'""")
ORACLE_SQL["recent_alerts"] = _with(
    """SELECT "timestamp", location_id, rainfall_mm_per_hr, river_level_m, 'FLOOD_ALERT' AS alert_type
       FROM readings WHERE rainfall_mm_per_hr > 5.0 OR river_level_m > 4.5
       ORDER BY "timestamp" DESC, location_id, rainfall_mm_per_hr DESC, river_level_m DESC LIMIT 10""")
ORACLE_SQL["batch_summary"] = _with(
    f"""SELECT location_id, hour, flood_risk_level,
              CASE WHEN grouping(location_id) = 0 THEN 'location'
                   WHEN grouping(hour) = 0 THEN 'hour'
                   WHEN grouping(flood_risk_level) = 0 THEN 'level' ELSE 'all' END AS summary_kind,
              count(*) AS total_records,
              round(avg(rainfall_mm_per_hr), {DIGITS}) AS avg_rainfall,
              max(rainfall_mm_per_hr) AS max_rainfall, min(rainfall_mm_per_hr) AS min_rainfall,
              round(avg(temperature_c), {DIGITS}) AS avg_temperature,
              round(avg(river_level_m), {DIGITS}) AS avg_river_level,
              max(river_level_m) AS max_river_level,
              round(CASE WHEN stddev_pop(rainfall_mm_per_hr) * stddev_pop(river_level_m) = 0 THEN NULL
                         ELSE covar_pop(rainfall_mm_per_hr, river_level_m)
                              / (stddev_pop(rainfall_mm_per_hr) * stddev_pop(river_level_m)) END, {DIGITS})
                AS correlation
       FROM (SELECT location_id, CAST(hour(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS hour,
                    {RISK_CASE} AS flood_risk_level, rainfall_mm_per_hr, temperature_c, river_level_m
             FROM readings)
       GROUP BY GROUPING SETS ((location_id), (hour), (flood_risk_level), ())""")
ORACLE_SQL["reading_time_parts"] = _with(
    """SELECT "timestamp", CAST(hour(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS hour,
              CAST(CAST("timestamp" AS TIMESTAMP) AS DATE) AS date FROM readings""")
ORACLE_SQL["undecodable_messages"] = (
    f"SELECT * FROM ({ORACLE_SQL['message_triage']}) WHERE problem = 'undecodable'")
ORACLE_SQL["csv_location_stats"] = ORACLE_SQL["location_stats"]
ORACLE_SQL["json_distribution"] = ORACLE_SQL["risk_distribution"]
ORACLE_SQL["alerts_with_time"] = f"SELECT *, TRUE AS stamped FROM ({ORACLE_SQL['flood_alerts']})"
_TEXT_DIGEST = "CAST(sum(CAST('0x' || substr(md5({}), 1, 8) AS BIGINT)) AS BIGINT) AS text_digest"
_MILLIONTHS = "CAST(sum(CAST(round({} * 1e6) AS BIGINT)) AS BIGINT) AS {}"
_DIGESTS = ", ".join([_TEXT_DIGEST.format('"timestamp"'), _MILLIONTHS.format("rainfall_mm_per_hr", "rain_digest"),
                      _MILLIONTHS.format("river_level_m", "river_digest")])
ORACLE_SQL["decode_with_raw"] = f"""
SELECT side, location_id, damaged, count(*) AS count, {_DIGESTS}
FROM (SELECT *, "timestamp" IS NULL AS damaged FROM ({ORACLE_SQL["decode_readings"]})),
     (VALUES ('decoded'), ('raw')) AS s(side) GROUP BY 1, 2, 3"""
ORACLE_SQL["stream_windowed_stats"] = ORACLE_SQL["windowed_stats"]
ORACLE_SQL["stream_update_stats"] = ORACLE_SQL["windowed_stats"]
ORACLE_SQL["stream_fan_out"] = f"""
SELECT 'alerts' AS sink, count(*) AS count, {_DIGESTS} FROM ({ORACLE_SQL["flood_alerts"]})
UNION ALL SELECT 'raw_messages', count(*), {_DIGESTS} FROM ({ORACLE_SQL["json_roundtrip"]})
UNION ALL SELECT 'windowed_readings', CAST(sum(record_count) AS BIGINT), {_TEXT_DIGEST.format("location_id")},
       {_MILLIONTHS.format("max_rainfall", "rain_digest")}, {_MILLIONTHS.format("max_river_level", "river_digest")}
FROM ({ORACLE_SQL["windowed_stats"]})"""
ORACLE_SQL["stream_alerts"] = ORACLE_SQL["flood_alerts"]
ORACLE_SQL["stream_raw_archive"] = ORACLE_SQL["json_roundtrip"]
ORACLE_SQL["stream_realtime_stats"] = _with(
    f"""SELECT location_id, round(avg(rainfall_mm_per_hr), {DIGITS}) AS avg_rainfall,
              max(rainfall_mm_per_hr) AS max_rainfall,
              round(avg(river_level_m), {DIGITS}) AS avg_river_level,
              max(river_level_m) AS max_river_level, count(*) AS record_count
       FROM readings GROUP BY location_id""")
ORACLE_SQL["stream_triage"] = ORACLE_SQL["message_triage"]
ORACLE_SQL["stream_recent_alerts"] = ORACLE_SQL["recent_alerts"]
ORACLE_SQL["clustered_extreme_events"] = ORACLE_SQL["extreme_events"]
ORACLE_SQL["clustered_location"] = f"""SELECT * FROM ({ORACLE_SQL['risk_classify']})
WHERE location_id = '{CHECK_LOCATION}'"""
ORACLE_SQL["incremental_batch"] = ORACLE_SQL["batch_summary"]
ORACLE_SQL["triage_sides"] = f"""SELECT *, CASE WHEN problem = 'undecodable' THEN 'set_aside' ELSE 'processed' END AS side
FROM ({ORACLE_SQL['message_triage']})"""
ORACLE_SQL["stream_compacted_stats"] = ORACLE_SQL["windowed_stats"]
ORACLE_SQL["stream_late_rows"] = _with(
    f"""SELECT part, ws AS window_start, location_id, round(avg(rainfall_mm_per_hr), {DIGITS}) AS avg_rainfall,
              max(rainfall_mm_per_hr) AS max_rainfall, round(avg(river_level_m), {DIGITS}) AS avg_river_level,
              max(river_level_m) AS max_river_level, count(*) AS record_count
       FROM (SELECT *, CASE WHEN ws + INTERVAL 5 MINUTES <= wm THEN 'late'
                            WHEN ws + INTERVAL 5 MINUTES <= (SELECT max(t) FROM dealt) - INTERVAL 10 MINUTES
                            THEN 'closed' ELSE 'open' END AS part
             FROM (SELECT *, time_bucket(INTERVAL '5 minutes', t) AS ws FROM dealt) JOIN marks USING (b))
       GROUP BY ALL""").replace("\nSELECT part", f""",
bounds AS (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events),
dealt AS (SELECT *, CAST("timestamp" AS TIMESTAMP) AS t,
                 ((epoch_us(ts) - low) * {LATE_BATCHES}) // (high - low + 1)
                 + CASE WHEN event_id % {LATE_EVERY} = 0 THEN {LATE_BY} ELSE 0 END AS b FROM readings, bounds),
marks AS (SELECT b, max(max(t)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                    - INTERVAL 10 MINUTES AS wm FROM dealt GROUP BY b)
SELECT part""", 1)
# Spark filters a micro-batch's late rows by the watermark that the one before it evicted by
ORACLE_SQL["stream_append_stats"] = "SELECT * EXCLUDE (part) FROM ({}) WHERE part = 'closed'".format(
    ORACLE_SQL["stream_late_rows"].replace("AND 1 PRECEDING", "AND 2 PRECEDING"))
ORACLE_SQL["stream_live_alerts"] = ORACLE_SQL["flood_alerts"]
ORACLE_SQL["batch_views_persisted"] = ORACLE_SQL["risk_distribution"]

assert set(ORACLE_SQL) <= set(QUERIES), set(ORACLE_SQL) - set(QUERIES)
