"""Readings derived from the driver's ``events`` table.

The test tables carry no weather data, so a fixed mapping turns each event
into one reading (and each reading into one message). The mapping is plain
column arithmetic, so it runs inside the scan's code-generated stage and
scales with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverwatch import schema as S
from riverwatch.functions import codec

N_LOCATIONS = 12
TOPIC = "readings"
DAMAGE_ENVELOPE = "reading: "


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reading_columns(n_locations: int = N_LOCATIONS) -> list[Column]:
    """events(event_id, ts, user_id, value, props) -> the six reading columns.

    Written as SQL expressions: one parse on the JVM per column instead of a
    Py4J round trip per function call when the plan is built."""
    loc = f"(user_id % {int(n_locations)})"
    exprs = {
        S.TIMESTAMP: "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")",
        S.LOCATION_ID: f"concat('LOC', lpad(CAST({loc} AS STRING), 3, '0'))",
        S.ELEVATION: f"CAST({loc} AS DOUBLE) * 10.0D",
        S.RAINFALL: "value / 20",
        S.TEMPERATURE: "15 + (event_id % 200) / 10",
        S.RIVER_LEVEL: "CAST(get_json_object(props, '$.k') AS DOUBLE) / 18",
    }
    return [F.expr(e).alias(name) for name, e in exprs.items()]


def readings_from_events(events: DataFrame, n_locations: int = N_LOCATIONS,
                         parse_once: bool = False) -> DataFrame:
    """``parse_once`` puts the columns behind a generator (as ``decode_messages``
    does), so that a filter on them does not parse the JSON text again."""
    if parse_once:
        return events.select(F.inline(F.array(F.struct(*reading_columns(n_locations)))))
    return events.select(*reading_columns(n_locations))


def readings(spark: SparkSession, sf_dir: str, parse_once: bool = False) -> DataFrame:
    return readings_from_events(load_table(spark, sf_dir, "events"), parse_once=parse_once)


def messages_from_events(
    events: DataFrame,
    n_locations: int = N_LOCATIONS,
    topic: str = TOPIC,
    damaged: Column | None = None,
) -> DataFrame:
    """Kafka-shaped records: one JSON reading per event.

    key = location id, offset = event id, partition = location slot,
    broker timestamp = event time. ``damaged`` (a predicate over ``events``)
    marks records whose whole payload is wrapped in a log-style text
    envelope (``reading: {...}``), which no JSON parser accepts; it feeds
    the set-aside path of triage with undecodable messages.
    """
    loc = F.col("user_id") % n_locations
    body = F.to_json(F.struct(*reading_columns(n_locations)))
    if damaged is not None:
        body = F.when(damaged, F.concat(F.lit(DAMAGE_ENVELOPE), body)).otherwise(body)
    return events.select(
        F.concat(F.lit("LOC"), F.lpad(loc.cast("string"), 3, "0")).cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        loc.cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def messages_from_readings(df: DataFrame) -> DataFrame:
    """Readings -> ``value`` text column (the producer's encoding, SNK-1)."""
    return df.select(codec.encode().alias("value"))


def events_stream(
    spark: SparkSession,
    sf_dir: str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """``events`` as a file stream, for driving the speed layer offline.

    The table is one file or a folder of part files; its files are the units
    of micro-batches (``max_files_per_trigger`` bounds a batch)."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    r = spark.readStream.schema(spark.read.parquet(path).schema)  # footer + listing only
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # as a pattern that only this name matches: a plain path has to be a folder
    return r.parquet(f"{path[:-1]}[t]")
