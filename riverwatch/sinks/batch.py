"""Batch sinks (SNK-1..SNK-4)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverwatch import schema as S
from riverwatch.functions import codec


def encode_messages(
    df: DataFrame, key_col: str | None = None, missing_as_nan: bool = False
) -> DataFrame:
    """SNK-1 encode: one JSON text per reading in ``value`` (and ``key``).
    Without a key the Kafka producer spreads records over partitions, so a
    hot location cannot overload one partition.

    A missing number is left out of the message by default. With
    ``missing_as_nan`` it is sent as NaN, as a producer that turns rows into
    dictionaries through pandas does; decoded with ``keep_nan=True`` it then
    alerts like the original pipeline (NaN > 5 is true in Spark)."""
    if missing_as_nan:
        df = df.select(*[
            F.coalesce(F.col(f.name), F.lit(float("nan"))).alias(f.name)
            if f.name in S.READING_COLUMNS and isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ])
    cols = [codec.encode([c for c in S.READING_COLUMNS if c in df.columns]).alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*cols)


def publish_kafka(
    df: DataFrame, bootstrap_servers: str, topic: str, key_col: str | None = None,
    missing_as_nan: bool = False,
) -> None:
    """SNK-1: publish readings to a topic in one distributed write."""
    (
        encode_messages(df, key_col, missing_as_nan)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .save()
    )


def write_message_files(
    df: DataFrame, path: str, mode: str = "overwrite", missing_as_nan: bool = False
) -> None:
    """SNK-1 offline twin: one message per line in text files."""
    encode_messages(df, missing_as_nan=missing_as_nan).write.mode(mode).text(path)


def write_parquet_view(df: DataFrame, path: str) -> None:
    """SNK-2: overwrite a parquet view. Written unsorted: readers sort."""
    df.write.mode("overwrite").parquet(path)


def write_partitioned_view(
    df: DataFrame, path: str, column: str = S.FLOOD_RISK_LEVEL, rebalance: bool = True
) -> None:
    """SNK-3: overwrite parquet partitioned by ``column``.

    With few distinct values (four risk levels, one of them usually holding
    most rows) every task would otherwise write one small file per value.
    ``rebalance`` asks AQE for a shuffle by the column whose skewed
    partitions it splits to the advisory size, so each level gets files of
    a useful size and the dominant level is written by many tasks, not one.
    """
    if rebalance:
        df = df.hint("rebalance", column)
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def run_stamp(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")


def write_json_view(df: DataFrame, base_dir: str, name: str, run_id: str | None = None) -> str:
    """SNK-4: overwrite ``<base>/<name>_<run id>.json`` (a folder of JSON
    files). Returns the path written."""
    path = f"{base_dir.rstrip('/')}/{name}_{run_id or run_stamp()}.json"
    df.write.mode("overwrite").json(path)
    return path


def write_alerts_json(df: DataFrame, path: str, mode: str = "append") -> None:
    """Alert records as JSON files, the layout the stream's alert sink
    writes; used to publish batch-detected alerts to the serving layer."""
    df.write.mode(mode).json(path)
