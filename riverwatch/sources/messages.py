"""One entry point for message input: a Kafka topic or a folder of files.

Both give the columns the decoders expect: ``value`` (the message) and
``timestamp`` (broker time for Kafka; for files, the time of the read,
as files carry none).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverwatch.sources import files, kafka


def read_messages(
    spark: SparkSession,
    bootstrap_servers: str | None = None,
    topic: str | None = None,
    path: str | None = None,
    stream: bool = False,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
    max_files_per_trigger: int | None = None,
    starting_offsets: str | None = None,
    ending_offsets: str | None = None,
) -> DataFrame:
    """SRC-1 / SRC-2 (Kafka) or their file twins. Exactly one of
    ``bootstrap_servers`` (+ ``topic``) and ``path`` must be given.

    ``starting_offsets`` (Kafka: earliest, latest or JSON) defaults to earliest
    for a batch and latest for a stream; a stream uses it at its first start only.
    ``ending_offsets`` (Kafka batch) defaults to latest.
    An option that has no meaning for the source raises ValueError."""
    if bool(bootstrap_servers) == bool(path):
        raise ValueError("give either bootstrap_servers and topic, or path")
    given = {"min_partitions": min_partitions, "max_offsets_per_trigger": max_offsets_per_trigger,
             "max_files_per_trigger": max_files_per_trigger, "starting_offsets": starting_offsets, "ending_offsets": ending_offsets}
    valid = {"starting_offsets", "min_partitions"} if bootstrap_servers else set()
    if bootstrap_servers and not stream:
        valid.add("ending_offsets")
    if stream:
        valid.add("max_offsets_per_trigger" if bootstrap_servers else "max_files_per_trigger")
    unused = sorted(k for k, v in given.items() if v is not None and k not in valid)
    if unused:
        raise ValueError(f"no use for {', '.join(unused)} with this source")
    if bootstrap_servers:
        if not topic:
            raise ValueError("a Kafka source needs a topic")
        if stream:
            return kafka.read_kafka_stream(
                spark, bootstrap_servers, topic, starting_offsets or "latest",
                max_offsets_per_trigger, min_partitions=min_partitions)
        return kafka.read_kafka_batch(spark, bootstrap_servers, topic, min_partitions,
                                      starting_offsets=starting_offsets or "earliest",
                                      ending_offsets=ending_offsets or "latest")
    if stream:
        df = files.read_message_stream(spark, path, max_files_per_trigger)
    else:
        df = files.read_message_files(spark, path)
    return df.withColumn("timestamp", F.current_timestamp())
