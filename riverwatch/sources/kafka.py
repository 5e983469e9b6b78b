"""Kafka topic as a bounded (batch) or unbounded (stream) DataFrame.

The rows carry Spark's Kafka columns (``schema.KAFKA_RECORD``); decoding
is left to ``operators.decode``. The connector jar
(``spark-sql-kafka-0-10`` for the cluster's Spark/Scala version) must be
on the classpath; this module only builds the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    ending_offsets: str | None = None,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options.

    ``min_partitions`` lets one Kafka partition be read by several tasks
    (by default each topic partition is one task, which caps the batch
    read's parallelism at the partition count). ``max_offsets_per_trigger``
    bounds a micro-batch so a backlog does not become one huge batch.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if ending_offsets is not None:
        opts["endingOffsets"] = ending_offsets
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update(extra or {})
    return opts


def read_kafka_batch(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    min_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    starting_offsets: str = "earliest",
    ending_offsets: str = "latest",
) -> DataFrame:
    """The topic from ``starting_offsets`` (the whole of it) to ``ending_offsets`` (SRC-1).

    ``latest`` is looked up anew by every scan; offsets per partition as JSON give all
    scans the same rows. ``plans.incremental`` pins them by itself."""
    opts = kafka_options(
        bootstrap_servers, topic, starting_offsets, ending_offsets, min_partitions, None, extra
    )
    return spark.read.format("kafka").options(**opts).load()


def read_kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    extra: dict[str, str] | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Unbounded read (SRC-2). ``startingOffsets`` only applies on the first
    run; afterwards the query's checkpoint holds the offsets."""
    opts = kafka_options(
        bootstrap_servers, topic, starting_offsets, None, min_partitions,
        max_offsets_per_trigger, extra,
    )
    return spark.readStream.format("kafka").options(**opts).load()
