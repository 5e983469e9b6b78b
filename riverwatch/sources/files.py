"""File sources: message files, reading CSV, alert JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverwatch import schema as S
from riverwatch.sinks import commits

BATCH_ID = commits.BATCH_ID


def read_message_files(spark: SparkSession, path: str) -> DataFrame:
    """One JSON message per line -> a ``value`` string column; the offline
    twin of the Kafka batch read."""
    return spark.read.text(path)


def read_message_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of new message files in a folder (text, one message a line)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def read_readings_csv(
    spark: SparkSession, path: str, schema: T.StructType = S.READING
) -> DataFrame:
    """Readings CSV with a header line, its columns taken by name.

    The order of the columns is the file's; further columns are ignored, and a
    missing one raises ValueError. Types are fixed, not inferred (inference
    costs a full extra pass and guesses types per file); a cell that is not of
    its type is NULL. All files of a folder need the same header."""
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_alerts(
    spark: SparkSession, path: str, schema: T.StructType = S.ALERT, with_batch: bool = False,
    upto: int | None = None
) -> DataFrame:
    """Alert JSON files. The schema is explicit: the JSON writer leaves out
    NULL fields and writes NaN as a string, so inference would mistype or
    fail on an empty folder. A folder written by a streaming file sink is
    read through its ``_spark_metadata`` log, so half-written files of a
    failed micro-batch are not seen. Folders written per micro-batch
    (``batch_id=N``) are read as one; the partition column is dropped, or
    kept (NULL in other layouts) if ``with_batch`` is set. Of such folders with markers
    (``sinks.commits``) only batches that are marked count, or those up to ``upto``."""
    batched = T.StructType([*schema.fields, T.StructField(BATCH_ID, T.LongType())])
    rows = spark.read.schema(batched).json(path)
    last = commits.last_commit(spark, path) if upto is None else upto
    if last is not None:
        rows = rows.filter(F.col(BATCH_ID) <= last)
    return rows.select(*(batched if with_batch else schema).fieldNames())


def read_archive(spark: SparkSession, path: str, commits_root: str | None = None) -> DataFrame:
    """The raw archive as ``value``. ``commits_root``: the folder with the markers of its
    micro-batches (the alerts', if both come from one query); without markers all is read."""
    rows = spark.read.text(path)
    if BATCH_ID in rows.columns:
        rows = commits.committed(rows, commits_root or path)
    return rows.select("value")
