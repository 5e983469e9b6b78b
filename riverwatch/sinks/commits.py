"""Which micro-batches of a folder count: a marker made after all of a batch is written.

A ``foreachBatch`` writer puts a batch into ``batch_id=N`` folders and then makes
the empty file ``_commits/batch_id=N``. Batches are written one after the other, and one that
is replayed replaces its folders, so the newest marker tells that all up to it are whole. Readers take
these only; the filter is on the partition column, so other folders are not opened.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverwatch.sinks.versions import _path

BATCH_ID = "batch_id"  # the folder of a micro-batch
COMMITS = "_commits"
KEEP = 3


def _marked(spark: SparkSession, root: str) -> list[int] | None:
    """Marked batches that are still listed (``KEEP`` or so); None without a folder of markers."""
    fs, folder = _path(spark, f"{root.rstrip('/')}/{COMMITS}")
    if not fs.exists(folder):
        return None
    names = [re.fullmatch(rf"{BATCH_ID}=(\d+)", s.getPath().getName()) for s in fs.listStatus(folder)]
    return sorted(int(n[1]) for n in names if n)


def begin(spark: SparkSession, root: str) -> None:
    """Make the folder of markers, so that a first batch that fails is not taken for plain files."""
    fs, folder = _path(spark, f"{root.rstrip('/')}/{COMMITS}")
    fs.mkdirs(folder)


def commit(spark: SparkSession, root: str, batch_id: int) -> None:
    """All of batch ``batch_id`` is written."""
    before = _marked(spark, root) or []
    fs, marker = _path(spark, f"{root.rstrip('/')}/{COMMITS}/{BATCH_ID}={batch_id}")
    fs.createNewFile(marker)
    for n in before[:-KEEP]:
        fs.delete(_path(spark, f"{root.rstrip('/')}/{COMMITS}/{BATCH_ID}={n}")[1], True)


def last_commit(spark: SparkSession, root: str) -> int | None:
    """The newest batch that counts: -1 before the first, None for a folder without markers."""
    marked = _marked(spark, root)
    return None if marked is None else (marked[-1] if marked else -1)


def committed(df: DataFrame, root: str) -> DataFrame:
    """The rows of ``df`` (a folder with ``batch_id``) whose batch counts by the markers of ``root``."""
    last = last_commit(df.sparkSession, root)
    return df if last is None else df.filter(F.col(BATCH_ID) <= last)
