"""Tables that are replaced as a whole, with no moment in which a reader sees a part.

A table is a folder of versions, ``version=N``. A version counts once its empty
marker file stands in it; the marker is made last, and making an empty file is
atomic on every store. Readers take the newest marked version, so a failure
between two writes leaves the old one served. There is one writer at a time; a
few versions stay behind for readers that are still at work on them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

DONE = "_DONE"
KEEP = 3


def _path(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    """(number, whether marked) of the versions below ``root``, in order. There are
    about ``KEEP`` of them, whatever the table holds."""
    fs, folder = _path(spark, root)
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        name = re.fullmatch(r"version=(\d+)", status.getPath().getName())
        if name:
            marker = _path(spark, f"{version_path(root, int(name[1]))}/{DONE}")[1]
            found.append((int(name[1]), fs.exists(marker)))
    return sorted(found)


def version_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/version={number}"


def current_version(spark: SparkSession, root: str) -> str | None:
    """The folder of the newest finished version; None if there is none."""
    done = [n for n, marked in _versions(spark, root) if marked]
    return version_path(root, done[-1]) if done else None


def write_version(spark: SparkSession, root: str, write: Callable[[str], object],
                  keep: int = KEEP) -> str:
    """Let ``write`` fill the folder of a new version, then make it the current one.

    Of the others the newest ``keep - 1`` finished ones stay; older ones and
    those that a failed writer left are deleted.
    """
    before = _versions(spark, root)
    number = max((n for n, _ in before), default=0) + 1
    path = version_path(root, number)
    write(path)
    fs, marker = _path(spark, f"{path}/{DONE}")
    fs.createNewFile(marker)
    done = [n for n, marked in before if marked]
    for n in {n for n, _ in before} - set(done[len(done) - keep + 1:] if keep > 1 else []):
        fs.delete(_path(spark, version_path(root, n))[1], True)
    return path


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The current version of a parquet table; a plain folder without versions as it is."""
    return spark.read.parquet(current_version(spark, root) or root)
