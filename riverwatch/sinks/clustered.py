"""Tables sorted across their files, with a small table of what each file holds.

Rows go to files by ranges of the order and are sorted in each, so file after file is
the whole order. A row for each file keeps its least and greatest key and its count. Readers use
it to open only the files they need: the best rows, a range of keys, or all rows in
order without a sort.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

DATA, FILES = "data", "files"


def _order(columns: Sequence[str]) -> list[Column]:
    """``"-name"`` is descending; nulls come last either way."""
    return [F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc_nulls_last(c) for c in columns]


def write_clustered(df: DataFrame, path: str, order: Sequence[str], files: int | None = None) -> None:
    """Overwrite ``path`` with ``df`` in files that follow ``order``, and the table of files.

    ``order``: column names, ``-`` in front for descending. The first is the key that files are
    skipped by; rows that are equal by all of them may stand in any order, and equal
    keys may spread over several files. ``files``: how many (AQE chooses if None)."""
    root, by = path.rstrip("/"), _order(order)
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    # the Bloom filter serves look-ups of one key among files whose ranges overlap
    key = order[0].lstrip("-")
    (ranged.sortWithinPartitions(*by).write.mode("overwrite")
     .option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(f"{root}/{DATA}"))
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{root}/{DATA}")
    name = F.col("_metadata.file_name")
    rows.groupBy(F.regexp_extract(name, "part-([0-9]+)", 1).cast("long").alias("number"), name.alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("n"),
        F.count(key).alias("n_keys")).coalesce(1).write.mode("overwrite").parquet(f"{root}/{FILES}")


def clustered_files(spark: SparkSession, path: str) -> DataFrame:
    """(number, file, low, high, n, n_keys), one row for each file; a null key is not in low and high."""
    return spark.read.parquet(f"{path.rstrip('/')}/{FILES}")


def _read(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    root = f"{path.rstrip('/')}/{DATA}"
    schema = spark.read.parquet(root).schema
    return spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in files]) if files else \
        spark.createDataFrame([], schema)


def top_files(spark: SparkSession, path: str, k: int) -> list[str]:
    """The files that may hold one of the ``k`` rows with the greatest keys, ties and all.

    Files with the greatest maxima are taken until they hold ``k`` keys; their least minimum is a
    floor that the ``k``-th best reaches, so files whose maximum is below it are left out.
    """
    files = clustered_files(spark, path)
    # a file has a key at least, so k files are enough for k keys
    best = files.filter("n_keys > 0").orderBy(F.desc("high"), "number").limit(k).collect()
    floor, held = None, 0
    for f in best:
        held += f["n_keys"]
        floor = f["low"] if floor is None else min(floor, f["low"])
        if held >= k:
            break
    if held < k:  # rows without a key count too
        return [f["file"] for f in files.select("file").collect()]
    return [f["file"] for f in files.filter(F.col("high") >= F.lit(floor)).select("file").collect()]


def top_rows(spark: SparkSession, path: str, k: int,
             best: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """``best(rows, k)`` over the files that can hold its answer. ``best`` has to prefer greater keys."""
    return best(_read(spark, path, top_files(spark, path, k)), k)


def rows_between(spark: SparkSession, path: str, key: str, low: object, high: object | None = None) -> DataFrame:
    """The rows with ``low <= key <= high`` (``key`` equal to ``low`` if ``high`` is None), from the
    files whose range meets that; row groups in them are skipped by their statistics."""
    high = low if high is None else high
    files = clustered_files(spark, path).filter(
        (F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low))).select("file").collect()
    return _read(spark, path, [f["file"] for f in files]).filter(F.col(key).between(F.lit(low), F.lit(high)))


def rows_in_order(spark: SparkSession, path: str) -> Iterator[Row]:
    """All rows in the table's order, file after file, without a sort; the driver holds a partition at a time."""
    for f in clustered_files(spark, path).orderBy("number", "file").select("file").collect():
        yield from _read(spark, path, [f["file"]]).toLocalIterator()
