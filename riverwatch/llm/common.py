"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverwatch.session import work_path

#: The six ASCII white-space characters of the word rule ``[^\x20\x09-\x0D]+``.
WHITE = " \t\n\x0b\f\r"
WHITE_RUN = "[ \\t-\\r]+"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
FILES_AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the time of a block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stored(df: DataFrame, name: str, free_shuffles: bool = False, by: str | None = None,
           distinct: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage at files every executor reaches, so a lost executor costs
    a re-read and not a recomputation. Non-deterministic columns are fixed.
    ``free_shuffles``: the shuffle files of the write are deleted as soon as it is
    done, not when the driver happens to collect garbage; nothing reads them again.
    ``by``: a column with few values that the files are dealt by (see ``drop_part``).
    ``distinct``: columns (list elements as ``name.list.element``) that hold hardly a value twice, so
    that no dictionary of them is tried.
    """
    path = work_path(df.sparkSession, name)
    write = df.write.options(**{f"parquet.enable.dictionary#{c}": "false" for c in distinct})
    with setting(df.sparkSession, SHUFFLE_CLEANUP, "true") if free_shuffles else nullcontext():
        # files of all values are written side by side, so the rows are not sorted for it
        with setting(df.sparkSession, FILES_AT_ONCE, "16") if by else nullcontext():
            (write.partitionBy(by) if by else write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def drop_part(df: DataFrame, by: str, value: int) -> None:
    """Delete the files with one value of the column that ``stored`` dealt a table by; filter it out from then on."""
    _delete(df, f"{df._stored_path}/{by}={value}")


def drop_stored(df: DataFrame | None) -> None:
    """Delete the files behind a table made by ``stored`` (a finished round's)."""
    path = getattr(df, "_stored_path", None)
    if path is not None:
        _delete(df, path)


def _delete(df: DataFrame, path: str) -> None:
    sc = df.sparkSession.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (a let-binding)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def salts_for(rows: int, per_salt: int = 200_000) -> int:
    """Salt count that keeps about ``per_salt`` rows in each (key, salt) group."""
    return max(8, -(-rows // per_salt))


def gapless_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str,
                 salts: int) -> DataFrame:
    """Ranks 0, 1, 2, ... without gaps among the rows of each key.

    A key may hold any share of the rows: it is ranked in ``salts`` hash parts,
    and each part's ranks start after the sizes of the parts before it. Only
    one row per (key, part) meets in a task. ``df`` is read twice, so it has to
    be a stored table or a deterministic plan. Null keys are not allowed.
    """
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(F.lit(f"salt of {out}"), *order), F.lit(salts)))
    by = [*keys, "__salt"]
    before = Window.partitionBy(*keys).orderBy("__salt").rowsBetween(
        Window.unboundedPreceding, -1)
    parts = (salted.groupBy(*by).agg(F.count("*").alias("__n"))
             .select(*by, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")))
    local = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    return (salted.withColumn("__local", local).join(parts, by)
            .withColumn(out, F.col("__before") + F.col("__local"))
            .drop("__salt", "__local", "__before"))


def bounded_batches(spark: SparkSession, size: str = "16m") -> None:
    """Bound Arrow batches by bytes too, so that a batch of very long texts stays small."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, size)
