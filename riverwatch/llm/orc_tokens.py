"""Token ids in ORC files: sorted by document, with row indexes and Bloom filters."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverwatch.llm.common import bounded_batches, table
from riverwatch.llm.tokens import default_path, encoder
from riverwatch.session import work_path

END_ID = 0
#: Integers are run-length encoded by the format itself. Stripes of this size are read in
#: parallel; a row index entry each 1,000 rows and the Bloom filters let a search for a
#: document skip stripes and row groups by metadata.
ORC_OPTIONS = {
    "orc.compress": "ZSTD",
    "orc.stripe.size": str(32 << 20),
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def write_token_orc(docs: DataFrame, path: str, tokenizer: str | None = None,
                    end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write (doc_id, part, local_start, n_tokens, tokens) in ascending doc_id order.

    The documents are range-partitioned and sorted by id before they are
    encoded, so only texts are shuffled. ``part`` numbers the ranges in order
    and ``local_start`` counts the ids before a document in its part. Rows of
    one id stay in the order of the input and may spread over several parts.

    Nulls: a null text is empty (``end_id`` alone); null ids come first. An
    empty table gives files without rows. Other columns are not read.
    """
    tok = tokenizer or default_path()
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = encoder(tok), TaskContext.get().partitionId(), 0
        for b in batches:
            data = [enc.ids(t or "") + end for t in b.column(1).to_pylist()]
            n = np.array([len(d) // 4 for d in data], dtype=np.int64)
            ends = np.cumsum(n)
            values = pa.array(np.frombuffer(b"".join(data), dtype="<i4"))
            offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
            yield pa.record_batch(
                [b.column(0), pa.array(np.full(len(n), part, dtype=np.int32)),
                 pa.array(at + ends - n), pa.array(n),
                 pa.ListArray.from_arrays(offsets, values)],
                names=["doc_id", "part", "local_start", "n_tokens", "tokens"])
            at += int(n.sum())

    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                        F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "row"]
    rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    rows.mapInArrow(
        run, f"doc_id {kind}, part int, local_start long, n_tokens long, tokens array<int>"
    ).write.options(**ORC_OPTIONS).orc(path)


def part_starts(rows: DataFrame) -> DataFrame:
    """(part, before): the ids in all parts before; one row for each file is summed and ordered."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def read_token_orc(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows plus ``start``: the ids of all documents before this one."""
    rows = spark.read.orc(path)
    return rows.join(part_starts(rows), "part").withColumn(
        "start", F.col("before") + F.col("local_start")).drop("before")


def token_digest(rows: DataFrame) -> DataFrame:
    """(doc_id, part, local_start, n_tokens, ids_crc32) of rows of the files."""
    bounded_batches(rows.sparkSession)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(3)
            at = lists.offsets.to_numpy()
            ids = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<u4")
            crc = [zlib.crc32(ids[s:e]) for s, e in zip(at[:-1], at[1:])]
            yield pa.record_batch(
                [*b.columns[:3], pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "part", "local_start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "part", "local_start", "tokens").mapInArrow(
        run, f"doc_id {kind}, part int, local_start long, n_tokens long, ids_crc32 long")


def op10_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "token-orc")
    write_token_orc(table(spark, sf_dir, "documents"), path)
    rows = spark.read.orc(path)
    return token_digest(rows).join(part_starts(rows), "part").select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
