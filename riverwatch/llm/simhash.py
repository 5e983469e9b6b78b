"""SimHash near-duplicates by covering locality-sensitive hashing.

A covering family of bit masks (structured, not sampled) makes every pair of
fingerprints within the radius agree on all bits of at least one mask, so no
pair within the radius is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverwatch.llm.common import bounded_batches, free_name, stored, table
from riverwatch.llm.components import components

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
PART = 1 << 15   # shingles whose bits are unpacked at once
BLOCK = 2048     # fingerprints of one bucket in one block; larger buckets go by pairs of blocks


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of the XXH64 of word shingles; 0 for a text without words.

    ASCII letters are lowered and words split at ASCII white space. A bit is
    1 if it is set in over half the hashes, repeats included.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, PART):
        part = words[at:at + PART + shingle - 1]
        grams = zip(*(part[i:] for i in range(shingle))) if len(words) >= shingle else [words]
        h = np.fromiter((xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams), dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(sum(1 << int(i) for i in np.flatnonzero(2 * counts > n)))


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp): fp is the fingerprint as a signed 64-bit number.

    A null text counts as empty; ``text_hash`` tells rows of one id apart.
    """
    bounded_batches(docs.sparkSession)  # texts may be very long
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).cast(pa.binary())
            fps = np.array([fingerprint(t.as_py(), shingle) for t in texts], dtype=np.uint64)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(fps.view(np.int64))],
                                  names=["id", "text_hash", "fp"])

    return docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, text_hash long, fp long")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 masks; two numbers within ``radius`` bits agree under one of them.

    Bit i gets a non-zero vector m(i) of radius+1 bits, and mask v holds the
    bits with odd <m(i), v>. The vectors of ``radius`` bits span a proper
    subspace, so some v is orthogonal to them all: its mask leaves them out.
    """
    count = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(bits) if ((1 + i % count) & v).bit_count() % 2)
            for v in range(1, count + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Edges (fingerprint, root) that join what lies within ``radius`` among ``fps``.

    A search takes one member after the other and compares it with the
    members that are not reached yet, so a dense group is settled quickly.
    """
    left = np.unique(fps)
    while len(left):
        root, left = left[0], left[1:]
        todo = [root]
        while todo and len(left):
            near = np.bitwise_count(left ^ todo.pop()) <= radius
            for x in left[near]:
                yield int(x), int(root)
                todo.append(x)
            left = left[~near]


def near_edges(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges (u, v) that connect exactly what chains of pairs within ``radius`` connect.

    ``fps``: a stored table with the distinct fingerprints, column ``fp``. The
    fingerprints are put into one bucket for each mask. Buckets of two are
    settled by their least and largest member. Larger ones are gathered by
    block, and those over ``block`` by pairs of hash blocks, so that a task
    never holds more than about two blocks; every pair of a bucket meets, but
    only a spanning forest is emitted.
    """
    masks = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(_signed(m)).alias("m"))
                      for i, m in enumerate(covering_masks(radius))])
    keyed = fps.select("fp", F.explode(masks).alias("s")).select(
        "fp", F.xxhash64("s.t", F.col("fp").bitwiseAND(F.col("s.m"))).alias("key"))
    sized = stored(keyed.groupBy("key").agg(
        F.count("*").alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v"))
        .filter("n > 1"), "simhash-buckets")
    pairs = sized.filter("n = 2").select("u", "v").filter(
        F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)

    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
    met = (keyed.join(sized.filter("n > 2").select("key", blocks.alias("blocks")), "key")
           .withColumn("own", own)
           .select("key", "fp", F.explode(F.transform(
               F.sequence(F.lit(0), F.col("blocks") - 1),
               lambda o: F.struct(F.least(o, F.col("own")).alias("i"),
                                  F.greatest(o, F.col("own")).alias("j")))).alias("pair")))
    groups = met.groupBy("key", "pair").agg(F.collect_list("fp").alias("fps")).select("fps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            edges = set()
            for row in b.column(0):
                members = row.values.to_numpy(zero_copy_only=False).view(np.uint64)
                edges.update(_forest(members, radius))
            found = np.array(sorted(edges), dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])],
                                  names=["u", "v"])

    return pairs.unionByName(groups.mapInArrow(run, "u long, v long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp, root, component_id) for each row of ``docs``.

    Rows link when their fingerprints differ in ``radius`` bits or fewer;
    ``component_id`` is the smallest id reachable, a row's own
    included, and ``root`` the component's smallest fingerprint.

    Nulls: a null or empty text, or one without words, has fingerprint zero
    and is linked like any other; null ids are carried along and are never
    the smallest id, unless a component has no other. Repeated rows give
    repeated result rows. An empty table gives an empty result. Other columns
    are not read. Copies collapse to one fingerprint before any comparison.
    """
    rows = stored(with_fingerprints(docs, shingle, id_col, text_col), "simhash")
    each = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    rooted = components(near_edges(each.select("fp"), radius))
    joined = each.join(rooted, each.fp == rooted.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = joined.join(least, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("id", "text_hash", "fp", "root", "component_id")


def first_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each near-duplicate group: that with the smallest doc_id.

    Of rows that share this doc_id the one with the smallest text hash stays,
    once if it is repeated. A group whose doc_ids are all null keeps one row.
    """
    found = near_duplicates(docs, shingle, radius)
    first = found.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("k"))
    name, mark = free_name(docs, "__key"), free_name(docs, "__hash")
    key = _row_key(F.col("k.id"))
    keep = first.select(key.alias(name), F.col("k.text_hash").alias(mark))
    keyed = docs.withColumn(name, _row_key(F.col("doc_id"))).withColumn(
        mark, F.xxhash64("text"))
    return keyed.join(keep, [name, mark], "left_semi").dropDuplicates([name, mark]).select(
        *docs.columns)


def _row_key(id_: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), id_.cast("string")), F.lit("null"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"),
                        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")
