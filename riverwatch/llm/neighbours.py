"""Nearest neighbours by a block matrix join with int8 tiles and error bounds.

Queries and candidates are cut into blocks; each pair of blocks is one task
of a Spark join. A tile's int8 products give every cosine up to a bound that is
known exactly; what the bounds cannot rule out is computed anew in double
precision from the original vectors. The result is that of brute force.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverwatch.llm.common import stored, table

NEAREST = 5
QUERY_BLOCK = 4096
BLOCK = 4096
PANEL = 1024    # dimensions of one product: 1024 * 127^2 is exact in float32
ROUNDING = 1e-9  # more than the rounding of the bounds and scores themselves


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of two double matrices; sums run over the dimensions in order."""
    dot, aa, bb = (np.zeros(len(a)) for _ in range(3))
    for k in range(a.shape[1]):
        x, y = a[:, k], b[:, k]
        dot += x * y
        aa += x * x
        bb += y * y
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, scales, norms of the scaled rows, and norms of what the rounding lost.

    The rows stand for unit vectors: unit = scale * int8 + loss.
    """
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    near = q * scale[:, None]
    return (q, scale, np.sqrt((near * near).sum(axis=1)),
            np.sqrt(((unit - near) ** 2).sum(axis=1)))


def tile_survivors(queries: np.ndarray, rows: np.ndarray, same: np.ndarray, k: int):
    """(query index, row index) of the pairs that may be among a query's ``k`` nearest.

    ``same``: marks pairs that don't count. With p the product of the int8 rows,
    the cosine lies within |near_a| * loss_b + loss_a * |near_b| + loss_a * loss_b
    of scale_a * scale_b * p. A pair whose upper bound is below the k-th largest
    lower bound of its query is ruled out.
    """
    return _survivors(quantised(queries), quantised(rows), same, k)


def _survivors(queries: tuple, rows: tuple, same: np.ndarray, k: int):
    """``tile_survivors`` of rows that are quantised already."""
    qa, sa, na, la = queries
    qb, sb, nb, lb = rows
    product = np.zeros((len(qa), len(qb)))
    for at in range(0, qa.shape[1], PANEL):
        product += qa[:, at:at + PANEL].astype(np.float32) @ qb[:, at:at + PANEL].astype(np.float32).T
    product *= sa[:, None]
    product *= sb[None, :]
    error = np.multiply.outer(na, lb) + np.multiply.outer(la, nb + lb) + ROUNDING
    lower = np.where(same, -np.inf, product - error)
    if lower.shape[1] > k:
        floor = np.partition(lower, lower.shape[1] - k, axis=1)[:, lower.shape[1] - k]
    else:
        floor = np.full(len(qa), -np.inf)
    return np.nonzero((product + error >= floor[:, None]) & ~same)


def _nearest_in_tile(queries: pa.Table, rows: pa.Table, k: int) -> list[tuple]:
    def matrix(t: pa.Table) -> np.ndarray:
        v = t["vec"].combine_chunks()
        return v.values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(v), -1)

    found: list[tuple] = []
    a_all, a_ids = matrix(queries), queries["vec_id"].to_numpy()
    b, b_ids = matrix(rows), rows["vec_id"].to_numpy()
    small_a, small_b = quantised(a_all), quantised(b)  # once for the tile
    for at in range(0, len(a_all), 256):  # bounds the product matrix
        a, ids = a_all[at:at + 256], a_ids[at:at + 256]
        i, j = _survivors(tuple(x[at:at + 256] for x in small_a), small_b, ids[:, None] == b_ids[None, :], k)
        score = np.concatenate([cosines(a[i[s:s + 65536]], b[j[s:s + 65536]])
                                for s in range(0, len(i), 65536)]) if len(i) else np.zeros(0)
        cuts = np.searchsorted(i, np.arange(len(a) + 1))
        for n, (s, e) in enumerate(zip(cuts[:-1], cuts[1:])):
            for minus, vec_id in heapq.nsmallest(k, zip((-score[s:e]).tolist(), b_ids[j[s:e]].tolist())):
                found.append((int(ids[n]), vec_id, -minus))
    return found


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, dim, vec) of the vectors that take part: finite, not null, not all zero."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return vectors.filter(F.col(id_col).isNotNull() & v.isNotNull() & ~bad & some).select(
        F.col(id_col).cast("long").alias("vec_id"), F.size(v).alias("dim"),
        v.alias("vec"))


def nearest(vectors: DataFrame, is_query, k: int = NEAREST, query_block: int = QUERY_BLOCK,
            block: int = BLOCK, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest cosines of each query, ties to smaller ids.

    ``is_query``: a condition on ``vec_id``. Candidates are all rows with
    another id and as many dimensions. Rows go to blocks by hash; a query block
    is sent to every candidate block and the reverse, each pair of blocks is
    one group, and a group keeps its k best for each query in a heap. The
    partial results are merged by rank, which Spark limits before its shuffle.

    Nulls: rows with null ids, and vectors null, zero or holding null or
    non-finite components take no part. Of rows with one id and one vector
    only one counts; a query with fewer than k candidates returns them all.
    Empty tables give no rows; other columns are not read.
    """
    rows = stored(usable(vectors, id_col, vec_col).dropDuplicates(["vec_id", "vec"]), "vectors")
    queries = rows.filter(is_query)
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    n_rows, n_queries = -(-sizes["n"] // block) or 1, -(-sizes["q"] // query_block) or 1

    def dealt(df: DataFrame, own: int, other: int, names: tuple[str, str]) -> DataFrame:
        return df.select("*", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(own)).cast("int")
                         .alias(names[0]), F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(names[1]))

    left = dealt(queries, n_queries, n_rows, ("qb", "rb")).groupBy("dim", "qb", "rb")
    right = dealt(rows, n_rows, n_queries, ("rb", "qb")).groupBy("dim", "qb", "rb")

    def tile(a: pa.Table, b: pa.Table) -> pa.Table:
        got = _nearest_in_tile(a, b, k) if a.num_rows and b.num_rows else []
        cols = list(zip(*got)) or [(), (), ()]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64())})

    partial = left.cogroup(right).applyInArrow(tile, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


_DOUBLES = "CAST(embedding AS DOUBLE[])"
ORACLE = f"""
WITH v AS (
  SELECT vec_id, {_DOUBLES} AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter({_DOUBLES}, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter({_DOUBLES}, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_dot_product(q.e, c.e)
           / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
           AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= {NEAREST}
"""
