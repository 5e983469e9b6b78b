"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverwatch.llm.common import drop_stored, stored


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, root) for every node of ``edges``; the root is the smallest node of its component.

    Each round is a pair of aggregations and joins on node keys; the edges
    never leave the executors. A round's edges are written to the shared
    folder, so that a lost executor repeats one round at most. Minima are
    pre-aggregated before the shuffle, and a join with a hot node is an
    ordinary sort-merge join that Spark can split. Null ends and loops are
    ignored; no edges give no rows.
    """
    a, b = F.col(left), F.col(right)
    now = stored(edges.filter(a.isNotNull() & b.isNotNull() & (a != b))
                 .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
                 "components")
    seen = _signature(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")).select(
            "n", F.least("n", "m").alias("m"))
        large = (now.join(low, now.v == low.n).select("u", F.col("m").alias("v"))
                 .distinct())
        low = large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        small = large.join(low, large.u == low.n).filter(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(small.unionByName(low.select(F.col("n").alias("u"), F.col("m").alias("v")))
                       .distinct(), "components")
        signature = _signature(after)
        drop_stored(now)
        now = after
        if signature == seen:
            break
        seen = signature
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
