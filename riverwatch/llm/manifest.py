"""Merkle manifest of a dataset, with proofs folded from retained SHA-256 midstates.

Rows are leaves of a tree for each source, and the sources' roots are leaves of
one more. A parent keeps a copy of its hash state before each child; folding a
changed leaf resumes the state before the changed child and feeds it the
replacement and the children right of it only.

Trees are cut into blocks of ``FAN ** LEVELS`` nodes. Going up, a block gives its
top node, and the top nodes of all blocks are the next table of nodes. Going down,
each block is sent the path above its top node. A task holds one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverwatch.llm.common import stored, table

FAN = 3
LEVELS = 7  # levels in a block: 2187 nodes at most
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NULL = "-"


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels, size = 0, 1
    while size < n:
        levels, size = levels + 1, size * FAN
    return levels


class Block:
    """Some levels of a tree above consecutive nodes, with the hash states of its parents.

    ``nodes``: digests as hex bytes. ``levels``: how many levels to build; the
    last run of a level may be short, also one node long.
    """

    def __init__(self, nodes: list[bytes], levels: int):
        self.rows, self.states = [nodes], []
        for _ in range(levels):
            below, parents, kept = self.rows[-1], [], []
            for at in range(0, len(below), FAN):
                state = hashlib.sha256()
                for child in below[at:at + FAN]:
                    kept.append(state.copy())  # the state before this child
                    state.update(child)
                parents.append(state.hexdigest().encode())
            self.states.append(kept)
            self.rows.append(parents)

    @property
    def top(self) -> bytes:
        return self.rows[-1][0]

    def right(self, level: int, i: int) -> bytes:
        return b"".join(self.rows[level][i + 1:(i // FAN + 1) * FAN])

    def siblings(self, level: int, i: int) -> bytes:
        return b"".join(self.rows[level][i // FAN * FAN:i]) + self.right(level, i)

    def proofs(self, above: bytes) -> list[bytes]:
        """For each node all siblings up to the top, followed by ``above``."""
        known = [above]
        for level in range(len(self.states) - 1, -1, -1):
            known = [self.siblings(level, i) + known[i // FAN] for i in range(len(self.rows[level]))]
        return known

    def fold(self, i: int, digest: bytes) -> bytes:
        """The top if node ``i`` were ``digest``."""
        for level, kept in enumerate(self.states):
            state = kept[i].copy()
            state.update(digest)
            state.update(self.right(level, i))
            digest, i = state.hexdigest().encode(), i // FAN
        return digest

    def path(self, i: int) -> list[tuple[int, bytes]]:
        """(place among its siblings, all children of the parent) for each level up to the top."""
        out = []
        for level in range(len(self.states)):
            at = i // FAN * FAN
            out.append((i - at, b"".join(self.rows[level][at:at + FAN])))
            i //= FAN
        return out


class Above:
    """The path from a block's top to the root, its hash states made once for the block."""

    def __init__(self, slots: Sequence[int], children: Sequence[str]):
        self.steps, proof = [], []
        for slot, text in zip(slots, children):
            all_ = text.encode()
            left, right = all_[:64 * slot], all_[64 * (slot + 1):]
            self.steps.append((hashlib.sha256(left), right))
            proof.append(left + right)
        self.proof = b"".join(proof)

    def fold(self, digest: bytes) -> bytes:
        for before, right in self.steps:
            state = before.copy()
            state.update(digest)
            state.update(right)
            digest = state.hexdigest().encode()
        return digest


def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit(NULL)).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(_encoded, values)), 256)


def ordered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` plus ``idx``, the place in the order within each ``tree``, and ``n``, the tree's leaves.

    Sorted by ranges and written; a row's place is its place in its file plus the
    tree's rows in earlier files, so a tree may hold any share of the rows.
    """
    by = ["tree", *order]
    written = stored(leaves.repartitionByRange(*by).sortWithinPartitions(*by), "merkle-leaves")
    placed = written.select("*", F.col("_metadata.file_path").alias("file"),
                            F.col("_metadata.row_index").alias("at"))
    files = Window.partitionBy("tree").orderBy("first")
    parts = stored(placed.groupBy("tree", "file").agg(  # a row for each file, and for each tree in it
        F.min(F.struct(*order)).alias("first"), F.min("at").alias("low"), F.count("*").alias("own")).select(
        "tree", "file", "low",
        F.coalesce(F.sum("own").over(files.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("own").over(Window.partitionBy("tree")).alias("n")), "merkle-parts")
    return placed.join(parts, ["tree", "file"]).withColumn(
        "idx", F.col("at") - F.col("low") + F.col("before")).drop("file", "at", "low", "before")


def _block(levels: int) -> Column:
    return F.floor(F.col("idx") / F.lit(FAN ** levels)).cast("long").alias("block")


def _built(t: pa.Table, round_: int, levels: int) -> tuple[pa.Table, Block]:
    t = t.take(pa.array(np.argsort(t["idx"].to_numpy())))
    left = height(t["n"][0].as_py()) - levels * round_
    return t, Block([x.encode() for x in t["hash"].to_pylist()], max(0, min(levels, left)))


def fold_up(nodes: DataFrame, round_: int, levels: int) -> DataFrame:
    """(tree, idx, n, hash): the top nodes of all blocks."""
    def top(key: tuple, t: pa.Table) -> pa.Table:
        t, block = _built(t, round_, levels)
        return pa.table({"tree": t["tree"].slice(0, 1), "idx": pa.array([key[1].as_py()], pa.int64()),
                         "n": t["n"].slice(0, 1), "hash": [block.top.decode()]})

    return nodes.select("tree", "idx", "n", "hash").groupBy("tree", _block(levels)).applyInArrow(
        top, "tree string, idx long, n long, hash string")


def tops(nodes: DataFrame, rounds: int, levels: int) -> list[DataFrame]:
    """The tables of nodes from the leaves to the trees' roots, each stored."""
    out = [nodes]
    for r in range(rounds):
        out.append(stored(fold_up(out[-1], r, levels), "merkle-nodes"))
    return out


def _rounds(nodes: DataFrame, levels: int) -> int:
    most = nodes.agg(F.max("n")).first()[0] or 0
    return max(1, -(-height(most) // levels))


PATH = "slots array<int>, children array<string>, subroot string"


def paths_down(nodes: DataFrame, above: DataFrame, round_: int, levels: int) -> DataFrame:
    """(tree, idx, slots, children, subroot): each node's path to the root.

    ``above``: the same for the blocks' top nodes.
    """
    def down(t: pa.Table, up: pa.Table) -> pa.Table:
        t, block = _built(t, round_, levels)
        slots, children = up["slots"][0].as_py(), up["children"][0].as_py()
        own = [block.path(i) for i in range(t.num_rows)]
        return pa.table({
            "tree": t["tree"], "idx": t["idx"],
            "slots": pa.array([[s for s, _ in p] + slots for p in own], pa.list_(pa.int32())),
            "children": pa.array([[c.decode() for _, c in p] + children for p in own], pa.list_(pa.string())),
            "subroot": pa.array([up["subroot"][0].as_py()] * t.num_rows, pa.string())})

    return nodes.select("tree", "idx", "n", "hash").groupBy("tree", _block(levels)).cogroup(
        above.withColumn("block", F.col("idx")).groupBy("tree", "block")).applyInArrow(
        down, f"tree string, idx long, {PATH}")


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS,
             id_col: str = "doc_id", tree_col: str = "source", replaced: Column | None = None,
             text_col: str = "text", levels: int = LEVELS) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) for each row of ``docs``.

    A leaf is the SHA-256 of the row's ``fields``, each as its UTF-8 length, a colon and its text, or ``-``
    if null. In each tree (value of ``tree_col``) leaves ascend by id; every
    three consecutive nodes become the hash of their digests until one is left. These subroots, in
    order of their tree (null first, then by bytes), make the root in the same way.
    ``proof_sha256`` is the hash of a leaf's siblings up to the root. ``replaced``: the text
    as it is found at a later check; ``folded_root`` is the root with this row's leaf made from it
    and the original siblings, ``verified`` whether that is the root.

    Nulls: null ids come first, a null tree value is a tree of its own before all
    others. Rows that share an id are leaves of their own, ordered by digest;
    rows repeated as a whole are too. A tree of one leaf has it as its subroot. An empty
    table gives no rows. Other columns are not read; texts are hashed whole, in the JVM.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    later = F.col(text_col) if replaced is None else replaced
    leaf = leaf_digest([F.col(c) for c in fields])
    other = leaf_digest([later if c == text_col else F.col(c) for c in fields])
    leaves = stored(docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit(NULL)).alias("tree"),
        F.col(id_col).alias("id"), leaf.alias("hash"),
        F.when(~later.eqNullSafe(F.col(text_col)), other).alias("other")), "merkle-rows")
    nodes = ordered(leaves.withColumn("row", F.monotonically_increasing_id()), ["id", "hash", "row"])
    up = tops(nodes, _rounds(nodes, levels), levels)

    # the subroots as leaves of one tree: "-" stands before "=", and strings compare by bytes
    subroots = up[-1].select(F.lit("").alias("tree"), F.col("tree").alias("id"), "hash")
    trees = stored(ordered(subroots, ["id"]), "merkle-trees")
    over = tops(trees, _rounds(trees, levels), levels)
    root = (over[-1].select("hash").first() or [None])[0]
    none = spark.range(1).select(F.lit("").alias("tree"), F.lit(0).cast("long").alias("idx"),
                                 F.array().cast("array<int>").alias("slots"),
                                 F.array().cast("array<string>").alias("children"),
                                 F.lit(None).cast("string").alias("subroot"))
    for r in range(len(over) - 2, -1, -1):
        none = paths_down(over[r], none, r, levels)
    above = stored(none.drop("tree", "subroot").join(trees.select("idx", F.col("id").alias("tree"),
                                                                  F.col("hash").alias("subroot")), "idx")
                   .withColumn("idx", F.lit(0).cast("long")), "merkle-above")
    for r in range(len(up) - 2, 0, -1):
        above = stored(paths_down(up[r], above, r, levels), "merkle-above")

    def prove(t: pa.Table, upper: pa.Table) -> pa.Table:
        t, block = _built(t, 0, levels)
        path = Above(upper["slots"][0].as_py(), upper["children"][0].as_py())
        proofs = [hashlib.sha256(p).hexdigest() for p in block.proofs(path.proof)]
        leaf_ = t["hash"].to_pylist()
        folded = [path.fold(block.fold(i, (now or was).encode())).decode()
                  for i, (now, was) in enumerate(zip(t["other"].to_pylist(), leaf_))]
        subroot = pa.array([upper["subroot"][0].as_py()] * t.num_rows, pa.string())
        return pa.table({"id": t["id"], "leaf": t["hash"], "subroot": subroot,
                         "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string())})

    proven = nodes.select("tree", "idx", "n", "hash", "id", "other").groupBy("tree", _block(levels)).cogroup(
        above.withColumn("block", F.col("idx")).groupBy("tree", "block")).applyInArrow(
        prove, f"id {kind}, leaf string, subroot string, proof_sha256 string, folded_root string")
    return proven.select("id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256",
                         "folded_root", (F.col("folded_root") == F.lit(root).cast("string")).alias("verified"))


def tampered_text() -> Column:
    """The text without newlines where the CRC-32 of the id's decimals is even."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"), replaced=tampered_text()).withColumnRenamed("id", "doc_id")


def _sql_encoded(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '{NULL}' ELSE strlen({text}) || ':' || {text} END"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_encoded(text if c == "text" else c) for c in FIELDS) + ")"


def _sql_up(name: str, start: str) -> str:
    """All nodes (tree, level, idx, h, n) above the leaves ``start``."""
    return f"""{name} AS (SELECT tree, 0 AS level, idx, h, n FROM {start}
  UNION ALL
  SELECT tree, level + 1, idx // {FAN}, sha256(string_agg(h, '' ORDER BY idx)), (n + {FAN - 1}) // {FAN}
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // {FAN}, n)"""


def _sql_fold(name: str, nodes: str, start: str) -> str:
    """(r, level, idx, h) with each row's digest after so many levels, from ``start`` (r, tree, idx, h)."""
    return f"""{name} AS (SELECT r, tree, 0 AS level, idx, h FROM {start}
  UNION ALL
  SELECT r, w.tree, w.level + 1, w.idx // {FAN},
         sha256(string_agg(CASE WHEN x.idx = w.idx THEN w.h ELSE x.h END, '' ORDER BY x.idx))
  FROM {name} w JOIN {nodes} x ON x.tree = w.tree AND x.level = w.level AND x.idx // {FAN} = w.idx // {FAN}
  WHERE x.n > 1 GROUP BY r, w.tree, w.level, w.idx // {FAN})"""


def _sql_siblings(stage: int, nodes: str, start: str) -> str:
    own = f"s.idx // CAST(pow({FAN}, x.level) AS BIGINT)"
    return f"""SELECT r, {stage} AS stage, x.level, x.idx, x.h FROM {start} s JOIN {nodes} x
  ON x.tree = s.tree AND x.n > 1 AND x.idx // {FAN} = {own} // {FAN} AND x.idx <> {own}"""


_CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: CAST(ascii(c) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
  lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, *,
         CASE WHEN {_CRC32} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS later FROM documents),
leafs AS (SELECT r, doc_id, coalesce('=' || source, '{NULL}') AS tree, {_sql_leaf("text")} AS h,
                 {_sql_leaf("later")} AS later FROM d),
bottom AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h, r) - 1 AS idx,
                  count(*) OVER (PARTITION BY tree) AS n FROM leafs),
{_sql_up("low", "bottom")},
heads AS (SELECT '' AS tree, tree AS own, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n
          FROM low WHERE n = 1),
{_sql_up("high", "heads")},
root AS (SELECT h FROM high WHERE n = 1),
first AS (SELECT r, tree, idx, later AS h FROM bottom),
{_sql_fold("walk", "low", "first")},
ended AS (SELECT r, tree, arg_max(h, level) AS h FROM walk GROUP BY r, tree),
second AS (SELECT r, '' AS tree, heads.idx, ended.h FROM ended JOIN heads ON heads.own = ended.tree),
{_sql_fold("walk2", "high", "second")},
folded AS (SELECT r, arg_max(h, level) AS h FROM walk2 GROUP BY r),
siblings AS ({_sql_siblings(0, "low", "first")} UNION ALL {_sql_siblings(1, "high", "second")}),
proofs AS (SELECT r, string_agg(h, '' ORDER BY stage, level, idx) AS p FROM siblings GROUP BY r)
SELECT doc_id, bottom.h AS leaf, heads.h AS subroot, root.h AS root, sha256(coalesce(p, '')) AS proof_sha256,
       folded.h AS folded_root, folded.h = root.h AS verified
FROM bottom JOIN heads ON heads.own = bottom.tree JOIN folded USING (r) LEFT JOIN proofs USING (r), root
"""
