"""Line dedup over levelled sorted runs of line hashes, with built-ins only.

The keys of all lines seen so far lie in runs: tables bucketed and sorted by the
line's hash. A new batch of documents is reduced to one row for each key, is
merge-anti-joined with one run after the other, and what is left is written as a run
of its own. Runs of one level are merged into one of the next, so there are few.
All tables of keys have the same buckets, so these joins shuffle nothing.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverwatch.llm.common import WHITE, bind, drop_stored, stored, table
from riverwatch.session import work_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 10
FANOUT = 2             # runs of one level that are merged into one of the next
BATCHES = 4            # batches into which a whole table is cut
BUCKET_DOCS = 50_000   # documents for each bucket of the runs
HOT = 1024             # a key with more than one in so many lines of a batch is hot


def lower_ascii(text: Column) -> Column:
    """A-Z lowered and nothing else. ``lower`` does that to texts of ASCII alone."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def find_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, row, at, key) for each line whose key has ``min_chars`` characters or more.

    ``key`` is the MD5 of the trimmed and lowered line, 128 bits; ``row`` is a hash of the text, so that
    (id, row) names a row and its copies.
    """
    each = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"),
                       F.posexplode(lines_of(F.col(text_col))).alias("at", "line"))
    trimmed = each.select("id", "row", "at", F.btrim("line", F.lit(WHITE)).alias("line")).filter(
        F.length("line") >= min_chars)
    return trimmed.select("id", "row", "at", F.unhex(F.md5(lower_ascii(F.col("line")))).alias("key"))


class LineRuns:
    """The levelled runs of all keys that ``add`` has been given.

    ``buckets``: into how many sorted files a run goes; set it once, for the
    size the runs will have. The runs are tables below ``spark.checkpoint.dir``.
    """

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = FANOUT, min_chars: int = MIN_CHARS):
        self.spark, self.buckets, self.fanout, self.min_chars = spark, buckets, fanout, min_chars
        self.runs: list[tuple[int, DataFrame]] = []  # (level, table)

    def _written(self, df: DataFrame) -> DataFrame:
        """``df`` as a table in buckets, sorted by key."""
        name = f"line_run_{uuid.uuid4().hex}"
        path = work_path(self.spark, "line-runs")
        (df.repartition(self.buckets, "key").sortWithinPartitions("key").write
         .bucketBy(self.buckets, "key").sortBy("key").option("path", path).saveAsTable(name))
        out = self.spark.table(name)
        out._stored_path, out._run_name = path, name
        return out

    def _dropped(self, run: DataFrame) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run._run_name}")
        drop_stored(run)

    def _compact(self) -> None:
        level = 0
        while True:
            own = [r for n, r in self.runs if n == level]
            if len(own) >= self.fanout:
                merged = self._written(reduce(DataFrame.unionByName, own))
                self.runs = [(n, r) for n, r in self.runs if n != level] + [(level + 1, merged)]
                for r in own:
                    self._dropped(r)
            elif not any(n > level for n, _ in self.runs):
                return
            level += 1

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, row, lines): the numbers of the lines to drop in each document of the batch.

        A line goes if an earlier batch holds its key, or if a smaller id of this
        batch does. The batch's keys are in the runs afterwards.
        """
        self._compact()
        lines = stored(find_lines(docs, id_col, text_col, self.min_chars), "line-keys")
        # hot keys are absorbed before the shuffle
        own = self._written(lines.groupBy("key").agg(
            F.min("id").alias("least"), F.max("id").alias("most"),
            F.max(F.col("id").isNull()).alias("null_too"), F.count("*").alias("n")))
        new = own
        for _, run in self.runs:
            new = new.join(run.select("key").hint("merge"), "key", "left_anti")
        fresh = self._written(new)
        held = own.join(fresh.select("key").hint("merge"), "key", "left_anti")
        more = (F.col("least") < F.col("most")) | (F.col("null_too") & F.col("least").isNotNull())
        repeats = stored(
            held.select("key", F.lit(True).alias("held"), "least", "n").unionByName(
                fresh.filter(more).select("key", F.lit(False).alias("held"), "least", "n")), "line-repeats")
        out = stored(self._decided(lines, repeats), "line-drops")
        self.runs.append((0, fresh))
        self._dropped(own)
        for done in (lines, repeats):
            drop_stored(done)
        return out

    def _decided(self, lines: DataFrame, repeats: DataFrame) -> DataFrame:
        total = lines.count()
        hot = F.col("n") * HOT > total  # HOT keys at most, so a small side
        few, many = repeats.filter(hot), repeats.filter(~hot)
        goes = F.col("held") | ~F.col("id").eqNullSafe(F.col("least"))
        found = lines.join(F.broadcast(few), "key").unionByName(lines.join(
            F.broadcast(few.select("key")), "key", "left_anti").join(many.hint("merge"), "key"))
        return found.filter(goes).groupBy("id", "row").agg(F.collect_set("at").alias("lines"))  # of one text

    def close(self) -> None:
        """Delete the runs."""
        for _, run in self.runs:
            self._dropped(run)
        self.runs = []


def without_lines(docs: DataFrame, drops: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped`` beside their columns."""
    keyed = docs.drop("kept_text", "n_lines", "n_dropped")
    own = [F.col(c) for c in keyed.columns]
    left = keyed.select(F.struct(*own).alias("doc"), F.col(id_col).alias("id"),
                        F.xxhash64(text_col).alias("row")).alias("l")
    right = drops.alias("r")
    both = left.join(right, F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.row") == F.col("r.row")), "left")
    text = F.col("doc").getField(text_col)
    parts = lines_of(text)
    kept = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("lines")))
    joined = both.select(
        "doc", F.size(parts).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("lines").isNull(), F.coalesce(text, F.lit(""))).otherwise(
            F.array_join(bind(parts, lambda p: F.transform(kept, lambda i: F.get(p, i))), "\n")).alias("kept_text"))
    return joined.select("doc.*", "kept_text", "n_lines", "n_dropped")


def dedup_lines(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS,
                id_col: str = "doc_id", text_col: str = "text", fanout: int = FANOUT) -> DataFrame:
    """``docs`` without the lines that a document of a smaller id holds too.

    A line's key is the line without ASCII white space at its ends, A-Z lowered. Keys of
    ``min_chars`` characters or more that two ids or more hold stay in the smallest id alone, with all
    their lines there. Adds ``kept_text`` (the other lines joined by newlines),
    ``n_lines`` (before) and ``n_dropped``.

    The table is cut into ``batches`` of ascending ids at approximate quantiles (ids that
    are no numbers make one batch), each of which is added to the runs. Keys equal by
    MD5 count as equal.

    Nulls: a null text is one empty line. Rows with a null id count as one document behind all
    others. Rows that share an id are one document: none of its lines repeat each other. Repeated rows have equal
    results. Empty tables stay empty. Columns of ``docs`` named like an added one are replaced.
    """
    spark = docs.sparkSession
    numeric = isinstance(docs.schema[id_col].dataType, T.NumericType)
    cuts = [i / batches for i in range(1, batches)] if numeric else []
    bounds = F.percentile_approx(id_col, cuts or [0.5], 1000) if numeric else F.lit(None)
    n, at = docs.agg(F.count("*"), bounds).first()
    runs = LineRuns(spark, max(8, -(-n // BUCKET_DOCS)), fanout, min_chars)
    id_, edges = F.col(id_col), sorted(set(at or [])) if cuts else []
    drops = None
    for i in range(len(edges) + 1):
        own = F.lit(True)
        if i > 0:
            own = own & (id_.isNull() | (id_ > edges[i - 1]) if i == len(edges) else id_ > edges[i - 1])
        if i < len(edges):
            own = own & (id_ <= edges[i])
        part = runs.add(docs.filter(own), id_col, text_col)
        drops = part if drops is None else drops.unionByName(part)
    runs.close()
    return without_lines(docs, drops, id_col, text_col)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          '{UPPER}', '{LOWER}') AS key FROM l),
r AS (SELECT key, min(doc_id) AS least FROM k WHERE length(key) >= {MIN_CHARS}
      GROUP BY key HAVING count(DISTINCT doc_id) > 1)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE least IS NOT NULL AND doc_id <> least) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE least IS NULL OR doc_id = least), '')) AS kept_sha256
FROM k LEFT JOIN r USING (key) GROUP BY doc, doc_id
"""
