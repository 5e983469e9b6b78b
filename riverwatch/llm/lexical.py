"""Ranked lexical search by an Aho-Corasick scan over the documents, without a document index.

All terms of the items form one automaton, with a guard at both ends of each
term, so that a match is a whole term of the text. One pass over the documents
counts every term's occurrences; the automaton's outputs are then mapped to the
items that hold the term.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverwatch.llm.common import bounded_batches, stored, table

# What a term is, and the constants of the score.
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WEIGHT_SCALE, TF_SCALE, TF_STEP, NORM = 1000, 1_000_000_000, 1000, 8
LENGTH_PERCENT = 90

K = 10
TERM_BYTES = 4 << 20  # an automaton holds no more bytes of terms than this (a node takes about 50)
ITEMS = 2048          # items scored together
SCORED = 256          # documents scored together
GUARD = " "

#: Bytes of a text to those of its terms: A-Z lowered, what is in no term a guard. Bytes of
#: characters beyond ASCII are all term bytes, so this works on UTF-8.
_TO_TERMS = bytes(
    ord(chr(b).lower()) if chr(b).isalnum() else ord(GUARD) for b in range(128)
) + bytes(range(128, 256))


def terms_of(text: Column) -> Column:
    """The distinct terms of a text as an array; a null text has none."""
    found = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))
    return F.array_distinct(found)


@functools.lru_cache(maxsize=1)
def _automaton(terms: tuple[str, ...]) -> ahocorasick.Automaton:
    """The automaton of the terms, made once in a Python worker."""
    made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, term in enumerate(terms):
        made.add_word(GUARD + term.encode().decode("latin-1") + GUARD, i)
    made.make_automaton()
    return made


def count_terms(text: str | None, automaton: ahocorasick.Automaton) -> tuple[int, Counter]:
    """(terms in the text with repeats, occurrences of each term of the automaton)."""
    plain = (text or "").encode("utf-8", "surrogatepass").translate(_TO_TERMS)
    n = len(plain.split())
    if not n or not len(automaton):
        return n, Counter()
    return n, Counter(map(itemgetter(1), automaton.iter(f"{GUARD}{plain.decode('latin-1')}{GUARD}")))


def scan_documents(docs: DataFrame, terms: list[str], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tf) for each document: its length in terms, and the automaton's counts."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(tuple(terms))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _automaton(shared.value)
        for b in batches:
            n, ids, tfs, ends = [], [], [], [0]
            for text in b.column(1):
                length, counts = count_terms(text.as_py(), made)
                n.append(length)
                ids.extend(counts.keys())
                tfs.extend(counts.values())
                ends.append(len(ids))
            at = pa.array(ends, pa.int32())
            yield pa.record_batch(
                [b.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tfs, pa.int32()))], names=["id", "n", "terms", "tf"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n long, terms array<int>, tf array<int>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Postings:
    """For each term number its weight and the items that hold it."""

    def __init__(self, weights: np.ndarray, starts: np.ndarray, items: np.ndarray, n_items: int):
        self.weights, self.starts, self.items, self.n_items = weights, starts, items, n_items

    def scores(self, terms: np.ndarray, tf: np.ndarray, norms: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Integer scores (documents x items) of documents given by their terms one after the other."""
        n_docs = len(ends) - 1
        doc = np.repeat(np.arange(n_docs), np.diff(ends))
        own = self.weights[terms] * ((TF_SCALE * tf) // (TF_STEP * tf + NORM * norms[doc]))
        times = self.starts[terms + 1] - self.starts[terms]
        at = np.repeat(self.starts[terms] - np.cumsum(times) + times, times) + np.arange(times.sum())
        cell = np.repeat(doc, times) * self.n_items + self.items[at]
        value = np.repeat(own, times)
        most = int(value.max(initial=0)) * max(1, int(np.diff(ends).max(initial=0)))
        if most < 1 << 53:  # sums of doubles are exact up to there
            out = np.bincount(cell, weights=value, minlength=n_docs * self.n_items).astype(np.int64)
        else:
            out = np.zeros(n_docs * self.n_items, dtype=np.int64)
            np.add.at(out, cell, value)
        return out.reshape(n_docs, self.n_items)


class Best:
    """The ``k`` best (score, id) of each item among the documents of one task."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.floor = np.ones(n_items, dtype=np.int64)  # scores of 0 don't count
        self.rows = [np.zeros(0, dtype=np.int64) for _ in range(4)]  # item, score, id is null, id

    def add(self, scores: np.ndarray, none: np.ndarray, ids: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.floor)
        if not len(doc):
            return
        new = (item, scores[doc, item], none[doc], ids[doc])
        item, score, null, id_ = (np.concatenate([a, b]) for a, b in zip(self.rows, new))
        order = np.lexsort((id_, null, -score, item))
        item, score, null, id_ = (x[order] for x in (item, score, null, id_))
        first = np.flatnonzero(np.diff(item, prepend=-1))
        rank = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        self.rows = [x[rank < self.k] for x in (item, score, null, id_)]
        full = rank == self.k - 1
        self.floor[item[full]] = score[full]


def score_documents(hits: DataFrame, postings: Postings, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, score, id): each task's ``k`` best documents of each item."""
    shared = hits.sparkSession.sparkContext.broadcast(postings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        best = Best(own.n_items, k)
        for whole in batches:
            for at in range(0, whole.num_rows, SCORED):
                b = whole.slice(at, SCORED)
                lists = b.column(2)
                ends = lists.offsets.to_numpy().astype(np.int64)
                n = b.column(1).to_numpy()
                none = b.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = b.column(0).fill_null(0).to_numpy()
                best.add(own.scores(
                    lists.flatten().to_numpy().astype(np.int64), b.column(3).flatten().to_numpy().astype(np.int64),
                    100 - LENGTH_PERCENT + (LENGTH_PERCENT * n * n_docs) // n_terms, ends - ends[0]), none, ids)
        item, score, none, ids = best.rows
        yield pa.record_batch([pa.array(item, pa.int32()), pa.array(score, pa.int64()),
                               pa.array(ids, pa.int64(), mask=none.astype(bool))], names=["item", "score", "id"])

    return hits.select(F.col("id").cast("long"), "n", "terms", "tf").filter(F.size("terms") > 0).mapInArrow(
        run, "item int, score long, id long")


def _item_blocks(pairs: DataFrame, term_bytes: int, items: int) -> int:
    """Into how many hash parts the items go, so that each holds so many bytes and items at most."""
    n = 1
    while True:
        part = F.pmod(F.xxhash64("item"), F.lit(n))
        sizes = pairs.groupBy(part.alias("part"), "item").agg(F.sum(F.octet_length("term")).alias("bytes"))
        most = sizes.groupBy("part").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"),
                                         F.max("bytes").alias("one")).agg(
            F.max("bytes").alias("bytes"), F.max("n").alias("n"), F.max("one").alias("one")).first()
        if most["n"] is None or (most["n"] <= items and most["bytes"] <= max(term_bytes, most["one"])):
            return n
        n *= 2


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id",
                   text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                   term_bytes: int = TERM_BYTES, items_at_once: int = ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item.

    Each pass scans the documents with the automaton of a block of items. Its size is
    measured before it is broadcast and is ``term_bytes`` bytes of terms at most; an item with more
    of its own makes a block by itself. One pass serves a set of
    items of a few megabytes, however many documents there are. The counts
    are stored, document frequencies are summed up from them, and each task
    keeps the ``k`` best of each item; these are merged in salted parts and then by item.

    Integer ids. Nulls: a null text has no terms; null document ids rank behind
    all others of equal score; a null item id is an item of its own. Rows with
    one item id are one item with the terms of all of them. Each row of ``docs``
    is a document, repeated ones too, and repeats get ranks of their own. Items
    without terms or without a document that scores have no rows; neither have
    empty tables. Other columns are not read.
    """
    spark = docs.sparkSession
    kind = items.schema[item_col].dataType.simpleString()
    pairs = stored(items.select(F.col(item_col).alias("item"), F.explode(terms_of(F.col(item_text))).alias("term"))
                   .distinct(), "lexical-terms")
    blocks, found = _item_blocks(pairs, term_bytes, items_at_once), None
    for block in range(blocks):
        rows = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()  # of a measured size
        names = list({r.item: None for r in rows})
        terms = sorted({r.term for r in rows})
        hits = stored(scan_documents(docs, terms, id_col, text_col), "lexical-hits")
        n_docs, n_terms = hits.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(terms), dtype=np.int64)
        for r in hits.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row a term
            df[r.t] = r["count"]
        number, place = {t: i for i, t in enumerate(terms)}, {x: i for i, x in enumerate(names)}
        links = np.array(sorted((number[r.term], place[r.item]) for r in rows), dtype=np.int64).reshape(-1, 2)
        postings = Postings(np.array([weight(n_docs, int(x)) for x in df], dtype=np.int64),
                            np.searchsorted(links[:, 0], np.arange(len(terms) + 1)), links[:, 1], len(names))
        named = spark.createDataFrame(list(enumerate(names)), f"item int, name {kind}")
        part = score_documents(hits, postings, n_docs, max(1, n_terms), k)
        order = [F.desc("score"), F.asc_nulls_last("id")]
        part = part.withColumn("salt", F.pmod(F.xxhash64("id", "score"), F.lit(64)))
        for by in (["item", "salt"], ["item"]):
            part = part.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(
                F.col("rank") <= k)
        part = part.join(F.broadcast(named), "item").select(  # items_at_once rows at most
            F.col("name").alias("item_id"), F.col("rank").cast("int"), F.col("id").alias("doc_id"), "score")
        found = part if found is None else found.unionByName(part)
    return found


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')"
ORACLE = f"""
WITH t AS (SELECT row_number() OVER () AS doc, doc_id, {_TERMS} AS terms FROM documents),
one AS (SELECT doc, doc_id, len(terms) AS n, unnest(terms) AS term FROM t),
total AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(len(terms)) AS BIGINT) AS l FROM t WHERE len(terms) > 0),
item AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tf AS (SELECT doc, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
       FROM one WHERE term IN (SELECT term FROM item) GROUP BY ALL),
w AS (SELECT term, CAST(floor({WEIGHT_SCALE} * ln(CAST(2 * any_value(nd) + 2 AS DOUBLE) / (2 * count(*) + 1)))
             AS BIGINT) AS w
      FROM tf, total GROUP BY term),
s AS (SELECT item_id, doc, doc_id, CAST(sum(w * (({TF_SCALE} * tf) // ({TF_STEP} * tf + {NORM} * (
               {100 - LENGTH_PERCENT} + ({LENGTH_PERCENT} * n * nd) // l)))) AS BIGINT) AS score
      FROM item JOIN tf USING (term) JOIN w USING (term), total GROUP BY item_id, doc, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
             doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= {K}
"""
