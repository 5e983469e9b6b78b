"""Mixing sources to target weights by Poisson replication, with built-ins only."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverwatch.llm.common import bind, free_name, stored, table

TEMPERATURE = 0.5
SEED = 42
PART = 1024  # copies of one document that are made in one go
DIGITS = 13  # hex digits of the hash in the uniform number: 52 bits


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts, a null part written as 'null'."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") / float(16 ** DIGITS)


def first_count(rate: Column) -> Column:
    """The count at which the law starts: all below it together have less than 2^-53."""
    return F.greatest(F.lit(0).cast("long"), F.floor(rate - 12 * F.sqrt(rate) - 40))


def _log_chance(rate: Column, k: Column) -> Column:
    """ln P(count = k) for k > 0 by Stirling's series, with the large terms taken off each other first."""
    d = (rate - k) / k
    series = 1 / (12 * k) - 1 / (360 * F.pow(k, F.lit(3))) + 1 / (1260 * F.pow(k, F.lit(5)))
    return k * (F.log1p(d) - d) - 0.5 * F.ln(2 * math.pi * k) - series


def poisson_cdf(rate: Column, low: Column | None = None) -> Column:
    """P(count <= k) for k = ``low`` (0 if None), ... so far that the rest is below 2^-53.

    An array that grows in a fold is copied at each step, so the law is filled in
    blocks of about the square root of its length; from ``first_count`` on
    it has 24 * sqrt(rate) numbers or so.
    """
    low = F.lit(0).cast("long") if low is None else low
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40)
    start = F.when(low == 0, -rate).otherwise(_log_chance(rate, low.cast("double")))
    first = F.struct(start.alias("lp"), F.exp(start).alias("c"))
    each = F.ceil(F.sqrt(last - low))

    def step(acc: Column, k: Column) -> Column:
        return bind(acc.lp + F.ln(rate) - F.ln(k), lambda lp: F.struct(
            lp.alias("lp"), (acc.c + F.exp(lp)).alias("c")))

    def walked(size: Column, at: Column, state: Column) -> Column:
        """The states after each of ``size`` steps from ``at``."""
        empty = F.struct(state.alias("now"), F.array(state).alias("all"))
        return F.slice(F.aggregate(F.sequence(at + 1, at + size), empty, lambda acc, k: bind(
            step(acc.now, k), lambda x: F.struct(x.alias("now"), F.concat(acc["all"], F.array(x)).alias("all"))),
            lambda acc: acc["all"]), F.lit(2), size.cast("int"))

    def filled(size: Column, begin: Column) -> Column:
        starts = F.sequence(low, last - 1, size)
        # the state at the start of each block, then the steps of all blocks from theirs
        heads = F.aggregate(starts, F.struct(begin.alias("now"), F.array(begin).alias("all")),
                            lambda acc, at: bind(F.aggregate(F.sequence(at + 1, at + size), acc.now, step),
                                                 lambda x: F.struct(x.alias("now"), F.concat(
                                                     acc["all"], F.array(x)).alias("all"))), lambda acc: acc["all"])
        blocks = bind(heads, lambda h: F.transform(starts, lambda at, i: walked(
            F.least(size, last - at), at, F.get(h, i))))
        return F.transform(F.concat(F.array(begin), F.flatten(blocks)), lambda x: x.c)

    return bind(each, lambda size: bind(first, lambda begin: filled(size, begin)))


def source_rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None,
                 temperature: float = TEMPERATURE, total: float | None = None,
                 source_col: str = "source") -> DataFrame:
    """(src, n, rate, cdf) for each source: its rows, its mean repetitions, and their law.

    ``weights`` are the target shares; a source without one gets no rows.
    Without ``weights`` a source weighs its row count to the power
    ``temperature``. ``total``: expected rows of the mixture, as many as
    ``docs`` has if None. The rate is total * weight / sum of weights / rows.
    """
    n = docs.groupBy(F.col(source_col).alias("src")).agg(F.count("*").alias("n"))
    if weights is None:
        weighed = n.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(float(temperature))))
    else:
        given = docs.sparkSession.createDataFrame(
            [(k, float(v)) for k, v in weights.items()], "key string, w double")
        weighed = n.join(given, n.src.cast("string").eqNullSafe(given.key)).drop("key").filter("w > 0")
    summed = weighed.agg(F.sum("w").alias("w_all"))
    rows = n.agg(F.sum("n").cast("double").alias("n_all"))
    all_ = summed.crossJoin(rows)  # one row each
    rate = (F.lit(total) if total is not None else F.col("n_all")) * F.col("w") / F.col("w_all") \
        / F.col("n")
    return weighed.crossJoin(all_).select("src", "n", rate.alias("rate")).withColumn(
        "cdf", poisson_cdf(F.col("rate"), first_count(F.col("rate"))))


def mix_sources(docs: DataFrame, weights: Mapping[str | None, float] | None = None,
                temperature: float = TEMPERATURE, total: float | None = None, seed: int = SEED,
                id_col: str = "doc_id", source_col: str = "source",
                copy_col: str = "copy", order_col: str = "mix_key") -> DataFrame:
    """The mixture: each document as often as its Poisson count, in random order.

    A document's count inverts the Poisson law with its source's rate at a
    number hashed from (seed, id), so a rerun or a lost task gives the same
    copies. Added columns: ``copy_col``, from 0, and ``order_col``, a hash of
    (seed, id, copy). Rows go to partitions by that hash and are sorted by it
    there; sorting all of them by it gives one global order.

    The table of rates has a row for each source and is stored; Spark
    broadcasts it only while its size is under its broadcast threshold and
    else joins by shuffle, splitting a hot source (AQE).

    Nulls: a null source is a source of its own; null ids hash as 'null'.
    Repeated rows are drawn alike. Empty tables stay empty. Columns of
    ``docs`` named like an added column are replaced.
    """
    docs = docs.drop(copy_col, order_col)
    # sums of doubles follow the order of rows: one stored result for the whole run
    rates = stored(source_rates(docs, weights, temperature, total, source_col)
                   .select(F.col("src").alias("__src"), F.col("cdf").alias("__cdf"),
                           first_count(F.col("rate")).alias("__low"), "rate"), "mix-rates")
    most = rates.agg(F.max("rate")).first()[0] or 0
    rates = rates.drop("rate")
    u, n = free_name(docs, "__u"), free_name(docs, "__n")
    drawn = (docs.join(rates, docs[source_col].eqNullSafe(rates["__src"]))
             .withColumn(u, _uniform(F.lit(seed), F.col(id_col)))
             .withColumn(n, F.col("__low") + F.size(F.filter("__cdf", lambda c: c <= F.col(u))))
             .filter(F.col(n) > 0).select(*docs.columns, n))
    if most > PART:  # a document's copies are dealt to many tasks, in parts
        part = free_name(docs, "__part")
        drawn = drawn.withColumn(part, F.explode(F.sequence(
            F.lit(0).cast("long"), F.col(n) - 1, F.lit(PART).cast("long"))))
        drawn = drawn.repartition(F.xxhash64(F.col(id_col), F.col(part)))
        numbers = F.sequence(F.col(part), F.least(F.col(n), F.col(part) + PART) - 1)
    else:
        numbers = F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    copies = drawn.select(*docs.columns, F.explode(numbers).alias(copy_col))
    parts = [F.coalesce(c.cast("string"), F.lit("null"))
             for c in (F.lit(seed), F.col(id_col), F.col(copy_col))]
    keyed = copies.withColumn(copy_col, F.col(copy_col).cast("long")).withColumn(
        order_col, F.md5(F.concat_ws("|", *parts)))
    return keyed.repartition(order_col).sortWithinPartitions(order_col)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mixture with the columns of ``docs`` alone."""
    return mix_sources(docs, copy_col="__copy", order_col="__mix_key").drop("__copy", "__mix_key")


def op7_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH RECURSIVE src AS (
  SELECT source, count(*) AS n FROM documents GROUP BY source),
rate AS (
  SELECT source, (SELECT CAST(sum(n) AS DOUBLE) FROM src)
           * pow(CAST(n AS DOUBLE), {TEMPERATURE})
           / (SELECT sum(pow(CAST(n AS DOUBLE), {TEMPERATURE})) FROM src) / n AS rate FROM src),
law AS (
  SELECT source, rate, 0 AS k, -rate AS lp, exp(-rate) AS c FROM rate
  UNION ALL
  SELECT source, rate, k + 1, lp + ln(rate) - ln(k + 1), c + exp(lp + ln(rate) - ln(k + 1))
  FROM law WHERE k < ceil(rate + 12 * sqrt(rate) + 40)),
cdf AS (SELECT source, list(c ORDER BY k) AS cdf FROM law GROUP BY source),
drawn AS (
  SELECT d.*, len(list_filter(cdf, lambda c: c <= CAST('0x' || substr(md5(
           '{SEED}|' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, {DIGITS}) AS BIGINT)
           / {float(16 ** DIGITS)!r})) AS times
  FROM documents d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source),
copies AS (
  SELECT doc_id, text, lang, source, n_chars, unnest(range(times)) AS copy FROM drawn)
SELECT *, md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || copy) AS mix_key
FROM copies
"""
