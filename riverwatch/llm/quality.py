"""Quality rules: a threshold table compiled into one projection.

Each rule bounds the ratio of two counts taken from a document. The table of
rules is turned into one Spark expression over the text; there is no shuffle
and no user function, so the operator is one map over the scan.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverwatch.llm.common import WHITE, WHITE_RUN, bind, free_name, table

SYMBOLS = "[#*$%&|<>]"

# Stop words: frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by this are at from "
    "de la le et les des en un du que une pour est qui dans par sur pas au avec "
    "der die und in den von zu das mit sich des auf für im ist dem nicht ein eine als "
    "de la que el en y los se las del un por con no una para su es al"
).split()


class Rule(NamedTuple):
    """``low * den <= 1000 * num <= high * den``; None leaves a side open."""

    name: str
    num: str
    den: str
    low: int | None
    high: int | None


#: Rules beyond the base rules, in thousandths. A ratio over no lines or words passes.
RULES = (
    Rule("word length", "word_chars", "n_words", 2500, 12000),
    Rule("symbols per word", "n_symbols", "n_words", None, 100),
    Rule("stop words per word", "n_stop_words", "n_words", 40, None),
    Rule("duplicate lines per line", "n_dup_lines", "n_lines", None, 400),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _n_repeat_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more."""
    n = F.size(w)
    starts = F.sequence(F.lit(0), n - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    def same(x: Column, y: Column) -> Column:
        return (x.h == y.h) & (x.a == y.a) & (x.b == y.b) & (x.c == y.c)

    def covered(p: Column) -> Column:
        """Positions covered by three-word windows at the ascending starts ``p``."""
        steps = F.transform(p, lambda x, j: F.when(j + 1 < F.size(p),
                                                   F.least(F.lit(3), p[j + 1] - x)).otherwise(3))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def exact(h: Column) -> Column:
        # sorted by hash first, by the words on equal hashes: neighbours decide
        windows = F.sort_array(F.transform(starts, lambda i: F.struct(
            h[i].alias("h"), w[i].alias("a"), w[i + 1].alias("b"), w[i + 2].alias("c"),
            i.alias("i"))))
        repeated = bind(windows, lambda s: F.filter(s, lambda x, j: (
            F.when(j > 0, same(x, s[j - 1])).otherwise(F.lit(False))
            | F.when(j + 1 < F.size(s), same(x, s[j + 1])).otherwise(F.lit(False)))))
        return bind(F.sort_array(F.transform(repeated, lambda x: x.i)), covered)

    # equal windows have equal hashes, so distinct hashes mean no repeat
    some = bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
                .otherwise(exact(h)))
    return F.when(n < 3, F.lit(0)).otherwise(some)


def text_counts(text: Column) -> Column:
    """Struct of the counts that the rules use; a null text counts as empty."""
    t = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(t, F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, WHITE_RUN, -1))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != "")

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(*sorted(set(STOP_WORDS)))))
            .cast("long").alias("n_stop_words"),
            _n_repeat_words(w).cast("long").alias("n_repeat_words"))

    of_lines = bind(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    symbols = F.regexp_count(t, F.lit(SYMBOLS)).cast("long")
    return F.struct(bind(words, of_words).alias("w"), of_lines.alias("l"),
                    symbols.alias("n_symbols"))


def _passes(rule: Rule, get) -> Column:
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & (rule.low * get(rule.den) <= 1000 * get(rule.num))
    if rule.high is not None:
        ok = ok & (1000 * get(rule.num) <= rule.high * get(rule.den))
    return ok


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = MIN_WORDS,
                  max_repeat_percent: int = MAX_REPEAT_PERCENT,
                  text_col: str = "text", out: str = "quality") -> DataFrame:
    """``docs`` plus a struct ``out`` with the counts, ``base_failed`` and ``kept``.

    Words are runs of anything but ASCII white space. ``base_failed``: fewer
    than ``min_words`` words, or more than ``max_repeat_percent`` of the words in
    three-word windows that occur twice or more. ``kept``: not ``base_failed`` and
    every rule of the table holds.

    Nulls: a null text counts as empty (no words, so ``base_failed``); other
    columns are not read. An empty table gives an empty table. Repeated rows
    are judged one by one. A column already named ``out`` is replaced. Very
    long texts cost O(n log n) at worst, for the sort of the repeated windows.
    """
    counts = free_name(docs, "__counts")

    def get(name: str) -> Column:
        part = {"n_symbols": "n_symbols", "n_lines": "l.n_lines",
                "n_dup_lines": "l.n_dup_lines"}.get(name, f"w.{name}")
        return F.col(f"{counts}.{part}")

    failed = (get("n_words") < min_words) | (
        100 * get("n_repeat_words") > max_repeat_percent * get("n_words"))
    kept = ~failed
    for rule in rules:
        kept = kept & _passes(rule, get)
    fields = ("n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines",
              "n_repeat_words")
    # the generator keeps Spark from copying the counts into every rule
    counted = docs.select("*", F.explode(F.array(text_counts(F.col(text_col)))).alias(counts))
    return counted.withColumn(out, F.struct(
        *[get(f).alias(f) for f in fields],
        failed.alias("base_failed"), kept.alias("kept"))).drop(counts)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass the rules, with their columns as they came."""
    flag = free_name(docs, "__quality")
    return quality_rules(docs, out=flag).filter(F.col(f"{flag}.kept")).drop(flag)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "kept", "n_stop_words", "n_lines")
    return q.select("doc_id", *[F.col(f"quality.{n}").alias(n) for n in names])


def _sql_list(words) -> str:
    return ", ".join("'" + w + "'" for w in sorted(set(words)))


_RULE_SQL = " AND ".join(
    part for r in RULES for part in (
        ([f"{r.low} * {r.den} <= 1000 * {r.num}"] if r.low is not None else [])
        + ([f"1000 * {r.num} <= {r.high} * {r.den}"] if r.high is not None else [])))

ORACLE = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
word AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM base),
win AS (
  SELECT doc_id, i, a, lead(a, 1) OVER d AS b, lead(a, 2) OVER d AS c
  FROM word WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
rep AS (
  SELECT doc_id, i FROM win WHERE c IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) >= 2),
cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS s(k)
  GROUP BY doc_id),
line AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT x) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM base)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(line.dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(w, lambda x: lower(x) IN ({_sql_list(STOP_WORDS)}))) AS BIGINT)
           AS n_stop_words,
         CAST(coalesce(line.n, 0) AS BIGINT) AS n_lines
  FROM base LEFT JOIN cov USING (doc_id) LEFT JOIN line USING (doc_id)),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words
    AS base_failed FROM counted)
SELECT *, NOT base_failed AND {_RULE_SQL} AS kept FROM judged
"""
