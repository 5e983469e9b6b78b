"""Batch analytics over readings (A-1..A-8, P-11, TOP-1).

Every aggregate here is algebraic (count, sum/avg, min, max, central
moments), so Spark plans it as partial aggregation in each task, a shuffle
of one row per (task, group), and a final merge. A location holding a
third of all rows therefore costs no more shuffle than any other: skew is
absorbed before the exchange. Top-k runs as a per-task heap plus one merge
(``TakeOrderedAndProject``), never a global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverwatch import schema as S
from riverwatch.functions import rules, stats, timeparse


def location_stats(df: DataFrame, ordered: bool = True) -> DataFrame:
    """A-1: per-location count, averages and extremes. ``count(*)`` counts
    undecodable rows too; they form the NULL location group."""
    out = df.groupBy(S.LOCATION_ID).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.avg(S.RAINFALL).alias("avg_rainfall"),
        F.max(S.RAINFALL).alias("max_rainfall"),
        F.min(S.RAINFALL).alias("min_rainfall"),
        F.avg(S.TEMPERATURE).alias("avg_temperature"),
        F.avg(S.RIVER_LEVEL).alias("avg_river_level"),
        F.max(S.RIVER_LEVEL).alias("max_river_level"),
    )
    return out.orderBy(S.LOCATION_ID) if ordered else out


def risk_distribution(classified: DataFrame, ordered: bool = True) -> DataFrame:
    """A-2 / A-5: rows per risk level, most frequent first."""
    out = classified.groupBy(S.FLOOD_RISK_LEVEL).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.desc("count"), S.FLOOD_RISK_LEVEL) if ordered else out


def with_time_parts(df: DataFrame) -> DataFrame:
    """P-11: ``hour`` (INT) and ``date`` from the timestamp text; NULL for
    text that is not a time, in ANSI mode too."""
    return df.withColumn("hour", timeparse.hour_of(S.TIMESTAMP)).withColumn(
        "date", timeparse.date_of(S.TIMESTAMP)
    )


def hourly_patterns(df: DataFrame, ordered: bool = True) -> DataFrame:
    """A-3: averages by hour of day (at most 24 rows, plus NULL for bad
    timestamps)."""
    out = (
        df.select(timeparse.hour_of(S.TIMESTAMP).alias("hour"), S.RAINFALL, S.RIVER_LEVEL)
        .groupBy("hour")
        .agg(
            F.avg(S.RAINFALL).alias("avg_rainfall"),
            F.avg(S.RIVER_LEVEL).alias("avg_river_level"),
        )
    )
    return out.orderBy("hour") if ordered else out


def rain_river_corr(df: DataFrame, a: str = S.RAINFALL, b: str = S.RIVER_LEVEL) -> DataFrame:
    """A-4: one row, ``correlation``: Pearson over pairwise-present rows;
    NULL for no rows or a constant column."""
    return df.agg(stats.pearson(a, b).alias("correlation"))


def extreme_events(df: DataFrame, n: int = 10) -> DataFrame:
    """TOP-1 + P-12: the ``n`` readings with the most rain, then the highest
    river. DESC puts NULLs last. Time and location break ties, so the
    answer does not depend on partitioning."""
    return (
        df.select(S.TIMESTAMP, S.LOCATION_ID, S.RAINFALL, S.RIVER_LEVEL)
        .orderBy(
            F.col(S.RAINFALL).desc(),
            F.col(S.RIVER_LEVEL).desc(),
            F.col(S.TIMESTAMP).asc(),
            F.col(S.LOCATION_ID).asc(),
        )
        .limit(n)
    )


def recent_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    """TOP-2: the ``n`` latest alerts by timestamp text (ISO text sorts in
    time order). Ties broken by location and values."""
    return alerts.orderBy(
        F.col(S.TIMESTAMP).desc(),
        F.col(S.LOCATION_ID).asc(),
        F.col(S.RAINFALL).desc(),
        F.col(S.RIVER_LEVEL).desc(),
    ).limit(n)


def high_risk_locations(
    classified: DataFrame,
    levels: tuple[str, ...] = (rules.HIGH, rules.CRITICAL),
    ordered: bool = True,
) -> DataFrame:
    """A-6 + P-10: row counts per (location, level) for the given levels.
    On a view partitioned by level the ``isin`` becomes a partition filter."""
    out = (
        classified.filter(F.col(S.FLOOD_RISK_LEVEL).isin(list(levels)))
        .groupBy(S.LOCATION_ID, S.FLOOD_RISK_LEVEL)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    if ordered:
        out = out.orderBy(F.desc("count"), S.LOCATION_ID, S.FLOOD_RISK_LEVEL)
    return out


def record_count(df: DataFrame) -> DataFrame:
    """A-7 as a query: one row, ``total_records``."""
    return df.agg(F.count(F.lit(1)).alias("total_records"))


def has_rows(df: DataFrame) -> bool:
    """A-7 as a guard: reads at most one row, not the whole input."""
    return not df.isEmpty()


WINDOW_AGGS = (
    ("avg_rainfall", F.avg, S.RAINFALL),
    ("max_rainfall", F.max, S.RAINFALL),
    ("avg_river_level", F.avg, S.RIVER_LEVEL),
    ("max_river_level", F.max, S.RIVER_LEVEL),
)


def windowed_stats(
    df: DataFrame,
    time_col: str,
    window: str = "5 minutes",
    slide: str | None = None,
) -> DataFrame:
    """A-8: per (tumbling window, location) averages, maxima and count.
    Works on batch and streaming input alike; a stream adds its watermark
    before calling this."""
    w = F.window(time_col, window, slide) if slide else F.window(time_col, window)
    return df.groupBy(w.alias("window"), F.col(S.LOCATION_ID)).agg(
        *[fn(c).alias(name) for name, fn, c in WINDOW_AGGS],
        F.count(F.lit(1)).alias("record_count"),
    )


def flatten_window(df: DataFrame, as_ntz: bool = True) -> DataFrame:
    """``window`` struct -> ``window_start``/``window_end`` columns (NTZ by
    default so the values do not depend on the session time zone)."""
    start, end = F.col("window.start"), F.col("window.end")
    if as_ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    rest = [c for c in df.columns if c != "window"]
    return df.select(start.alias("window_start"), end.alias("window_end"), *rest)


SUMMARY_KIND = "summary_kind"


def batch_summary(classified: DataFrame) -> DataFrame:
    """Location stats, hourly averages, level counts and the overall
    correlation in one scan and one shuffle, as grouping sets.

    Reads the union of the columns the four analytics need once, instead of
    once per analytic; the result is small (locations + 24 hours + levels +
    1 rows). ``summary_kind`` says which grouping a row belongs to
    (``location``, ``hour``, ``level``, ``all``); ``split_summary`` turns it
    into the four results with the same columns as the separate operators.
    """
    df = classified.select(
        S.LOCATION_ID,
        timeparse.hour_of(S.TIMESTAMP).alias("hour"),
        S.FLOOD_RISK_LEVEL,
        S.RAINFALL,
        S.TEMPERATURE,
        S.RIVER_LEVEL,
    )
    keys = [S.LOCATION_ID, "hour", S.FLOOD_RISK_LEVEL]
    kind = (
        F.when(F.grouping(S.LOCATION_ID) == 0, F.lit("location"))
        .when(F.grouping("hour") == 0, F.lit("hour"))
        .when(F.grouping(S.FLOOD_RISK_LEVEL) == 0, F.lit("level"))
        .otherwise(F.lit("all"))
    )
    return df.groupingSets([[S.LOCATION_ID], ["hour"], [S.FLOOD_RISK_LEVEL], []], *keys).agg(
        kind.alias(SUMMARY_KIND),
        F.count(F.lit(1)).alias("total_records"),
        F.avg(S.RAINFALL).alias("avg_rainfall"),
        F.max(S.RAINFALL).alias("max_rainfall"),
        F.min(S.RAINFALL).alias("min_rainfall"),
        F.avg(S.TEMPERATURE).alias("avg_temperature"),
        F.avg(S.RIVER_LEVEL).alias("avg_river_level"),
        F.max(S.RIVER_LEVEL).alias("max_river_level"),
        stats.pearson(S.RAINFALL, S.RIVER_LEVEL).alias("correlation"),
    )


def split_summary(summary: DataFrame, ordered: bool = True) -> dict[str, DataFrame]:
    """``batch_summary`` -> location_stats, hourly_patterns,
    risk_distribution, correlation (shaped as the separate operators)."""
    def part(kind: str) -> DataFrame:
        return summary.filter(F.col(SUMMARY_KIND) == F.lit(kind))

    loc = part("location").select(
        S.LOCATION_ID, "total_records", "avg_rainfall", "max_rainfall", "min_rainfall",
        "avg_temperature", "avg_river_level", "max_river_level")
    hourly = part("hour").select("hour", "avg_rainfall", "avg_river_level")
    dist = part("level").select(S.FLOOD_RISK_LEVEL, F.col("total_records").alias("count"))
    corr = part("all").select("correlation")
    if ordered:
        loc = loc.orderBy(S.LOCATION_ID)
        hourly = hourly.orderBy("hour")
        dist = dist.orderBy(F.desc("count"), S.FLOOD_RISK_LEVEL)
    return {"location_stats": loc, "hourly_patterns": hourly,
            "risk_distribution": dist, "correlation": corr}
