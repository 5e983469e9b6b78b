"""Serving layer (V-1..V-6): named queries over the stored views.

The query functions are DataFrame -> DataFrame, so they also run on views
computed in the same session. ``ServingLayer`` binds them to the folders
the batch and speed layers write.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverwatch import schema as S
from riverwatch.operators import analytics as A
from riverwatch.plans.batch import BatchPaths, current_views
from riverwatch.sinks.versions import read_current
from riverwatch.sources.files import read_alerts


recent_alerts = A.recent_alerts  # V-2 / TOP-2


def location_summary(stats: DataFrame, location_id: str | None = None) -> DataFrame:
    """V-3 / P-9: one location's statistics, or all when none is given."""
    out = stats.filter(F.col(S.LOCATION_ID) == F.lit(location_id)) if location_id else stats
    return out.orderBy(S.LOCATION_ID)


def risk_summary(flood_risk: DataFrame) -> DataFrame:
    """V-4 / A-5."""
    return A.risk_distribution(flood_risk)


def high_risk_locations(flood_risk: DataFrame) -> DataFrame:
    """V-5 / A-6."""
    return A.high_risk_locations(flood_risk)


_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _try_read(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The view, or None when its folder does not exist (or holds no data
    files to infer a schema from); other errors propagate."""
    try:
        return read()
    except AnalysisException as e:
        condition = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
        name = (condition() if condition else None) or ""
        if name in _ABSENT or any(a in str(e) for a in _ABSENT):
            return None
        raise


class ServingLayer:
    """Views of a batch output folder plus the speed layer's alert folder."""

    QUERY_NAMES = ("alerts", "location", "risk_summary", "high_risk")

    def __init__(self, spark: SparkSession, batch_dir: str, alerts_dir: str | None = None,
                 alerts_top_dir: str | None = None):
        self.spark = spark
        self.batch_dir = batch_dir
        self.paths = BatchPaths(batch_dir)
        self.alerts_dir = alerts_dir
        self.alerts_top_dir = alerts_top_dir
        self.views: dict[str, DataFrame] = {}
        self.load_batch_views()

    def load_batch_views(self) -> dict[str, DataFrame]:
        """V-1: (re)load the views present; absent ones are left out. The
        loaded DataFrames are snapshots until the next call."""
        self.views = {}
        self.paths = current_views(self.spark, self.batch_dir)  # all views of one run
        for name, path in (("location_stats", self.paths.location_stats),
                           ("flood_risk", self.paths.flood_risk)):
            df = _try_read(lambda p=path: self.spark.read.parquet(p))
            if df is not None:
                self.views[name] = df
        return self.views

    def get_realtime_alerts(self, n: int = 10) -> DataFrame:
        """V-2: latest alerts; an empty DataFrame when there are none.

        With ``alerts_top_dir`` (the speed layer's top-k index,
        ``SpeedConfig.alerts_top_path``) and ``n`` no larger than the k stored
        with it, the answer comes from its k rows instead of every alert file;
        it is the same answer. For a larger ``n`` the alert files are read; without
        them it raises ValueError rather than return too few.
        """
        empty = self.spark.createDataFrame([], S.ALERT)
        if self.alerts_top_dir:
            top = _try_read(lambda: read_current(self.spark, self.alerts_top_dir))
            if top is not None:
                k = top.agg(F.min("k")).first()[0] if "k" in top.columns else 0
                # no rows: there has been no alert
                if k is None or n <= k:
                    return recent_alerts(top.select(*S.ALERT.fieldNames()), n)
                if not self.alerts_dir:
                    raise ValueError(f"the alert index holds {k} rows, asked for {n}")
        if not self.alerts_dir:
            return empty
        df = _try_read(lambda: read_alerts(self.spark, self.alerts_dir))
        return recent_alerts(df, n) if df is not None else empty

    def get_location_summary(self, location_id: str | None = None) -> DataFrame | None:
        stats = self.views.get("location_stats")
        return None if stats is None else location_summary(stats, location_id)

    def get_flood_risk_summary(self) -> DataFrame | None:
        fr = self.views.get("flood_risk")
        return None if fr is None else risk_summary(fr)

    def get_high_risk_locations(self) -> DataFrame | None:
        fr = self.views.get("flood_risk")
        return None if fr is None else high_risk_locations(fr)

    def query(self, name: str, **kwargs) -> DataFrame | None:
        """V-6: named-query dispatch; an unknown name raises ValueError."""
        table: dict[str, Callable[[], DataFrame | None]] = {
            "alerts": lambda: self.get_realtime_alerts(kwargs.get("n", 10)),
            "location": lambda: self.get_location_summary(kwargs.get("location_id")),
            "risk_summary": self.get_flood_risk_summary,
            "high_risk": self.get_high_risk_locations,
        }
        if name not in table:
            raise ValueError(f"unknown query {name!r}; known: {', '.join(self.QUERY_NAMES)}")
        return table[name]()
