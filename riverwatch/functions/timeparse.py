"""Reading timestamps are ISO-8601 text; these turn them into times.

Bad text gives NULL in both ANSI and non-ANSI mode (``try_cast``), where a
plain implicit cast would throw under ANSI.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riverwatch import schema as S


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wall_time(text: str | Column = S.TIMESTAMP) -> Column:
    """TIMESTAMP_NTZ in the session time zone: text with an offset is read as
    an instant and shown in the session zone (as an implicit cast does);
    zone-less text keeps its wall-clock time. (A direct NTZ cast would
    accept an offset and silently drop it, so it is only the fallback.)"""
    t = _c(text)
    return F.coalesce(
        t.try_cast("timestamp").cast("timestamp_ntz"),
        t.try_cast("timestamp_ntz"),
    )


def instant(text: str | Column = S.TIMESTAMP) -> Column:
    """TIMESTAMP (with local time zone), as a watermark needs."""
    return _c(text).try_cast("timestamp")


def hour_of(text: str | Column = S.TIMESTAMP) -> Column:
    return F.hour(wall_time(text))


def date_of(text: str | Column = S.TIMESTAMP) -> Column:
    return F.to_date(wall_time(text))
