"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pearson(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation over the rows where both values are present.

    Built from ``covar_pop`` and ``stddev_pop`` (both merge partial states,
    so this is an ordinary two-phase aggregate), with ``try_divide`` so that
    no rows, one row or a constant column give NULL instead of NaN or a
    divide-by-zero error. Each side is masked by the other's NULLs so the
    three moments see the same rows.
    """
    x, y = _c(a), _c(b)
    xm = F.when(y.isNotNull(), x)
    ym = F.when(x.isNotNull(), y)
    return F.try_divide(
        F.covar_pop(xm, ym), F.stddev_pop(xm) * F.stddev_pop(ym)
    )
