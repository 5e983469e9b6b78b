"""Risk classification (P-5) and alert extraction (P-6..P-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverwatch import schema as S
from riverwatch.functions.rules import (
    AlertRule,
    RiskThresholds,
    alert_condition,
    risk_level,
)


def classify_risk(df: DataFrame, thresholds: RiskThresholds = RiskThresholds()) -> DataFrame:
    """P-5: append ``flood_risk_level`` (narrow: no shuffle)."""
    return df.withColumn(S.FLOOD_RISK_LEVEL, risk_level(S.RAINFALL, S.RIVER_LEVEL, thresholds))


def flood_alerts(
    df: DataFrame, rule: AlertRule = AlertRule(), with_processing_time: bool = False
) -> DataFrame:
    """P-6 + P-7 (+ P-8): rows over the alert rule, projected to the alert
    record. Rows whose two values are both NULL are dropped (NULL is not
    TRUE). ``with_processing_time`` keeps a ``processing_time`` column that
    ``decode.stamp_processing_time`` added."""
    cols = [
        F.col(S.TIMESTAMP),
        F.col(S.LOCATION_ID),
        F.col(S.RAINFALL),
        F.col(S.RIVER_LEVEL),
        F.lit(rule.tag).alias(S.ALERT_TYPE),
    ]
    if with_processing_time:
        cols.append(F.col(S.PROCESSING_TIME))
    return df.filter(alert_condition(S.RAINFALL, S.RIVER_LEVEL, rule)).select(*cols)
