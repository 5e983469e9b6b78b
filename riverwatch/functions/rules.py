"""Risk, alert and triage rules as Column expressions.

Three rule sets exist and they deliberately differ (a river at 4.3 m with
light rain is HIGH risk yet raises no alert). Each is one dataclass of
thresholds; the defaults are the fixed values below. All comparisons are
strict ``>`` and follow SQL three-valued logic: ``NULL > x`` is NULL, so in
an OR the other side decides, and a CASE branch with a NULL condition is
skipped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from riverwatch import schema as S

# --- fixed values (must equal the reference's for the same results) -------
# risk levels, highest first
CRITICAL = "CRITICAL"
HIGH = "HIGH"
MODERATE = "MODERATE"
LOW = "LOW"
LEVELS = (CRITICAL, HIGH, MODERATE, LOW)
# risk thresholds (rainfall mm/h, river level m):
#   CRITICAL: rain > 7.0 AND river > 5.0
#   HIGH:     rain > 5.0 OR  river > 4.0
#   MODERATE: rain > 3.0 OR  river > 3.5
# alert rule: rain > 5.0 OR river > 4.5, tagged "FLOOD_ALERT"
ALERT_TAG = "FLOOD_ALERT"
# triage rule: rain > 5.0, a missing rainfall counts as 0
TRIAGE_ALERT = "[ALERT] FLOOD ALERT (High Rainfall!)"
TRIAGE_OK = "Status OK"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RiskThresholds:
    critical_rain: float = 7.0
    critical_river: float = 5.0
    high_rain: float = 5.0
    high_river: float = 4.0
    moderate_rain: float = 3.0
    moderate_river: float = 3.5


@dataclass(frozen=True)
class AlertRule:
    rain: float = 5.0
    river: float = 4.5
    tag: str = ALERT_TAG


@dataclass(frozen=True)
class TriageRule:
    rain: float = 5.0
    missing_rain: float = 0.0
    alert: str = TRIAGE_ALERT
    ok: str = TRIAGE_OK


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def risk_level(
    rain: str | Column = S.RAINFALL,
    river: str | Column = S.RIVER_LEVEL,
    t: RiskThresholds = RiskThresholds(),
) -> Column:
    """CASE WHEN chain, first match wins; no match (or all NULL) is LOW."""
    r, v = _c(rain), _c(river)
    return (
        F.when((r > t.critical_rain) & (v > t.critical_river), F.lit(CRITICAL))
        .when((r > t.high_rain) | (v > t.high_river), F.lit(HIGH))
        .when((r > t.moderate_rain) | (v > t.moderate_river), F.lit(MODERATE))
        .otherwise(F.lit(LOW))
    )


def alert_condition(
    rain: str | Column = S.RAINFALL,
    river: str | Column = S.RIVER_LEVEL,
    rule: AlertRule = AlertRule(),
) -> Column:
    """TRUE, FALSE or NULL; ``filter`` keeps TRUE only."""
    return (_c(rain) > rule.rain) | (_c(river) > rule.river)


def triage_status(
    rain: str | Column = S.RAINFALL, rule: TriageRule = TriageRule()
) -> Column:
    """Consumer-side tag: only rainfall counts, a missing value counts as 0."""
    r = F.coalesce(_c(rain), F.lit(rule.missing_rain))
    return F.when(r > rule.rain, F.lit(rule.alert)).otherwise(F.lit(rule.ok))
