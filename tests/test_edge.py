"""NULL, NaN and boundary readings (FIXTURES.md section 3)."""

import math

from pyspark.sql import functions as F

from riverwatch import schema as S
from riverwatch.functions.rules import AlertRule, RiskThresholds, alert_condition, risk_level, triage_status
from riverwatch.operators.classify import flood_alerts

NAN = float("nan")
# id, rain, river, level, alert (True/False/None=dropped), triage ALERT?
EDGE = [
    ("n1", None, 6.0, "HIGH", True, False),
    ("n2", None, None, "LOW", None, False),
    ("n3", NAN, 3.0, "HIGH", True, True),
    ("n4", 7.0, 5.0, "HIGH", True, True),
    ("n5", 5.0, 4.0, "MODERATE", False, False),
    ("n6", 3.0, 3.5, "LOW", False, False),
    ("n7", 1.0, 4.3, "HIGH", False, False),
    ("n8", 8.0, None, "HIGH", True, True),
    ("n9", 7.1, 5.1, "CRITICAL", True, True),
]


def _df(spark):
    return spark.createDataFrame([(e[0], e[1], e[2]) for e in EDGE],
                                 f"id string, {S.RAINFALL} double, {S.RIVER_LEVEL} double")


def test_edge_levels_alerts_triage_keep_nan(spark):
    df = _df(spark).select(
        "id", risk_level().alias("level"), alert_condition().alias("alert"),
        triage_status().alias("triage"))
    got = {r.id: r for r in df.collect()}
    for id_, _, _, level, alert, tri in EDGE:
        r = got[id_]
        assert r.level == level, id_
        assert r.alert == alert, id_
        assert (r.triage.startswith("[ALERT]")) == tri, id_


def test_alert_filter_drops_null_and_false(spark):
    df = _df(spark).withColumn(S.TIMESTAMP, F.col("id")).withColumn(S.LOCATION_ID, F.lit("A"))
    ids = {r.timestamp for r in flood_alerts(df).collect()}
    assert ids == {e[0] for e in EDGE if e[4] is True}


def test_nan_as_null_default(spark):
    # With NaN read as NULL (the decode default), n3 is LOW, no alert, OK.
    df = _df(spark).filter("id = 'n3'").select(
        F.nanvl(S.RAINFALL, F.lit(None).cast("double")).alias(S.RAINFALL), S.RIVER_LEVEL)
    r = df.select(risk_level().alias("l"), alert_condition().alias("a"), triage_status().alias("t")).first()
    assert (r.l, r.a, r.t) == ("LOW", None, "Status OK")


def test_thresholds_are_parameters(spark):
    df = _df(spark).filter("id = 'n7'")  # river 4.3: HIGH by default, no alert
    r = df.select(risk_level(t=RiskThresholds(high_river=4.5)).alias("l"),
                  alert_condition(rule=AlertRule(river=4.0)).alias("a")).first()
    assert r.l == "MODERATE" and r.a is True


def test_strict_boundaries(spark):
    df = _df(spark).filter("id = 'n5'")
    r = df.select(risk_level().alias("l")).first()
    assert r.l == "MODERATE"  # 5.0 is not > 5.0, 4.0 is not > 4.0
    assert not math.isnan(5.0)


def test_bad_timestamp_text_is_null_in_both_ansi_modes(spark):
    from riverwatch.operators import analytics as A
    rows = [("2024-01-01T05:00:00", "A", 0.0, 1.0, 20.0, 1.0),
            ("not a time", "A", 0.0, 3.0, 20.0, 2.0),
            ("2024-01-01T05:30:00+01:00", "A", 0.0, 5.0, 20.0, 3.0)]
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            df = spark.createDataFrame(rows, S.READING)
            got = {r.hour: r.avg_rainfall for r in A.hourly_patterns(df).collect()}
            # zone-less text keeps its hour; an offset is read as an instant
            # and shown in the session zone (UTC); bad text is NULL
            assert got == {None: 3.0, 4: 5.0, 5: 1.0}, ansi
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
