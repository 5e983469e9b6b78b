"""Properties of the rules over generated readings."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riverwatch.functions.rules import RiskThresholds, alert_condition, risk_level
from riverwatch.operators import analytics as A
from riverwatch.operators.classify import classify_risk

from samples import readings_with

value = st.one_of(st.none(), st.floats(min_value=0, max_value=12, allow_nan=False))
rows = st.lists(st.tuples(value, value), min_size=1, max_size=40)
RANK = {"LOW": 0, "MODERATE": 1, "HIGH": 2, "CRITICAL": 3}


@settings(max_examples=15, deadline=None)
@given(rows)
def test_level_counts_sum_to_rows(spark, data):
    df = readings_with(spark, data)
    total = A.risk_distribution(classify_risk(df)).agg(F.sum("count")).first()[0]
    assert total == len(data)


@settings(max_examples=15, deadline=None)
@given(rows)
def test_critical_implies_alert(spark, data):
    df = readings_with(spark, data).select(risk_level().alias("l"), alert_condition().alias("a"))
    assert df.filter((F.col("l") == "CRITICAL") & ~F.coalesce(F.col("a"), F.lit(False))).count() == 0


@settings(max_examples=15, deadline=None)
@given(rows, st.floats(min_value=0, max_value=3))
def test_raising_thresholds_never_raises_level(spark, data, bump):
    t = RiskThresholds()
    up = RiskThresholds(*(v + bump for v in (t.critical_rain, t.critical_river, t.high_rain,
                                               t.high_river, t.moderate_rain, t.moderate_river)))
    df = readings_with(spark, data).select(risk_level(t=t).alias("a"), risk_level(t=up).alias("b"))
    for r in df.collect():
        assert RANK[r.b] <= RANK[r.a]
