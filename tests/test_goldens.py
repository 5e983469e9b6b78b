"""Expected results on six readings (conftest.GOLDEN)."""

import pytest
from pyspark.sql import functions as F

from riverwatch import schema as S
from riverwatch.operators import analytics as A
from riverwatch.operators.classify import classify_risk, flood_alerts
from riverwatch.plans.serving import recent_alerts
from riverwatch.sources.files import read_readings_csv

from samples import GOLDEN


def test_location_stats(golden):
    rows = {r.location_id: r for r in A.location_stats(golden).collect()}
    a, b = rows["LOC001"], rows["LOC002"]
    assert a.total_records == 4 and b.total_records == 2
    assert a.avg_rainfall == pytest.approx(3.575) and a.max_rainfall == 5.6 and a.min_rainfall == 1.1
    assert a.avg_temperature == pytest.approx(15.9) and a.avg_river_level == pytest.approx(3.25)
    assert a.max_river_level == 4.6
    assert b.avg_rainfall == pytest.approx(4.85) and b.max_rainfall == 9.3 and b.min_rainfall == 0.4
    assert b.avg_temperature == pytest.approx(12.1) and b.avg_river_level == pytest.approx(4.05)
    assert b.max_river_level == 6.2
    assert [r.location_id for r in A.location_stats(golden).collect()] == ["LOC001", "LOC002"]


def test_levels_and_distribution(golden):
    levels = [r.flood_risk_level for r in classify_risk(golden).orderBy(S.TIMESTAMP).collect()]
    assert levels == ["LOW", "MODERATE", "HIGH", "LOW", "CRITICAL", "MODERATE"]
    dist = {r.flood_risk_level: r["count"] for r in A.risk_distribution(classify_risk(golden)).collect()}
    assert dist == {"LOW": 2, "MODERATE": 2, "HIGH": 1, "CRITICAL": 1}
    counts = [r["count"] for r in A.risk_distribution(classify_risk(golden)).collect()]
    assert counts == sorted(counts, reverse=True)


def test_high_risk_locations(golden):
    rows = [tuple(r) for r in A.high_risk_locations(classify_risk(golden)).collect()]
    assert sorted(rows) == [("LOC001", "HIGH", 1), ("LOC002", "CRITICAL", 1)]


def test_correlation(golden):
    (r,) = A.rain_river_corr(golden).collect()
    assert r.correlation == pytest.approx(0.9771585557783082, abs=1e-12)
    assert f"{r.correlation:.4f}" == "0.9772"


def test_extreme_events_order(golden):
    rows = A.extreme_events(golden).collect()
    hours = [r.timestamp[11:13] for r in rows]
    assert hours == ["04", "02", "01", "05", "00", "03"]
    assert rows[0].asDict() == {
        "timestamp": "2024-01-01T04:00:00", "location_id": "LOC002",
        "rainfall_mm_per_hr": 9.3, "river_level_m": 6.2,
    }


def test_hourly_patterns(golden):
    rows = A.hourly_patterns(golden).collect()
    assert [r.hour for r in rows] == [0, 1, 2, 3, 4, 5]
    for r, g in zip(rows, GOLDEN):
        assert r.avg_rainfall == pytest.approx(g[3]) and r.avg_river_level == pytest.approx(g[5])


def test_time_parts(golden):
    r = A.with_time_parts(golden).orderBy(S.TIMESTAMP).first()
    assert r.hour == 0 and str(r.date) == "2024-01-01"


def test_alerts_and_recent(golden):
    alerts = flood_alerts(golden)
    assert alerts.columns == [S.TIMESTAMP, S.LOCATION_ID, S.RAINFALL, S.RIVER_LEVEL, S.ALERT_TYPE]
    rows = recent_alerts(alerts).collect()
    assert [(r.timestamp[11:13], r.location_id) for r in rows] == [("04", "LOC002"), ("02", "LOC001")]
    assert {r.alert_type for r in rows} == {"FLOOD_ALERT"}


def test_record_count_and_guard(spark, golden):
    assert A.record_count(golden).first().total_records == 6
    assert A.has_rows(golden)
    assert not A.has_rows(golden.limit(0))


def test_csv_source(spark, tmp_path):
    p = tmp_path / "readings.csv"
    lines = ["timestamp,location_id,elevation_m,rainfall_mm_per_hr,temperature_c,river_level_m"]
    lines += [",".join(str(v) for v in g) for g in GOLDEN]
    p.write_text("\n".join(lines) + "\n")
    df = read_readings_csv(spark, str(p))
    assert df.schema == S.READING
    assert sorted(tuple(r) for r in df.collect()) == sorted(GOLDEN)


def test_alerts_with_processing_time(golden):
    from riverwatch.operators.decode import stamp_processing_time
    df = flood_alerts(stamp_processing_time(golden), with_processing_time=True)
    assert df.columns[-1] == S.PROCESSING_TIME
    rows = df.collect()
    assert len(rows) == 2 and len({r.processing_time for r in rows}) == 1  # one value per query


def test_sliding_windows(golden):
    from riverwatch.functions.timeparse import wall_time
    df = golden.withColumn("t", wall_time(S.TIMESTAMP))
    tumbling = A.windowed_stats(df, "t", "5 minutes")
    sliding = A.windowed_stats(df, "t", "5 minutes", slide="1 minute")
    assert tumbling.count() == 6  # one window per reading (hours apart)
    assert sliding.count() == 30  # each reading falls in 5 overlapping windows
    assert {r.record_count for r in sliding.collect()} == {1}


def test_window_boundaries_half_open(spark):
    from riverwatch.functions.timeparse import wall_time
    rows = [("2024-01-01T00:04:59", "A", 0.0, 1.0, 20.0, 1.0),
            ("2024-01-01T00:05:00", "A", 0.0, 2.0, 20.0, 1.0),
            ("2024-01-01T00:09:59", "A", 0.0, 3.0, 20.0, 1.0),
            ("2024-01-01T00:10:00", "A", 0.0, 4.0, 20.0, 1.0)]
    df = spark.createDataFrame(rows, S.READING).withColumn("t", wall_time(S.TIMESTAMP))
    got = A.flatten_window(A.windowed_stats(df, "t")).select(
        F.date_format("window_start", "HH:mm:ss").alias("s"),
        F.date_format("window_end", "HH:mm:ss").alias("e"), "record_count", "max_rainfall").collect()
    assert sorted(tuple(r) for r in got) == [
        ("00:00:00", "00:05:00", 1, 1.0), ("00:05:00", "00:10:00", 2, 3.0), ("00:10:00", "00:15:00", 1, 4.0)]


def test_output_schemas(golden):
    """Column names and types of the stored views (FIXTURES.md section 1)."""
    def shape(df):
        return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    assert shape(A.location_stats(golden)) == [
        (f.name, f.dataType.simpleString()) for f in S.LOCATION_STATS.fields]
    parts = A.split_summary(A.batch_summary(classify_risk(golden)))
    assert shape(parts["location_stats"]) == shape(A.location_stats(golden))
    assert shape(A.risk_distribution(classify_risk(golden))) == [
        ("flood_risk_level", "string"), ("count", "bigint")]
    assert shape(A.hourly_patterns(golden)) == [
        ("hour", "int"), ("avg_rainfall", "double"), ("avg_river_level", "double")]
    assert shape(flood_alerts(golden)) == [(f.name, f.dataType.simpleString()) for f in S.ALERT.fields]


def test_summary_keeps_null_location_group(spark):
    """An undecodable message is a row of NULLs: it forms the NULL location
    group (D4) in the separate operator and in the single-scan summary alike,
    distinct from the grouping sets' own NULLs."""
    from samples import GOLDEN
    df = spark.createDataFrame(GOLDEN + [(None, None, None, None, None, None)], S.READING)
    direct = {r.location_id: r.total_records for r in A.location_stats(df).collect()}
    parts = A.split_summary(A.batch_summary(classify_risk(df)))
    summary = {r.location_id: r.total_records for r in parts["location_stats"].collect()}
    assert direct == summary == {None: 1, "LOC001": 4, "LOC002": 2}
    hours = {r.hour for r in parts["hourly_patterns"].collect()}
    assert None in hours and len(hours) == 7
    dist = {r.flood_risk_level: r["count"] for r in parts["risk_distribution"].collect()}
    assert dist["LOW"] == 3  # the NULL row is LOW


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("location_id,extra,river_level_m,timestamp,rainfall_mm_per_hr,elevation_m,temperature_c\n"
                 "A,x,1.5,2024-01-01T00:00:00,bad,3.0,4.0\n")
    names = [f.name for f in S.READING.fields]
    if "elevation_m" not in names:  # the schema's own names decide
        p.write_text(p.read_text().replace("elevation_m", names[2]).replace("temperature_c", names[4]))
    row = read_readings_csv(spark, str(p)).first()
    assert row.location_id == "A" and row.river_level_m == 1.5 and row.rainfall_mm_per_hr is None
    assert row.timestamp == "2024-01-01T00:00:00"
    p.write_text("location_id,timestamp\nA,2024-01-01T00:00:00\n")
    with pytest.raises(ValueError, match="river_level_m"):
        read_readings_csv(spark, str(p))
