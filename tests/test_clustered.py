"""Tables in order over their files: readers open what they need and get what a full scan gets."""

import random

import pytest
from pyspark.sql import functions as F

from riverwatch import schema as S
from riverwatch.operators import analytics as A
from riverwatch.sinks import clustered as C

FILES = 8


def table(spark, n, values, seed=1):
    rng = random.Random(seed)
    rows = [(f"2031-05-{rng.randint(1, 28):02d}T00:00:00", rng.choice(["A", "B", "C", None]), 0.0, rng.choice(values),
             1.0, rng.choice([None, 1.0, 2.0, 3.0])) for _ in range(n)]
    return spark.createDataFrame(rows, S.READING)


@pytest.mark.parametrize("values,most", [
    ([float(v) for v in range(500)], 2),   # few files
    ([1.0, 2.0, 3.0, None], FILES),        # ties over several files
    ([7.0], FILES), ([None], FILES)])
def test_top_rows_equal_a_full_scan(spark, tmp_path, values, most):
    df, path = table(spark, 600, values), str(tmp_path)
    C.write_clustered(df, path, [f"-{S.RAINFALL}", f"-{S.RIVER_LEVEL}"], FILES)
    for k in (1, 10, 250):
        top = C.top_rows(spark, path, k, A.extreme_events)
        assert [tuple(r) for r in top.collect()] == [tuple(r) for r in A.extreme_events(df, k).collect()]
    files = C.top_files(spark, path, 10)
    assert len(files) <= most
    assert len(C.top_rows(spark, path, 10, A.extreme_events).inputFiles()) == len(files)
    assert C.top_rows(spark, path, 5000, A.extreme_events).count() == 600


def test_a_key_is_looked_up_in_its_files(spark, tmp_path):
    df, path = table(spark, 900, [1.0, 2.0]), str(tmp_path)
    C.write_clustered(df, path, [S.TIMESTAMP, S.LOCATION_ID], FILES)
    day = "2031-05-07T00:00:00"
    found = C.rows_between(spark, path, S.TIMESTAMP, day)
    assert found.count() == df.filter(F.col(S.TIMESTAMP) == day).count() > 0
    assert len(found.inputFiles()) <= 2
    assert "GreaterThanOrEqual(timestamp" in found._jdf.queryExecution().executedPlan().toString()
    span = C.rows_between(spark, path, S.TIMESTAMP, "2031-05-03", "2031-05-09")
    assert span.count() == df.filter(F.col(S.TIMESTAMP).between("2031-05-03", "2031-05-09")).count()
    assert C.rows_between(spark, path, S.TIMESTAMP, "2032").count() == 0


def test_rows_are_read_back_in_order_without_a_sort(spark, tmp_path):
    df, path = table(spark, 700, [float(v) for v in range(300)] + [None]), str(tmp_path)
    C.write_clustered(df, path, [f"-{S.RAINFALL}", S.TIMESTAMP], FILES)
    assert C.clustered_files(spark, path).count() > 1
    keys = [(r[S.RAINFALL], r[S.TIMESTAMP]) for r in C.rows_in_order(spark, path)]
    want = df.orderBy(F.desc_nulls_last(S.RAINFALL), F.asc_nulls_last(S.TIMESTAMP)).collect()
    assert keys == [(r[S.RAINFALL], r[S.TIMESTAMP]) for r in want]


def test_empty(spark, tmp_path):
    C.write_clustered(table(spark, 0, [1.0]), str(tmp_path), [S.RAINFALL])
    assert C.top_rows(spark, str(tmp_path), 5, A.extreme_events).count() == 0
    assert list(C.rows_in_order(spark, str(tmp_path))) == []
