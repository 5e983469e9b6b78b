"""Stream results kept as tables: markers, compaction, late rows."""

import os

import pytest
from pyspark.sql import functions as F

from riverwatch import schema as S
from riverwatch.operators import analytics as A
from riverwatch.sinks import commits
from riverwatch.sources.files import read_alerts, read_archive
from riverwatch.streaming import speed
from riverwatch.streaming.late import WindowsWithLateRows
from riverwatch.streaming.updates import compact, read_window_updates, write_update

ALERT = '{"timestamp":"2031-05-01T00:0%d:00","location_id":"P","rainfall_mm_per_hr":9,"river_level_m":6}'


def put(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def run(spark, src, cfg):
    speed.await_all(spark, speed.start_speed_layer(spark.readStream.text(src), cfg))


def test_archive_and_alerts_count_together(spark, tmp_path, monkeypatch):
    src = f"{tmp_path}/in"
    cfg = speed.SpeedConfig(checkpoint_root=f"{tmp_path}/ck", alerts_path=f"{tmp_path}/alerts",
                            raw_path=f"{tmp_path}/raw", stats=False, shared_stateless=True, available_now=True)

    def seen():
        return (read_alerts(spark, cfg.alerts_path).count(),
                read_archive(spark, cfg.raw_path, cfg.alerts_path).count())

    put(src, "a.txt", [ALERT % 1, "not json"])
    run(spark, src, cfg)
    assert seen() == (1, 2)
    put(src, "b.txt", [ALERT % 2, ALERT % 3])
    real = speed.alerts_stream
    monkeypatch.setattr(speed, "alerts_stream", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(Exception):  # the archive is written, the alerts are not
        run(spark, src, cfg)
    assert os.path.isdir(f"{tmp_path}/raw/batch_id=1") and seen() == (1, 2)
    monkeypatch.setattr(speed, "alerts_stream", real)
    run(spark, src, cfg)
    assert seen() == (3, 4)


def test_markers(spark, tmp_path):
    root = str(tmp_path / "t")
    assert commits.last_commit(spark, root) is None
    commits.begin(spark, root)
    assert commits.last_commit(spark, root) == -1
    for n in range(9):
        commits.commit(spark, root, n)
    assert commits.last_commit(spark, root) == 8 and len(os.listdir(f"{root}/_commits")) <= 2 * commits.KEEP + 2


def window_rows(spark, rows):
    """rows of (minute, location, count) as update-mode output."""
    df = spark.createDataFrame(rows, "m int, location_id string, record_count long")
    t = F.expr("TIMESTAMP '2031-05-01 00:00:00' + make_interval(0, 0, 0, 0, 0, m)")
    return df.select(F.struct(t.alias("start"), (t + F.expr("INTERVAL 5 MINUTES")).alias("end")).alias("window"),
                     "location_id", F.lit(1.5).alias("avg_rainfall"), F.lit(2.0).alias("max_rainfall"),
                     F.lit(None).cast("double").alias("avg_river_level"),
                     F.lit(None).cast("double").alias("max_river_level"), "record_count")


def test_compaction_keeps_the_newest_and_bounds_folders(spark, tmp_path):
    path, want = str(tmp_path / "stats"), {}
    for n in range(12):
        rows = [(5 * (n // 2), "A", n + 1), (5 * max(0, n // 2 - 1), "B", 10 * n), (5 * (n // 2), None, n)]
        write_update(window_rows(spark, rows), n, path)
        want.update({(m, loc): c for m, loc, c in rows})
        if n % 3 == 2:
            assert compact(spark, path, "10 minutes")
            assert not [d for d in os.listdir(path) if d.startswith("batch_id=")]
        got = {((r.window.start.minute), r.location_id): r.record_count for r in read_window_updates(spark, path).collect()}
        assert got == want and read_window_updates(spark, path).count() == len(want)
    assert not compact(spark, path, "10 minutes")  # nothing new
    assert len(os.listdir(f"{path}/_base")) <= 2
    # closed windows are written once and are not in the base any more
    closed = spark.read.parquet(f"{path}/_closed")
    assert closed.count() == closed.select("window", "location_id").distinct().count() > 0
    # a batch without its marker does not count
    window_rows(spark, [(30, "A", 99)]).write.parquet(f"{path}/batch_id=12")
    assert read_window_updates(spark, path).filter("record_count = 99").count() == 0


def reading(minute, loc="P", rain=1.0):
    return (None if minute is None else f"2031-05-01T{minute // 60:02d}:{minute % 60:02d}:00", loc, 0.0, rain, 9.0, 2.0)


def test_late_rows_and_kept_rows_add_up(spark, tmp_path, monkeypatch):
    src, layer = f"{tmp_path}/in", WindowsWithLateRows(spark, f"{tmp_path}/out")
    # a batch a file; minutes of the readings
    feed = [[0, 1, 6], [30, 2], [31, 4, 14, None], [24, 90], [50, 79, 91], [3]]
    for n, minutes in enumerate(feed):
        spark.createDataFrame([reading(m, rain=float(n)) for m in minutes], S.READING).coalesce(1).write.mode(
            "append").parquet(src)
        stream = spark.readStream.schema(S.READING).parquet(src)
        if n == 3:  # fails after its windows are written: neither side counts it
            from riverwatch.streaming import late as module
            real = module.versions.write_version
            monkeypatch.setattr(module.versions, "write_version", lambda *a, **k: (_ for _ in ()).throw(OSError("x")))
            with pytest.raises(Exception):
                layer.start(stream, available_now=True).awaitTermination()
            monkeypatch.setattr(module.versions, "write_version", real)
        layer.start(stream, available_now=True).awaitTermination()
    # watermarks (minutes): none, -4, 20, 21, 80, 81
    late = sorted((r.batch_id, r.why, r.timestamp) for r in layer.late().collect())
    assert [(b, w) for b, w, _ in late] == [(2, "late"), (2, "late"), (2, "no_time"), (4, "late"), (4, "late"),
                                            (5, "late")]
    kept = layer.closed().unionByName(layer.open())
    assert kept.agg(F.sum("record_count")).first()[0] + len(late) == sum(map(len, feed))
    counts = {r.window.start.hour * 60 + r.window.start.minute: (r.record_count, r.max_rainfall)
              for r in layer.closed().collect()}
    assert counts == {0: (3, 1.0), 5: (1, 0.0), 20: (1, 3.0), 30: (2, 2.0)}
    assert {r.window.start.minute for r in layer.open().collect()} == {30}  # 01:30
    assert len([d for d in os.listdir(f"{tmp_path}/out/windows") if os.path.isdir(
        f"{tmp_path}/out/windows/{d}/done=false")]) == 1
    assert A.flatten_window(layer.closed()).columns[0] == "window_start"


def test_each_batch_of_the_feed_is_a_file_for_every_core(spark, tmp_path):
    """Also a batch with few events or none; events without a time are in no batch."""
    from riverwatch.plans import registry

    minutes = [0, 0, 1, 700, *range(900, 1000), None]  # of seven batches the third, fourth and sixth are empty
    rows = [(i, m) for i, m in enumerate(minutes)]
    spark.createDataFrame(rows, "event_id long, m int").select(
        "event_id", F.expr("TIMESTAMP_NTZ '2031-05-01 00:00:00' + make_interval(0, 0, 0, 0, 0, m)").alias("ts"),
        F.col("event_id").alias("user_id"), F.lit(None).cast("string").alias("event_type"),
        F.lit(1.5).alias("value"), F.lit('{"k": 9}').alias("props")).write.parquet(f"{tmp_path}/events.parquet")
    for late in (False, True):
        got = {}

        def take(df, n):
            got[n] = sorted(r.s for r in df.select(F.get_json_object(F.col("value").cast("string"), "$.timestamp").alias("s")).collect())

        query = registry._fed_in_batches(spark, str(tmp_path), 7, late).writeStream.foreachBatch(take).option(
            "checkpointLocation", f"{tmp_path}/ck{late}").trigger(availableNow=True).start()
        query.awaitTermination()
        want = {n: [] for n in range(9 if late else 7)}
        for i, m in rows:
            if m is not None:
                want[m * 60_000_000 * 7 // (999 * 60_000_000 + 1) + (2 if late and i % 7 == 0 else 0)].append(
                    f"2031-05-01T{m // 60:02d}:{m % 60:02d}:00")
        assert got == {n: sorted(v) for n, v in want.items()}
        for n in want:  # the source's log of each micro-batch: a line for the format, then the files
            with open(f"{tmp_path}/ck{late}/sources/0/{n}") as f:
                assert len(f.readlines()) == 1 + spark.sparkContext.defaultParallelism
