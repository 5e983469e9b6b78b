"""Speed layer on file sources with availableNow (FIXTURES.md section 6)."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from riverwatch import schema as S
from riverwatch.operators import analytics as A
from riverwatch.operators.classify import flood_alerts
from riverwatch.operators.decode import decode_messages
from riverwatch.session import local_dir, work_path
from riverwatch.sinks.versions import KEEP, read_current
from riverwatch.sources.files import read_alerts, read_message_files, read_message_stream
from riverwatch.streaming.speed import SpeedConfig, await_all, start_speed_layer, stop_all

from samples import GOLDEN


def _write_batches(folder, batches):
    """One text file per micro-batch, increasing modification times."""
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 1000
    for i, rows in enumerate(batches):
        p = os.path.join(folder, f"part-{i:04d}.txt")
        with open(p, "w") as f:
            for r in rows:
                f.write(json.dumps(r) + "\n")
        os.utime(p, (base + i, base + i))


def _reading(ts, rain, river=1.0, loc="A"):
    return {"timestamp": ts, "location_id": loc, "elevation_m": 1.0,
            "rainfall_mm_per_hr": rain, "temperature_c": 20.0, "river_level_m": river}


def _golden_msgs():
    keys = S.READING_COLUMNS
    return [dict(zip(keys, g)) for g in GOLDEN]


def _cfg(spark, root, **kw):
    kw.setdefault("available_now", True)
    kw.setdefault("stats_memory", "stats_path" not in kw)
    return SpeedConfig(checkpoint_root=f"{root}/ckpt", **kw)


def test_stream_equals_batch(spark):
    root = work_path(spark, "test-stream")
    src_dir = local_dir(f"{root}/in")
    msgs = _golden_msgs()
    _write_batches(src_dir, [msgs[:2], msgs[2:4], msgs[4:]])
    cfg = _cfg(spark, root, alerts_path=f"{root}/alerts", raw_path=f"{root}/raw",
               stats_path=f"{root}/stats", time_col="event")
    raw = read_message_stream(spark, src_dir, max_files_per_trigger=1)
    qs = start_speed_layer(raw, cfg)
    await_all(spark, qs)
    batch = decode_messages(read_message_files(spark, src_dir))
    # alerts = batch alerts
    got = sorted(tuple(r) for r in read_alerts(spark, cfg.alerts_path).collect())
    assert got == sorted(tuple(r) for r in flood_alerts(batch).collect())
    assert len(got) == 2
    # complete-mode stats = batch groupBy
    from riverwatch.functions.timeparse import instant
    direct = A.windowed_stats(batch.withColumn("t", instant(S.TIMESTAMP)), "t")
    s = read_current(spark, cfg.stats_path)
    assert sorted(tuple(r) for r in s.collect()) == sorted(tuple(r) for r in direct.collect())
    # raw archive holds the messages unchanged
    lines = sorted(r.value for r in spark.read.text(cfg.raw_path).collect())
    assert lines == sorted(json.dumps(m) for m in msgs)


def test_processing_time_default_and_memory_sink(spark):
    root = work_path(spark, "test-stream-pt")
    src_dir = local_dir(f"{root}/in")
    _write_batches(src_dir, [_golden_msgs()])
    cfg = _cfg(spark, root, stats_query_name="rt_stats_test")
    qs = start_speed_layer(read_message_stream(spark, src_dir), cfg)
    await_all(spark, qs)
    rows = spark.sql("SELECT * FROM rt_stats_test").collect()
    # one micro-batch: processing_time is one value, so one window per location
    assert sorted((r.location_id, r.record_count) for r in rows) == [("LOC001", 4), ("LOC002", 2)]


LATE = [
    [_reading("2024-01-01T00:00:00", 1.0)],
    [_reading("2024-01-01T01:00:00", 2.0)],
    [_reading("2024-01-01T01:05:00", 2.0)],
    [_reading("2024-01-01T00:01:00", 100.0)],
    [_reading("2024-01-01T03:00:00", 2.0)],
]


@pytest.mark.parametrize("mode,first_max,first_count,dropped,windows", [
    ("append", 1.0, 1, 1, ["00:00", "01:00", "01:05"]),
    ("update", 1.0, 1, 1, ["00:00", "01:00", "01:05", "03:00"]),
    ("complete", 100.0, 2, 0, ["00:00", "01:00", "01:05", "03:00"]),
])
def test_late_row(spark, mode, first_max, first_count, dropped, windows):
    root = work_path(spark, f"test-late-{mode}")
    src_dir = local_dir(f"{root}/in")
    _write_batches(src_dir, LATE)
    name = f"late_{mode}"
    cfg = _cfg(spark, root, stats_mode=mode, time_col="event", stats_query_name=name)
    qs = start_speed_layer(read_message_stream(spark, src_dir, max_files_per_trigger=1), cfg)
    await_all(spark, qs)
    out = spark.sql(f"SELECT * FROM {name}")
    got = out.select(F.date_format(F.col("window.start").cast("timestamp_ntz"), "HH:mm").alias("w"),
                     "max_rainfall", "record_count").collect()
    assert sorted({r.w for r in got}) == windows
    firsts = [r for r in got if r.w == "00:00"]
    assert max(r.max_rainfall for r in firsts) == first_max
    assert max(r.record_count for r in firsts) == first_count
    n_dropped = sum(
        op.numRowsDroppedByWatermark
        for p in qs[-1].recentProgress for op in p.stateOperators)
    assert n_dropped == dropped


def test_restart_no_duplicates(spark):
    root = work_path(spark, "test-restart")
    src_dir = local_dir(f"{root}/in")
    msgs = _golden_msgs()
    _write_batches(src_dir, [msgs[:3]])
    cfg = _cfg(spark, root, alerts_path=f"{root}/alerts", stats_path=f"{root}/stats",
               time_col="event")
    await_all(spark, start_speed_layer(read_message_stream(spark, src_dir), cfg))
    assert read_alerts(spark, cfg.alerts_path).count() == 1
    # new file arrives; same checkpoints: only the new alert is added
    with open(os.path.join(src_dir, "part-9999.txt"), "w") as f:
        for m in msgs[3:]:
            f.write(json.dumps(m) + "\n")
    await_all(spark, start_speed_layer(read_message_stream(spark, src_dir), cfg))
    alerts = read_alerts(spark, cfg.alerts_path).collect()
    assert len(alerts) == 2 and len({tuple(a) for a in alerts}) == 2
    stats = read_current(spark, cfg.stats_path)
    assert stats.agg(F.sum("record_count")).first()[0] == 6


def test_alert_files_per_batch(spark):
    root = work_path(spark, "test-alert-files")
    src_dir = local_dir(f"{root}/in")
    _write_batches(src_dir, [_golden_msgs()])
    cfg = _cfg(spark, root, alerts_path=f"{root}/alerts", stats=False, alert_files_per_batch=1)
    raw = read_message_stream(spark, src_dir).repartition(3)
    await_all(spark, start_speed_layer(raw, cfg))
    files = [f for f in os.listdir(local_dir(cfg.alerts_path)) if f.endswith(".json")]
    assert len(files) == 1
    assert read_alerts(spark, cfg.alerts_path).count() == 2


def test_append_mode_parquet_stats(spark):
    """Append mode writes each window once the watermark has passed it."""
    root = work_path(spark, "test-append-parquet")
    src_dir = local_dir(f"{root}/in")
    _write_batches(src_dir, LATE)
    cfg = _cfg(spark, root, stats_mode="append", time_col="event", stats_path=f"{root}/stats")
    await_all(spark, start_speed_layer(read_message_stream(spark, src_dir, max_files_per_trigger=1), cfg))
    got = spark.read.parquet(cfg.stats_path).select(
        F.date_format(F.col("window.start").cast("timestamp_ntz"), "HH:mm").alias("w"),
        "max_rainfall", "record_count").collect()
    assert sorted((r.w, r.max_rainfall, r.record_count) for r in got) == [
        ("00:00", 1.0, 1), ("01:00", 2.0, 1), ("01:05", 2.0, 1)]


def test_update_mode_parquet_stats(spark):
    """Update mode to a table: per-batch versions, newest per group wins;
    the result equals the update-mode expectations of the late-row test."""
    from riverwatch.streaming.speed import latest_window_stats
    root = work_path(spark, "test-update-parquet")
    src_dir = local_dir(f"{root}/in")
    _write_batches(src_dir, LATE)
    cfg = _cfg(spark, root, stats_mode="update", time_col="event", stats_path=f"{root}/stats")
    await_all(spark, start_speed_layer(read_message_stream(spark, src_dir, max_files_per_trigger=1), cfg))
    latest = latest_window_stats(spark.read.parquet(cfg.stats_path))
    got = latest.select(
        F.date_format(F.col("window.start").cast("timestamp_ntz"), "HH:mm").alias("w"),
        "max_rainfall", "record_count").collect()
    assert sorted((r.w, r.max_rainfall, r.record_count) for r in got) == [
        ("00:00", 1.0, 1), ("01:00", 2.0, 1), ("01:05", 2.0, 1), ("03:00", 2.0, 1)]


def test_update_mode_newest_version_wins(spark):
    from riverwatch.streaming.speed import latest_window_stats
    root = work_path(spark, "test-update-newest")
    src_dir = local_dir(f"{root}/in")
    _write_batches(src_dir, [[_reading("2024-01-01T00:00:00", 1.0)],
                             [_reading("2024-01-01T00:02:00", 3.0)]])
    cfg = _cfg(spark, root, stats_mode="update", time_col="event", stats_path=f"{root}/stats")
    await_all(spark, start_speed_layer(read_message_stream(spark, src_dir, max_files_per_trigger=1), cfg))
    versions = spark.read.parquet(cfg.stats_path)
    assert versions.count() == 2  # the window was emitted by both batches
    (r,) = latest_window_stats(versions).collect()
    assert (r.max_rainfall, r.record_count, r.avg_rainfall) == (3.0, 2, 2.0)


def test_rocksdb_state_store(spark):
    from riverwatch.session import ROCKSDB_PROVIDER
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB_PROVIDER)
    try:
        root = work_path(spark, "test-rocksdb")
        src_dir = local_dir(f"{root}/in")
        _write_batches(src_dir, LATE)
        cfg = _cfg(spark, root, stats_mode="complete", time_col="event", stats_path=f"{root}/stats")
        await_all(spark, start_speed_layer(read_message_stream(spark, src_dir, max_files_per_trigger=1), cfg))
        rows = read_current(spark, cfg.stats_path).collect()
        assert sum(r.record_count for r in rows) == 5 and len(rows) == 4
    finally:
        if old:
            spark.conf.set(key, old)
        else:
            spark.conf.unset(key)


def test_shared_stateless_fanout(spark):
    """One read of the source for alerts and raw archive; a restart adds the
    new batch only."""
    root = work_path(spark, "test-shared")
    src_dir = local_dir(f"{root}/in")
    msgs = _golden_msgs()
    _write_batches(src_dir, [msgs[:3]])
    cfg = _cfg(spark, root, alerts_path=f"{root}/alerts", raw_path=f"{root}/raw",
               stats=False, shared_stateless=True)
    qs = start_speed_layer(read_message_stream(spark, src_dir), cfg)
    assert len(qs) == 1
    await_all(spark, qs)
    with open(os.path.join(src_dir, "part-9999.txt"), "w") as f:
        for m in msgs[3:]:
            f.write(json.dumps(m) + "\n")
    await_all(spark, start_speed_layer(read_message_stream(spark, src_dir), cfg))
    alerts = read_alerts(spark, cfg.alerts_path)
    assert alerts.columns == S.ALERT.fieldNames()
    batch = decode_messages(read_message_files(spark, src_dir))
    assert sorted(tuple(r) for r in alerts.collect()) == sorted(tuple(r) for r in flood_alerts(batch).collect())
    lines = sorted(r.value for r in spark.read.text(cfg.raw_path).select("value").collect())
    assert lines == sorted(json.dumps(m) for m in msgs)


def test_await_all_stops_on_interrupt(spark, monkeypatch):
    root = work_path(spark, "test-interrupt")
    src_dir = local_dir(f"{root}/in")
    _write_batches(src_dir, [_golden_msgs()])
    cfg = _cfg(spark, root, available_now=False, trigger=None, stats_query_name="intr_test",
               alerts_path=f"{root}/alerts")
    qs = start_speed_layer(read_message_stream(spark, src_dir), cfg)

    def interrupted(*a, **k):
        raise KeyboardInterrupt

    monkeypatch.setattr(type(qs[0]), "awaitTermination", interrupted)
    with pytest.raises(KeyboardInterrupt):
        await_all(spark, qs)
    assert not any(q.isActive for q in qs)


def test_state_partitions(spark):
    root = work_path(spark, "test-state-parts")
    src_dir = local_dir(f"{root}/in")
    _write_batches(src_dir, [_golden_msgs()])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    cfg = _cfg(spark, root, time_col="event", stats_path=f"{root}/stats", state_partitions=3)
    qs = start_speed_layer(read_message_stream(spark, src_dir), cfg)
    await_all(spark, qs)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    ops = qs[-1].lastProgress["stateOperators"]
    assert ops[0]["numShufflePartitions"] == 3
    assert read_current(spark, cfg.stats_path).agg(F.sum("record_count")).first()[0] == 6


def test_live_triggers_pick_up_new_files(spark):
    """ST-6 with real processing-time triggers: files arriving while the
    queries run are picked up; then all queries stop."""
    root = work_path(spark, "test-live")
    src_dir = local_dir(f"{root}/in")
    msgs = _golden_msgs()
    _write_batches(src_dir, [msgs[:2]])
    cfg = _cfg(spark, root, available_now=False, trigger="1 second", time_col="event",
               alerts_path=f"{root}/alerts", stats_path=f"{root}/stats")
    qs = start_speed_layer(read_message_stream(spark, src_dir), cfg)
    try:
        for q in qs:
            q.processAllAvailable()
        assert read_alerts(spark, cfg.alerts_path).count() == 0  # first two: no alert
        for i, m in enumerate(msgs[2:]):
            with open(os.path.join(src_dir, f"late-{i}.txt"), "w") as f:
                f.write(json.dumps(m) + "\n")
        for q in qs:
            q.processAllAvailable()
        assert read_alerts(spark, cfg.alerts_path).count() == 2
        stats = read_current(spark, cfg.stats_path)
        assert stats.agg(F.sum("record_count")).first()[0] == 6
        assert all(q.isActive for q in qs)
    finally:
        stop_all(qs)
    assert not any(q.isActive for q in qs)


@pytest.mark.parametrize("shared", [False, True])
def test_alerts_top_index_serves_same_answer(spark, shared):
    """Latest alerts from the per-batch top-k index equal the full scan."""
    from samples import SF001
    from riverwatch.plans.serving import ServingLayer
    from riverwatch.sources import readings as R
    root = work_path(spark, f"test-top-index-{shared}")
    src_dir = f"{root}/in"
    (R.messages_from_events(R.load_table(spark, SF001, "events")).select(
        F.col("value").cast("string").alias("value")).repartition(4).write.text(src_dir))
    cfg = _cfg(spark, root, alerts_path=f"{root}/alerts", alerts_top_path=f"{root}/top",
               stats=False, shared_stateless=shared)
    await_all(spark, start_speed_layer(read_message_stream(spark, src_dir, max_files_per_trigger=1), cfg))
    assert read_current(spark, cfg.alerts_top_path).count() == cfg.alerts_top_k
    assert len(os.listdir(local_dir(cfg.alerts_top_path))) <= KEEP  # four batches, old ones gone
    fast = ServingLayer(spark, work_path(spark, "nb"), cfg.alerts_path, cfg.alerts_top_path)
    full = ServingLayer(spark, work_path(spark, "nb"), cfg.alerts_path)
    for n in (3, 10):
        assert [tuple(r) for r in fast.get_realtime_alerts(n).collect()] == \
               [tuple(r) for r in full.get_realtime_alerts(n).collect()]


def test_stop_all_on_failure(spark):
    root = work_path(spark, "test-stop")
    src_dir = local_dir(f"{root}/in")
    _write_batches(src_dir, [_golden_msgs()])
    cfg = _cfg(spark, root, available_now=False, trigger=None, stats_query_name="stop_test")
    qs = start_speed_layer(read_message_stream(spark, src_dir), cfg)
    assert all(q.isActive for q in qs)
    stop_all(qs)
    assert not any(q.isActive for q in qs)


def test_await_all_sees_a_failure_beside_a_live_query(spark):
    import time
    from pyspark.sql import functions as F
    root = work_path(spark, "test-await")
    live = (spark.readStream.format("rate").load().writeStream.format("noop")
            .option("checkpointLocation", f"{root}/live").start())
    bad = (spark.readStream.format("rate").load().select(F.raise_error(F.lit("boom"))).writeStream
           .format("noop").option("checkpointLocation", f"{root}/bad").start())
    began = time.monotonic()
    with pytest.raises(Exception, match="boom"):
        await_all(spark, [live, bad])
    assert time.monotonic() - began < 30 and not live.isActive and not bad.isActive


def test_await_all_timeout_is_for_all(spark):
    import time
    root = work_path(spark, "test-await")
    qs = [(spark.readStream.format("rate").load().writeStream.format("noop")
           .option("checkpointLocation", f"{root}/{i}").start()) for i in range(3)]
    began = time.monotonic()
    await_all(spark, qs, timeout=2)
    assert time.monotonic() - began < 5 and all(q.isActive for q in qs)
    stop_all(qs)


def test_index_without_alert_files_is_refused(spark):
    root = work_path(spark, "test-index")
    with pytest.raises(ValueError, match="alerts_path"):
        start_speed_layer(spark.readStream.format("rate").load(), SpeedConfig(
            checkpoint_root=root, alerts_top_path=f"{root}/top", stats=False))


def test_index_serves_any_n(spark):
    """Three batches of 30 alerts: n over the index's k is read from the files."""
    from riverwatch.plans.serving import ServingLayer
    root = work_path(spark, "test-index-n")
    src_dir = local_dir(f"{root}/in")
    batches = [[{**_golden_msgs()[0], "timestamp": f"2024-01-{b + 1:02d}T00:{i:02d}:00",
                 "rainfall_mm_per_hr": 9.0} for i in range(30)] for b in range(3)]
    _write_batches(src_dir, batches)
    cfg = _cfg(spark, root, alerts_path=f"{root}/alerts", alerts_top_path=f"{root}/top", stats=False)
    await_all(spark, start_speed_layer(read_message_stream(spark, src_dir, max_files_per_trigger=1), cfg))
    files = ServingLayer(spark, f"{root}/none", cfg.alerts_path)
    both = ServingLayer(spark, f"{root}/none", cfg.alerts_path, cfg.alerts_top_path)
    for n in (3, 10, 50, 100):
        assert [tuple(r) for r in both.query("alerts", n=n).collect()] == [
            tuple(r) for r in files.query("alerts", n=n).collect()]
    assert both.query("alerts", n=100).count() == 90
    with pytest.raises(ValueError, match="asked for 50"):
        ServingLayer(spark, f"{root}/none", None, cfg.alerts_top_path).query("alerts", n=50)


def _index_job(spark, root):
    cfg = _cfg(spark, root, alerts_path=f"{root}/alerts", alerts_top_path=f"{root}/top",
               alerts_top_k=4, stats=False)
    src_dir = local_dir(f"{root}/in")
    rows = [{**_golden_msgs()[0], "timestamp": f"2024-02-{d + 1:02d}T00:00:0{i}", "rainfall_mm_per_hr": 9.0}
            for d in range(3) for i in (0, 0, 1)]  # each day holds one alert twice
    _write_batches(src_dir, [rows[i:i + 3] for i in (0, 3, 6)])
    await_all(spark, start_speed_layer(read_message_stream(spark, src_dir, 1), cfg))
    return cfg


def _index_is_exact(spark, cfg):
    keys = S.ALERT.fieldNames()
    index = A.recent_alerts(read_current(spark, cfg.alerts_top_path).select(*keys), cfg.alerts_top_k)
    files = A.recent_alerts(read_alerts(spark, cfg.alerts_path), cfg.alerts_top_k)
    return [tuple(r) for r in index.collect()] == [tuple(r) for r in files.collect()]


def test_index_after_a_replayed_batch_holds_nothing_twice(spark):
    from riverwatch.streaming.speed import _write_top
    cfg = _index_job(spark, work_path(spark, "test-replay"))
    assert _index_is_exact(spark, cfg)
    for batch_id in (2, 2, 0):
        _write_top(spark, cfg, batch_id)
        assert _index_is_exact(spark, cfg)


def test_index_added_or_enlarged_later_covers_older_alerts(spark):
    import dataclasses
    from riverwatch.streaming.speed import _write_top
    root = work_path(spark, "test-late-index")
    cfg = _index_job(spark, root)
    for later in (dataclasses.replace(cfg, alerts_top_path=f"{root}/other"),
                  dataclasses.replace(cfg, alerts_top_k=8)):
        _write_top(spark, later, 2)
        assert read_current(spark, later.alerts_top_path).count() == later.alerts_top_k
        assert _index_is_exact(spark, later)


@pytest.mark.parametrize("kind", ["parsed", "raw"])
def test_console_monitors_run(spark, kind):
    """SNK-8 / SNK-9: the console prints from the JVM; the rows it was given are checked."""
    root = work_path(spark, "test-console")
    src_dir = local_dir(f"{root}/in")
    _write_batches(src_dir, [_golden_msgs()])
    qs = start_speed_layer(read_message_stream(spark, src_dir),
                           _cfg(spark, root, console=kind, stats=False))
    await_all(spark, qs)
    assert len(qs) == 1 and sum(p["numInputRows"] for p in qs[0].recentProgress) == 6
