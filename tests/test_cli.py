"""CLI commands on file sources: produce -> batch -> serve."""

from riverwatch.cli import run
from riverwatch.session import local_dir, work_path

from samples import GOLDEN


def test_produce_batch_serve(spark, tmp_path, capsys):
    csv = tmp_path / "w.csv"
    csv.write_text("timestamp,location_id,elevation_m,rainfall_mm_per_hr,temperature_c,river_level_m\n"
                   + "\n".join(",".join(map(str, g)) for g in GOLDEN) + "\n")
    root = work_path(spark, "test-cli")
    msgs, out = f"{root}/messages", f"{root}/batch"
    assert run(spark, ["produce", "--csv", str(csv), "--messages", msgs]) == 0
    lines = spark.read.text(msgs).count()
    assert lines == 6
    capsys.readouterr()
    assert run(spark, ["batch", "--messages", msgs, "--out", out, "--run-id", "x"]) == 0
    assert "loaded 6 records" in capsys.readouterr().out
    assert run(spark, ["serve", "--batch", out, "risk_summary"]) == 0
    shown = capsys.readouterr().out
    for level in ("LOW", "MODERATE", "HIGH", "CRITICAL"):
        assert level in shown
    assert run(spark, ["serve", "--batch", out, "location", "--location", "LOC002"]) == 0
    assert "LOC002" in capsys.readouterr().out
    assert run(spark, ["serve", "--batch", local_dir(f"{root}/none"), "high_risk"]) == 1


def test_speed_and_triage_once(spark, tmp_path, capsys):
    import json
    src = tmp_path / "in"
    src.mkdir()
    rows = [dict(zip(["timestamp", "location_id", "elevation_m", "rainfall_mm_per_hr",
                      "temperature_c", "river_level_m"], g)) for g in GOLDEN]
    (src / "a.txt").write_text("\n".join(json.dumps(r) for r in rows) + "\nnot json\n")
    root = work_path(spark, "test-cli-speed")
    out = f"{root}/out"
    assert run(spark, ["speed", "--messages", str(src), "--out", out, "--event-time", "--once",
                       "--checkpoint", f"{root}/ckpt"]) == 0
    from riverwatch.sources.files import read_alerts
    assert read_alerts(spark, f"{out}/flood_alerts").count() == 2
    from riverwatch.sinks.versions import read_current
    stats = read_current(spark, f"{out}/windowed_stats")
    # event-time windows: the undecodable line has no time, so no window
    assert stats.agg({"record_count": "sum"}).first()[0] == 6
    # append mode through the CLI: windows close once the watermark passes
    out2 = f"{root}/out2"
    assert run(spark, ["speed", "--messages", str(src), "--out", out2, "--event-time", "--once",
                       "--stats-mode", "append", "--checkpoint", f"{root}/ckpt2"]) == 0
    assert spark.read.parquet(f"{out2}/windowed_stats").count() >= 1
    # the console sink prints from the JVM; here only the run is checked
    assert run(spark, ["triage", "--messages", str(src), "--once", "--checkpoint", f"{root}/t"]) == 0


def test_argument_errors(spark):
    import pytest
    with pytest.raises(SystemExit):
        run(spark, ["batch", "--kafka", "b:9092", "--out", "/x"])  # no topic
    with pytest.raises(SystemExit):
        run(spark, ["speed", "--out", "/x"])  # no source
    with pytest.raises(SystemExit):
        run(spark, ["serve", "--batch", "/x", "nope"])  # unknown query


def test_ignored_options_are_errors_and_triage_starts_at_the_beginning(spark):
    import pytest
    from riverwatch.cli import _parse
    for argv in (["batch", "--messages", "/m", "--out", "/o", "--once"],
                 ["batch", "--messages", "/m", "--out", "/o", "--checkpoint", "/c"],
                 ["triage", "--messages", "/m", "--max-offsets", "5"],
                 ["speed", "--messages", "/m", "--out", "/o", "--starting-offsets", "latest"],
                 ["speed", "--kafka", "b", "--topic", "t", "--out", "/o", "--max-files", "1"]):
        with pytest.raises(SystemExit):
            _parse(argv)
    assert _parse(["triage", "--kafka", "b", "--topic", "t"]).starting_offsets == "earliest"
    assert _parse(["speed", "--kafka", "b", "--topic", "t", "--out", "/o"]).starting_offsets is None
