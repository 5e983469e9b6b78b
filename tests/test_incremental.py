"""Incremental batch: later runs read only what is new and give what one run over all gives."""

import random

import pytest
from pyspark.sql import functions as F

from riverwatch import schema as S
from riverwatch.operators import analytics as A
from riverwatch.operators.classify import classify_risk
from riverwatch.operators.decode import decode_kafka_batch, read_triage, triage, write_triage
from riverwatch.plans import incremental as I
from riverwatch.plans.batch import FLOOD_RISK, LOCATION_STATS, RISK_DISTRIBUTION, run_batch
from riverwatch.sources import readings as R

from samples import SF001


def rounded(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def messages(spark):
    return R.messages_from_events(R.load_table(spark, SF001, "events")).cache()


def add(messages, topic, part, of):
    messages.filter(F.col("offset") % of == part).coalesce(2).write.mode("append").parquet(topic)


def stream(spark, messages, topic):
    return spark.readStream.schema(messages.schema).parquet(topic)


def test_runs_add_up_and_read_only_new_files(spark, messages, tmp_path):
    topic, layer = f"{tmp_path}/topic", I.IncrementalBatch(spark, f"{tmp_path}/out")
    assert layer.summary() is None and layer.views() is None
    sizes = []
    for part in range(3):
        add(messages, topic, part, 3)
        sizes.append(layer.run(stream(spark, messages, topic)))
    assert sizes == [messages.filter(F.col("offset") % 3 == p).count() for p in range(3)]
    assert layer.run(stream(spark, messages, topic)) == 0  # nothing new
    whole = classify_risk(decode_kafka_batch(messages))
    assert rounded(layer.summary().select(*A.batch_summary(whole).columns)) == rounded(A.batch_summary(whole))
    views = layer.views()
    assert rounded(views["extreme_events"]) == rounded(A.extreme_events(whole))
    assert rounded(views["flood_risk"].select(*whole.columns)) == rounded(whole)
    assert rounded(views["hourly_patterns"]) == rounded(A.hourly_patterns(whole))
    runs = spark.read.parquet(f"{tmp_path}/out/runs").orderBy("batch_id").collect()
    assert [r.n_rows for r in runs] == sizes
    assert all(a.end == b.start for a, b in zip(runs, runs[1:]))  # ranges follow one another


def test_a_failed_run_is_taken_up(spark, messages, tmp_path, monkeypatch):
    topic, layer = f"{tmp_path}/topic", I.IncrementalBatch(spark, f"{tmp_path}/out")
    add(messages, topic, 0, 2)
    layer.run(stream(spark, messages, topic))
    before = rounded(layer.summary())
    add(messages, topic, 1, 2)
    kept = I.versions.write_version
    monkeypatch.setattr(I.versions, "write_version", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(Exception):  # the readings are written, the states are not
        layer.run(stream(spark, messages, topic))
    assert rounded(layer.summary()) == before
    assert layer.views()["flood_risk"].count() == messages.filter("offset % 2 = 0").count()
    monkeypatch.setattr(I.versions, "write_version", kept)
    layer.run(stream(spark, messages, topic))
    assert layer.views()["flood_risk"].count() == messages.count()
    whole = classify_risk(decode_kafka_batch(messages))
    assert rounded(layer.summary().select(*A.batch_summary(whole).columns)) == rounded(A.batch_summary(whole))
    layer._take(messages, layer.last_batch())  # a replay of a batch that counts changes nothing
    assert layer.views()["flood_risk"].count() == messages.count()


def test_moments_keep_their_digits_and_nulls(spark):
    rng = random.Random(4)
    rows = [("t", f"L{rng.randrange(3)}", 0.0, rng.choice([None, 1e8 + rng.random()]), None,
             rng.choice([None, 1e8 + rng.random()])) for _ in range(400)]
    df = classify_risk(spark.createDataFrame(rows, S.READING)).withColumn("part", F.floor(F.rand(1) * 5)).cache()
    parts = [I.partial_states(df.filter(F.col("part") == k)) for k in range(5)]
    merged = parts[0]
    for p in parts[1:]:
        merged = I.merge_states(merged.unionByName(p))
    got = {tuple(r)[:4]: r for r in I.summary_of(merged).collect()}
    for r in A.batch_summary(df).collect():
        own = got[(r.location_id, r.hour, r.flood_risk_level, r.summary_kind)]
        assert own.total_records == r.total_records and own.avg_temperature is None
        assert own.max_rainfall == r.max_rainfall
        for c in ("correlation", "avg_rainfall"):
            assert (own[c] is None) == (r[c] is None)
            assert r[c] is None or abs(own[c] - r[c]) < 1e-6 * max(1, abs(r[c]))


def test_single_views(spark, messages, tmp_path):
    rows = decode_kafka_batch(messages)
    assert set(run_batch(spark, rows, f"{tmp_path}/a", views=(LOCATION_STATS,))) == {"location_stats"}
    out = run_batch(spark, rows, f"{tmp_path}/b", run_id="x", views=(RISK_DISTRIBUTION, FLOOD_RISK))
    assert rounded(out["risk_distribution"]) == rounded(A.risk_distribution(classify_risk(rows)))
    with pytest.raises(ValueError):
        run_batch(spark, rows, f"{tmp_path}/c", views=("other",))


def test_triage_is_written_in_one_scan_and_read_by_side(spark, messages, tmp_path):
    damaged = R.messages_from_events(R.load_table(spark, SF001, "events"),
                                     damaged=F.col("event_type") == "error")
    path = f"{tmp_path}/sides"
    tagged = triage(damaged)
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("from_json(concat({\"__values") <= 1
    write_triage(tagged, path)
    good, bad = read_triage(spark, path)
    assert good.count() + bad.count() == damaged.count() and bad.count() > 0
    for side in (good, bad):
        text = side._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in text and "problem" in text.split("PartitionFilters: [")[1].split("]")[0]
    write_triage(triage(messages), f"{path}2")  # no problems at all
    good, bad = read_triage(spark, f"{path}2")
    assert (good.count(), bad.count()) == (messages.count(), 0)
