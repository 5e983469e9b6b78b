"""Kafka adapter: option building (no broker is reachable here)."""

from riverwatch.sources.kafka import kafka_options


def test_batch_options():
    o = kafka_options("b:9092", "t", "earliest", "latest", min_partitions=64)
    assert o == {"kafka.bootstrap.servers": "b:9092", "subscribe": "t",
                 "startingOffsets": "earliest", "endingOffsets": "latest", "minPartitions": "64"}


def test_stream_options():
    o = kafka_options("b:9092", "t", "latest", max_offsets_per_trigger=100000,
                      extra={"failOnDataLoss": "false"})
    assert "endingOffsets" not in o
    assert o["maxOffsetsPerTrigger"] == "100000" and o["failOnDataLoss"] == "false"


def test_read_messages_needs_one_source(spark):
    import pytest
    from riverwatch.sources.messages import read_messages
    with pytest.raises(ValueError):
        read_messages(spark)
    with pytest.raises(ValueError):
        read_messages(spark, "b:9092", "t", path="/x")
    with pytest.raises(ValueError):
        read_messages(spark, "b:9092")


def test_read_messages_files(spark, tmp_path):
    from riverwatch.operators.decode import decode_kafka_batch
    from riverwatch.sources.messages import read_messages
    (tmp_path / "m.txt").write_text('{"location_id":"A","rainfall_mm_per_hr":6.0}\n')
    df = decode_kafka_batch(read_messages(spark, path=str(tmp_path)))
    r = df.first()
    assert r.location_id == "A" and r.rainfall_mm_per_hr == 6.0 and r.kafka_timestamp is not None
    s = read_messages(spark, path=str(tmp_path), stream=True)
    assert s.isStreaming and "value" in s.columns


def test_options_without_a_meaning_are_refused(spark):
    import pytest
    from riverwatch.sources.messages import read_messages
    for stream, option in ((False, "starting_offsets"), (True, "max_offsets_per_trigger"),
                           (False, "max_files_per_trigger"), (True, "min_partitions")):
        with pytest.raises(ValueError, match=option):
            read_messages(spark, path="/x", stream=stream, **{option: 1})
    with pytest.raises(ValueError, match="max_offsets_per_trigger"):
        read_messages(spark, "b:9092", "t", max_offsets_per_trigger=5)


def test_offsets_reach_the_reader(spark, monkeypatch):
    from riverwatch.sources import kafka
    from riverwatch.sources.messages import read_messages
    seen = []
    monkeypatch.setattr(kafka, "kafka_options", lambda *a, **k: seen.append(a) or (_ for _ in ()).throw(KeyError))
    for stream, given in ((True, "earliest"), (True, None), (False, None)):
        try:
            read_messages(spark, "b:9092", "t", stream=stream, starting_offsets=given, min_partitions=7)
        except KeyError:
            pass
    assert [a[2] for a in seen] == ["earliest", "latest", "earliest"]
    assert all(a[4] == 7 for a in seen)
