import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from riverwatch.llm import sharding as S


def check(data, rows, shards):
    assert Counter((r.id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in data)
    counts = Counter(r.shard for r in rows)
    assert set(counts) <= set(range(shards))
    assert max(counts.values()) - min(counts[s] for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def homes(rows):
    """Shards that hold rows of each repeated text."""
    by = defaultdict(set)
    n = Counter(r.text_crc32 for r in rows)
    for r in rows:
        by[r.text_crc32].add(r.shard)
    return {c: len(s) for c, s in by.items() if n[c] > 1}


def run(documents, data, shards=16):
    rows = S.shard_documents(documents([(i, t, "en", "s", 0) for i, t in data]), shards).collect()
    check(data, rows, shards)
    return rows


def test_groups_stay_together(documents):
    rng = random.Random(5)
    data = []
    for g in range(150):
        data += [(len(data) + k, f"group {g}") for k in range(rng.choice([2, 3, 5, 9]))]
    data += [(len(data) + k, f"single {k}") for k in range(1200)]
    rng.shuffle(data)
    cut = [c for c, n in homes(run(documents, data)).items() if n > 1]
    assert len(cut) <= 5


def test_hot_group_and_edges(documents):
    data = [(i, "hot") for i in range(700)] + [(1000 + i, f"text é {i % 500}") for i in range(800)]
    data += [(None, None), (None, ""), (7, "x" * 100000), (7, "x" * 100000), (5000, None)]
    rows = run(documents, data)
    cut = [n for c, n in homes(rows).items() if n > 1]
    assert len(cut) < 60


def test_only_linked_rows(documents):
    run(documents, [(i, f"t{i % 40}") for i in range(400)], 7)
    run(documents, [(i, "same") for i in range(50)], 16)


def test_few_rows_and_empty(documents):
    run(documents, [(1, "a"), (2, "a"), (3, "b")])
    assert S.shard_documents(documents([])).count() == 0


def test_oversize_start_is_cut_exactly(spark, documents, monkeypatch):
    """More linked rows in a shard than it may have: some give up their places."""
    real = S.propagate
    monkeypatch.setattr(S, "propagate", lambda nodes, m, n, q, r: real(nodes.withColumn("shard", F.lit(3)), m, n, q, 0))
    run(documents, [(i, f"t{i % 50}") for i in range(200)] + [(900 + i, f"s{i}") for i in range(40)], 8)


def test_query(spark, tmp_path, documents):
    documents(["a", "a", None, "b"]).write.parquet(str(tmp_path / "documents.parquet"))
    out = S.op2_sharding(spark, str(tmp_path))
    assert dict(out.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string",
                                "shard": "int", "slot": "bigint", "grown_shard": "int"}
    assert {r.law for r in out.collect()} == {"rows"}


def test_groups_stay_whole_when_all_rows_are_linked(documents):
    for size, linked in ((10, 1.0), (2, 1.0), (10, 0.9)):
        n = 3200
        data = [(i, f"g{i % int(n * linked / size)}" if i < n * linked else f"single {i}") for i in range(n)]
        got = homes(run(documents, data))
        assert len(got) == int(n * linked / size)
        assert sum(k > 1 for k in got.values()) <= 15


def test_departures_make_room():
    full = {0: 10, 1: 10}
    assert S.accept([(0, 1, 5, 3), (1, 0, 6, 3)], full, [10, 10]) == []
    assert sorted(S.accept([(0, 1, 5, 3), (1, 0, 6, 3)], full, [10, 13])) == [(0, 6), (1, 5)]
    assert sorted(S.accept([(0, 1, 7, 3), (1, 0, 6, 3)], full, [10, 13])) == [(0, 6), (1, 7)]
