import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riverwatch.llm import packing as P
from riverwatch.llm import tokens as T


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=32))
def test_plan_places_every_piece_once(counts):
    plan = P.plan_packing(counts, 32)
    placed = Counter()
    for lengths, times in plan:
        assert times > 0 and sum(lengths) <= 32
        for x in lengths:
            placed[x] += times
    assert placed == Counter(counts)
    ranks = defaultdict(list)
    for length, low, high, each, _, _ in P.places(plan):
        assert (high - low) % each == 0
        ranks[length].append((low, high))
    for length, spans in ranks.items():
        at = 0
        for low, high in sorted(spans):
            assert low == at
            at = high
        assert at == counts[length]


def test_exact_complements_come_first():
    assert sorted(P.plan_packing({30: 5, 2: 5}, 32)) == [((30, 2), 5)]
    assert sorted(P.plan_packing({20: 2, 8: 2, 4: 2}, 32)) == [((20, 8, 4), 2)]
    assert sorted(P.plan_packing({18: 3, 14: 1, 8: 1, 6: 1, 10: 1, 2: 2}, 32)) == [
        ((18, 8, 6), 1), ((18, 10, 2, 2), 1), ((18, 14), 1)]
    assert P.plan_packing({}, 32) == [] and P.plan_packing({32: 7}, 32) == [((32,), 7)]


def test_plan_is_close_to_the_bound_and_does_not_grow_with_the_counts():
    rng = np.random.default_rng(4)
    for scale in (30, 30_000):
        counts = {i: int(n) for i, n in enumerate(rng.integers(1, scale, 1024), 1)}
        plan = P.plan_packing(counts)
        used = sum(t for _, t in plan)
        volume = sum(k * n for k, n in counts.items()) / 1024
        large = sum(n for k, n in counts.items() if k > 512)  # no two share a sequence
        assert used <= 1.015 * max(volume, large) + 2
        assert len(P.places(plan)) < 16 * 1024


def check(data, rows, size, end=P.END_ID):
    enc = T.encoder(T.default_path())
    by = defaultdict(list)
    for r in rows:
        by[r.id if hasattr(r, "id") else r.doc_id].append(r)
    want = Counter()
    for i, t in data:
        ids = enc.tokenizer.encode(t or "", add_special_tokens=False).ids + [end]
        n = len(ids)
        first = n - size * ((n - 1) // size)
        at, k = 0, 0
        while at < n:
            take = first if k == 0 else size
            part = ids[at:at + take]
            want[(i, k, at, take, zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
            at, k = at + take, k + 1
    assert Counter((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return seqs


def test_documents(documents):
    texts = [None, "", "a", "b c", "word " * 5000, "x" * 3000, "é\n" * 700, *(f"t {i} " * i for i in range(60)), "a", "a"]
    data = list(enumerate(texts)) + [(None, "lost id"), (3, "b c"), (3, "b c")]
    d = documents([(i, t, "en", "s", 0) for i, t in data])
    rows = P.pack_documents(d, size=64).collect()
    seqs = check(data, rows, 64)
    total = sum(r.length for r in rows)
    assert len(seqs) <= 1.05 * total / 64 + 1


def test_hot_length_and_sequences(documents):
    data = [(i, "same text here" if i % 3 else f"{i} " * (i % 11)) for i in range(600)]
    placed = P.pack_documents(documents([(i, t, "en", "s", 0) for i, t in data]), size=32, with_ids=True)
    rows = placed.collect()
    check(data, rows, 32)
    packed = {r.sequence_id: r.ids for r in P.sequences(placed).collect()}
    for r in rows:
        assert packed[r.sequence_id][r.offset:r.offset + r.length] == r.ids


def test_empty_and_clash(spark, documents):
    assert P.pack_documents(documents([])).count() == 0
    d = spark.createDataFrame([(1, "a b", 3)], "doc_id long, text string, __rank int")
    assert P.pack_documents(d).count() == 1
    assert P.pack_documents(d).filter(F.col("offset") == 0).count() == 1


def test_short_pieces_have_complements_too():
    assert sorted(P.plan_packing({400: 1000, 312: 2000})) == [((400, 312, 312), 1000)]
    assert sorted(P.plan_packing({512: 3, 256: 2})) == [((512, 256, 256), 1), ((512, 512), 1)]
    rng = np.random.default_rng(9)
    counts = {int(i): int(n) for i, n in zip(rng.choice(np.arange(200, 513), 60, False), rng.integers(1, 3000, 60))}
    used = sum(t for _, t in P.plan_packing(counts))
    alone = sum(t for _, t in P._plan(counts, 1024, 513))
    assert used < alone


def test_pairs_are_found_whatever_their_counts():
    have = np.bincount([160] * 4 + [164] * 3, minlength=1025)
    assert P._exact_fill(324, 2, have) == (164, 160)
