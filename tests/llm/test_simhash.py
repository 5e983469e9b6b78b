import itertools
import random

import xxhash
from pyspark.sql import functions as F

from riverwatch.llm import simhash as S
from riverwatch.llm.common import stored
from riverwatch.llm.components import components


def brute_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    w = [x for x in lowered.split(" ") if x]
    if not w:
        return 0
    grams = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(pairs):
    """pairs: (id, fp) -> {index: smallest id reachable}, by repeated merging."""
    label = list(range(len(pairs)))
    for i, j in itertools.combinations(range(len(pairs)), 2):
        if bin(pairs[i][1] ^ pairs[j][1]).count("1") <= 4 and label[i] != label[j]:
            a, b = label[i], label[j]
            label = [a if x == b else x for x in label]
    return [min((pairs[j][0] for j in range(len(pairs)) if label[j] == label[i] and pairs[j][0] is not None),
                default=None) for i in range(len(pairs))]


EDGE = [None, "", " \n", "One", "one", "ÉÀ b C d e", "éà b c d e", "É b c d", "é B C D", "a b c d " * 9,
        "x\x0by\x0cz\x1cw", "a  b\n c\td", "w " * 40000, "Q" * 100000]


def test_fingerprints(documents):
    got = S.with_fingerprints(documents(EDGE)).orderBy("id").collect()
    assert [r.fp & (2**64 - 1) for r in got] == [brute_fingerprint(t) for t in EDGE]
    long = " ".join(str(i % 977) for i in range(S.PART * 2 + 5))
    assert S.fingerprint(long.encode()) == brute_fingerprint(long)


def test_spark_hash_is_the_same(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("the é 😀")).alias("h")).first()
    assert row.h & (2**64 - 1) == xxhash.xxh64_intdigest("the é 😀".encode(), 42)


def test_masks_cover_every_close_pair():
    masks = S.covering_masks()
    assert len(masks) == 31
    rng = random.Random(1)
    for _ in range(4000):
        x, y = rng.getrandbits(64), 0
        for b in rng.sample(range(64), rng.randint(0, 4)):
            y |= 1 << b
        assert any((x & m) == ((x ^ y) & m) for m in masks)


def _fps(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(30):  # chains of near fingerprints, dense groups, lone ones
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 3, 25])):
            out.append(x)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << b
    return sorted(set(out))


def test_components_are_exact_with_small_blocks(spark):
    for seed, block in ((1, 2048), (2, 3)):
        fps = _fps(seed)
        table = stored(spark.createDataFrame([(S._signed(x),) for x in fps], "fp long"), "t")
        got = {r.node & (2**64 - 1): r.root for r in components(S.near_edges(table, block=block)).collect()}
        want = brute_components(list(enumerate(fps)))
        groups = {}
        for i, x in enumerate(fps):
            groups.setdefault(want[i], set()).add(got.get(x, ("alone", x)))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_near_duplicates_and_first(spark, documents):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randint(0, 60)) for _ in range(300)) for _ in range(8)]
    texts = [*EDGE, *base, *(b + " tail" for b in base), base[0], base[0]]
    rows = [(100 - i, t, "en", "s", 0) for i, t in enumerate(texts)]
    rows += [(None, base[1], "en", "s", 0), (100, "another text under a used id " * 30, "en", "s", 0), rows[-1]]
    d = documents(rows)
    got = sorted(((r.id, r.fp & (2**64 - 1), r.component_id) for r in S.near_duplicates(d).collect()), key=str)
    pairs = [(r[0], brute_fingerprint(r[1])) for r in rows]
    assert got == sorted(((i, f, c) for (i, f), c in zip(pairs, brute_components(pairs))), key=str)
    kept = S.first_of_each(d)
    assert kept.columns == d.columns
    kept = kept.collect()
    assert len(kept) == len({_class(pairs, i) for i in range(len(pairs))})


def _class(pairs, i):
    seen, todo = {i}, [i]
    while todo:
        x = todo.pop()
        for j in range(len(pairs)):
            if j not in seen and bin(pairs[x][1] ^ pairs[j][1]).count("1") <= 4:
                seen.add(j)
                todo.append(j)
    return frozenset(seen)


def test_empty_table_and_all_null_ids(spark, documents):
    assert S.near_duplicates(documents([])).count() == 0
    assert S.first_of_each(documents([])).count() == 0
    d = documents([(None, "a b c d e", "en", "s", 1)] * 3)
    assert [r.component_id for r in S.near_duplicates(d).collect()] == [None] * 3
    assert S.first_of_each(d).count() == 1


def test_clashing_columns(spark):
    d = spark.createDataFrame([(1, "a b c d", 7, 8)], "doc_id long, text string, __key int, fp int")
    assert [tuple(r) for r in S.first_of_each(d).collect()] == [(1, "a b c d", 7, 8)]


def test_components_ignores_loops_and_nulls(spark):
    e = spark.createDataFrame([(1, 1), (None, 2), (5, 4), (4, 3), (9, 8), (8, 9), (3, 5)], "a long, b long")
    assert sorted(map(tuple, components(e, "a", "b").collect())) == [(3, 3), (4, 3), (5, 3), (8, 8), (9, 8)]
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {r.root for r in components(chain, "a", "b").collect()} == {0}
