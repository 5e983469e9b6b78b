import itertools
import random

import numpy as np
import pyarrow as pa

from riverwatch.llm import substrings as S
from riverwatch.llm.common import stored
from riverwatch.llm.components import components

rng = random.Random(11)


def sentence(n):
    w = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n)]
    return " ".join(w).capitalize() + "."


def para(k):
    return " ".join(sentence(rng.randint(6, 12)) for _ in range(k))


def grams(line):
    w = line.lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def jaccard(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b)


def test_bands():
    assert S.bands_for(0.8, 2, 0.995) == 6
    rng_ = np.random.default_rng(1)
    hit = 0
    for _ in range(400):
        shared = rng_.integers(0, 2**63, 80).astype(np.uint64)
        a, b = (np.concatenate([shared, rng_.integers(0, 2**63, 10).astype(np.uint64)]) for _ in range(2))
        hit += bool((S.band_keys(a, 6) == S.band_keys(b, 6)).any())
    assert hit >= 392


def test_line_components_match_brute_force(spark, documents):
    lines = []
    for _ in range(25):
        words = para(6).split()
        lines.append(" ".join(words))
        for _ in range(rng.randint(0, 4)):  # drifting copies: chains of similar lines
            words = words.copy()
            words[rng.randrange(len(words))] = "edited" + str(rng.random())
            lines.append(" ".join(words))
    d = documents(lines)
    units = stored(S.find_units(d, S.bands_for(recall=1 - 1e-9)), "t")
    ids = {r.id: r.hash for r in units.filter("kind = 0").collect()}
    for block in (256, 2):
        root = {r.node: r.root for r in components(S.similar_lines(d, units, 0.8, block)[0]).collect()}
        label = list(range(len(lines)))
        for i, j in itertools.combinations(range(len(lines)), 2):
            if jaccard(lines[i], lines[j]) >= 0.8 and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
        for i, j in itertools.combinations(range(len(lines)), 2):
            a, b = root.get(ids[i], ids[i]), root.get(ids[j], ids[j])
            assert (a == b) == (label[i] == label[j])


def test_passages_inside_and_across_lines(documents):
    passage, near = para(7), para(9)
    edited = near.split()
    edited[30] = "changed"
    texts = [para(4) + "\n" + passage + "\n" + para(3),          # 0: the first
             para(3) + " " + passage + " " + para(2),            # 1: inside a line
             para(2) + "\n" + passage.replace(". ", ".\n", 3),   # 2: over several lines
             para(5) + "\n" + near, para(5) + "\n" + " ".join(edited),
             para(12), "Short common line here.\n" + para(5), "Short common line here.\n" + para(5),
             None, "", "x" * 50000, para(400)]
    texts += [texts[5], para(5) + "\n" + sentence(9) * 1]
    got = S.repeated_passages(documents(texts)).collect()
    by = {}
    for r in got:
        by.setdefault(r.id, []).append(r)
    assert set(by) == {0, 1, 2, 3, 4, 5, 12}
    assert {i: {r.removed for r in by[i]} for i in by} == {
        0: {False}, 1: {True}, 2: {True}, 3: {False}, 4: {True}, 5: {False}, 12: {True}}
    whole = set(passage.lower().split())
    for i in (0, 1, 2):
        covered = " ".join(texts[i][r.start:r.end] for r in by[i]).lower().split()
        assert len(set(covered) & whole) >= len(whole) - 14
        assert len(set(covered) - whole) <= 14
    assert all(r.n_words >= S.PASSAGE_WORDS for r in got)
    row = by[12][0]
    assert texts[12][row.start:row.end] == texts[5] and row.n_words == len(texts[5].split())


def test_repeats_in_one_document_and_null_ids(spark, documents):
    p = para(6)
    assert S.repeated_passages(documents([p + "\n" + para(2) + "\n" + p])).count() == 0
    d = documents([(None, p, "en", "s", 1), (None, p, "en", "s", 1), (4, p, "en", "s", 1), (4, p, "en", "s", 1)])
    assert S.repeated_passages(d).count() == 0
    d = documents([(None, p, "en", "s", 1), (9, p, "en", "s", 1), (4, p, "en", "s", 1)])
    assert sorted((str(r.id), r.removed) for r in S.repeated_passages(d).collect()) == [
        ("4", False), ("9", True), ("None", True)]


def test_empty_and_clash(spark, documents):
    assert S.repeated_passages(documents([])).count() == 0
    p = para(6)
    d = spark.createDataFrame([(1, p, 1, 2), (2, p, 3, 4)], "doc_id long, text string, row int, hash int")
    assert S.repeated_passages(d).count() == 2


def shared_runs(texts, size):
    """Word ranges of each text that windows of ``size`` words shared with another text cover."""
    split = [t.lower().split() for t in texts]
    seen = {}
    for i, w in enumerate(split):
        for k in range(len(w) - size + 1):
            seen.setdefault(tuple(w[k:k + size]), set()).add(i)
    return [{k + j for k in range(len(w) - size + 1) if len(seen[tuple(w[k:k + size])]) > 1 for j in range(size)}
            for w in split]


def covered_words(text, rows):
    at, out = 0, set()
    for k, w in enumerate(text.split()):
        at = text.index(w, at)
        if any(r.start <= at and at + len(w) <= r.end for r in rows):
            out.add(k)
        at += len(w)
    return out


def test_all_shared_windows_are_reported(documents):
    """Passages that start and end inside sentences or have no sentence ends."""
    def bare(n):
        return sentence(n).lower()[:-1]
    def within(passage):
        return f"{para(2)} {bare(7)} {passage} {bare(9)}. {para(2)}"
    texts = [para(20) for _ in range(3)]
    for n in (50, 50, 55, 70, 120, 300):
        p = bare(n)
        texts += [within(p), within(p)]
    long = bare(200).split()  # other parts of one passage in other texts
    texts += [within(" ".join(long[a:b])) for a, b in ((0, 120), (60, 200), (30, 100))]
    wrapped = bare(90).split()
    texts += ["\n".join(" ".join(wrapped[k:k + n]) for k in range(0, 90, n)) for n in (7, 11)]
    got = {}
    for r in S.repeated_passages(documents(texts)).collect():
        got.setdefault(r.id, []).append(r)
    for i, want in enumerate(shared_runs(texts, 50)):
        have = covered_words(texts[i], got.get(i, []))
        assert want <= have
        assert len(have - want) <= 12


def test_a_passage_with_an_edit_in_each_sentence(documents):
    p = sentence(260).lower()[:-1].split()
    sparse = [f"edit{k}" if k % 52 == 26 else w for k, w in enumerate(p)]
    def text(words):
        return para(6) + " " + " ".join(words) + " " + para(6)
    rows = S.repeated_passages(documents([text(p), text(sparse)])).collect()
    assert {r.id: r.removed for r in rows} == {0: False, 1: True}
    assert sum(r.n_words for r in rows) >= 2 * 200


def test_short_paragraphs_and_parts_of_a_run_are_reported(documents):
    short, s1, s2 = sentence(20), sentence(29), sentence(29)
    texts = [para(4) + "\n" + short, short + "\n" + para(4),
             f"{para(3)} {s1} {para(3)}", *(f"{para(3)} {s1} {s2} {para(3)}" for _ in range(2))]
    got = {}
    for r in S.repeated_passages(documents(texts)).collect():
        got.setdefault((r.id, r.removed), []).append(r)
    for key in ((0, False), (1, True)):
        assert [texts[r.id][r.start:r.end] for r in got.pop(key)] == [short]
    assert set(got) == {(3, True), (3, False), (4, True)}
    words = texts[3].split()
    at = words.index(s1.split()[0])
    assert set(range(at, at + 29)) <= covered_words(texts[3], got[3, True])
    assert set(range(at + 29, at + 58)) <= covered_words(texts[3], got[3, False])


def test_short_lines_and_sentences(documents):
    line = "one two three four five six seven eight nine ten"  # 0.86 alike with a word more
    verse = "\n".join(sentence(4)[:-1] for _ in range(15))
    brief = " ".join(sentence(4) for _ in range(12))
    wide = sentence(96).split()
    def wrap(n):
        return "\n".join(" ".join(wide[k:k + n]) for k in range(0, 96, n))
    texts = [f"{para(2)}\n{t}\n{para(2)}" for t in (line, line + " eleven", verse, verse, brief, brief,
                                                   wrap(12), wrap(10))]
    got = {}
    for r in S.repeated_passages(documents(texts)).collect():
        got.setdefault(r.id, []).append(r)
    assert {i: {r.removed for r in rows} for i, rows in got.items()} == {i: {i % 2 == 1} for i in range(8)}
    for i, n in enumerate((10, 11, 60, 60, 48, 48, 96, 96)):
        assert n <= len(covered_words(texts[i], got[i])) <= n + 10


def test_buckets_match_brute_force():
    gen = np.random.default_rng(3)
    key = np.append(gen.integers(0, 40000, 90000), np.full(5000, 40001))
    unit = np.append(gen.integers(0, 9, 90000), gen.integers(0, 700, 5000))
    ids = [None if x % 50 == 0 else f"doc{x}" for x in gen.integers(0, 400, 95000).tolist()]
    order = np.lexsort((unit, key))
    rows = [(int(key[i]), int(unit[i]), ids[i]) for i in order]
    want = {}
    for k, u, i in rows:
        want.setdefault(k, {}).setdefault(u, []).append(i)
    t = pa.table([list(c) for c in zip(*rows)], schema=pa.schema(
        [("key", pa.int64()), ("hash", pa.int64()), ("id", pa.string())]))
    for least, block in ((1 << 16, 256), (300, 4), (7000, 256)):
        got = {}
        for b in S.buckets_of(iter(t.to_batches(max_chunksize=1000)), block, least):
            for r in b.to_pylist():
                got.setdefault(r["key"], []).append(r)
        assert set(got) == {k for k, u in want.items() if len(u) > 1}
        for k, parts in got.items():
            assert [m for r in parts for m in r["members"]] == sorted(want[k])
            assert all(len(r["members"]) <= block and r["large"] == (len(want[k]) > block) for r in parts)
            known = [i for u in want[k].values() for i in u if i is not None]
            ends = [[r[c] for r in parts if r[c] is not None] for c in ("low", "high")]
            assert (min(ends[0], default=None), max(ends[1], default=None)) == (
                min(known, default=None), max(known, default=None))


def test_a_large_bucket_is_split_without_all_pairs(spark):
    """Edited copies of one set: links as by brute force, and rows in proportion to the members."""
    gen = np.random.default_rng(7)

    def members(n, edits):
        base = gen.integers(1, 2**62, 46).tolist()
        out = {frozenset(base)}
        for _ in range(n):
            x = list(base)
            for _ in range(gen.integers(1, edits + 1)):
                at = gen.integers(0, 42)
                x[at:at + 5] = gen.integers(1, 2**62, 5).tolist()
            out.add(frozenset(x))
            if gen.random() < 0.3:  # alike to that copy, not to the base
                out.add(frozenset(x[:-2] + gen.integers(1, 2**62, 2).tolist()))
        return list(out)

    rows = []
    for n, edits in ((120, 1), (240, 1), (150, 4)):
        sets = [sorted(x) for x in members(n, edits)]
        hashes = gen.permutation(np.arange(10_000 * n, 10_000 * n + len(sets))).tolist()
        large = stored(spark.createDataFrame([(1, h, len(sets)) for h in hashes], "key long, hash long, n long"), "t")
        shingles = stored(spark.createDataFrame(list(zip(hashes, sets)), "hash long, shingles array<long>"), "t")
        edges, groups, left = S.split_large(large, shingles, 0.8, 8)
        edges, groups = ([tuple(r) for t in x for r in t.collect()] for x in (edges, groups))
        assert left.isEmpty() and all(len(m) <= 8 for m, in groups)
        rows.append((len(sets), sum(len(m) for m, in groups)))
        known = {h: set(x) for h, x in zip(hashes, sets)}
        for m, in groups:
            edges += list(S._forest({h: known[h] for h in m}, 0.8))
        got, want = ({h: h for h in hashes} for _ in range(2))

        def join(label, pairs):
            for a, b in pairs:
                if label[a] != label[b]:
                    old, new = label[a], label[b]
                    for h in label:
                        label[h] = new if label[h] == old else label[h]

        def alike(a, b):
            return len(known[a] & known[b]) >= 0.8 * len(known[a] | known[b])

        assert all(alike(a, b) for a, b in edges)
        join(got, edges)
        join(want, (x for x in itertools.combinations(hashes, 2) if alike(*x)))
        assert all((got[a] == got[b]) == (want[a] == want[b]) for a, b in itertools.combinations(hashes, 2))
    assert rows[1][1] <= 4 * rows[0][1] * rows[1][0] / rows[0][0] + 100  # pairs of blocks: 4 x more for 2 x the members
    assert rows[1][1] <= 12 * rows[1][0]
