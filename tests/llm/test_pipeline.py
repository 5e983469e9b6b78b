import random
import re
from collections import Counter

import corpus_pipeline as C
from test_mixing import brute_count, rates
from test_packing import check
from test_quality import brute as brute_quality
from test_secrets import brute_all
from test_simhash import _class, brute_fingerprint

from riverwatch.llm import quality as Q


def corpus():
    rng = random.Random(9)
    stops = ["the", "of", "and", "der", "que", "les"]

    def text(n):
        return " ".join(rng.choice(stops) if rng.random() < 0.3 else
                        "".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    good = [text(rng.randint(60, 400)) for _ in range(40)]
    data = [(i, t) for i, t in enumerate(good)]
    data += [(100 + i, t) for i, t in enumerate(good[:8])]
    data += [(200, good[0] + " tail"), (201, text(20)), (202, None), (203, ""), (204, "### " * 90), (3, good[3])]
    data += [(300, text(80) + ' token = "' + "0123456789abcdef" * 2 + '" ' + text(5)), (None, text(90))]
    return [(i, t, "en", "big" if (i or 0) % 3 else "small", len(t or "")) for i, t in data]


def brute_kept(t):
    n, chars, symbols, dup, _, failed = brute_quality(t)
    if failed:
        return False
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = len([x for x in t.split("\n") if x.strip()])
    stop = sum(w.lower() in set(Q.STOP_WORDS) for w in words)
    got = {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_lines": lines,
           "n_stop_words": stop}
    return all((r.low is None or r.low * got[r.den] <= 1000 * got[r.num])
               and (r.high is None or 1000 * got[r.num] <= r.high * got[r.den]) for r in Q.RULES)


def test_pipeline_matches_brute_force(spark, tmp_path, documents):
    data = corpus()
    documents(data).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    rows = [r for r in data if brute_kept(r[1])]
    pairs = [(r[0], brute_fingerprint(r[1])) for r in rows]
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(_class(pairs, i), set()).add(r)
    rows = [min(g, key=lambda r: (r[0] is None, r[0])) for g in groups.values()]
    masked = []
    for i, t, lang, source, n in rows:
        out, at = "", 0
        for a, _, b in brute_all(t):
            if a >= at:
                out += t[at:a] + "[SECRET]"
            at = max(at, b)
        t = out + t[at:]
        masked.append((i, t, lang, source, len(t)))
    rate = rates(Counter(r[3] for r in masked))
    mixed = [r for r in masked for _ in range(brute_count(r[0], rate[r[3]]))]

    got = C.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = got.withColumnRenamed("doc_id", "id").collect()
    check([(r[0], r[1]) for r in mixed], got, 1024)


def test_stages_keep_the_columns_and_take_empty_tables(spark, documents):
    empty = documents([])
    d = documents(corpus())
    for name, stage in C.STAGES[:-1]:
        assert stage(spark, d, "").columns == d.columns, name
        assert stage(spark, empty, "").count() == 0
    assert C.STAGES[-1][1](spark, empty, "").count() == 0


def test_every_stage_is_registered_in_order():
    assert [n for n, _ in C.STAGES] == [
        "quality rules", "SimHash near-dedup", "secret scans", "mixing sources", "best-fit packing"]
