import math
import random
import re

from riverwatch.llm import lexical as X

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def brute(docs, items, k=10):
    split = [(i, terms(t)) for i, t in docs]
    N, L = sum(bool(w) for _, w in split), sum(len(w) for _, w in split)
    sets, out = {}, []
    for item, text in items:
        sets.setdefault(item, set()).update(terms(text))
    for item, own in sets.items():
        weight = {}
        for t in own:
            df = sum(t in w for _, w in split)
            weight[t] = math.floor(1000 * math.log((2 * N + 2) / (2 * df + 1)))
        scored = []
        for i, w in split:
            m = 100 - 90 + (90 * len(w) * N) // L if L else 0
            s = sum(weight[t] * ((1000000000 * w.count(t)) // (1000 * w.count(t) + 8 * m)) for t in own if t in w)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, i, -s))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


VOCAB = ["alpha", "Beta", "GAMMA", "straße", "Éclair", "日本", "x9", "beta2", "a", "the", "of", "KK", "😀x"]


def make(spark, n, seed):
    rng = random.Random(seed)
    seps = [" ", "\n", "-", "_", "  ", ", ", "\x00", "\x7f", "'"]
    def text(k):
        return "".join(rng.choice(VOCAB) + rng.choice(seps) for _ in range(rng.randint(0, k)))
    docs = [(i, text(40)) for i in range(n)] + [(None, text(40)), (None, None), (3, "alpha"), (3, "alpha"), (n, "")]
    docs += [(n + 1 + i, "beta gamma") for i in range(15)] + [(n + 40, "alphabet betas " * 5000 + "gamma")]
    items = [(i, text(8)) for i in range(30)] + [(None, "alpha of"), (2, "straße"), (31, None), (32, "unknown words"),
                                               (33, ""), (34, "the the THE")]
    return docs, items


def test_matches_brute_force(spark):
    docs, items = make(spark, 120, 5)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    q = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert got(X.rank_documents(d, q)) == want
    # several automata and passes, small parts
    assert got(X.rank_documents(d, q, term_bytes=200, items_at_once=14)) == want
    assert got(X.rank_documents(d, q, k=2)) == brute(docs, items, 2)


def test_sums_beyond_doubles():
    import numpy as np
    p = X.Postings(np.array([1 << 40, 3]), np.array([0, 1, 2]), np.array([0, 0]), 1)
    out = p.scores(np.array([0, 1]), np.array([1, 1]), np.array([1]), np.array([0, 2]))
    each = 1000000000 // 1008
    assert out.tolist() == [[((1 << 40) + 3) * each]]


def test_empty_tables_and_clashing_columns(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "beta", 5, 6)], "item_id long, text string, n int, score int")
    assert X.rank_documents(documents(["beta"]), none).collect() == []
    assert X.rank_documents(documents([]), one).collect() == []
    assert X.rank_documents(documents([None, ""]), one).collect() == []
    d = spark.createDataFrame([(1, "beta", 1, 2)], "doc_id long, text string, terms int, item int")
    rows = X.rank_documents(d, one).collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in rows] == [(1, 1, 1)]
    assert X.rank_documents(d, one).dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"),
                                              ("score", "bigint")]
