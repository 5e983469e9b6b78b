import numpy as np
from pyspark.sql import functions as F

from riverwatch.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(data, k, mod):
    def usable(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
    rows = {}
    for i, v in data:
        if i is not None and usable(v):
            rows[(i, tuple(np.float32(v).tolist()))] = np.float32(v).astype(np.float64)
    out = {}
    for (i, _), a in rows.items():
        if i % mod:
            continue
        found = [(-float(N.cosines(a[None], b[None])[0]), j) for (j, _), b in rows.items()
                 if j != i and len(b) == len(a)]
        out[i] = [(j, -s) for s, j in sorted(found)[:k]]
    return out


def run(spark, data, k=5, mod=7, **kw):
    d = spark.createDataFrame([(i, v, 0) for i, v in data], SCHEMA)
    got = {}
    for r in N.nearest(d, F.col("vec_id") % mod == 0, k, **kw).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for v in got.values():
        v.sort()
        assert [x[0] for x in v] == list(range(1, len(v) + 1))
    return {q: [x[1:] for x in v] for q, v in got.items()}


def test_matches_brute_force_over_blocks(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(9, 24))
    data = [(i, (centre[i % 9] + rng.normal(size=24) * (0.05 if i % 2 else 1)).tolist()) for i in range(400)]
    data += [(1000 + i, data[3][1]) for i in range(60)]  # a common vector: ties by id
    data += [(2000, None), (2002, []), (2009, [0.0] * 24), (2016, [float("nan")] + [1.0] * 23),
             (2023, [float("inf")] * 24), (2030, [None] + [1.0] * 23), (None, [1.0] * 24),
             (3003, [1e30] * 24), (3010, [1e-30] * 24), (7, data[7][1])]
    want = brute(data, 5, 7)
    assert run(spark, data, query_block=16, block=50) == want
    assert run(spark, data) == want


def test_dimensions_do_not_mix_and_few_candidates(spark):
    data = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (7, [1.0, 1.0, 1.0]), (14, [3.0])]
    assert run(spark, data) == {0: brute(data, 5, 7)[0]}
    assert run(spark, []) == {}


def test_wide_vectors_use_panels(spark):
    rng = np.random.default_rng(3)
    data = [(i, rng.normal(size=N.PANEL * 2 + 9).tolist()) for i in range(40)]
    assert run(spark, data) == brute(data, 5, 7)


def test_bounds_hold_and_rule_out():
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(30, 64)), rng.normal(size=(3000, 64))
    i, j = N.tile_survivors(a, b, np.zeros((30, 3000), bool), 5)
    exact = (a / np.linalg.norm(a, axis=1)[:, None]) @ (b / np.linalg.norm(b, axis=1)[:, None]).T
    for q in range(30):
        assert set(np.argsort(-exact[q])[:5]) <= set(j[i == q])
    assert len(i) < 30 * 60
