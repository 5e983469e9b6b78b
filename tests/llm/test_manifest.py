import hashlib
import random
import zlib

import pytest

from riverwatch.llm import manifest as M


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row[0], row[3], row[2], row[4], text)  # doc_id, source, lang, n_chars, text
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, i):
    out = []
    for nodes in levels[:-1]:
        at = i // 3 * 3
        out += [x for j, x in enumerate(nodes[at:at + 3], at) if j != i]
        i //= 3
    return out


def refold(levels, i, digest):
    for nodes in levels[:-1]:
        at = i // 3 * 3
        digest = H(*(digest if j == i else x for j, x in enumerate(nodes[at:at + 3], at)))
        i //= 3
    return digest


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append(r)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in names:
        trees[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        built[s] = climb([leaf(r, r[1]) for r in trees[s]])
    top = climb([built[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(trees[s]):
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            text = r[1].replace("\n", "") if even and r[1] is not None else r[1]
            folded = refold(top, k, refold(built[s], i, leaf(r, text)))
            out.append((r[0], leaf(r, r[1]), built[s][-1][0], top[-1][0],
                        H(*siblings(built[s], i), *siblings(top, k)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def make(seed):
    rng = random.Random(seed)
    sizes = {None: 4, "a": 1, "b": 3, "é": 28, "z": 70, "Z": 9, "": 10, **{f"s{i}": 2 for i in range(12)}}
    rows = [(rng.randrange(10**6), rng.choice(["one\ntwo", "é\n", "no newline", "", None, "\n" * 9]),
             rng.choice(["en", None]), s, rng.choice([3, None])) for s, n in sizes.items() for _ in range(n)]
    rows += [(None, "x\ny", "en", "z", 1), (None, None, None, None, None), (7, "p\n", "en", "z", 1),
             (7, "p\n", "en", "z", 1), (7, "q\n", "en", "z", 1), (8, "long\n" * 50000, "en", "b", 9)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("levels", [1, 7])
def test_matches_brute_force(spark, tmp_path, documents, levels):
    rows = make(levels)
    d = documents(rows).repartition(4)
    out = M.manifest(d, replaced=M.tampered_text(), levels=levels)
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows)


def test_midstates_resume_at_the_changed_child():
    nodes = [H(str(i)).encode() for i in range(11)]
    block = M.Block(nodes, 3)
    levels = climb([n.decode() for n in nodes])
    assert block.top.decode() == levels[-1][0]
    for i in range(11):
        assert block.fold(i, nodes[i]) == block.top
        assert block.fold(i, b"f" * 64).decode() == refold(levels, i, "f" * 64)
        assert block.proofs(b"+")[i].decode() == "".join(siblings(levels, i)) + "+"
    assert len(block.states[0]) == 11  # one state before each child


def test_untampered_rows_verify(documents):
    d = documents(make(5))
    assert M.manifest(d).filter("NOT verified").count() == 0


def test_empty_and_clashing_columns(spark, documents):
    out = M.manifest(documents([]))
    assert out.count() == 0 and out.columns == [
        "id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    row = (5, "a\nb", "en", "s", 3)
    d = spark.createDataFrame([(*row, 1, 2, "h")], "doc_id long, text string, lang string, source string, "
                              "n_chars long, tree int, idx int, hash string")
    assert [tuple(r) for r in M.manifest(d, replaced=M.tampered_text()).collect()] == brute([row])


def test_query(spark, tmp_path, documents):
    rows = make(2)[:40]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = M.op13_merkle_manifest(spark, str(tmp_path))
    assert out.columns[0] == "doc_id"
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows)
