import glob
import zlib

import numpy as np
import pyarrow.orc as po

from riverwatch.llm import orc_tokens as O
from riverwatch.llm import tokens as T

TEXTS = [None, "", "a", "b c", "word " * 5000, "é\n" * 700, *(f"t {i} " * (i % 40) for i in range(300)), "a", "a"]


def ids(text, end=0):
    return T.encoder(T.default_path()).tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


def test_query_round_trip(spark, tmp_path, documents):
    documents([(len(TEXTS) - i, t, "en", "s", 0) for i, t in enumerate(TEXTS)]).repartition(5).write.parquet(
        str(tmp_path / "documents.parquet"))
    got = O.op10_token_id_output(spark, str(tmp_path)).orderBy("doc_id").collect()
    at = 0
    for r, t in zip(got, reversed(TEXTS), strict=True):
        want = ids(t)
        assert (r.start, r.n_tokens) == (at, len(want))
        assert r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
        at += len(want)


def test_files_are_sorted_and_indexed(spark, tmp_path, documents):
    path = str(tmp_path / "orc")
    O.write_token_orc(documents([(i * 7 % 309, t, "en", "s", 0) for i, t in enumerate(TEXTS)]), path)
    rows = O.read_token_orc(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.tokens)
        at += r.n_tokens
    files = sorted(glob.glob(path + "/*.orc"))
    assert files and all(po.ORCFile(f).compression == "ZSTD" for f in files)
    # one id is found through pushed-down filters
    one = spark.read.orc(path).filter("doc_id = 11")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,11)]" in one._jdf.queryExecution().toString()
    assert one.first().tokens == ids(next(t for i, t in enumerate(TEXTS) if i * 7 % 309 == 11))


def test_null_and_repeated_ids(spark, tmp_path, documents):
    path = str(tmp_path / "orc")
    data = [(None, "x", "en", "s", 0), (5, "y", "en", "s", 0), (5, "y", "en", "s", 0), (5, None, "en", "s", 0)]
    O.write_token_orc(documents(data), path)
    rows = O.read_token_orc(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 5, 5, 5]
    assert sorted(map(str, (r.tokens for r in rows))) == sorted(str(ids(t)) for _, t, *_ in data)


def test_empty_and_clash(spark, tmp_path, documents):
    O.write_token_orc(documents([]), str(tmp_path / "none"))
    documents([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert O.op10_token_id_output(spark, str(tmp_path)).count() == 0
    d = spark.createDataFrame([(1, "a", 2, 3)], "doc_id long, text string, part int, h long")
    O.write_token_orc(d, str(tmp_path / "clash"))
    assert spark.read.orc(str(tmp_path / "clash")).first().tokens == ids("a")
