import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riverwatch.llm import quality as Q

GOOD = " ".join(f"the word{i} of and{i}" for i in range(20))


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(w)
    c = Counter(zip(w, w[1:], w[2:]))
    cover = {j for i in range(n - 2) if c[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(cover),
            n < 50 or 100 * len(cover) > 50 * n)


def got(docs):
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    rows = Q.quality_rules(docs).select("text", *[f"quality.{c}" for c in cols]).collect()
    return [(r.text, tuple(r[c] for c in cols)) for r in rows]


EDGE = [None, "", " \n\t", "a", "a b", "a b c a b c", "x\x0by\x0cz", "a b c d", "é # ü\n\n\né # ü",
        "one two three\none two three\n", "\r\na\r\n", "😀 😀 😀 😀", "a a a a", "$$$ &&& |", GOOD, GOOD,
        "w " * 30000, " ".join(str(i) for i in range(20000)) + " 1 2 3"]


def test_counts_match_brute_force_on_edges(documents):
    for text, counts in got(documents(EDGE)):
        assert counts == brute(text), text and text[:60]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n\t#é", max_size=60), min_size=1, max_size=40))
def test_counts_match_brute_force(documents, texts):
    for text, counts in got(documents(texts)):
        assert counts == brute(text), repr(text)


def test_verdicts(documents):
    bad = {"symbols": GOOD + " ### $$$ &&&" * 5, "no stop words": " ".join(f"qz{i}" for i in range(80)),
           "long words": " ".join("the " + "x" * 40 + str(i) for i in range(60)),
           "lines": "\n".join([GOOD] + ["the same line again and so on"] * 9)}
    rows = Q.quality_rules(documents([GOOD, *bad.values()])).orderBy("doc_id").collect()
    assert [r.quality.kept for r in rows] == [True, False, False, False, False]
    assert Q.kept_documents(documents([GOOD, *bad.values()])).columns == [
        "doc_id", "text", "lang", "source", "n_chars"]


def test_empty_table_and_clashing_columns(spark, documents):
    assert Q.quality_rules(documents([])).count() == 0
    d = spark.createDataFrame([(None, GOOD, 1, 2), (1, None, 3, 4)],
                              "doc_id long, text string, __counts int, __quality int")
    kept = Q.kept_documents(d)
    assert kept.columns == d.columns
    assert [tuple(r) for r in kept.collect()] == [(None, GOOD, 1, 2)]


def test_no_user_functions_and_no_shuffle(documents):
    plan = Q.quality_rules(documents([GOOD]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
