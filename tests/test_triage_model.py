"""Triage against a plain-Python model of the consumer on generated messages.

The model decodes with ``json.loads`` and tags rainfall > 5 (missing = 0).
Where the original loop would crash (explicit null or text rainfall, a
non-object message) our operator tags or flags instead; the model encodes
that decision, so the two must agree on every message.
"""

import json
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from riverwatch.operators.decode import BAD_FIELD, UNDECODABLE, triage
from riverwatch.functions.rules import TRIAGE_ALERT, TRIAGE_OK

num = st.one_of(st.none(), st.floats(min_value=-10, max_value=20, allow_nan=False),
                st.integers(min_value=-5, max_value=20), st.just("abc"), st.just(float("nan")))
obj = st.fixed_dictionaries({}, optional={
    "rainfall_mm_per_hr": num, "river_level_m": num,
    "timestamp": st.sampled_from(["2024-01-01T00:00:00", "x"]), "extra": st.integers()})
message = st.one_of(
    obj.map(lambda d: json.dumps(d)),
    st.sampled_from(["not json", "{", "[]", "[1,2]", "", " ", "{\"a\":", "null", "{}", None,
                     "\nnull", "null\t", "[1] x", '"text" more', '{"rainfall_mm_per_hr": 6.0} xyz',
                     '{"rainfall_mm_per_hr": 6} {"rainfall_mm_per_hr": 1}', "{'rainfall_mm_per_hr': 6}",
                     "1] xyz [2", "]", "1, 2", '"text"', "5", " {} ", ',"end of message"]',
                     "[NaN]", "[1, NaN]", '{"a": [NaN], "rainfall_mm_per_hr": 7}']),
)


def model(text):
    """-> (status, problem) as the operator should give them."""
    try:
        rec = None if text is None else json.loads(text)
    except (json.JSONDecodeError, ValueError):
        rec = None
    if rec is None:  # the consumer skips what decodes to nothing
        return None, UNDECODABLE
    if not isinstance(rec, dict):
        return TRIAGE_OK, BAD_FIELD
    rain = rec.get("rainfall_mm_per_hr", 0)
    bad = any(isinstance(rec.get(k), str) for k in ("rainfall_mm_per_hr", "river_level_m"))
    if isinstance(rain, str) or rain is None or (isinstance(rain, float) and math.isnan(rain)):
        rain = 0  # text and null are unreadable; NaN is read as missing
    return (TRIAGE_ALERT if rain > 5.0 else TRIAGE_OK), (BAD_FIELD if bad else None)


@settings(max_examples=10, deadline=None)
@given(st.lists(message, min_size=1, max_size=30))
def test_triage_matches_model(spark, msgs):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(msgs)], "offset long, value string")
    got = {r.offset: (r.status, r.problem) for r in triage(df).collect()}
    for i, m in enumerate(msgs):
        assert got[i] == model(m), (m, got[i])


FIXED = ["\nnull", "null\t", "[1] x", '"text" more', '{"rainfall_mm_per_hr": 6.0} xyz', "1] xyz [2", "]",
         '{"rainfall_mm_per_hr": 6} {"rainfall_mm_per_hr": 1}', "{'rainfall_mm_per_hr': 6}", "1, 2", '"text"',
         "5", " {} ", "\n{}\r\n", ',"end of message"]', '1,"end of message"] [', "not json", "{", "[]", "[1,2]", "", " ", "{\"a\":", "null", "{}", None, "[NaN]",
         "[1, NaN]", '{"a": [NaN], "rainfall_mm_per_hr": 7}', '{"rainfall_mm_per_hr": NaN}',
         '{"rainfall_mm_per_hr": "6"}', '{"rainfall_mm_per_hr": null}', '{"rainfall_mm_per_hr": 5.5}']


def test_triage_matches_model_on_fixed_messages(spark):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(FIXED)], "offset long, value string")
    got = {r.offset: (r.status, r.problem) for r in triage(df).collect()}
    for i, m in enumerate(FIXED):
        assert got[i] == model(m), (m, got[i])
