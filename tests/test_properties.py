"""Property tests of scalar functions against plain-Python statements of their rules."""

import math
from datetime import date, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from livemart.functions.masking import mask_phone
from livemart.functions.numeric import age_years, percent_1dp
from livemart.functions.text import tokens


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 10**6)), min_size=1, max_size=40))
def test_percent_is_half_up_one_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "p long, t long")
    got = [r.v for r in df.select(percent_1dp("p", "t").alias("v")).collect()]
    want = [math.floor(p * 1000.0 / t + 0.5) / 10.0 for p, t in pairs]
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789", max_size=14)), min_size=1, max_size=40))
def test_mask_keeps_everything_after_seven(spark, tels):
    df = spark.createDataFrame([(t,) for t in tels], "tel string")
    got = [r.m for r in df.select(mask_phone("tel").alias("m")).collect()]
    assert got == [None if t is None else "*******" + t[7:] for t in tels]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 40000), min_size=1, max_size=40))
def test_age_is_days_div_365(spark, days_before):
    as_of = date(2001, 8, 2)
    births = [(as_of - timedelta(days=d)).isoformat() for d in days_before]
    df = spark.createDataFrame([(b,) for b in births], "b string")
    got = [r.a for r in df.select(age_years("b", as_of.isoformat()).alias("a")).collect()]
    assert got == [d // 365 for d in days_before]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="ab Z9,-", max_size=20), min_size=1, max_size=20))
def test_tokens_are_lowercase_alnum_runs(spark, texts):
    import re
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [list(r.t) for r in df.select(tokens("s").alias("t")).collect()]
    assert got == [re.findall(r"[a-z0-9]+", t.lower()) for t in texts]
