"""Property checks: scalar column functions against plain-Python models on
generated inputs (one DataFrame per property, so one Spark job each)."""

from __future__ import annotations

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bondmart.functions import scalars as X

ALPHABET = st.sampled_from(list("ab ()（）银行甲"))
TEXT = st.lists(st.text(ALPHABET, max_size=8), min_size=1, max_size=60)


def cut_model(s: str) -> str:
    c = max(s.find("("), s.find("（"))
    return s[:c].strip(" ") if c > 0 else s


def issuer_model(s):
    if s is None or s == "":
        return ""
    return s[4:] if len(s) >= 4 else s


def bucket_model(y: Decimal) -> str:
    for lo, label in ((10, "十年以上"), (7, "七年至十年"), (5, "五年至七年"), (3, "三年至五年"), (1, "一年至三年")):
        if y > lo:
            return label
    return "一年及以下"


@settings(max_examples=8, deadline=None)
@given(TEXT)
def test_paren_cut_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(X.strip_paren_suffix(F.col("x"))).collect()]
    assert got == [cut_model(v) for v in values]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(ALPHABET, max_size=7)), min_size=1, max_size=60))
def test_issuer_code_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(X.issuer_code(F.col("x"))).collect()]
    assert got == [issuer_model(v) for v in values]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.decimals(min_value=0, max_value=40, places=6, allow_nan=False), min_size=1, max_size=60))
def test_maturity_bucket_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x decimal(18,6)")
    got = [r[0] for r in df.select(X.maturity_bucket(F.col("x"))).collect()]
    assert got == [bucket_model(v) for v in values]
