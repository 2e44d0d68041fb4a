"""Scalar functions on hand-made edge rows (FIXTURES.md part C)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from bondmart.functions import scalars as X


def _apply(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_strip_paren_suffix(spark):
    got = _apply(spark, ["基金（甲）(乙)", "(甲)", "银行", "银行 (x)", " A （b）", "x(", None], X.strip_paren_suffix)
    assert got == ["基金（甲）", "(甲)", "银行", "银行", "A", "x", None]


def test_first_paren_prefix(spark):
    got = _apply(spark, ["a(b", "a（b", "ab", "(b"], X.first_paren_prefix)
    assert got == ["a", "a", None, ""]


def test_issuer_code(spark):
    assert _apply(spark, ["abc", "abcd", "abcdef", "", None], X.issuer_code) == ["abc", "", "ef", "", ""]


def test_maturity_bucket_edges(spark):
    vals = [Decimal(x) for x in ("1", "1.000001", "3", "5", "7", "10", "10.5", "0")]
    got = _apply(spark, vals, X.maturity_bucket, "decimal(18,6)")
    assert got == ["一年及以下", "一年至三年", "一年至三年", "三年至五年", "五年至七年", "七年至十年",
                   "十年以上", "一年及以下"]


def test_rating_normalize(spark):
    got = _apply(spark, ["AAA", "AA+", "A-1+", "AA＋", "AA", "x"], X.rating_normalize)
    assert got == ["AAA", "AA+", "AA+", "AA+", "AA及以下", "AA及以下"]


def test_bond_categories(spark):
    assert _apply(spark, ["利率债", "同业存单", "信用债", "其他", None], X.bond_category4) == [
        "利率债", "同业存单", "信用债", "其他", "其他"]
    got = _apply(spark, ["国债", "超短期融资券", "短期融资券", "企业债", "公司债"], X.bond_category8)
    assert got == ["国债", "短期融资券（包含超短融）", "短期融资券（包含超短融）", "企业债", "其他"]


def test_deal_strategy(spark):
    assert _apply(spark, ["0", "4", "1", "", None], X.deal_strategy) == ["正常", "正常", "策略性交易", "正常", "正常"]


def test_parse_date_strict(spark):
    got = _apply(spark, ["2018-02-28", "2018-02-30", "2018-03-01 10:00:00", "x"], X.parse_date)
    assert got == [dt.date(2018, 2, 28), None, dt.date(2018, 3, 1), None]


def test_ratio6_zero_total(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("0.00")), (Decimal("1"), Decimal("3"))],
                               "n decimal(18,2), d decimal(18,2)")
    assert [r[0] for r in df.select(X.ratio6("n", "d")).collect()] == [None, 0.333333]


def test_set_to_string_sorted(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "x string")
    assert df.agg(X.set_to_string(F.collect_set("x"), "#")).first()[0] == "a#b#c"
