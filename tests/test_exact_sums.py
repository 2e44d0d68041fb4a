"""Sums and sets in the rows of a shuffle, tasks of a distinct projection: read from the plans; results on small rows."""

from __future__ import annotations

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType
from test_grains import _deals
from test_operators import _feeds
from test_shuffles import _plan

from bondmart.functions import scalars as X
from bondmart.operators.joins import distinct_rows
from bondmart.operators.rollup import rollup_items
from bondmart.plans import cash_reports as CR
from bondmart.plans import grains as G


@pytest.mark.parametrize("precision, scale", [(18, 2), (18, 6), (18, 0), (9, 6), (8, 2), (28, 2), (18, 10)])
def test_exact_sums_are_the_decimal_sums(spark, precision, scale):
    kind = DecimalType(precision, scale)
    most = Decimal("9" * precision).scaleb(-scale)
    least = Decimal(1).scaleb(-scale)
    held = [("most", most)] * 3 + [("least", v) for v in (-most, -least, None, -least)] + [
        ("mixed", v) for v in (most, -most, least, -least, -least)] + [("none", None), ("zero", Decimal(0))]
    df = spark.createDataFrame(held, f"k string, v decimal({precision},{scale})").repartition(3)
    got = df.groupBy("k").agg(X.exact_sum("v", kind).alias("got"), F.sum("v").alias("want"))
    assert got.schema["got"].dataType == got.schema["want"].dataType
    rows = got.collect()
    assert len(rows) == len({k for k, _ in held}) and all(r.got == r.want for r in rows)


@pytest.mark.parametrize("report", [CR.root_investment_returns, CR.root_term_preference, CR.ctgry_trade_deadline_info,
                                    CR.SET_TABLES["root_distribution_number"].items, CR.set_report("root_distribution_number"),
                                    CR.set_report("root_deal_amount_trans_info", strings=False)])
def test_amounts_are_shuffled_as_whole_numbers(spark, report):
    out = report(_feeds(spark, bond_deal=_deals()))
    partial = re.findall(r"partial_sum\(.*", _plan(out))
    # a decimal sum holds a flag of its own beside its 16 bytes
    assert partial and any("shiftright" in p or "bigint" in p for p in partial) and "isEmpty" not in partial[-1]


def test_rows_of_the_fact_keep_the_type_of_an_amount(spark):
    f = _feeds(spark, bond_deal=_deals())
    rows = G.cash_sides(f)
    assert dict(rows.dtypes)["dirty_amnt"] == "decimal(18,2)"
    one = rows.select("dirty_amnt", "buy_dirty_amnt", "sell_dirty_amnt").collect()
    assert one and all(r[0] == (r[1] if r[1] is not None else r[2]) for r in one)
    f = _feeds(spark, bond_deal=_deals())
    stored = G.grain(f, "grain_cash").groupBy(F.lit(1).alias("all")).agg(F.sum("buy_dirty_amnt").alias("buy_dirty_amnt"), F.sum("sell_dirty_amnt").alias("sell_dirty_amnt"))
    f.__dict__["_memo"]["grain_cash"] = stored
    both = G.cash_sides(f).collect()
    assert any(r.buy_dirty_amnt and r.sell_dirty_amnt for r in both)
    for r in both:
        sides = [v for v in (r.buy_dirty_amnt, r.sell_dirty_amnt) if v is not None]
        assert r.dirty_amnt == (sum(sides) if sides else None)


def test_sets_are_shuffled_by_number(spark):
    df = spark.createDataFrame([("1", "k", "a", "x", 1), ("1", "k", None, "x", 2), ("2", "k", "a", "y", 4)],
                               "member string, key string, a string, b string, v int").repartition(2)
    rollup = spark.createDataFrame([("1", "1", "机构"), ("2", "1", "产品")], "member string, root string, join_type string")
    out = rollup_items(df, F.broadcast(rollup), ["key"], {"v": df.v}, {"a_set": df.a, "b_set": df.b})
    exchange = re.search(r"Exchange hashpartitioning\(root#.*", _plan(out))[0]
    assert "_set#" in exchange and "set_name#" not in exchange
    assert {tuple(r) for r in out.select("join_type", "set_name", "item", "n_rows", "v").collect()} == {
        ("全部", "a_set", "a", 2, 5), ("机构", "a_set", "a", 1, 1), ("产品", "a_set", "a", 1, 4),
        ("全部", "a_set", None, 1, 2), ("机构", "a_set", None, 1, 2), ("全部", "b_set", "x", 2, None),
        ("机构", "b_set", "x", 2, None), ("全部", "b_set", "y", 1, None), ("产品", "b_set", "y", 1, None)}


def test_a_distinct_projection_has_tasks_of_its_own(spark):
    assert "REPARTITION_BY_NUM" in _plan(CR.ctgry_deal_strategy_info(_feeds(spark, bond_deal=_deals())))
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (None, None), (None, None)], "k int, v string").repartition(3)
    assert sorted(map(repr, distinct_rows(df).collect())) == sorted(map(repr, df.distinct().collect()))
