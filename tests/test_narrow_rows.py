"""What the rows of a roll-up carry through a shuffle, read from the plans; results on small rows."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_grains import _deals
from test_operators import _feeds
from test_shuffles import _plan, _rows

from bondmart.operators import rollup as R
from bondmart.plans import cash_reports as CR
from bondmart.sources import testviews as T


def test_totals_are_added_up_from_the_types(spark):
    df, rollup = _rows(spark)
    df = df.withColumn("d", F.col("x").cast("decimal(18,2)")).withColumn("fine", F.col("x").cast("decimal(30,10)"))
    sums = {"x": F.col("x"), "d": F.col("d"), "fine": F.col("fine")}
    apart = R._apart(R.with_rollup(df, rollup), ["root", "key"], sums, R.PARTICIPANT_TYPES)
    # a decimal of so many places would be rounded by an addition
    assert [c for c in apart.columns if c.endswith("_0")] == ["fine_0"]
    out = R.rollup_agg(df, rollup, ["key"], sums)
    assert dict(out.dtypes)["d"] == "decimal(28,2)" and dict(out.dtypes)["x"] == "bigint"
    whole = {r.root: (r.x, r.d, r.fine) for r in out.collect() if r.join_type == "全部"}
    assert whole == {"10": (3, Decimal(3), Decimal(3)), "30": (None, None, None), "99": (4, Decimal(4), Decimal(4))}


def test_strings_collect_items_before_the_fan_out(spark):
    df, rollup = _rows(spark)
    more = df.unionByName(spark.createDataFrame([("11", "k", "c", 1), ("10", "k", None, 5)], df.schema))
    out = R.rollup_strings(more, rollup, ["key"], {"x": more.x}, {"s": more.item}, lambda items: F.array_join(F.sort_array(items), ","))
    plan = _plan(out)
    assert plan.index("Generate explode") < plan.index("ObjectHashAggregate") and "n_rows" not in plan
    assert {tuple(r) for r in out.select("root", "join_type", "key", "x", "s", "s_size").collect()} == {
        ("10", "全部", "k", 9, "a,c", 2), ("10", "产品", "k", 2, "a,c", 2), ("10", "机构", "k", 7, "a", 1),
        ("30", "全部", "k", None, "b", 1), ("30", "货币市场基金", "k", None, "b", 1),
        ("99", "全部", None, 4, "", 0), ("99", "机构", None, 4, "", 0)}


@pytest.mark.parametrize("query, unused", [
    (CR.root_roi_performance, "bond_type8"),
    (lambda f: CR.SET_TABLES["root_counter_party_bond_info"].report(f), "bond_type8"),
    (lambda f: CR.SET_TABLES["root_distribution_number"].report(f), "bond_type4")])
def test_unused_bond_lookups_are_left_out(spark, query, unused):
    f = _feeds(spark, bond_deal=_deals())
    assert unused not in _plan(query(f))


def test_deals_of_large_orders_are_made_in_more_tasks(spark, monkeypatch):
    rows = spark.range(40).selectExpr("id % 10 as k", "id as v")
    orders = spark.range(10).selectExpr("id as o", "id * 2 as w")
    plain = T._joined(rows, "k", orders, "o")
    assert "REPARTITION_BY_NUM" not in _plan(plain)
    monkeypatch.setattr(T, "BROADCAST_MAX_BYTES", 0)
    monkeypatch.setattr(T, "TASK_BYTES", 16)
    large = T._joined(rows.select("k", "v"), "k", orders.select("o", "w"), "o")
    assert "REPARTITION_BY_NUM" in _plan(large)
    assert sorted(map(tuple, large.collect())) == sorted(map(tuple, plain.collect()))
