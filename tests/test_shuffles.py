"""How often the rows of a report are shuffled, read from the plans; results on small rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_grains import _deals
from test_operators import OPEN, _feeds, _member

from bondmart.operators import joins
from bondmart.operators import rollup as R
from bondmart.plans import cash_reports as CR
from bondmart.plans import quality as Q


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(spark):
    df = spark.createDataFrame([("11", "k", "a", 1), ("10", "k", "a", 2), ("30", "k", "b", None), ("99", None, None, 4)],
                               "member string, key string, item string, x int")
    rollup = spark.createDataFrame([("11", "10", "产品"), ("10", "10", "机构"), ("30", "30", "货币市场基金")],
                                   "member string, root string, join_type string")
    return df.repartition("x"), F.broadcast(rollup)


@pytest.fixture()
def no_broadcast(spark, monkeypatch):
    """Dimensions of a size that is joined by shuffle."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(joins.small, "__defaults__", (0,))
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_sums_by_root_are_shuffled_once(spark):
    df, rollup = _rows(spark)
    out = R.rollup_agg(df, rollup, ["key"], {"x": df.x})
    assert _plan(out).count("Exchange hashpartitioning(root") == 1 and "Exchange hashpartitioning(member" not in _plan(out)
    assert {tuple(r) for r in out.collect()} == {
        ("10", "全部", "k", 3), ("10", "产品", "k", 1), ("10", "机构", "k", 2), ("30", "全部", "k", None),
        ("30", "货币市场基金", "k", None), ("99", "全部", None, 4), ("99", "机构", None, 4)}


def test_sets_by_root_are_shuffled_as_distinct_rows(spark):
    """Once to make items distinct, once more to bring the rows of a report together."""
    f = _feeds(spark, bond_deal=_deals())
    own = CR.SET_TABLES["root_counter_party_bond_info"]
    assert _plan(own.items(f)).count("Exchange hashpartitioning(root") == 1
    for df in (own.report(f), own.report(f, strings=False), CR.root_period_sizes(f)):
        assert _plan(df).count("Exchange hashpartitioning(root") == 2
        assert "Exchange hashpartitioning(member" not in _plan(df)
    items = own.items(f)
    for strings, way in ((True, own.strings), (False, own.sizes)):
        got, want = own.report(f, strings=strings), way(items)
        assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_dated_members_are_checked_with_the_members(spark, no_broadcast):
    members = [_member(i) for i in ("10", "11", "20", "30", "40")]
    members.append({**_member("11"), "efctv_from_dt": dt.date(2020, 1, 1), "efctv_to_dt": dt.date(2020, 1, 3)})
    members = [{**m, "efctv_from_dt": dt.date(2020, 1, 1)} if m["ip_id"] == "40" else m for m in members]
    f = _feeds(spark, member_d=members, bond_deal=_deals())
    out = Q.effective_dated_cash_deals(f)
    for party in ("buy_ip_id", "sell_ip_id"):
        assert _plan(out).count(f"Exchange hashpartitioning({party}") == 2, party  # the members' and the deals', once each
    days = {(r.sell_ip_id, r.deal_dt) for r in out.collect()}
    assert ("40", dt.date(2020, 1, 2)) in days and ("40", dt.date(2020, 1, 1)) not in days
    assert ("30", dt.date(2020, 1, 1)) in days and OPEN not in {d for _, d in days}
