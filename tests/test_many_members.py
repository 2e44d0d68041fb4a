"""Reports where members are too many to broadcast: shuffles read from the plans, rows equal to those with broadcasts."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F
from test_grains import _deals
from test_operators import _feeds, _member, _rel
from test_shuffles import _plan

from bondmart import labels as L
from bondmart.operators import joins
from bondmart.operators import rollup as R
from bondmart.operator_queries import OPERATOR_QUERIES
from bondmart.plans import base as B
from bondmart.plans import cash_reports as CR


@pytest.fixture()
def many_members(spark, monkeypatch):
    """A call from which on no dimension is broadcast."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def begin():
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        monkeypatch.setattr(joins.small, "__defaults__", (0,))

    yield begin
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def _cash_feeds(spark):
    bonds = [{"bond_id": f"b{i}", "bond_ctgry_nm": "国债", "issr_id": "i", "c3": "x", "bond_nm": "n"} for i in range(0, 30, 2)]
    failed = [{"rmv_kind": L.FAILED_KIND, "rmv_reason": L.FAILED_REASON, "mkt_id": "110", "deal_suffix": s} for s in ("c3", "c3", "c8", None)]
    match = [{"deal_nmbr": f"n{i}", "match_status": str(i % 3)} for i in range(0, 40, 3)]
    deals = _deals()
    deals += [{**d, "buy_ip_id": d["sell_ip_id"], "sell_ip_id": d["buy_ip_id"]} for d in deals[:30]]
    deals += [{**deals[0], "buy_ip_id": None}, {**deals[1], "bond_id": None, "deal_nmbr": None}, {**deals[4], "deal_dt": None}]
    members = [_member(i) for i in ("1", "10", "11", "20", "30")] + [{**_member("40"), "member_ctgry_id": None}]
    return _feeds(spark, bond_deal=deals, bond_d=bonds, member_d=members, trdx_deal_infrmn_rmv_d=failed,
                  dps_v_cbt_all_txn_dtl=match, cim_org_rl=[_rel("11", "10"), _rel("10", "1"), _rel("40", "30")])


def _rows(df) -> list[str]:
    return sorted(map(repr, df.collect()))


def _same_rows(spark, many_members, query):
    """The plan of a query once members are many; its rows are those that it had before."""
    want = _rows(query(_cash_feeds(spark)))
    many_members()
    out = query(_cash_feeds(spark))
    plan = _plan(out)
    assert want and _rows(out) == want
    return plan


def _shuffles(plan: str, key: str) -> int:
    return plan.count(f"Exchange hashpartitioning({key}#")


def _distinct_projection(f):
    return CR._deals_with_cats(f).select("buy_cat", "sell_cat", "deal_nmbr", "dirty_amnt", "bond_type4", "deal_dt",
                                         "deal_strategy").dropDuplicates()


@pytest.mark.parametrize("query", [CR.root_bond_deal, CR.root_term_preference, CR.root_deal_rows, CR.ctgry_trade_deadline_info])
def test_a_party_is_looked_up_where_it_is_checked(spark, many_members, query):
    """Each party's deals and the members, once each: no shuffle of the sides by member."""
    plan = _same_rows(spark, many_members, query)
    assert _shuffles(plan, "member") == 0 and _shuffles(plan, "buy_ip_id") == _shuffles(plan, "sell_ip_id") == 2


def test_a_distinct_projection_looks_categories_up_with_the_members(spark, many_members):
    plan = _same_rows(spark, many_members, _distinct_projection)
    assert _shuffles(plan, "buy_ip_id") == _shuffles(plan, "sell_ip_id") == 2


def test_the_registered_distinct_projection_is_the_one_tested(spark):
    f = _cash_feeds(spark)
    assert "distinct_projection" in OPERATOR_QUERIES and _rows(_distinct_projection(f)) == _rows(CR._deals_with_cats(f).select(
        "buy_cat", "sell_cat", "deal_nmbr", "dirty_amnt", "bond_type4", "deal_dt", "deal_strategy").distinct())


def test_few_failed_deals_shuffle_no_deals(spark):
    """The feed's size isn't known here, that of the failed deals written is."""
    f = _cash_feeds(spark)
    assert not joins.is_small(B.failed_cash_deals(f)) and joins.is_small(B.failed_cash_ids(f))
    out = B.fact_cash_deal(f)
    assert _shuffles(_plan(out), "bond_deal_id") == 0
    assert {r.bond_deal_id for r in out.collect()} & {"c3", "c8", "c1"} == {"c1"}


def test_members_own_columns_go_with_the_side(spark):
    df = spark.createDataFrame([("a", "b", "ra", "rb", 1), (None, "c", None, "rc", 2)], "x string, y string, rx string, ry string, v int")
    out = R.sides_unpivot(df, (("BUY", "x", "y"), ("SELL", "y", "x")), own={"root": ["rx", "ry"]})
    assert out.columns == ["v", "side", "member", "counter", "root"]
    assert {tuple(r) for r in out.collect()} == {(1, "BUY", "a", "b", "ra"), (1, "SELL", "b", "a", "rb"),
                                                 (2, "BUY", None, "c", None), (2, "SELL", "c", None, "rc")}


@pytest.mark.parametrize("name, strings", [
    ("root_distribution_number", True), ("root_distribution_number", False), ("root_counter_party_bond_info", True),
    ("root_counter_party_bond_info", False), ("root_counter_party_buyer", True), ("root_deal_amount_trans_info", False)])
def test_sets_of_rooted_rows_are_shuffled_once(spark, many_members, name, strings):
    """By root and key, before there is a row per set."""
    plan = _same_rows(spark, many_members, CR.set_report(name, strings))
    assert _shuffles(plan, "member") == 0 and _shuffles(plan, "buy_ip_id") == _shuffles(plan, "sell_ip_id") == 2
    assert _shuffles(plan, "root") == 1 and "_set#" not in re.search(r"Exchange hashpartitioning\(root#.*", plan)[0]


def test_items_of_rooted_rows(spark, many_members):
    plan = _same_rows(spark, many_members, CR.SET_TABLES["root_counter_party_bond_info"].items)
    assert _shuffles(plan, "member") == 0 and _shuffles(plan, "root") == 1


def test_items_of_a_month_are_counted_in_tasks_of_their_own(spark, many_members):
    """As many tasks as the deals' files ask for, which adaptive execution keeps; one shuffle of rooted rows."""
    f = _cash_feeds(spark)
    tasks = joins.tasks_for(f.bond_deal, CR.TASK_BYTES)
    assert re.search(rf"hashpartitioning\(root#.*month#\d+, {tasks}\), REPARTITION_BY_NUM", _plan(CR.root_period_sizes(f)))
    plan = _same_rows(spark, many_members, CR.root_period_sizes)
    assert _shuffles(plan, "root") == 1 and _shuffles(plan, "member_id") == 0


def test_tasks_grow_with_the_files(spark, tmpdir_path):
    spark.range(20000).write.parquet(f"{tmpdir_path}/t")
    df = spark.read.parquet(f"{tmpdir_path}/t")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert joins.tasks_for(df, 1 << 40) == least == joins.tasks_for(spark.createDataFrame([(1,)], "id long"), 1)
    assert joins.tasks_for(df.join(df.withColumnRenamed("id", "k"), df.id == F.col("k")), 1024) > joins.tasks_for(df, 1024) > least


def test_sides_are_combined_in_tasks_of_their_own(spark, many_members):
    """Not in those of the bond lookup, by all keys and not by bond alone."""
    many_members()
    f = _cash_feeds(spark)
    for query in (CR.root_bond_deal, CR.set_report("root_distribution_number"), CR.set_report("root_distribution_number", False)):
        exchange = re.search(r"Exchange hashpartitioning\(root#.*", _plan(query(f)))[0]
        assert "REPARTITION_BY_NUM" in exchange and "deal_dt#" in exchange and "bond_type8#" in exchange
