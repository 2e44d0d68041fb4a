"""Reports on the driver tables: oracle slice, invariants, plan checks."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as E
from bondmart.registry import feeds_for
from bondmart.plans import cash_reports as CR
from bondmart.plans import repo_reports as RR
from bondmart.sources.testviews import TABLES

ORACLE_SLICE = [
    "member_price_deal_info", "ctgry_price_deal_info", "global_price_deal_info",
    "member_ctgry_amount_deal_info", "member_bond_type_deal_info", "ctgry_bond_rtng_deal_info",
    "root_deal_amount_trans_info", "root_trade_deadline_info", "ctgry_deal_strategy_info",
    "ingest_csv_strict", "sink_upsert_merge", "dq_unmatched",
]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, Decimal):
        return v.normalize()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", ORACLE_SLICE)
def test_against_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    a = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    b = Counter(tuple(_norm(dict(zip(ocols, r))[c]) for c in cols) for r in cur.fetchall())
    assert a == b


@pytest.fixture(scope="module")
def feeds(spark):
    return feeds_for(spark, SF_SMALL)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "price_difference" in df.columns and df.count() > 0


def test_join_types_sum_to_all(feeds):
    df = RR.member_bond_ctgry_deal_info(feeds)
    keys = ["unq_id_in_src_sys", "bond_ctgry_nm", "deal_dt"]
    allv = df.filter(F.col("join_type") == "全部").groupBy(*keys).agg(F.sum("repo_sum_amount").alias("a"))
    parts = df.filter(F.col("join_type") != "全部").groupBy(*keys).agg(F.sum("repo_sum_amount").alias("p"))
    bad = allv.join(parts, keys, "full_outer").filter(~F.col("a").eqNullSafe(F.col("p")))
    assert bad.count() == 0


def test_bought_equals_sold_per_bond_day(feeds):
    df = CR.base_investment_returns(feeds)
    g = df.groupBy("bond_id", "deal_dt").agg(F.sum("buy_face_price").alias("b"), F.sum("sell_face_price").alias("s"))
    assert g.filter(F.col("b") != F.col("s")).count() == 0


def test_counter_party_tables_equal(feeds):
    a = CR.REPORTS["root_counter_party_bond_info"](feeds)
    b = CR.REPORTS["root_counter_party_number"](feeds)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_full_outer_form_equals_unpivot_form(spark):
    q = E.queries()
    a = q["buy_sell_full_outer"](spark, SF_SMALL)
    b = q["base_investment_returns"](spark, SF_SMALL).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_banks_subset_and_rate_bounds(feeds):
    g = RR.global_price_deal_info(feeds)
    assert g.filter(F.col("banks_weighted_price").isNotNull() & F.col("market_weighted_price").isNull()).count() == 0
    assert g.filter((F.col("market_weighted_price") < F.col("market_min_deal_repo_rate").cast("double") - 1e-6)
                    | (F.col("market_weighted_price") > F.col("market_max_deal_repo_rate").cast("double") + 1e-6)
                    ).count() == 0


def test_allocation_sums_to_deal_amount(feeds):
    from bondmart.plans import base as B

    c = B.fact_repo_collateral(feeds)
    g = c.groupBy("ev_id", "trade_amnt").agg(F.sum("alloc").alias("s"), F.count(F.lit(1)).alias("n"))
    bad = g.filter(F.abs(F.col("s") - F.col("trade_amnt")) > F.col("n") * F.lit(Decimal("0.00005")))
    assert bad.count() == 0


@pytest.mark.parametrize("name", list(RR.REPORTS) + list(CR.REPORTS))
def test_plan_is_jvm_only_without_cartesian(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
                "PythonUDF"):
        assert bad not in plan, (name, bad)


def test_type_fan_out_is_above_the_first_aggregate(spark):
    """Root reports aggregate at member grain before the fan-out to participant types."""
    from bondmart.plans import cash_reports, repo_reports
    from bondmart.registry import feeds_for

    f = feeds_for(spark, "/root/testdata/sf0.001")
    seen = 0
    for name, report in {**repo_reports.REPORTS, **cash_reports.REPORTS}.items():
        plan = report(f)._jdf.queryExecution().optimizedPlan().toString().split("\n")
        for i, line in enumerate(plan):
            if "Generate explode(array(全部" in line:
                seen += 1
                assert any("Aggregate" in x for x in plan[i + 1:]), name
    assert seen >= 16
