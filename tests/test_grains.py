"""Shared grains: scans of the facts in a nightly run, layout by root, equality with single reports."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_operators import _feeds, _member, _rel

from bondmart.plans import cash_reports as CR
from bondmart.plans import grains, job
from bondmart.registry import feeds_for

SF = "/root/testdata/sf0.001"
IN_PLACE = ("root_trade_deadline_info", "root_bond_deal", "root_investment_returns", "root_roi_performance",
            "root_bond_concentration", "root_term_preference", "ctgry_bond_deal", "base_investment_returns",
            "union_info_for_bond_concentration")


@pytest.fixture(scope="module")
def stored(spark):
    f = feeds_for(spark, SF).derive()
    job.build_dimensions(f)
    job.materialize_facts(spark, f)
    yield f
    job.clean_up(spark, f)


def _scans(df) -> Counter:
    """How often a plan reads each stored fact or grain."""
    leaves, out = df._jdf.queryExecution().optimizedPlan().collectLeaves(), Counter()
    for i in range(leaves.size()):
        if leaves.apply(i).getClass().getSimpleName() == "LogicalRelation":
            out[leaves.apply(i).relation().location().rootPaths().head().getName()] += 1
    return out


def test_scans_of_a_nightly_run(spark, stored):
    """Building the grains, all 42 tables and their sets read each fact a few times in all."""
    plans = [grains.GRAINS[g].combined(stored) for g in grains.GRAINS]
    for name, _ in job.report_jobs(job.REPORTS):
        own = CR.SET_TABLES.get(name)
        plans.append(own.items(stored) if own else job.REPORTS[name](stored))
    seen = sum(map(_scans, plans), Counter())
    assert {n: seen[n] for n in job.FACTS} == {"fact_repo_deal": 3, "fact_repo_collateral": 1, "fact_cash_deal": 5}


def test_readers_are_listed(spark, stored):
    """GRAIN_REPORTS names exactly the reports whose plans read a stored grain."""
    for name in job.REPORTS:
        want = {g for g, own in job.GRAIN_REPORTS.items() if name in own}
        got = {n for n in _scans(job.REPORTS[name](stored)) if n in grains.GRAINS}
        assert got == want, name


@pytest.mark.parametrize("name", IN_PLACE)
def test_layout_saves_the_exchange(spark, stored, name):
    plan = job.REPORTS[name](stored)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan


def _deals():
    out = []
    for i in range(90):
        out.append({"bond_deal_id": f"c{i}", "buy_ip_id": "11" if i % 3 else "30", "sell_ip_id": "30" if i % 3 else "40",
                    "deal_nmbr": f"n{i % 40}", "deal_dt": dt.date(2020, 1, 1 + i % 2), "st": "1", "bond_id": f"b{i % 30}",
                    "crncy": "CNY", "trade_amnt": Decimal("1"), "dirty_amnt": Decimal(i) if i % 7 else None,
                    "face_value": Decimal("100"), "yrs_to_mrty": Decimal(i % 5) if i % 11 else None})
    return out


@pytest.mark.parametrize("laid_out", [True, False])
def test_stored_grain_gives_the_same_reports(spark, laid_out):
    """Null amounts and terms, one root in most rows."""
    f = _feeds(spark, bond_deal=_deals())
    names = [n for g in ("grain_cash", "grain_cash_pair") for n in job.GRAIN_REPORTS[g]]
    plain = {n: sorted(map(repr, job.REPORTS[n](f).collect())) for n in names}
    run = f.derive()
    job.materialize_facts(spark, run, grains=("grain_cash", "grain_cash_pair"), laid_out=laid_out)
    table = getattr(run.__dict__["_memo"]["grain_cash"], "_bm_table", None)
    assert sum(map(len, plain.values())) > 0 and bool(table) == laid_out
    for n in names:
        assert sorted(map(repr, job.REPORTS[n](run).collect())) == plain[n], n
    job.clean_up(spark, run)
    assert table is None or not spark.catalog.tableExists(table)


def test_a_hot_root_is_spread_by_its_bonds(spark, tmpdir_path):
    """Rows of one root lie in many buckets, each (root, bond) in one."""
    f = _feeds(spark, bond_deal=_deals())
    copy = grains.GRAINS["grain_cash"].write(spark, f, f"{tmpdir_path}/grain_cash")
    places = {(r.root, r.bond_id, r.place) for r in copy.select("root", "bond_id", F.input_file_name().alias("place")).collect()}
    assert len({p[:2] for p in places}) == len(places) > 20
    assert max(Counter(root for root, _ in {(p[0], p[2]) for p in places}).values()) > 1
    spark.sql(f"DROP TABLE {copy._bm_table}")


def test_a_grain_for_one_report_is_not_written():
    assert job.grains_of(["root_bond_deal"]) == []
    assert job.grains_of(["root_bond_deal", "base_investment_returns"]) == ["grain_cash"]
    assert job.grains_of(job.REPORTS, job.SIDE_FACTS["cash"]) == ["grain_cash", "grain_cash_pair"]
