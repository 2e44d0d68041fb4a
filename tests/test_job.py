"""The nightly job: from CSV dumps, over some days, with empty facts, and its clean-up."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F
from test_operators import _feeds

from bondmart import oracle
from bondmart.operators.joins import dedupe_latest
from bondmart.plans import cash_reports as CR
from bondmart.plans import job
from bondmart.registry import feeds_for
from bondmart.session import checkpoint_dir
from bondmart.sources import csvfeeds, testviews

SF = "/root/testdata/sf0.001"


def _deal(i, day, st="1"):
    return {"bond_deal_id": f"c{i}", "buy_ip_id": "11", "sell_ip_id": "30", "deal_nmbr": f"n{i}", "deal_dt": day,
            "st": st, "bond_id": "b1", "crncy": "CNY", "trade_amnt": Decimal("1"), "dirty_amnt": Decimal("10"),
            "face_value": Decimal("100"), "yrs_to_mrty": Decimal("2")}


def _norm(rows):
    def one(v):
        if isinstance(v, float):
            return round(v, 6)
        return Decimal(v).normalize() if isinstance(v, Decimal) else v

    return sorted((tuple(map(one, r)) for r in rows), key=repr)


def _few_orders(spark, root):
    """The tables with the first orders only: each day is a partition of every report."""
    for t in testviews.TABLES:
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        key = {"orders": "o_orderkey", "lineitem": "l_orderkey"}.get(t)
        (df.filter(f"{key} <= 60") if key else df).coalesce(1).write.parquet(f"{root}/{t}.parquet")
    return root


def test_csv_dumps_to_all_reports(spark, tmpdir_path):
    """Feeds rendered to CSV, both jobs run from them, every table equal to the oracle."""
    src = _few_orders(spark, os.path.join(tmpdir_path, "src"))
    feeds = testviews.load(spark, src)
    paths = csvfeeds.dump(feeds, os.path.join(tmpdir_path, "dump"))
    with open(os.path.join(paths["pd_d"], "broken.csv"), "w") as f:
        f.write("1,2,3\n\n9\n")
    loaded, rejects = csvfeeds.load(spark, paths)
    out = os.path.join(tmpdir_path, "out")
    job.run(spark, loaded, out, rejects=rejects, strings=True)
    con = duckdb.connect()
    for t in testviews.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{src}/{t}.parquet/*.parquet'")
    sql = oracle.all_sql()
    for name in job.REPORTS:
        want = con.execute(sql[name])
        names = [c[0] for c in want.description]
        got = spark.read.parquet(os.path.join(out, name)).select(*names).collect()
        assert _norm(got) == _norm(want.fetchall()), name
    dq = {r.check: r.n for r in spark.read.parquet(os.path.join(out, "data_quality")).collect()}
    assert dq["rejected:pd_d"] == 2 and dq["rows:fact_cash_deal"] > 0
    assert dq["rows:fact_repo_deal"] == con.execute(sql["fact_repo_deal"]).to_arrow_table().num_rows


def test_sets_by_root_are_rows_and_sizes(spark, tmpdir_path):
    """Without strings no aggregate holds an array, and a table and its twin share their item rows."""
    deals = [_deal(i, dt.date(2020, 1, 1 + i % 2)) | {"bond_id": f"b{i % 3}"} for i in range(6)]
    f = _feeds(spark, bond_deal=deals)
    names = [*CR.SET_TABLES, *CR.TWINS]
    job.run(spark, f, tmpdir_path, names)
    for name in names:
        want = CR.REPORTS[name](f)
        got = spark.read.parquet(f"{tmpdir_path}/{name}")
        assert not [c for c, t in got.dtypes if t == "string" and c.endswith(("_set", "deal_number"))]
        want = want.select(*got.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name
    for name, table in CR.SET_TABLES.items():
        items = table.items(f)
        for df in (items, table.sizes(items)):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert not any(x in plan for x in ("collect_set", "collect_list", "flatten")), name
        stored = spark.read.parquet(f"{tmpdir_path}/{name}_items")
        assert stored.select(*items.columns).exceptAll(items).count() == 0 and stored.count() == items.count()


def test_sketches_of_days_merge(spark):
    items = spark.range(6000).selectExpr(
        "'r' as member_id", "'x' as participant_type", "'t' as bond_type_f", "'counter_id_set' as set_name",
        "cast(id % 4000 as string) as item", "date_add(date'2020-01-01', cast(id % 30 as int)) as deal_dt")
    row = CR.SET_TABLES["root_counter_party_bond_info"].period_sizes(items, F.lit("all"), "period").first()
    assert row.n_items == 4000 and abs(row.estimate - 4000) < 200


def test_days_are_rewritten_and_cleared(spark, tmpdir_path):
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    name = "root_deal_amount_trans_info"
    read = lambda: {(r.member_id, r.deal_dt) for r in spark.read.parquet(f"{tmpdir_path}/{name}").collect()}
    job.run(spark, _feeds(spark, bond_deal=[_deal(1, d1), _deal(2, d2)]), tmpdir_path, [name])
    assert {d for _, d in read()} == {d1, d2}
    job.run(spark, _feeds(spark, bond_deal=[_deal(1, d1), _deal(2, d2, "2")]), tmpdir_path, [name], days=[d2])
    assert {d for _, d in read()} == {d1}  # the only deal of d2 was cancelled


def test_empty_facts_and_clean_up(spark, tmpdir_path):
    def left():
        root = checkpoint_dir(spark).removeprefix("file:")
        return {x for d in ("snapshots", "") for x in os.listdir(os.path.join(root, d))
                if x.startswith("facts-") or d == "snapshots"} if os.path.isdir(root) else set()

    before = left()
    job.run(spark, _feeds(spark, bond_deal=[], bond_repo_deal_f=[], ev_cltrl_dtls=[]), tmpdir_path,
            ["root_deal_amount_trans_info", "member_price_deal_info"])
    assert spark.read.parquet(f"{tmpdir_path}/data_quality").filter("check like 'rows:%'").agg({"n": "sum"}).first()[0] == 0
    assert left() == before


def test_days_reach_the_scan(spark):
    f = job.of_days(feeds_for(spark, SF), [dt.date(1995, 1, 2)])
    plan = f.bond_repo_deal_f._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "o_orderdate" in plan.split("PushedFilters")[1]


def test_equal_versions_of_a_member_are_decided(spark):
    rows = [("a", 1, "x", None), ("a", 1, "y", "p"), ("a", 1, "y", "q")]
    for order in (rows, rows[::-1]):
        got = dedupe_latest(spark.createDataFrame(order, "k string, d int, u string, v string"), ["k"], ["d"])
        assert [tuple(r) for r in got.collect()] == [("a", 1, "y", "q")]


def test_changed_input_gets_new_feeds(spark, tmpdir_path):
    for t in testviews.TABLES:
        spark.read.parquet(f"{SF}/{t}.parquet").limit(5).write.parquet(f"{tmpdir_path}/{t}.parquet")
    first = feeds_for(spark, tmpdir_path)
    assert feeds_for(spark, tmpdir_path) is first
    spark.read.parquet(f"{SF}/part.parquet").limit(9).write.mode("overwrite").parquet(f"{tmpdir_path}/part.parquet")
    assert feeds_for(spark, tmpdir_path) is not first


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session)
