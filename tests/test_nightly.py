"""Nightly run over dumps of different nights: equal to a batch run over all of
them, and only the days concerned are rewritten."""

from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys

from test_operators import OPEN, _feeds, _member, _rel

from bondmart.plans import job
from bondmart.plans import repo_reports as RR
from bondmart.sources import csvfeeds
from bondmart.streaming import nightly

D1, D2, D3, D4 = (dt.date(2020, 1, d) for d in (1, 2, 3, 4))
NAMES = [*RR.REPORTS, "root_deal_amount_trans_info", "root_deal_strategy_info", "bondinfo", "root_distribution_number"]
BOND = {"bond_ctgry_nm": "国债", "issr_id": "I1", "c3": "x", "bond_nm": "n", "bond_cd": "c", "c6": "x", "c7": "x",
        "mrty_dt": "2030-01-01", "c9": "x", "c10": "x", "c11": "x", "lstng_dt": "2010-01-01", "bond_prnt_tp_nm": "信用债"}


def _rating(bond, raw, start, end):
    return {"bond_id": bond, "rtng_raw": raw, "rtng_start_dt": start, "rtng_end_dt": end, "c4": "x"}


RATINGS = [_rating("b1", "AAA", dt.date(2019, 1, 1), D2), _rating("b1", "AA", D3, OPEN), _rating("b2", "AA", dt.date(2019, 1, 1), OPEN)]


def static(spark, ratings=RATINGS, **extra):
    bonds = [BOND | {"bond_id": b} for b in ("b1", "b2")]
    return _feeds(spark, bond_repo_deal_f=[], bond_d=bonds, ri_credit_rtng=ratings, **extra)


def repo(i, repo_ip, rvrse_ip, day, amount="100.00", nmbr=None):
    return f"11002e{i},{repo_ip},{rvrse_ip},P1,{nmbr or f'r{i}'},1,{day},2.0,{amount},109,x"


def pledge(i, bond, face, haircut="0.9"):
    return f"{bond},11002e{i},{haircut},{face},x"


def cash(i, buy, sell, day, bond="b1", nmbr=None):
    return f"c{i},{buy},{sell},{nmbr or f'n{i}'},{day},1,{bond},CNY,1,10.00,100,2,x,y,z"


def failed(suffix, market="109"):
    return f"2,1,{market},{suffix},x"


DEALS = {"bond_repo_deal_f": [repo(1, 11, 30, D1), repo(2, 20, 30, D2), repo(3, 30, 20, D3), repo(4, 11, 20, D4)],
         "bond_deal": [cash(1, 11, 30, D1, nmbr="s"), cash(2, 20, 30, D2), cash(3, 30, 11, D4, "b2")]}
PLEDGES = {"ev_cltrl_dtls": [pledge(1, "b1", 60), pledge(1, "b2", 40), pledge(2, "b1", 10), pledge(3, "b1", 5),
                             pledge(4, "b2", 7), pledge(9, "b1", 8)],
           "dps_v_cr_dep_txn_dtl": ["r1,1", "r4,0"], "dps_v_cbt_all_txn_dtl": ["s,1"]}


def land(root, night, drops):
    for feed, lines in drops.items():
        os.makedirs(f"{root}/{feed}", exist_ok=True)
        with open(f"{root}/{feed}/night{night}.csv", "w") as f:
            f.write("\n".join([csvfeeds.header_text(feed), *lines]) + "\n")


def batch(spark, feeds, drops, out):
    facts = {}
    for feed in nightly.FEEDS:
        lines = [x for d in drops for x in d.get(feed, [])]
        facts[feed] = csvfeeds.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"), feed)
    job.run(spark, feeds.derive(**facts), out, NAMES)
    return out


def tables(spark, root, names=NAMES):
    out = {}
    for name in names:
        try:
            df = spark.read.parquet(f"{root}/{name}")
            out[name] = sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)
        except Exception:  # a table of no rows has no files
            out[name] = []
    return out


def written(root, name):
    """Time of each day's partition."""
    return {d: max(os.stat(f"{root}/{name}/{d}/{f}").st_mtime_ns for f in os.listdir(f"{root}/{name}/{d}"))
            for d in os.listdir(f"{root}/{name}") if d.startswith("deal_dt=")}


FIRST = """
import sys
sys.path[:0] = [{root!r}, {tests!r}]
from pyspark.sql import SparkSession
import test_nightly as T
from bondmart.streaming import nightly
s = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {ckpt!r}).getOrCreate()
T.land({landing!r}, 1, T.DEALS)
days = nightly.run_night(s, {landing!r}, T.static(s), {out!r}, {state!r}, T.NAMES)
assert days == {{"repo": [T.D1, T.D2, T.D3, T.D4], "cash": [T.D1, T.D2, T.D4]}}, days
s.stop()
"""


def test_nights_equal_a_batch_and_rewrite_few_days(spark, tmpdir_path):
    landing, out, state = (f"{tmpdir_path}/{x}" for x in ("landing", "out", "state"))
    here = os.path.dirname(os.path.abspath(__file__))
    code = FIRST.format(root=os.path.dirname(here), tests=here, ckpt=f"{tmpdir_path}/ckpt", landing=landing, out=out, state=state)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)

    # night 2, another application: the collateral and flags of last night's deals
    land(landing, 2, PLEDGES)
    days = nightly.run_night(spark, landing, static(spark), out, state, NAMES)
    assert days == {"repo": [D1, D2, D3, D4], "cash": [D1]}
    drops = [DEALS, PLEDGES]
    assert tables(spark, out) == tables(spark, batch(spark, static(spark), drops, f"{tmpdir_path}/b2"))
    assert tables(spark, out)["member_bond_type_deal_info"] and tables(spark, out)["global_price_deal_info"]

    # night 3: deal 2 failed after all, deal 9 comes after its collateral, the number s has a second deal
    late = {"trdx_deal_infrmn_rmv_d": [failed("e2")], "bond_repo_deal_f": [repo(9, 30, 11, D4)],
            "bond_deal": [cash(7, 20, 11, D2, nmbr="s")]}
    before = written(out, "member_price_deal_info")
    land(landing, 3, late)
    days = nightly.run_night(spark, landing, static(spark), out, state, NAMES)
    assert days == {"repo": [D2, D4], "cash": [D2]}
    drops.append(late)
    want = tables(spark, batch(spark, static(spark), drops, f"{tmpdir_path}/b3"))
    assert tables(spark, out) == want
    after = written(out, "member_price_deal_info")
    assert f"deal_dt={D2}" not in after  # its only deal was removed
    assert {d for d in after if after[d] != before.get(d)} == {f"deal_dt={D4}"}

    # night 4: no dumps; the first rating of b1 ends a day later
    ratings = [_rating("b1", "AAA", dt.date(2019, 1, 1), D3), _rating("b1", "AA", D4, OPEN), RATINGS[2]]
    stale = tables(spark, out)
    days = nightly.run_night(spark, landing, static(spark, ratings), out, state, NAMES)
    assert days == {"repo": [D3], "cash": []}
    assert tables(spark, out) != stale

    # night 5: member 20 gets a root; all days on which it trades
    relations = {"cim_org_rl": [_rel("11", "10"), _rel("10", "1"), _rel("20", "30")]}
    days = nightly.run_night(spark, landing, static(spark, ratings, **relations), out, state, NAMES)
    assert days == {"repo": [D2, D3, D4], "cash": [D2]}
    want = tables(spark, batch(spark, static(spark, ratings, **relations), drops, f"{tmpdir_path}/b5"))
    assert tables(spark, out) == want
    assert nightly.run_night(spark, landing, static(spark, ratings, **relations), out, state, NAMES) == {"repo": [], "cash": []}


def test_rejects_are_kept_and_replayed_once(spark, tmpdir_path):
    landing, out, state = (f"{tmpdir_path}/{x}" for x in ("landing", "out", "state"))
    names = ["root_deal_amount_trans_info"]
    bad = [cash(2, 20, 30, "2020-13-01"), "1,2,3"]
    land(landing, 1, {"bond_deal": [cash(1, 11, 30, D1), *bad]})
    nightly.run_night(spark, landing, static(spark), out, state, names)
    store = nightly.Store(spark, state)
    rejects = {r.line: r for r in store.rejects().collect()}
    assert {r.reason for r in rejects.values()} == {"deal_dt", "arity"} and set(rejects) == set(bad)
    fixed = spark.createDataFrame([(rejects[bad[0]].reject_id, cash(2, 20, 30, D2)), ("unknown", "x")], "reject_id string, line string")
    assert [nightly.replay(spark, fixed, landing, state) for _ in range(2)] == [1, 0]
    assert nightly.run_night(spark, landing, static(spark), out, state, names) == {"repo": [], "cash": [D2]}
    assert nightly.replay(spark, fixed, landing, state) == 0
    rows = spark.read.parquet(f"{out}/{names[0]}").where(f"deal_dt = '{D2}' and participant_type = '全部'").collect()
    assert {r.member_id: r.deal_number_size for r in rows} == {"20": 1, "30": 1}


def test_a_batch_run_again_changes_nothing(spark, tmpdir_path):
    store = nightly.Store(spark, f"{tmpdir_path}/state")
    lines = [("bond_repo_deal_f", x) for x in DEALS["bond_repo_deal_f"]] + [("ev_cltrl_dtls", x) for x in PLEDGES["ev_cltrl_dtls"]]
    df = spark.createDataFrame([(x, f, f) for f, x in lines], "value string, feed string, src string")
    later = spark.createDataFrame([(repo(9, 30, 11, D4), "bond_repo_deal_f", "z")], "value string, feed string, src string")
    seen = []
    for b in (df, df, later, later):
        nightly.ingest_batch(store)(b, 0)
        seen.append([sorted(map(tuple, t.collect()), key=repr) for t in (
            store.deals("repo"), store.dated("ev_cltrl_dtls"), store.waiting("ev_cltrl_dtls"), store.pending())])
    assert seen[0] == seen[1] and seen[2] == seen[3]
    assert len(seen[0][1]) == 5 and len(seen[0][2]) == 1 and len(seen[2][1]) == 6


def test_changed_rating_stretches(spark):
    cols = "bond_id string, seg_start date, seg_end date, rtng_rank int"
    old = spark.createDataFrame([("a", D1, D4, 2), ("b", D1, D2, 0), ("c", D1, OPEN, 1)], cols)
    new = spark.createDataFrame([("a", D1, D2, 2), ("a", D3, D3, 1), ("a", D4, D4, 2), ("c", D1, OPEN, 1), ("d", D2, D3, 3)], cols)
    got = {tuple(r) for r in nightly.changed_ratings(old, new).collect()}
    assert got == {("a", D3, D3), ("d", D2, D3)}  # b had the lowest bucket, which is no rating too
