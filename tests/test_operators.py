"""Operators and report rules on hand-made feeds (FIXTURES.md part C)."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from conftest import empty_feeds
from pyspark.sql import functions as F

from bondmart.operators.joins import rating_as_of, rating_segments, with_rating
from bondmart.plans import base as B
from bondmart.plans import cash_reports as CR
from bondmart.plans import repo_reports as RR

D = dt.date(2020, 1, 1)
OPEN = dt.date(9999, 12, 31)


def _member(i, name="bank"):
    return {"ip_id": i, "member_ctgry_id": "B", "member_cd": "M" + i, "full_nm": name,
            "rt_member_cd": "R", "rt_member_full_nm": "root", "efctv_from_dt": dt.date(1990, 1, 1),
            "efctv_to_dt": OPEN, "unq_id": i, "c9": "x"}


def _rel(slave, master):
    return {"rl_tp_id": "T1", "slv_unq_id": slave, "mstr_unq_id": master, "rl_status": "C",
            "valid_to": "9999-12-31 00:00:00", "c5": "x"}


def _deal(ev, repo, rvrse, rate, amt, nmbr=None):
    return {"ev_id": ev, "repo_ip_id": repo, "rvrse_ip_id": rvrse, "pd_id": "P1", "deal_nmbr": nmbr or ev,
            "st": "1", "deal_dt": D, "repo_rate": Decimal(rate), "trade_amnt": Decimal(amt), "mkt_id": "109",
            "c10": "x"}


def _feeds(spark, **extra):
    base = dict(
        pd_d=[{"pd_id": "P1", "pd_cd": "R001"}],
        market_close_type_i=[{"market": "质押式回购", "ctgry_type_nm": "BANK", "show_name_raw": "银行(x)"}],
        member_ctgry_d=[{"member_ctgry_id": "B", "ctgry_type_nm": "BANK"}],
        after_hours_bond_type=[{"show_name_raw": "银行（y）", "member_ctgry_id": "B"}],
        member_d=[_member(i) for i in ("1", "10", "11", "20", "30")],
        mstr_slv_rl_tp_rl=[{"rl_kind": "1", "rl_tp_id": "T1", "valid_to": "9999-12-31", "c3": "x"}],
        cim_org_rl=[_rel("11", "10"), _rel("10", "1"), _rel("20", "20")],
        bond_repo_deal_f=[_deal("11002e1", "11", "30", "2.0", "100.00"),
                          _deal("11002e2", "20", "30", "3.0", "50.00")],
    )
    base.update(extra)
    return empty_feeds(spark, **base)


def test_root_rollup_one_level_and_self_mapped(spark):
    f = _feeds(spark)
    rows = {(r.unq_id_in_src_sys, r.join_type): r for r in RR.member_price_deal_info(f).collect()}
    # 11 -> 10 (one level: 10's own master 1 is not followed)
    assert set(rows) == {("10", "全部"), ("10", "产品"), ("20", "全部"), ("20", "机构"),
                         ("30", "全部"), ("30", "机构")}
    assert rows[("10", "产品")].repo_weighted_price == 2.0
    r30 = rows[("30", "全部")]
    assert r30.rvrse_weighted_price == round((2 * 100 + 3 * 50) / 150, 6)
    assert r30.repo_weighted_price is None and r30.price_difference is None and r30.total_amount is None


def test_self_mapped_member_is_product_in_cash_job(spark):
    deal = {"bond_deal_id": "c1", "buy_ip_id": "20", "sell_ip_id": "30", "deal_nmbr": "n1", "deal_dt": D,
            "st": "1", "bond_id": "b1", "crncy": " CNY ", "trade_amnt": Decimal("1"),
            "dirty_amnt": Decimal("101.50"), "face_value": Decimal("100"), "yrs_to_mrty": Decimal("2")}
    f = _feeds(spark, bond_deal=[deal])
    rows = {(r.member_id, r.participant_type) for r in CR.REPORTS["root_deal_amount_trans_info"](f).collect()}
    assert rows == {("20", "全部"), ("20", "产品"), ("30", "全部"), ("30", "机构")}


def test_collateral_ratio_duplicates_and_zero_face(spark):
    c = [("b1", "11002e1", "0.9", "60"), ("b1", "11002e1", "0.9", "60"), ("b2", "11002e1", "0.8", "40"),
         ("b3", "11002e2", "1.0", "0"), ("b4", "11002e2", "1.0", "0")]
    cl = [{"bond_id": b, "ev_id": e, "cnvrsn_prprtn": Decimal(h), "face_value": Decimal(v), "c4": "x"}
          for b, e, h, v in c]
    f = _feeds(spark, ev_cltrl_dtls=cl)
    got = {(r.ev_id, r.bond_id): r.alloc for r in B.fact_repo_collateral(f).collect()}
    assert got == {("11002e1", "b1"): Decimal("60.0000"), ("11002e1", "b2"): Decimal("40.0000"),
                   ("11002e2", "b3"): Decimal("0.0000"), ("11002e2", "b4"): Decimal("0.0000")}


def test_rating_same_interval_takes_lowest_and_bounds_inclusive(spark):
    r = [{"bond_id": "b1", "rtng_raw": "AAA", "rtng_start_dt": D, "rtng_end_dt": dt.date(2020, 1, 31), "c4": "x"},
         {"bond_id": "b1", "rtng_raw": "AA", "rtng_start_dt": D, "rtng_end_dt": dt.date(2020, 1, 31), "c4": "x"},
         {"bond_id": "b2", "rtng_raw": "AA+", "rtng_start_dt": D, "rtng_end_dt": D, "c4": "x"}]
    f = _feeds(spark, ri_credit_rtng=r)
    rows = spark.createDataFrame([("b1", D), ("b2", D), ("b2", dt.date(2020, 1, 2)), ("b9", D)],
                                 "bond_id string, deal_dt date")
    got = {(x.bond_id, x.deal_dt): x.rtng_desc for x in with_rating(rows, B.dim_rating_segments(f)).collect()}
    assert got == {("b1", D): "AA及以下", ("b2", D): "AA+", ("b2", dt.date(2020, 1, 2)): "AA及以下",
                   ("b9", D): "AA及以下"}


def test_rating_segments_equal_keyed_as_of_on_random_overlaps(spark):
    rnd = random.Random(7)
    rows, keys = [], set()
    base = dt.date(2020, 1, 1)
    for b in range(12):
        for _ in range(rnd.randint(1, 4)):
            s = base + dt.timedelta(days=rnd.randint(0, 40))
            e = s + dt.timedelta(days=rnd.randint(0, 30))
            rows.append((f"b{b}", s, e, rnd.randint(0, 2)))
        for _ in range(15):
            keys.add((f"b{b}", base + dt.timedelta(days=rnd.randint(-5, 80))))
    ratings = spark.createDataFrame(rows, "bond_id string, rtng_start_dt date, rtng_end_dt date, rtng_rank int")
    ratings = ratings.groupBy("bond_id", "rtng_start_dt", "rtng_end_dt").agg(F.min("rtng_rank").alias("rtng_rank"))
    k = spark.createDataFrame(sorted(keys), "bond_id string, deal_dt date")
    a = {(r.bond_id, r.deal_dt): r.rtng_rank for r in rating_as_of(k, ratings).collect()}
    seg = rating_segments(ratings)
    j = k.join(seg, (k.bond_id == seg.bond_id) & (k.deal_dt >= seg.seg_start) & (k.deal_dt <= seg.seg_end))
    b = {(r[0], r[1]): r.rtng_rank for r in j.select(k.bond_id, k.deal_dt, "rtng_rank").collect()}
    assert a == b and len(a) > 50


def test_spread_only_with_both_sides(spark):
    f = _feeds(spark, bond_repo_deal_f=[_deal("11002e1", "11", "30", "2.0", "100.00"),
                                        _deal("11002e2", "30", "11", "3.0", "50.00")])
    rows = {r.ins_show_name: r for r in RR.ctgry_price_deal_info(f).collect()}
    r = rows["银行"]
    # both members have both sides: d(11) = 3 - 2, d(30) = 2 - 3, equal totals -> 0
    assert r.price_difference == 0.0
    assert r.repo_max_deal_repo_rate == Decimal("3.000000") and r.rvrse_min_deal_repo_rate == Decimal("2.000000")


def test_distinct_projection_counts_equal_lines_once(spark):
    line = {"bond_deal_id": "c1", "buy_ip_id": "11", "sell_ip_id": "30", "deal_nmbr": "n1", "deal_dt": D,
            "st": "1", "bond_id": "b1", "crncy": "CNY", "trade_amnt": Decimal("1"),
            "dirty_amnt": Decimal("10.00"), "face_value": Decimal("10"), "yrs_to_mrty": Decimal("2")}
    f = _feeds(spark, bond_deal=[line, dict(line, bond_deal_id="c2")])
    assert [r.full_price for r in CR.ctgry_deal_strategy_info(f).collect()] == [Decimal("10.00")]
    assert {r.full_price for r in CR.union_info_for_bond_concentration(f).collect()} == {Decimal("20.00")}


def test_unresolved_member_category(spark):
    extra = _member("40")
    extra["member_ctgry_id"] = "Z"
    f = _feeds(spark, member_d=[_member(i) for i in ("11", "30")] + [extra])
    assert {r.ip_id for r in B.dim_member(f).collect()} == {"11", "30"}
    cash = {r.ip_id: r.ins_show_name for r in B.dim_member_cash(f).collect()}
    assert cash == {"11": "银行", "30": "银行", "40": "None"}


def test_root_segments_by_brute_force(spark):
    r = random.Random(11)
    first, last = dt.date(1, 1, 1), dt.date(9999, 12, 31)
    day = lambda: r.choice([None, *[D + dt.timedelta(days=i) for i in range(12)]])
    types = [(r.choice("112"), f"T{i % 3}", day(), day()) for i in range(7)]
    orgs = [(f"T{r.randrange(4)}", f"m{r.randrange(5)}", f"r{r.randrange(4)}", r.choice("CCD"), day(), day()) for _ in range(40)]
    segs = B.root_segments(
        spark.createDataFrame(types, "rl_kind string, rl_tp_id string, valid_from date, valid_to date"),
        spark.createDataFrame(orgs, "rl_tp_id string, slv_unq_id string, mstr_unq_id string, rl_status string, valid_from date, valid_to date"))
    days = [(f"m{m}", D + dt.timedelta(days=i)) for m in range(6) for i in range(-3, 15)]
    got = {(x.member, x.deal_dt): x.root for x in B.with_root_as_of(
        spark.createDataFrame(days, "member string, deal_dt date"), segs).collect()}
    assert len(got) == len(days)
    for m, d in days:
        hits = []
        for tp, slave, master, status, a, b in orgs:
            for kind, t, c, e in types:
                if slave == m and status == "C" and kind == "1" and tp == t:
                    span = (max(a or first, c or first), min(b or last, e or last))
                    if (a or first) <= (b or last) and (c or first) <= (e or last) and span[0] <= d <= span[1]:
                        hits.append((span[0], -(span[1] - first).days, master))
        assert got[m, d] == (max(hits)[2] if hits else m)
    rows = sorted(segs.collect())
    assert all(x.seg_start <= x.seg_end for x in rows)
    assert all(y.seg_start > x.seg_end for x, y in zip(rows, rows[1:]) if x.unq_id == y.unq_id)


def test_roots_of_the_feeds_by_day(spark):
    ended = _rel("30", "20") | {"valid_to": "2019-12-31 00:00:00"}
    segs = B.dim_root_segments(_feeds(spark, cim_org_rl=[_rel("11", "10"), ended]))
    assert {(r.unq_id, r.root_unq_id, r.seg_end) for r in segs.collect()} == {("11", "10", OPEN), ("30", "20", dt.date(2019, 12, 31))}
