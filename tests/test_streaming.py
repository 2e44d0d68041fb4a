"""Incremental run: CSV drops processed by the stream, also by separate
applications, equal a batch run over all of them."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

from test_operators import _feeds

from bondmart.plans import cash_reports as CR
from bondmart.streaming import daily

REPORTS = ["root_deal_amount_trans_info", "base_investment_returns"]


def _line(i, buy, sell, day, price):
    return f"c{i},{buy},{sell},n{i},{day},1,b1,CNY,1,{price},100,2,x,y,z"


def _drop(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write("\n".join(rows) + "\n")


def test_incremental_equals_batch(spark, tmpdir_path):
    landing, store, out = (os.path.join(tmpdir_path, x) for x in ("landing", "store", "out"))
    static = _feeds(spark)
    first = [_line(1, "11", "30", "2020-01-01", "10.00"), _line(2, "20", "30", "2020-01-02", "5.00")]
    _drop(landing, "d1.csv", first)
    q = daily.start(spark, landing, static, out, store, REPORTS, name="t1")
    q.awaitTermination()
    second = [_line(3, "30", "11", "2020-01-02", "7.00")]
    _drop(landing, "d2.csv", second)
    q = daily.start(spark, landing, static, out, store, REPORTS, name="t1")
    q.awaitTermination()

    from bondmart.sources import csvfeeds

    lines = spark.createDataFrame([(x,) for x in first + second], "value string")
    batch = _feeds(spark, bond_deal=csvfeeds.parse_lines(lines, "bond_deal"))
    for name in REPORTS:
        want = CR.REPORTS[name](batch)
        got = spark.read.parquet(os.path.join(out, name)).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name
    r = {(x.member_id, x.deal_dt): x.full_price
         for x in spark.read.parquet(os.path.join(out, "root_deal_amount_trans_info")).collect()
         if x.participant_type == "全部"}
    assert r[("30", dt.date(2020, 1, 2))] == Decimal("12.00")


NIGHT = """
import os, sys
sys.path[:0] = [{root!r}, {tests!r}]
from pyspark.sql import SparkSession
from test_operators import _feeds
from bondmart.streaming import daily
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {ckpt!r}).getOrCreate()
daily.start(s, {landing!r}, _feeds(s), {out!r}, {state!r}, {reports!r}).awaitTermination()
s.stop()
"""


def test_nights_of_separate_applications(spark, tmpdir_path):
    import subprocess
    import sys

    from bondmart.sources import csvfeeds

    here = os.path.dirname(os.path.abspath(__file__))
    state, out = os.path.join(tmpdir_path, "state"), os.path.join(tmpdir_path, "out")
    drops = [[_line(1, "11", "30", "2020-01-01", "10.00"), _line(2, "20", "30", "2020-01-02", "5.00")],
             [_line(3, "30", "11", "2020-01-02", "7.00")], [_line(4, "11", "20", "2020-01-02", "4.00")]]
    for night, rows in enumerate(drops):
        # the second night finds the first drop archived, the third a new folder
        landing = os.path.join(tmpdir_path, "landing" if night < 2 else "landing3")
        if night == 1:
            os.rename(os.path.join(landing, "d0.csv"), os.path.join(tmpdir_path, "archived.csv"))
        _drop(landing, f"d{night}.csv", rows)
        code = NIGHT.format(root=os.path.dirname(here), tests=here, ckpt=os.path.join(tmpdir_path, f"ckpt{night}"),
                            landing=landing, out=out, state=state, reports=REPORTS)
        subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    lines = spark.createDataFrame([(x,) for rows in drops for x in rows], "value string")
    batch = _feeds(spark, bond_deal=csvfeeds.parse_lines(lines, "bond_deal"))
    for name in REPORTS:
        want = CR.REPORTS[name](batch)
        got = spark.read.parquet(os.path.join(out, name)).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name
