"""CSV ingest (S1-S3) and sinks (K1, K2)."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from bondmart.sources import csvfeeds
from bondmart.sources.sinks import merge_column_groups, upsert, write_report


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as fh:
        fh.write(text)


def test_strict_arity_required_and_types(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "pd.csv")
    _write(p, "PD_ID,PD_CD\n1,UPDATE\n2,R001\n3\n4,R007,extra\n5,\n\"6,x\",R014\n")
    got = csvfeeds.read_feed(spark, "pd_d", p)
    rows = sorted(tuple(r) for r in got.collect())
    # the data row holding the header token (UPDATE contains PD) is kept
    assert rows == [("1", "UPDATE"), ("2", "R001"), ("6,x", "R014")]
    legacy = csvfeeds.read_feed(spark, "pd_d", p, drop_containing="PD")
    assert sorted(r[0] for r in legacy.collect()) == ["2", "6,x"]


def test_typed_columns_and_rejects(spark):
    lines = spark.createDataFrame([
        ("e1,r,v,P1,n1,1,2018-01-02,3.5,100.25,109,y",),
        ("e2,r,v,P1,n2,1,2018-02-30,3.5,100.25,109,y",),   # invalid day
        ("e3,r,v,P1,n3,1,2018-01-02,abc,100.25,109,y",),   # bad decimal
    ], "value string")
    good, bad = csvfeeds.parse_lines(lines, "bond_repo_deal_f", rejects=True)
    g = good.collect()
    assert len(g) == 1 and g[0].deal_dt == dt.date(2018, 1, 2)
    assert g[0].repo_rate == Decimal("3.500000") and g[0].trade_amnt == Decimal("100.25")
    assert bad.count() == 2


def test_gbk_file(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "ctgry.csv")
    _write(p, "银行（甲）,B01\n基金,F01\n", encoding="gbk")
    got = csvfeeds.read_feed(spark, "after_hours_bond_type", p, encoding="GBK")
    assert sorted(tuple(r) for r in got.collect()) == [("基金", "F01"), ("银行（甲）", "B01")]


def _report(spark, rows):
    return spark.createDataFrame(rows, "k string, deal_dt date, v int")


def _rows(spark, out):
    return sorted((r.k, r.v) for r in spark.read.parquet(out).collect())


def test_write_report_replaces_the_days_of_the_run(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "report")
    d1, d2, d3 = (dt.date(2020, 1, i) for i in (1, 2, 3))
    write_report(_report(spark, [("a", d1, 1), ("b", d2, 2), ("d", d3, 4)]), out)
    write_report(_report(spark, [("c", d2, 3)]), out, days=[d2])
    assert _rows(spark, out) == [("a", 1), ("c", 3), ("d", 4)]
    write_report(_report(spark, [("e", d1, 5)]), out, days=[d1, d2])  # d2 came out empty
    assert _rows(spark, out) == [("d", 4), ("e", 5)]
    write_report(_report(spark, []), out, days=[d1])
    assert _rows(spark, out) == [("d", 4)]
    write_report(_report(spark, [("f", d2, 6)]), out)  # a run over all days replaces the table
    assert _rows(spark, out) == [("f", 6)]


def test_upsert_into_a_stored_table(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "stored")
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    kinds = ["k string, deal_dt date, p int", "k string, deal_dt date, q int"]
    upsert(spark.createDataFrame([("a", d1, 1), ("b", d2, 2)], kinds[0]), out, ["k", "deal_dt"])
    upsert(spark.createDataFrame([("a", d1, 7), ("c", d1, 8)], kinds[1]), out, ["k", "deal_dt"])
    upsert(spark.createDataFrame([("a", d1, 9)], kinds[0]), out, ["k", "deal_dt"])
    got = {(r.k, r.deal_dt): (r.p, r.q) for r in spark.read.option("mergeSchema", True).parquet(out).collect()}
    assert got == {("a", d1): (9, 7), ("b", d2): (2, None), ("c", d1): (None, 8)}


def test_long_quoted_cells_and_unbalanced_quotes(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "pd.csv")
    long = 'x,""' * 50_000
    _write(p, f'1,"{long}"\n2,"a""b,c"\n3,"open,R1\n4,R"2\n')
    good, bad = csvfeeds.read_feed(spark, "pd_d", p, rejects=True)
    got = {r.pd_id: r.pd_cd for r in good.collect()}
    assert got["1"] == long.replace('""', '"') and got["2"] == 'a"b,c' and got["4"] == 'R"2'
    assert [r.value for r in bad.collect()] == ['3,"open,R1']


def test_header_only_in_some_parts(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "pd_d")
    os.makedirs(folder)
    _write(os.path.join(folder, "a.csv"), "pd_id,pd_cd\n1,R001\n2,R007\n")
    _write(os.path.join(folder, "b.csv"), "3,R014\n4,R021\n")
    assert {r.pd_id for r in csvfeeds.read_feed(spark, "pd_d", folder).collect()} == {"1", "2", "3", "4"}


def test_merge_column_groups_later_wins(spark):
    a = spark.createDataFrame([("k1", 1.0, 10), ("k2", 2.0, 20)], "k string, p double, amt int")
    b = spark.createDataFrame([("k1", 5.0), ("k3", 7.0)], "k string, q double")
    c = spark.createDataFrame([("k1", 9.0)], "k string, p double")
    got = {r.k: (r.p, r.amt, r.q) for r in merge_column_groups([a, b, c], ["k"]).collect()}
    assert got == {"k1": (9.0, 10, 5.0), "k2": (2.0, 20, None), "k3": (None, None, 7.0)}


def test_token_count_quotes(spark):
    df = spark.createDataFrame([('a,"b,c",d',), ('"x""y",z',), ("",)], "value string")
    assert [r[0] for r in df.select(csvfeeds.token_count(F.col("value"))).collect()] == [3, 2, 1]


def test_bad_bytes_are_rejected_with_their_offset(spark, tmpdir_path):
    import os
    os.makedirs(f"{tmpdir_path}/pd")
    with open(f"{tmpdir_path}/pd/a.csv", "wb") as f:
        f.write("P1,银行\n".encode("gbk") + b"P2,\xff\xfe\n" + "P3,价\nP4,x,y\n".encode("gbk") + "P5,价".encode("gbk")[:-1])
    good, bad = csvfeeds.read_feed(spark, "pd_d", f"{tmpdir_path}/pd", encoding="GBK", rejects=True)
    assert sorted(map(tuple, good.collect())) == [("P1", "银行"), ("P3", "价")]
    assert sorted(r.reason for r in bad.collect()) == ["arity", "byte 3", "byte 3"]
    assert "spark.sql.legacy.javaCharsets" not in dict(spark.conf.getAll) or spark.conf.get("spark.sql.legacy.javaCharsets") == "false"


def test_records_across_lines_and_splits(spark, tmpdir_path):
    import csv
    import io
    import os
    import random

    r, want = random.Random(5), []
    os.makedirs(f"{tmpdir_path}/x")
    for n in range(3):
        rows = [[f"k{n}_{i}", "".join(r.choice(['a', '"', ',', "\n", "\n\n", "\r\n", "é"]) for _ in range(r.randint(1, 30)))]
                for i in range(60)]
        text = io.StringIO(newline="")
        csv.writer(text, lineterminator="\n").writerows(rows)
        with open(f"{tmpdir_path}/x/{n}.csv", "w", newline="") as f:
            f.write(text.getvalue())
        want += [tuple(x) for x in rows]
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        records, open_ = csvfeeds.read_records(spark, f"{tmpdir_path}/x")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    got = [next(csv.reader(io.StringIO(x.value, newline=""))) for x in records.collect()]
    assert sorted(map(tuple, got)) == sorted(want) and open_.count() == 0
    with open(f"{tmpdir_path}/x/9.csv", "w") as f:
        f.write('a,b\nc,"d\n' + "e,f\n" * 20)
    records, open_ = csvfeeds.read_records(spark, f"{tmpdir_path}/x/9.csv", max_lines=5)
    assert [x.value for x in records.collect()] == ["a,b"] and open_.count() == 21
