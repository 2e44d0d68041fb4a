"""Operator-level queries: one registered query per SURVEY §2 operator id.

Each query applies one operator (ingest, scalar, filter, join, aggregate,
set operation, sink merge) to data derived from the driver tables, over
the whole tables, and has a DuckDB statement in ``OPERATOR_SQL`` (same CTE
prelude as the report oracle).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondmart import labels as L
from bondmart import oracle as O
from bondmart.functions import scalars as X
from bondmart.operators.joins import rating_as_of, small, with_rating
from bondmart.operators.rollup import (
    CASH_SIDES, REPO_SIDES, explode_join_types, sides_unpivot, with_category,
    with_join_type_cash, with_join_type_repo,
)
from bondmart.plans import base as B
from bondmart.plans import quality as Q
from bondmart.plans import repo_reports as RR
from bondmart.registry import feeds_for
from bondmart.session import checkpoint_dir, snapshot
from bondmart.sources import csvfeeds
from bondmart.sources.sinks import upsert, write_report

Query = Callable[[SparkSession, str], DataFrame]
RERUN_DAYS = 5  # days that sink_report writes a second time
OPERATOR_QUERIES: dict[str, Query] = {}
OPERATOR_SQL: dict[str, str] = {}


def op(name: str, sql: str):
    """Register a (Feeds | spark, sf_dir) function and its oracle body."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            if getattr(fn, "_raw", False):
                return fn(spark, sf_dir)
            return fn(feeds_for(spark, sf_dir))

        run.__name__ = name
        OPERATOR_QUERIES[name] = run
        body = sql.strip()
        prelude = O.FEEDS + "," + O.BASE + "," + O.REPO_SIDES_SQL
        OPERATOR_SQL[name] = (f"WITH {prelude},\n{body[5:]}" if body.upper().startswith("WITH ")
                              else f"WITH {prelude}\n{body}")
        return fn

    return deco


def raw(fn):
    fn._raw = True
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ----------------------------------------------------------------- S1-S3
# member feed rendered to CSV lines from the whole customer table, with
# broken rows: key % 13 = 0 an extra field, % 17 = 0 an empty full name,
# % 19 = 0 an invalid date; % 7 = 0 a quoted name holding a comma, and
# % 11 = 0 a name holding the word MEMBER (the header token), % 23 = 0 a
# Chinese name. The lines are written to files and read as feeds.
HEADER = ("IP_ID,MEMBER_CTGRY_ID,MEMBER_CD,FULL_NM,RT_MEMBER_CD,RT_MEMBER_FULL_NM,"
          "EFCTV_FROM_DT,EFCTV_TO_DT,UNQ_ID_IN_SRC_SYS,NOTE")


def _member_lines(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    ks = k.cast("string")
    name = F.when(k % 11 == 0, F.concat(F.col("c_name"), F.lit(" MEMBER"))).otherwise(F.col("c_name"))
    name = F.when(k % 23 == 0, F.concat(name, F.lit("银行"))).otherwise(name)
    name = F.when(k % 7 == 0, F.concat(F.lit('"'), name, F.lit(', Ltd"'))).otherwise(name)
    name = F.when(k % 17 == 0, F.lit("")).otherwise(name)
    from_dt = F.when(k % 19 == 0, F.lit("1998-02-30")).otherwise(F.lit("1990-01-01"))
    line = F.concat_ws(",", ks, F.substring("c_mktsegment", 1, 3), F.concat(F.lit("M"), ks), name,
                       F.concat(F.lit("M"), (k - k % 10).cast("string")), F.lit("root"), from_dt,
                       F.lit("9999-12-31"), ks, F.lit("x"))
    line = F.when(k % 13 == 0, F.concat(line, F.lit(",extra"))).otherwise(line)
    return customer.select(line.alias("value"))


MEMBER_CSV_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS ip_id, substr(c_mktsegment, 1, 3) AS member_ctgry_id,
    'M' || CAST(c_custkey AS VARCHAR) AS member_cd,
    CASE WHEN c_custkey % 11 = 0 THEN c_name || ' MEMBER' ELSE c_name END
        || CASE WHEN c_custkey % 23 = 0 THEN '银行' ELSE '' END
        || CASE WHEN c_custkey % 7 = 0 THEN ', Ltd' ELSE '' END AS full_nm,
    'M' || CAST(c_custkey - c_custkey % 10 AS VARCHAR) AS rt_member_cd, 'root' AS rt_member_full_nm,
    DATE '1990-01-01' AS efctv_from_dt, DATE '9999-12-31' AS efctv_to_dt,
    CAST(c_custkey AS VARCHAR) AS unq_id, 'x' AS c9
FROM customer WHERE c_custkey % 13 <> 0 AND c_custkey % 17 <> 0 AND c_custkey % 19 <> 0"""


def _files(spark, lines: DataFrame, encoding: str | None = None) -> str:
    """Lines written as text files under the shared folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/ingest/{uuid.uuid4().hex}"
    (lines if encoding is None else csvfeeds.encoded(lines, encoding)).write.text(path)
    return path


@op("ingest_csv_strict", MEMBER_CSV_SQL)
@raw
def ingest_csv_strict(spark, sf_dir):
    """Exact arity, required cells, strict types."""
    return csvfeeds.read_feed(spark, "member_d", _files(spark, _member_lines(_table(spark, sf_dir, "customer"))))


@op("ingest_header_drop", MEMBER_CSV_SQL)
@raw
def ingest_header_drop(spark, sf_dir):
    """The header line is dropped by equality, in whichever file it is,
    so data rows holding the header token (MEMBER) and first lines of files
    without a header survive."""
    lines = _member_lines(_table(spark, sf_dir, "customer")).repartition(3)
    lines = spark.range(1).select(F.lit(HEADER).alias("value")).unionByName(lines)
    return csvfeeds.read_feed(spark, "member_d", _files(spark, lines), header=HEADER)


@op("ingest_gbk", MEMBER_CSV_SQL)
@raw
def ingest_gbk(spark, sf_dir):
    """S3: files in GBK, decoded by the reader."""
    lines = _member_lines(_table(spark, sf_dir, "customer"))
    return csvfeeds.read_feed(spark, "member_d", _files(spark, lines, "GBK"), encoding="GBK")


SPLIT_BYTES = 4096  # splits of ingest_quoted_breaks, so that every size cuts files in mid-quote


@op("ingest_quoted_breaks", MEMBER_CSV_SQL.replace("', Ltd'", "chr(10) || 'a \"b\", ' || chr(10) || chr(10) || 'Ltd'"))
@raw
def ingest_quoted_breaks(spark, sf_dir):
    """A quoted name holds three line breaks, doubled quotes and a comma;
    the files are cut into splits of 4 KB, in mid-quote too."""
    lines = _member_lines(_table(spark, sf_dir, "customer"))
    broken = F.regexp_replace("value", ', Ltd"', '\na ""b"", \n\nLtd"')
    path = _files(spark, lines.select(broken.alias("value")).coalesce(3))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
    try:  # the lines are read and stored here
        records, _ = csvfeeds.read_records(spark, path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    return csvfeeds.parse_lines(records, "member_d")


def _damaged_gbk(spark, sf_dir):
    """The member lines in GBK; key % 31 = 0 has a byte after the first comma
    that begins no character."""
    good = _member_lines(_table(spark, sf_dir, "customer"))
    raw = csvfeeds.encoded(good, "GBK").select(F.col("value").cast("binary").alias("b"))
    comma = F.position(F.lit(b","), F.col("b"))
    key = F.substring("b", 1, comma - 1).cast("string").cast("long")
    hurt = F.concat(F.substring("b", 1, comma), F.lit(b"\xff"), F.substring("b", comma + 1, F.octet_length("b")))
    path = f"{checkpoint_dir(spark).rstrip('/')}/ingest/{uuid.uuid4().hex}"
    raw.select(F.when(key % 31 == 0, hurt).otherwise(F.col("b")).cast("string").alias("value")).write.text(path)
    return path


@op("ingest_gbk_strict", MEMBER_CSV_SQL + " AND c_custkey % 31 <> 0")
@raw
def ingest_gbk_strict(spark, sf_dir):
    """S3: of GBK files with bad bytes, the rows without any."""
    return csvfeeds.read_feed(spark, "member_d", _damaged_gbk(spark, sf_dir), encoding="GBK")


@op("ingest_gbk_rejects", """SELECT CAST(c_custkey AS VARCHAR) AS ip_id,
    'byte ' || (length(CAST(c_custkey AS VARCHAR)) + 1) AS reason FROM customer WHERE c_custkey % 31 = 0""")
@raw
def ingest_gbk_rejects(spark, sf_dir):
    """S3: lines rejected for their bytes, with the offset of the first bad one."""
    _, bad = csvfeeds.read_feed(spark, "member_d", _damaged_gbk(spark, sf_dir), encoding="GBK", rejects=True)
    return bad.where(F.col("reason").startswith("byte")).select(F.substring_index("value", ",", 1).alias("ip_id"), "reason")


# ----------------------------------------------------------------- K1, K2, P1, P2
@op("sink_report", O.Q["member_price_deal_info"])
@raw
def sink_report(spark, sf_dir):
    """K1: the flagship table written through the report sink (parquet,
    partitioned by day) under the shared folder. The first write has wrong
    sums on some days and holds a day without rows, which a run over these days
    replaces and clears; then read back."""
    f = feeds_for(spark, sf_dir)
    full = snapshot(RR.member_price_deal_info(f), "member_price")
    path = f"{checkpoint_dir(spark).rstrip('/')}/sink-report/{uuid.uuid4().hex}"
    known = full.select("deal_dt").where("deal_dt is not null").distinct().orderBy("deal_dt")
    days = [r[0] for r in known.limit(RERUN_DAYS).collect()]
    again = F.coalesce(F.col("deal_dt").isin(days), F.lit(False)) if days else F.lit(False)
    amount = F.when(again, F.col("repo_sum_amount") + 1).otherwise(F.col("repo_sum_amount"))
    first = full.withColumn("repo_sum_amount", amount.cast(full.schema["repo_sum_amount"].dataType))
    if days:
        gone = days[0] - timedelta(days=1)
        first = first.unionByName(full.where(F.col("deal_dt") == days[0]).withColumn("deal_dt", F.lit(gone)))
    write_report(first, path)
    if days:
        write_report(full.where(again), path, days=[gone, *days])
    return spark.read.schema(full.schema).parquet(path).select(*full.columns)


@op("sink_upsert_merge", O.Q["member_price_deal_info"])
@raw
def sink_upsert_merge(spark, sf_dir):
    """K2: column groups of one table upserted into a stored table. The
    first load holds one side of the keys and wrong sums, which the later
    loads complete and correct."""
    f = feeds_for(spark, sf_dir)
    full = snapshot(RR.member_price_deal_info(f), "member_price")
    keys = ["unq_id_in_src_sys", "join_type", "pd_cd", "deal_dt"]
    repo = full.filter(F.col("repo_sum_amount").isNotNull()).select(
        *keys, "repo_weighted_price", "repo_sum_amount")
    rvrse = full.filter(F.col("rvrse_sum_amount").isNotNull()).select(
        *keys, "rvrse_weighted_price", "rvrse_sum_amount")
    both = full.filter(F.col("repo_sum_amount").isNotNull()).select(
        *repo.columns, "price_difference", "total_amount")
    path = f"{checkpoint_dir(spark).rstrip('/')}/sink-upsert/{uuid.uuid4().hex}"
    wrong = repo.withColumn("repo_sum_amount", (F.col("repo_sum_amount") + 1).cast(
        full.schema["repo_sum_amount"].dataType))
    for group in (wrong, rvrse, both):
        upsert(group, path, keys)
    return spark.read.option("mergeSchema", True).parquet(path).select(*full.columns)


@op("sides_unpivot", "SELECT side, member, counter, ev_id, trade_amnt FROM rs_deal")
def sides_unpivot_q(f):
    return sides_unpivot(B.fact_repo_deal(f), REPO_SIDES).select("side", "member", "counter", "ev_id",
                                                                   "trade_amnt")


@op("collateral_allocate", "SELECT ev_id, bond_id, cnvrsn_prprtn, alloc FROM c_coll")
def collateral_allocate(f):
    return B.fact_repo_collateral(f).select("ev_id", "bond_id", "cnvrsn_prprtn", "alloc")


# ----------------------------------------------------------------- F1-F12
def _paren_names(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    raw_ = (F.when(k % 5 == 0, F.concat(F.lit("("), F.col("c_name"), F.lit(")")))
            .when(k % 5 == 1, F.concat(F.col("c_name"), F.lit(" (a)")))
            .when(k % 5 == 2, F.concat(F.col("c_name"), F.lit("（b）")))
            .when(k % 5 == 3, F.concat(F.col("c_name"), F.lit("（c）(d)")))
            .otherwise(F.col("c_name")))
    return customer.select(k.alias("c_custkey"), raw_.alias("raw"))


PAREN_SQL = """(SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '(' || c_name || ')'
    WHEN 1 THEN c_name || ' (a)' WHEN 2 THEN c_name || '（b）' WHEN 3 THEN c_name || '（c）(d)'
    ELSE c_name END AS raw FROM customer)"""


@op("strip_paren_suffix", f"SELECT c_custkey, raw, {O.strip_paren('raw')} AS name FROM {PAREN_SQL} p")
@raw
def strip_paren_suffix(spark, sf_dir):
    p = _paren_names(_table(spark, sf_dir, "customer"))
    return p.select("c_custkey", "raw", X.strip_paren_suffix("raw").alias("name"))


@op("first_paren_prefix", f"""SELECT c_custkey, raw,
    CASE WHEN strpos(raw, '(') > 0 THEN split_part(raw, '(', 1)
        WHEN strpos(raw, '（') > 0 THEN split_part(raw, '（', 1) END AS name FROM {PAREN_SQL} p""")
@raw
def first_paren_prefix(spark, sf_dir):
    p = _paren_names(_table(spark, sf_dir, "customer"))
    return p.select("c_custkey", "raw", X.first_paren_prefix("raw").alias("name"))


@op("bond_category4", f"SELECT bond_id, bond_prnt_tp_nm, {O.CAT4} AS bond_ctgry_nm FROM f_bond")
def bond_category4(f):
    return f.bond_d.select("bond_id", "bond_prnt_tp_nm",
                           X.bond_category4("bond_prnt_tp_nm").alias("bond_ctgry_nm"))


@op("bond_category8", f"SELECT bond_id, bond_ctgry_nm, {O.BOND8} AS bond_type8 FROM f_bond")
def bond_category8(f):
    return f.bond_d.select("bond_id", "bond_ctgry_nm", X.bond_category8("bond_ctgry_nm").alias("bond_type8"))


@op("maturity_bucket", f"""SELECT yrs_to_mrty, {O.BUCKET} AS mrty_bucket, count(*) AS n
    FROM f_cash GROUP BY yrs_to_mrty""")
def maturity_bucket(f):
    return f.bond_deal.groupBy("yrs_to_mrty").agg(F.count(F.lit(1)).alias("n")).select(
        "yrs_to_mrty", X.maturity_bucket("yrs_to_mrty").alias("mrty_bucket"), "n")


@op("rating_normalize", f"""SELECT bond_id, rtng_start_dt, rtng_raw,
    {O.rank_label(O.RANK)} AS rtng_desc FROM f_rtng""")
def rating_normalize(f):
    return f.ri_credit_rtng.select("bond_id", "rtng_start_dt", "rtng_raw",
                                   X.rating_normalize("rtng_raw").alias("rtng_desc"))


@op("issuer_code", """SELECT p_partkey, raw,
    CASE WHEN raw IS NULL OR raw = '' THEN '' WHEN length(raw) >= 4 THEN substr(raw, 5) ELSE raw END AS issr_id
    FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 1 THEN substr(p_brand, 1, 3)
        WHEN 2 THEN '' ELSE NULL END AS raw FROM part) t""")
@raw
def issuer_code(spark, sf_dir):
    p = _table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    raw_ = (F.when(k % 4 == 0, F.col("p_brand")).when(k % 4 == 1, F.substring("p_brand", 1, 3))
            .when(k % 4 == 2, F.lit("")).otherwise(F.lit(None).cast("string")))
    return p.select("p_partkey", raw_.alias("raw")).select("p_partkey", "raw", X.issuer_code("raw").alias("issr_id"))


@op("event_id_build", """SELECT '11002' || deal_suffix AS ev_id FROM f_rmv
    WHERE rmv_kind = '2' AND rmv_reason = '1' AND mkt_id = '109'""")
def event_id_build(f):
    return B.failed_repo_events(f)


@op("deal_strategy", """SELECT CAST(o_orderkey AS VARCHAR) AS deal_nmbr, m.match_status,
    CASE WHEN m.match_status IS NULL OR m.match_status = '' OR m.match_status IN ('0', '4') THEN '正常'
        ELSE '策略性交易' END AS deal_strategy
    FROM orders o LEFT JOIN f_match m ON CAST(o.o_orderkey AS VARCHAR) = m.deal_nmbr""")
@raw
def deal_strategy(spark, sf_dir):
    f = feeds_for(spark, sf_dir)
    o = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("deal_nmbr"))
    s = o.join(f.dps_v_cbt_all_txn_dtl, "deal_nmbr", "left")
    return s.select("deal_nmbr", "match_status", X.deal_strategy("match_status").alias("deal_strategy"))


@op("set_to_string", f"""SELECT member, deal_dt, {O.sset('counter', ',')} AS counter_set, count(DISTINCT counter) AS n
    FROM rs_deal GROUP BY member, deal_dt""")
def set_to_string(f):
    d = sides_unpivot(B.fact_repo_deal(f), REPO_SIDES)
    return d.groupBy("member", "deal_dt").agg(
        X.set_to_string(F.collect_set("counter"), L.REPO_SET_SEP).alias("counter_set"),
        F.count_distinct("counter").alias("n"))


@op("trim_currency", "SELECT crncy AS raw, trim(crncy) AS crncy, count(*) AS n FROM f_cash GROUP BY crncy")
def trim_currency(f):
    return f.bond_deal.groupBy(F.col("crncy").alias("raw")).agg(F.count(F.lit(1)).alias("n")).select(
        "raw", X.trim_currency("raw").alias("crncy"), "n")


@op("parse_date", """SELECT o_orderkey, s, TRY_CAST(substr(s, 1, 10) AS DATE) AS d FROM (
    SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN substr(strftime(o_orderdate, '%Y-%m-%d'), 1, 8) || '32'
        WHEN o_orderkey % 13 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00'
        ELSE strftime(o_orderdate, '%Y-%m-%d') END AS s FROM orders) t""")
@raw
def parse_date(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    s = F.date_format("o_orderdate", "yyyy-MM-dd")
    s = (F.when(k % 11 == 0, F.concat(F.substring(s, 1, 8), F.lit("32")))
         .when(k % 13 == 0, F.concat(s, F.lit(" 00:00:00"))).otherwise(s))
    return o.select("o_orderkey", s.alias("s")).select("o_orderkey", "s", X.parse_date("s").alias("d"))


@op("decimal_arith", """SELECT ev_id, CAST(repo_rate * trade_amnt AS DECIMAL(38,8)) AS weighted, trade_amnt
    FROM c_deal""")
def decimal_arith(f):
    d = B.fact_repo_deal(f)
    return d.select("ev_id", (F.col("repo_rate") * F.col("trade_amnt")).cast("decimal(38,8)").alias("weighted"),
                    "trade_amnt")


# ----------------------------------------------------------------- W1-W11
@op("current_version", "SELECT ip_id, member_ctgry_id, efctv_from_dt FROM f_member WHERE efctv_to_dt = DATE '9999-12-31'")
def current_version(f):
    return f.member_d.filter(F.col("efctv_to_dt") == F.lit(L.OPEN_END_DATE).cast("date")).select(
        "ip_id", "member_ctgry_id", "efctv_from_dt")


@op("pledged_market", "SELECT ev_id, deal_dt FROM f_repo WHERE mkt_id = '109'")
def pledged_market(f):
    return f.bond_repo_deal_f.filter(F.col("mkt_id") == L.PLEDGED_REPO_MKT_ID).select("ev_id", "deal_dt")


@op("drop_cancelled", "SELECT ev_id, st FROM f_repo WHERE st <> '2'")
def drop_cancelled(f):
    return f.bond_repo_deal_f.filter(F.col("st") != L.CANCELLED_STATUS).select("ev_id", "st")


@op("failed_settlement", "SELECT deal_suffix AS bond_deal_id FROM f_rmv WHERE rmv_kind = '2' AND rmv_reason = '1'")
def failed_settlement(f):
    return B.failed_cash_deals(f)


@op("valid_relation", "SELECT * FROM c_root")
def valid_relation(f):
    return B.dim_root(f)


@op("reported_products", "SELECT ev_id, pd_cd FROM c_priced")
def reported_products(f):
    return B.fact_repo_deal_priced(f).select("ev_id", "pd_cd")


@op("cny_only", "SELECT crncy, count(*) AS n FROM c_cash GROUP BY crncy")
def cny_only(f):
    return B.fact_cash_deal(f).groupBy("crncy").agg(F.count(F.lit(1)).alias("n"))


@op("rated_bonds_only", f"""SELECT ev_id, bond_id, bond_ctgry_nm, rtng_desc FROM (
    SELECT c.ev_id, c.bond_id, coalesce(b.bond_ctgry_nm, '其他') AS bond_ctgry_nm,
        {O.rank_label('coalesce(k.rtng_rank, 0)')} AS rtng_desc
    FROM c_coll c LEFT JOIN c_bond4 b ON c.bond_id = b.bond_id
        LEFT JOIN c_coll_rank k ON c.bond_id = k.bond_id AND c.deal_dt = k.deal_dt) t
    WHERE bond_ctgry_nm <> '利率债'""")
def rated_bonds_only(f):
    c = B.fact_repo_collateral(f).join(small(B.dim_bond4(f).select("bond_id", "bond_ctgry_nm")), "bond_id", "left")
    c = c.withColumn("bond_ctgry_nm", F.coalesce("bond_ctgry_nm", F.lit(L.BOND_OTHER)))
    c = with_rating(c, B.dim_rating_segments(f))
    return c.filter(F.col("bond_ctgry_nm") != L.RATE_BOND).select("ev_id", "bond_id", "bond_ctgry_nm", "rtng_desc")


@op("drop_unresolved", "SELECT ip_id, ins_show_name, bond_after_show_name FROM c_member")
def drop_unresolved(f):
    return B.dim_member(f).select("ip_id", "ins_show_name", "bond_after_show_name")


@op("interbank_flag", "SELECT deal_nmbr FROM f_dep WHERE dep_flag = '1'")
def interbank_flag(f):
    return B.interbank_deals(f)


@op("effective_dated_member", """SELECT bond_deal_id, buy_ip_id, sell_ip_id, deal_strategy, deal_nmbr, deal_dt,
    bond_type4, crncy, trade_amnt, dirty_amnt, face_value, yrs_to_mrty, bond_id, bond_type8, mrty_bucket FROM c_cash d
    WHERE EXISTS (SELECT 1 FROM f_member m WHERE m.ip_id = d.buy_ip_id
            AND d.deal_dt > m.efctv_from_dt AND d.deal_dt < m.efctv_to_dt)
        AND EXISTS (SELECT 1 FROM f_member m WHERE m.ip_id = d.sell_ip_id
            AND d.deal_dt > m.efctv_from_dt AND d.deal_dt < m.efctv_to_dt)""")
def effective_dated_member(f):
    return Q.effective_dated_cash_deals(f)


# ----------------------------------------------------------------- J1-J9
@op("lookup_inner", """SELECT d.ev_id, p.pd_cd FROM c_deal d
    JOIN (SELECT pd_id, max(pd_cd) AS pd_cd FROM f_pd_d GROUP BY pd_id) p ON d.pd_id = p.pd_id""")
def lookup_inner(f):
    return B.fact_repo_deal(f).join(small(B.dim_product(f)), "pd_id", "inner").select("ev_id", "pd_cd")


@op("lookup_left", "SELECT bond_deal_id, bond_id, bond_type4 FROM c_cash")
def lookup_left(f):
    return B.fact_cash_deal(f).select("bond_deal_id", "bond_id", "bond_type4")


@op("category_chain", "SELECT * FROM c_repo_ctgry")
def category_chain(f):
    return B.repo_category(f)


@op("root_of_member", """SELECT m.unq_id, coalesce(r.root_unq_id, m.unq_id) AS root
    FROM c_member m LEFT JOIN c_root r ON m.unq_id = r.unq_id""")
def root_of_member(f):
    m = B.dim_member(f).select("unq_id")
    return m.join(small(B.dim_root(f)), "unq_id", "left").select(
        "unq_id", F.coalesce("root_unq_id", "unq_id").alias("root"))


# relations with days, from the whole relation feeds: the type T1 is valid in three
# stretches (one open on each side), T2 in one of a wrong kind; an organisation's
# second and third master overlap the first, and one row ends before it starts
DATED_TYPES = [("1", "T1", None, "1994-06-30"), ("1", "T1", "1994-06-01", "1996-12-31"), ("1", "T1", "1997-07-01", None),
               ("2", "T2", None, None), ("1", "T3", "1998-01-01", "1997-01-01")]


def _dated_types_sql() -> str:
    day = lambda d: f"DATE '{d}'" if d else "NULL::DATE"
    return ", ".join(f"('{k}', '{t}', {day(a)}, {day(b)})" for k, t, a, b in DATED_TYPES)


ROOT_AS_OF_SQL = f"""
WITH ty AS (SELECT * FROM (VALUES {_dated_types_sql()}) t(rl_kind, rl_tp_id, vf, vt)),
org AS (
    SELECT rl_tp_id, slv_unq_id, mstr_unq_id, rl_status, NULL::DATE AS vf, DATE '1995-12-31' AS vt FROM f_orgrl
    UNION ALL
    SELECT rl_tp_id, slv_unq_id, substr(slv_unq_id, 1, 1) || '1', rl_status, DATE '1993-01-01', DATE '1993-09-30' FROM f_orgrl
    UNION ALL
    SELECT rl_tp_id, slv_unq_id, substr(slv_unq_id, 1, 1) || '2', rl_status, DATE '1995-07-01', NULL FROM f_orgrl
    UNION ALL
    SELECT 'T3', slv_unq_id, 'X', rl_status, NULL, NULL FROM f_orgrl),
rel AS (
    SELECT slv_unq_id, mstr_unq_id, greatest(coalesce(org.vf, DATE '0001-01-01'), coalesce(ty.vf, DATE '0001-01-01')) AS a,
        least(coalesce(org.vt, DATE '9999-12-31'), coalesce(ty.vt, DATE '9999-12-31')) AS b
    FROM org JOIN ty USING (rl_tp_id)
    WHERE rl_kind = '1' AND rl_status = 'C' AND coalesce(ty.vf, DATE '0001-01-01') <= coalesce(ty.vt, DATE '9999-12-31')),
days AS (SELECT DISTINCT member, deal_dt FROM cs),
hit AS (
    SELECT member, deal_dt, mstr_unq_id, row_number() OVER (
        PARTITION BY member, deal_dt ORDER BY a DESC, b, mstr_unq_id DESC) AS rn
    FROM days JOIN rel ON slv_unq_id = member AND deal_dt BETWEEN a AND b)
SELECT coalesce(h.mstr_unq_id, s.member) AS member_id, s.deal_dt, count(DISTINCT s.member) AS n_members,
    CAST(sum(dirty_amnt) AS DECIMAL(38,2)) AS full_price
FROM cs s LEFT JOIN (SELECT * FROM hit WHERE rn = 1) h ON h.member = s.member AND h.deal_dt = s.deal_dt
GROUP BY 1, 2"""


@op("root_as_of", ROOT_AS_OF_SQL)
def root_as_of(f):
    """J2 + W11: amounts by the root that a member had on the day of the deal."""
    rows = [F.struct(*[F.lit(v).cast(t).alias(n) for v, t, n in zip(
        r, ("string", "string", "date", "date"), ("rl_kind", "rl_tp_id", "valid_from", "valid_to"))]) for r in DATED_TYPES]
    types = f.pd_d.sparkSession.range(1).select(F.inline(F.array(*rows)))
    own, pre = f.cim_org_rl, F.substring("slv_unq_id", 1, 1)

    def dated(master, start, end, kind=F.col("rl_tp_id")):
        return own.select(kind.alias("rl_tp_id"), "slv_unq_id", master.alias("mstr_unq_id"), "rl_status",
                          F.lit(start).cast("date").alias("valid_from"), F.lit(end).cast("date").alias("valid_to"))

    orgs = dated(F.col("mstr_unq_id"), None, "1995-12-31").unionByName(
        dated(F.concat(pre, F.lit("1")), "1993-01-01", "1993-09-30")).unionByName(
        dated(F.concat(pre, F.lit("2")), "1995-07-01", None)).unionByName(dated(F.lit("X"), None, None, F.lit("T3")))
    # by member and day first; the members' ids and unq ids are the same in this mapping
    d = sides_unpivot(B.fact_cash_deal(f), CASH_SIDES).groupBy("member", "deal_dt").agg(F.sum("dirty_amnt").alias("amount"))
    d = B.with_root_as_of(d, snapshot(B.root_segments(types, orgs), "root_segments"))
    return d.groupBy(F.col("root").alias("member_id"), "deal_dt").agg(
        F.count(F.lit(1)).alias("n_members"), F.sum("amount").cast("decimal(38,2)").alias("full_price"))


@op("root_id_resolve", """SELECT m.ip_id, CASE WHEN r.root_unq_id IS NULL THEN m.ip_id
        ELSE coalesce(b.ip_id, m.ip_id) END AS root,
    CASE WHEN r.root_unq_id IS NULL THEN '机构' ELSE '产品' END AS join_type
    FROM c_member_cash m LEFT JOIN c_root r ON m.unq_id = r.unq_id
        LEFT JOIN (SELECT unq_id, max(ip_id) AS ip_id FROM c_member_cash GROUP BY unq_id) b
            ON r.root_unq_id = b.unq_id""")
def root_id_resolve(f):
    m = B.dim_member_cash(f).select(F.col("ip_id"), F.col("ip_id").alias("member"))
    return with_join_type_cash(m, B.dim_root(f), B.dim_member_cash(f)).select("ip_id", "root", "join_type")


@op("failed_deal_anti", "SELECT ev_id FROM c_deal")
def failed_deal_anti(f):
    return B.fact_repo_deal(f).select("ev_id")


@op("interbank_semi", """SELECT ev_id, pd_cd, deal_dt FROM c_priced
    WHERE deal_nmbr IN (SELECT deal_nmbr FROM f_dep WHERE dep_flag = '1')""")
def interbank_semi(f):
    return B.fact_repo_deal_priced(f).join(B.interbank_deals(f), "deal_nmbr", "left_semi").select(
        "ev_id", "pd_cd", "deal_dt")


@op("deal_collateral_join", "SELECT ev_id, bond_id, cnvrsn_prprtn FROM c_coll")
def deal_collateral_join(f):
    return B.fact_repo_collateral(f).select("ev_id", "bond_id", "cnvrsn_prprtn")


@op("rating_as_of", "SELECT bond_id, deal_dt, rtng_rank FROM c_coll_rank")
def rating_as_of_q(f):
    keys = B.fact_repo_collateral(f).select("bond_id", "deal_dt").distinct()
    return rating_as_of(keys, B.dim_rating(f))


SPREAD_SQL = """
WITH mg AS (SELECT member, pd_cd, deal_dt,
        sum(CASE WHEN side = 'REPO' THEN repo_rate * trade_amnt END) AS rn,
        sum(CASE WHEN side = 'REPO' THEN trade_amnt END) AS ra,
        sum(CASE WHEN side = 'RVRSE' THEN repo_rate * trade_amnt END) AS vn,
        sum(CASE WHEN side = 'RVRSE' THEN trade_amnt END) AS va
    FROM rs_priced GROUP BY member, pd_cd, deal_dt)
SELECT member AS unq_id_in_src_sys, pd_cd, deal_dt,
    round(CAST(vn AS DOUBLE) / CAST(va AS DOUBLE) - CAST(rn AS DOUBLE) / CAST(ra AS DOUBLE), 6) AS price_difference,
    CAST(ra + va AS DECIMAL(38,2)) AS total_amount
FROM mg WHERE ra IS NOT NULL AND va IS NOT NULL"""


@op("spread_inner_join", SPREAD_SQL)
def spread_inner_join(f):
    """J7 in join form: repo-side and reverse-side member prices, inner join."""
    d = B.fact_repo_deal_priced(f)
    keys = ["member", "pd_cd", "deal_dt"]
    ra = d.groupBy(F.col("repo_unq_id").alias("member"), "pd_cd", "deal_dt").agg(
        F.sum(F.col("repo_rate") * F.col("trade_amnt")).alias("rn"), F.sum("trade_amnt").alias("ra"))
    va = d.groupBy(F.col("rvrse_unq_id").alias("member"), "pd_cd", "deal_dt").agg(
        F.sum(F.col("repo_rate") * F.col("trade_amnt")).alias("vn"), F.sum("trade_amnt").alias("va"))
    j = ra.join(va, keys, "inner")
    return j.select(
        F.col("member").alias("unq_id_in_src_sys"), "pd_cd", "deal_dt",
        F.round(RR._spread("rn", "ra", "vn", "va"), 6).alias("price_difference"),
        (F.col("ra") + F.col("va")).cast("decimal(38,2)").alias("total_amount"))


@op("buy_sell_full_outer", O.Q["base_investment_returns"])
def buy_sell_full_outer(f):
    """J8 in join form: buyer and seller aggregates, full outer join, 0 for
    a missing side (equals the unpivot form of base_investment_returns)."""
    d = B.fact_cash_deal(f)
    keys = ["member_id", "bond_id", "deal_dt", "bond_type_e"]
    buy = d.groupBy(F.col("buy_ip_id").alias("member_id"), "bond_id", "deal_dt",
                    F.col("bond_type8").alias("bond_type_e")).agg(
        F.sum("dirty_amnt").alias("bf"), F.sum("face_value").alias("bc"))
    sell = d.groupBy(F.col("sell_ip_id").alias("member_id"), "bond_id", "deal_dt",
                     F.col("bond_type8").alias("bond_type_e")).agg(
        F.sum("dirty_amnt").alias("sf"), F.sum("face_value").alias("sc"))
    j = buy.join(sell, keys, "full_outer")
    z = [F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,2)") for c in ("bf", "sf", "bc", "sc")]
    return j.select(*keys, z[0].alias("buy_full_price"), z[1].alias("sell_full_price"),
                    z[2].alias("buy_face_price"), z[3].alias("sell_face_price"))


@op("valid_members_semi", "SELECT bond_deal_id, buy_ip_id, sell_ip_id FROM c_cash")
def valid_members_semi(f):
    return B.fact_cash_deal(f).select("bond_deal_id", "buy_ip_id", "sell_ip_id")


# ----------------------------------------------------------------- A1-A12
@op("weighted_price", f"""SELECT pd_cd, deal_dt, {O.r6('sum(repo_rate * trade_amnt)', 'sum(trade_amnt)')} AS weighted_price
    FROM c_priced GROUP BY pd_cd, deal_dt""")
def weighted_price(f):
    d = B.fact_repo_deal_priced(f)
    g = d.groupBy("pd_cd", "deal_dt").agg(F.sum(F.col("repo_rate") * F.col("trade_amnt")).alias("n"),
                                         F.sum("trade_amnt").alias("a"))
    return g.select("pd_cd", "deal_dt", X.ratio6("n", "a").alias("weighted_price"))


@op("sum_amount", "SELECT pd_id, deal_dt, CAST(sum(trade_amnt) AS DECIMAL(38,2)) AS sum_amount FROM c_deal GROUP BY pd_id, deal_dt")
def sum_amount(f):
    return B.fact_repo_deal(f).groupBy("pd_id", "deal_dt").agg(X.sum_amount("trade_amnt").alias("sum_amount"))


@op("min_max_rate", "SELECT pd_id, deal_dt, max(repo_rate) AS max_rate, min(repo_rate) AS min_rate FROM c_deal GROUP BY pd_id, deal_dt")
def min_max_rate(f):
    return B.fact_repo_deal(f).groupBy("pd_id", "deal_dt").agg(
        F.max("repo_rate").alias("max_rate"), F.min("repo_rate").alias("min_rate"))


@op("collect_distinct_set", f"""SELECT bond_id, deal_dt, {O.sset('member', '#')} AS member_set,
    count(DISTINCT member) AS n FROM cs GROUP BY bond_id, deal_dt""")
def collect_distinct_set(f):
    d = sides_unpivot(B.fact_cash_deal(f), CASH_SIDES)
    return d.groupBy("bond_id", "deal_dt").agg(
        X.set_to_string(F.collect_set("member"), L.CASH_SET_SEP).alias("member_set"),
        F.count_distinct("member").alias("n"))


@op("weighted_spread", """SELECT ins_show_name, pd_cd, deal_dt, price_difference FROM ("""
    + O.Q["ctgry_price_deal_info"].strip() + ") t WHERE price_difference IS NOT NULL")
def weighted_spread(f):
    return RR.ctgry_price_deal_info(f).filter(F.col("price_difference").isNotNull()).select(
        "ins_show_name", "pd_cd", "deal_dt", "price_difference")


@op("haircut_weighted", f"""SELECT bond_ctgry_nm, deal_dt,
    {O.r6('sum(cnvrsn_prprtn * alloc)', 'sum(alloc)')} AS weighted_cnvrsn_prprtn
    FROM (SELECT c.*, coalesce(b.bond_ctgry_nm, '其他') AS bond_ctgry_nm FROM c_coll c
        LEFT JOIN c_bond4 b ON c.bond_id = b.bond_id) t GROUP BY bond_ctgry_nm, deal_dt""")
def haircut_weighted(f):
    c = B.fact_repo_collateral(f).join(small(B.dim_bond4(f).select("bond_id", "bond_ctgry_nm")), "bond_id", "left")
    c = c.withColumn("bond_ctgry_nm", F.coalesce("bond_ctgry_nm", F.lit(L.BOND_OTHER)))
    g = c.groupBy("bond_ctgry_nm", "deal_dt").agg(
        F.sum(F.col("cnvrsn_prprtn") * F.col("alloc")).alias("n"), F.sum("alloc").alias("a"))
    return g.select("bond_ctgry_nm", "deal_dt", X.ratio6("n", "a").alias("weighted_cnvrsn_prprtn"))


@op("collateral_ratio", """SELECT c.ev_id, c.bond_id, c.cnvrsn_prprtn, c.face_value,
    CAST(t.sum_face AS DECIMAL(38,2)) AS sum_face,
    round(CASE WHEN t.sum_face < 0.000000001 THEN CAST(c.face_value AS DOUBLE)
        ELSE CAST(c.face_value AS DOUBLE) / CAST(t.sum_face AS DOUBLE) END, 9) AS ratio
    FROM c_cl c JOIN c_cltot t ON c.ev_id = t.ev_id""")
def collateral_ratio(f):
    rows, tot = B.collateral_ratio(f)
    x = rows.join(tot, "ev_id", "inner")
    face = F.col("face_value").cast("double")
    ratio = F.when(F.col("sum_face") < F.lit(L.ZERO_FACE_EPS).cast("decimal(18,9)"), face).otherwise(
        face / F.col("sum_face").cast("double"))
    return x.select("ev_id", "bond_id", "cnvrsn_prprtn", "face_value",
                    F.col("sum_face").cast("decimal(38,2)").alias("sum_face"), F.round(ratio, 9).alias("ratio"))


@op("rating_worst_per_interval", "SELECT bond_id, rtng_start_dt, rtng_end_dt, rtng_rank FROM c_rating")
def rating_worst_per_interval(f):
    return B.dim_rating(f).select("bond_id", "rtng_start_dt", "rtng_end_dt", "rtng_rank")


@op("root_rollup", f"""SELECT root, {O.JT} AS join_type, deal_dt,
    CAST(sum(trade_amnt) AS DECIMAL(38,2)) AS sum_amount
    FROM {O._repo_rolled('rs_deal')} x {O._gs(['root', 'deal_dt'])}""")
def root_rollup(f):
    d = sides_unpivot(B.fact_repo_deal(f), REPO_SIDES)
    d = explode_join_types(with_join_type_repo(d, B.dim_root(f), B.member_info(f)))
    return d.groupBy("root", "join_type", "deal_dt").agg(X.sum_amount("trade_amnt").alias("sum_amount"))


@op("root_rollup_cash", f"""SELECT root, {O.JT} AS join_type, deal_dt,
    CAST(sum(dirty_amnt) AS DECIMAL(38,2)) AS full_price
    FROM {O.CASH_ROLLED} x {O._gs(['root', 'deal_dt'])}""")
def root_rollup_cash(f):
    d = sides_unpivot(B.fact_cash_deal(f), CASH_SIDES)
    d = explode_join_types(with_join_type_cash(d, B.dim_root(f), B.dim_member_cash(f)))
    return d.groupBy("root", "join_type", "deal_dt").agg(X.sum_amount("dirty_amnt").alias("full_price"))


@op("category_rollup", """SELECT i.ins_show_name, s.deal_dt, CAST(sum(s.trade_amnt) AS DECIMAL(38,2)) AS sum_amount
    FROM rs_deal s JOIN c_minfo i ON s.member = i.unq_id GROUP BY i.ins_show_name, s.deal_dt""")
def category_rollup(f):
    d = with_category(sides_unpivot(B.fact_repo_deal(f), REPO_SIDES), B.member_info(f), "member", "ins_show_name")
    return d.groupBy("ins_show_name", "deal_dt").agg(X.sum_amount("trade_amnt").alias("sum_amount"))


@op("clean_count", """SELECT 'fact_repo_deal' AS "check", count(*) AS n FROM c_deal
    UNION ALL SELECT 'fact_cash_deal', count(*) FROM c_cash""")
def clean_count(f):
    return Q.clean_count(f)


DQ_SQL = """
SELECT 'category_without_display_name' AS "check", count(*) AS n FROM f_mcd
    WHERE ctgry_type_nm NOT IN (SELECT ctgry_type_nm FROM f_mct WHERE market = '质押式回购')
UNION ALL SELECT 'member_without_category', count(*) FROM f_member
    WHERE efctv_to_dt = DATE '9999-12-31' AND member_ctgry_id NOT IN (SELECT member_ctgry_id FROM c_repo_ctgry)
UNION ALL SELECT 'member_without_cash_category', count(*) FROM f_member
    WHERE efctv_to_dt = DATE '9999-12-31' AND member_ctgry_id NOT IN (SELECT member_ctgry_id FROM c_aht)
UNION ALL SELECT 'repo_deal_without_product', count(*) FROM c_deal
    WHERE pd_id NOT IN (SELECT pd_id FROM f_pd_d)
UNION ALL SELECT 'repo_deal_unknown_party', count(*) FROM f_repo d
    WHERE d.mkt_id = '109' AND d.st <> '2'
        AND d.ev_id NOT IN (SELECT '11002' || deal_suffix FROM f_rmv WHERE rmv_kind = '2' AND rmv_reason = '1' AND mkt_id = '109')
        AND (d.repo_ip_id NOT IN (SELECT ip_id FROM c_member) OR d.rvrse_ip_id NOT IN (SELECT ip_id FROM c_member))
UNION ALL SELECT 'cash_deal_without_bond_type4', count(*) FROM c_cash WHERE bond_type4 = 'empty'
UNION ALL SELECT 'cash_deal_without_bond_type8', count(*) FROM c_cash WHERE bond_type8 = 'empty'"""


@op("dq_unmatched", DQ_SQL)
def dq_unmatched(f):
    return Q.dq_unmatched(f)


# ----------------------------------------------------------------- U1, U2
@op("buy_sell_union", """SELECT member, deal_dt, CAST(sum(dirty_amnt) AS DECIMAL(38,2)) AS full_price
    FROM cs GROUP BY member, deal_dt""")
def buy_sell_union(f):
    """U1 in union form: buyer and seller aggregates unioned, re-reduced."""
    d = B.fact_cash_deal(f)
    buy = d.groupBy(F.col("buy_ip_id").alias("member"), "deal_dt").agg(F.sum("dirty_amnt").alias("p"))
    sell = d.groupBy(F.col("sell_ip_id").alias("member"), "deal_dt").agg(F.sum("dirty_amnt").alias("p"))
    return buy.unionByName(sell).groupBy("member", "deal_dt").agg(X.sum_amount("p").alias("full_price"))


@op("distinct_projection", f"""SELECT DISTINCT buy_cat, sell_cat, deal_nmbr, dirty_amnt, bond_type4, deal_dt,
    deal_strategy FROM {O.CATS} y""")
def distinct_projection(f):
    from bondmart.plans import cash_reports as CR
    return CR._deals_with_cats(f).select("buy_cat", "sell_cat", "deal_nmbr", "dirty_amnt", "bond_type4",
                                         "deal_dt", "deal_strategy").dropDuplicates()


@op("fact_repo_deal_all_markets", """SELECT d.ev_id, r.unq_id AS repo_unq_id, v.unq_id AS rvrse_unq_id, d.pd_id,
    d.deal_nmbr, d.st, d.deal_dt, d.repo_rate, d.trade_amnt
    FROM f_repo d JOIN c_member r ON d.repo_ip_id = r.ip_id JOIN c_member v ON d.rvrse_ip_id = v.ip_id
    WHERE d.st <> '2'""")
def fact_repo_deal_all_markets(f):
    """The repo fact with its market parameter open: deals of all markets,
    failed settlements included."""
    return B.fact_repo_deal(f, market=None, drop_failed=False)
