"""Driver parquet tables -> reference feeds (FIXTURES.md part B).

The reference ships no data; this mapping turns the TPC-H-like tables under
``sf_dir`` into the fifteen feeds so every report can run (and be checked
against the DuckDB oracle in ``oracle.py``, which restates the same mapping
in SQL). All tables are read whole: members are all customers (``C`` ids) and
all suppliers (``S`` ids), bonds are all parts, and every order and line is a
deal between its real parties on its real day. The parties of every second
deal are swapped, and every fifth order has a mirrored deal (parties swapped,
same product and day, an event id of its own), so members trade on both sides
of one key. Modulo rules only mark broken rows and feed variants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondmart import labels as L
from bondmart.operators.joins import BROADCAST_MAX_BYTES, estimated_bytes
from bondmart.sources.feeds import Feeds

TABLES = ("customer", "supplier", "part", "orders", "lineitem")

TASK_BYTES = 4 << 20  # of the lines' file (compressed) that one task turns into deals

# fixed values: the segments of the customer table, dealt to suppliers in turn
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c) -> F.Column:
    return c.cast("string")


def _deals(rows: DataFrame, order_key, customer, supplier) -> DataFrame:
    """rows with ``mirror`` (a second, mirrored deal for every fifth order),
    ``nmbr`` and the parties ``first_ip`` and ``second_ip``."""
    mirror = F.when(order_key % 5 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    buyer, seller = F.concat(F.lit("C"), _s(customer)), F.concat(F.lit("S"), _s(supplier))
    swap = (order_key % 2 == 1) != F.col("mirror")
    return rows.withColumn("mirror", F.explode(mirror)).withColumns({
        "nmbr": F.concat(F.when(F.col("mirror"), "M").otherwise(""), _s(order_key)),
        "first_ip": F.when(swap, seller).otherwise(buyer),
        "second_ip": F.when(swap, buyer).otherwise(seller)})


def _joined(rows: DataFrame, key: str, orders: DataFrame, order_key: str) -> DataFrame:
    """rows with their order. Orders too large to broadcast meet them in tasks of
    at most about TASK_BYTES of the rows' file: what a deal becomes later in the same task
    (a row a side and type, held by an aggregate) is many times as large as its row,
    so the tasks must not grow to what a shuffle alone would bear."""
    rows_bytes, order_bytes = estimated_bytes(rows), estimated_bytes(orders)
    if rows_bytes is not None and order_bytes is not None and order_bytes > BROADCAST_MAX_BYTES:
        tasks = max(-(-rows_bytes // TASK_BYTES), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        rows, orders = rows.repartition(tasks, key), orders.repartition(tasks, order_key)
    return rows.join(orders, F.col(key) == F.col(order_key), "inner")


def _consts(spark: SparkSession, rows, schema) -> DataFrame:
    """Small constant table, built JVM-side (a local relation Catalyst can
    size, no Python rows)."""
    names = [c.strip().split()[0] for c in schema.split(",")]
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def load(spark: SparkSession, sf_dir: str) -> Feeds:
    customer = _read(spark, sf_dir, "customer")
    supplier = _read(spark, sf_dir, "supplier")
    part = _read(spark, sf_dir, "part")
    orders = _read(spark, sf_dir, "orders")
    lineitem = _read(spark, sf_dir, "lineitem")

    # ---- products: order priority is the product id; 5-LOW has no product
    pd_d = _consts(
        spark,
        [("1-URGENT", "R001"), ("2-HIGH", "R007"), ("3-MEDIUM", "R014"),
         ("4-NOT SPECIFIED", "R021")],
        "pd_id string, pd_cd string",
    )

    # ---- member categories from the market segments; FURNITURE unresolved
    segments = customer.select(F.col("c_mktsegment").alias("seg")).distinct()
    known = segments.filter(F.col("seg") != "FURNITURE")
    market_close_type_i = known.select(
        F.lit(L.PLEDGED_REPO_MARKET).alias("market"),
        F.col("seg").alias("ctgry_type_nm"),
        F.concat(F.col("seg"), F.lit("(x)")).alias("show_name_raw"),
    ).unionByName(
        # a row of another market, which must be ignored
        known.select(
            F.lit("买断式回购").alias("market"),
            F.col("seg").alias("ctgry_type_nm"),
            F.lit("OTHER").alias("show_name_raw"),
        )
    )
    member_ctgry_d = segments.select(
        F.substring("seg", 1, 3).alias("member_ctgry_id"), F.col("seg").alias("ctgry_type_nm")
    )
    after_hours_bond_type = known.select(
        F.concat(F.col("seg"), F.lit("（y）")).alias("show_name_raw"),
        F.substring("seg", 1, 3).alias("member_ctgry_id"),
    )

    # ---- members: customers and suppliers without key % 50 = 49; key % 10 = 9
    # also has a closed earlier version (another category), which the
    # current-version filter must drop
    k = F.col("k")
    orgs = customer.select(
        F.lit("C").alias("pre"), F.col("c_custkey").alias("k"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("nation"),
    ).unionByName(supplier.select(
        F.lit("S").alias("pre"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"),
        F.element_at(F.array(*map(F.lit, SEGMENTS)), (F.col("s_suppkey") % 5 + 1).cast("int")).alias("seg"),
        F.col("s_nationkey").alias("nation")))
    ident, master = F.concat("pre", _s(k)), F.concat(F.col("pre"), _s(k - k % 10))
    members = orgs.filter(k % 50 != 49)

    def member_rows(m, ctgry, start, end):
        return m.select(
            ident.alias("ip_id"),
            ctgry.alias("member_ctgry_id"),
            F.concat(F.lit("M"), ident).alias("member_cd"),
            F.concat(
                F.col("name"), F.when(F.col("nation") < 5, F.lit(L.JT_MONEY_FUND)).otherwise("")
            ).alias("full_nm"),
            F.concat(F.lit("M"), master).alias("rt_member_cd"),
            F.lit("root").alias("rt_member_full_nm"),
            F.lit(start).cast("date").alias("efctv_from_dt"),
            F.lit(end).cast("date").alias("efctv_to_dt"),
            ident.alias("unq_id"),
        )

    member_d = member_rows(members, F.substring("seg", 1, 3), "1990-01-01", L.OPEN_END_DATE).unionByName(
        member_rows(members.filter(k % 10 == 9), F.lit("HOU"), "1980-01-01", "1989-12-31"))

    # ---- root relations: slave k -> master k - k % 10 for k % 10 in 1..6;
    # k % 10 = 7 uses an invalid relation type, k % 10 = 8 a closed status
    mstr_slv_rl_tp_rl = _consts(
        spark,
        [(L.RELATION_KIND_VALID, "T1", "9999-12-31 00:00:00"),
         ("2", "T2", "9999-12-31 00:00:00"),
         (L.RELATION_KIND_VALID, "T3", "2019-12-31 00:00:00")],
        "rl_kind string, rl_tp_id string, valid_to string",
    )
    d = k % 10
    cim_org_rl = orgs.filter(d.between(1, 8)).select(
        F.when(d == 7, F.lit("T2")).otherwise(F.lit("T1")).alias("rl_tp_id"),
        ident.alias("slv_unq_id"),
        master.alias("mstr_unq_id"),
        F.when(d == 8, F.lit("D")).otherwise(F.lit(L.RELATION_STATUS_VALID)).alias("rl_status"),
        F.lit("9999-12-31 00:00:00").alias("valid_to"),
    )

    # ---- removed deals: % 97 failed pledged repo, % 89 failed elsewhere
    # (cash job only), % 83 removed for another reason
    ok = F.col("o_orderkey")
    trdx = orders.filter((ok % 97 == 0) | (ok % 89 == 0) | (ok % 83 == 0)).select(
        F.when((ok % 97 == 0) | (ok % 89 == 0), F.lit(L.FAILED_KIND)).otherwise("1").alias("rmv_kind"),
        F.lit(L.FAILED_REASON).alias("rmv_reason"),
        F.when(ok % 97 == 0, F.lit(L.PLEDGED_REPO_MKT_ID)).otherwise("110").alias("mkt_id"),
        _s(ok).alias("deal_suffix"),
    )

    # ---- repo deals: one per order that has lines, and the mirrored ones
    lines_per_order = lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("min_supp"))
    o = orders.join(lines_per_order, orders.o_orderkey == lines_per_order.l_orderkey, "inner")
    bond_repo_deal_f = _deals(o, ok, F.col("o_custkey"), F.col("min_supp")).select(
        F.concat(F.lit(L.EVENT_ID_PREFIX), "nmbr").alias("ev_id"),
        F.col("first_ip").alias("repo_ip_id"),
        F.col("second_ip").alias("rvrse_ip_id"),
        F.col("o_orderpriority").alias("pd_id"),
        F.col("nmbr").alias("deal_nmbr"),
        F.when(F.col("o_orderstatus") == "P", F.lit(L.CANCELLED_STATUS)).otherwise("1").alias("st"),
        F.col("o_orderdate").cast("date").alias("deal_dt"),
        ((ok % 400 + 100).cast("double") / 100).cast("decimal(18,6)").alias("repo_rate"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("trade_amnt"),
        # key % 29 = 0: a deal of another market, left out by the market filter
        F.when(ok % 29 == 0, F.lit("110")).otherwise(F.lit(L.PLEDGED_REPO_MKT_ID)).alias("mkt_id"),
    )

    # ---- interbank deals: % 3 = 0 flagged, % 3 = 1 listed with another flag
    dps_v_cr_dep_txn_dtl = orders.filter(ok % 3 != 2).select(
        _s(ok).alias("deal_nmbr"),
        F.when(ok % 3 == 0, F.lit(L.INTERBANK_FLAG)).otherwise("0").alias("dep_flag"),
    )

    # ---- collateral: every line pledges its part
    lk = F.col("l_orderkey")
    ev_cltrl_dtls = _deals(lineitem, lk, F.lit(0), F.lit(0)).select(
        _s(F.col("l_partkey")).alias("bond_id"),
        F.concat(F.lit(L.EVENT_ID_PREFIX), "nmbr").alias("ev_id"),
        (F.lit(1) - F.col("l_discount")).cast("decimal(9,6)").alias("cnvrsn_prprtn"),
        F.col("l_quantity").cast("decimal(18,2)").alias("face_value"),
    )

    # ---- bonds: parts without key % 50 = 49
    pk = F.col("p_partkey")
    bond8_raw = F.element_at(
        F.array(*[F.lit(x) for x in
                  ["国债", "同业存单", "政策性金融债", "地方政府债", "超短期融资券",
                   "短期融资券", "中期票据", "企业债", "资产支持证券"]]),
        (F.col("p_size") % 9 + 1).cast("int"),
    )
    parent4 = (
        F.when(F.col("p_type").isin("ECONOMY", "SMALL"), F.lit("利率债"))
        .when(F.col("p_type") == "MEDIUM", F.lit("同业存单"))
        .when(F.col("p_type").isin("PROMO", "STANDARD"), F.lit("信用债"))
        .otherwise(F.lit("其他"))
    )
    bond_d = part.filter(pk % 50 != 49).select(
        _s(pk).alias("bond_id"),
        bond8_raw.alias("bond_ctgry_nm"),
        F.col("p_brand").alias("issr_id"),
        F.lit("x").alias("c3"),
        F.col("p_name").alias("bond_nm"),
        F.concat(F.lit("B"), _s(pk)).alias("bond_cd"),
        F.lit("x").alias("c6"),
        F.lit("x").alias("c7"),
        F.date_format(F.date_add(F.lit("2030-01-01").cast("date"), pk.cast("int")), "yyyy-MM-dd")
        .alias("mrty_dt"),
        F.lit("x").alias("c9"),
        F.lit("x").alias("c10"),
        F.lit("x").alias("c11"),
        # key % 50 = 23: no listing date, so the bond is missing from the
        # 4-way dimension of the cash job but present in the 8-way one
        F.when(pk % 50 != 23, F.date_format(
            F.date_add(F.lit("1994-01-01").cast("date"), pk.cast("int")), "yyyy-MM-dd"))
        .alias("lstng_dt"),
        parent4.alias("bond_prnt_tp_nm"),
    )

    # ---- ratings: parts with key % 5 <> 0, two intervals each; key % 7 = 0
    # gets a second, lower rating on the first interval
    rated = part.filter(pk % 5 != 0)
    # two rating intervals per bond, index i = 0, 1
    interval = F.explode(F.array(
        F.struct(F.lit(0).alias("i"), F.lit("1995-01-01").alias("s"), F.lit("1997-12-31").alias("e")),
        F.struct(F.lit(1).alias("i"), F.lit("1998-01-01").alias("s"), F.lit("2001-12-31").alias("e")),
    )).alias("iv")
    rated_iv = rated.select("p_partkey", "p_size", interval).select(
        "p_partkey", "p_size", "iv.i", "iv.s", "iv.e")
    j = (F.col("p_size") + F.col("i")) % 3
    raw = (
        F.when(j == 0, F.lit("AAA"))
        .when(j == 1, F.when(pk % 2 == 0, F.lit("AA＋")).otherwise(F.lit("A-1+")))
        .otherwise(F.lit("AA"))
    )
    base_rtng = rated_iv.select(
        _s(pk).alias("bond_id"), raw.alias("rtng_raw"),
        F.col("s").cast("date").alias("rtng_start_dt"), F.col("e").cast("date").alias("rtng_end_dt"),
    )
    extra_rtng = rated.filter(pk % 7 == 0).select(
        _s(pk).alias("bond_id"), F.lit("BBB").alias("rtng_raw"),
        F.lit("1995-01-01").cast("date").alias("rtng_start_dt"),
        F.lit("1997-12-31").cast("date").alias("rtng_end_dt"),
    )
    ri_credit_rtng = base_rtng.unionByName(extra_rtng)

    # ---- cash-bond deals: one per line, and the mirrored ones
    li = _joined(lineitem, "l_orderkey", orders.select("o_orderkey", "o_custkey"), "o_orderkey")
    ln = F.col("l_linenumber") % 7
    bond_deal = _deals(li, lk, F.col("o_custkey"), F.col("l_suppkey")).select(
        F.col("nmbr").alias("bond_deal_id"),
        F.col("first_ip").alias("buy_ip_id"),
        F.col("second_ip").alias("sell_ip_id"),
        F.col("nmbr").alias("deal_nmbr"),
        F.col("l_shipdate").cast("date").alias("deal_dt"),
        F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R"),
               F.lit(L.CANCELLED_STATUS)).otherwise("1").alias("st"),
        _s(F.col("l_partkey")).alias("bond_id"),
        F.when(ln == 0, F.lit("USD")).when(ln == 1, F.lit(" - ")).otherwise(F.lit("CNY"))
        .alias("crncy"),
        (F.col("l_extendedprice").cast("decimal(18,2)") * (
            F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(9,2)"))).cast("decimal(18,2)")
        .alias("trade_amnt"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("dirty_amnt"),
        F.col("l_quantity").cast("decimal(18,2)").alias("face_value"),
        ((F.col("l_partkey") % 130).cast("double") / 10).cast("decimal(18,6)").alias("yrs_to_mrty"),
    )

    # ---- matching status per deal number: % 4 = 0 -> 0, 1 -> 4, 2 -> 1
    m = ok % 4
    dps_v_cbt_all_txn_dtl = orders.filter(m != 3).select(
        _s(ok).alias("deal_nmbr"),
        F.when(m == 0, F.lit("0")).when(m == 1, F.lit("4")).otherwise(F.lit("1")).alias("match_status"),
    )

    return Feeds(
        pd_d=pd_d,
        market_close_type_i=market_close_type_i,
        member_ctgry_d=member_ctgry_d,
        after_hours_bond_type=after_hours_bond_type,
        member_d=member_d,
        mstr_slv_rl_tp_rl=mstr_slv_rl_tp_rl,
        cim_org_rl=cim_org_rl,
        trdx_deal_infrmn_rmv_d=trdx,
        bond_repo_deal_f=bond_repo_deal_f,
        bond_d=bond_d,
        ri_credit_rtng=ri_credit_rtng,
        dps_v_cr_dep_txn_dtl=dps_v_cr_dep_txn_dtl,
        ev_cltrl_dtls=ev_cltrl_dtls,
        bond_deal=bond_deal,
        dps_v_cbt_all_txn_dtl=dps_v_cbt_all_txn_dtl,
    )
