"""DuckDB oracle SQL for every registered query.

An independent restatement in plain SQL of (1) the driver-table -> feed
mapping of ``sources.testviews`` and (2) the cleaning and report semantics
of ``plans``. Tables ``customer supplier part orders lineitem`` are the pre-registered
driver views. Formulation differs on purpose from the DataFrame plans
(GROUPING SETS instead of a fan-out, NOT IN / IN instead of anti/semi
joins, window ranking instead of max_by), so agreement is evidence.
"""

from __future__ import annotations


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def strip_paren(e: str) -> str:
    pos = f"greatest(strpos({e}, '('), strpos({e}, '（'))"
    return f"(CASE WHEN {pos} > 1 THEN trim(substr({e}, 1, {pos} - 1)) ELSE {e} END)"


def r6(num: str, den: str) -> str:
    return f"round(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0), 6)"


def sset(e: str, sep: str, filt: str | None = None) -> str:
    f = f" FILTER (WHERE {filt})" if filt else ""
    return f"string_agg(DISTINCT {e}, {_q(sep)} ORDER BY {e}){f}"


def scount(e: str, sep: str, filt: str | None = None) -> str:
    """Size of the set that ``sset`` joins."""
    return f"count(DISTINCT {e})" + (f" FILTER (WHERE {filt})" if filt else "")


# fixed values: labels, written out here so that a wrong label of the library shows
RANK = "CASE WHEN rtng_raw IN ('AAA') THEN 2 WHEN rtng_raw IN ('AA+', 'A-1+', 'AA＋') THEN 1 ELSE 0 END"


def rank_label(e: str) -> str:
    return f"(CASE {e} WHEN 2 THEN 'AAA' WHEN 1 THEN 'AA+' ELSE 'AA及以下' END)"


BOND8 = """CASE bond_ctgry_nm WHEN '国债' THEN '国债' WHEN '同业存单' THEN '同业存单'
    WHEN '政策性金融债' THEN '政策性金融债' WHEN '地方政府债' THEN '地方政府债'
    WHEN '超短期融资券' THEN '短期融资券（包含超短融）' WHEN '短期融资券' THEN '短期融资券（包含超短融）'
    WHEN '中期票据' THEN '中期票据' WHEN '企业债' THEN '企业债' ELSE '其他' END"""
BUCKET = """CASE WHEN yrs_to_mrty > 10 THEN '十年以上' WHEN yrs_to_mrty > 7 THEN '七年至十年'
    WHEN yrs_to_mrty > 5 THEN '五年至七年' WHEN yrs_to_mrty > 3 THEN '三年至五年'
    WHEN yrs_to_mrty > 1 THEN '一年至三年' ELSE '一年及以下' END"""
CAT4 = """(CASE WHEN bond_prnt_tp_nm IN ('利率债', '同业存单', '信用债') THEN bond_prnt_tp_nm ELSE '其他' END)"""


# --------------------------------------------------------------- feeds + base
FEEDS = f"""
f_pd_d AS (SELECT * FROM (VALUES ('1-URGENT', 'R001'), ('2-HIGH', 'R007'), ('3-MEDIUM', 'R014'),
    ('4-NOT SPECIFIED', 'R021')) t(pd_id, pd_cd)),
f_segs AS (SELECT DISTINCT c_mktsegment AS seg FROM customer),
f_mct AS (
    SELECT '质押式回购' AS market, seg AS ctgry_type_nm, seg || '(x)' AS show_name_raw
    FROM f_segs WHERE seg <> 'FURNITURE'
    UNION ALL
    SELECT '买断式回购', seg, 'OTHER' FROM f_segs WHERE seg <> 'FURNITURE'),
f_mcd AS (SELECT substr(seg, 1, 3) AS member_ctgry_id, seg AS ctgry_type_nm FROM f_segs),
f_aht AS (SELECT seg || '（y）' AS show_name_raw, substr(seg, 1, 3) AS member_ctgry_id
    FROM f_segs WHERE seg <> 'FURNITURE'),
f_org AS (
    SELECT 'C' AS pre, c_custkey AS k, c_name AS name, c_mktsegment AS seg, c_nationkey AS nation FROM customer
    UNION ALL
    SELECT 'S', s_suppkey, s_name,
        (['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'])[s_suppkey % 5 + 1], s_nationkey
    FROM supplier),
f_member AS (
    SELECT pre || CAST(k AS VARCHAR) AS ip_id, substr(seg, 1, 3) AS member_ctgry_id,
        'M' || pre || CAST(k AS VARCHAR) AS member_cd,
        name || CASE WHEN nation < 5 THEN '货币市场基金' ELSE '' END AS full_nm,
        'M' || pre || CAST(k - k % 10 AS VARCHAR) AS rt_member_cd,
        'root' AS rt_member_full_nm, DATE '1990-01-01' AS efctv_from_dt,
        DATE '9999-12-31' AS efctv_to_dt, pre || CAST(k AS VARCHAR) AS unq_id
    FROM f_org WHERE k % 50 <> 49
    UNION ALL
    SELECT pre || CAST(k AS VARCHAR), 'HOU', 'M' || pre || CAST(k AS VARCHAR),
        name || CASE WHEN nation < 5 THEN '货币市场基金' ELSE '' END,
        'M' || pre || CAST(k - k % 10 AS VARCHAR), 'root', DATE '1980-01-01', DATE '1989-12-31',
        pre || CAST(k AS VARCHAR)
    FROM f_org WHERE k % 50 <> 49 AND k % 10 = 9),
f_rltp AS (SELECT * FROM (VALUES ('1', 'T1', '9999-12-31 00:00:00'), ('2', 'T2', '9999-12-31 00:00:00'),
    ('1', 'T3', '2019-12-31 00:00:00')) t(rl_kind, rl_tp_id, valid_to)),
f_orgrl AS (
    SELECT CASE WHEN k % 10 = 7 THEN 'T2' ELSE 'T1' END AS rl_tp_id,
        pre || CAST(k AS VARCHAR) AS slv_unq_id,
        pre || CAST(k - k % 10 AS VARCHAR) AS mstr_unq_id,
        CASE WHEN k % 10 = 8 THEN 'D' ELSE 'C' END AS rl_status,
        '9999-12-31 00:00:00' AS valid_to
    FROM f_org WHERE k % 10 BETWEEN 1 AND 8),
f_side AS (SELECT * FROM (VALUES (false, ''), (true, 'M')) t(mirror, mark)),
f_rmv AS (
    SELECT CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 THEN '2' ELSE '1' END AS rmv_kind,
        '1' AS rmv_reason, CASE WHEN o_orderkey % 97 = 0 THEN '109' ELSE '110' END AS mkt_id,
        CAST(o_orderkey AS VARCHAR) AS deal_suffix
    FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 OR o_orderkey % 83 = 0),
f_repo AS (
    SELECT '11002' || m.mark || CAST(o.o_orderkey AS VARCHAR) AS ev_id,
        CASE WHEN (o.o_orderkey % 2 = 1) <> m.mirror THEN 'S' || CAST(l.min_supp AS VARCHAR)
            ELSE 'C' || CAST(o.o_custkey AS VARCHAR) END AS repo_ip_id,
        CASE WHEN (o.o_orderkey % 2 = 1) <> m.mirror THEN 'C' || CAST(o.o_custkey AS VARCHAR)
            ELSE 'S' || CAST(l.min_supp AS VARCHAR) END AS rvrse_ip_id,
        o.o_orderpriority AS pd_id, m.mark || CAST(o.o_orderkey AS VARCHAR) AS deal_nmbr,
        CASE WHEN o.o_orderstatus = 'P' THEN '2' ELSE '1' END AS st,
        CAST(o.o_orderdate AS DATE) AS deal_dt,
        CAST(CAST(o.o_orderkey % 400 + 100 AS DOUBLE) / 100 AS DECIMAL(18,6)) AS repo_rate,
        CAST(o.o_totalprice AS DECIMAL(18,2)) AS trade_amnt,
        CASE WHEN o.o_orderkey % 29 = 0 THEN '110' ELSE '109' END AS mkt_id
    FROM orders o JOIN (SELECT l_orderkey, min(l_suppkey) AS min_supp FROM lineitem GROUP BY l_orderkey) l
        ON o.o_orderkey = l.l_orderkey JOIN f_side m ON NOT m.mirror OR o.o_orderkey % 5 = 0),
f_dep AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS deal_nmbr,
        CASE WHEN o_orderkey % 3 = 0 THEN '1' ELSE '0' END AS dep_flag
    FROM orders WHERE o_orderkey % 3 <> 2),
f_cltrl AS (
    SELECT CAST(l_partkey AS VARCHAR) AS bond_id, '11002' || m.mark || CAST(l_orderkey AS VARCHAR) AS ev_id,
        CAST(1 - l_discount AS DECIMAL(9,6)) AS cnvrsn_prprtn,
        CAST(l_quantity AS DECIMAL(18,2)) AS face_value
    FROM lineitem JOIN f_side m ON NOT m.mirror OR l_orderkey % 5 = 0),
f_bond AS (
    SELECT CAST(p_partkey AS VARCHAR) AS bond_id,
        (['国债', '同业存单', '政策性金融债', '地方政府债', '超短期融资券', '短期融资券', '中期票据', '企业债',
          '资产支持证券'])[p_size % 9 + 1] AS bond_ctgry_nm,
        p_brand AS issr_id, p_name AS bond_nm, 'B' || CAST(p_partkey AS VARCHAR) AS bond_cd,
        strftime(DATE '2030-01-01' + CAST(p_partkey AS INTEGER), '%Y-%m-%d') AS mrty_dt,
        CASE WHEN p_partkey % 50 <> 23
            THEN strftime(DATE '1994-01-01' + CAST(p_partkey AS INTEGER), '%Y-%m-%d') END AS lstng_dt,
        CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN '利率债' WHEN p_type = 'MEDIUM' THEN '同业存单'
            WHEN p_type IN ('PROMO', 'STANDARD') THEN '信用债' ELSE '其他' END AS bond_prnt_tp_nm
    FROM part WHERE p_partkey % 50 <> 49),
f_rtng AS (
    SELECT CAST(p_partkey AS VARCHAR) AS bond_id,
        CASE (p_size + 0) % 3 WHEN 0 THEN 'AAA'
            WHEN 1 THEN CASE WHEN p_partkey % 2 = 0 THEN 'AA＋' ELSE 'A-1+' END ELSE 'AA' END AS rtng_raw,
        DATE '1995-01-01' AS rtng_start_dt, DATE '1997-12-31' AS rtng_end_dt
    FROM part WHERE p_partkey % 5 <> 0
    UNION ALL
    SELECT CAST(p_partkey AS VARCHAR),
        CASE (p_size + 1) % 3 WHEN 0 THEN 'AAA'
            WHEN 1 THEN CASE WHEN p_partkey % 2 = 0 THEN 'AA＋' ELSE 'A-1+' END ELSE 'AA' END,
        DATE '1998-01-01', DATE '2001-12-31'
    FROM part WHERE p_partkey % 5 <> 0
    UNION ALL
    SELECT CAST(p_partkey AS VARCHAR), 'BBB', DATE '1995-01-01', DATE '1997-12-31'
    FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 7 = 0),
f_cash AS (
    SELECT m.mark || CAST(l.l_orderkey AS VARCHAR) AS bond_deal_id,
        CASE WHEN (l.l_orderkey % 2 = 1) <> m.mirror THEN 'S' || CAST(l.l_suppkey AS VARCHAR)
            ELSE 'C' || CAST(o.o_custkey AS VARCHAR) END AS buy_ip_id,
        CASE WHEN (l.l_orderkey % 2 = 1) <> m.mirror THEN 'C' || CAST(o.o_custkey AS VARCHAR)
            ELSE 'S' || CAST(l.l_suppkey AS VARCHAR) END AS sell_ip_id,
        m.mark || CAST(l.l_orderkey AS VARCHAR) AS deal_nmbr,
        CAST(l.l_shipdate AS DATE) AS deal_dt,
        CASE WHEN l.l_linestatus = 'F' AND l.l_returnflag = 'R' THEN '2' ELSE '1' END AS st,
        CAST(l.l_partkey AS VARCHAR) AS bond_id,
        CASE WHEN l.l_linenumber % 7 = 0 THEN 'USD' WHEN l.l_linenumber % 7 = 1 THEN ' - ' ELSE 'CNY' END AS crncy,
        CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(3,2)) - CAST(l.l_discount AS DECIMAL(9,2)))
            AS DECIMAL(18,2)) AS trade_amnt,
        CAST(l.l_extendedprice AS DECIMAL(18,2)) AS dirty_amnt,
        CAST(l.l_quantity AS DECIMAL(18,2)) AS face_value,
        CAST(CAST(l.l_partkey % 130 AS DOUBLE) / 10 AS DECIMAL(18,6)) AS yrs_to_mrty
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN f_side m ON NOT m.mirror OR l.l_orderkey % 5 = 0),
f_match AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS deal_nmbr,
        CASE o_orderkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '4' ELSE '1' END AS match_status
    FROM orders WHERE o_orderkey % 4 <> 3)"""

BASE = f"""
c_mct AS (SELECT ctgry_type_nm, max({strip_paren('show_name_raw')}) AS ins_show_name
    FROM f_mct WHERE market = '质押式回购' GROUP BY ctgry_type_nm),
c_repo_ctgry AS (SELECT d.member_ctgry_id, max(m.ins_show_name) AS ins_show_name
    FROM f_mcd d JOIN c_mct m ON d.ctgry_type_nm = m.ctgry_type_nm GROUP BY d.member_ctgry_id),
c_aht AS (SELECT member_ctgry_id, max({strip_paren('show_name_raw')}) AS bond_after_show_name
    FROM f_aht GROUP BY member_ctgry_id),
c_member AS (
    SELECT ip_id, unq_id, member_ctgry_id, full_nm, ins_show_name, bond_after_show_name FROM (
        SELECT m.ip_id, m.unq_id, m.member_ctgry_id, m.full_nm, c.ins_show_name, a.bond_after_show_name,
            row_number() OVER (PARTITION BY m.ip_id ORDER BY m.efctv_from_dt DESC, m.unq_id DESC,
                m.member_ctgry_id DESC, m.full_nm DESC, c.ins_show_name DESC, a.bond_after_show_name DESC) AS rn
        FROM f_member m JOIN c_repo_ctgry c ON m.member_ctgry_id = c.member_ctgry_id
            JOIN c_aht a ON m.member_ctgry_id = a.member_ctgry_id
        WHERE m.efctv_to_dt = DATE '9999-12-31' AND coalesce(m.rt_member_cd, '') <> ''
            AND coalesce(m.rt_member_full_nm, '') <> '') t WHERE rn = 1),
c_minfo AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY unq_id ORDER BY ip_id DESC) AS rn
    FROM c_member) t WHERE rn = 1),
c_root AS (
    SELECT slv_unq_id AS unq_id, max(mstr_unq_id) AS root_unq_id FROM f_orgrl
    WHERE rl_status = 'C' AND starts_with(valid_to, '9999-12-31')
        AND rl_tp_id IN (SELECT rl_tp_id FROM f_rltp WHERE rl_kind = '1' AND starts_with(valid_to, '9999-12-31'))
    GROUP BY slv_unq_id),
c_deal AS (
    SELECT d.ev_id, r.unq_id AS repo_unq_id, v.unq_id AS rvrse_unq_id, d.pd_id, d.deal_nmbr, d.st,
        d.deal_dt, d.repo_rate, d.trade_amnt
    FROM f_repo d JOIN c_member r ON d.repo_ip_id = r.ip_id JOIN c_member v ON d.rvrse_ip_id = v.ip_id
    WHERE d.mkt_id = '109' AND d.st <> '2'
        AND d.ev_id NOT IN (SELECT '11002' || deal_suffix FROM f_rmv
            WHERE rmv_kind = '2' AND rmv_reason = '1' AND mkt_id = '109')),
c_priced AS (
    SELECT d.*, p.pd_cd FROM c_deal d
        JOIN (SELECT pd_id, max(pd_cd) AS pd_cd FROM f_pd_d GROUP BY pd_id) p ON d.pd_id = p.pd_id
    WHERE p.pd_cd IN ('R001', 'R007', 'R014')),
c_bond4 AS (
    SELECT bond_id, bond_ctgry_nm, issr_id FROM (
        SELECT bond_id, {CAT4} AS bond_ctgry_nm,
            CASE WHEN issr_id IS NULL OR issr_id = '' THEN '' WHEN length(issr_id) >= 4 THEN substr(issr_id, 5)
                ELSE issr_id END AS issr_id
        FROM f_bond) t
    QUALIFY row_number() OVER (PARTITION BY bond_id ORDER BY bond_ctgry_nm DESC, issr_id DESC) = 1),
c_rating AS (SELECT bond_id, rtng_start_dt, rtng_end_dt, min({RANK}) AS rtng_rank
    FROM f_rtng GROUP BY bond_id, rtng_start_dt, rtng_end_dt),
c_cl AS (SELECT DISTINCT ev_id, bond_id, cnvrsn_prprtn, face_value FROM f_cltrl),
c_cltot AS (SELECT ev_id, sum(face_value) AS sum_face FROM c_cl GROUP BY ev_id),
c_coll AS (
    SELECT d.ev_id, d.repo_unq_id, d.rvrse_unq_id, d.deal_dt, d.trade_amnt, c.bond_id, c.cnvrsn_prprtn,
        CAST(CAST(CAST(floor((CASE WHEN t.sum_face < 0.000000001 THEN CAST(c.face_value AS DOUBLE)
                ELSE CAST(c.face_value AS DOUBLE) / CAST(t.sum_face AS DOUBLE) END)
            * CAST(d.trade_amnt AS DOUBLE) * 10000.0 + 0.5) AS BIGINT) AS DECIMAL(18,0))
            * CAST(0.0001 AS DECIMAL(4,4)) AS DECIMAL(23,4)) AS alloc
    FROM c_deal d JOIN c_cltot t ON d.ev_id = t.ev_id JOIN c_cl c ON d.ev_id = c.ev_id),
c_coll_rank AS (
    SELECT k.bond_id, k.deal_dt, r.rtng_rank
    FROM (SELECT DISTINCT bond_id, deal_dt FROM c_coll) k
        JOIN c_rating r ON k.bond_id = r.bond_id AND k.deal_dt BETWEEN r.rtng_start_dt AND r.rtng_end_dt
    QUALIFY row_number() OVER (PARTITION BY k.bond_id, k.deal_dt
        ORDER BY r.rtng_start_dt DESC, r.rtng_end_dt ASC, r.rtng_rank ASC) = 1),
c_member_cash AS (
    SELECT ip_id, unq_id, ins_show_name FROM (
        SELECT m.ip_id, m.unq_id, coalesce(a.bond_after_show_name, 'None') AS ins_show_name,
            row_number() OVER (PARTITION BY m.ip_id ORDER BY m.efctv_from_dt DESC, m.unq_id DESC,
                coalesce(a.bond_after_show_name, 'None') DESC) AS rn
        FROM f_member m LEFT JOIN c_aht a ON m.member_ctgry_id = a.member_ctgry_id
        WHERE m.efctv_to_dt = DATE '9999-12-31') t WHERE rn = 1),
c_bond4c AS (
    SELECT bond_id, bond_nm, bond_cd, mrty_dt, lstng_dt, {CAT4} AS bond_type4 FROM f_bond
    WHERE coalesce(bond_id, '') <> '' AND coalesce(bond_ctgry_nm, '') <> '' AND coalesce(issr_id, '') <> ''
        AND coalesce(bond_nm, '') <> '' AND coalesce(bond_cd, '') <> '' AND coalesce(mrty_dt, '') <> ''
        AND coalesce(lstng_dt, '') <> '' AND coalesce(bond_prnt_tp_nm, '') <> ''),
c_bond8 AS (
    SELECT bond_id, {BOND8} AS bond_type8 FROM f_bond
    WHERE coalesce(bond_id, '') <> '' AND coalesce(bond_ctgry_nm, '') <> '' AND coalesce(issr_id, '') <> ''
        AND coalesce(bond_nm, '') <> ''),
c_cash AS (
    SELECT d.bond_deal_id, d.buy_ip_id, d.sell_ip_id, d.deal_nmbr, d.deal_dt, d.bond_id, d.trade_amnt, d.dirty_amnt,
        d.face_value, d.yrs_to_mrty, trim(d.crncy) AS crncy,
        CASE WHEN s.match_status IS NULL OR s.match_status = '' OR s.match_status IN ('0', '4')
            THEN '正常' ELSE '策略性交易' END AS deal_strategy,
        coalesce(b4.bond_type4, 'empty') AS bond_type4, coalesce(b8.bond_type8, 'empty') AS bond_type8,
        {BUCKET.replace('yrs_to_mrty', 'd.yrs_to_mrty')} AS mrty_bucket
    FROM f_cash d
        LEFT JOIN (SELECT deal_nmbr, max(match_status) AS match_status FROM f_match GROUP BY deal_nmbr) s
            ON d.deal_nmbr = s.deal_nmbr
        LEFT JOIN c_bond4c b4 ON d.bond_id = b4.bond_id
        LEFT JOIN c_bond8 b8 ON d.bond_id = b8.bond_id
    WHERE d.st <> '2' AND trim(d.crncy) IN ('CNY', '-')
        AND d.buy_ip_id IN (SELECT ip_id FROM c_member_cash)
        AND d.sell_ip_id IN (SELECT ip_id FROM c_member_cash)
        AND d.bond_deal_id NOT IN (SELECT deal_suffix FROM f_rmv WHERE rmv_kind = '2' AND rmv_reason = '1'))"""

# ----------------------------------------------------------- report helpers
REPO_SIDES_SQL = """
rs_priced AS (
    SELECT 'REPO' AS side, repo_unq_id AS member, rvrse_unq_id AS counter, * EXCLUDE (repo_unq_id, rvrse_unq_id)
    FROM c_priced
    UNION ALL
    SELECT 'RVRSE', rvrse_unq_id, repo_unq_id, * EXCLUDE (repo_unq_id, rvrse_unq_id) FROM c_priced),
rs_deal AS (
    SELECT 'REPO' AS side, repo_unq_id AS member, rvrse_unq_id AS counter, * EXCLUDE (repo_unq_id, rvrse_unq_id)
    FROM c_deal
    UNION ALL
    SELECT 'RVRSE', rvrse_unq_id, repo_unq_id, * EXCLUDE (repo_unq_id, rvrse_unq_id) FROM c_deal),
rs_coll AS (
    SELECT 'REPO' AS side, repo_unq_id AS member, rvrse_unq_id AS counter, * EXCLUDE (repo_unq_id, rvrse_unq_id)
    FROM c_coll
    UNION ALL
    SELECT 'RVRSE', rvrse_unq_id, repo_unq_id, * EXCLUDE (repo_unq_id, rvrse_unq_id) FROM c_coll),
cs AS (
    SELECT 'BUY' AS side, buy_ip_id AS member, sell_ip_id AS counter, * EXCLUDE (buy_ip_id, sell_ip_id)
    FROM c_cash
    UNION ALL
    SELECT 'SELL', sell_ip_id, buy_ip_id, * EXCLUDE (buy_ip_id, sell_ip_id) FROM c_cash)"""


def _repo_rolled(src: str) -> str:
    return f"""(SELECT s.*, coalesce(r.root_unq_id, s.member) AS root,
        CASE WHEN coalesce(r.root_unq_id, s.member) = s.member THEN '机构'
            WHEN coalesce(i.full_nm, '') LIKE '%货币市场基金%' THEN '货币市场基金' ELSE '产品' END AS jt
    FROM {src} s LEFT JOIN c_root r ON s.member = r.unq_id LEFT JOIN c_minfo i ON s.member = i.unq_id)"""


CASH_ROLLED = """(SELECT s.*,
        CASE WHEN r.root_unq_id IS NULL THEN s.member ELSE coalesce(b.ip_id, s.member) END AS root,
        CASE WHEN r.root_unq_id IS NULL THEN '机构' ELSE '产品' END AS jt
    FROM cs s LEFT JOIN c_member_cash m ON s.member = m.ip_id
        LEFT JOIN c_root r ON m.unq_id = r.unq_id
        LEFT JOIN (SELECT unq_id, max(ip_id) AS ip_id FROM c_member_cash GROUP BY unq_id) b
            ON r.root_unq_id = b.unq_id)"""

JT = "CASE WHEN grouping(jt) = 1 THEN '全部' ELSE jt END"


def _gs(keys: list[str]) -> str:
    """GROUP BY GROUPING SETS: keys with and without the participant type."""
    k = ", ".join(keys)
    return f"GROUP BY GROUPING SETS (({k}), ({k}, jt))"


def _side(side: str, e: str) -> str:
    return f"CASE WHEN side = '{side}' THEN {e} END"


def _bside(side: str, e: str) -> str:
    return f"CAST(coalesce(sum({_side(side, e)}), 0) AS DECIMAL(38,2))"


# ------------------------------------------------------------------ queries
Q: dict[str, str] = {}

# base tables
Q["dim_member"] = "SELECT * FROM c_member"
Q["dim_root"] = "SELECT * FROM c_root"
Q["dim_rating"] = (f"SELECT bond_id, rtng_start_dt, rtng_end_dt, rtng_rank, {rank_label('rtng_rank')} "
                   "AS rtng_desc FROM c_rating")
Q["dim_bond4"] = "SELECT * FROM c_bond4"
Q["dim_bond8"] = "SELECT * FROM c_bond8"
Q["fact_repo_deal"] = "SELECT * FROM c_deal"
Q["fact_repo_deal_priced"] = "SELECT * FROM c_priced"
Q["fact_repo_collateral"] = "SELECT * FROM c_coll"
Q["fact_cash_deal"] = ("SELECT bond_deal_id, buy_ip_id, sell_ip_id, deal_strategy, deal_nmbr, deal_dt, bond_type4, "
                       "crncy, trade_amnt, dirty_amnt, face_value, yrs_to_mrty, bond_id, bond_type8, mrty_bucket FROM c_cash")

# repo reports
Q["member_sketch_info"] = ("SELECT unq_id AS unq_id_in_src_sys, full_nm, ins_show_name, bond_after_show_name "
                           "FROM c_minfo")

Q["member_all_price_deal_info"] = f"""
SELECT s.member AS unq_id_in_src_sys, s.pd_cd, s.deal_dt, i.ins_show_name,
    {r6(f"sum({_side('REPO', 'repo_rate * trade_amnt')})", f"sum({_side('REPO', 'trade_amnt')})")} AS repo_weighted_price,
    {r6(f"sum({_side('RVRSE', 'repo_rate * trade_amnt')})", f"sum({_side('RVRSE', 'trade_amnt')})")} AS rvrse_weighted_price
FROM rs_priced s JOIN c_minfo i ON s.member = i.unq_id
GROUP BY s.member, s.pd_cd, s.deal_dt, i.ins_show_name"""

Q["member_price_deal_info"] = f"""
SELECT root AS unq_id_in_src_sys, join_type, pd_cd, deal_dt,
    {r6('rn', 'ra')} AS repo_weighted_price, CAST(ra AS DECIMAL(38,2)) AS repo_sum_amount,
    {r6('vn', 'va')} AS rvrse_weighted_price, CAST(va AS DECIMAL(38,2)) AS rvrse_sum_amount,
    CASE WHEN ra IS NOT NULL AND va IS NOT NULL
        THEN round(CAST(vn AS DOUBLE) / CAST(va AS DOUBLE) - CAST(rn AS DOUBLE) / CAST(ra AS DOUBLE), 6) END
        AS price_difference,
    CASE WHEN ra IS NOT NULL AND va IS NOT NULL THEN CAST(ra + va AS DECIMAL(38,2)) END AS total_amount
FROM (
    SELECT root, {JT} AS join_type, pd_cd, deal_dt,
        sum({_side('REPO', 'repo_rate * trade_amnt')}) AS rn, sum({_side('REPO', 'trade_amnt')}) AS ra,
        sum({_side('RVRSE', 'repo_rate * trade_amnt')}) AS vn, sum({_side('RVRSE', 'trade_amnt')}) AS va
    FROM {_repo_rolled('rs_priced')} x
    {_gs(['root', 'pd_cd', 'deal_dt'])}) g"""

Q["ctgry_price_deal_info"] = f"""
WITH mg AS (
    SELECT member, pd_cd, deal_dt,
        sum({_side('REPO', 'repo_rate * trade_amnt')}) AS rn, sum({_side('REPO', 'trade_amnt')}) AS ra,
        sum({_side('RVRSE', 'repo_rate * trade_amnt')}) AS vn, sum({_side('RVRSE', 'trade_amnt')}) AS va,
        max({_side('REPO', 'repo_rate')}) AS rmax, min({_side('REPO', 'repo_rate')}) AS rmin,
        max({_side('RVRSE', 'repo_rate')}) AS vmax, min({_side('RVRSE', 'repo_rate')}) AS vmin
    FROM rs_priced GROUP BY member, pd_cd, deal_dt),
spread AS (
    SELECT i.ins_show_name, mg.pd_cd, mg.deal_dt,
        sum((CAST(vn AS DOUBLE) / CAST(va AS DOUBLE) - CAST(rn AS DOUBLE) / CAST(ra AS DOUBLE))
            * CAST(ra + va AS DOUBLE)) AS dt, sum(CAST(ra + va AS DOUBLE)) AS t
    FROM mg JOIN c_minfo i ON mg.member = i.unq_id
    WHERE ra IS NOT NULL AND va IS NOT NULL
    GROUP BY i.ins_show_name, mg.pd_cd, mg.deal_dt),
prices AS (
    SELECT i.ins_show_name, mg.pd_cd, mg.deal_dt,
        sum(rn) AS rn, sum(ra) AS ra, sum(vn) AS vn, sum(va) AS va,
        max(rmax) AS rmax, min(rmin) AS rmin, max(vmax) AS vmax, min(vmin) AS vmin
    FROM mg JOIN c_minfo i ON mg.member = i.unq_id
    GROUP BY i.ins_show_name, mg.pd_cd, mg.deal_dt)
SELECT p.ins_show_name, p.pd_cd, p.deal_dt,
    {r6('p.rn', 'p.ra')} AS repo_weighted_price, {r6('p.vn', 'p.va')} AS rvrse_weighted_price,
    {r6('s.dt', 's.t')} AS price_difference,
    p.rmax AS repo_max_deal_repo_rate, p.rmin AS repo_min_deal_repo_rate,
    p.vmax AS rvrse_max_deal_repo_rate, p.vmin AS rvrse_min_deal_repo_rate
FROM prices p LEFT JOIN spread s
    ON p.ins_show_name = s.ins_show_name AND p.pd_cd = s.pd_cd AND p.deal_dt = s.deal_dt"""

Q["global_price_deal_info"] = f"""
WITH m AS (
    SELECT pd_cd, deal_dt, sum(repo_rate * trade_amnt) AS n, sum(trade_amnt) AS a,
        max(repo_rate) AS mx, min(repo_rate) AS mn
    FROM c_priced GROUP BY pd_cd, deal_dt),
b AS (
    SELECT pd_cd, deal_dt, sum(repo_rate * trade_amnt) AS n, sum(trade_amnt) AS a,
        max(repo_rate) AS mx, min(repo_rate) AS mn
    FROM c_priced WHERE deal_nmbr IN (SELECT deal_nmbr FROM f_dep WHERE dep_flag = '1')
    GROUP BY pd_cd, deal_dt)
SELECT m.pd_cd, m.deal_dt, {r6('m.n', 'm.a')} AS market_weighted_price,
    m.mx AS market_max_deal_repo_rate, m.mn AS market_min_deal_repo_rate,
    {r6('b.n', 'b.a')} AS banks_weighted_price, b.mx AS banks_max_deal_repo_rate,
    b.mn AS banks_min_deal_repo_rate
FROM m LEFT JOIN b ON m.pd_cd = b.pd_cd AND m.deal_dt = b.deal_dt"""

DIST = ("(SELECT s.*, ci.ins_show_name AS cou_party_ins_show_name FROM rs_deal s "
        "JOIN c_minfo ci ON s.counter = ci.unq_id)")

Q["member_ctgry_amount_deal_info"] = f"""
SELECT root AS unq_id_in_src_sys, {JT} AS join_type, cou_party_ins_show_name, deal_dt,
    CAST(sum({_side('REPO', 'trade_amnt')}) AS DECIMAL(38,2)) AS repo_sum_amount,
    CAST(sum({_side('RVRSE', 'trade_amnt')}) AS DECIMAL(38,2)) AS rvrse_sum_amount,
    {sset('counter', ',', "side = 'REPO'")} AS repo_cou_party_uniq_set, {scount('counter', ',', "side = 'REPO'")} AS repo_cou_party_uniq_set_size,
    {sset('counter', ',', "side = 'RVRSE'")} AS rvrse_cou_party_uniq_set, {scount('counter', ',', "side = 'RVRSE'")} AS rvrse_cou_party_uniq_set_size
FROM {_repo_rolled(DIST)} x
{_gs(['root', 'cou_party_ins_show_name', 'deal_dt'])}"""

Q["ctgry_ctgry_amount_deal_info"] = f"""
SELECT i.ins_show_name, d.cou_party_ins_show_name, d.deal_dt,
    CAST(sum({_side('REPO', 'trade_amnt')}) AS DECIMAL(38,2)) AS repo_sum_amount,
    CAST(sum({_side('RVRSE', 'trade_amnt')}) AS DECIMAL(38,2)) AS rvrse_sum_amount
FROM {DIST} d JOIN c_minfo i ON d.member = i.unq_id
GROUP BY i.ins_show_name, d.cou_party_ins_show_name, d.deal_dt"""

Q["member_ctgry_number_deal_info"] = f"""
SELECT i.ins_show_name, d.member AS unq_id_in_src_sys, d.cou_party_ins_show_name, d.deal_dt,
    {sset('counter', ',', "side = 'REPO'")} AS repo_cou_party_uniq_set, {scount('counter', ',', "side = 'REPO'")} AS repo_cou_party_uniq_set_size,
    {sset('counter', ',', "side = 'RVRSE'")} AS rvrse_cou_party_uniq_set, {scount('counter', ',', "side = 'RVRSE'")} AS rvrse_cou_party_uniq_set_size
FROM {DIST} d JOIN c_minfo i ON d.member = i.unq_id
GROUP BY i.ins_show_name, d.member, d.cou_party_ins_show_name, d.deal_dt"""

COLL_CAT = ("(SELECT s.*, coalesce(b.bond_ctgry_nm, '其他') AS bond_ctgry_nm FROM rs_coll s "
            "LEFT JOIN c_bond4 b ON s.bond_id = b.bond_id)")
COLL_RTNG = (f"(SELECT c.*, {rank_label('coalesce(k.rtng_rank, 0)')} AS rtng_desc FROM {COLL_CAT} c "
             "LEFT JOIN c_coll_rank k ON c.bond_id = k.bond_id AND c.deal_dt = k.deal_dt)")
COLL_ISSR = "(SELECT s.*, b.issr_id FROM rs_coll s JOIN c_bond4 b ON s.bond_id = b.bond_id)"
ALLOC = (f"CAST(sum({_side('REPO', 'alloc')}) AS DECIMAL(38,4)) AS repo_sum_amount, "
         f"CAST(sum({_side('RVRSE', 'alloc')}) AS DECIMAL(38,4)) AS rvrse_sum_amount")
HAIRCUT = (f"{r6('sum(' + _side('REPO', 'cnvrsn_prprtn * alloc') + ')', 'sum(' + _side('REPO', 'alloc') + ')')}"
           " AS repo_weighted_cnvrsn_prprtn, "
           f"{r6('sum(' + _side('RVRSE', 'cnvrsn_prprtn * alloc') + ')', 'sum(' + _side('RVRSE', 'alloc') + ')')}"
           " AS rvrse_weighted_cnvrsn_prprtn")
NOT_RATE = "bond_ctgry_nm <> '利率债'"


def _member_coll(src: str, keys: list[str], measures: str, where: str = "") -> str:
    w = f"WHERE {where}" if where else ""
    ks = ", ".join(keys)
    return f"""
SELECT root AS unq_id_in_src_sys, {JT} AS join_type, {ks}, {measures}
FROM {_repo_rolled(f'(SELECT * FROM {src} z {w})')} x
{_gs(['root'] + keys)}"""


def _ctgry_coll(src: str, keys: list[str], measures: str, where: str = "") -> str:
    w = f"AND {where}" if where else ""
    ks = ", ".join(f"c.{k}" for k in keys)
    return f"""
SELECT i.ins_show_name, {ks}, {measures}
FROM {src} c JOIN c_minfo i ON c.member = i.unq_id WHERE TRUE {w}
GROUP BY i.ins_show_name, {ks}"""


Q["member_bond_ctgry_deal_info"] = _member_coll(COLL_CAT, ["bond_ctgry_nm", "deal_dt"], ALLOC)
Q["ctgry_bond_ctgry_deal_info"] = _ctgry_coll(COLL_CAT, ["bond_ctgry_nm", "deal_dt"], ALLOC)
Q["member_bond_rtng_deal_info"] = _member_coll(COLL_RTNG, ["bond_ctgry_nm", "rtng_desc", "deal_dt"], ALLOC, NOT_RATE)
Q["ctgry_bond_rtng_deal_info"] = _ctgry_coll(COLL_RTNG, ["bond_ctgry_nm", "rtng_desc", "deal_dt"], ALLOC, NOT_RATE)
Q["member_bond_type_deal_info"] = _member_coll(COLL_RTNG, ["bond_ctgry_nm", "rtng_desc", "deal_dt"], HAIRCUT)
Q["ctgry_bond_type_deal_info"] = _ctgry_coll(COLL_RTNG, ["bond_ctgry_nm", "rtng_desc", "deal_dt"], HAIRCUT)
Q["member_bond_issr_deal_info"] = _member_coll(COLL_ISSR, ["issr_id", "deal_dt"], HAIRCUT)
Q["ctgry_bond_issr_deal_info"] = _ctgry_coll(COLL_ISSR, ["issr_id", "deal_dt"], HAIRCUT)

# optional variants (commented out in the original job)
_MG = f"""
SELECT member, pd_cd, deal_dt,
    sum({_side('REPO', 'repo_rate * trade_amnt')}) AS rn, sum({_side('REPO', 'trade_amnt')}) AS ra,
    sum({_side('RVRSE', 'repo_rate * trade_amnt')}) AS vn, sum({_side('RVRSE', 'trade_amnt')}) AS va
FROM rs_priced GROUP BY member, pd_cd, deal_dt"""
Q["member_spread_info"] = f"""
SELECT m.member AS unq_id_in_src_sys, m.pd_cd, m.deal_dt, i.ins_show_name,
    round(CAST(vn AS DOUBLE) / CAST(va AS DOUBLE) - CAST(rn AS DOUBLE) / CAST(ra AS DOUBLE), 6) AS price_difference,
    CAST(ra + va AS DECIMAL(38,2)) AS total_amount
FROM ({_MG}) m JOIN c_minfo i ON m.member = i.unq_id
WHERE ra IS NOT NULL AND va IS NOT NULL"""
Q["ctgry_price_difference_simple"] = f"""
SELECT ins_show_name, pd_cd, deal_dt,
    round(CAST(vn AS DOUBLE) / CAST(va AS DOUBLE) - CAST(rn AS DOUBLE) / CAST(ra AS DOUBLE), 6) AS price_difference
FROM (SELECT i.ins_show_name, s.pd_cd, s.deal_dt,
        sum({_side('REPO', 'repo_rate * trade_amnt')}) AS rn, sum({_side('REPO', 'trade_amnt')}) AS ra,
        sum({_side('RVRSE', 'repo_rate * trade_amnt')}) AS vn, sum({_side('RVRSE', 'trade_amnt')}) AS va
    FROM rs_priced s JOIN c_minfo i ON s.member = i.unq_id
    GROUP BY i.ins_show_name, s.pd_cd, s.deal_dt) g
WHERE ra IS NOT NULL AND va IS NOT NULL"""

# cash reports
Q["memberid2name"] = "SELECT ip_id AS member_id, ins_show_name AS ctgry_type FROM c_member_cash"
Q["bondinfo"] = "SELECT bond_id, bond_nm, bond_cd, lstng_dt, mrty_dt FROM c_bond4c"

FP = "CAST(sum(dirty_amnt) AS DECIMAL(38,2)) AS full_price"


def _cash_root(keys: list[tuple[str, str]], measures: str, root_name: str = "member_id",
               src: str = CASH_ROLLED) -> str:
    """keys: (expr, name) besides root and participant type."""
    sel = ", ".join(f"{e} AS {n}" for e, n in keys)
    return f"""
SELECT root AS {root_name}, {JT} AS participant_type, {sel}, {measures}
FROM {src} x
{_gs(['root'] + [e for e, _ in keys])}"""


Q["root_deal_amount_trans_info"] = _cash_root(
    [("bond_type4", "bond_type_f"), ("deal_dt", "deal_dt")],
    f"{FP}, {sset('deal_nmbr', '#')} AS deal_number, {scount('deal_nmbr', '#')} AS deal_number_size")
Q["root_counter_party_bond_info"] = _cash_root(
    [("bond_type4", "bond_type_f"), ("deal_dt", "deal_dt")],
    f"{sset('counter', '#')} AS counter_id_set, {scount('counter', '#')} AS counter_id_set_size, {sset('bond_id', '#')} AS bond_id_set, {scount('bond_id', '#')} AS bond_id_set_size")
Q["root_counter_party_number"] = Q["root_counter_party_bond_info"]
Q["root_deal_rows"] = _cash_root(
    [("bond_type4", "bond_type_f"), ("deal_dt", "deal_dt"), ("deal_nmbr", "deal_number")], FP)
Q["root_deal_strategy_info"] = _cash_root(
    [("bond_type4", "bond_type_f"), ("deal_dt", "deal_dt"), ("deal_strategy", "deal_strategy")], FP)

CATS = ("(SELECT d.*, coalesce(b.ins_show_name, 'None') AS buy_cat, coalesce(s.ins_show_name, 'None') AS sell_cat "
        "FROM c_cash d LEFT JOIN c_member_cash b ON d.buy_ip_id = b.ip_id "
        "LEFT JOIN c_member_cash s ON d.sell_ip_id = s.ip_id)")

Q["ctgry_counter_party_buyer"] = f"""
SELECT buy_cat AS ctgry_type, bond_type4 AS bond_type_f, deal_dt, sell_cat AS member_type, {FP},
    {sset('sell_ip_id', '#')} AS member_id_set, {scount('sell_ip_id', '#')} AS member_id_set_size
FROM {CATS} x GROUP BY buy_cat, bond_type4, deal_dt, sell_cat"""
Q["ctgry_counter_party_seller"] = f"""
SELECT sell_cat AS ctgry_type, bond_type4 AS bond_type_f, deal_dt, buy_cat AS member_type, {FP},
    {sset('buy_ip_id', '#')} AS member_id_set, {scount('buy_ip_id', '#')} AS member_id_set_size
FROM {CATS} x GROUP BY sell_cat, bond_type4, deal_dt, buy_cat"""


def _leg(me: str, other: str, other_cat: str) -> str:
    return CASH_ROLLED.replace("FROM cs s", f"""FROM (SELECT {me} AS member, {other} AS counter,
        {other_cat} AS counter_cat, bond_type4, deal_dt, dirty_amnt FROM {CATS} y) s""")


Q["root_counter_party_buyer"] = _cash_root(
    [("bond_type4", "bond_type_f"), ("deal_dt", "deal_dt"), ("counter_cat", "member_type")],
    f"{FP}, {sset('counter', '#')} AS member_id_set, {scount('counter', '#')} AS member_id_set_size", "buyer_id", _leg("buy_ip_id", "sell_ip_id", "sell_cat"))
Q["root_counter_party_seller"] = _cash_root(
    [("bond_type4", "bond_type_f"), ("deal_dt", "deal_dt"), ("counter_cat", "member_type")],
    f"{FP}, {sset('counter', '#')} AS member_id_set, {scount('counter', '#')} AS member_id_set_size", "seller_id", _leg("sell_ip_id", "buy_ip_id", "buy_cat"))
Q["counter_party_buyer"] = f"""
SELECT buy_ip_id AS member_id, bond_type4 AS bond_type_f, deal_dt, sell_cat AS rmember_type,
    buy_cat AS member_type, {sset('sell_ip_id', '#')} AS rmember_id_set, {scount('sell_ip_id', '#')} AS rmember_id_set_size
FROM {CATS} x GROUP BY buy_ip_id, bond_type4, deal_dt, sell_cat, buy_cat"""
Q["counter_party_seller"] = f"""
SELECT sell_ip_id AS member_id, bond_type4 AS bond_type_f, deal_dt, buy_cat AS rmember_type,
    sell_cat AS member_type, {sset('buy_ip_id', '#')} AS rmember_id_set, {scount('buy_ip_id', '#')} AS rmember_id_set_size
FROM {CATS} x GROUP BY sell_ip_id, bond_type4, deal_dt, buy_cat, sell_cat"""

BS_FACE = f"{_bside('BUY', 'face_value')} AS buy_full_price, {_bside('SELL', 'face_value')} AS sell_full_price"
RETURNS = (f"{_bside('BUY', 'dirty_amnt')} AS buy_full_price, {_bside('SELL', 'dirty_amnt')} AS sell_full_price, "
           f"{_bside('BUY', 'face_value')} AS buy_face_price, {_bside('SELL', 'face_value')} AS sell_face_price")
CS_CAT = ("(SELECT s.*, coalesce(m.ins_show_name, 'None') AS ctgry FROM cs s "
          "LEFT JOIN c_member_cash m ON s.member = m.ip_id)")

Q["root_trade_deadline_info"] = f"""
SELECT root AS member_id, bond_id, member AS cmember_id, {JT} AS participant_type, deal_dt,
    bond_type4 AS bond_type_f, mrty_bucket AS yr_of_time_to_mrty_type, {BS_FACE}
FROM {CASH_ROLLED} x
{_gs(['root', 'bond_id', 'member', 'deal_dt', 'bond_type4', 'mrty_bucket'])}"""
Q["ctgry_trade_deadline_info"] = f"""
SELECT ctgry AS ctgry_type, bond_id, deal_dt, bond_type4 AS bond_type_f, mrty_bucket AS yr_of_time_to_mrty_type,
    {BS_FACE}
FROM {CS_CAT} x GROUP BY ctgry, bond_id, deal_dt, bond_type4, mrty_bucket"""
Q["ctgry_bond_set"] = f"""
SELECT member AS member_id, deal_strategy, deal_dt, ctgry AS member_type, {sset('bond_id', '#')} AS bond_id_set, {scount('bond_id', '#')} AS bond_id_set_size
FROM {CS_CAT} x GROUP BY member, deal_strategy, deal_dt, ctgry"""
Q["root_distribution_number"] = _cash_root(
    [("bond_type8", "bond_type_e"), ("deal_strategy", "deal_strategy"), ("deal_dt", "deal_dt")],
    f"{FP}, {sset('bond_id', '#')} AS bond_id_set, {scount('bond_id', '#')} AS bond_id_set_size")
Q["root_bond_deal"] = _cash_root(
    [("bond_type8", "bond_type_e"), ("deal_strategy", "deal_strategy"), ("deal_dt", "deal_dt"),
     ("bond_id", "bond_id")], FP)
Q["ctgry_bond_deal"] = f"""
SELECT member AS member_id, bond_id, bond_type8 AS bond_type_e, deal_strategy, deal_dt, ctgry AS member_type, {FP}
FROM {CS_CAT} x GROUP BY member, bond_id, bond_type8, deal_strategy, deal_dt, ctgry"""
Q["union_info_for_bond_concentration"] = f"""
SELECT member AS member_id, deal_strategy, deal_dt, bond_id, {FP}
FROM cs GROUP BY member, deal_strategy, deal_dt, bond_id"""
Q["base_investment_returns"] = f"""
SELECT member AS member_id, bond_id, deal_dt, bond_type8 AS bond_type_e, {RETURNS}
FROM cs GROUP BY member, bond_id, deal_dt, bond_type8"""
Q["root_investment_returns"] = _cash_root(
    [("bond_id", "bond_id"), ("deal_dt", "deal_dt"), ("bond_type8", "bond_type_e")], RETURNS)
Q["ctgry_investment_returns"] = f"""
SELECT ctgry AS ctgry_type, bond_id, deal_dt, bond_type8 AS bond_type_e, {RETURNS}
FROM {CS_CAT} x GROUP BY ctgry, bond_id, deal_dt, bond_type8"""
Q["root_roi_performance"] = _cash_root(
    [("bond_id", "bond_id"), ("deal_dt", "deal_dt"), ("bond_type4", "bond_type_f")], RETURNS)
Q["root_bond_concentration"] = _cash_root(
    [("bond_id", "bond_id"), ("bond_type4", "bond_type_f"), ("deal_dt", "deal_dt")], FP)
Q["root_term_preference"] = f"""
SELECT root AS member_id, bond_id, member AS cmember_id, {JT} AS participant_type, deal_dt,
    bond_type4 AS bond_type_f, yrs_to_mrty AS yr_of_time_to_mrty, {BS_FACE}
FROM {CASH_ROLLED} x
{_gs(['root', 'bond_id', 'member', 'deal_dt', 'bond_type4', 'yrs_to_mrty'])}"""
Q["ctgry_deal_strategy_info"] = f"""
SELECT buy_cat AS ctgry_type_buy, sell_cat AS ctgry_type_sell, bond_type4 AS bond_type_f, deal_dt,
    deal_strategy, {FP}
FROM (SELECT DISTINCT buy_cat, sell_cat, deal_nmbr, dirty_amnt, bond_type4, deal_dt, deal_strategy FROM {CATS} y) x
GROUP BY buy_cat, sell_cat, bond_type4, deal_dt, deal_strategy"""

# the sets by root as rows, and their sizes without the strings
_K4 = [("bond_type4", "bond_type_f"), ("deal_dt", "deal_dt")]
_KC = _K4 + [("counter_cat", "member_type")]
_K8 = [("bond_type8", "bond_type_e"), ("deal_strategy", "deal_strategy"), ("deal_dt", "deal_dt")]
_BUY, _SELL = _leg("buy_ip_id", "sell_ip_id", "sell_cat"), _leg("sell_ip_id", "buy_ip_id", "buy_cat")
_SETS = {  # report: keys, root's name, rows, sum, [(item, set)]
    "root_deal_amount_trans_info": (_K4, "member_id", CASH_ROLLED, FP, [("deal_nmbr", "deal_number")]),
    "root_counter_party_bond_info": (_K4, "member_id", CASH_ROLLED, "",
                                     [("counter", "counter_id_set"), ("bond_id", "bond_id_set")]),
    "root_counter_party_buyer": (_KC, "buyer_id", _BUY, FP, [("counter", "member_id_set")]),
    "root_counter_party_seller": (_KC, "seller_id", _SELL, FP, [("counter", "member_id_set")]),
    "root_distribution_number": (_K8, "member_id", CASH_ROLLED, FP, [("bond_id", "bond_id_set")]),
}
for _name, (_keys, _root, _src, _sum, _sets) in _SETS.items():
    Q[f"{_name}_items"] = "\nUNION ALL\n".join(_cash_root(
        [*_keys, (_item, "item")], f"'{_set}' AS set_name, count(*) AS n_rows" + (_sum and ", " + _sum), _root, _src)
        for _item, _set in _sets)
    Q[f"{_name}_sizes"] = _cash_root(_keys, ", ".join(
        ([_sum] if _sum else []) + [f"count(DISTINCT {_item}) AS {_set}_size" for _item, _set in _sets]), _root, _src)
_MONTH = "strftime(deal_dt, '%Y-%m')"
Q["root_period_sizes"] = "\nUNION ALL\n".join(_cash_root(
    [("bond_type4", "bond_type_f"), (_MONTH, "month")],
    f"'{_set}' AS set_name, count(DISTINCT {_item}) AS n_items, TRUE AS sketch_agrees")
    for _item, _set in _SETS["root_counter_party_bond_info"][4])


def sql(name: str) -> str:
    """Full runnable statement for one query (shared CTE prelude + body)."""
    body = Q[name].strip()
    prelude = FEEDS + "," + BASE + "," + REPO_SIDES_SQL
    if body.upper().startswith("WITH "):
        return f"WITH {prelude},\n{body[5:]}"
    return f"WITH {prelude}\n{body}"


def all_sql() -> dict[str, str]:
    return {k: sql(k) for k in Q}
