"""Cleaned base tables shared by all reports.

Dimensions are small and deduplicated on their key; facts stay distributed
and are only ever joined to dimensions (size-checked broadcast) or to other
facts on their own key (shuffle join, AQE skew handling).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondmart import labels as L
from bondmart.functions import scalars as X
from bondmart.operators.intervals import intersection, segments, value_as_of
from bondmart.operators.joins import dedupe_latest, is_small, rating_segments, small
from bondmart.operators.rollup import member_rollup, with_join_type_cash, with_join_type_repo
from bondmart.session import snapshot
from bondmart.sources.feeds import Feeds, dimension, per_feeds


def _open_end() -> F.Column:
    return F.lit(L.OPEN_END_DATE).cast("date")


# ---------------------------------------------------------------- dimensions

@per_feeds
def repo_category(f: Feeds) -> DataFrame:
    """member_ctgry_id -> display name via the pledged-repo closing
    types (two lookups chained, misses dropped)."""
    mct = f.market_close_type_i.filter(F.col("market") == L.PLEDGED_REPO_MARKET).select(
        "ctgry_type_nm", X.strip_paren_suffix("show_name_raw").alias("ins_show_name")
    )
    mct = dedupe_latest(mct, ["ctgry_type_nm"], ["ins_show_name"])
    mcd = f.member_ctgry_d.select("member_ctgry_id", "ctgry_type_nm").join(
        small(mct), "ctgry_type_nm", "inner"
    )
    return dedupe_latest(mcd.select("member_ctgry_id", "ins_show_name"), ["member_ctgry_id"],
                         ["ins_show_name"])


@per_feeds
def after_hours_category(f: Feeds) -> DataFrame:
    """member_ctgry_id -> cash-market display name (paren suffix cut, F1)."""
    a = f.after_hours_bond_type.select(
        "member_ctgry_id", X.strip_paren_suffix("show_name_raw").alias("bond_after_show_name")
    )
    return dedupe_latest(a, ["member_ctgry_id"], ["bond_after_show_name"])


def _current_members(f: Feeds) -> DataFrame:
    """Current version of each member row."""
    return f.member_d.filter(F.col("efctv_to_dt") == _open_end())


@dimension
def dim_member(f: Feeds) -> DataFrame:
    """Repo-job members: current, both display categories resolved.

    One row per ip_id: (ip_id, unq_id, member_ctgry_id, full_nm,
    ins_show_name, bond_after_show_name).
    """
    m = _current_members(f).filter(
        F.col("rt_member_cd").isNotNull() & (F.col("rt_member_cd") != "")
        & F.col("rt_member_full_nm").isNotNull() & (F.col("rt_member_full_nm") != "")
    ).select("ip_id", "unq_id", "member_ctgry_id", "full_nm", "efctv_from_dt")
    m = m.join(small(repo_category(f)), "member_ctgry_id", "inner").join(
        small(after_hours_category(f)), "member_ctgry_id", "inner"
    )
    m = dedupe_latest(m, ["ip_id"], ["efctv_from_dt", "unq_id"])
    return m.select("ip_id", "unq_id", "member_ctgry_id", "full_nm", "ins_show_name",
                    "bond_after_show_name")


@dimension
def member_info(f: Feeds) -> DataFrame:
    """Repo-job member info keyed by unq_id (full name, display category)."""
    return dedupe_latest(dim_member(f), ["unq_id"], ["ip_id"])


@dimension
def dim_member_cash(f: Feeds) -> DataFrame:
    """Cash-job members: current; unresolved category kept as 'None'.

    One row per ip_id: (ip_id, unq_id, ins_show_name).
    """
    m = _current_members(f).select("ip_id", "unq_id", "member_ctgry_id", "efctv_from_dt")
    m = m.join(small(after_hours_category(f)), "member_ctgry_id", "left").withColumn(
        "ins_show_name", F.coalesce(F.col("bond_after_show_name"), F.lit(L.UNRESOLVED))
    )
    m = dedupe_latest(m.select("ip_id", "unq_id", "ins_show_name", "efctv_from_dt"), ["ip_id"],
                      ["efctv_from_dt", "unq_id"])
    return m.select("ip_id", "unq_id", "ins_show_name")


@dimension
def member_id_by_unq(f: Feeds) -> DataFrame:
    """Cash job: unq_id -> member id (J2b), one row per unq_id."""
    return dedupe_latest(dim_member_cash(f).select("unq_id", "ip_id"), ["unq_id"], ["ip_id"])


@dimension
def member_rollup_repo(f: Feeds) -> DataFrame:
    """A9 per member (unq_id): root and participant type (repo rule)."""
    return member_rollup(member_info(f), "unq_id",
                         lambda m: with_join_type_repo(m, dim_root(f), member_info(f)))


@dimension
def member_rollup_cash(f: Feeds) -> DataFrame:
    """A9b + J2b per member (ip_id): root member id and participant type."""
    return member_rollup(dim_member_cash(f), "ip_id",
                         lambda m: with_join_type_cash(m, dim_root(f), dim_member_cash(f),
                                                       by_unq=member_id_by_unq(f)))


@dimension
def dim_root(f: Feeds) -> DataFrame:
    """Slave unq_id -> master unq_id for valid, current relations.

    One level only (a master's own master is not followed).
    """
    valid = f.mstr_slv_rl_tp_rl.filter(
        (F.col("rl_kind") == L.RELATION_KIND_VALID) & F.col("valid_to").startswith(L.OPEN_END_DATE)
    ).select("rl_tp_id")
    rel = f.cim_org_rl.filter(
        (F.col("rl_status") == L.RELATION_STATUS_VALID) & F.col("valid_to").startswith(L.OPEN_END_DATE)
    ).join(small(valid), "rl_tp_id", "left_semi")
    rel = rel.select(F.col("slv_unq_id").alias("unq_id"), F.col("mstr_unq_id").alias("root_unq_id"))
    return dedupe_latest(rel, ["unq_id"], ["root_unq_id"])


def dated_relations(f: Feeds) -> tuple[DataFrame, DataFrame]:
    """The two relation feeds with days: a relation is valid up to the day of
    its ``valid_to``; the dumps name no start, so it is open."""
    start, end = F.lit(None).cast("date").alias("valid_from"), F.to_date(F.substring("valid_to", 1, 10)).alias("valid_to")
    types = f.mstr_slv_rl_tp_rl.select("rl_kind", "rl_tp_id", start, end)
    return types, f.cim_org_rl.select("rl_tp_id", "slv_unq_id", "mstr_unq_id", "rl_status", start, end)


def root_segments(types: DataFrame, organisations: DataFrame) -> DataFrame:
    """J2 + W5 by day: (unq_id, seg_start, seg_end, root_unq_id). A relation
    counts on the days on which both its type and the organisations' row are
    valid; of several on one day the one that began last."""
    types = types.filter(F.col("rl_kind") == L.RELATION_KIND_VALID).select("rl_tp_id", "valid_from", "valid_to")
    rows = organisations.filter(F.col("rl_status") == L.RELATION_STATUS_VALID).select(
        "rl_tp_id", F.col("slv_unq_id").alias("unq_id"), F.col("mstr_unq_id").alias("root_unq_id"), "valid_from", "valid_to")
    return segments(intersection(rows, types, ["rl_tp_id"]), "unq_id", "root_unq_id")


@dimension
def dim_root_segments(f: Feeds) -> DataFrame:
    """The roots of the feeds by day (where ``dim_root`` has the current ones)."""
    return root_segments(*dated_relations(f))


def with_root_as_of(df: DataFrame, segs: DataFrame, member: str = "member", day: str = "deal_dt") -> DataFrame:
    """Add ``root``: the member's root on the row's day, or the member itself."""
    x = value_as_of(df, segs, "unq_id", day, "root_unq_id", F.col(member))
    return x.withColumn("root", F.coalesce("root_unq_id", member)).drop("root_unq_id")


@dimension
def dim_product(f: Feeds) -> DataFrame:
    return dedupe_latest(f.pd_d.select("pd_id", "pd_cd"), ["pd_id"], ["pd_cd"])


@dimension
def dim_bond4(f: Feeds) -> DataFrame:
    """Repo-job bond dimension: (bond_id, bond_ctgry_nm (F2), issr_id (F6))."""
    b = f.bond_d.select(
        "bond_id",
        X.bond_category4("bond_prnt_tp_nm").alias("bond_ctgry_nm"),
        X.issuer_code("issr_id").alias("issr_id"),
    )
    return dedupe_latest(b, ["bond_id"], ["bond_ctgry_nm", "issr_id"])


BOND_CELLS = ["bond_id", "bond_ctgry_nm", "issr_id", "c3", "bond_nm", "bond_cd", "c6", "c7",
              "mrty_dt", "c9", "c10", "c11", "lstng_dt", "bond_prnt_tp_nm"]


def _filled(cols) -> F.Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    return cond


@dimension
def dim_bond4_cash(f: Feeds) -> DataFrame:
    """Cash-job 4-way bond dimension: every cell filled. (bond_id, bond_nm,
    bond_cd, mrty_dt, lstng_dt, bond_type4)."""
    b = f.bond_d.filter(_filled(BOND_CELLS)).select(
        "bond_id", "bond_nm", "bond_cd", "mrty_dt", "lstng_dt",
        X.bond_category4("bond_prnt_tp_nm").alias("bond_type4"),
    )
    return dedupe_latest(b, ["bond_id"], ["bond_nm", "bond_cd", "mrty_dt", "lstng_dt", "bond_type4"])


@dimension
def dim_bond8(f: Feeds) -> DataFrame:
    """Cash-job 8-way bond dimension: first five cells filled. (bond_id,
    bond_type8)."""
    b = f.bond_d.filter(_filled(BOND_CELLS[:5])).select(
        "bond_id", X.bond_category8("bond_ctgry_nm").alias("bond_type8")
    )
    return dedupe_latest(b, ["bond_id"], ["bond_type8"])


@dimension
def dim_rating(f: Feeds) -> DataFrame:
    """F5 + A8: (bond_id, start, end, rtng_rank, rtng_desc), the lowest
    rating among records of one bond and interval."""
    r = f.ri_credit_rtng.select(
        "bond_id", "rtng_start_dt", "rtng_end_dt", X.rating_rank("rtng_raw").alias("rtng_rank")
    )
    r = r.groupBy("bond_id", "rtng_start_dt", "rtng_end_dt").agg(F.min("rtng_rank").alias("rtng_rank"))
    return r.withColumn("rtng_desc", X.rating_label("rtng_rank"))


@dimension
def dim_rating_segments(f: Feeds) -> DataFrame:
    """J6 prepared: non-overlapping rating segments per bond."""
    return rating_segments(dim_rating(f))


# ---------------------------------------------------------------- facts

@per_feeds
def failed_repo_events(f: Feeds) -> DataFrame:
    """W4 + F7: event ids of failed pledged-repo settlements."""
    return f.trdx_deal_infrmn_rmv_d.filter(
        (F.col("rmv_kind") == L.FAILED_KIND) & (F.col("rmv_reason") == L.FAILED_REASON)
        & (F.col("mkt_id") == L.PLEDGED_REPO_MKT_ID)
    ).select(X.event_id("deal_suffix").alias("ev_id"))


@dimension
def member_versions(f: Feeds) -> DataFrame:
    """The days of each version of a member (ip_id, efctv_from_dt, efctv_to_dt)."""
    return f.member_d.select("ip_id", "efctv_from_dt", "efctv_to_dt").distinct()


@per_feeds
def failed_cash_deals(f: Feeds) -> DataFrame:
    """W4 for the cash job (any market): bond deal ids."""
    return f.trdx_deal_infrmn_rmv_d.filter(
        (F.col("rmv_kind") == L.FAILED_KIND) & (F.col("rmv_reason") == L.FAILED_REASON)
    ).select(F.col("deal_suffix").alias("bond_deal_id"))


@per_feeds
def failed_cash_ids(f: Feeds) -> DataFrame:
    """``failed_cash_deals`` for the anti join of the deals. They are few, which the size of
    their feed doesn't show: if that is too large for a broadcast they are written
    once, and the join goes by the size of what was written."""
    ids = failed_cash_deals(f).distinct()
    return ids if is_small(ids) else snapshot(ids, "failed_cash_ids")


@per_feeds
def interbank_deals(f: Feeds) -> DataFrame:
    """Deal numbers flagged interbank."""
    return f.dps_v_cr_dep_txn_dtl.filter(F.col("dep_flag") == L.INTERBANK_FLAG).select("deal_nmbr")


@per_feeds
def fact_repo_deal(f: Feeds, members: DataFrame | None = None, market: str | None = L.PLEDGED_REPO_MKT_ID,
                   drop_failed: bool = True) -> DataFrame:
    """Cleaned repo deals (W2, W3, J3, W9 + party lookup). ``market``: the
    market id kept (None: all); ``drop_failed``: without failed settlements.

    (ev_id, repo_unq_id, rvrse_unq_id, pd_id, deal_nmbr, st, deal_dt,
    repo_rate, trade_amnt)
    """
    members = dim_member(f) if members is None else members
    d = f.bond_repo_deal_f.filter(F.col("st") != L.CANCELLED_STATUS)
    if market is not None:
        d = d.filter(F.col("mkt_id") == market)
    if drop_failed:  # failed settlements are few; AQE broadcasts them when they are
        d = d.join(failed_repo_events(f), "ev_id", "left_anti")
    ids = members.select("ip_id", "unq_id")
    d = d.join(small(ids.select(F.col("ip_id").alias("repo_ip_id"), F.col("unq_id").alias("repo_unq_id"))),
               "repo_ip_id", "inner")
    d = d.join(small(ids.select(F.col("ip_id").alias("rvrse_ip_id"), F.col("unq_id").alias("rvrse_unq_id"))),
               "rvrse_ip_id", "inner")
    return d.select("ev_id", "repo_unq_id", "rvrse_unq_id", "pd_id", "deal_nmbr", "st", "deal_dt",
                    "repo_rate", "trade_amnt")


@per_feeds
def fact_repo_deal_priced(f: Feeds, deals: DataFrame | None = None) -> DataFrame:
    """+ product code, W6 (reported products only)."""
    deals = fact_repo_deal(f) if deals is None else deals
    return deals.join(small(dim_product(f)), "pd_id", "inner").filter(
        F.col("pd_cd").isin(*L.REPORTED_PRODUCTS)
    )


@per_feeds
def collateral_ratio(f: Feeds) -> tuple[DataFrame, DataFrame]:
    """Distinct (ev_id, bond, haircut, face) rows and each deal's face
    total: returns (rows, totals) with totals = (ev_id, sum_face). Dedupe and total
    are grouped aggregates, so one deal with very many pledged rows is
    combined map-side; the join back on ev_id is AQE skew-join eligible.
    """
    c = f.ev_cltrl_dtls.select("ev_id", "bond_id", "cnvrsn_prprtn", "face_value").dropDuplicates()
    tot = c.groupBy("ev_id").agg(F.sum("face_value").alias("sum_face"))
    return c, tot


@per_feeds
def fact_repo_collateral(f: Feeds, deals: DataFrame | None = None) -> DataFrame:
    """J5 + A7 + P2: one row per deal and pledged bond.

    (ev_id, repo_unq_id, rvrse_unq_id, deal_dt, trade_amnt, bond_id,
    cnvrsn_prprtn, alloc) with alloc = ratio * amount kept in whole 1e-4
    units (DECIMAL(x,4)); ratio = face / Σface, or the raw face when
    Σface < 1e-9.
    """
    deals = fact_repo_deal(f) if deals is None else deals
    rows, tot = collateral_ratio(f)
    d = deals.select("ev_id", "repo_unq_id", "rvrse_unq_id", "deal_dt", "trade_amnt").join(
        tot, "ev_id", "inner"
    )
    x = d.join(rows, "ev_id", "inner")
    face = F.col("face_value").cast("double")
    ratio = F.when(
        F.col("sum_face") < F.lit(L.ZERO_FACE_EPS).cast("decimal(18,9)"), face
    ).otherwise(face / F.col("sum_face").cast("double"))
    units = F.floor(ratio * F.col("trade_amnt").cast("double") * F.lit(10000.0) + F.lit(0.5))
    alloc = (units.cast("decimal(18,0)") * F.lit(0.0001).cast("decimal(4,4)")).cast("decimal(23,4)")
    return x.select(
        "ev_id", "repo_unq_id", "rvrse_unq_id", "deal_dt", "trade_amnt", "bond_id",
        "cnvrsn_prprtn", alloc.alias("alloc"),
    )


def effective_dated(df: DataFrame, members: DataFrame, id_col: str, date_col: str = "deal_dt") -> DataFrame:
    """Keep rows whose member id has a version with from < date < to
    (both strict). Equi-join on the id plus a range residual, semi join."""
    m = members.select(F.col("ip_id").alias("_ip"), "efctv_from_dt", "efctv_to_dt")
    cond = ((F.col(id_col) == F.col("_ip")) & (F.col(date_col) > F.col("efctv_from_dt"))
            & (F.col(date_col) < F.col("efctv_to_dt")))
    return df.join(small(m), cond, "left_semi")


@dimension
def cash_parties(f: Feeds) -> DataFrame:
    """What reports look up by a party of a cash deal: (ip_id, cat, root, join_type), a row per member."""
    rollup = member_rollup_cash(f).withColumnRenamed("member", "ip_id")
    return dim_member_cash(f).select("ip_id", F.col("ins_show_name").alias("cat")).join(small(rollup), "ip_id", "left")


FACT_CASH = ("bond_deal_id", "buy_ip_id", "sell_ip_id", "deal_strategy", "deal_nmbr", "deal_dt", "bond_type4", "crncy",
             "trade_amnt", "dirty_amnt", "face_value", "yrs_to_mrty", "bond_id", "bond_type8", "mrty_bucket")
CASH_PARTIES = (("buy", "buy_ip_id"), ("sell", "sell_ip_id"))
OF_PARTY = ("cat", "root", "join_type")


def _clean_cash_deals(f: Feeds, members: DataFrame, versions: DataFrame | None = None) -> DataFrame:
    """The rows of ``fact_cash_deal``, with the columns of ``members`` beside its
    ip_id as buy_... and sell_.... Members that are broadcast are checked first; else
    the joins by deal come first, after which rows need no deal number in the members' shuffles."""
    d = f.bond_deal.withColumn("crncy", X.trim_currency("crncy")).filter(
        (F.col("st") != L.CANCELLED_STATUS) & F.col("crncy").isin(*L.CASH_CURRENCIES)
    )
    of_party = [c for c in members.columns if c != "ip_id"]

    def of_members(d: DataFrame) -> DataFrame:
        for side, party in CASH_PARTIES:
            own = members.select(F.col("ip_id").alias(party), *[F.col(c).alias(f"{side}_{c}") for c in of_party])
            d = d.join(small(own), party, "inner" if of_party else "left_semi")
            if versions is not None:
                d = effective_dated(d, versions, party)
        return d

    def by_deal(d: DataFrame) -> DataFrame:
        d = d.join(small(failed_cash_ids(f)), "bond_deal_id", "left_anti")
        strat = f.dps_v_cbt_all_txn_dtl.groupBy("deal_nmbr").agg(F.max("match_status").alias("match_status"))
        return d.join(strat, "deal_nmbr", "left")

    for step in (of_members, by_deal) if is_small(members) else (by_deal, of_members):
        d = step(d)
    # one row a bond, as the planner can see: it leaves out a lookup that a report doesn't use
    for bonds in (dim_bond4_cash(f).select("bond_id", "bond_type4"), dim_bond8(f)):
        d = d.join(small(bonds.dropDuplicates(["bond_id"])), "bond_id", "left")
    derived = {
        "deal_strategy": X.deal_strategy("match_status"), "mrty_bucket": X.maturity_bucket("yrs_to_mrty"),
        "bond_type4": F.coalesce("bond_type4", F.lit(L.NO_BOND_TYPE)), "bond_type8": F.coalesce("bond_type8", F.lit(L.NO_BOND_TYPE))}
    return d.select(*[derived[c].alias(c) if c in derived else c for c in FACT_CASH],
                    *[f"{side}_{c}" for side, _ in CASH_PARTIES for c in of_party])


@per_feeds
def fact_cash_deal(f: Feeds, members: DataFrame | None = None, versions: DataFrame | None = None) -> DataFrame:
    """Cleaned cash-bond deals (W3, W7, J9, J3, F8, F2/F3/F4 lookups). ``versions``:
    keep only deals on a day strictly within a version of both members (W11); a
    party's versions are checked where it is checked as a member, by the same key.

    (bond_deal_id, buy_ip_id, sell_ip_id, deal_strategy, deal_nmbr, deal_dt,
    bond_type4, crncy, trade_amnt, dirty_amnt, face_value, yrs_to_mrty,
    bond_id, bond_type8, mrty_bucket)
    """
    members = dim_member_cash(f) if members is None else members
    return _clean_cash_deals(f, members.select("ip_id"), versions)


@per_feeds
def _party_deals(f: Feeds) -> DataFrame:
    return _clean_cash_deals(f, cash_parties(f).select("ip_id", *OF_PARTY))


def party_deals(f: Feeds) -> DataFrame | None:
    """``fact_cash_deal`` with the category, root and participant type of both parties
    (buy_cat, ...), looked up where a party is checked as a member, so that the
    deals are shuffled once for it and their sides not at all. None if
    that saves nothing: members are broadcast, or the run has stored the fact."""
    stored = hasattr(f.__dict__.get("_memo", {}).get("fact_cash_deal"), "_bm_path")
    return None if stored or is_small(dim_member_cash(f)) else _party_deals(f)
