"""Data-quality counts (A11, A12) and the optional effective-dated member
check (W11).

The original jobs counted unmatched lookups in accumulators and logged
sizes. Here each fact is looked up and counted in one pass, and all checks form
one small DataFrame (check, n): global aggregates with map-side partial
counts, no driver-side collection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondmart import labels as L
from bondmart.operators.joins import small
from bondmart.plans import base as B
from bondmart.sources.feeds import Feeds


def _count(df: DataFrame, check: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(check).alias("check"), "n")


def _rows(counts: DataFrame) -> DataFrame:
    """One row of counts as (check, n) rows."""
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("check"), F.col(c).alias("n")) for c in counts.columns])))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_unmatched(f: Feeds) -> DataFrame:
    """Rows dropped or defaulted by each lookup."""
    mct = f.market_close_type_i.filter(F.col("market") == L.PLEDGED_REPO_MARKET).select("ctgry_type_nm")
    no_show = f.member_ctgry_d.join(small(mct), "ctgry_type_nm", "left_anti")
    cur = f.member_d.filter(F.col("efctv_to_dt") == F.lit(L.OPEN_END_DATE).cast("date"))
    no_ctgry = cur.join(small(B.repo_category(f)), "member_ctgry_id", "left_anti")
    no_after = cur.join(small(B.after_hours_category(f)), "member_ctgry_id", "left_anti")
    # repo deals: both parties and the product looked up in one pass over the raw deals
    raw = f.bond_repo_deal_f.filter(
        (F.col("mkt_id") == L.PLEDGED_REPO_MKT_ID) & (F.col("st") != L.CANCELLED_STATUS)
    ).join(B.failed_repo_events(f), "ev_id", "left_anti")
    ids = B.dim_member(f).select("ip_id")
    for side in ("repo", "rvrse"):
        party = ids.select(F.col("ip_id").alias(f"{side}_ip_id"), F.lit(True).alias(f"{side}_known"))
        raw = raw.join(small(party), f"{side}_ip_id", "left")
    product = B.dim_product(f).select("pd_id", F.lit(True).alias("pd_known"))
    raw = raw.join(small(product), "pd_id", "left")
    known = F.col("repo_known").isNotNull() & F.col("rvrse_known").isNotNull()
    repo = raw.agg(
        F.count(F.when(known & F.col("pd_known").isNull(), 1)).alias("repo_deal_without_product"),
        F.count_distinct(F.when(~known, F.col("ev_id"))).alias("repo_deal_unknown_party"))
    cash = B.fact_cash_deal(f).agg(
        F.count(F.when(F.col("bond_type4") == L.NO_BOND_TYPE, 1)).alias("cash_deal_without_bond_type4"),
        F.count(F.when(F.col("bond_type8") == L.NO_BOND_TYPE, 1)).alias("cash_deal_without_bond_type8"))
    return _union([
        _count(no_show, "category_without_display_name"),
        _count(no_ctgry, "member_without_category"),
        _count(no_after, "member_without_cash_category"),
        _rows(repo), _rows(cash),
    ])


def clean_count(f: Feeds) -> DataFrame:
    """Sizes of the cleaned fact tables (one pass each, no extra job per
    count: both are parts of one union)."""
    return _union([
        _count(B.fact_repo_deal(f), "fact_repo_deal"),
        _count(B.fact_cash_deal(f), "fact_cash_deal"),
    ])


def effective_dated_cash_deals(f: Feeds) -> DataFrame:
    """W11 on both parties of the cleaned cash deals."""
    return B.fact_cash_deal(f, versions=B.member_versions(f))
