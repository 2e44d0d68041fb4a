"""Input feeds: typed layout of each reference feed and the container.

Every feed is a DataFrame with the named, typed columns listed in
``LAYOUTS``. Two producers exist: ``sources.csvfeeds`` (raw CSV dumps in the
original positional layout) and ``sources.testviews`` (the driver's parquet
tables mapped onto the feeds). Plans only ever see ``Feeds``.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame

S, D = "string", "date"
AMT, RATE, HAIRCUT = "decimal(18,2)", "decimal(18,6)", "decimal(9,6)"

# feed -> positional columns (name, type); the CSV arity is len(columns).
# ``required``: positions that must be non-empty (None = all).
LAYOUTS: dict[str, dict] = {
    "pd_d": {"columns": [("pd_id", S), ("pd_cd", S)]},
    "market_close_type_i": {
        "columns": [("market", S), ("ctgry_type_nm", S), ("show_name_raw", S)]
    },
    "member_ctgry_d": {"columns": [("member_ctgry_id", S), ("ctgry_type_nm", S)]},
    "after_hours_bond_type": {"columns": [("show_name_raw", S), ("member_ctgry_id", S)]},
    "member_d": {
        "columns": [
            ("ip_id", S), ("member_ctgry_id", S), ("member_cd", S), ("full_nm", S),
            ("rt_member_cd", S), ("rt_member_full_nm", S), ("efctv_from_dt", D),
            ("efctv_to_dt", D), ("unq_id", S), ("c9", S),
        ],
        # the cash job lets the root code and name be empty; the repo job
        # additionally requires them (plans.base.dim_member)
        "required": [0, 1, 2, 3, 6, 7, 8, 9],
    },
    "mstr_slv_rl_tp_rl": {
        "columns": [("rl_kind", S), ("rl_tp_id", S), ("valid_to", S), ("c3", S)]
    },
    "cim_org_rl": {
        "columns": [
            ("rl_tp_id", S), ("slv_unq_id", S), ("mstr_unq_id", S), ("rl_status", S),
            ("valid_to", S), ("c5", S),
        ]
    },
    "trdx_deal_infrmn_rmv_d": {
        "columns": [
            ("rmv_kind", S), ("rmv_reason", S), ("mkt_id", S), ("deal_suffix", S), ("c4", S),
        ]
    },
    "bond_repo_deal_f": {
        "columns": [
            ("ev_id", S), ("repo_ip_id", S), ("rvrse_ip_id", S), ("pd_id", S),
            ("deal_nmbr", S), ("st", S), ("deal_dt", D), ("repo_rate", RATE),
            ("trade_amnt", AMT), ("mkt_id", S), ("c10", S),
        ]
    },
    "bond_d": {
        "columns": [
            ("bond_id", S), ("bond_ctgry_nm", S), ("issr_id", S), ("c3", S), ("bond_nm", S),
            ("bond_cd", S), ("c6", S), ("c7", S), ("mrty_dt", S), ("c9", S), ("c10", S),
            ("c11", S), ("lstng_dt", S), ("bond_prnt_tp_nm", S),
        ],
        # nothing required at load; the 4-way dim needs every cell, the 8-way
        # dim the first five (plans.base.dim_bond4_cash, dim_bond8)
        "required": [],
    },
    "ri_credit_rtng": {
        "columns": [
            ("bond_id", S), ("rtng_raw", S), ("rtng_start_dt", D), ("rtng_end_dt", D), ("c4", S),
        ]
    },
    "dps_v_cr_dep_txn_dtl": {"columns": [("deal_nmbr", S), ("dep_flag", S)]},
    "ev_cltrl_dtls": {
        "columns": [
            ("bond_id", S), ("ev_id", S), ("cnvrsn_prprtn", HAIRCUT), ("face_value", AMT),
            ("c4", S),
        ]
    },
    "bond_deal": {
        "columns": [
            ("bond_deal_id", S), ("buy_ip_id", S), ("sell_ip_id", S), ("deal_nmbr", S),
            ("deal_dt", D), ("st", S), ("bond_id", S), ("crncy", S), ("trade_amnt", AMT),
            ("dirty_amnt", AMT), ("face_value", AMT), ("yrs_to_mrty", RATE), ("c12", S),
            ("c13", S), ("c14", S),
        ],
        "required": list(range(12)),
    },
    "dps_v_cbt_all_txn_dtl": {"columns": [("deal_nmbr", S), ("match_status", S)]},
}


@dataclass
class Feeds:
    """All input feeds of both jobs as typed DataFrames."""

    pd_d: DataFrame
    market_close_type_i: DataFrame
    member_ctgry_d: DataFrame
    after_hours_bond_type: DataFrame
    member_d: DataFrame
    mstr_slv_rl_tp_rl: DataFrame
    cim_org_rl: DataFrame
    trdx_deal_infrmn_rmv_d: DataFrame
    bond_repo_deal_f: DataFrame
    bond_d: DataFrame
    ri_credit_rtng: DataFrame
    dps_v_cr_dep_txn_dtl: DataFrame
    ev_cltrl_dtls: DataFrame
    bond_deal: DataFrame
    dps_v_cbt_all_txn_dtl: DataFrame

    @classmethod
    def names(cls) -> list[str]:
        return [f.name for f in fields(cls)]

    def derive(self, **feeds: DataFrame) -> Feeds:
        """These feeds with some fact feeds replaced; dimensions already
        built are shared, derived facts are not."""
        out = replace(self, **feeds)
        memo = self.__dict__.get("_memo", {})
        out.__dict__["_memo"] = {k: v for k, v in memo.items() if k in DIMENSIONS}
        return out


#: names of the tables built by ``dimension``
DIMENSIONS: set[str] = set()


def dimension(fn):
    """A bounded dimension derived from the feeds: memoized per feed set and
    snapshotted (checkpointed) once, then shared by every report."""
    from bondmart.session import snapshot

    def build(f: Feeds):
        return snapshot(fn(f), fn.__name__)

    build.__name__ = fn.__name__
    build.__doc__ = fn.__doc__
    DIMENSIONS.add(fn.__name__)
    return per_feeds(build)


def per_feeds(fn):
    """Memoize a derived table on its Feeds object: one DataFrame (one plan,
    one size check) per dimension per feed set, however many joins use it."""

    def wrapper(f: Feeds, *args, **kwargs):
        if args or kwargs:
            return fn(f, *args, **kwargs)
        memo = f.__dict__.setdefault("_memo", {})
        if fn.__name__ not in memo:
            memo[fn.__name__] = fn(f)
        return memo[fn.__name__]

    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper
