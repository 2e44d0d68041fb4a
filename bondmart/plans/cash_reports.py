"""Cash-bond reports: one lazy DataFrame per output table.

Most tables are one call of ``_report``: side-unpivoted deals (buy leg and
sell leg, from a shared grain), optional root roll-up or category lookup, one groupBy with sums
and sorted sets. Buy/sell tables that the original job built with a full
outer join of a buy aggregate and a sell aggregate (J8) are the same
groupBy with side-conditional sums defaulting to 0. Every set has its size beside it;
sets by root are rows first (``SetTable``) and strings only on request.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bondmart import labels as L
from bondmart.functions import scalars as X
from bondmart.operators.joins import distinct_rows, tasks_for
from bondmart.operators.rollup import (
    CASH_TYPES, period_sizes, rollup_agg, rollup_items, rollup_sizes, rollup_strings, set_arrays, set_sizes, with_category,
)
from bondmart.plans import base as B
from bondmart.plans.grains import cash_sides, deal_sides, grain, is_stored, rooted_sides
from bondmart.sources.feeds import Feeds

BUY, SELL = L.SIDE_BUY, L.SIDE_SELL
SEP = L.CASH_SET_SEP
TASK_BYTES = 4 << 20  # of the deals' files (compressed) whose sides one task combines


def _cat(df: DataFrame, f: Feeds, member: str, out: str) -> DataFrame:
    """Member id -> cash display category ('None' if unresolved)."""
    return with_category(df, B.dim_member_cash(f), member, out, key="ip_id", how="left",
                         default=L.UNRESOLVED)


def _sides_by_ctgry(f: Feeds) -> DataFrame:
    """Sides of the deals with the member's category (``ctgry``)."""
    d = rooted_sides(f)
    return d.drop("root", "join_type") if "ctgry" in d.columns else _cat(d, f, "member", "ctgry")


def _sum(df: DataFrame, c: str) -> Column:
    return X.exact_sum(c, df.schema[c].dataType).cast("decimal(38,2)")


def _set(c, name: str) -> list[Column]:
    """A set as a string, and its size."""
    return _named_set(F.collect_set(c), name)


def _named_set(items: Column, name: str) -> list[Column]:
    return [X.set_to_string(items, SEP).alias(name), F.size(items).cast("long").alias(f"{name}_size")]


def _of_side(side: str, c: str) -> str:
    return f"{side.lower()}_{c}"


def _side_sum(df: DataFrame, side: str, c: str) -> Column:
    return F.coalesce(_sum(df, _of_side(side, c)), F.lit(0)).cast("decimal(38,2)")


def _report(df: DataFrame, keys: Sequence[tuple[str, str]], measures: Sequence[Column]) -> DataFrame:
    """groupBy(keys).agg(measures) with output names: keys = [(col, name)]. A
    member's root, where rows carry it, goes along as a key: it changes no group,
    and lets a grain laid out by root aggregate in place."""
    cols, names = [k for k, _ in keys], [n for _, n in keys]
    place = ["root"] if "member" in cols and "root" in df.columns else []
    g = df.groupBy(*place, *cols).agg(*measures)
    return g.select(*[F.col(k).alias(n) for k, n in keys],
                    *[c for c in g.columns if c not in place + cols and c not in names])


def _tasks(f: Feeds, df: DataFrame) -> int | None:
    """Tasks to combine sides in that carry their root, as many as the deals' files ask for; a
    stored grain stays where it is. A task holds its rows several times (partial and
    final aggregates, sets), so it must not take what adaptive execution would put together."""
    return tasks_for(f.bond_deal, TASK_BYTES) if "root" in df.columns and not is_stored(f, "grain_cash") else None


def _root_report(f: Feeds, df: DataFrame, keys: Sequence[tuple[str, str]], sums: Sequence[tuple]) -> DataFrame:
    """A report by root and participant type. sums = [(side or None,
    col, name)], a side's sum being 0 without deals."""
    cols = [k for k, _ in keys]
    g = rollup_agg(df, B.member_rollup_cash(f), cols, {n: F.col(_of_side(side, c) if side else c) for side, c, n in sums},
                   types=CASH_TYPES, tasks=_tasks(f, df) if "bond_id" in cols else None)
    out = [F.col(k).alias(n) for k, n in keys]
    for side, _, n in sums:
        out.append((F.coalesce(F.col(n), F.lit(0)) if side else F.col(n)).cast("decimal(38,2)").alias(n))
    return g.select(*out)


@dataclass(frozen=True)
class SetTable:
    """A4 + A9b: a report by root whose columns are distinct sets. ``rows``:
    the deals' sides; keys = [(col, name)], sums and sets = [(col, name)]."""

    rows: Callable[[Feeds], DataFrame]
    keys: tuple[tuple[str, str], ...]
    sums: tuple[tuple[str, str], ...]
    sets: tuple[tuple[str, str], ...]
    count: str | None = None  # deals that a row stands for

    def _rolled(self, f: Feeds, way: Callable[..., DataFrame], **how) -> DataFrame:
        rows = self.rows(f)
        if "text" in how or way is rollup_sizes:
            how["tasks"] = _tasks(f, rows)
        return way(rows, B.member_rollup_cash(f), [k for k, _ in self.keys],
                   {n: F.col(c) for c, n in self.sums}, {n: F.col(c) for c, n in self.sets}, types=CASH_TYPES, **how)

    def items(self, f: Feeds, place: Sequence[str | Column | int] = ()) -> DataFrame:
        """The sets as rows: keys, set_name, item, n_rows and sums; the sums
        stand on the rows of the first set. ``place``: see ``items_apart``."""
        g = self._rolled(f, rollup_items, count=F.col(self.count) if self.count else None, place=place)
        return g.select(*[F.col(k).alias(n) for k, n in self.keys], "set_name", "item", "n_rows",
                        *[F.col(n).cast("decimal(38,2)").alias(n) for _, n in self.sums])

    def _names(self) -> tuple[list[str], list[str], list[str]]:
        return [n for _, n in self.keys], [n for _, n in self.sums], [n for _, n in self.sets]

    def sizes(self, items: DataFrame) -> DataFrame:
        """The report without set strings: exact sizes from the item rows."""
        keys, sums, sets = self._names()
        return set_sizes(items, keys, sums, sets).select(
            *keys, *[F.col(n).cast("decimal(38,2)").alias(n) for n in sums], *[f"{n}_size" for n in sets])

    def strings(self, items: DataFrame) -> DataFrame:
        """The report as the original job wrote it, built on request."""
        keys, sums, sets = self._names()
        return set_arrays(items, keys, sums, sets).select(
            *keys, *[F.col(n).cast("decimal(38,2)").alias(n) for n in sums],
            *[c for n in sets for c in (X.set_to_string(F.col(n), SEP).alias(n), F.col(f"{n}_size"))])

    def report(self, f: Feeds, strings: bool = True) -> DataFrame:
        """The report from the deals at once: sizes counted before the fan-out, or
        the items of a row brought together before it."""
        keys, sums, sets = self._names()
        if strings:
            g = self._rolled(f, rollup_strings, text=lambda items: X.set_to_string(items, SEP))
            held = [c for n in sets for c in (n, f"{n}_size")]
        else:
            g, held = self._rolled(f, rollup_sizes), [f"{n}_size" for n in sets]
        return g.select(*[F.col(k).alias(n) for k, n in self.keys],
                        *[F.col(n).cast("decimal(38,2)").alias(n) for n in sums], *held)

    def period_sizes(self, items: DataFrame, period: Column, name: str) -> DataFrame:
        """Exact distinct items of each set over ``period``, and the estimate
        that the merged sketches of the days give."""
        keys = [n for n in self._names()[0] if n not in ("deal_dt", name)]
        return period_sizes(items.withColumn(name, period), [*keys, name, "set_name"], "deal_dt")


# ------------------------------------------------------------------ tables

def memberid2name(f: Feeds) -> DataFrame:
    m = B.dim_member_cash(f)
    return m.select(F.col("ip_id").alias("member_id"), F.col("ins_show_name").alias("ctgry_type"))


def bondinfo(f: Feeds) -> DataFrame:
    return B.dim_bond4_cash(f).select("bond_id", "bond_nm", "bond_cd", "lstng_dt", "mrty_dt")


ROOT_KEYS4 = [("root", "member_id"), ("join_type", "participant_type"), ("bond_type4", "bond_type_f"),
              ("deal_dt", "deal_dt")]


def root_deal_rows(f: Feeds) -> DataFrame:
    """The deal numbers of ``root_deal_amount_trans_info`` as rows."""
    keys = ROOT_KEYS4 + [("deal_nmbr", "deal_number")]
    return _root_report(f, deal_sides(f), keys, [(None, "dirty_amnt", "full_price")])


def root_deal_strategy_info(f: Feeds) -> DataFrame:
    return _root_report(f, rooted_sides(f), ROOT_KEYS4 + [("deal_strategy", "deal_strategy")],
                        [(None, "dirty_amnt", "full_price")])


def _with_cats(d: DataFrame, f: Feeds) -> DataFrame:
    d = _cat(d, f, "buy_ip_id", "buy_cat")
    return _cat(d, f, "sell_ip_id", "sell_cat")


def _deals_with_cats(f: Feeds) -> DataFrame:
    deals = B.party_deals(f)
    return _with_cats(B.fact_cash_deal(f), f) if deals is None else deals


def _pairs(f: Feeds) -> DataFrame:
    deals = None if is_stored(f, "grain_cash_pair") else B.party_deals(f)
    if deals is None:
        return _with_cats(grain(f, "grain_cash_pair"), f)
    return deals.withColumn("n", F.lit(1).cast("long"))


def ctgry_counter_party_buyer(f: Feeds) -> DataFrame:
    d = _pairs(f)
    return _report(d,
                   [("buy_cat", "ctgry_type"), ("bond_type4", "bond_type_f"), ("deal_dt", "deal_dt"),
                    ("sell_cat", "member_type")],
                   [_sum(d, "dirty_amnt").alias("full_price"), *_set("sell_ip_id", "member_id_set")])


def ctgry_counter_party_seller(f: Feeds) -> DataFrame:
    d = _pairs(f)
    return _report(d,
                   [("sell_cat", "ctgry_type"), ("bond_type4", "bond_type_f"), ("deal_dt", "deal_dt"),
                    ("buy_cat", "member_type")],
                   [_sum(d, "dirty_amnt").alias("full_price"), *_set("buy_ip_id", "member_id_set")])


def _one_leg(f: Feeds, leg: str) -> DataFrame:
    """Deals of one leg (member = buyer or seller) with the other party's
    category."""
    d = _pairs(f)
    me, other, other_cat = (("buy_ip_id", "sell_ip_id", "sell_cat") if leg == BUY
                            else ("sell_ip_id", "buy_ip_id", "buy_cat"))
    own = [F.col(f"{leg.lower()}_{c}").alias(c) for c in ("root", "join_type") if f"{leg.lower()}_{c}" in d.columns]
    return d.select(F.col(me).alias("member"), F.col(other).alias("counter"),
                    F.col(other_cat).alias("counter_cat"), "bond_type4", "deal_dt", "dirty_amnt", "n", *own)


def counter_party_buyer(f: Feeds) -> DataFrame:
    return _report(_pairs(f),
                   [("buy_ip_id", "member_id"), ("bond_type4", "bond_type_f"), ("deal_dt", "deal_dt"),
                    ("sell_cat", "rmember_type"), ("buy_cat", "member_type")],
                   [*_set("sell_ip_id", "rmember_id_set")])


def counter_party_seller(f: Feeds) -> DataFrame:
    return _report(_pairs(f),
                   [("sell_ip_id", "member_id"), ("bond_type4", "bond_type_f"), ("deal_dt", "deal_dt"),
                    ("buy_cat", "rmember_type"), ("sell_cat", "member_type")],
                   [*_set("buy_ip_id", "rmember_id_set")])


def _buy_sell(df: DataFrame, c: str, names=("buy_full_price", "sell_full_price")) -> list:
    return [_side_sum(df, BUY, c).alias(names[0]), _side_sum(df, SELL, c).alias(names[1])]


FACE_SIDES = [(BUY, "face_value", "buy_full_price"), (SELL, "face_value", "sell_full_price")]
RETURNS = [(BUY, "dirty_amnt", "buy_full_price"), (SELL, "dirty_amnt", "sell_full_price"),
           (BUY, "face_value", "buy_face_price"), (SELL, "face_value", "sell_face_price")]


def root_trade_deadline_info(f: Feeds) -> DataFrame:
    """Face value bought / sold (the columns are named full price)."""
    return _root_report(f, rooted_sides(f),
                   [("root", "member_id"), ("bond_id", "bond_id"), ("member", "cmember_id"),
                    ("join_type", "participant_type"), ("deal_dt", "deal_dt"), ("bond_type4", "bond_type_f"),
                    ("mrty_bucket", "yr_of_time_to_mrty_type")],
                   FACE_SIDES)


def ctgry_trade_deadline_info(f: Feeds) -> DataFrame:
    d = _sides_by_ctgry(f)
    return _report(d,
                   [("ctgry", "ctgry_type"), ("bond_id", "bond_id"), ("deal_dt", "deal_dt"),
                    ("bond_type4", "bond_type_f"), ("mrty_bucket", "yr_of_time_to_mrty_type")],
                   _buy_sell(d, "face_value"))


def ctgry_bond_set(f: Feeds) -> DataFrame:
    return _report(_sides_by_ctgry(f),
                   [("member", "member_id"), ("deal_strategy", "deal_strategy"), ("deal_dt", "deal_dt"),
                    ("ctgry", "member_type")],
                   [*_set("bond_id", "bond_id_set")])


def root_bond_deal(f: Feeds) -> DataFrame:
    return _root_report(f, rooted_sides(f),
                   [("root", "member_id"), ("join_type", "participant_type"), ("bond_type8", "bond_type_e"),
                    ("deal_strategy", "deal_strategy"), ("deal_dt", "deal_dt"), ("bond_id", "bond_id")],
                   [(None, "dirty_amnt", "full_price")])


def ctgry_bond_deal(f: Feeds) -> DataFrame:
    """Keyed by member in spite of its name."""
    d = _sides_by_ctgry(f)
    return _report(d,
                   [("member", "member_id"), ("bond_id", "bond_id"), ("bond_type8", "bond_type_e"),
                    ("deal_strategy", "deal_strategy"), ("deal_dt", "deal_dt"), ("ctgry", "member_type")],
                   [_sum(d, "dirty_amnt").alias("full_price")])


def union_info_for_bond_concentration(f: Feeds) -> DataFrame:
    d = cash_sides(f)
    return _report(d,
                   [("member", "member_id"), ("deal_strategy", "deal_strategy"), ("deal_dt", "deal_dt"),
                    ("bond_id", "bond_id")],
                   [_sum(d, "dirty_amnt").alias("full_price")])


def _returns(df: DataFrame) -> list:
    return _buy_sell(df, "dirty_amnt") + _buy_sell(df, "face_value", ("buy_face_price", "sell_face_price"))


def base_investment_returns(f: Feeds) -> DataFrame:
    d = cash_sides(f)
    return _report(d,
                   [("member", "member_id"), ("bond_id", "bond_id"), ("deal_dt", "deal_dt"),
                    ("bond_type8", "bond_type_e")],
                   _returns(d))


def root_investment_returns(f: Feeds) -> DataFrame:
    return _root_report(f, rooted_sides(f),
                   [("root", "member_id"), ("join_type", "participant_type"), ("bond_id", "bond_id"),
                    ("deal_dt", "deal_dt"), ("bond_type8", "bond_type_e")],
                   RETURNS)


def ctgry_investment_returns(f: Feeds) -> DataFrame:
    d = _sides_by_ctgry(f)
    return _report(d,
                   [("ctgry", "ctgry_type"), ("bond_id", "bond_id"), ("deal_dt", "deal_dt"),
                    ("bond_type8", "bond_type_e")],
                   _returns(d))


def root_roi_performance(f: Feeds) -> DataFrame:
    return _root_report(f, rooted_sides(f),
                   [("root", "member_id"), ("join_type", "participant_type"), ("bond_id", "bond_id"),
                    ("deal_dt", "deal_dt"), ("bond_type4", "bond_type_f")],
                   RETURNS)


def root_bond_concentration(f: Feeds) -> DataFrame:
    return _root_report(f, rooted_sides(f),
                   [("root", "member_id"), ("join_type", "participant_type"), ("bond_id", "bond_id"),
                    ("bond_type4", "bond_type_f"), ("deal_dt", "deal_dt")],
                   [(None, "dirty_amnt", "full_price")])


def root_term_preference(f: Feeds) -> DataFrame:
    return _root_report(f, rooted_sides(f),
                   [("root", "member_id"), ("bond_id", "bond_id"), ("member", "cmember_id"),
                    ("join_type", "participant_type"), ("deal_dt", "deal_dt"), ("bond_type4", "bond_type_f"),
                    ("yrs_to_mrty", "yr_of_time_to_mrty")],
                   FACE_SIDES)


def ctgry_deal_strategy_info(f: Feeds) -> DataFrame:
    """Distinct projection first (two lines of one deal number with the
    same amount and classes count once), then the sum."""
    d = distinct_rows(_deals_with_cats(f).select("buy_cat", "sell_cat", "deal_nmbr", "dirty_amnt", "bond_type4",
                                                 "deal_dt", "deal_strategy"))
    return _report(d,
                   [("buy_cat", "ctgry_type_buy"), ("sell_cat", "ctgry_type_sell"), ("bond_type4", "bond_type_f"),
                    ("deal_dt", "deal_dt"), ("deal_strategy", "deal_strategy")],
                   [_sum(d, "dirty_amnt").alias("full_price")])


def _leg_keys(root: str) -> tuple[tuple[str, str], ...]:
    return (("root", root), ("join_type", "participant_type"), ("bond_type4", "bond_type_f"), ("deal_dt", "deal_dt"),
            ("counter_cat", "member_type"))


PRICE = (("dirty_amnt", "full_price"),)
SET_TABLES = {
    # the set of deal numbers grows with a root's deals of a day
    "root_deal_amount_trans_info": SetTable(deal_sides, tuple(ROOT_KEYS4), PRICE, (("deal_nmbr", "deal_number"),)),
    "root_counter_party_bond_info": SetTable(
        deal_sides, tuple(ROOT_KEYS4), (), (("counter", "counter_id_set"), ("bond_id", "bond_id_set"))),
    "root_counter_party_buyer": SetTable(
        lambda f: _one_leg(f, BUY), _leg_keys("buyer_id"), PRICE, (("counter", "member_id_set"),), "n"),
    "root_counter_party_seller": SetTable(
        lambda f: _one_leg(f, SELL), _leg_keys("seller_id"), PRICE, (("counter", "member_id_set"),), "n"),
    "root_distribution_number": SetTable(
        rooted_sides, (("root", "member_id"), ("join_type", "participant_type"), ("bond_type8", "bond_type_e"),
                 ("deal_strategy", "deal_strategy"), ("deal_dt", "deal_dt")), PRICE, (("bond_id", "bond_id_set"),), "n"),
}
#: tables that equal another one: the union of the legs before the roll-up is the union after it
TWINS = {"root_counter_party_number": "root_counter_party_bond_info"}


def set_report(name: str, strings: bool = True) -> Callable[[Feeds], DataFrame]:
    own = SET_TABLES[TWINS.get(name, name)]

    def plan(f: Feeds) -> DataFrame:
        return own.report(f, strings)

    plan.__name__ = name
    return plan


def root_period_sizes(f: Feeds) -> DataFrame:
    """Distinct counter-parties and bonds of a root by month, exact, and
    whether the sketches of its days agree within 5 % (and one item)."""
    own = SET_TABLES["root_counter_party_bond_info"]
    # the month is a key of the rows, so that what lies together by month is made distinct there
    rows, by_month = own.rows, (*own.keys, ("month", "month"))
    own = replace(own, rows=lambda f: rows(f).withColumn("month", F.trunc("deal_dt", "month")), keys=by_month)
    # a task sorts its rows by item and by day: more tasks than a shuffle alone would bear
    tasks = tasks_for(f.bond_deal, TASK_BYTES)
    sizes = own.period_sizes(own.items(f, place=[tasks, "root", "bond_type4", "month"]), F.col("month"), "month")
    near = F.abs(F.col("estimate") - F.col("n_items")) <= F.greatest(F.lit(1.0), F.col("n_items") * 0.05)
    return sizes.withColumn("month", F.date_format("month", "yyyy-MM")).withColumn("sketch_agrees", near).drop("estimate")


REPORTS = {
    "memberid2name": memberid2name,
    "bondinfo": bondinfo,
    "root_deal_amount_trans_info": set_report("root_deal_amount_trans_info"),
    "root_counter_party_bond_info": set_report("root_counter_party_bond_info"),
    "root_counter_party_number": set_report("root_counter_party_number"),
    "root_deal_strategy_info": root_deal_strategy_info,
    "ctgry_counter_party_buyer": ctgry_counter_party_buyer,
    "root_counter_party_buyer": set_report("root_counter_party_buyer"),
    "counter_party_buyer": counter_party_buyer,
    "counter_party_seller": counter_party_seller,
    "ctgry_counter_party_seller": ctgry_counter_party_seller,
    "root_counter_party_seller": set_report("root_counter_party_seller"),
    "root_trade_deadline_info": root_trade_deadline_info,
    "ctgry_trade_deadline_info": ctgry_trade_deadline_info,
    "ctgry_bond_set": ctgry_bond_set,
    "root_distribution_number": set_report("root_distribution_number"),
    "root_bond_deal": root_bond_deal,
    "ctgry_bond_deal": ctgry_bond_deal,
    "union_info_for_bond_concentration": union_info_for_bond_concentration,
    "base_investment_returns": base_investment_returns,
    "root_investment_returns": root_investment_returns,
    "ctgry_investment_returns": ctgry_investment_returns,
    "root_roi_performance": root_roi_performance,
    "root_bond_concentration": root_bond_concentration,
    "root_term_preference": root_term_preference,
    "ctgry_deal_strategy_info": ctgry_deal_strategy_info,
}

#: not tables of the original job
VARIANTS = {
    "root_deal_rows": root_deal_rows,
    "root_period_sizes": root_period_sizes,
    **{f"{n}_items": t.items for n, t in SET_TABLES.items()},
    **{f"{n}_sizes": set_report(n, strings=False) for n in SET_TABLES},
}
