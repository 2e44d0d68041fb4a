"""Grains: additive measures of a fact that several reports share.

A grain is the side-unpivoted fact reduced to the keys and sums that its
reports need. Unwritten it is a narrow view of the fact's rows, so a single
report plans as one aggregate. The nightly run aggregates each grain once
and writes it: the fact is then scanned once for all reports of the grain, and
every report combines rows that are combined already (sums of sums, extremes
of extremes; decimals, so exact).

A grain with a ``layout`` is written with the root and participant type of its
member, bucketed by (root, bond). Any report keyed by root or member and by bond then
aggregates without an exchange, also over the fan-out to the types, which
keeps rows in place. The bond is in the layout because one root may hold a
third of all rows: its bonds spread it over all buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bondmart import labels as L
from bondmart.operators.joins import small, with_rating
from bondmart.operators.rollup import CASH_SIDES, REPO_SIDES, on_side, sides_unpivot, with_rollup
from bondmart.plans import base as B
from bondmart.sources.feeds import Feeds

REPO, RVRSE, BUY, SELL = L.SIDE_REPO, L.SIDE_RVRSE, L.SIDE_BUY, L.SIDE_SELL


@dataclass(frozen=True)
class Grain:
    """``fact``: the table it is made of; ``sums``, ``most``, ``least``: columns of
    ``rows`` and how they combine; ``layout``: bucket columns of the written
    grain; ``rollup``: member -> (root, join_type) for them."""

    fact: str
    rows: Callable[[Feeds], DataFrame]
    keys: tuple[str, ...]
    sums: tuple[str, ...]
    most: tuple[str, ...] = ()
    least: tuple[str, ...] = ()
    layout: tuple[str, ...] = ()
    rollup: Callable[[Feeds], DataFrame] | None = None

    def combined(self, f: Feeds) -> DataFrame:
        ways = ((F.sum, self.sums), (F.max, self.most), (F.min, self.least))
        df = self.rows(f).groupBy(*self.keys).agg(*[way(c).alias(c) for way, cols in ways for c in cols])
        return with_rollup(df, self.rollup(f)) if self.layout else df

    def write(self, spark: SparkSession, f: Feeds, path: str, laid_out: bool = True) -> DataFrame:
        """Aggregate and write the grain under ``path``; returns the stored copy."""
        df = self.combined(f)
        if not (self.layout and laid_out):
            df.drop("root", "join_type").hint("rebalance", "deal_dt").sortWithinPartitions("deal_dt").write.parquet(path)
            return spark.read.schema(df.drop("root", "join_type").schema).parquet(path)
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"{path.rstrip('/').rsplit('/', 1)[-1]}_{uuid.uuid4().hex}"  # buckets are known to the catalog alone
        df.repartition(buckets, *self.layout).write.bucketBy(buckets, *self.layout).sortBy(*self.layout).option(
            "path", path).saveAsTable(name)
        copy = spark.table(name)
        copy._bm_table = name
        return copy


def _measures(sides: tuple[str, str], terms: dict[str, Column]) -> list[Column]:
    """Each term once a side: ``<side>_<term>``, NULL on rows of the other side."""
    return [on_side(s, e).alias(f"{s.lower()}_{n}") for s in sides for n, e in terms.items()]


def _both(sides: tuple[str, str], *terms: str) -> tuple[str, ...]:
    return tuple(f"{s.lower()}_{n}" for s in sides for n in terms)


# ------------------------------------------------------------------- cash

CASH_KEYS = ("member", "bond_id", "bond_type4", "bond_type8", "deal_strategy", "mrty_bucket", "yrs_to_mrty", "deal_dt")


def _cash_measures(sides: DataFrame, *of_member: str) -> DataFrame:
    return sides.select(*of_member, *CASH_KEYS, *_measures((BUY, SELL), {c: F.col(c) for c in ("dirty_amnt", "face_value")}),
                        F.lit(1).cast("long").alias("n"))


def _cash_rows(f: Feeds) -> DataFrame:
    return _cash_measures(sides_unpivot(B.fact_cash_deal(f), CASH_SIDES))


def _cash_pair_rows(f: Feeds) -> DataFrame:
    return B.fact_cash_deal(f).select("buy_ip_id", "sell_ip_id", "bond_type4", "deal_dt", "dirty_amnt",
                                      F.lit(1).cast("long").alias("n"))


# ------------------------------------------------------------------- repo

def _repo_price_rows(f: Feeds) -> DataFrame:
    """Rate times amount and amount by side, kept exact, and the rates for the extremes."""
    d = sides_unpivot(B.fact_repo_deal_priced(f), REPO_SIDES)
    return d.select("member", "pd_cd", "deal_dt", *_measures((REPO, RVRSE), {
        "num": F.col("repo_rate") * F.col("trade_amnt"), "amt": F.col("trade_amnt"),
        "max": F.col("repo_rate"), "min": F.col("repo_rate")}))


def _repo_pair_rows(f: Feeds) -> DataFrame:
    """Amounts and deals between two members, all products."""
    d = sides_unpivot(B.fact_repo_deal(f), REPO_SIDES)
    return d.select("member", "counter", "deal_dt", *_measures((REPO, RVRSE), {
        "amt": F.col("trade_amnt"), "n": F.lit(1).cast("long")}))


def _collateral_rows(f: Feeds) -> DataFrame:
    """Allocated amounts and their haircuts by bond category (a bond missing
    from the dimension: 其他), as-of rating and issuer (``listed``: the bond is in
    the dimension)."""
    bonds = B.dim_bond4(f).select("bond_id", "bond_ctgry_nm", "issr_id", F.lit(True).alias("listed"))
    # whole 1e-4 units of at most 18 digits, as the fact makes them
    c = B.fact_repo_collateral(f).withColumn("alloc", F.col("alloc").cast("decimal(18,4)")).join(small(bonds), "bond_id", "left")
    c = c.withColumn("bond_ctgry_nm", F.coalesce("bond_ctgry_nm", F.lit(L.BOND_OTHER))).withColumn(
        "listed", F.coalesce("listed", F.lit(False)))
    d = sides_unpivot(with_rating(c, B.dim_rating_segments(f)), REPO_SIDES)
    return d.select("member", "bond_ctgry_nm", "rtng_desc", "issr_id", "listed", "deal_dt", *_measures((REPO, RVRSE), {
        "cut": F.col("cnvrsn_prprtn") * F.col("alloc"), "alloc": F.col("alloc")}))


GRAINS = {
    "grain_cash": Grain("fact_cash_deal", _cash_rows, CASH_KEYS, (*_both((BUY, SELL), "dirty_amnt", "face_value"), "n"),
                        layout=("root", "bond_id"), rollup=B.member_rollup_cash),
    "grain_cash_pair": Grain("fact_cash_deal", _cash_pair_rows, ("buy_ip_id", "sell_ip_id", "bond_type4", "deal_dt"),
                             ("dirty_amnt", "n")),
    "grain_repo_price": Grain("fact_repo_deal", _repo_price_rows, ("member", "pd_cd", "deal_dt"),
                              _both((REPO, RVRSE), "num", "amt"), _both((REPO, RVRSE), "max"), _both((REPO, RVRSE), "min")),
    "grain_repo_pair": Grain("fact_repo_deal", _repo_pair_rows, ("member", "counter", "deal_dt"),
                             _both((REPO, RVRSE), "amt", "n")),
    "grain_collateral": Grain("fact_repo_collateral", _collateral_rows,
                              ("member", "bond_ctgry_nm", "rtng_desc", "issr_id", "listed", "deal_dt"),
                              _both((REPO, RVRSE), "cut", "alloc")),
}


def grain(f: Feeds, name: str) -> DataFrame:
    """The written grain if the run made one, else its rows."""
    memo = f.__dict__.setdefault("_memo", {})
    if name not in memo:
        memo[name] = GRAINS[name].rows(f)
    return memo[name]


def is_stored(f: Feeds, name: str) -> bool:
    """Whether the run has written the grain."""
    return hasattr(grain(f, name), "_bm_path")


def deal_sides(f: Feeds) -> DataFrame:
    """The two sides of the cash deals, with the member's category (``ctgry``), root and
    participant type if these are looked up by party (``party_deals``)."""
    deals = B.party_deals(f)
    if deals is None:
        return sides_unpivot(B.fact_cash_deal(f), CASH_SIDES)
    return sides_unpivot(deals, CASH_SIDES, own={
        n: [f"buy_{c}", f"sell_{c}"] for n, c in (("ctgry", "cat"), ("root", "root"), ("join_type", "join_type"))})


def _any_dirty(rows: DataFrame) -> DataFrame:
    """A row of the fact has one side and keeps the type of its amount; a stored
    row (its sums are wider) has both."""
    buy, sell = F.col("buy_dirty_amnt"), F.col("sell_dirty_amnt")
    both = [buy + sell] if rows.schema["buy_dirty_amnt"].dataType.precision > 18 else []
    return rows.withColumn("dirty_amnt", F.coalesce(*both, buy, sell))


def cash_sides(f: Feeds) -> DataFrame:
    """``grain_cash`` with the dirty amount of both sides."""
    return _any_dirty(grain(f, "grain_cash"))


def rooted_sides(f: Feeds) -> DataFrame:
    """``cash_sides`` for reports by root or category: with ctgry, root and
    join_type where the deals' sides have them."""
    if is_stored(f, "grain_cash") or B.party_deals(f) is None:
        return cash_sides(f)
    return _any_dirty(_cash_measures(deal_sides(f), "ctgry", "root", "join_type"))
