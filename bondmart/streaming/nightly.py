"""Incremental nightly run of both jobs over dumps that arrive on different nights.

``landing/<feed>/`` receives CSV dumps of the deal feeds (repo, cash) and of the
feeds that name deals by key (collateral, removals, interbank flags, matching
status). A deal and the rows that name it need not arrive on one night.

``ingest`` (Structured Streaming, ``foreachBatch``) stores

* deals by day and source file;
* a keyed row under every day on which a stored deal has its key (``dated``), or
  else with those that wait for their deal (``waiting``). New deals draw their
  rows from ``waiting`` and, if their key is known from other days, from those
  days. So all rows that a day's deals can meet lie in that day's partition, and
  a night reads the keys of stored deals, but no row of other days;
* the days that a batch touched (``pending``): days of its deals, and days that
  its keyed rows fell on, which is how a removal that comes nights after its
  deal leads to the days to be built anew;
* the lines it rejects, with feed, file and reason (``rejects``); ``replay``
  lands corrected lines once.

A batch that is run again overwrites its own partitions. ``run_night`` then
compares the dimensions with those of the last night (``changes``: rating
intervals, members, bonds, products), adds the days on which a stored deal or its
collateral meets a change, and rewrites the reports of exactly these days.
Dimensions come from ``static`` feeds, read whole every night. Days stay pending
until their reports are written.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bondmart.functions import scalars as X
from bondmart.operators.joins import small
from bondmart.plans import base as B
from bondmart.plans import cash_reports, job, repo_reports
from bondmart.session import snapshot
from bondmart.sources import csvfeeds
from bondmart.sources.feeds import LAYOUTS, Feeds
from bondmart.sources.sinks import remove, write_report

DEALS = {"repo": "bond_repo_deal_f", "cash": "bond_deal"}
PARTIES = {"repo": ("repo_ip_id", "rvrse_ip_id"), "cash": ("buy_ip_id", "sell_ip_id")}
#: feed -> (side, column of the side's deals, the same key in a row of the feed)
KEYED: dict[str, list[tuple[str, str, Callable[[], Column]]]] = {
    "ev_cltrl_dtls": [("repo", "ev_id", lambda: F.col("ev_id"))],
    "trdx_deal_infrmn_rmv_d": [("repo", "ev_id", lambda: X.event_id("deal_suffix")),
                               ("cash", "bond_deal_id", lambda: F.col("deal_suffix"))],
    "dps_v_cr_dep_txn_dtl": [("repo", "deal_nmbr", lambda: F.col("deal_nmbr"))],
    "dps_v_cbt_all_txn_dtl": [("cash", "deal_nmbr", lambda: F.col("deal_nmbr"))],
}
FEEDS = (*DEALS.values(), *KEYED)
#: reports without days, made from dimensions alone
UNDATED = {"repo": ("member_sketch_info",), "cash": ("memberid2name", "bondinfo")}
REPORTS = {"repo": repo_reports.REPORTS, "cash": cash_reports.REPORTS}


def _columns(feed: str) -> list[str]:
    return [c for c, _ in LAYOUTS[feed]["columns"]]


def _ddl(feed: str, *more: str) -> str:
    return ", ".join([*(f"{c} {t}" for c, t in LAYOUTS[feed]["columns"]), *more])


class Store:
    """The tables of the state folder, empty at first."""

    def __init__(self, spark: SparkSession, state: str):
        self.spark, self.root = spark, state.rstrip("/")

    def read(self, name: str, ddl: str) -> DataFrame:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
        return self.spark.read.schema(ddl).parquet(f"{self.root}/{name}")

    def write(self, df: DataFrame, name: str, *by: str) -> None:
        """Overwrite the partitions that ``df`` has rows for."""
        df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *by).parquet(f"{self.root}/{name}")

    def deals(self, side: str) -> DataFrame:
        return self.read(f"deals/{DEALS[side]}", _ddl(DEALS[side], "src string"))

    def dated(self, feed: str) -> DataFrame:
        return self.read(f"dated/{feed}", _ddl(feed, "key string", "side string", "deal_dt date", "via string"))

    def waiting(self, feed: str) -> DataFrame:
        return self.read(f"waiting/{feed}", _ddl(feed, "key string", "side string", "via string"))

    def pending(self) -> DataFrame:
        return self.read("pending", "side string, deal_dt date, via string")

    def rejects(self) -> DataFrame:
        return self.read("rejects", "line string, reason string, reject_id string, feed string, src string")

    def replayed(self) -> DataFrame:
        return self.read("replayed", "reject_id string")


# ------------------------------------------------------------------- ingest

def _parsed(lines: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    own = lines.where(F.col("feed") == feed)
    good, bad = csvfeeds.parse_lines(own, feed, header_line=csvfeeds.header_text(feed), keep=("src",), rejects=True)
    bad = bad.select(F.col(csvfeeds.LINE).alias("line"), "reason", F.sha2(
        F.concat_ws("\n", F.lit(feed), "src", csvfeeds.LINE), 256).alias("reject_id"), F.lit(feed).alias("feed"), "src")
    return good, bad


def _with_days(store: Store, feed: str, rows: DataFrame | None, new_deals: dict[str, DataFrame], via: str) -> DataFrame:
    """Rows of a keyed feed that this batch puts under a day, or (deal_dt
    null) has to keep waiting: its new rows, and older ones of its new deals."""
    out, columns = [], _columns(feed)
    for side, deal_key, row_key in KEYED[feed]:
        keys = store.deals(side).select(F.col(deal_key).alias("key"), "deal_dt").distinct()
        if rows is not None:
            own = rows.withColumn("key", row_key())
            out.append(own.join(keys, "key", "left").select(*columns, "key", F.lit(side).alias("side"), "deal_dt"))
        if side in new_deals:
            new = new_deals[side].select(F.col(deal_key).alias("key"), "deal_dt").distinct()
            kept = store.waiting(feed).where((F.col("side") == side) & (F.col("via") != via))
            out.append(kept.join(new, "key").select(*columns, "key", "side", "deal_dt"))
            again = new.join(keys.withColumnRenamed("deal_dt", "known_dt"), "key").where("deal_dt <> known_dt")
            known = [r[0] for r in again.select("known_dt").distinct().collect()]  # a row per day
            if known:
                there = store.dated(feed).where((F.col("side") == side) & F.col("deal_dt").isin(known) & (F.col("via") != via))
                there = there.withColumnRenamed("deal_dt", "known_dt")
                out.append(there.join(again, ["key", "known_dt"]).select(*columns, "key", "side", "deal_dt"))
    found = store.waiting(feed).limit(0).select(*columns, "key", "side", F.lit(None).cast("date").alias("deal_dt"))
    for more in out:
        found = found.unionByName(more)
    return found.distinct().withColumn("via", F.lit(via))


def ingest_batch(store: Store) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, epoch: int) -> None:
        lines = snapshot(batch, "lines")
        files = lines.select("feed", "src").distinct()
        # a batch that is run again has the same files, and so the same name
        via = files.agg(F.hex(F.expr("bit_xor(xxhash64(src))"))).first()[0]
        present = {r[0] for r in files.select("feed").distinct().collect()}  # at most the feeds' names
        made, pending, new_deals = [lines], [], {}
        for side, feed in DEALS.items():
            if feed in present:
                good, bad = _parsed(lines, feed)
                store.write(bad, "rejects", "feed", "src")
                new_deals[side] = snapshot(good, feed)
                made.append(new_deals[side])
                store.write(new_deals[side], f"deals/{feed}", "deal_dt", "src")
                pending.append(new_deals[side].select(F.lit(side).alias("side"), "deal_dt"))
        for feed in KEYED:
            rows = None
            if feed in present:
                good, bad = _parsed(lines, feed)
                store.write(bad, "rejects", "feed", "src")
                rows = good.select(*_columns(feed))
            found = snapshot(_with_days(store, feed, rows, new_deals, via), feed)
            made.append(found)
            store.write(found.where("deal_dt is not null"), f"dated/{feed}", "side", "deal_dt", "via")
            store.write(found.where("deal_dt is null").drop("deal_dt"), f"waiting/{feed}", "side", "via")
            pending.append(found.where("deal_dt is not null").select("side", "deal_dt"))
        days = pending[0]
        for more in pending[1:]:
            days = days.unionByName(more)
        store.write(days.distinct().withColumn("via", F.lit(via)), "pending", "via")
        for df in made:
            remove(store.spark, df._bm_path)

    return run


def ingest(spark: SparkSession, landing: str, state: str) -> None:
    """Take in what has landed since the last time, then stop."""
    path = F.col("_metadata.file_path")
    feed = F.regexp_extract(path, f".*/({'|'.join(FEEDS)})/", 1)
    lines = spark.readStream.format("text").option("recursiveFileLookup", True).option("ignoreMissingFiles", True).load(
        landing).select(csvfeeds.LINE, feed.alias("feed"), F.hex(F.xxhash64(path)).alias("src")).where("feed <> ''")
    lines.writeStream.foreachBatch(ingest_batch(Store(spark, state))).option(
        "checkpointLocation", f"{state.rstrip('/')}/offsets").trigger(availableNow=True).start().awaitTermination()


def replay(spark: SparkSession, corrections: DataFrame, landing: str, state: str) -> int:
    """Land corrected lines of rejects: corrections(reject_id, line). A reject
    is replayed once, however often it is corrected; returns how many were."""
    store = Store(spark, state)
    one = corrections.groupBy("reject_id").agg(F.min("line").alias("line"))
    rejects = store.rejects().select("reject_id", "feed").distinct()
    due = snapshot(one.join(rejects, "reject_id").join(store.replayed(), "reject_id", "left_anti"), "replay")
    name, n = due.agg(F.hex(F.expr("bit_xor(xxhash64(reject_id))")), F.count(F.lit(1))).first()
    for feed in [r[0] for r in due.select("feed").distinct().collect()]:  # at most the feeds' names
        due.where(F.col("feed") == feed).select("line").write.mode("overwrite").text(
            f"{landing.rstrip('/')}/{feed}/replay-{name}")
    due.select("reject_id").write.mode("append").parquet(f"{store.root}/replayed")
    remove(spark, due._bm_path)
    return n


# --------------------------------------------------------- changed dimensions

DIMENSIONS = [name for wave in job.DIMENSION_WAVES for name in wave]


def save_dimensions(spark: SparkSession, static: Feeds, path: str) -> dict[str, DataFrame]:
    """Build tonight's dimensions under ``path``; ``static`` uses them from there."""
    job.build_dimensions(static)
    memo, out = static.__dict__["_memo"], {}
    for name in DIMENSIONS:
        df = memo[name]
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        out[name] = spark.read.schema(df.schema).parquet(f"{path}/{name}")
        if where := getattr(df, "_bm_path", None):
            remove(spark, where)
    static.__dict__["_memo"] = {**{k: v for k, v in memo.items() if k not in out}, **out}
    return out


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys of rows that only one of two versions has."""
    new = new.select(*old.columns)
    return old.exceptAll(new).unionByName(new.exceptAll(old)).select(F.col(key).alias("key")).distinct()


def changed_ratings(old: DataFrame, new: DataFrame) -> DataFrame:
    """(bond_id, start, end): the stretches on which a bond's rating segments
    of two versions differ. Both versions' boundaries cut the time line; a
    stretch without a segment counts as the lowest bucket, as in the reports."""
    last = F.lit("9999-12-31").cast("date")
    both = old.unionByName(new)
    cuts = both.select("bond_id", F.col("seg_start").alias("start")).unionByName(
        both.where(F.col("seg_end") < last).select("bond_id", F.date_add("seg_end", 1).alias("start"))).distinct()
    after = F.lead("start").over(Window.partitionBy("bond_id").orderBy("start"))
    out = cuts.withColumn("end", F.coalesce(F.date_sub(after, 1), last))
    for name, version in (("was", old), ("is", new)):
        seg = version.select(F.col("bond_id").alias("b"), "seg_start", "seg_end", F.col("rtng_rank").alias(name))
        out = out.join(seg, (F.col("bond_id") == F.col("b")) & (F.col("seg_start") <= F.col("start"))
                       & (F.col("seg_end") >= F.col("end")), "left").drop("b", "seg_start", "seg_end")
    return out.where(F.coalesce("was", F.lit(0)) != F.coalesce("is", F.lit(0))).select("bond_id", "start", "end")


def _member_rows(d: dict[str, DataFrame], side: str) -> DataFrame:
    """All that the reports of a side take from a member, by member id."""
    if side == "cash":
        return d["dim_member_cash"].join(d["member_rollup_cash"], F.col("ip_id") == F.col("member"), "left").drop("member")
    own = d["dim_member"].select("ip_id", "unq_id")
    info = d["member_info"].select("unq_id", "full_nm", "ins_show_name", "bond_after_show_name")
    return own.join(info, "unq_id", "left").join(d["member_rollup_repo"], F.col("unq_id") == F.col("member"), "left").drop("member")


def changes(store: Store, old: dict[str, DataFrame], new: dict[str, DataFrame]) -> DataFrame:
    """(side, deal_dt): stored days on which a deal meets a changed dimension."""
    out = []
    for side, parties in PARTIES.items():
        members = changed_keys(_member_rows(old, side), _member_rows(new, side), "ip_id")
        party = store.deals(side).select("deal_dt", F.explode(F.array(*parties)).alias("key"))
        out.append(party.join(small(members), "key", "left_semi").select(F.lit(side).alias("side"), "deal_dt"))
    products = changed_keys(old["dim_product"], new["dim_product"], "pd_id")
    out.append(store.deals("repo").withColumnRenamed("pd_id", "key").join(small(products), "key", "left_semi").select(
        F.lit("repo").alias("side"), "deal_dt"))
    pledged = store.dated("ev_cltrl_dtls").select("bond_id", "deal_dt")
    ratings = changed_ratings(old["dim_rating_segments"], new["dim_rating_segments"]).withColumnRenamed("bond_id", "key")
    out.append(pledged.join(small(ratings), (F.col("bond_id") == F.col("key")) & F.col("deal_dt").between(
        F.col("start"), F.col("end")), "left_semi").select(F.lit("repo").alias("side"), "deal_dt"))
    for side, rows, dims in (("repo", pledged, ("dim_bond4",)),
                             ("cash", store.deals("cash").select("bond_id", "deal_dt"), ("dim_bond4_cash", "dim_bond8"))):
        for dim in dims:
            bonds = changed_keys(old[dim], new[dim], "bond_id")
            out.append(rows.withColumnRenamed("bond_id", "key").join(small(bonds), "key", "left_semi").select(
                F.lit(side).alias("side"), "deal_dt"))
    days = out[0]
    for more in out[1:]:
        days = days.unionByName(more)
    return days.distinct()


# ---------------------------------------------------------------- the night

def feeds_of_days(store: Store, static: Feeds, side: str, days: Sequence[datetime.date]) -> Feeds:
    """``static`` with the stored deals of some days and the rows that name them."""
    of_days = F.col("deal_dt").isin(list(days))
    facts = {}
    for other, feed in DEALS.items():
        facts[feed] = store.deals(other).where(of_days if other == side else F.lit(False)).select(*_columns(feed))
    for feed in KEYED:
        facts[feed] = store.dated(feed).where(of_days & (F.col("side") == side)).select(*_columns(feed))
    return static.derive(**facts)


def run_night(spark: SparkSession, landing: str, static: Feeds, out_root: str, state: str,
              names: Sequence[str] | None = None, strings: bool = False) -> dict[str, list[datetime.date]]:
    """Take in tonight's dumps, compare tonight's dimensions (``static``) with
    the last ones, rewrite the reports of the days concerned; the days by side."""
    store, out_root = Store(spark, state), out_root.rstrip("/")
    ingest(spark, landing, state)
    done = [r[0] for r in store.read("nights", "night long").orderBy("night").collect()]  # a row per night
    last = done[-1] if done else 0
    new = save_dimensions(spark, static, f"{store.root}/dimensions/{last + 1}")
    due = store.pending().select("side", "deal_dt")
    if done:
        old = {n: spark.read.schema(df.schema).parquet(f"{store.root}/dimensions/{last}/{n}") for n, df in new.items()}
        due = due.unionByName(changes(store, old, new))
    files = [r[0] for r in store.pending().select("via").distinct().collect()]  # a row per batch since the last night
    days: dict[str, list] = {side: [] for side in DEALS}
    for side, day in due.where("deal_dt is not null").distinct().orderBy("side", "deal_dt").collect():  # a row per day
        days[side].append(day)
    for side, own in days.items():
        wanted = [n for n in REPORTS[side] if names is None or n in names]
        for name in set(UNDATED[side]) & set(wanted):
            write_report(REPORTS[side][name](static), f"{out_root}/{name}")
        dated = [n for n in wanted if n not in UNDATED[side]]
        if own and dated:
            f = feeds_of_days(store, static, side, own)
            job.run(spark, f, out_root, dated, days=own, strings=strings, facts=job.SIDE_FACTS[side], quality=False)
    spark.range(1).select(F.lit(last + 1).cast("long").alias("night")).write.mode("append").parquet(f"{store.root}/nights")
    for via in files:
        remove(spark, f"{store.root}/pending/via={via}")
    return days
