"""Nightly job: all report tables of one run, written partitioned by day.

The cleaned facts (repo deals, collateral allocation, cash deals) feed many
reports each. A run writes them once as tables in the shared checkpoint
folder (``spark.checkpoint.dir``) and every report then reads the written
table — column-pruned, with its deal-date partitions — instead of redoing
the cleaning joins per report. The written tables also cut lineage, so a
lost executor late in the run costs a re-read, not a recomputation from the
raw feeds. Dimensions are already snapshotted per feed set
(``feeds.dimension``). A run over some ``days`` reads only those days' deals
and rewrites only their partitions. The run also writes a ``data_quality``
table: unmatched lookups, sizes of the facts (observed while they are
written) and rejected feed lines. Facts and snapshots are removed at the end
of a successful run and kept after a failure.

CLI: ``python -m bondmart.plans.job <feed-root-or-sf_dir> <out_root> [--csv] [--day=yyyy-mm-dd ...]``
"""

from __future__ import annotations

import datetime
import sys
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bondmart.plans import base as B
from bondmart.plans import cash_reports, repo_reports
from bondmart.plans.grains import GRAINS
from bondmart.plans.quality import dq_unmatched
from bondmart.session import checkpoint_dir
from bondmart.sources.feeds import Feeds
from bondmart.sources.sinks import observed, remove, write_report

FACTS = ("fact_repo_deal", "fact_repo_collateral", "fact_cash_deal")
SIDE_FACTS = {"repo": FACTS[:2], "cash": FACTS[2:]}
REPORTS = {**repo_reports.REPORTS, **cash_reports.REPORTS}

# dimension snapshots in dependency waves; members of a wave are independent
DIMENSION_WAVES = (
    ("dim_member", "dim_member_cash", "dim_root", "dim_product", "dim_bond4", "dim_bond4_cash",
     "dim_bond8", "dim_rating"),
    ("member_info", "member_id_by_unq", "dim_rating_segments"),
    ("member_rollup_repo", "member_rollup_cash"),
)
# facts in dependency waves (the collateral fact reads the written deals)
FACT_WAVES = (("fact_repo_deal", "fact_cash_deal"), ("fact_repo_collateral",))


#: reports that read a grain
GRAIN_REPORTS = {
    "grain_cash": ("root_deal_strategy_info", "root_trade_deadline_info", "ctgry_trade_deadline_info", "ctgry_bond_set",
                   "root_distribution_number", "root_bond_deal", "ctgry_bond_deal", "union_info_for_bond_concentration",
                   "base_investment_returns", "root_investment_returns", "ctgry_investment_returns",
                   "root_roi_performance", "root_bond_concentration", "root_term_preference"),
    "grain_cash_pair": ("ctgry_counter_party_buyer", "ctgry_counter_party_seller", "counter_party_buyer",
                        "counter_party_seller", "root_counter_party_buyer", "root_counter_party_seller"),
    "grain_repo_price": ("member_all_price_deal_info", "member_price_deal_info", "ctgry_price_deal_info"),
    "grain_repo_pair": ("member_ctgry_amount_deal_info", "ctgry_ctgry_amount_deal_info", "member_ctgry_number_deal_info"),
    "grain_collateral": tuple(f"{who}_bond_{what}_deal_info" for what in ("ctgry", "rtng", "type", "issr")
                              for who in ("member", "ctgry")),
}


def grains_of(names, facts=FACTS) -> list[str]:
    """Grains worth writing: those of ``facts`` that two or more reports read."""
    return [g for g, own in GRAIN_REPORTS.items() if GRAINS[g].fact in facts and len(set(own) & set(names)) > 1]


def _waves(waves, fn, workers: int) -> None:
    """Run independent small jobs of each wave concurrently (Spark schedules
    jobs submitted from several threads side by side)."""
    for wave in waves:
        with ThreadPoolExecutor(max_workers=max(1, min(workers, len(wave)))) as ex:
            list(ex.map(fn, wave))


def build_dimensions(f: Feeds, workers: int = 4) -> None:
    """Snapshot every dimension of the run once."""
    _waves(DIMENSION_WAVES, lambda name: getattr(B, name)(f), workers)


def materialize_facts(spark: SparkSession, f: Feeds, run_id: str | None = None,
                      workers: int = 2, facts=FACTS, grains=tuple(GRAINS), laid_out: bool = True) -> dict[str, int]:
    """Write the shared facts once, and from them the grains, make the feed set
    use the copies, and return the facts' sizes (A11, observed by the writes).
    ``laid_out``: write the grains that have a layout in buckets."""
    root = checkpoint_dir(spark).rstrip("/") + f"/facts-{run_id or uuid.uuid4().hex}"
    sizes = {}
    memo = f.__dict__.setdefault("_memo", {})

    def one(name: str) -> None:
        path, df, size = f"{root}/{name}", getattr(B, name)(f), Observation()
        # files of normal size, a day in few of them and in order, so that row groups can be skipped by day
        df.observe(size, F.count(F.lit(1)).alias("n")).hint("rebalance", "deal_dt").sortWithinPartitions(
            "deal_dt").write.parquet(path)
        copy = spark.read.schema(df.schema).parquet(path)  # an empty fact has no file to take a schema from
        copy._bm_path = root
        memo[name] = copy
        sizes[name] = observed(size, "n") or 0

    _waves([w for wave in FACT_WAVES if (w := [n for n in wave if n in facts])], one, workers)

    def reduce(name: str) -> None:
        copy = GRAINS[name].write(spark, f, f"{root}/{name}", laid_out)
        copy._bm_path = root
        memo[name] = copy

    _waves([grains], reduce, workers)
    return sizes


def write_set_table(spark: SparkSession, f: Feeds, base: str, names: list[str], out_root: str,
                    days: list[datetime.date] | None = None, strings: bool = False) -> None:
    """A table of sets: its items as rows first (``<base>_items``), and from
    them the sizes of ``base`` and its twin; with ``strings`` also the sets as text."""
    table, path = cash_reports.SET_TABLES[base], f"{out_root}/{base}_items"
    rows = table.items(f)
    write_report(rows, path, days=days)
    items = spark.read.schema(rows.schema).parquet(path)
    if days is not None:
        items = items.filter(F.col("deal_dt").isin(list(days)))
    for name in names:
        write_report(table.strings(items) if strings else table.sizes(items), f"{out_root}/{name}", days=days)


def report_jobs(names) -> list[tuple[str, list[str]]]:
    """(table, tables made with it): a twin goes with the table that it equals."""
    jobs: dict[str, list[str]] = {}
    for name in names:
        jobs.setdefault(cash_reports.TWINS.get(name, name), []).append(name)
    return list(jobs.items())


def of_days(f: Feeds, days) -> Feeds:
    """Feeds whose deals are those of some days, pushed to the deal scans."""
    return f.derive(bond_deal=f.bond_deal.filter(F.col("deal_dt").isin(list(days))),
                    bond_repo_deal_f=f.bond_repo_deal_f.filter(F.col("deal_dt").isin(list(days))))


def data_quality(spark: SparkSession, f: Feeds, sizes: dict[str, int], rejects: DataFrame | None) -> DataFrame:
    """(check, n): unmatched lookups, fact sizes and rejected lines by feed."""
    out = dq_unmatched(f)
    if sizes:
        rows = [F.struct(F.lit(f"rows:{k}").alias("check"), F.lit(n).cast("long").alias("n")) for k, n in sizes.items()]
        out = out.unionByName(spark.range(1).select(F.inline(F.array(*rows))))
    if rejects is not None:
        out = out.unionByName(rejects.groupBy("feed").agg(F.count(F.lit(1)).alias("n")).select(
            F.concat(F.lit("rejected:"), "feed").alias("check"), "n"))
    return out


def clean_up(spark: SparkSession, *feeds: Feeds) -> None:
    """Remove the written facts and snapshots of a run."""
    for f in feeds:
        for df in f.__dict__.pop("_memo", {}).values():
            if table := getattr(df, "_bm_table", None):
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            if path := getattr(df, "_bm_path", None):
                remove(spark, path)


def run(spark: SparkSession, f: Feeds, out_root: str, names=None, materialize: bool = True,
        days: list[datetime.date] | None = None, rejects: DataFrame | None = None, workers: int = 4,
        strings: bool = False, facts=FACTS, quality: bool = True) -> dict:
    """Write the report tables (of ``days``, if given) and the data-quality
    table; returns {name: seconds}. Reports are independent and run side by
    side. Sets by root are written as rows and sizes, with ``strings`` as text too. ``facts``: those that the reports need."""
    build_dimensions(f)
    todays = f if days is None else of_days(f, days)
    sizes = materialize_facts(spark, todays, facts=facts, grains=grains_of(names or REPORTS, facts)) if materialize else {}
    out_root, times = out_root.rstrip("/"), {}

    def one(job: tuple[str, list[str]]) -> None:
        name, made = job
        t0 = time.perf_counter()
        if name in cash_reports.SET_TABLES:
            write_set_table(spark, todays, name, made, out_root, days, strings)
        else:
            df = data_quality(spark, todays, sizes, rejects) if name == "data_quality" else REPORTS[name](todays)
            write_report(df, f"{out_root}/{name}", days=days)
        times.update({n: round(time.perf_counter() - t0, 3) for n in made})

    with ThreadPoolExecutor(max_workers=workers) as ex:
        list(ex.map(one, report_jobs([*(names or REPORTS), *(["data_quality"] if quality else [])])))
    clean_up(spark, f, todays)
    return times


def main(argv: list[str]) -> None:  # pragma: no cover - CLI
    from bondmart.session import get_session
    from bondmart.sources import csvfeeds, testviews

    src, out = argv[0], argv[1]
    spark = get_session()
    if "--csv" in argv:
        f, rejects = csvfeeds.load(spark, {n: f"{src}/{n}" for n in Feeds.names()})
    else:
        f, rejects = testviews.load(spark, src), None
    days = [datetime.date.fromisoformat(a[6:]) for a in argv if a.startswith("--day=")]
    print(run(spark, f, out, days=days or None, rejects=rejects))


if __name__ == "__main__":  # pragma: no cover
    main(sys.argv[1:])
