"""Query registry: name -> (spark, sf_dir) -> DataFrame.

Every entry loads the driver tables of ``sf_dir`` through the feed mapping
and returns a DataFrame over the whole tables. Dimensions are snapshotted
when the first query of a folder is planned; the query itself is lazy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bondmart.plans import base as B
from bondmart.plans import cash_reports, repo_reports
from bondmart.sources import testviews
from bondmart.sources.feeds import Feeds

Plan = Callable[[Feeds], DataFrame]


BASE_TABLES: dict[str, Plan] = {
    "dim_member": B.dim_member,
    "dim_root": B.dim_root,
    "dim_rating": B.dim_rating,
    "dim_bond4": B.dim_bond4,
    "dim_bond8": B.dim_bond8,
    "fact_repo_deal": lambda f: B.fact_repo_deal(f),
    "fact_repo_deal_priced": lambda f: B.fact_repo_deal_priced(f),
    "fact_repo_collateral": lambda f: B.fact_repo_collateral(f),
    "fact_cash_deal": B.fact_cash_deal,
}

PLANS: dict[str, Plan] = {**BASE_TABLES, **repo_reports.REPORTS, **cash_reports.REPORTS,
                          **repo_reports.VARIANTS, **cash_reports.VARIANTS}


_FEEDS: dict[tuple, tuple[tuple, Feeds]] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Size and time of the input tables, by the session's file system."""
    out = []
    for name in testviews.TABLES:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        out.append((fs.getContentSummary(path).getLength(), fs.getFileStatus(path).getModificationTime()))
    return tuple(out)


def feeds_for(spark: SparkSession, sf_dir: str) -> Feeds:
    """One feed set per (application, input folder) and state of its tables:
    its dimension snapshots are built once and shared by all reports of the
    run, like one nightly job; changed input gets new feeds."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    state = _state(spark, sf_dir)
    if key not in _FEEDS or _FEEDS[key][0] != state:
        _FEEDS[key] = (state, testviews.load(spark, sf_dir))
    return _FEEDS[key][1]


def _bind(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(feeds_for(spark, sf_dir))

    run.__name__ = getattr(plan, "__name__", "plan")
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from bondmart.operator_queries import OPERATOR_QUERIES

    out = {name: _bind(p) for name, p in PLANS.items()}
    out.update(OPERATOR_QUERIES)
    return out
