"""Incremental nightly run on Structured Streaming.

The original jobs are nightly batches over feed dumps. Here new dumps of
the cash-deal feed land in a folder; a file-source stream (trigger
``availableNow``: process what has arrived, then stop) hands each
micro-batch to ``foreachBatch``, which

1. parses the lines strictly (``csvfeeds.parse_lines``) and stores them under
   ``<state>/store``, partitioned by deal day and source file with dynamic
   overwrite: a file that is read again, after a failure or by another
   application, replaces its own rows;
2. reads back only the partitions of the batch's days, writes the cleaned fact
   of these days once, and computes the requested reports from it; and
3. overwrites exactly those date partitions of each report.

Rejected lines are kept by source file, with a reason, under ``<state>/store-rejects``.

``state`` is a stable folder that the caller names, the same for every night:
it holds the streams' offsets (by landing folder) and the store, so the next
application goes on where the last one ended, also if files have been archived
or each night has a landing folder of its own. A file's path stands for one
dump whose content doesn't change. Dimensions come
from a static ``Feeds`` and are built once for all batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bondmart.plans import base as B
from bondmart.plans import cash_reports
from bondmart.session import snapshot
from bondmart.sources import csvfeeds
from bondmart.sources.feeds import DIMENSIONS, LAYOUTS, Feeds
from bondmart.sources.sinks import remove, write_report

FEED = "bond_deal"


def _stored(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed rows and rejected lines of a batch, with the key of their source file."""
    good, bad = csvfeeds.parse_lines(batch, FEED, header_line=csvfeeds.header_text(FEED), keep=("file",), rejects=True)
    return good.withColumnRenamed("file", "src"), bad.withColumnRenamed("file", "src")


def process_batch(spark: SparkSession, static: Feeds, store: str, out_root: str,
                  reports: Sequence[str]) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, epoch: int) -> None:
        good, bad = _stored(batch)
        bad.hint("rebalance", "src").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "src").parquet(f"{store}-rejects")
        typed = snapshot(good, "drop")
        days = [r[0] for r in typed.select("deal_dt").distinct().collect()]  # a row per day of the drop
        if days:
            typed.hint("rebalance", "deal_dt", "src").write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("deal_dt", "src").parquet(store)
            columns = [F.col(c).cast(t) for c, t in LAYOUTS[FEED]["columns"]]
            todays = spark.read.parquet(store).filter(F.col("deal_dt").isin(days)).select(*columns)
            f = static.derive(bond_deal=todays)
            fact = snapshot(B.fact_cash_deal(f), "fact_cash_deal")
            f.__dict__["_memo"]["fact_cash_deal"] = fact
            for name in reports:
                write_report(cash_reports.REPORTS[name](f), f"{out_root.rstrip('/')}/{name}", days=days)
            static.__dict__.setdefault("_memo", {}).update(
                {k: v for k, v in f.__dict__["_memo"].items() if k in DIMENSIONS})
            for name, df in f.__dict__["_memo"].items():  # the fact, and what else was written for this batch alone
                if name not in DIMENSIONS and hasattr(df, "_bm_path"):
                    remove(spark, df._bm_path)
        remove(spark, typed._bm_path)

    return run


def start(spark: SparkSession, landing: str, static: Feeds, out_root: str, state: str,
          reports: Sequence[str] | None = None, name: str = "cash-deal-drops",
          once: bool = True) -> StreamingQuery:
    """Start the incremental run over ``landing`` (CSV drops of the cash-deal
    feed). ``state``: folder of the offsets and the store, the same every
    night. ``once``: trigger availableNow (nightly use)."""
    reports, state = list(reports or cash_reports.REPORTS), state.rstrip("/")
    key = hashlib.sha1(landing.rstrip("/").encode()).hexdigest()[:16]  # a stream's offsets belong to one folder
    lines = spark.readStream.format("text").option("ignoreMissingFiles", True).load(landing).select(
        csvfeeds.LINE, F.hex(F.xxhash64("_metadata.file_path")).alias("file"))
    w = lines.writeStream.foreachBatch(process_batch(spark, static, f"{state}/store", out_root, reports)).option(
        "checkpointLocation", f"{state}/offsets/{key}")
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")
    return w.queryName(name).start()
