"""Report sinks (K1, K2).

K1: each report table is one DataFrame written as parquet, partitioned by
deal date. A run over all days replaces the whole table; a run over some days
replaces exactly those days' partitions (dynamic partition overwrite), clears
those of its days that came out empty, and leaves the others alone.

K2: the original store merged several writes of different columns for the
same keys (one write per side). ``merge_column_groups`` reproduces that
upsert semantics on DataFrames: per key and column the value of the latest
write that carried the column wins; columns no write carried stay NULL.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bondmart.session import snapshot


def write_report(df: DataFrame, path: str, partition_by: Sequence[str] = ("deal_dt",),
                 fmt: str = "parquet", days: Sequence[datetime.date] | None = None) -> None:
    """K1: write one report table; ``days``: the days of the run, if not all.

    ``rebalance`` on the partition columns first: rows of one day go to few
    tasks (few files per partition directory, not one per shuffle
    partition), while AQE still splits an oversized day and coalesces small
    ones. The days written are observed by the same job.
    """
    cols = [c for c in partition_by if c in df.columns]
    w = df
    if cols:
        w = w.hint("rebalance", *cols)
    if not cols or days is None:
        w = w.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (w.partitionBy(*cols) if cols else w).format(fmt).save(path)
        return
    seen = Observation()
    days_seen = F.array_join(F.collect_set(F.col(cols[0]).cast("string")), ",")  # at most the run's days
    w = w.observe(seen, days_seen.alias("days"))
    w.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).format(fmt).save(path)
    written = set((observed(seen, "days") or "").split(","))
    for day in days:
        if str(day) not in written:
            remove(df.sparkSession, f"{path.rstrip('/')}/{cols[0]}={day}")


def observed(seen: Observation, name: str):
    """An observed metric; None if the plan proved empty while it ran, since
    Spark then drops the observing node and has no row to report."""
    try:
        return seen.get[name]
    except Py4JJavaError as e:
        if "toPyRow" not in str(e):
            raise
        return None


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the session's file system, if it is there."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def upsert(df: DataFrame, path: str, keys: Sequence[str], days: Sequence[datetime.date] | None = None,
           by: str = "deal_dt") -> None:
    """K2: merge a column group into a stored table partitioned by deal date
    (or another date column, one of the keys).

    Stored values of other columns and keys stay; the new group's values win.
    Only the partitions of ``days`` (by default the dates in ``df``) are read
    and rewritten. The merged rows are written aside first, as a table cannot
    be read and overwritten in one job.
    """
    spark = df.sparkSession
    if days is None:
        days = [r[0] for r in df.select(by).distinct().collect()]  # a row per date of the group
    try:
        old = spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException:  # not stored yet
        write_report(df, path, (by,), days=days)
        return
    merged = merge_column_groups([old.filter(F.col(by).isin(list(days))), df], keys)
    write_report(snapshot(merged, "upsert"), path, (by,), days=days)


def merge_column_groups(groups: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """K2: upsert-merge column groups written in order (later wins).

    Each group has the key columns plus some value columns. The result has
    one row per key present in any group and every value column of any
    group. One union + one grouped aggregate (``max_by`` on the write
    sequence, ignoring groups that did not carry the column): no joins, a
    single shuffle on the keys.
    """
    keys = list(keys)
    value_cols: list[str] = []
    for g in groups:
        value_cols += [c for c in g.columns if c not in keys and c not in value_cols]
    types = {}
    for g in groups:
        for fld in g.schema.fields:
            types.setdefault(fld.name, fld.dataType)
    parts = []
    for seq, g in enumerate(groups):
        sel = [F.col(k) for k in keys]
        for c in value_cols:
            carried = c in g.columns
            sel.append((F.col(c) if carried else F.lit(None)).cast(types[c]).alias(c))
            sel.append(F.lit(seq if carried else None).cast("int").alias(f"_seq_{c}"))
        parts.append(g.select(*sel))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    aggs = [F.max_by(F.col(c), F.col(f"_seq_{c}")).alias(c) for c in value_cols]
    return u.groupBy(*keys).agg(*aggs)
