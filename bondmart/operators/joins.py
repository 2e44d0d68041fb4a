"""Join helpers: size-checked broadcast, keyed dedupe, lookups, as-of rating.

Broadcast policy: a side is hinted for broadcast only when Catalyst's
plan-time size estimate (``sizeInBytes`` of the optimized plan, no job run)
is at most ``max_bytes``. Otherwise the plain DataFrame is returned and the
join shuffles; AQE may still turn it into a broadcast join after the map
stage has measured the real size. Fact-sized sides are never hinted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bondmart.functions.scalars import rating_label

# bound for hinted broadcasts, on Catalyst's size estimate (for a parquet
# snapshot: its compressed file size; in memory a few times more)
BROADCAST_MAX_BYTES = 16 * 1024 * 1024
UNKNOWN_BYTES = 1 << 62  # Catalyst's estimate of rows whose size it doesn't know is 2^63 - 1


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's plan-time size estimate in bytes (None if unavailable).

    Memoized on the DataFrame: dimensions are built once per feed set and
    checked once, not re-optimized at every join that uses them.
    """
    cached = getattr(df, "_bm_size", False)
    if cached is not False:
        return cached
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        size = int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - non-JVM backends
        size = None
    try:
        df._bm_size = size
    except AttributeError:  # pragma: no cover
        pass
    return size


def small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint if the estimated size is within ``max_bytes``."""
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


def is_small(df: DataFrame) -> bool:
    """Whether ``small`` hints a broadcast of ``df``."""
    return small(df) is not df


def tasks_for(df: DataFrame, task_bytes: int) -> int:
    """Tasks for rows made of ``df``: one for ``task_bytes`` of what it reads (compressed
    files), at least ``spark.sql.shuffle.partitions``. Given as a number, adaptive execution keeps it.
    Rows whose size the planner doesn't know (an RDD's) don't count."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return max(-(-sum(n for n in sizes if n < UNKNOWN_BYTES) // task_bytes), least)


def dedupe_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple, ties
    decided by the other columns in their order.

    Stands in for the last-one-wins of a driver-side map build, but
    deterministic. A grouped aggregate (partial + final), not a window, so a
    hot key is combined map-side.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order],
                                                                     *[F.col(c) for c in rest if c not in order]))
    return df.groupBy(*keys).agg(best.alias("_b")).select(*keys, *[F.col(f"_b.{c}") for c in rest])


def distinct_rows(df: DataFrame) -> DataFrame:
    """``dropDuplicates`` of fact-sized rows by a shuffle of their own, in as many tasks as
    ``spark.sql.shuffle.partitions``: a task holds its rows twice (partial and final aggregate),
    so it must not take what adaptive execution would put together for a join."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *df.columns).dropDuplicates()


def lookup(df: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Dimension lookup (inner drops misses, left keeps them as NULL)."""
    return df.join(small(dim), on, how)


def rating_as_of(keys: DataFrame, ratings: DataFrame) -> DataFrame:
    """Rating of each (bond_id, deal_dt) whose interval holds the date.

    ``ratings`` has (bond_id, rtng_start_dt, rtng_end_dt, rtng_rank) with one
    row per interval (see plans.base.dim_rating). Both ends are inclusive. Overlapping
    intervals: latest start wins, then earliest end, then the lower rating.
    Returns (bond_id, deal_dt, rtng_rank) for keys with a hit only; callers
    left-join it and default to the lowest bucket.

    ``keys`` is distinct (bond, date) pairs, so a hot bond contributes one
    row per day, and the equi key bond_id turns the range test into a
    residual predicate of an equi-join (no nested loop).
    """
    r = ratings.select(
        F.col("bond_id").alias("r_bond_id"), "rtng_start_dt", "rtng_end_dt", "rtng_rank"
    )
    hit = keys.join(
        small(r),
        (F.col("bond_id") == F.col("r_bond_id"))
        & (F.col("deal_dt") >= F.col("rtng_start_dt"))
        & (F.col("deal_dt") <= F.col("rtng_end_dt")),
        "inner",
    )
    pick = F.min_by(
        F.col("rtng_rank"),
        F.struct(
            F.datediff(F.lit("9999-12-31").cast("date"), F.col("rtng_start_dt")),
            F.col("rtng_end_dt"),
            F.col("rtng_rank"),
        ),
    )
    return hit.groupBy("bond_id", "deal_dt").agg(pick.alias("rtng_rank"))


def rating_segments(ratings: DataFrame) -> DataFrame:
    """J6 prepared on the rating dimension: non-overlapping segments.

    For each bond, the interval boundaries (starts and day-after-ends) cut
    the timeline into elementary segments; each segment takes the rating of
    the winning interval covering it (same tie rule as ``rating_as_of``).
    Result (bond_id, seg_start, seg_end, rtng_rank) has at most one segment
    per bond and day, so a fact row needs only an equi-join on bond_id with
    a range residual, and finds at most one match: no distinct-keys pass
    over the facts, no regrouping. Works on the bounded rating dimension
    only (a window per bond over its few boundaries).
    """
    last_day = F.lit("9999-12-31").cast("date")
    starts = ratings.select("bond_id", F.col("rtng_start_dt").alias("p"))
    after_ends = ratings.filter(F.col("rtng_end_dt") < last_day).select(
        "bond_id", F.date_add("rtng_end_dt", 1).alias("p"))
    pts = starts.unionByName(after_ends).distinct()
    nxt = F.lead("p").over(Window.partitionBy("bond_id").orderBy("p"))
    seg = pts.select(
        "bond_id", F.col("p").alias("seg_start"),
        F.coalesce(F.date_sub(nxt, 1), last_day).alias("seg_end"),
    )
    r = ratings.select(F.col("bond_id").alias("r_bond_id"), "rtng_start_dt", "rtng_end_dt", "rtng_rank")
    cov = seg.join(
        r,
        (F.col("bond_id") == F.col("r_bond_id"))
        & (F.col("rtng_start_dt") <= F.col("seg_start"))
        & (F.col("rtng_end_dt") >= F.col("seg_end")),
        "inner",
    )
    pick = F.min_by(
        F.col("rtng_rank"),
        F.struct(
            F.datediff(last_day, F.col("rtng_start_dt")), F.col("rtng_end_dt"), F.col("rtng_rank")
        ),
    )
    return cov.groupBy("bond_id", "seg_start", "seg_end").agg(pick.alias("rtng_rank"))


def with_rating(df: DataFrame, segments: DataFrame, out: str = "rtng_desc") -> DataFrame:
    """Add the as-of rating label to rows with (bond_id, deal_dt) using
    ``rating_segments`` output; no covering interval -> lowest bucket."""
    s = segments.select(F.col("bond_id").alias("_sb"), "seg_start", "seg_end", "rtng_rank")
    x = df.join(
        small(s),
        (F.col("bond_id") == F.col("_sb"))
        & (F.col("deal_dt") >= F.col("seg_start"))
        & (F.col("deal_dt") <= F.col("seg_end")),
        "left",
    )
    return x.withColumn(out, rating_label(F.coalesce(F.col("rtng_rank"), F.lit(0)))).drop(
        "_sb", "seg_start", "seg_end", "rtng_rank")


__all__ = [
    "BROADCAST_MAX_BYTES", "estimated_bytes", "small", "is_small", "tasks_for", "dedupe_latest", "distinct_rows", "lookup",
    "rating_as_of", "rating_segments", "with_rating",
]
