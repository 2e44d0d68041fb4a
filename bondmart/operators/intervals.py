"""Interval feeds: intersection of two chained feeds and non-overlapping segments.

Intervals hold both their ends, as days; a null start or end is open. All work
is on the interval feeds (bounded dimensions); a fact row then needs an
equi-join with a range residual and finds at most one segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bondmart import labels as L
from bondmart.operators.joins import small

FIRST_DAY = "0001-01-01"


def closed(df: DataFrame, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Open ends as the first and the last day; intervals that end before they
    start go."""
    first, last = F.lit(FIRST_DAY).cast("date"), F.lit(L.OPEN_END_DATE).cast("date")
    return df.withColumns({start: F.coalesce(start, first), end: F.coalesce(end, last)}).where(F.col(start) <= F.col(end))


def intersection(left: DataFrame, right: DataFrame, on: Sequence[str], start: str = "valid_from",
                 end: str = "valid_to") -> DataFrame:
    """Rows of ``left`` with those of ``right`` of the same key, over the days
    that both cover."""
    theirs = closed(right, start, end).withColumnsRenamed({start: "_start", end: "_end"})
    both = closed(left, start, end).join(small(theirs), list(on))
    return both.withColumns({start: F.greatest(start, "_start"), end: F.least(end, "_end")}).where(
        F.col(start) <= F.col(end)).drop("_start", "_end")


def segments(intervals: DataFrame, key: str, value: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """(key, seg_start, seg_end, value): at most one segment per key and day.
    Where intervals overlap the latest start wins, then the earliest end, then
    the greatest value; neighbours of one value are one segment."""
    last = F.lit(L.OPEN_END_DATE).cast("date")
    own = closed(intervals, start, end).select(key, start, end, value).distinct()
    cuts = own.select(key, F.col(start).alias("seg_start")).unionByName(
        own.where(F.col(end) < last).select(key, F.date_add(end, 1).alias("seg_start"))).distinct()
    in_order = Window.partitionBy(key).orderBy("seg_start")
    cuts = cuts.withColumn("seg_end", F.coalesce(F.date_sub(F.lead("seg_start").over(in_order), 1), last))
    covering = cuts.join(own, key).where((F.col(start) <= F.col("seg_start")) & (F.col(end) >= F.col("seg_end")))
    best = F.max_by(value, F.struct(F.col(start), F.datediff(F.lit(FIRST_DAY).cast("date"), F.col(end)), F.col(value)))
    cut = covering.groupBy(key, "seg_start", "seg_end").agg(best.alias(value))
    # a segment begins where the value changes or a day is missing
    new = (F.lag(value).over(in_order) != F.col(value)) | (F.lag("seg_end").over(in_order) != F.date_sub("seg_start", 1))
    run = F.sum(F.coalesce(new, F.lit(True)).cast("int")).over(in_order)
    return cut.withColumn("_run", run).groupBy(key, value, "_run").agg(
        F.min("seg_start").alias("seg_start"), F.max("seg_end").alias("seg_end")).select(key, "seg_start", "seg_end", value)


def value_as_of(df: DataFrame, segs: DataFrame, key: str, day: str, value: str, member: Column) -> DataFrame:
    """``df`` with ``value`` of the segment that holds ``day`` for ``member`` (null: none)."""
    s = segs.select(F.col(key).alias("_key"), "seg_start", "seg_end", F.col(value))
    return df.join(small(s), (member == F.col("_key")) & F.col(day).between(F.col("seg_start"), F.col("seg_end")), "left").drop(
        "_key", "seg_start", "seg_end")
