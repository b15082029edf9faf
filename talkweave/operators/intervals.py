"""Joins on intervals and dates, interval unions, and small interval arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlap(start_a: str, end_a: str, start_b: str, end_b: str) -> Column:
    """Length of the common part, negative where there is a gap."""
    return F.least(end_a, end_b) - F.greatest(start_a, start_b)


def folded(x: Column) -> Column:
    """A ratio of which too much counts against it as well: 1/x^2 above 1."""
    return F.when(x > 1, 1 / (x * x)).otherwise(x)


def overlap_join(a: DataFrame, b: DataFrame, key: str, bucket_ms: int | None = None) -> DataFrame:
    """Pairs of a (start_ms, end_ms) and b (b_start_ms, b_end_ms, ...) with a common part, within the key.

    With bucket_ms both sides are also dealt to the time buckets that they touch, so that long recordings don't make one hot
    key; a pair is kept in the first bucket that both touch. Still an equi join, so hash or sort-merge and AQE's skew split apply.
    """
    common = F.col("overlap_ms") > 0
    if bucket_ms is None:
        return a.join(b, key).withColumn("overlap_ms", overlap("start_ms", "end_ms", "b_start_ms", "b_end_ms")).where(common)
    cut = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / bucket_ms), F.floor(F.greatest(F.col(s), F.col(e)) / bucket_ms)))
    left = a.withColumn("_bucket", cut("start_ms", "end_ms"))
    right = b.withColumn("_bucket", cut("b_start_ms", "b_end_ms"))
    both = left.join(right, [key, "_bucket"]).withColumn("overlap_ms", overlap("start_ms", "end_ms", "b_start_ms", "b_end_ms"))
    return both.where(common & (F.col("_bucket") == F.floor(F.greatest("start_ms", "b_start_ms") / bucket_ms))).drop("_bucket")


def date_range_join(events: DataFrame, ranges: DataFrame, date: str, first: str, last: str, widen_days: int = 0) -> DataFrame:
    """Rows of events with each range that holds their date, both ends included and widened.

    Ranges are spread over their days, a day being the join key: a plain range condition would be a nested-loop join.
    """
    days = F.sequence(F.date_sub(F.col(first), widen_days), F.date_add(F.col(last), widen_days))
    spread = ranges.where(F.col(first).isNotNull() & F.col(last).isNotNull() & (F.col(first) <= F.col(last))).withColumn("_day", F.explode(days))
    return events.join(spread, F.col(date) == F.col("_day")).drop("_day")


def within_days(df: DataFrame, date: str, other: DataFrame, other_date: str, days: int = 7) -> DataFrame:
    """Rows strictly between the other table's first date less `days` and last date plus `days`."""
    bounds = other.agg(F.date_sub(F.min(other_date), days).alias("_low"), F.date_add(F.max(other_date), days).alias("_high"))
    return df.crossJoin(F.broadcast(bounds)).where((F.col(date) > F.col("_low")) & (F.col(date) < F.col("_high"))).drop("_low", "_high")  # one row


def union_intervals(df: DataFrame, keys: list[str], gap_ms: int = 0, pad_ms: int = 0, least_ms: int = 0, start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """Intervals padded, those closer than gap_ms merged, those shorter than least_ms left out."""
    padded = df.withColumn(start, F.col(start) - pad_ms).withColumn(end, F.col(end) + pad_ms)
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = padded.withColumn("_new", F.coalesce(F.col(start) - reach > gap_ms, F.lit(True)).cast("int")).withColumn("_island", island)
    merged = marked.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")
    return merged.where(F.col(end) - F.col(start) >= least_ms)


def sessions_by_gap(df: DataFrame, keys: list[str], gap_ms: int, start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """Adds session_id: a new one where the start lies gap_ms or more after everything before."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col(start) - reach >= gap_ms, F.lit(True)).cast("long")
    return df.withColumn("_new", fresh).withColumn("session_id", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
