"""Runs of equal labels in ordered segments (gaps and islands)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def changes(label: str, w: WindowSpec) -> Column:
    """Whether the label differs from the one before; true for the first row."""
    return (F.row_number().over(w) == 1) | ~F.col(label).eqNullSafe(F.lag(label).over(w))


def ends(label: str, w: WindowSpec) -> Column:
    """Whether the label differs from the one after; true for the last row."""
    return F.lead(F.lit(1)).over(w).isNull() | ~F.col(label).eqNullSafe(F.lead(label).over(w))


def with_run_id(df: DataFrame, keys: list[str], label: str, *order: str) -> DataFrame:
    """Adds run_id: 1, 2, ... for each stretch of equal labels within the keys. One shuffle, on the keys."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_new", changes(label, w).cast("long")).withColumn("run_id", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def run_ends(df: DataFrame, keys: list[str], label: str, *order: str) -> DataFrame:
    """The rows that begin or end a run."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({"_a": changes(label, w), "_b": ends(label, w)}).where("_a OR _b").drop("_a", "_b")


def label_runs(segments: DataFrame, keys: list[str], label: str, order: list[str], start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """One row a run: keys, run_id, label, start and end over its first and last segments."""
    w = Window.partitionBy(*keys).orderBy(*order)
    edges = with_run_id(segments, keys, label, *order).withColumn("_b", ends(label, w)).withColumn("_a", changes(label, w)).where("_a OR _b")
    return edges.groupBy(*keys, "run_id").agg(F.first(label).alias(label), F.min(start).alias(start), F.max(end).alias(end))


def true_regions(df: DataFrame, keys: list[str], flag: str, order: str) -> DataFrame:
    """(keys, first, last, n): stretches of true values between those that aren't, by their first and last place."""
    runs = with_run_id(df.withColumn("_f", F.coalesce(F.col(flag), F.lit(False))), keys, "_f", order)
    return runs.where("_f").groupBy(*keys, "run_id").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n")).drop("run_id")
