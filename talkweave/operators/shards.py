"""Global numbering and running sums in two phases, shards of bounded length, previous texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from ..storage import stored


def running_sum(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Adds the sum of value over all rows up to this one, in a total order; nulls count as 0.

    The rows are dealt to contiguous ranges of the order, and among equals of a hash of the whole row, so that no key makes
    a range larger than a task can take; each task sorts its range and adds up. The result is stored once: the ranges that
    the totals are taken from are those that the sums were made in, whatever the columns are and however partitions are
    joined. Then each range's offset, one row a range, is added. One shuffle, and no window over rows.
    """
    part, run, tie = _fresh(df, "_part", "_run", "_tie")
    whole = isinstance(df.schema[value].dataType, IntegralType)
    kind, named = (pa.int64(), "long") if whole else (pa.float64(), "double")
    hashed = F.xxhash64(*(F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and "variant" not in t))
    ordered = df.withColumn(tie, hashed).repartitionByRange(*order, tie).sortWithinPartitions(*order, tie).drop(tie)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = TaskContext.get().partitionId(), pa.scalar(0, kind)
        for batch in batches:
            if batch.num_rows:
                sums = pc.cumulative_sum(pc.fill_null(batch.column(value).cast(kind), pa.scalar(0, kind)), start=total)
                total = sums[-1]
                yield batch.append_column(run, sums).append_column(part, pa.array([at] * batch.num_rows, pa.int64()))

    summed = stored(ordered.mapInArrow(add, StructType(df.schema.fields).add(run, named).add(part, "long")))
    totals = summed.groupBy(part).agg(F.sum(F.coalesce(F.col(value).cast(named), F.lit(0).cast(named))).alias("_total"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = totals.select(part, F.coalesce(F.sum("_total").over(before), F.lit(0).cast(named)).alias("_before"))
    return summed.join(F.broadcast(offsets), part).withColumn(out, F.col(run) + F.col("_before")).drop(part, run, "_before")


def _fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def numbered(df: DataFrame, order: str, out: str) -> DataFrame:
    """Adds 1, 2, ... in a total order."""
    return running_sum(df.withColumn("_one", F.lit(1).cast("long")), [order], "_one", out).drop("_one")


def shard_ids(df: DataFrame, order: list[str], duration_ms: str, hours: float = 25.0) -> DataFrame:
    """Adds shard: rows in order, cut where the running duration passes a multiple of `hours`; four digits."""
    summed = running_sum(df, order, duration_ms, "_cumulated")
    number = F.floor(F.col("_cumulated") / F.lit(3.6e6) / F.lit(hours)).cast("string")
    return summed.withColumn("shard", F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number)).drop("_cumulated")


def chunk_ids(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Adds chunk_id: 0, 1, ... within the key."""
    return df.withColumn("chunk_id", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)


def previous_text(keys: list[str], order: str, text: str = "text", start: str = "start_ms", end: str = "end_ms", empty: str = "<|nospeech|>") -> Column:
    """The text of the row before where that ends exactly where this one starts and says something; else null."""
    w = Window.partitionBy(*keys).orderBy(order)
    before = F.lag(text).over(w)
    return F.when((F.col(start) == F.lag(end).over(w)) & (before != "") & (before != empty), before)


def renumbered(df: DataFrame, file: str, existing: DataFrame, existing_file: str) -> DataFrame:
    """Adds new_file: the shard number in a file name moved on behind the highest existing one, four digits."""
    number = lambda c: F.regexp_extract(c, r"(\d+)(?=\.parquet$)", 1).cast("int")
    top = existing.agg((F.coalesce(F.max(number(existing_file)), F.lit(-1)) + 1).alias("_offset"))
    moved = F.lpad((number(file) + F.col("_offset")).cast("string"), 4, "0")
    return df.crossJoin(F.broadcast(top)).withColumn("new_file", F.concat(F.regexp_replace(file, r"\d+\.parquet$", ""), moved, F.lit(".parquet"))).drop("_offset")  # one row
