"""Waveform and batch helpers as array expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType


def cut_audio(audio: str, start_ms: Column, end_ms: Column, rate: int = 16_000) -> Column:
    """Samples of an interval."""
    first = F.floor(start_ms * rate / 1000).cast("int")
    return F.slice(F.col(audio), F.greatest(first, F.lit(0)) + 1, F.greatest(F.floor(end_ms * rate / 1000).cast("int") - first, F.lit(0)))


@F.pandas_udf(ArrayType(IntegerType()))
def prefix_sums(lengths: pd.Series) -> pd.Series:
    """Where each piece begins; one running sum a row, which lambda functions could only form again for every element."""
    return lengths.map(lambda x: None if x is None else np.cumsum(np.concatenate([[0], x[:-1]])).astype("int32") if len(x) else x)


def unflattened(values: str, lengths: str) -> Column:
    """A flat array cut into pieces of these lengths."""
    return F.transform(F.arrays_zip(prefix_sums(F.col(lengths).cast("array<int>")).alias("b"), F.col(lengths).alias("n")), lambda x: F.slice(F.col(values), x["b"] + 1, x["n"]))


def frames_of(values: str, width: int, spans: str) -> Column:
    """Of flat scores, `width` a frame, those of each span (start, end) of frames: an array for each run of speech."""
    return F.transform(spans, lambda s: F.slice(F.col(values), s["start"] * width + 1, (s["end"] - s["start"]) * width))


def collated(df: DataFrame, batch: str, values: str, fill: float = 0.0) -> DataFrame:
    """Rows with values, filled up to the longest of their batch, and their own length (n)."""
    longest = df.where(F.col(values).isNotNull()).withColumn("n", F.size(values))
    most = longest.groupBy(batch).agg(F.max("n").alias("_most"))
    fills = F.array_repeat(F.lit(fill).cast("float"), F.col("_most") - F.col("n"))
    return longest.join(most, batch).withColumn(values, F.concat(values, fills)).drop("_most")


def as_floats(audio: str) -> Column:
    return F.col(audio).cast("array<float>")


def share(df: DataFrame, n: int, k: int, order: str) -> DataFrame:
    """Every n-th row by position, beginning with the k-th: a worker's share."""
    from .shards import numbered

    return numbered(df, order, "_pos").where((F.col("_pos") - 1) % n == k).drop("_pos")


def batches(df: DataFrame, order: str, size: int) -> DataFrame:
    """Adds batch: 0, 1, ... for each `size` rows in order."""
    from .shards import numbered

    return numbered(df, order, "_pos").withColumn("batch", F.floor((F.col("_pos") - 1) / size)).drop("_pos")
