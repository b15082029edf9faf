"""How much of a corpus was matched, by year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import n_words


def by_year(all_rows: DataFrame, matched: DataFrame, date: str, duration_s: str, text: str | None = None) -> DataFrame:
    """(year, n_all, n_matched, hours, [words,] match_fraction) of years with rows on both sides."""
    total = all_rows.where(F.col(date).isNotNull()).groupBy(F.year(date).cast("long").alias("year")).agg(F.count(F.lit(1)).alias("n_all"))
    extra = [F.sum(n_words(F.col(text))).alias("words")] if text else []
    hit = matched.where(F.col(date).isNotNull()).groupBy(F.year(date).cast("long").alias("year")).agg(F.count(F.lit(1)).alias("n_matched"), (F.sum(duration_s) / 3600).alias("hours"), *extra)
    return total.join(hit, "year").withColumn("match_fraction", F.col("n_matched") / F.col("n_all"))
