"""Rows and values per key: first, best, ambiguous, present elsewhere. Every choice has an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def best_per_key(df: DataFrame, keys: list[str], score: str, *ties: Column | str) -> DataFrame:
    """The row of the highest score of each key; ties in the given order, null scores last."""
    return first_per_key(df, keys, F.desc_nulls_last(score), *ties)


def first_values(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """For each key and column the first value that isn't null. Null keys are left out."""
    others = [c for c in df.columns if c not in keys and c != order]
    kept = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return kept.groupBy(*keys).agg(*(F.expr(f"min_by(`{c}`, `{order}`) FILTER (WHERE `{c}` IS NOT NULL)").alias(c) for c in others))


def multiple(keys: list[str]) -> Column:
    """Whether a row's key occurs more than once."""
    return F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1


def drop_ambiguous(df: DataFrame, keys: list[str], bounds: list[str]) -> DataFrame:
    """Leaves out rows that lack a bound while their key has several rows."""
    missing = F.exists(F.array(*(F.col(b).isNull() for b in bounds)), lambda x: x)
    return df.withColumn("_many", multiple(keys)).where(~(missing & F.col("_many"))).drop("_many")


def basename(path: Column | str) -> Column:
    return F.substring_index(F.col(path) if isinstance(path, str) else path, "/", -1)


def not_done(df: DataFrame, done: DataFrame, path: str, done_path: str) -> DataFrame:
    """Rows whose file name is not among the finished ones."""
    return df.join(done.select(basename(done_path).alias("_done")).distinct(), basename(path) == F.col("_done"), "left_anti")


def only_done(df: DataFrame, done: DataFrame, path: str, done_path: str) -> DataFrame:
    return df.join(done.select(basename(done_path).alias("_done")).distinct(), basename(path) == F.col("_done"), "left_semi")


def distinct_text(column: str, separator: str = ", ") -> Column:
    """Aggregate: distinct values that aren't null, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(column)), separator)


def ordered_text(order: str, column: str, separator: str = " ") -> Column:
    """Aggregate: texts joined in an explicit order; nulls are left out."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(column).alias("_v"))))
    return F.array_join(F.transform(pairs, lambda x: x["_v"]), separator)


def ordered_lists(order: str, column: str) -> Column:
    """Aggregate: lists put one after the other in an explicit order."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(column).alias("_v"))))
    return F.flatten(F.filter(F.transform(pairs, lambda x: x["_v"]), lambda v: v.isNotNull()))


def coalesced(df: DataFrame, first: str, second: str) -> DataFrame:
    """first, filled from second, which goes."""
    return df.withColumn(first, F.coalesce(first, second)).drop(second)


def unique_columns(df: DataFrame) -> DataFrame:
    """The first of equally named columns."""
    names = df.columns
    if len(set(names)) == len(names):
        return df
    numbered = df.toDF(*(f"{c}_{i}" for i, c in enumerate(names)))
    return numbered.select(*(F.col(f"{c}_{i}").alias(c) for i, c in enumerate(names) if names.index(c) == i))


def top_groups(df: DataFrame, key: str, n: int = 10_000) -> DataFrame:
    """The n commonest values with their counts; equal counts by value."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key).limit(n)


def top_entries(column: str, n: int, pinned: str) -> Column:
    """Of a map of numbers the n largest entries, and that of the pinned key wherever it ranks."""
    entries = F.array_sort(F.map_entries(column), lambda a, b: F.when(a["value"] > b["value"], -1).when(a["value"] < b["value"], 1).when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    first = F.slice(entries, 1, n)
    rest = F.filter(F.map_entries(column), lambda e: (e["key"] == pinned) & ~F.exists(first, lambda x: x["key"] == pinned))
    return F.map_from_entries(F.concat(first, rest))


def corrected(df: DataFrame, column: str, rules: list[tuple[str, str, object]]) -> DataFrame:
    """Values overwritten where `column` holds a pattern: (pattern, target column, value), a later rule over an earlier one."""
    for pattern, target, value in rules:
        df = df.withColumn(target, F.when(F.coalesce(F.col(column).rlike(pattern), F.lit(False)), F.lit(value)).otherwise(F.col(target)))
    return df


def lookup_first(df: DataFrame, path: str, table: DataFrame, file: str, order: str, parts: int = 1) -> DataFrame:
    """Each row with the first row of a table whose file is the end of its path (the last `parts` parts): an equi join on those
    instead of a search for substrings. Rows without one keep nulls."""
    from ..functions.cleaning import last_parts

    first = first_per_key(table.withColumn("_file", last_parts(F.col(file), parts)), ["_file"], order)
    return df.join(first, last_parts(F.col(path), parts) == F.col("_file"), "left").drop("_file")


def mapped_lists(df: DataFrame, key: str, table: DataFrame, order: str, values: str, out: str) -> DataFrame:
    """Each row with the ordered list of a table's values for its key; null where there are none."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), F.col(values).alias("_v")))), lambda x: x["_v"])
    return df.join(table.groupBy(key).agg(listed.alias(out)), key, "left")


def large_enough(files: DataFrame, size: str, least: int, path: str, without: list[str]) -> DataFrame:
    """Files of more than `least` bytes that aren't on a list."""
    return files.where(F.col(size).isNotNull() & (F.col(size) > least) & ~basename(path).isin(without))
