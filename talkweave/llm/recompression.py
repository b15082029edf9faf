"""Operator 3: repeated passages by recompression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._recompression import parse
from ._repeats import gram_hashes, repeat_sql, repeats
from ._tables import dropped, stored, table

#: Words that a repeat has at least, and words from which a symbol of the parse merges no further.
LENGTH, FULL = 50, 8
#: Rounds over the whole corpus at most: each joins a quarter of the pairs that there are.
GLOBAL_ROUNDS = 4


def shared_windows(tokens: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose `length` tokens start at an earlier position too, and the first such position.

    Hashes propose, all tokens of each proposed pair are compared.
    """
    h = gram_hashes(tokens, length)
    inside = np.flatnonzero(np.arange(len(h)) + length <= ends[: len(h)])
    _, first, group = np.unique(h[inside], return_index=True, return_inverse=True)
    source = inside[first[group]]
    later = source != inside
    hits, source = inside[later], source[later]
    good = np.ones(len(hits), bool)
    for k in range(length):
        good &= tokens[hits + k] == tokens[source + k]
    return hits[good], source[good]


def merged(shared: DataFrame, rounds: int = GLOBAL_ROUNDS) -> DataFrame:
    """Symbols that are at several places, joined over the whole corpus in rounds of runs and pairs by name: where one symbol
    ends wherever it is, another one starts, and that starts nowhere else, both get one new name. Occurrences keep the first
    part's place and reach to the last part. So nothing is lost: where a part is, the pair is.

    shared: as from `_repeats.shared_anchors`. Each round joins a table with one row a name; a hash bit tells left names from
    right ones, another one each round, so that pairs don't overlap. Occurrences are looked at once before and once after.
    """
    place = F.xxhash64("doc_id", "version", "at").bitwiseAND(F.lit((1 << 40) - 1))
    names = shared.where(place == F.col("first")).groupBy("key", "n", "starts", "ends", "size").agg(F.lit(1).alias("one")).drop("one")
    # One row a name: head is its first part, reach how far behind it the last one begins.
    names = names.where("starts IS NOT NULL AND ends IS NOT NULL")
    # Names that start alike, or end alike, wherever they are, are left alone: only one of them could be the neighbour.
    for c in ("starts", "ends"):
        names = names.join(names.groupBy("n", c).agg(F.count(F.lit(1)).alias("m")).where("m = 1").drop("m"), ["n", c], "left_semi")
    names = stored(names.select(F.col("key").alias("name"), F.col("key").alias("head"), F.array("key").alias("parts"), "n", "starts", "ends", F.lit(0).alias("reach"), "size"))
    for k in range(rounds):
        side = F.xxhash64("name", F.lit(k)) < 0
        right = names.where(side).select(F.col("name").alias("name_"), F.col("parts").alias("parts_"), "n", F.col("starts").alias("ends"), F.col("ends").alias("ends_"), F.col("reach").alias("reach_"), F.col("size").alias("size_"))
        pairs = stored(names.where(~side).join(right, ["n", "ends"]))
        if pairs.isEmpty():
            dropped(pairs)
            break
        gone = pairs.select(F.explode(F.array("name", "name_")).alias("name"))
        new = pairs.select(F.xxhash64("name", "name_").alias("name"), "head", F.concat("parts", "parts_").alias("parts"), "n", "starts", F.col("ends_").alias("ends"), (F.col("size") + F.col("reach_")).alias("reach"), (F.col("size") + F.col("size_")).alias("size"))
        before, names = names, stored(names.join(gone, "name", "left_anti").unionByName(new))
        dropped(before, pairs)
    parts = names.where(F.size("parts") > 1).select(F.posexplode("parts").alias("i", "key"), F.when(F.col("head") == F.col("key"), F.col("reach")).alias("to"), "name")
    both = shared.join(parts.where("i = 0 OR to IS NULL"), "key", "left").where("i IS NULL OR i = 0")
    return both.select(F.coalesce("name", "key").alias("key"), "home", "doc_id", "version", "at", (F.col("at") + F.coalesce("to", F.lit(0))).alias("reach"))


def repeated_passages(docs: DataFrame, length: int = LENGTH, full: int = FULL, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Spans of at least `length` words that occur earlier; rows, order and special cases as in `_repeats.spans`.

    Runs and pairs of words are renamed text by text until symbols hold `full` words, by hashes of their content: the same
    on all executors. Spark then counts the names; those that occur once go, and the rest are joined to higher symbols in
    rounds over the whole corpus (`merged`). Around the symbols that are left, words are compared. A repeat of just `length`
    words between different contexts lacks a common symbol in some 2 of 100,000 cases (tests/llm measure it); longer ones have
    many.
    """
    return repeats(docs, lambda tokens, first: parse(tokens, first, full), shared_windows, length, length - full, merged, text, key)


def op3_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`repeated_passages` over the documents table."""
    return repeated_passages(table(spark, sf_dir, "documents"))


SQL = repeat_sql(LENGTH)
