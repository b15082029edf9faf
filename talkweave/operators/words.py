"""Timed words: index, slice by time, time bounds of word ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word_table(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, word_index, word): words of a text in order, indices from 0."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    return df.select(key, F.posexplode(words).alias("word_index", "word"))


def timed_words(df: DataFrame, key: str, words: str) -> DataFrame:
    """(key, word_index, word, start_time, end_time) from an array of timed words."""
    return df.select(key, F.posexplode(words).alias("word_index", "_w")).select(key, "word_index", "_w.word", "_w.start_time", "_w.end_time")


def shifted(words: str, seconds: Column) -> Column:
    """Timed words moved by so many seconds."""
    return F.transform(words, lambda w: F.struct(w["word"].alias("word"), (w["start_time"] + seconds).alias("start_time"), (w["end_time"] + seconds).alias("end_time")))


def index_at(words: str, t: Column) -> Column:
    """Index of the word at a time: the first that ends after it, the last one beyond all, null before the first."""
    n = F.size(words)
    later = F.array_position(F.transform(words, lambda w: w["end_time"] > t), True)
    return F.when((n > 0) & (t >= F.col(words)[0]["start_time"]), F.when(later > 0, later - 1).otherwise((n - 1).cast("long")))


def text_between(words: str, start: Column, end: Column) -> Column:
    """Words from the one at start to the one at end, both included; null where either is."""
    i, j = index_at(words, start), index_at(words, end)
    return F.when(j >= i, F.array_join(F.transform(F.slice(words, (i + 1).cast("int"), (j - i + 1).cast("int")), lambda w: w["word"]), " "))


def time_bounds(words: str, start: str, end: str) -> Column:
    """Times (start_time, end_time) of the word range [start, end): null bounds where an index is null; beyond the end, the
    last word's end."""
    n = F.size(words)
    first = F.try_element_at(F.col(words), (F.col(start) + 1).cast("int"))["start_time"]
    last = F.try_element_at(F.col(words), F.least(F.greatest(F.col(end), F.lit(1)), n).cast("int"))["end_time"]
    return F.struct(F.when(F.col(start).isNotNull(), first).alias("start_time"), F.when(F.col(end).isNotNull() & (n > 0), last).alias("end_time"))


def encoded_words(df: DataFrame, key: str, text: str, vocabulary: DataFrame) -> DataFrame:
    """(key, word_index, id): ids of a vocabulary (word, id), 0 for words that it lacks."""
    return word_table(df, key, text).join(vocabulary, "word", "left").select(key, "word_index", F.coalesce("id", F.lit(0)).alias("id"))


def vocabulary(df: DataFrame, text: str) -> DataFrame:
    """(word, id): distinct words numbered from 1 in sorted order.

    Numbered in two steps, within ranges of the sorted words and by the ranges' sizes, so no task sees all words.
    """
    from .shards import numbered

    words = df.select(F.explode(F.filter(F.split(text, r"\s+"), lambda w: w != "")).alias("word")).distinct()
    return numbered(words, "word", "id")


def decoded_words(df: DataFrame, key: str, order: str, ids: str, vocabulary: DataFrame) -> DataFrame:
    """(key, text): words of ids in order; ids that the vocabulary lacks (0) are left out."""
    named = df.join(vocabulary.select(F.col("id").alias(ids), "word"), ids)
    return named.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "word"))), lambda x: x["word"]), " ").alias("text"))
