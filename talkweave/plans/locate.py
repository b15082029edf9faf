"""Locating written speeches in the transcripts of recordings of about their date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalise import normalize_udf
from ..functions.similarity import locate_udf
from ..operators.intervals import date_range_join
from ..operators.keys import best_per_key, drop_ambiguous
from ..operators.words import time_bounds


def locate_speeches(speeches: DataFrame, recordings: DataFrame, widen_days: int = 0, threshold: float = 55, language: str = "sv", done: DataFrame | None = None) -> DataFrame:
    """Each speech (speech_id, date, text) in its best recording (audio_path, date_start, date_end, inference_text, words):
    word_start, word_end, score, start_time, end_time, duration.

    Ids alone go through the date join; texts are attached to the distinct pairs, for the similarity search is what costs.
    Speeches with several candidates lose those that lack a bound. done: speeches already located, left out.
    """
    if done is not None:
        speeches = speeches.join(done.select("speech_id").distinct(), "speech_id", "left_anti")
    pairs = date_range_join(speeches.select("speech_id", "date"), recordings.select("audio_path", "date_start", "date_end"), "date", "date_start", "date_end", widen_days).select("speech_id", "audio_path").distinct()
    texts = speeches.select("speech_id", "text").groupBy("speech_id").agg(F.min("text").alias("text")).withColumn("text_normalized", normalize_udf(language)("text"))
    sides = recordings.select("audio_path", normalize_udf(language)("inference_text").alias("inference_normalized"), "words")
    both = pairs.join(texts, "speech_id").join(sides, "audio_path")
    found = both.withColumn("_m", locate_udf(threshold)("text_normalized", "inference_normalized")).select("speech_id", "audio_path", "text_normalized", "_m.*", "words")
    timed = found.withColumn("_t", time_bounds("words", "word_start", "word_end")).select("*", "_t.*").drop("_t", "words")
    known = drop_ambiguous(timed.where("start_time IS NOT NULL OR end_time IS NOT NULL"), ["speech_id"], ["start_time", "end_time"])
    return best_per_key(known, ["speech_id"], "score", "audio_path").withColumn("duration", F.col("end_time") - F.col("start_time"))
