"""From scored chunks to shards of training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import clean_chunk, head_error, piped_tags, tail_error
from ..functions.similarity import bleu_udf, first_word_udf, last_word_udf, word_error_udf
from ..operators.shards import chunk_ids, previous_text, shard_ids
from ..operators.upsert import by_model


def scored_models(chunks: DataFrame, models: dict[str, str], results: str = "transcription", text: str = "text") -> DataFrame:
    """Adds, for each model, its last transcription and the scores against the text: models maps a prefix to a model's name
    (two models give two columns of each score)."""
    for prefix, model in models.items():
        said = f"{prefix}_text"
        chunks = chunks.withColumn(said, by_model(results, model))
        chunks = chunks.withColumns({
            f"{prefix}_bleu": bleu_udf(text, said), f"{prefix}_wer": word_error_udf(text, said), f"{prefix}_first": first_word_udf(text, said), f"{prefix}_last": last_word_udf(text, said),
            f"{prefix}_cer_head": head_error(F.col(text), F.col(said)), f"{prefix}_cer_tail": tail_error(F.col(text), F.col(said)),
        })
    return chunks


def publish(chunks: DataFrame, hours: float = 25.0) -> DataFrame:
    """chunks: audio_file, speech_id, date, start_ms, end_ms, text, text_whisper, transcription. Adds chunk_id, shard, cleaned
    texts, previous_text, bleu, wer, cer_head, cer_tail and is_silence."""
    numbered = chunk_ids(chunks, "audio_file", "start_ms", "end_ms").withColumn("duration_ms", F.col("end_ms") - F.col("start_ms"))
    placed = shard_ids(numbered, ["date", "audio_file", "chunk_id"], "duration_ms", hours)
    cleaned = placed.withColumns({"text": clean_chunk(F.col("text")), "text_timestamps": piped_tags(F.col("text_whisper"))})
    scored = cleaned.withColumns({
        "bleu": bleu_udf("text", "transcription"), "wer": word_error_udf("text", "transcription"),
        "cer_head": head_error(F.col("text"), F.col("transcription")), "cer_tail": tail_error(F.col("text"), F.col("transcription")),
        "is_silence": (F.trim("text") == "") & (F.trim("transcription") == ""),
    })
    return scored.withColumn("previous_text", previous_text(["audio_file", "speech_id"], "chunk_id"))
