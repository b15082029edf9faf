"""Refining spoken passages by the labels of the segments that they overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.intervals import folded, overlap_join
from ..operators.keys import best_per_key
from ..operators.runs import label_runs, run_ends


def refine(segments: DataFrame, speeches: DataFrame, recording: str = "recording", label: str = "label", order: str = "pos", least_ms: int = 600, least_ratio: float = 0.25, least_score: float = 0.5, bucket_ms: int | None = 3_600_000) -> DataFrame:
    """The run of one label that fits each speech best.

    segments: recording, label, pos, start_ms, end_ms. speeches: recording, speech_id, b_start_ms, b_end_ms. Short segments
    go; runs of a label meet speeches that they overlap; each label is scored by the share of the speech that a run covers and
    by how much of the label's time the speech accounts for; the best run of each label, then the best label of each speech.
    bucket_ms: runs and speeches of a recording meet by the buckets of time that they touch, not all with all.
    """
    runs = label_runs(segments.where(F.col("end_ms") - F.col("start_ms") >= least_ms), [recording], label, [order])
    pairs = overlap_join(runs, speeches, recording, bucket_ms)
    pairs = pairs.withColumns({"duration_text": F.col("b_end_ms") - F.col("b_start_ms"), "duration_segment": F.col("end_ms") - F.col("start_ms")})
    pairs = pairs.withColumn("overlap_ratio", F.try_divide(F.col("overlap_ms"), F.col("duration_text"))).where("overlap_ratio > 1e-7")
    speech, by_label = Window.partitionBy(recording, "speech_id"), Window.partitionBy(recording, "speech_id", label)
    ratio = folded(F.sum("duration_segment").over(by_label) / F.sum("overlap_ms").over(speech))
    scored = pairs.withColumns({"speaker_ratio": ratio, "nr_speech_segments": F.count(F.lit(1)).over(speech)}).where(F.col("speaker_ratio") > least_ratio)
    edges = run_ends(scored, [recording, "speech_id"], label, "start_ms", "end_ms")
    wide = edges.withColumns({"run_start_ms": F.col("start_ms"), "start_segment_ms": F.min("start_ms").over(by_label), "end_segment_ms": F.max("end_ms").over(by_label)})
    wide = wide.withColumn("score_1", (F.col("overlap_ratio") + F.col("speaker_ratio")) / 2)
    one = best_per_key(wide, [recording, label, "speech_id"], "score_1", "run_start_ms", "run_id")
    length = folded((F.col("end_segment_ms") - F.col("start_segment_ms")) / F.col("duration_text"))
    one = one.withColumn("overall_score", (F.col("overlap_ratio") + F.col("speaker_ratio") + length) / 3)
    best = best_per_key(one, [recording, "speech_id"], "overall_score", "start_segment_ms", label).where(F.col("overall_score") > least_score)
    neighbours = Window.partitionBy(recording).orderBy("start_segment_ms", "speech_id")
    same = F.coalesce(F.col("start_segment_ms") == F.lag("start_segment_ms").over(neighbours), F.lit(False)) | F.coalesce(F.col("start_segment_ms") == F.lead("start_segment_ms").over(neighbours), F.lit(False))
    return best.select(
        recording, "speech_id", label, "start_segment_ms", "end_segment_ms", (F.col("end_segment_ms") - F.col("start_segment_ms")).alias("duration_segment_ms"),
        F.round("overall_score", 6).alias("overall_score"), "nr_speech_segments", same.alias("start_segment_same"),
    )
