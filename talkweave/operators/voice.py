"""Voice activity: hysteresis over scores, and groups of segments."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def binarize(scores: list[float], step: float, onset: float = 0.5, offset: float = 0.363, max_duration: float = float("inf"), pad_onset: float = 0.0, pad_offset: float = 0.0, min_duration_on: float = 0.0, min_duration_off: float = 0.0) -> list[tuple[float, float]]:
    """Active stretches (seconds) of frame scores: begun above onset, ended below offset. One that lasts too long is cut at the
    lowest score of its second half. They are then padded, joined across gaps shorter than min_duration_off (and where padding
    makes them touch), and left out below min_duration_on."""
    if not scores:
        return []
    out, start, seen = [], 0.0, [scores[0]]
    active = scores[0] > onset
    for k, y in enumerate(scores[1:], 1):
        t = k * step
        if active:
            if t - start > max_duration:
                half = len(seen) // 2
                low = half + min(range(len(seen) - half), key=lambda i: seen[half + i])
                cut = start + low * step
                out.append((start, cut))
                start, seen = cut, seen[low:]
            if y < offset:
                out.append((start, t))
                active = False
        elif y > onset:
            start, seen, active = t, [], True
        seen.append(y)
    if active:
        out.append((start, len(scores) * step))
    found = [(s - pad_onset, e + pad_offset) for s, e in out if e > s]
    if pad_onset or pad_offset or min_duration_off:
        joined: list[tuple[float, float]] = []
        for s, e in found:
            if joined and s - joined[-1][1] <= min_duration_off:
                joined[-1] = (joined[-1][0], max(e, joined[-1][1]))
            else:
                joined.append((s, e))
        found = joined
    return [(s, e) for s, e in found if e - s >= min_duration_on]


def merged_groups(segments: list[tuple[float, float]], chunk_s: float = 30.0) -> list[dict]:
    """Segments in groups that last chunk_s at most; one longer than that is a group of its own."""
    out: list[dict] = []
    for s, e in segments:
        if out and e - out[-1]["start"] <= chunk_s:
            out[-1]["end"] = e
            out[-1]["segments"].append((s, e))
        else:
            out.append({"start": s, "end": e, "segments": [(s, e)]})
    return out


def active_stretches(df: DataFrame, key: str, order: str, score: str, step: float, **limits: float) -> DataFrame:
    """(key, start, end) of each key's scores in order."""
    kind = dict(df.dtypes)[key]

    def run(k: tuple, g: pd.DataFrame) -> pd.DataFrame:
        found = binarize(g.sort_values("_o")["_s"].tolist(), step, **limits)
        return pd.DataFrame([(k[0], s, e) for s, e in found], columns=[key, "start", "end"])

    return df.select(key, F.col(order).alias("_o"), F.col(score).cast("double").alias("_s")).groupBy(key).applyInPandas(run, f"`{key}` {kind}, start double, `end` double")
