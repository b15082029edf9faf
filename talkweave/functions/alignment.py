"""Aligning known text to frame scores, sentence spans, and features of audio, in numpy."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .slices import by_slices


def forced_alignment(log_probs: np.ndarray, tokens: list[int], blank: int = 0) -> list[tuple[int, int, float]]:
    """(first frame, end frame, mean log probability) of each token on the best path of a CTC model: blanks may lie between
    tokens, and must between equal ones. Empty if there are fewer frames than the tokens need."""
    n, m = len(log_probs), len(tokens)
    if not m or n < m + sum(a == b for a, b in zip(tokens, tokens[1:])):
        return []
    states = [blank]
    for t in tokens:
        states += [t, blank]
    s = np.array(states)
    skip = np.zeros(len(s), bool)
    skip[2:] = (s[2:] != blank) & (s[2:] != s[:-2])
    best = np.full(len(s), -np.inf)
    best[0], best[1] = log_probs[0, blank], log_probs[0, tokens[0]]
    came = np.zeros((n, len(s)), np.int8)
    for k in range(1, n):
        options = np.stack([best, np.concatenate([[-np.inf], best[:-1]]), np.where(skip, np.concatenate([[-np.inf, -np.inf], best[:-2]]), -np.inf)])
        came[k] = options.argmax(0)
        best = options.max(0) + log_probs[k, s]
    at = len(s) - 1 if best[-1] >= best[-2] else len(s) - 2
    path = np.empty(n, np.int64)
    for k in range(n - 1, -1, -1):
        path[k] = at
        at -= int(came[k, at])
    out = []
    for i, t in enumerate(tokens):
        frames = np.flatnonzero(path == 2 * i + 1)
        out.append((int(frames[0]), int(frames[-1]) + 1, float(log_probs[frames, t].mean())))
    return out


def word_times(log_probs: np.ndarray, words: list[str], letters: dict[str, int], seconds_a_frame: float, start_s: float = 0.0, gap: str = "|", blank: int = 0) -> list[dict]:
    """Time and score of each word; letters that the model lacks are passed over, words without any have null times."""
    tokens, owner = [], []
    for k, w in enumerate(words):
        known = [letters[c] for c in w if c in letters]
        if known and tokens and gap in letters:
            tokens.append(letters[gap])
            owner.append(-1)
        tokens += known
        owner += [k] * len(known)
    found = forced_alignment(log_probs, tokens, blank)
    out = [{"word": w, "start_time": None, "end_time": None, "score": None} for w in words]
    for k in range(len(words)):
        mine = [f for f, o in zip(found, owner) if o == k]
        if mine:
            out[k] |= {"start_time": start_s + mine[0][0] * seconds_a_frame, "end_time": start_s + mine[-1][1] * seconds_a_frame, "score": float(np.mean([f[2] for f in mine]))}
    return out


def ctc_segmentation(log_probs: np.ndarray, utterances: list[list[int]], seconds_a_frame: float, blank: int = 0, window: int = 30) -> list[dict]:
    """Start, end and confidence of utterances that are spoken in order somewhere in the frames (Kurzinger et al., 2020).

    Frames before the first and behind the last utterance cost nothing; within, each frame continues its token (or a blank)
    or moves on to the next. confidence: the least mean log probability of any `window` frames of the utterance. Utterances
    without a token have nulls; all have, where there are fewer frames than tokens.
    """
    tokens = [t for u in utterances for t in u]
    n, m = len(log_probs), len(tokens)
    none = {"start_time": None, "end_time": None, "confidence": None}
    if not m or n < m:
        return [dict(none) for _ in utterances]
    emit = log_probs[:, tokens]
    stay = np.maximum(emit, log_probs[:, [blank]])
    best = np.full((n, m), -np.inf)
    moved = np.zeros((n, m), bool)
    best[0, 0] = emit[0, 0]
    moved[0, 0] = True
    for k in range(1, n):
        come = np.concatenate([[0.0], best[k - 1, :-1]]) + emit[k]
        keep = best[k - 1] + stay[k]
        moved[k] = come > keep
        best[k] = np.where(moved[k], come, keep)
    k, j = int(best[:, -1].argmax()), m - 1
    first, last, score = np.full(m, -1), np.full(m, -1), np.full(n, np.nan)
    while j >= 0:
        if last[j] < 0:
            last[j] = k
        score[k] = emit[k, j] if moved[k, j] else stay[k, j]
        if moved[k, j]:
            first[j] = k
            j -= 1
        k -= 1
    # A token ends with the last frame that says it; the blanks behind it are pause.
    for j in range(m):
        own = np.flatnonzero(emit[first[j] : last[j] + 1, j] > log_probs[first[j] : last[j] + 1, blank])
        last[j] = first[j] + (int(own[-1]) if len(own) else 0)
    out, at = [], 0
    for u in utterances:
        if not u:
            out.append(dict(none))
            continue
        a, b = int(first[at]), int(last[at + len(u) - 1]) + 1
        s = np.nan_to_num(score[a:b])
        size = min(window, len(s))
        sums = np.convolve(s, np.ones(size), "valid") / size
        out.append({"start_time": a * seconds_a_frame, "end_time": b * seconds_a_frame, "confidence": float(sums.min())})
        at += len(u)
    return out


def text_tokens(text: str, letters: dict[str, int], gap: str = "|") -> list[int]:
    """Letters of a text that a model knows, words apart by its gap."""
    out: list[int] = []
    for w in text.split():
        known = [letters[c] for c in w if c in letters]
        if known and out and gap in letters:
            out.append(letters[gap])
        out += known
    return out


def word_times_udf(letters: dict[str, int], seconds_a_frame: float, gap: str = "|", blank: int = 0):
    """Arrow UDF: (flat log probabilities, text, start in seconds) -> array<struct<word, start_time, end_time, score>>; a row
    holds the frames of one stretch of speech."""

    @F.pandas_udf("array<struct<word: string, start_time: double, end_time: double, score: double>>")
    def udf(values: pd.Series, texts: pd.Series, starts: pd.Series) -> pd.Series:
        width = max(letters.values()) + 1

        def one(v, t, s):
            if v is None or t is None:
                return None
            return word_times(np.asarray(v, float).reshape(-1, width), t.split(), letters, seconds_a_frame, float(s or 0), gap, blank)

        return pd.Series([one(*x) for x in zip(values, texts, starts)])

    return udf


def segments_udf(letters: dict[str, int], seconds_a_frame: float, gap: str = "|", blank: int = 0):
    """Arrow UDF: (flat log probabilities, array of utterances) -> array<struct<start_time, end_time, confidence>>."""

    @F.pandas_udf("array<struct<start_time: double, end_time: double, confidence: double>>")
    def udf(values: pd.Series, utterances: pd.Series) -> pd.Series:
        width = max(letters.values()) + 1

        def one(v, u):
            if v is None or u is None:
                return None
            return ctc_segmentation(np.asarray(v, float).reshape(-1, width), [text_tokens(t or "", letters, gap) for t in u], seconds_a_frame, blank)

        return pd.Series([one(*x) for x in zip(values, utterances)])

    return udf


def log_mel_udf(bands: int = 80, rate: int = 16_000):
    """Arrow UDF: samples -> flat log mel power, `bands` values a frame."""

    @F.pandas_udf("array<float>")
    def udf(audio: pd.Series) -> pd.Series:
        return audio.map(lambda x: None if x is None else log_mel(np.asarray(x, float), bands, rate=rate).T.astype("float32").ravel())

    return udf


_STOP = re.compile(r"(?<![.!?…])[.!?…]++[\"'”’)\]]*+(?=\s|$)")
_BLANKS = re.compile(r"\s*")


def sentences(text: str, abbreviations: tuple[str, ...] = ()) -> list[tuple[int, int]]:
    """Character spans of sentences: up to . ! ? … and closing quotes before white space and no small letter, but not after an
    abbreviation, an initial or a number with a dot. The text is passed once, however much of it one sentence takes."""
    short = {a.lower() for a in abbreviations}
    out, start, seen = [], 0, 0
    for m in _STOP.finditer(text):
        end, before, seen = m.end(), seen, m.end()
        behind = _BLANKS.match(text, end).end()
        after = text[behind : behind + 1]
        if after and after.islower():
            continue
        if after and m[0] == ".":
            word = text[before:end].rsplit(None, 1)[-1]  # white space follows every stop, so it began behind the last one
            if word.lower() in short or re.fullmatch(r"\w\.|\d+\.", word):
                continue
        out.append((_BLANKS.match(text, start).end(), end))
        start = end
    rest = text[start:]
    if rest.strip():
        out.append((start + len(rest) - len(rest.lstrip()), start + len(rest.rstrip())))
    return out


def mel_filters(bands: int = 80, size: int = 400, rate: int = 16_000) -> np.ndarray:
    """Triangular filters on the mel scale (linear to 1 kHz, logarithmic above), each of the same area."""
    to_hz = lambda m: np.where(m < 15, m * 200 / 3, 1000 * np.exp(np.log(6.4) / 27 * (m - 15)))
    top = 15 + np.log(rate / 2 / 1000) * 27 / np.log(6.4)
    edges = to_hz(np.linspace(0, top, bands + 2))
    bins = np.fft.rfftfreq(size, 1 / rate)
    up = (bins - edges[:-2, None]) / np.diff(edges)[:-1, None]
    down = (edges[2:, None] - bins) / np.diff(edges)[1:, None]
    return np.maximum(0, np.minimum(up, down)) * (2 / (edges[2:] - edges[:-2]))[:, None]


def log_mel(audio: np.ndarray, bands: int = 80, size: int = 400, hop: int = 160, rate: int = 16_000) -> np.ndarray:
    """Log mel power (bands x frames), not more than 8 decades below its maximum, scaled to about -1..1."""
    padded = np.pad(np.asarray(audio, float), size // 2, mode="reflect" if len(audio) > size // 2 else "constant")
    count = max(0, (len(padded) - size) // hop)
    frames = np.lib.stride_tricks.sliding_window_view(padded, size)[::hop][:count]
    power = np.abs(np.fft.rfft(frames * np.hanning(size + 1)[:-1])) ** 2
    logs = np.log10(np.maximum(mel_filters(bands, size, rate) @ power.T, 1e-10))
    return (np.maximum(logs, logs.max(initial=-10.0) - 8) + 4) / 4


def sentences_udf(abbreviations: tuple[str, ...] = ()):
    """Arrow UDF: text -> array<struct<start, end, text>>. Sentences go to Arrow columns a slice of texts at a time."""

    @F.arrow_udf("array<struct<start: int, `end`: int, text: string>>")
    def udf(texts: pa.Array) -> pa.Array:
        item = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())])

        def found(part: list) -> pa.Array:
            starts, ends, said, offsets = [], [], [], [0]
            for t in part:
                for a, b in () if t is None else sentences(t, abbreviations):
                    starts.append(a)
                    ends.append(b)
                    said.append(t[a:b])
                offsets.append(len(starts))
            columns = [pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(said, pa.string())]
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(item)), mask=pa.array([t is None for t in part], pa.bool_()))

        return by_slices(texts, found)

    return udf


def numeric_tokens(vocabulary: dict[str, int], signs: str = "0123456789%$£") -> list[int]:
    """Ids of tokens with a digit or such a sign: what a recogniser is kept from writing."""
    return sorted(i for t, i in vocabulary.items() if any(c in signs for c in t))
