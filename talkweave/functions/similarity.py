"""Similarity kernels in plain Python and numpy, and their Arrow UDFs."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def lcs_length(a: str | list, b: str | list) -> int:
    """Longest common subsequence, bit-parallel over a."""
    if not a or not b:
        return 0
    return _lcs_length(_masks(a), len(a), b)


def _masks(a: str | list) -> dict:
    """The places of each item, as bits."""
    masks: dict = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    return masks


def _lcs_length(masks: dict, size: int, b: str | list) -> int:
    full = (1 << size) - 1
    s = full
    for y in b:
        if y in masks:
            u = s & masks[y]
            s = (s + u | s - u) & full
    return size - s.bit_count()


def ratio(a: str, b: str) -> float:
    """Similarity in 0..100: twice the common subsequence against both lengths; 100 for two empty texts."""
    n = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / n if n else 100.0


def edit_distance(a: list | str, b: list | str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def word_error(reference: str | None, hypothesis: str | None) -> float | None:
    """Word edits against the reference's words; null where either is null or the reference has no word."""
    if reference is None or hypothesis is None or not reference.split():
        return None
    return edit_distance(reference.split(), hypothesis.split()) / len(reference.split())


def bleu(reference: str | None, hypothesis: str | None, weights: tuple[float, ...] = (0.25, 0.25, 0.25, 0.25)) -> float | None:
    """Clipped n-gram precision with brevity penalty; zero counts are smoothed by the fourth method of Chen and Cherry (2014):
    1 / (2^k * 5 / ln(length)) with k rising at each zero."""
    if reference is None or hypothesis is None:
        return None
    r, h = reference.split(), hypothesis.split()
    if not h or not r:
        return 0.0
    logs, zeros = 0.0, 1
    for n, weight in enumerate(weights, 1):
        mine = Counter(tuple(h[i : i + n]) for i in range(len(h) - n + 1))
        theirs = Counter(tuple(r[i : i + n]) for i in range(len(r) - n + 1))
        hit, total = sum((mine & theirs).values()), max(sum(mine.values()), 1)
        if n == 1 and not hit:
            return 0.0
        if not hit:
            if len(h) < 2:
                continue
            value = 1 / (2**zeros * 5 / math.log(len(h)))
            zeros += 1
            hit = value
        if weight:
            logs += weight * math.log(hit / total)
    penalty = 1.0 if len(h) > len(r) else math.exp(1 - len(r) / len(h))
    return penalty * math.exp(logs)


def partial_alignment(text: str, needle: str) -> tuple[float, int, int]:
    """Best similarity of the shorter string to a window of the longer, and the window in `text` (start, end).

    Windows of the shorter's length slide along, and shorter ones at both ends; windows are tried in the order of a bound
    by common characters, and only while the bound beats the best. What a window has in common bounds its neighbours too.
    """
    swap = len(needle) > len(text)
    short, long = (text, needle) if swap else (needle, text)
    m, n = len(short), len(long)
    if not m:
        return (100.0 if not n else 0.0), 0, 0
    need, masks = Counter(short), _masks(short)
    places = np.arange(n + m - 1)  # full windows, then those cut off at the start, then those at the end
    starts = np.where(places <= n - m, places, np.where(places < n, 0, places - m + 1))
    ends = np.where(places <= n - m, places + m, np.where(places < n, places - n + m, n))
    common = np.zeros(len(places), np.int64)
    letters = np.frombuffer(long.encode("utf-32-le", "surrogatepass"), np.uint32)
    for c, k in need.items():
        seen = np.concatenate([[0], np.cumsum(letters == ord(c))])
        common += np.minimum(seen[ends] - seen[starts], k)
    sizes = ends - starts
    bound = 200.0 * common / (m + sizes)
    best, where = 0.0, (0, min(m, n))
    order = np.argsort(-bound, kind="stable")
    most = common.tolist()
    for k, top in zip(order.tolist(), bound[order].tolist()):
        if top <= best:
            break
        s, e = int(starts[k]), int(ends[k])
        if 200.0 * most[k] / (m + e - s) <= best:
            continue
        length = _lcs_length(masks, m, long[s:e])
        score = 200.0 * length / (m + e - s)
        if score > best:
            best, where = score, (s, e)
        # A window that has d other characters has at most d more in common.
        spare = int(best * m / 100) - length
        if k <= n - m:
            for i in range(max(0, k - spare), min(n - m, k + spare) + 1):
                far = length + abs(i - k)
                if far < most[i]:
                    most[i] = far
    return (best, 0, len(text)) if swap else (best, *where)


def word_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Words of a character range: the last that starts at or before it, and the first that ends at or behind its end."""
    starts, ends, at = [], [], 0
    for w in text.split(" "):
        if w:
            starts.append(at)
            ends.append(at + len(w))
        at += len(w) + 1
    first = max((i for i, s in enumerate(starts) if s <= start), default=0)
    last = next((i for i, e in enumerate(ends) if e >= end), len(starts) - 1)
    return first, len(starts) if end >= len(text) else last


def locate(needle: str | None, text: str | None, threshold: float = 55, max_words: int = 120, compat: bool = False) -> tuple[int | None, int | None, float | None]:
    """Where a speech lies in a transcript: (first word, end word, score); end exclusive. Nulls where it doesn't.

    A needle of more than 2 * max_words words is found by its first and its last words. compat: the word that holds the
    match's last character counts as the end itself, which leaves that word out.
    """
    if needle is None or text is None or len(text.split()) <= 1:
        return None, None, None
    words = needle.split()
    if len(words) > 2 * max_words:
        a = locate(" ".join(words[:max_words]), text, threshold, max_words, compat)
        b = locate(" ".join(words[-max_words:]), text, threshold, max_words, compat)
        found = [s for s in (a[2], b[2]) if s is not None]
        return a[0], b[1], sum(found) / len(found) if found else None
    score, s, e = partial_alignment(text, needle)
    again = ratio(text[s:e], needle)
    if max(score, again) < threshold:
        return None, None, None
    first, last = word_span(text, s, e)
    whole = e >= len(text)
    return first, last if compat or whole else last + 1, again


def ngram_scores(needle: list[str], text: list[str], n: int = 6) -> np.ndarray:
    """Weight of each word of text by the n-grams of needle that it takes part in: longer ones count more."""
    total = np.zeros(len(text))
    for i in range(1, n):
        if len(text) < i or len(needle) < i:
            break
        grams = {tuple(needle[k : k + i]) for k in range(len(needle) - i + 1)}
        hit = np.array([tuple(text[k : k + i]) in grams for k in range(len(text) - i + 1)], float)
        hit = np.concatenate([hit, np.zeros(len(text) - len(hit))])
        total += np.convolve(hit, np.ones(i + 2) * math.sqrt(math.log(i + 1)), "same")[: len(text)]
    return total / 3


def regions(flags: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of true values (start, end)."""
    edge = np.diff(np.concatenate([[0], flags.astype(int), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def ngram_locate(needle: str | None, text: str | None, threshold: float = 1.3, least: int = 8, max_gap: int = 30) -> tuple[int | None, int | None, float | None]:
    """Start from the first long region of n-gram hits whose next one is near, end from the last, seen from the right."""
    if needle is None or text is None:
        return None, None, None
    score = ngram_scores(needle.split(), text.split())
    r = regions(score > threshold)
    long = lambda x: x[1] - x[0] > least
    start = next((x[0] for i, x in enumerate(r) if long(x) and (i + 1 == len(r) or r[i + 1][0] - x[1] <= max_gap)), None)
    end = next((r[i][1] for i in range(len(r) - 1, -1, -1) if long(r[i]) and (i == 0 or r[i][0] - r[i - 1][1] <= max_gap)), None)
    if start is None or end is None or end <= start:
        return None, None, None
    return start, end, float(score[start:end].sum())


def _pairs(function):
    @F.pandas_udf(DoubleType())
    def udf(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([function(x, y) for x, y in zip(a, b)], dtype="float64")

    return udf


def _end_ratio(pick: int):
    def score(a, b):
        if a is None or b is None:
            return None
        x, y = a.split(), b.split()
        return ratio(x[pick], y[pick]) if x and y else 0.0

    return score


word_error_udf = _pairs(word_error)
bleu_udf = _pairs(bleu)
overlap_bleu_udf = _pairs(lambda a, b: bleu(b, a, (0, 0.25, 0.5, 0.25)))
ratio_udf = _pairs(lambda a, b: None if a is None or b is None else ratio(a, b))
first_word_udf, last_word_udf = _pairs(_end_ratio(0)), _pairs(_end_ratio(-1))


def locate_udf(threshold: float = 55, max_words: int = 120, compat: bool = False, finder=None):
    """Arrow UDF (needle, text) -> struct<word_start, word_end, score>."""
    find = finder or (lambda a, b: locate(a, b, threshold, max_words, compat))

    @F.pandas_udf("word_start long, word_end long, score double")
    def udf(needle: pd.Series, text: pd.Series) -> pd.DataFrame:
        found = [find(a, b) for a, b in zip(needle, text)]
        return pd.DataFrame({"word_start": pd.array([x[0] for x in found], "Int64"), "word_end": pd.array([x[1] for x in found], "Int64"), "score": pd.array([x[2] for x in found], "Float64")})

    return udf
