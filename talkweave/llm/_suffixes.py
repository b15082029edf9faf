"""Suffix order, longest common prefixes and longest previous factors of token arrays, in whole-array steps."""

from __future__ import annotations

import numpy as np


def suffix_order(tokens: np.ndarray, ends: np.ndarray, enough: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of all suffixes by their first `enough` tokens at least, by prefix doubling, and the ranks of each doubling
    (level k: by the first 2^k tokens).

    ends: for each position, the end of its segment; a suffix stops there, and is less than any that goes on.
    """
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    levels, h = [rank], 1
    order = np.argsort(rank)
    at = np.arange(n)
    while h < enough and rank.max(initial=0) < n:
        beyond = at + h
        inside = beyond < ends
        key = rank * (n + 2)
        key[inside] += rank[beyond[inside]]
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        levels.append(rank)
        h *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """Tokens that each suffix shares with the one before it in the order (0 for the first), counted up to 2^levels - 1."""
    n = len(order)
    if n < 2:
        return np.zeros(n, np.int64)
    i, j = order[:-1].copy(), order[1:].copy()
    stop_i, stop_j = ends[i], ends[j]
    for k in range(len(levels) - 1, -1, -1):
        h = 1 << k
        ok = np.flatnonzero((i + h <= stop_i) & (j + h <= stop_j))
        ok = ok[levels[k][i[ok]] == levels[k][j[ok]]]
        i[ok] += h
        j[ok] += h
    return np.concatenate([[0], i - order[:-1]])


def _previous_smaller(position: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """For each place of the order: tokens shared with the nearest earlier place that has a smaller position (0: none).

    shared[i]: tokens that place i shares with place i - 1. Every place first points to the one before it; as long as
    that has a larger position, the pointer moves on to where that one points, so chains shorten as they are followed.
    """
    n = len(position)
    to = np.arange(n) - 1
    least = shared.copy()
    live = np.arange(1, n)
    while len(live):
        live = live[(to[live] >= 0)]
        live = live[position[to[live]] > position[live]]
        hop = to[live]
        least_next = np.minimum(least[live], least[hop])
        to_next = to[hop]
        least[live], to[live] = least_next, to_next
    return np.where(to >= 0, least, 0)


def previous_factors(order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """For each position the longest factor that also starts at a smaller position (their overlap is allowed), as far as
    `shared` counts.

    In suffix order the best earlier match is the nearest place before or after with a smaller position.
    """
    before = _previous_smaller(order, shared)
    back = np.concatenate([[0], shared[:0:-1]])
    after = _previous_smaller(order[::-1], back)[::-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(before, after)
    return out
