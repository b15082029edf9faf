"""Locally consistent parsing of token sequences: runs and pairs are renamed round by round.

The first rounds, up to symbols of some ten words, are made text by text: a name is a 64-bit hash of what it stands for, so
every executor gives equal content the same name without a dictionary that would have to be shuffled. The rounds over what
is left when names that occur once have gone are made in Spark (`recompression.merged`). A symbol merges with the next if a hash bit puts the first on the left side
and the second on the right; this looks at two symbols only, so a repeated passage is parsed alike but for its edges.
"""

from __future__ import annotations

import numpy as np

from ._arrays import U, mix, ranges

ROUNDS = 14


def parse(tokens: np.ndarray, first: np.ndarray, full: int, step: int = 24, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, first tokens and sizes of all symbols of at least `full` tokens; these merge no further.

    first: where each text begins (one more for the end). A run of at least `full` tokens is also named by what it
    repeats, whatever its length, about every `step` tokens: so runs of different lengths have names in common.
    """
    names, places, sizes = [], [], []
    n = len(tokens)
    name = mix(tokens + U(seed) * U(0xD1B54A32D192ED03))
    at = np.arange(n)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    size = np.ones(n, np.int64)
    for level in range(ROUNDS):
        if len(name) < 2:
            break
        # Runs of one symbol.
        same = (name[1:] == name[:-1]) & (text[1:] == text[:-1])
        if same.any():
            head = np.flatnonzero(np.concatenate([[True], ~same]))
            repeat = np.diff(np.append(head, len(name)))
            unit = size[head]
            size = np.add.reduceat(size, head)
            name, at, text = name[head], at[head], text[head]
            long = repeat > 1
            runs = np.flatnonzero(long & (size >= full))
            stride = unit[runs] * np.maximum(step // unit[runs], 1)
            count = (size[runs] + stride - 1) // stride
            names.append(np.repeat(mix(name[runs] ^ U(0x589965CC75374CC3)), count))
            places.append(np.repeat(at[runs], count) + ranges(np.zeros(len(runs), np.int64), count) * np.repeat(stride, count))
            sizes.append(np.full(int(count.sum()), full))
            name[long] = mix(name[long] * U(0x9E3779B97F4A7C15) + repeat[long].astype(np.uint64))
        # Pairs of a left and a right symbol; these cannot overlap.
        right = (mix(name + U(level + 1)) >> U(63)).astype(bool)
        free = size < full
        join = ~right[:-1] & right[1:] & free[:-1] & free[1:] & (text[1:] == text[:-1])
        where = np.flatnonzero(join)
        if not len(where):
            if not free.any():
                break
            continue
        name[where] = mix(name[where] * U(0xA0761D6478BD642F) + mix(name[where + 1] + U(0xE7037ED1A0B428DB)))
        size[where] += size[where + 1]
        keep = np.ones(len(name), bool)
        keep[where + 1] = False
        name, at, text, size = name[keep], at[keep], text[keep], size[keep]
    whole = size >= full
    return np.concatenate([*names, name[whole]]), np.concatenate([*places, at[whole]]), np.concatenate([*sizes, size[whole]])
