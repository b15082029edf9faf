"""Byte-pair encoding by speculation: longest matches propose tokens, pair checks accept or refuse whole words.

A sequence of tokens is the encoding of its bytes exactly if every token is the encoding of its own bytes and
every two neighbours are the encoding of theirs. Both are facts about the vocabulary, so words are checked with
table look-ups only; merging is simulated just for words that fail.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np

from ._arrays import hash_spans, mix, ranges

U = np.uint64
#: Longest-match words that a worker remembers before it starts afresh.
REMEMBERED = 1 << 19
#: Bytes of a word up to which words are stepped through together; a longer one is taken by itself.
LONG = 256
LETTER, NUMBER, BLANK, OTHER = 0, 1, 2, 3


class Table:
    """A hash table from 64-bit keys to 32-bit values that is probed for whole arrays."""

    def __init__(self, bits: int):
        self.mask = (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.full(1 << bits, -1, np.int32)
        self.size = 0

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, -1 where a key is absent."""
        at = (keys & U(self.mask)).astype(np.int64)
        found = self.values[at]
        rest = np.flatnonzero((found >= 0) & (self.keys[at] != keys))
        spot = at[rest]
        while len(rest):
            spot = (spot + 1) & self.mask
            v = self.values[spot]
            found[rest] = v
            more = (v >= 0) & (self.keys[spot] != keys[rest])
            rest, spot = rest[more], spot[more]
        return found

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct keys that are absent."""
        at = (keys & U(self.mask)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = self.values[at[left]] < 0
            here = left[free]
            self.values[at[here]] = values[here]
            self.keys[at[here]] = keys[here]
            won = np.zeros(len(keys), bool)
            won[here] = self.keys[at[here]] == keys[here]
            left = left[~won[left]]
            at[left] = (at[left] + 1) & self.mask
        self.size += len(keys)


@dataclass
class Vocabulary:
    """Tables of one rank file: flat token bytes, halves of each token, and a trie. Its size is that of the vocabulary."""

    data: np.ndarray
    offsets: np.ndarray
    left: np.ndarray
    right: np.ndarray
    own: np.ndarray
    pair_keys: np.ndarray
    pair_ids: np.ndarray
    trie_keys: np.ndarray
    trie_next: np.ndarray
    trie_token: np.ndarray
    byte_id: np.ndarray

    def __len__(self) -> int:
        return len(self.left)


def merge(piece: bytes, ranks: dict[bytes, int], below: int = 1 << 60) -> list[int]:
    """Exact merging: again and again the pair of lowest rank, the leftmost of equals."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    if len(parts) > 64:
        return _merge_long(parts, ranks, below)
    pair = [ranks.get(parts[i] + parts[i + 1], below) for i in range(len(parts) - 1)]
    while pair:
        best = min(pair)
        if best >= below:
            break
        i = pair.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i < len(pair):
            pair[i] = ranks.get(parts[i] + parts[i + 1], below)
        if i:
            pair[i - 1] = ranks.get(parts[i - 1] + parts[i], below)
    return [ranks[p] for p in parts]


def _merge_long(parts: list[bytes], ranks: dict[bytes, int], below: int) -> list[int]:
    """The same with a heap, for long pieces."""
    import heapq

    n = len(parts)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1], below)) < below]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or parts[i] != a or parts[j] != b:
            continue
        parts[i] = a + b
        alive[j] = False
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(parts[i] + parts[after[i]], below)) < below:
                heapq.heappush(heap, (r, i, parts[i], parts[after[i]]))
        if (h := before[i]) >= 0 and (r := ranks.get(parts[h] + parts[i], below)) < below:
            heapq.heappush(heap, (r, h, parts[h], parts[i]))
    return [ranks[p] for p, a in zip(parts, alive) if a]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def load(path: str) -> Vocabulary:
    """Builds the tables from a rank file (one base64 token and its rank a line)."""
    ranks = load_ranks(path)
    tokens = sorted(ranks, key=ranks.__getitem__)
    assert [ranks[t] for t in tokens] == list(range(len(tokens))), "ranks must be 0, 1, 2, ..."
    n = len(tokens)
    left, right, own = np.arange(n, dtype=np.int32), np.arange(n, dtype=np.int32), np.ones(n, bool)
    pairs: list[tuple[int, int, int]] = []
    for k, t in enumerate(tokens):
        if len(t) == 1:
            continue
        halves = merge(t, ranks, k)
        if len(halves) == 2:
            left[k], right[k] = halves
        else:  # no merge leads to it, so merging never yields it
            own[k] = False
        for i in range(1, len(t)):
            a, b = ranks.get(t[:i]), ranks.get(t[i:])
            if a is not None and b is not None:
                pairs.append((a, b, k))
    p = np.array(pairs, np.int64).reshape(-1, 3)
    key = p[:, 0] << 32 | p[:, 1]
    order = np.argsort(key)
    node, nodes, token = {b"": 0}, [], [-1]
    for k, t in enumerate(tokens):
        for i in range(1, len(t) + 1):
            if t[:i] not in node:
                node[t[:i]] = len(token)
                token.append(-1)
                nodes.append((node[t[: i - 1]] << 8 | t[i - 1], len(token) - 1))
        if own[k] or len(t) == 1:
            token[node[t]] = k
    trie = np.array(sorted(nodes), np.int64)
    sizes = np.array([len(t) for t in tokens])
    return Vocabulary(
        np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum(sizes)]), left, right, own, key[order], p[order, 2],
        trie[:, 0], trie[:, 1], np.array(token, np.int32), np.array([ranks[bytes([b])] for b in range(256)], np.int32),
    )


def compatible(v: Vocabulary, pairs: Table, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether merging the bytes of a and b gives just a, b.

    The two tokens are taken apart in reverse order of their merges. At each step the pair that touches the
    border must not be a token that would have merged before the later of the two was made.
    """
    a, b = a.astype(np.int64), b.astype(np.int64)
    good = np.ones(len(a), bool)
    limit = np.full(len(a), 1 << 40)
    live = np.arange(len(a))
    while len(live):
        x, y = a[live], b[live]
        made = pairs.get(mix(x.astype(np.uint64) << U(32) | y.astype(np.uint64)))
        clash = (made >= 0) & (made < limit[live])
        good[live[clash]] = False
        live, x, y = live[~clash], x[~clash], y[~clash]
        split_a = (x > y) & (v.right[x] != x)
        split_a |= (v.left[y] == y) & (v.right[x] != x)
        split_b = ~split_a & (v.left[y] != y)
        limit[live] = np.where(split_a, x, y + 1)
        a[live[split_a]] = v.right[x[split_a]]
        b[live[split_b]] = v.left[y[split_b]]
        live = live[split_a | split_b]
    return good


_classes = None


def _class_table() -> np.ndarray:
    """The class of every code point below 0x110000."""
    global _classes
    if _classes is None:
        import regex

        every = np.arange(0x110000, dtype="<u4")
        every[0xD800:0xE000] = 0
        text = every.tobytes().decode("utf-32-le")
        t = np.full(0x110000, OTHER, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
            for m in regex.finditer(pattern, text):
                t[m.start() : m.end()] = kind
        _classes = t
    return _classes


def code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The code points of multi-byte characters that start at these bytes."""
    n = len(data) - 1
    b0 = data[at].astype(np.int64)
    b1, b2, b3 = (data[np.minimum(at + k, n)].astype(np.int64) & 63 for k in (1, 2, 3))
    return np.where(b0 < 0xE0, (b0 & 31) << 6 | b1, np.where(b0 < 0xF0, (b0 & 15) << 12 | b1 << 6 | b2, (b0 & 7) << 18 | b1 << 12 | b2 << 6 | b3))


def pretokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each piece of the pattern of byte-level vocabularies, and the first piece of each text.

    The pattern: contractions, then runs of letters, numbers or other signs with an optional blank before them, then
    runs of white space, without the last one where something follows. Computed from the borders of character classes.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    table = _class_table()
    kind = table[:256][data]
    kind[data >= 128] = OTHER
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        c = table[code_points(data, lead)]
        kind[lead] = c
        b0 = data[lead]
        for k, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
            longer = b0 >= least
            kind[lead[longer] + k] = c[longer]
    start = np.ones(n, bool)
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    start |= border[:n]
    runs = np.flatnonzero(start)
    ends = np.append(runs[1:], n)
    k = kind[runs]
    blank = k == BLANK
    followed = np.zeros(len(runs), bool)
    followed[:-1] = ~border[ends[:-1]]
    # The last white-space character before something else: its first byte.
    give = np.flatnonzero(blank & followed)
    last = ends[give] - 1
    while len(back := np.flatnonzero((data[last] & 0xC0) == 0x80)):
        last[back] -= 1
    space = data[last] == 32
    first = runs.copy()
    first[give[space] + 1] = last[space]  # the next run takes the blank
    alone = give[~space]
    alone_at = last[~space]
    # White-space runs keep what is left of them; those that gave all away vanish.
    keep = np.ones(len(runs), bool)
    keep[give[space & (last == runs[give])]] = False
    pieces = [first[keep], alone_at[alone_at > runs[alone]]]
    # Contractions: a lone apostrophe that took no blank, and the letters after it.
    quote = np.flatnonzero((k == OTHER) & (ends - runs == 1) & (data[runs] == 39) & (first == runs))
    quote = quote[followed[quote]] if len(quote) else quote
    if len(quote):
        quote = quote[k[quote + 1] == LETTER]
        at, room = runs[quote] + 1, ends[quote + 1] - runs[quote] - 1
        one = data[at]
        two = np.where(room >= 2, data[np.minimum(at + 1, n - 1)], 0)
        long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
        short = np.isin(one, [115, 116, 109, 100])
        size = np.where(short, 1, np.where(long, 2, 0))
        hit = size > 0
        drop = at[hit]  # the letters' run starts later, or not at all
        rest = (at + size)[hit & (room > size)]
        p = np.concatenate(pieces)
        pieces = [p[~np.isin(p, drop)], rest]
    starts = np.sort(np.concatenate(pieces)) if len(pieces[1]) else pieces[0]
    return starts, np.append(starts[1:], n), np.searchsorted(starts, offsets)


class Encoder:
    """Encodes flat texts; remembers the tokens of words that it has met, in bounded memory."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        d, o = vocabulary.data.tobytes(), vocabulary.offsets.tolist()
        self.ranks = {d[o[i] : o[i + 1]]: i for i in range(len(vocabulary))}
        self.sizes = np.diff(vocabulary.offsets)
        self.failed = 0
        self._forget()
        self.pairs = Table(int(2 * len(vocabulary.pair_keys)).bit_length())
        self.pairs.put(mix(vocabulary.pair_keys.astype(np.uint64)), vocabulary.pair_ids.astype(np.int32))
        self.trie = Table(int(2 * len(vocabulary.trie_keys)).bit_length())
        self.trie.put(mix(vocabulary.trie_keys.astype(np.uint64)), vocabulary.trie_next.astype(np.int32))

    def _forget(self) -> None:
        self.known = Table(REMEMBERED.bit_length() + 1)
        self.tokens, self.filled = np.zeros(1 << 19, np.int32), 0
        self.at, self.count = np.zeros(REMEMBERED * 2, np.int32), np.zeros(REMEMBERED * 2, np.int32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, and the first token of each text."""
        starts, ends, text_word = pretokens(data, offsets)
        keys = hash_spans(data, starts, ends)
        if self.known.size > REMEMBERED:
            self._forget()
        index = self.known.get(keys)
        new = np.flatnonzero(index < 0)
        if len(new):
            uniq, where, back = np.unique(keys[new], return_index=True, return_inverse=True)
            base = self.known.size
            sample = new[where]
            tokens, counts = self.propose(data, starts[sample], ends[sample])
            while self.filled + len(tokens) > len(self.tokens):
                self.tokens = np.concatenate([self.tokens, np.zeros_like(self.tokens)])
            if base + len(uniq) > len(self.at):
                more = np.zeros(base + len(uniq), np.int32)
                self.at, self.count = np.concatenate([self.at, more]), np.concatenate([self.count, more])
            if 2 * (base + len(uniq)) > len(self.known.keys):
                old = np.flatnonzero(self.known.values >= 0)
                bigger = Table(int(4 * (base + len(uniq))).bit_length())
                bigger.put(self.known.keys[old], self.known.values[old])
                self.known = bigger
            self.tokens[self.filled : self.filled + len(tokens)] = tokens
            self.at[base : base + len(uniq)] = self.filled + np.cumsum(counts) - counts
            self.count[base : base + len(uniq)] = counts
            self.filled += len(tokens)
            self.known.put(uniq, (base + np.arange(len(uniq))).astype(np.int32))
            index[new] = base + back
        counts = self.count[index].astype(np.int64)
        ids = self.tokens[ranges(self.at[index].astype(np.int64), counts)]
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids, total[text_word]

    def propose(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of distinct words: greedy longest matches, checked, and merged exactly where the check fails."""
        v = self.v
        who, what, cursor = [], [], starts.astype(np.int64).copy()
        for w in np.flatnonzero(ends - starts > LONG).tolist():
            ids = self._stepped(data, int(starts[w]), int(ends[w]))
            who.append(np.full(len(ids), w))
            what.append(ids)
        live = np.flatnonzero(ends - starts <= LONG)
        while len(live):
            at, stop = cursor[live], ends[live]
            state = np.zeros(len(live), np.int64)
            best, reach = np.full(len(live), -1, np.int32), at.copy()
            walk = np.arange(len(live))
            pos = at.copy()
            while len(walk):
                nxt = self.trie.get(mix(state[walk].astype(np.uint64) << U(8) | data[pos[walk]].astype(np.uint64)))
                ok = nxt >= 0
                walk, nxt = walk[ok], nxt[ok]
                state[walk] = nxt
                pos[walk] += 1
                token = v.trie_token[nxt]
                hit = token >= 0
                best[walk[hit]] = token[hit]
                reach[walk[hit]] = pos[walk[hit]]
                walk = walk[pos[walk] < stop[walk]]
            who.append(live)
            what.append(best)
            cursor[live] = reach
            live = live[reach < stop]
        who, what = np.concatenate(who), np.concatenate(what)
        order = np.argsort(who, kind="stable")
        tokens, owner = what[order], who[order]
        counts = np.bincount(owner, minlength=len(starts))
        same = owner[1:] == owner[:-1]
        x, y = tokens[:-1][same].astype(np.int64), tokens[1:][same].astype(np.int64)
        if not len(x):
            return tokens, counts
        pairs, back = np.unique(x << 32 | y, return_inverse=True)
        fine = compatible(v, self.pairs, pairs >> 32, pairs & 0xFFFFFFFF)[back]
        bad = np.unique(owner[1:][same][~fine])
        if not len(bad):
            return tokens, counts
        self.failed += len(bad)
        fixed, sizes = self.merged(data, starts[bad], ends[bad])
        first = np.cumsum(counts) - counts
        pool = np.concatenate([tokens, fixed])
        first[bad] = len(tokens) + np.cumsum(sizes) - sizes
        counts[bad] = sizes
        return pool[ranges(first, counts)], counts

    def _stepped(self, data: np.ndarray, start: int, end: int) -> np.ndarray:
        """Greedy longest matches of one long word: first those from all of its bytes at once, then the steps from its beginning."""
        n = end - start
        best, reach = np.full(n, -1, np.int32), np.arange(n)
        state, walk = np.zeros(n, np.int64), np.arange(n)
        depth = 0
        while len(walk):
            nxt = self.trie.get(mix(state[walk].astype(np.uint64) << U(8) | data[start + walk + depth].astype(np.uint64)))
            ok = nxt >= 0
            walk, nxt = walk[ok], nxt[ok]
            state[walk] = nxt
            depth += 1
            token = self.v.trie_token[nxt]
            hit = token >= 0
            best[walk[hit]], reach[walk[hit]] = token[hit], walk[hit] + depth
            walk = walk[walk + depth < n]
        to, at, path = reach.tolist(), 0, []
        while at < n:
            path.append(at)
            at = to[at]
        return best[path]

    def merged(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many words: those of a similar length together, one merge of each in every round."""
        size = ends - starts
        sizes, parts, places = np.zeros(len(starts), np.int64), [], []
        for low, high in ((2, 4), (5, 8), (9, 12), (13, 20), (21, 32)):
            group = np.flatnonzero((size >= low) & (size <= high))
            for k in range(0, len(group), 50_000):
                self._merged(data, starts, size, group[k : k + 50_000], parts, places)
        for w in np.flatnonzero(size > 32).tolist():
            ids = np.array(merge(data[starts[w] : ends[w]].tobytes(), self.ranks), np.int32)
            parts.append(ids)
            places.append(np.full(len(ids), w))
        tokens, owner = np.concatenate(parts), np.concatenate(places)
        sizes = np.bincount(owner, minlength=len(starts))
        return tokens[np.argsort(owner, kind="stable")], sizes

    def _merged(self, data, starts, size, group, parts, places) -> None:
        if not len(group):
            return
        none = np.int32(2**31 - 1)
        width = int(size[group].max())
        at = starts[group][:, None] + np.arange(width)
        inside = np.arange(width) < size[group][:, None]
        t = np.where(inside, self.v.byte_id[data[np.minimum(at, len(data) - 1)]], -1).astype(np.int64)
        rank = np.full((len(group), width), none, np.int32)
        rank[:, :-1] = np.where(inside[:, 1:], self._pairs(t[:, :-1].ravel(), t[:, 1:].ravel()).reshape(len(group), -1), none)
        who, row = group, np.arange(len(group))
        while True:
            i = rank.argmin(1)
            r = rank[row, i]
            done = r == none
            if done.any():
                ids = t[done]
                real = ids >= 0
                parts.append(ids[real].astype(np.int32))
                places.append(np.repeat(who[done], real.sum(1)))
                live = ~done
                t, rank, who, i, r = t[live], rank[live], who[live], i[live], r[live]
                row = np.arange(len(who))
                if not len(who):
                    return
            t[row, i] = r
            keep = np.ones(t.shape, bool)
            keep[row, i + 1] = False
            t = t[keep].reshape(len(who), -1)
            keep[row, i + 1] = True
            keep[row, i] = False
            rank = rank[keep].reshape(len(who), -1)  # the merged pair's rank goes; that at i is renewed below
            last = t.shape[1] - 1
            nxt = t[row, np.minimum(i + 1, last)]
            right = (i < last) & (nxt >= 0)
            rank[row, i] = none
            rank[row[right], i[right]] = self._pairs(r[right].astype(np.int64), nxt[right])
            left = i > 0
            rank[row[left], i[left] - 1] = self._pairs(t[row[left], i[left] - 1], r[left].astype(np.int64))

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that each two make, or the largest number."""
        got = self.pairs.get(mix(a.astype(np.uint64) << U(32) | b.astype(np.uint64)))
        return np.where(got < 0, np.int32(2**31 - 1), got)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts, and the first byte of each."""
        sizes = self.sizes[ids]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return self.v.data[ranges(self.v.offsets[ids], sizes)], total[offsets]
