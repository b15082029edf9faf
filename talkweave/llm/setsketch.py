"""Operator 9: near duplicates by SetSketch registers, joint likelihood and exact verification; then, exactly, what these left."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._arrays import U, flat, hash_spans, mix, ranges, released, slices, words
from ._components import components
from ._tables import beside, dropped, fresh, stored, table

#: Words of a shingle, and the Jaccard similarity of shingle sets from which two texts are near copies.
SHINGLE, THRESHOLD = 3, 0.5
#: Bands and registers of a band: a pair at the threshold shares a band with probability 1 - (1 - 0.5^3)^48 = 0.998.
BANDS, ROWS = 48, 3
#: Spacing of register values and rate of the exponentials: with a spacing this fine, registers of unlike sets agree by
#: chance once in some 800 cases only, so the candidates of large corpora stay few.
BASE, RATE = 1.005, 32.0
#: Estimates are trusted to reject a pair when they lie so far below the threshold (over three standard errors), and to
#: connect one, as far as no further partners are looked for, when they lie so far above.
MARGIN = 0.13
#: Rows of a band value that meet in one group, and rows that a task holds at once beyond that. Larger band values go
#: through rounds of groups, and are told apart by FINER further bands of FINER_ROWS registers each: a pair at the threshold
#: shares one of these with probability 1 - (1 - 0.5^2)^24 = 0.999.
HOT, TOGETHER, FINER, FINER_ROWS = 20_000, 60_000, 24, 2
#: Shingles that are looked at together when it is counted which of them lie in several groups.
BUCKET = 2_000_000
_M = BANDS * ROWS
_FACTORS = np.random.default_rng(9).integers(0, 2**31, _M, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SALTS = np.random.default_rng(10).integers(0, 2**32, _M, dtype=np.uint32)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the word shingles of all texts (a shorter text is one shingle), and the first of each text."""
    starts, ends, first = words(data, offsets)
    w = hash_spans(data, starts, ends)
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    at = np.repeat(first[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    stop = np.repeat(first[1:], count)
    h = mix(w[at]) if len(at) else np.zeros(0, np.uint64)
    for k in range(1, size):
        inside = at + k < stop
        h[inside] = mix(h[inside] * U(0x9E3779B97F4A7C15) + w[at[inside] + k])
    return h, np.concatenate([[0], np.cumsum(count)])


def distinct(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each text, and the text of each."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[new], text[new]


def registers(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SetSketch registers (texts x BANDS*ROWS, uint16): floor(1 - log_b of the least of exponentially distributed hashes).

    The registers of a union are the larger of each two; texts without shingles have zeros.
    """
    n = np.diff(first)
    out = np.zeros((len(n), _M), np.uint16)
    has = np.flatnonzero(n)
    if not len(has):
        return out
    short = (h >> U(32)).astype(np.uint32)
    begin = first[:-1][has]
    least = np.empty((_M, len(has)), np.uint32)
    for j in range(_M):
        v = short ^ _SALTS[j]
        v *= _FACTORS[j]
        least[j] = np.minimum.reduceat(v, begin)
    exponential = -np.log1p(-(least.T + 0.5) / 2.0**32) / RATE
    out[has] = np.maximum(np.floor(1 - np.log(exponential) / np.log(BASE)), 0)
    return out


def band_keys(r: np.ndarray) -> np.ndarray:
    """A 64-bit key for the register values of each band (texts x BANDS)."""
    v = r.reshape(len(r), BANDS, ROWS).astype(np.uint64)
    packed = v[:, :, 0] | v[:, :, 1] << U(16) | v[:, :, 2] << U(32)
    return mix(packed + np.arange(1, BANDS + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15)).view(np.int64)


def cardinality(r: np.ndarray) -> np.ndarray:
    return r.shape[1] * (1 - 1 / BASE) / (RATE * np.log(BASE) * np.sum(BASE ** -r.astype(float), axis=1))


def jaccard(r: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity, given which register of each two is larger."""
    nu, nv = cardinality(r), cardinality(s)
    u, v = nu / (nu + nv), nv / (nu + nv)
    above, below = (r > s).sum(1), (r < s).sum(1)
    equal = r.shape[1] - above - below
    top = np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-np.maximum(x, 1e-12) * (BASE - 1) / BASE) / np.log(BASE)
    best, width = top / 2, top / 2
    for _ in range(3):
        grid = np.clip(best[:, None] + width[:, None] * np.linspace(-1, 1, 21), 0, top[:, None])
        greater, less = p(u[:, None] - v[:, None] * grid), p(v[:, None] - u[:, None] * grid)
        same = np.maximum(1 - greater - less, 1e-12)
        likelihood = above[:, None] * np.log(greater) + below[:, None] * np.log(less) + equal[:, None] * np.log(same)
        best = grid[np.arange(len(grid)), likelihood.argmax(1)]
        width = width / 10
    return best


def node(text: Column, seed: int = 0) -> Column:
    """A 64-bit name of a text; `sketched_texts` sees to it that different texts have different ones."""
    return F.xxhash64(text, F.lit(seed)) if seed else F.xxhash64(text)


def sketches(docs: DataFrame, seed: int = 0, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, node, digest (128 bits of the text), size (different shingles), registers (binary) of each row that has an id and
    a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = flat(part.column("text"))
                h, first = shingles(data, offsets)
                r = registers(h, first)
                raw = data.tobytes()
                digest = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                got = pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(digest, pa.binary()), pa.array(np.bincount(distinct(h, first)[1], minlength=len(digest))), _binary(r)], ["doc_id", "node", "digest", "size", "registers"])
                yield got.filter(pa.array(np.diff(first) > 0))

    source = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), node(docs[text], seed).alias("node"), docs[text].alias("text"))
    return source.mapInArrow(run, "doc_id long, node long, digest binary, size long, registers binary")


def sketched_texts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame, int]:
    """The stored rows (doc_id, node) and distinct texts (node, doc_id: the least, size, registers), and the seed of the nodes:
    another one is taken where two different texts, by their digests, have the same node."""
    for seed in range(100):
        every = stored(sketches(docs, seed, text, key))
        # Texts that many rows have are joined in each task first.
        texts = every.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("size").alias("size"), F.min("registers").alias("registers"), F.min("digest").alias("low"), F.max("digest").alias("high"))
        texts = stored(texts)
        if texts.where("low <> high").isEmpty():
            rows = stored(every.select("doc_id", "node").distinct())
            dropped(every)
            return rows, texts.drop("low", "high"), seed
        dropped(every, texts)
    raise RuntimeError("no seed names all texts apart")


def _binary(r: np.ndarray) -> pa.Array:
    at = np.arange(len(r) + 1, dtype=np.int32) * (r.shape[1] * r.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(r), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(r))])


def _matrix(column: pa.Array) -> np.ndarray:
    """Registers of a binary column without nulls."""
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(np.uint16).reshape(len(column), _M)


def bands(texts: DataFrame, keys=None) -> DataFrame:
    """(band, node) of every text and band. keys: makes band keys of registers and a band that is split further."""
    deeper = "band" in texts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                r = _matrix(batch.column("registers"))
                found = keys(r, batch.column("band").to_numpy()) if deeper else band_keys(r)
                ids = np.repeat(batch.column("node").to_numpy(), found.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(found.ravel()), pa.array(ids)], ["band", "node"])

    return texts.mapInArrow(run, "band long, node long")


def finer(level: int):
    """Band keys of a further level: of FINER pairs of registers, other ones at each level, within the band."""
    pick = np.random.default_rng(1000 + level).permutation(_M)[: FINER * FINER_ROWS].reshape(FINER, FINER_ROWS)

    def keys(r: np.ndarray, band: np.ndarray) -> np.ndarray:
        h = mix(band.view(np.uint64)[:, None] + np.arange(1, FINER + 1, dtype=np.uint64) * U(0xD1B54A32D192ED03) + U(level))
        for k in range(FINER_ROWS):
            h = mix(h * U(0x9E3779B97F4A7C15) + r[:, pick[:, k]].astype(np.uint64))
        return h.view(np.int64)

    return keys


def shared_bands(banded: DataFrame) -> DataFrame:
    """(band, node, n) of every band value that at least two texts share; counted in each task before it is sent."""
    several = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return banded.join(beside(several), "band")


def resembling(band: np.ndarray, r: np.ndarray, least: float, sure: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows and their estimates (`least` at least), enough to connect all rows of a band value that resemble
    each other; and which rows led: all but those that are surely connected to one that did.

    band: sorted. In each band value the first row is compared with all others. Those whose estimate is `sure` are
    connected through it; the rest, also those that may resemble it, go on to another round with four times as many
    leading rows, which again are compared with every row of the band value, until none is left. Rows that never led are
    at last compared with those that other leaders connect. So m copies cost m comparisons, rows that are unlike are
    compared each with each in a few rounds, and none is skipped for the size of its band value.
    """
    n = len(band)
    head = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]])) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(head, n))
    group = np.repeat(np.arange(len(head)), size)
    open_, led, leaders = np.ones(n, bool), np.zeros(n, bool), 1
    out: list[list[np.ndarray]] = [[], [], []]

    def compare(lead: np.ndarray, start: np.ndarray, length: np.ndarray, among: np.ndarray | None = None) -> None:
        # Rows that meet some 4,000 rows together, at a time.
        cost = np.cumsum(length)
        for some in np.split(np.arange(len(lead)), np.flatnonzero(np.diff(cost // 4_000)) + 1):
            a = np.repeat(lead[some], length[some])
            b = ranges(start[some], length[some])
            b = b if among is None else among[b]
            a, b = a[a != b], b[a != b]
            likely = np.flatnonzero((r[a] == r[b]).mean(1) >= least - 0.05)
            a, b = a[likely], b[likely]
            j = jaccard(r[a], r[b])
            a, b, j = a[j >= least], b[j >= least], j[j >= least]
            open_[b[j >= sure]] = False
            for x, y in zip(out, (a, b, j)):
                x.append(y)

    while open_.any():
        at = np.flatnonzero(open_)
        before = np.searchsorted(group[at], np.arange(len(head)))
        lead = at[np.arange(len(at)) - before[group[at]] < leaders]
        open_[lead], led[lead] = False, True
        compare(lead, head[group[lead]], size[group[lead]])
        leaders *= 4
    if not led.all():
        a, b, j = (np.concatenate(x) for x in out)
        label = _labels(n, a[j >= sure], b[j >= sure])
        rest = np.flatnonzero(~led)
        rest = rest[np.lexsort((label[rest], group[rest]))]
        # Each with the rows of its band value behind those of its own label.
        new = np.concatenate([[True], (np.diff(group[rest]) != 0) | (np.diff(label[rest]) != 0)])
        stop = np.append(np.flatnonzero(new)[1:], len(rest))[np.cumsum(new) - 1]
        length = np.searchsorted(group[rest], group[rest], "right") - stop
        some = np.flatnonzero(length)
        compare(rest[some], stop[some], length[some], rest)
    return *(np.concatenate(x) if x else np.zeros(0) for x in out), led  # type: ignore[return-value]


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that each row is connected to."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        now = label.copy()
        for ends in (a, b, label[a], label[b]):
            np.minimum.at(now, ends, low)
        now = now[now]
        if np.array_equal(now, label):
            return label
        label = now


def _meet(threshold: float, group: list[str]):
    """Rows (group..., node, registers), sorted by group, to (a, b, estimate) of those that may be near copies, and, where
    the group has a piece, (band, node) of those that led. Whole groups are held until there are rows enough."""

    def met(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held).combine_chunks()
        label = np.unique(np.stack([whole.column(c).to_numpy() for c in group], axis=1), axis=0, return_inverse=True)[1].ravel()
        ids = whole.column("node").to_numpy()
        order = np.lexsort((ids, label))
        r = np.concatenate([_matrix(c) for c in whole.column("registers").chunks])[order]
        a, b, j, led = resembling(label[order], r, threshold - MARGIN, threshold + MARGIN)
        x, y = ids[order][a.astype(np.int64)], ids[order][b.astype(np.int64)]
        rows = [np.minimum(x, y), np.maximum(x, y), j]
        if len(group) == 1:
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in rows], ["a", "b", "estimate"])
            return
        yield pa.RecordBatch.from_arrays([*(pa.array(v) for v in rows), pa.nulls(len(x), pa.int64())], ["a", "b", "estimate", "band"])
        at = order[led]
        yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.float64()), pa.array(whole.column("band").to_numpy()[at])], ["a", "b", "estimate", "band"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) >= TOGETHER:
                both = pa.Table.from_batches(held)
                last = np.ones(len(both), bool)
                for c in group:
                    v = both.column(c).to_numpy()
                    last &= v == v[-1]
                whole = len(both) - int(last.sum())  # the last group may go on
                if whole:
                    yield from met(both.slice(0, whole).to_batches())
                    held = both.slice(whole).to_batches()
        if held:
            yield from met(held)
        released()

    return run


def candidates(texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b, estimate) of pairs that may be near copies: see `resembling`. Only texts that share a band value have their
    registers sent, once for each such value, to where it is looked at.

    A band value of more than HOT texts is dealt to groups of about HOT. In each, rows that are surely connected to a leader
    are done: m copies leave one. The others go on; while they get fewer by half, again by the same band, else by further
    registers, which rows that have only the hot band's registers in common don't share. So no group is larger than a task
    can hold, and rows that are unlike don't meet all of them. Rows that are done in different groups of a hot band meet
    through their leaders, or through other bands, only.
    """
    members = stored(shared_bands(bands(texts)))
    registers_of = texts.select("node", "registers")
    cold = members.where(F.col("n") <= HOT).join(registers_of, "node").select("band", "node", "registers")
    found = cold.repartition("band").sortWithinPartitions("band").mapInArrow(_meet(threshold, ["band"]), "a long, b long, estimate double")
    hot, level = members.where(F.col("n") > HOT), 0
    while not hot.isEmpty():
        level += 1
        count = F.ceil(F.col("n") / HOT).cast("int")
        dealt = hot.join(registers_of, "node").select("band", F.pmod(F.xxhash64("node", F.lit(level)), count).cast("long").alias("piece"), "node", "registers")
        met = dealt.repartition("band", "piece").sortWithinPartitions("band", "piece").mapInArrow(_meet(threshold, ["band", "piece"]), "a long, b long, estimate double, band long")
        met = stored(met)
        found = found.unionByName(met.where("band IS NULL").drop("band"))
        # Bands that were one group are done.
        sizes = stored(hot.groupBy("band").agg(F.max("n").alias("was")).where(F.col("was") > HOT))
        led = met.where("band IS NOT NULL").select("band", F.col("a").alias("node")).join(F.broadcast(sizes), "band")  # at most the rows by HOT
        now = led.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
        led = stored(led.join(F.broadcast(now), "band"))
        same = led.where(F.col("n") <= F.col("was") / 2).select("band", "node", "n")
        split = led.where(F.col("n") > F.col("was") / 2).join(registers_of, "node").select("band", "node", "registers")
        hot = stored(same.unionByName(shared_bands(bands(split, finer(level))).select("band", "node", "n")))
    return found.groupBy("a", "b").agg(F.max("estimate").alias("estimate"))


def shingle_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles: sorted distinct 64-bit hashes) of the texts (node, doc_id) that are asked for, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                h, first = shingles(*flat(part.column("text")))
                sets = [np.unique(h[a:b].view(np.int64)) for a, b in zip(first[:-1], first[1:])]
                at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                flat_sets = np.concatenate(sets) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat_sets))], ["node", "shingles"])

    found = docs.join(beside(nodes), ["node", "doc_id"], "left_semi").select("node", "text").mapInArrow(run, "node long, shingles array<long>")
    return found.groupBy("node").agg(F.first("shingles").alias("shingles"))  # all rows of a node have the same


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have at least this Jaccard similarity."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common >= threshold * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def crossing(plain: DataFrame, texts: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of texts of different groups (node, root) whose similarity is the threshold at least: enough to connect all
    groups that have one. Exact, whatever sketches say.

    A text of such a pair has this share of its shingles in common with another group. Which shingles lie in several groups
    is found from 32 bits of each shingle, text and root within a bucket of shingles; where these bits are the same by chance a text is looked at
    in vain, never left out. The few texts that are left are joined by prefixes: with shingles in one order everywhere, the rare
    ones first, the two of a pair have one in common among the first size - threshold * size + 1 of each.
    """
    buckets = max(-(-(texts.agg(F.sum("size")).first()[0] or 0) // BUCKET), 1)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                h, text = distinct(*shingles(*flat(part.column("text"))))
                ref, root = (part.column(c).to_numpy().astype(np.uint32) for c in ("node", "root"))
                grouped_ = (part.column("node").to_numpy() != part.column("root").to_numpy())[text]
                kind = (h % U(buckets)).astype(np.int64) * 2 + grouped_
                order = np.argsort(kind, kind="stable")
                h, text, kind = h[order], text[order], kind[order]
                head = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]])) if len(kind) else np.zeros(0, np.int64)
                at = np.append(head, len(kind)).astype(np.int32) * 4
                kind = kind[head]
                size = np.where(kind % 2 == 1, np.diff(at), 0)
                own = np.repeat(kind % 2 == 1, np.diff(at) // 4)
                columns = [((h >> U(32)).astype(np.uint32), at), (ref[text], at), (root[text][own], np.concatenate([[0], np.cumsum(size)]).astype(np.int32))]
                binary = [pa.Array.from_buffers(pa.binary(), len(kind), [None, pa.py_buffer(x), pa.py_buffer(np.ascontiguousarray(v))]) for v, x in columns]
                yield pa.RecordBatch.from_arrays([pa.array(kind // 2), *binary], ["bucket", "keys", "refs", "roots"])

    def several(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        keys, refs, roots_ = ([], [], [])
        for batch in held:
            for k, r, o in zip(*(batch.column(c) for c in ("keys", "refs", "roots"))):
                keys.append(np.frombuffer(k.as_buffer(), np.uint32))
                refs.append(np.frombuffer(r.as_buffer(), np.uint32))
                roots_.append(np.frombuffer(o.as_buffer(), np.uint32) if len(o.as_buffer()) else refs[-1])
        key, ref, root = (np.concatenate(x) for x in (keys, refs, roots_))
        both = key.astype(np.uint64) << U(32) | ref
        order = np.argsort(both)
        both, root = both[order], root[order]
        key = (both >> U(32)).astype(np.uint32)
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(head, len(key)))
        shared = np.repeat(np.minimum.reduceat(root, head) < np.maximum.reduceat(root, head), size)
        shared[1:] &= both[1:] != both[:-1]  # a text that several rows have counts once
        ref, count = np.unique((both[shared] & U(0xFFFFFFFF)).astype(np.int64), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(ref), pa.array(count.astype(np.int64))], ["ref", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows come sorted by bucket."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(bucket)).tolist()
            for a, b in zip([0, *ends], ends):
                if a < b:
                    if held and held[0].column("bucket")[0].as_py() != bucket[a]:
                        yield several(held)
                        held = []
                    held.append(batch.slice(a, b - a))
        if held:
            yield several(held)
        released()

    low = lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))
    of = beside(roots.select("node", "root"))
    root = F.coalesce("root", "node").alias("root")
    marked = plain.join(of, "node", "left").select("node", root, "text").mapInArrow(mark, "bucket long, keys binary, refs binary, roots binary")
    counted = marked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(count, "ref long, n long").groupBy("ref").agg(F.sum("n").alias("shared"))
    every = texts.join(of, "node", "left").select("node", "doc_id", "size", root)
    # Groups whose roots have the same 32 bits are not told apart above.
    alike = every.groupBy(low("node").alias("alike")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("alike")
    asked = every.join(counted, low("node") == F.col("ref")).where(F.col("shared") >= threshold * F.col("size") - 1e-6).select(*every.columns)
    asked = stored(asked.unionByName(every.join(alike, low("root") == F.col("alike"), "left_semi")).distinct())
    sets = stored(shingle_sets(plain, asked.select("node", "doc_id")))
    posted = sets.join(asked, "node").select("node", "root", "size", F.explode("shingles").alias("h"))
    known = posted.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("h", "n")
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.coalesce("n", F.lit(0)), "h"))
    prefix = posted.join(known, "h", "left").withColumn("i", place).where(F.col("n").isNotNull() & (F.col("i") <= F.col("size") - F.ceil(threshold * F.col("size") - 1e-6) + 1))
    prefix = stored(prefix.select("h", "node", "root", "size"))
    side = lambda c: prefix.select("h", F.col("node").alias(c), F.col("root").alias(f"root_{c}"), F.col("size").alias(f"size_{c}"))
    near = F.least("size_a", "size_b") >= threshold * F.greatest("size_a", "size_b") - 1e-6
    pairs = stored(side("a").join(side("b"), "h").where(F.col("a") < F.col("b")).where(F.col("root_a") != F.col("root_b")).where(near).select("a", "b").distinct())
    found = stored(verified(pairs, sets, threshold))
    dropped(asked, sets, prefix, pairs)
    return found


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, kept_doc_id, exact): every document that goes, the one that stays for its group, and whether its text is
    the same as that of an earlier document. See `grouped`."""
    return grouped(docs, threshold, text, key)[0].drop("node")


def grouped(docs: DataFrame, threshold: float = THRESHOLD, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, int]:
    """(doc_id, node, kept_doc_id, exact) of every document that goes, and the seed of the nodes.

    A group is a connected component of all pairs of different texts whose Jaccard similarity is the threshold at least (most
    are shown by sketches, `crossing` finds whatever else connects groups), with all documents that have these texts; the
    least id stays (of an id's texts in one group, that of the least node). Texts without a word are in no group, nor are rows
    without an id; rows that repeat an id and text count as one document, an id's different texts as several. Equal texts are
    joined first, so sketches compete among distinct texts only; a very long text has as many registers as any. An empty table
    gives an empty result; further columns don't matter. ids must be integers.
    """
    rows, texts, seed = sketched_texts(docs, text, key)
    pairs = stored(candidates(texts, threshold))
    plain = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), node(docs[text], seed).alias("node"), docs[text].alias("text"))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stored(shingle_sets(plain, texts.select("node", "doc_id").join(ends, "node", "left_semi")))
    # First each text's likeliest link to an earlier one; then whatever links still lie between components.
    best = pairs.groupBy("b").agg(F.min(F.struct(F.col("estimate") < threshold + 0.1, "a")).alias("to")).select(F.col("to.a").alias("a"), "b")
    best = stored(best)
    linked = stored(verified(best, sets, threshold))
    roots = stored(components(linked))
    root = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    between = pairs.join(root("a"), "a", "left").join(root("b"), "b", "left").where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
    between = between.join(best, ["a", "b"], "left_anti")
    more = stored(verified(between, sets, threshold))
    dropped(sets, pairs)
    links = linked.unionByName(more)
    if not more.isEmpty():
        roots = components(links)
    # Then the links that no sketch has shown.
    missed = crossing(plain, texts, roots, threshold)
    if not missed.isEmpty():
        roots = components(links.unionByName(missed))
    named = texts.select("node", F.col("doc_id").alias("first_id")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    keepers = named.groupBy("root").agg(F.min(F.struct("first_id", "node")).alias("keeper"))
    to = named.join(keepers, "root").select("node", "first_id", "keeper")
    gone = rows.join(to, "node").where(F.struct(F.col("doc_id").alias("first_id"), "node") != F.col("keeper"))
    return gone.select("doc_id", "node", F.col("keeper.first_id").alias("kept_doc_id"), (F.col("doc_id") != F.col("first_id")).alias("exact")), seed


def op9_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`near_duplicates` over the documents table."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near copies, all columns. Rows with a null id, and those whose text is
    null or has no word, all stay, but for rows that repeat an id and text: of these one stays, that of the least hash of all
    columns. An id's different texts stay or go each for itself; an empty table stays empty."""
    id_, name, mark = fresh(docs, "_id", "_node", "_gone")
    found, seed = grouped(docs)
    gone = found.select(F.col("doc_id").alias(id_), F.col("node").alias(name), F.lit(True).alias(mark))
    own = docs.withColumn(name, node(F.col("text"), seed))
    twice = own.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(id_), name).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(id_, name, F.lit(False).alias(mark))
    marks = beside(gone.unionByName(twice).groupBy(id_, name).agg(F.max(mark).alias(mark)))
    kept = own.join(marks.withColumnRenamed(name, f"{name}2"), (F.col("doc_id") == F.col(id_)) & (F.col(name) == F.col(f"{name}2")), "left").where(~F.coalesce(mark, F.lit(False)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    single = kept.where(F.col(mark).isNull()).select(*columns)
    # Joined in each task first, so that a row which a third of all repeat is no hot one.
    whole = F.min(F.struct(F.xxhash64(*columns).alias("_h"), F.struct(*columns).alias("_row"))).alias("_least")
    repeated = kept.where(F.col(mark).isNotNull()).groupBy(F.col("doc_id").alias(id_), name).agg(whole).select("_least._row.*")
    return single.unionByName(repeated)
