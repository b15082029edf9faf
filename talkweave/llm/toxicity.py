"""Operator 6: toxicity by a convolutional classifier over hashed word embeddings, trained in numpy."""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._arrays import U, flat, hash_spans, mix, released, slices, words
from ._tables import beside, dropped, stored, table

#: Embedding rows (words and word beginnings share them) and their width; filter widths, and filters of each.
BUCKETS, WIDTH = 1 << 16, 16
WIDTHS, FILTERS = (1, 2, 3), 12
#: Bytes of a word's beginning, which has an embedding of its own: inflected and compound forms share it.
STEM = 5
#: The bounds where a caller of `train` asks for a bounded number of rows: documents of all languages and labels together,
#: characters of each and of all. Otherwise all labelled documents train, but for the fifth that calibrates the thresholds.
TRAIN_ALL, TRAIN_CHARS, TRAIN_TOTAL = 20_000, 100_000, 64_000_000
EPOCHS, RATE = 4, 0.08
#: Words of the documents that train one after the other in a round (a block has twice as many at most, but for its last
#: document), and documents and words of a step. One of HELD texts calibrates.
BLOCK, STEP, STEP_WORDS, HELD = 2_000_000, 32, 300_000, 5
#: Slices of the embedding whose sums meet, and the unit of these sums: whole numbers, so their order changes nothing.
SLICES, UNIT = 16, 2.0**-30
#: Parts that the labelled documents of a language and label are dealt to before the first are chosen.
PARTS = 64
#: Share of clean held-out documents that a language's threshold may let through as toxic; languages with fewer held-out
#: documents of either label use the threshold of all.
FALSE_ALARMS, LEAST_HELD = 0.002, 25

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Model:
    embedding: np.ndarray
    kernels: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float]
    threshold: float


def word_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedding rows of each word and of its beginning, and the first word of each text. Words are runs of letters and
    digits, without regard to ASCII case."""
    low = _LOWER[data]
    starts, ends, first = words(low, offsets, _SEPARATOR)
    whole = hash_spans(low, starts, ends) % U(BUCKETS)
    begin = mix(hash_spans(low, starts, np.minimum(ends, starts + STEM)) + U(1)) % U(BUCKETS)
    return whole.astype(np.int32), begin.astype(np.int32), first


def features(m: Model, rows: tuple[np.ndarray, np.ndarray], first: np.ndarray, where: bool = False):
    """Max-pooled filter outputs of each text (0 where a text has fewer words than a filter), and the first word of each maximum."""
    x = m.embedding[rows[0]] + m.embedding[rows[1]]
    texts = len(first) - 1
    pooled = np.zeros((texts, len(WIDTHS) * FILTERS), np.float32)
    places = np.full(pooled.shape, -1, np.int64)
    for k, width in enumerate(WIDTHS):
        n = len(x) - width + 1
        count = np.diff(first) - width + 1
        has = np.flatnonzero(count > 0)
        if n <= 0 or not len(has):
            continue
        y = x[:n] @ m.kernels[k][0]
        for j in range(1, width):
            y += x[j : j + n] @ m.kernels[k][j]
        # Windows that run over the end of a text must not count.
        valid = np.zeros(n, bool)
        begin = first[:-1][has]
        mark = np.zeros(n + 1, np.int64)
        np.add.at(mark, begin, 1)
        np.add.at(mark, np.minimum(begin + count[has], n), -1)
        valid = np.cumsum(mark[:n]) > 0
        y[~valid] = -1e9
        columns = slice(k * FILTERS, (k + 1) * FILTERS)
        top = np.maximum.reduceat(y, begin, axis=0)
        pooled[has, columns] = np.maximum(top + m.bias[columns], 0)
        if where:
            text = np.repeat(np.arange(len(has)), np.diff(np.append(begin, n)))
            for f in range(FILTERS):
                at = np.flatnonzero(y[begin[0] :, f] == top[text, f]) + begin[0]
                t, one = np.unique(text[at - begin[0]], return_index=True)
                places[has[t], k * FILTERS + f] = at[one]
    return pooled, places, x


def probability(m: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of toxicity of each text."""
    whole, begin, first = word_rows(data, offsets)
    pooled, _, _ = features(m, (whole, begin), first)
    return 1 / (1 + np.exp(-(pooled @ m.out + m.out_bias)))


def _start(rng: np.random.Generator) -> Model:
    """A model that calls nothing toxic."""
    filters = len(WIDTHS) * FILTERS
    kernels = [rng.normal(0, (2 / (w * WIDTH)) ** 0.5, (w, WIDTH, FILTERS)).astype(np.float32) for w in WIDTHS]
    return Model(rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32), kernels, np.zeros(filters, np.float32), np.zeros(filters, np.float32), 0.0, {}, 2.0)


def _speeds(m: Model) -> list[np.ndarray]:
    """Adagrad's sums of squares: of the embedding, the kernels, bias, out and out_bias."""
    return [np.full(np.shape(p), 1e-6, np.float32) for p in (m.embedding, *m.kernels, m.bias, m.out, [0.0])]


def _step(m: Model, speed: list[np.ndarray], rows: tuple[np.ndarray, np.ndarray], first: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """One step of Adagrad; returns the embedding rows that it moved."""
    pooled, places, x = features(m, rows, first, where=True)
    p = 1 / (1 + np.exp(-(pooled @ m.out + m.out_bias)))
    error = ((p - toxic) * weight / len(toxic)).astype(np.float32)
    back = error[:, None] * m.out * (pooled > 0)
    g_out, g_bias = pooled.T @ error, back.sum(0)
    touched, g_x = [], []
    for w, width in enumerate(WIDTHS):
        c = slice(w * FILTERS, (w + 1) * FILTERS)
        t, f = np.nonzero((places[:, c] >= 0) & (back[:, c] != 0))
        at, g = places[:, c][t, f], back[:, c][t, f]
        g_k = np.zeros_like(m.kernels[w])
        for j in range(width):
            np.add.at(g_k[j].T, f, g[:, None] * x[at + j])
            touched.append(at + j)
            g_x.append(g[:, None] * m.kernels[w][j][:, f].T)
        speed[1 + w] += g_k**2
        m.kernels[w] -= RATE * g_k / np.sqrt(speed[1 + w])
    at, g = np.concatenate(touched), np.concatenate(g_x)
    both, g = np.concatenate([rows[0][at], rows[1][at]]), np.concatenate([g, g])
    some, back_to = np.unique(both, return_inverse=True)
    g_e = np.zeros((len(some), WIDTH), np.float32)
    np.add.at(g_e, back_to, g)
    speed[0][some] += g_e**2
    m.embedding[some] -= RATE * g_e / np.sqrt(speed[0][some])
    for p_, g_, s_ in ((m.bias, g_bias, speed[-3]), (m.out, g_out, speed[-2])):
        s_ += g_**2
        p_ -= RATE * g_ / np.sqrt(s_)
    speed[-1] += float(error.sum()) ** 2
    m.out_bias -= RATE * float(error.sum()) / float(speed[-1][0]) ** 0.5
    return some


def fit(texts: list[str], toxic: np.ndarray, langs: list[str], epochs: int = EPOCHS, seed: int = 6) -> Model:
    """Trains on four fifths of the texts (Adagrad, batches of STEP) and calibrates thresholds by language on the rest.

    Without a text of either label the model calls nothing toxic.
    """
    rng = np.random.default_rng(seed)
    m = _start(rng)
    if not len(texts) or toxic.all() or not toxic.any():
        return m
    m.out[:] = rng.normal(0, 0.3, len(m.out))
    coded = [word_rows(*flat(pa.array([t]))) for t in texts]
    order = rng.permutation(len(texts))
    held, used = order[: len(order) // 5], order[len(order) // 5 :]
    speed = _speeds(m)
    weight = np.where(toxic, 0.5 / max(toxic.mean(), 1e-6), 0.5 / max(1 - toxic.mean(), 1e-6))
    for _ in range(epochs):
        rng.shuffle(used)
        for k in range(0, len(used), STEP):
            batch = used[k : k + STEP]
            rows = tuple(np.concatenate([coded[i][j] for i in batch]) for j in (0, 1))
            first = np.concatenate([[0], np.cumsum([len(coded[i][0]) for i in batch])])
            _step(m, speed, rows, first, toxic[batch], weight[batch])
    if len(held):
        p = probability(m, *flat(pa.array([texts[i] for i in held])))
        y, lang = toxic[held].astype(bool), np.array([langs[i] or "" for i in held])
        m.threshold = threshold_for(p[~y], p[y])
        for name in np.unique(lang):
            of = lang == name
            if name and (of & y).sum() >= LEAST_HELD and (of & ~y).sum() >= LEAST_HELD:
                m.thresholds[str(name)] = threshold_for(p[of & ~y], p[of & y])
    return m


def threshold_for(clean: np.ndarray, toxic: np.ndarray) -> float:
    """Midway between the clean documents' limit (all but FALSE_ALARMS) and the least toxic one above it, 0.5 at least."""
    if not len(clean):
        return 0.5
    limit = float(np.quantile(clean, 1 - FALSE_ALARMS))
    above = toxic[toxic > limit]
    return _between(limit, float(above.min()) if len(above) else None)


def _between(limit: float, above: float | None) -> float:
    return max(limit if above is None else (limit + above) / 2, 0.5)


def blocks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All labelled documents with a text, as embedding rows of their words, in stored blocks of about BLOCK words: held (they
    calibrate), n, n_toxic, toxic and count (of each document: uint8, and words as int64), words (uint16 pairs), langs.

    A hash of the text decides whether it is held, so copies are never on both sides; blocks are dealt and sorted by hashes, so
    they don't depend on how the tables are divided. An id that labels repeat counts as toxic where one of them says so;
    documents that repeat an id come as often as they are there.
    """
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = docs.where("text IS NOT NULL").select("doc_id", "text", "lang").join(beside(marked), "doc_id")
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(-(-total // (6 * BLOCK)), 1)  # a word takes some six bytes
    held = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(HELD)) == 0
    h = F.xxhash64("text", "doc_id")
    known = known.select((F.pmod(h, F.lit(parts)) * 2 + held.cast("int")).alias("part"), h.alias("h"), "doc_id", (F.col("toxic") == 1).cast("int").alias("toxic"), "lang", "text")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                whole, begin, first = word_rows(*flat(some.column("text")))
                pairs = np.stack([whole, begin], axis=1).astype(np.uint16)
                coded = pa.Array.from_buffers(pa.binary(), some.num_rows, [None, pa.py_buffer((first * 4).astype(np.int32)), pa.py_buffer(pairs)])
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], coded], [*some.schema.names[:-1], "words"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, langs, words_, size, now = [], [], [], 0, None

        def block() -> pa.RecordBatch:
            columns = [[now % 2 == 1], [len(toxic)], [sum(toxic)], [bytes(toxic)], [(np.array([len(w) for w in words_], np.int64) // 4).tobytes()], [b"".join(words_)]]
            kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds)), pa.array([langs], pa.list_(pa.string()))], ["held", "n", "n_toxic", "toxic", "count", "words", "langs"])

        for batch in batches:
            for part, y, lang, w in zip(*(batch.column(c).to_pylist() for c in ("part", "toxic", "lang", "words"))):
                if toxic and (part != now or size + len(w) > 8 * BLOCK):
                    yield block()
                    toxic, langs, words_, size = [], [], [], 0
                now = part
                toxic.append(y)
                langs.append(lang)
                words_.append(w)
                size += len(w)
        if toxic:
            yield block()
        released()

    key = dict(docs.dtypes)["doc_id"]
    coded = known.mapInArrow(code, f"part long, h long, doc_id {key}, toxic int, lang string, words binary")
    dealt = coded.repartition(min(2 * parts, 2000), "part").sortWithinPartitions("part", "h", "doc_id", "lang", "toxic")
    return stored(dealt.mapInArrow(deal, "held boolean, n long, n_toxic long, toxic binary, count binary, words binary, langs array<string>"))


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list]]:
    """Of each block: embedding rows, first word of each document, whether it is toxic, and the languages."""
    for k in range(batch.num_rows):
        toxic, count, words_ = (batch.column(c)[k].as_buffer() for c in ("toxic", "count", "words"))
        pairs = np.frombuffer(words_, np.uint16).reshape(-1, 2)
        yield pairs, np.concatenate([[0], np.cumsum(np.frombuffer(count, np.int64))]), np.frombuffer(toxic, np.uint8), batch.column("langs")[k].as_py()


def _batches(order: np.ndarray, count: np.ndarray) -> Iterator[np.ndarray]:
    """The documents of each step: STEP at most, of STEP_WORDS words unless it is one."""
    start, size = 0, 0
    for k, n in enumerate(count[order].tolist()):
        if k > start and (k - start == STEP or size + n > STEP_WORDS):
            yield order[start:k]
            start, size = k, 0
        size += n
    yield order[start:]


def _chosen(pairs: np.ndarray, first: np.ndarray, batch: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    own = np.concatenate([pairs[first[i] : first[i + 1]] for i in batch]).astype(np.int32)
    return (own[:, 0], own[:, 1]), np.concatenate([[0], np.cumsum(first[batch + 1] - first[batch])])


def _dense(m: Model) -> np.ndarray:
    return np.concatenate([*(k.ravel() for k in m.kernels), m.bias, m.out, [m.out_bias]]).astype(float)


def _round(used: DataFrame, m: Model, speed: list[np.ndarray], weights: tuple[float, float], seed: int) -> None:
    """Every block trains a copy of the model, document after document; then the model moves by the mean of their moves. An
    embedding row moves by the mean over the blocks that touched it, weighted by the steps in which they did, all else by the mean
    weighted by steps. Adagrad's sums move likewise."""
    shipped = used.sparkSession.sparkContext.broadcast((m, speed))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, pace = shipped.value
        moved, faster, steps_of = np.zeros((BUCKETS, WIDTH), np.int64), np.zeros((BUCKETS, WIDTH), np.int64), np.zeros(BUCKETS, np.int64)
        old, old_pace = _dense(begin), np.concatenate([s.ravel() for s in pace[1:]]).astype(float)
        rest, seen = np.zeros((2, len(old)), np.int64), 0
        for batch in batches:
            for pairs, first, toxic, _ in _documents(batch):
                own, own_speed = copy.deepcopy(begin), copy.deepcopy(pace)
                times, steps = np.zeros(BUCKETS, np.int64), 0
                for some in _batches(np.random.default_rng(seed).permutation(len(toxic)), np.diff(first)):
                    rows, at = _chosen(pairs, first, some)
                    times[_step(own, own_speed, rows, at, toxic[some], np.where(toxic[some], *weights))] += 1
                    steps += 1
                hit = np.flatnonzero(times)
                by = times[hit, None] / UNIT
                moved[hit] += np.rint((own.embedding[hit].astype(float) - begin.embedding[hit]) * by).astype(np.int64)
                faster[hit] += np.rint((own_speed[0][hit].astype(float) - pace[0][hit]) * by).astype(np.int64)
                steps_of += times
                new_pace = np.concatenate([s.ravel() for s in own_speed[1:]]).astype(float)
                rest += np.rint(np.stack([_dense(own) - old, new_pace - old_pace]) * (steps / UNIT)).astype(np.int64)
                seen += steps
        if seen:
            cut = [np.concatenate([x.ravel() for x in p]) for p in zip(*(np.split(x, SLICES) for x in (moved, faster, steps_of)))]
            sums = [*cut, np.append(rest.ravel(), seen)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array([x.tobytes() for x in sums], pa.binary())], ["slice", "sums"])
        released()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column("slice").to_pylist(), batch.column("sums")):
                x = np.frombuffer(x.as_buffer(), np.int64)
                sums[k] = sums[k] + x if k in sums else x.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["slice", "sums"])

    rows = "slice int, sums binary"
    got = used.mapInArrow(learn, rows).repartition(SLICES + 1, "slice").mapInArrow(meet, rows)
    sums = {r["slice"]: np.frombuffer(r["sums"], np.int64) for r in got.collect()}
    shipped.destroy()
    *cut, rest = (sums[k] for k in range(SLICES + 1))
    size = BUCKETS // SLICES * WIDTH
    moved, faster = (np.concatenate([x[k * size : (k + 1) * size] for x in cut]).reshape(BUCKETS, WIDTH) * UNIT for k in (0, 1))
    steps = np.maximum(np.concatenate([x[2 * size :] for x in cut]), 1)[:, None]
    m.embedding += (moved / steps).astype(np.float32)
    speed[0] += (faster / steps).astype(np.float32)
    change, pace = rest[:-1].reshape(2, -1) * (UNIT / rest[-1])
    at = 0
    for k, p in enumerate((*m.kernels, m.bias, m.out)):
        p += change[at : at + p.size].reshape(p.shape).astype(np.float32)
        speed[1 + k] += pace[at : at + p.size].reshape(p.shape).astype(np.float32)
        at += p.size
    m.out_bias += float(change[-1])
    speed[-1] += np.float32(pace[-1])


def _calibrate(held: DataFrame, m: Model) -> None:
    """Thresholds from all held-out documents, as in `threshold_for`."""
    shipped = held.sparkSession.sparkContext.broadcast(m)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            for pairs, first, toxic, langs in _documents(batch):
                for some in _batches(np.arange(len(toxic)), np.diff(first)):
                    pooled, _, _ = features(own, *_chosen(pairs, first, some))
                    p = np.round(1 / (1 + np.exp(-(pooled @ own.out + own.out_bias).astype(float))), 6)
                    yield pa.RecordBatch.from_arrays([pa.array([langs[i] or "" for i in some], pa.string()), pa.array(toxic[some].astype(bool)), pa.array(p)], ["lang", "toxic", "p"])
        released()

    judged = stored(held.mapInArrow(judge, "lang string, toxic boolean, p double"))
    # A language that has too few documents of a label has the threshold of all; percentiles count the million values of p.
    clean = F.when(~F.col("toxic"), F.col("p"))
    figures = [F.count(clean).alias("n_clean"), F.count_if("toxic").alias("n_toxic"), F.percentile(clean, F.lit(1 - FALSE_ALARMS)).alias("limit")]
    by = judged.groupBy("lang").agg(*figures).where(f"lang <> '' AND n_clean >= {LEAST_HELD} AND n_toxic >= {LEAST_HELD}")
    limits = stored(by.select("lang", "limit").unionByName(judged.agg(*figures).select(F.lit("").alias("lang"), "limit")))  # "" stands for all
    toxic = judged.where("toxic").select(F.explode(F.array_distinct(F.array("lang", F.lit("")))).alias("lang"), "p")
    above = toxic.join(limits, "lang").where("p > limit").groupBy("lang").agg(F.min("p").alias("above"))
    least = {r.lang: r.above for r in above.collect()}
    for r in limits.collect():
        t = 0.5 if r.limit is None else _between(r.limit, least.get(r.lang))
        if r.lang:
            m.thresholds[r.lang] = t
        else:
            m.threshold = t
    dropped(judged, limits)


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(text, lang, toxic) of at most `most` labelled documents of each language and label, chosen by a hash of the id, with
    at most TRAIN_ALL documents and TRAIN_TOTAL characters in all.

    The first of each of PARTS parts are taken, then the first of those, so that no task ranks a whole language; either half
    of the hashes gives half, which stays below Spark's limit for ranking groups while they are read (1,000). An id that
    labels repeat counts as toxic where one of them says so; documents that repeat an id are candidates as often as they come.
    """
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    short = docs.select("doc_id", "text", "lang", F.length("text").cast("long").alias("size"), F.xxhash64("text").alias("t")).where(F.col("size") <= TRAIN_CHARS)
    known = short.select("doc_id", "lang", "size", "t").join(marked, "doc_id").withColumn("h", F.xxhash64("doc_id"))
    known = known.withColumns({"half": F.col("h") < 0, "part": F.pmod(F.xxhash64("h"), F.lit(PARTS))})
    for keys in (["lang", "toxic", "half", "part"], ["lang", "toxic", "half"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("h", "doc_id", "t"))
        known = known.withColumn("n", place).where(F.col("n") <= max(most // 2, 1))
    some = known.orderBy("h", "doc_id", "t").limit(TRAIN_ALL)
    total = F.sum("size").over(Window.orderBy("h", "doc_id", "t"))  # over TRAIN_ALL rows at most
    chosen = stored(some.withColumn("total", total).where(F.col("total") <= TRAIN_TOTAL).select("doc_id", "t", "toxic").distinct())
    return short.join(F.broadcast(chosen), ["doc_id", "t"]).select("text", "lang", "toxic")


def train(docs: DataFrame, labels: DataFrame, most: int | None = None) -> Model:
    """The model from all labelled documents: four fifths train, in rounds of blocks (see `_round`), the rest calibrates. Where
    they fit one block this is what `fit` does. Without a text of either label to train on, the model calls nothing toxic.

    most: for trials, the model from a bounded number of documents of each language and label, which come to the driver.
    """
    if most is not None:
        rows = training_rows(docs, labels, most).where("text IS NOT NULL").orderBy(F.xxhash64("text")).collect()
        return fit([r.text for r in rows], np.array([r.toxic == 1 for r in rows], float), [r.lang for r in rows])
    rng = np.random.default_rng(6)
    m = _start(rng)
    every = blocks(docs, labels)
    used, held = every.where("NOT held"), every.where("held")
    n, n_toxic = used.agg(F.sum("n"), F.sum("n_toxic")).first()
    if n and 0 < n_toxic < n:
        m.out[:] = rng.normal(0, 0.3, len(m.out))
        speed = _speeds(m)
        for k in range(EPOCHS):
            _round(used, m, speed, (0.5 * n / n_toxic, 0.5 * n / (n - n_toxic)), k)
        m.threshold = 0.5
        _calibrate(held, m)
    dropped(every)
    return m


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang, probability, toxic) of each row: whole texts, against the threshold of the row's language.

    A text without words, or null, has probability 0 and isn't toxic; an unknown or null language has the threshold of all
    languages. Rows are judged one by one: repeated rows and null ids change nothing else, further columns don't matter, an
    empty table gives an empty result.
    """
    shipped, kind = docs.sparkSession.sparkContext.broadcast(model), dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = flat(part.column("text"))
                whole, begin, first = word_rows(data, offsets)
                pooled, _, _ = features(m, (whole, begin), first)
                p = np.where(np.diff(first) > 0, 1 / (1 + np.exp(-(pooled @ m.out + m.out_bias))), 0.0)
                limit = np.array([m.thresholds.get(name, m.threshold) for name in part.column("lang").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column("lang"), pa.array(np.round(p.astype(float), 6)), pa.array(p >= limit)], ["doc_id", "lang", "probability", "toxic"])

    return docs.select("doc_id", "text", "lang").mapInArrow(run, f"doc_id {kind}, lang string, probability double, toxic boolean")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents called toxic: (doc_id, lang, probability)."""
    docs = table(spark, sf_dir, "documents")
    return classify(docs, train(docs, table(spark, sf_dir, "labels"))).where("toxic").drop("toxic")
