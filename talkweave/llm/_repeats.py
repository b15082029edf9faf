"""Long repeats between documents: anchors, segments around shared anchors, and spans of later copies.

Anchors (a key and a word position) are chosen by content, so that a repeat holds the same anchors wherever it occurs.
Only keys, ids and positions are shuffled for all documents. Around anchors whose key occurs twice, the words go to the
home of that key, the least id of a document that has it; there, repeats are searched exactly, a bounded number of words at
a time. A home of more than HOT anchors (a passage that many documents share) isn't brought together: its windows are
named by 128-bit hashes, each task finds the first place of each among its own, and only those firsts meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._arrays import U, flat, hash_spans, mix, ranges, released, slices, words
from ._tables import beside, dropped, stored

#: Anchors that one home takes; and bytes of words (eight each) that are searched together, beyond one such home.
HOT, TOGETHER = 20_000, 16_000_000
#: Words whose windows are hashed at once.
WINDOWS = 500_000
#: How often a task sees a key that is counted before it is sent.
HEAVY = 64

Anchors = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]
Search = Callable[[np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray]]


def gram_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` tokens from each position on (positions too near the end are cut off)."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, at, out, h = tokens, 0, None, 1
    while True:
        if size & h:
            part = power[at : at + n]
            out = part.copy() if out is None else mix(out * U(0x9E3779B97F4A7C15) + part)
            at += h
        h *= 2
        if h > size:
            return out
        m = h // 2
        power = mix(power[:-m] * U(0xA0761D6478BD642F) + power[m:])


def tokens_of(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and the first word of each text."""
    data, offsets = flat(part.column("text"))
    starts, ends, first = words(data, offsets)
    return hash_spans(data, starts, ends), first


def shared_anchors(marked: DataFrame) -> DataFrame:
    """Of anchors (key, doc_id, version, at, size) those whose key is at several places, with home (the least id), n, and what
    tells whether the places of two keys are next to each other throughout: first (the least start), starts and ends, sums over
    40 bits of the hashes of where they start and end (null beyond 63 bits).

    Keys that a task sees HEAVY times or more are counted in each task before they are sent, so one that a third of all rows
    have is no hot key; what is left, at most HEAVY times the tasks for each key, is sorted out in one shuffle.
    """

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = [b.column(0).to_numpy() for b in batches if b.num_rows]
        if keys:
            name, count = np.unique(np.concatenate(keys), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(name[count >= HEAVY])], ["key"])

    place = lambda at: F.xxhash64("doc_id", "version", at).bitwiseAND(F.lit((1 << 40) - 1))
    known = {"home": F.min("doc_id"), "n": F.count(F.lit(1)), "first": F.min(place("at")), "starts": F.try_sum(place("at")), "ends": F.try_sum(place(F.col("at") + F.col("size")))}
    several = "starts IS NULL OR starts <> n * first"  # else all are one place, in rows that repeat each other
    heavy = beside(marked.select("key").mapInArrow(often, "key long").distinct())
    light = marked.join(heavy, "key", "left_anti").withColumns({c: f.over(Window.partitionBy("key")) for c, f in known.items()}).where(f"n > 1 AND ({several})")
    many = marked.join(heavy, "key", "left_semi")
    counted = many.groupBy("key").agg(*(f.alias(c) for c, f in known.items())).where(several)
    return light.unionByName(many.join(beside(counted), "key").select(*light.columns))


def repeats(docs: DataFrame, anchors: Anchors, search: Search, length: int, left: int, merge: Callable[[DataFrame], DataFrame] | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, start_word, end_word, n_words, source_doc_id): spans of words that occurred before. See `spans`."""
    return spans(docs, anchors, search, length, left, merge, text, key).drop("version")


def spans(docs: DataFrame, anchors: Anchors, search: Search, length: int, left: int, merge: Callable[[DataFrame], DataFrame] | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, version, start_word, end_word, n_words, source_doc_id): spans of words that occurred before.

    A word belongs to a span if some `length` words around it also start at an earlier place: in a document of smaller
    id, or earlier in the same one. Places are compared by id, version and position. Spans are as long as possible, end_word
    is the first word after the span, and source_doc_id the document where the span's first `length` words occur first.
    left: how many words before an anchor such a window can start. merge: joins anchors (see `shared_anchors`) that always
    come together, and adds reach, where the last one of them begins. Words are runs of characters other than ASCII white space. Texts of fewer
    words, empty or null texts and rows without an id have no spans; rows that repeat an id and text count as one document,
    an id's different texts as several, told apart by version, a hash of the text; a very long text is one row like any
    other; an empty table gives an empty result; further columns don't matter. ids must be integers.
    """
    plain = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(docs[text]).alias("version"), docs[text].alias("text"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, first = tokens_of(part)
                keys, at, size = anchors(tokens, first)
                doc = np.searchsorted(first, at, "right") - 1
                ids, versions = (part.column(c).to_numpy()[doc] for c in ("doc_id", "version"))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids), pa.array(versions), pa.array((at - first[doc]).astype(np.int32)), pa.array(size.astype(np.int32))], ["key", "doc_id", "version", "at", "size"])

    marked = stored(plain.mapInArrow(mark, "key long, doc_id long, version long, at int, size int"))
    shared = stored(shared_anchors(marked))
    dropped(marked)
    if merge:
        before, shared = shared, stored(merge(shared))
        dropped(before)
    kept = shared
    if not merge:
        shared = shared.withColumn("reach", F.col("at"))
    hot = shared.groupBy("home").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("home", F.lit(True).alias("hot"))
    hot = stored(hot)  # at most the anchors' number by HOT
    is_hot = not hot.isEmpty()
    placed = shared.join(F.broadcast(hot), "home", "left") if is_hot else shared.withColumn("hot", F.lit(False))
    # Texts with the places of their anchors, those in hot homes and the others: the texts are sent once.
    wanted = placed.groupBy("doc_id", "version").agg(F.collect_set(F.struct("at", "reach", "home", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("places"))

    def segments(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """Tokens of the texts; text, home, whether that is hot, first and end token of each segment around anchors; first token of
        each text. All hot homes count as one."""
        tokens, first = tokens_of(part)
        places = part.column("places")
        count = places.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        at, reach, home = (places.flatten().field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1, 2))
        warm = places.flatten().field(3).to_numpy(zero_copy_only=False).astype(bool)
        home = np.where(warm, 0, home)
        doc = np.repeat(np.arange(len(count)), count)
        low = np.maximum(at - left, 0) + first[doc]
        high = np.minimum(reach + length + first[doc], first[doc + 1])
        order = np.lexsort((low, home, warm, doc))
        doc, home, warm, low, high = doc[order], home[order], warm[order], low[order], high[order]
        if not len(doc):
            return tokens, doc, home, warm, low, high, first
        # Overlapping or touching pieces of one document and home become one segment.
        group = np.concatenate([[True], (doc[1:] != doc[:-1]) | (home[1:] != home[:-1]) | (warm[1:] != warm[:-1])])
        number = np.cumsum(group)
        wide = np.int64(len(tokens) + 1)
        far = np.maximum.accumulate(high + number * wide) - number * wide
        new = group.copy()
        new[1:] |= low[1:] > far[:-1]
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(doc)) - 1
        return tokens, doc[head], home[head], warm[head], low[head], far[last], first

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, doc, home, warm, start, stop, first = segments(part)
                if not len(doc):
                    continue
                size = stop - start
                raw = np.concatenate([[0], np.cumsum(size)]) * 8
                ids, versions = (part.column(c).to_numpy()[doc] for c in ("doc_id", "version"))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(home), pa.array(warm), pa.array(ids), pa.array(versions), pa.array((start - first[doc]).astype(np.int32)),
                        pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(raw.astype(np.int32)), pa.py_buffer(tokens[ranges(start, size)])]),
                    ],
                    ["home", "hot", "doc_id", "version", "start", "tokens"],
                )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, versions, start = (batch.column(c).to_numpy() for c in ("doc_id", "version", "start"))
            pieces = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("tokens")]
            size = np.array([len(x) for x in pieces])
            for some in np.split(np.arange(len(size)), np.flatnonzero(np.diff(np.cumsum(size) // WINDOWS)) + 1):
                tokens = np.concatenate([pieces[i] for i in some])
                count = np.maximum(size[some] - length + 1, 0)
                at, owner = ranges(np.cumsum(size[some]) - size[some], count), np.repeat(some, count)
                a, b = gram_hashes(tokens, length), gram_hashes(mix(tokens ^ U(0x5851F42D4C957F2D)), length)
                s = ranges(start[some].astype(np.int64), count)
                yield pa.RecordBatch.from_arrays([pa.array(a[at].view(np.int64)), pa.array(b[at].view(np.int64)), pa.array(ids[owner]), pa.array(versions[owner]), pa.array(s)], ["a", "b", "doc_id", "version", "s"])
        released()

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows come sorted by home: whole homes are searched as soon as there are words enough."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.column("tokens").nbytes for b in held) >= TOGETHER:
                homes = np.concatenate([b.column("home").to_numpy() for b in held])
                whole = int(np.searchsorted(homes == homes[-1], True))  # the last home may go on
                if whole:
                    both = pa.Table.from_batches(held)
                    yield from sought(both.slice(0, whole))
                    held = both.slice(whole).to_batches()
        if held:
            yield from sought(pa.Table.from_batches(held))
        released()

    def sought(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, versions = whole.column("doc_id").to_numpy(), whole.column("version").to_numpy()
        start = whole.column("start").to_numpy().astype(np.int64)
        pieces = [np.frombuffer(x.as_buffer(), np.uint64) for x in whole.column("tokens")]
        order = np.lexsort((start, versions, ids))
        # Segments of one document that overlap or touch become one, so that no place is there twice.
        parts, heads, begins, rows_of, total = [], [], [], [], 0
        last_row = reach = None
        for k in order.tolist():
            p, s = pieces[k], int(start[k])
            if last_row == (ids[k], versions[k]) and s <= reach:
                p = p[reach - s :]
            else:
                heads.append(total)
                begins.append(s)
                rows_of.append(k)
                last_row, reach = (ids[k], versions[k]), s
            if len(p):
                parts.append(p)
                total += len(p)
                reach += len(p)
        tokens, head = np.concatenate(parts), np.array(heads)
        begin, row_of = np.array(begins), np.array(rows_of)
        size = np.diff(np.append(head, len(tokens)))
        segment = np.repeat(np.arange(len(head)), size)
        ends = np.repeat(head + size, size)
        hits, source = search(tokens, ends, length)
        if not len(hits):
            return
        new = np.concatenate([[True], (hits[1:] != hits[:-1] + 1) | (segment[hits[1:]] != segment[hits[:-1]])])
        at = np.flatnonzero(new)
        to = np.append(at[1:], len(hits)) - 1
        seg = segment[hits[at]]
        from_ = hits[at] - head[seg] + begin[seg]
        until = hits[to] - head[seg] + begin[seg] + length
        doc_of = ids[row_of]
        yield pa.RecordBatch.from_arrays([pa.array(doc_of[seg]), pa.array(versions[row_of][seg]), pa.array(from_), pa.array(until), pa.array(doc_of[segment[source[at]]])], ["doc_id", "version", "s", "e", "source"])

    rows = "doc_id long, version long, s long, e long, source long"
    cold = plain.join(wanted, ["doc_id", "version"]).mapInArrow(cut, "home long, hot boolean, doc_id long, version long, start int, tokens binary")
    if is_hot:
        both = stored(cold)
        dropped(kept, hot)
        cold = both.where("NOT hot")
    cold = cold.drop("hot")
    found = cold.repartition("home").sortWithinPartitions("home").mapInArrow(seek, rows)
    if is_hot:
        every = stored(both.where("hot").mapInArrow(windows, "a long, b long, doc_id long, version long, s long"))
        place = F.struct("doc_id", "version", "s")
        firsts = every.groupBy("a", "b").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low <> high").select("a", "b", "low")
        again = every.join(beside(firsts), ["a", "b"]).where(place > F.col("low"))
        found = found.unionByName(again.select("doc_id", "version", "s", (F.col("s") + length).alias("e"), F.col("low.doc_id").alias("source")))
    by_start = Window.partitionBy("doc_id", "version").orderBy("s", "e", "source")
    reach = F.max("e").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    islands = found.withColumn("new", F.coalesce(F.col("s") > reach, F.lit(True)).cast("int"))
    islands = islands.withColumn("island", F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    joined = islands.groupBy("doc_id", "version", "island").agg(F.min(F.struct("s", "source")).alias("head"), F.max("e").alias("end_word"))
    return joined.select("doc_id", "version", F.col("head.s").alias("start_word"), "end_word", (F.col("end_word") - F.col("head.s")).alias("n_words"), F.col("head.source").alias("source_doc_id"))


def repeat_sql(length: int) -> str:
    """DuckDB SQL for the rows of `repeats` over documents."""
    return f"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(text, '[\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f ]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL
), grams AS (
  SELECT doc_id, pos, list_slice(w, pos + 1, pos + {length}) AS gram
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - {length} + 1, 0))) AS pos FROM words)
), seen AS (
  SELECT doc_id, pos, first_value(doc_id) OVER earlier AS source, row_number() OVER earlier AS n
  FROM grams WINDOW earlier AS (PARTITION BY gram ORDER BY doc_id, pos)
), hits AS (
  SELECT doc_id, pos, source, CASE WHEN pos - lag(pos) OVER place <= {length} THEN 0 ELSE 1 END AS fresh
  FROM seen WHERE n > 1 WINDOW place AS (PARTITION BY doc_id ORDER BY pos)
), islands AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS island FROM hits
)
SELECT doc_id, CAST(min(pos) AS BIGINT) AS start_word, CAST(max(pos) + {length} AS BIGINT) AS end_word,
  CAST(max(pos) + {length} - min(pos) AS BIGINT) AS n_words, arg_min(source, pos) AS source_doc_id
FROM islands GROUP BY doc_id, island"""
