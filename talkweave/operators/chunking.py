"""Timed sentences to bounded chunks: margins, silences, packing, rendering; and sessions of words."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

SILENCE = "<|silence|>"


def with_margin(df: DataFrame, keys: list[str], margin: float, start: str = "start", end: str = "end") -> DataFrame:
    """Start and end moved outward by a margin where there is room: the start if the gap before exceeds two margins (the first
    row: if it stays positive), the end if the next start lies more than a margin away. The last end stays."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    gap, room = F.col(start) - F.lag(end).over(w), F.lead(start).over(w) - F.col(end)
    first = F.row_number().over(w) == 1
    new_start = F.when(F.when(first, F.col(start) - margin > 0).otherwise(gap > 2 * margin), F.col(start) - margin).otherwise(F.col(start))
    new_end = F.when(F.coalesce(room > margin, F.lit(False)), F.col(end) + margin).otherwise(F.col(end))
    return df.withColumns({"_s": new_start, "_e": new_end}).drop(start, end).withColumnsRenamed({"_s": start, "_e": end})


def with_silences(df: DataFrame, keys: list[str], long_ms: int = 30_000) -> DataFrame:
    """Rows (keys, start_ms, end_ms, text) with a silence row in every gap, duration_ms and is_long. Overlapping rows get a
    silence of negative length."""
    w = Window.partitionBy(*keys).orderBy("start_ms", "end_ms")
    before = F.lag("end_ms").over(w)
    gap = F.struct(F.col("_before").alias("start_ms"), F.col("start_ms").alias("end_ms"), F.lit(SILENCE).alias("text"))
    own = F.struct("start_ms", "end_ms", "text")
    marked = df.withColumn("_before", before)
    rows = F.when(F.col("_before").isNotNull() & (F.col("_before") != F.col("start_ms")), F.array(gap, own)).otherwise(F.array(own))
    out = marked.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.*")
    return out.withColumn("duration_ms", F.col("end_ms") - F.col("start_ms")).withColumn("is_long", F.col("duration_ms") > long_ms)


def make_chunks(subs: Iterable[dict], least: int = 10_000, most: int = 30_000, silent_chunks: bool = False) -> list[dict]:
    """Packs sentences and silences, in order, into chunks of least..most ms.

    A live, duplicate or long sentence ends the current chunk (dropped below `least`) and is left out. A silence that would
    overrun fills the chunk to `most`, then whole chunks of silence, the remainder goes on. Another sentence that would overrun
    starts a new chunk. Sentences in a chunk have times relative to its start; silences have negative ids.
    """
    chunks: list[dict] = []
    current: list[dict] = []
    total, silence_id = 0, 0

    def flush() -> None:
        nonlocal current, total
        if current:
            start, end = current[0]["start"], current[-1]["end"]
            inner = [s | {"start": s["start"] - start, "end": s["end"] - start} for s in current]
            text = " ".join(s["text"] for s in current if s["text"] not in ("", SILENCE))
            chunks.append({"start": start, "end": end, "duration": total, "subs": inner, "text": text, "text_whisper": whisper_text(inner), "sub_ids": [s["id"] for s in current], "speech_id": current[0].get("speech_id")})
        current, total = [], 0

    for k, sub in enumerate(subs):
        silent = sub["text"] == SILENCE
        if silent:
            silence_id -= 1
        sub = dict(sub) | {"id": silence_id if silent else sub.get("id", k)}
        if sub.get("live") or sub.get("duplicate") or (sub.get("is_long") and not silent):
            if total >= least:
                flush()
            current, total = [], 0
            continue
        duration = sub["end"] - sub["start"]
        if duration + total > most:
            if silent:
                at = sub["start"]
                room = most - total
                if room:
                    current.append(sub | {"end": at + room, "duration": room})
                    total += room
                flush()
                at += room
                while sub["end"] - at > most:
                    silence_id -= 1
                    current, total = [sub | {"start": at, "end": at + most, "duration": most, "id": silence_id}], most
                    flush()
                    at += most
                silence_id -= 1
                sub, duration = sub | {"start": at, "duration": sub["end"] - at, "id": silence_id}, sub["end"] - at
            else:
                flush()
        if duration:
            current.append(sub)
            total += duration
    if total >= least:
        flush()
    return chunks if silent_chunks else [c for c in chunks if c["text"]]


def whisper_text(subs: list[dict]) -> str:
    """Texts between their times in 20 ms steps; silences are left out."""
    tag = lambda ms: f"<{ms // 20 * 20 / 1000:.2f}>"
    return "".join(f"{tag(s['start'])} {s['text']}{tag(s['end'])}" for s in subs if s["text"] not in ("", SILENCE))


CHUNK = "start long, `end` long, duration long, text string, text_whisper string, sub_ids array<int>, n_subs int"


def pack_chunks(subs: DataFrame, key: str, least: int = 10_000, most: int = 30_000, silent_chunks: bool = False) -> DataFrame:
    """make_chunks of each key's rows (start_ms, end_ms, text), ordered by time. One shuffle; a task holds one key's rows."""

    def run(k: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["start_ms", "end_ms"], kind="stable")
        rows = [{"start": int(s), "end": int(e), "text": t or "", "id": i, "is_long": e - s > most} for i, (s, e, t) in enumerate(zip(g["start_ms"], g["end_ms"], g["text"]))]
        made = make_chunks(rows, least, most, silent_chunks)
        return pd.DataFrame([{key: k[0], "chunk_id": i, **{c: m[c] for c in ("start", "end", "duration", "text", "text_whisper", "sub_ids")}, "n_subs": len(m["subs"])} for i, m in enumerate(made)], columns=[key, "chunk_id", "start", "end", "duration", "text", "text_whisper", "sub_ids", "n_subs"])

    kind = dict(subs.dtypes)[key]
    return subs.select(key, "start_ms", "end_ms", "text").groupBy(key).applyInPandas(run, f"`{key}` {kind}, chunk_id int, {CHUNK}")


def greedy_chunk_ids(order: str, duration: str, most: int) -> Column:
    """Aggregate: array<struct<pos, chunk>> of items packed in order into chunks of at most `most`; an item that alone exceeds
    it has a chunk to itself. One pass over each sorted list (an aggregate that grows an array would copy it at each step)."""
    items = F.array_sort(F.collect_list(F.struct(F.col(order).cast("long").alias("pos"), F.col(duration).cast("long").alias("size"))))
    chunks = greedy_chunks(most)(F.transform(items, lambda x: x["size"]))
    return F.arrays_zip(F.transform(items, lambda x: x["pos"]).alias("pos"), chunks.alias("chunk"))


def greedy_chunks(most: int):
    """Arrow UDF: sizes in order -> number of each one's chunk."""

    @F.pandas_udf("array<int>")
    def udf(sizes: pd.Series) -> pd.Series:
        def one(x):
            out, total, chunk = [], 0, 0
            for s in x.tolist():
                if total > 0 and total + s > most:
                    total, chunk = 0, chunk + 1
                total += s
                out.append(chunk)
            return out

        return sizes.map(lambda x: None if x is None else one(x))

    return udf


def capped_sessions(words: Iterable[tuple[int, int]], gap: int, most: int) -> list[int]:
    """Session of each (start, end) in order: a new one at a gap of at least `gap`, or where the session would exceed `most`;
    then neighbouring sessions join as long as they stay below `most` together."""
    spans: list[list[int]] = []
    member = []
    for s, e in words:
        if not spans or s - spans[-1][1] >= gap or e - spans[-1][0] > most:
            spans.append([s, e])
        else:
            spans[-1][1] = e
        member.append(len(spans) - 1)
    joined, start, number = [], None, -1
    for s, e in spans:
        if start is None or e - start >= most:
            start, number = s, number + 1
        joined.append(number)
    return [joined[m] for m in member]


class _Folded:
    """A stretch of words: least start, greatest end, and the text of those that aren't null."""

    __slots__ = ("end", "start", "words")

    def __init__(self):
        self.start = self.end = None
        self.words: list[str] = []

    def add(self, s: int | None, e: int | None, words: list[str]) -> None:
        if s is not None and (self.start is None or s < self.start):
            self.start = s
        if e is not None and (self.end is None or e > self.end):
            self.end = e
        self.words += words


class _Sessions:
    """capped_sessions of one key, word by word: what has become whole comes back as (number, stretch)."""

    def __init__(self, gap: int, most: int):
        self.gap, self.most, self.number = gap, most, -1
        self.span = self.first = self.last = self.known = self.session = self.begin = None

    def add(self, s: int | None, e: int | None, word: list[str]) -> tuple[int, _Folded] | None:
        done = None
        apart = s is not None and self.last is not None and s - self.last >= self.gap
        if self.span is None or apart or (e is not None and self.first is not None and e - self.first > self.most):
            done = self._join()
            self.span, self.first, self.known = _Folded(), s, None
        self.last = e
        self.known = self.known if e is None else e
        self.span.add(s, e, word)
        return done

    def _join(self) -> tuple[int, _Folded] | None:
        """The current span goes to the current session, or begins the next one."""
        done, span = None, self.span
        if span is None:
            return None
        if self.session is None or (self.known is not None and self.begin is not None and self.known - self.begin >= self.most):
            done = None if self.session is None else (self.number, self.session)
            self.session, self.begin, self.number = span, self.first, self.number + 1
        else:
            self.session.add(span.start, span.end, span.words)
        return done

    def end(self) -> list[tuple[int, _Folded]]:
        done = self._join()
        return ([done] if done else []) + ([(self.number, self.session)] if self.session else [])


class _Parts:
    """Parts of one key, word by word: a new one as soon as the one before lasts `least`."""

    def __init__(self, least: int):
        self.least, self.number, self.part, self.begin, self.full = least, -1, None, None, False

    def add(self, s: int | None, e: int | None, word: list[str]) -> tuple[int, _Folded] | None:
        done = None
        if self.part is None or self.full:
            done = None if self.part is None else (self.number, self.part)
            self.part, self.begin, self.number = _Folded(), s, self.number + 1
        self.full = e is not None and self.begin is not None and e - self.begin >= self.least
        self.part.add(s, e, word)
        return done

    def end(self) -> list[tuple[int, _Folded]]:
        return [(self.number, self.part)] if self.part else []


def _listed(column: pa.Array) -> list:
    """to_pylist, by way of numpy where that gives the same: it takes a tenth of the time."""
    plain = pa.types.is_string(column.type) or (pa.types.is_integer(column.type) and not column.null_count)
    return column.to_numpy(zero_copy_only=False).tolist() if plain else column.to_pylist()


#: Rows, and characters of text, of an output batch.
BATCH_ROWS, BATCH_CHARS = 10_000, 4 << 20


def _folded(words: DataFrame, key: str, name: str, folds: Callable[[], _Sessions | _Parts]) -> DataFrame:
    """(key, name, start_ms, end_ms, text): each key's words, by start, end (nulls last) and word, folded one after the other.

    Spark sorts (and spills); keys share a task's batches, and what is held is the stretch that isn't whole yet, not a key's
    rows. A stretch without a word has null text.
    """
    kind = dict(words.dtypes)[key]
    schema = f"`{key}` {kind}, `{name}` long, start_ms long, end_ms long, text string"
    wide = words.select(F.col(key), F.col("start_ms").cast("long").alias("start_ms"), F.col("end_ms").cast("long").alias("end_ms"), F.col("word").cast("string").alias("word"))
    arrow_key = wide.select(key).schema

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [to_arrow_type(arrow_key[0].dataType), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        out: list[list] = [[] for _ in types]
        size, now, fold = 0, None, None

        def put(number: int, x: _Folded) -> None:
            nonlocal size
            text = " ".join(x.words) if x.words else None
            size += len(text or "")
            for column, value in zip(out, (now, number, x.start, x.end, text)):
                column.append(value)

        def batch() -> pa.RecordBatch:
            nonlocal size
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=[key, name, "start_ms", "end_ms", "text"])
            for c in out:
                c.clear()
            size = 0
            return made

        for part in parts:
            for k, s, e, w in zip(*map(_listed, part.columns)):
                if fold is None or (k != now and (k == k or now == now)):  # NaN is a key like any other
                    for x in fold.end() if fold else ():
                        put(*x)
                    now, fold = k, folds()
                whole = fold.add(s, e, [] if w is None else [w])
                if whole:
                    put(*whole)
                    if len(out[0]) >= BATCH_ROWS or size >= BATCH_CHARS:
                        yield batch()
            if len(out[0]) >= BATCH_ROWS:
                yield batch()
        for x in fold.end() if fold else ():
            put(*x)
        yield batch()

    order = [F.asc(key), *(F.asc_nulls_last(c) for c in ("start_ms", "end_ms", "word"))]
    return wide.repartition(F.col(key)).sortWithinPartitions(*order).mapInArrow(run, schema)


def sessionised(words: DataFrame, key: str, gap_ms: int = 1000, most_ms: int = 20_000) -> DataFrame:
    """(key, session_id, start_ms, end_ms, text) of timed words (start_ms, end_ms, word): `capped_sessions` in one pass."""
    return _folded(words, key, "session_id", lambda: _Sessions(gap_ms, most_ms))


def sentence_times(sentences: list[tuple[int, int, str]], tokens: list[dict]) -> list[dict]:
    """Times of sentences (start char, end char, text) from tokens (original_start, original_end, start_time, end_time): that
    of the token with the first character or else the next known one, and of the last or else the one before; without either
    the sentence is left out."""
    out = []
    for s, e, text in sentences:
        start = next((t["start_time"] for t in tokens if t["original_end"] > s and t["original_start"] < e and t["start_time"] is not None), None)
        end = next((t["end_time"] for t in reversed(tokens) if t["original_start"] < e and t["original_end"] > s and t["end_time"] is not None), None)
        if start is not None and end is not None:
            out.append({"start": start, "end": end, "text": text})
    return out


def concatenated(words: DataFrame, key: str, least_ms: int = 25_000) -> DataFrame:
    """(key, part, start_ms, end_ms, text): timed words (start_ms, end_ms, word) in order, a new part as soon as the one before
    lasts least_ms; the last may be shorter."""
    return _folded(words, key, "part", lambda: _Parts(least_ms))


def timed_spans(spans: DataFrame, times: DataFrame, key: str) -> DataFrame:
    """Spans of normalised text (key, index, ...) with the times of their first and last word: times has key,
    normalized_word_index, position, start_time, end_time. Spans without a timed word keep null times."""
    known = times.groupBy(key, F.col("normalized_word_index").alias("index")).agg(F.min_by("start_time", "position").alias("start_time"), F.max_by("end_time", "position").alias("end_time"))
    return spans.join(known, [key, "index"], "left")
