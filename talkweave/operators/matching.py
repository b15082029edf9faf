"""Matching recognised segments to a long reference text, in order; and texts that share words in a row with passages."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType


@dataclass
class Segment:
    file: str
    start: float
    end: float
    words: list[str]


@dataclass
class Position:
    """Where a segment lies in the reference (end exclusive); -1 where it doesn't."""

    first: int
    last: int
    ratio: float
    segment: Segment


class Matcher:
    """Reference words as numbers, and where each occurs."""

    def __init__(self, reference: list[str]):
        self.ids = {w: i for i, w in enumerate(sorted(set(reference)), 1)}
        self.corpus = [self.ids[w] for w in reference]
        self.places: dict[int, list[int]] = defaultdict(list)
        for i, w in enumerate(self.corpus):
            self.places[w].append(i)

    def encode(self, words: list[str]) -> list[int]:
        return [self.ids.get(w, 0) for w in words]

    def anywhere(self, words: list[str], most: int = 1000) -> tuple[int, int, float]:
        """Best place, among those of the first word that occurs, but not too often; the first of equals."""
        query = self.encode(words)
        for shift, w in enumerate(query):
            hits = self.places.get(w, []) if w else []
            if 0 < len(hits) <= most:
                break
        else:
            return -1, -1, 0.0
        best = (-1, -1, 0.0)
        for h in hits:
            start = max(h - shift, 0)
            first, last, score = self.near(query, start, len(query) + 10)
            if score > best[2]:
                best = (first, last, score)
        return best

    def near(self, query: list[int], start: int, width: int) -> tuple[int, int, float]:
        """The part of a window that the query matches: up to its last matching block."""
        window = self.corpus[start : start + width]
        blocks = [b for b in SequenceMatcher(None, window, query, autojunk=False).get_matching_blocks() if b.size]
        if not blocks:
            return -1, -1, 0.0
        first, last = start + blocks[0].a, start + blocks[-1].a + blocks[-1].size
        return first, last, SequenceMatcher(None, self.corpus[first:last], query, autojunk=False).ratio()


def match_in_order(matcher: Matcher, segments: list[Segment], least_words: int = 15, least_ratio: float = 0.5) -> list[Position]:
    """Each segment's place: behind the one before, else anywhere, else nowhere. Short segments before the first match are
    passed over."""
    out: list[Position] = []
    cursor = None
    for s in segments:
        if cursor is None and len(s.words) < least_words:
            out.append(Position(-1, -1, 0.0, s))
            continue
        found = (-1, -1, 0.0)
        if cursor is not None:
            n = len(s.words)
            found = matcher.near(matcher.encode(s.words), cursor, n + (int(1.5 * n) if 1.5 * n < 10 else 10))
        if found[2] < least_ratio:
            found = matcher.anywhere(s.words)
        if found[2] < least_ratio:
            found = (-1, -1, 0.0)
        else:
            cursor = found[1]
        out.append(Position(*found, s))
    return out


def joined_positions(positions: list[Position], gap_s: float = 5.0, gap_words: int = 10, most_s: float = 1200.0) -> list[Position]:
    """Neighbours of one file close to each other in time and text become one, as long as it stays short."""
    out: list[Position] = []
    for p in positions:
        if p.first < 0:
            continue
        q = out[-1] if out else None
        if q and q.segment.file == p.segment.file and 0 <= p.segment.start - q.segment.end <= gap_s and 0 <= p.first - q.last <= gap_words and q.segment.end - q.segment.start < most_s:
            out[-1] = Position(q.first, p.last, min(q.ratio, p.ratio), Segment(q.segment.file, q.segment.start, p.segment.end, q.segment.words + p.segment.words))
        else:
            out.append(p)
    return out


def matched(segments: DataFrame, references: DataFrame, key: str) -> DataFrame:
    """(key, file, start, end, first, last, ratio, text) of segments (key, file, start, end, text) against one reference text a
    key; text is the reference's. Unmatched segments have null first, last and text."""
    kind = dict(segments.dtypes)[key]

    def run(k: tuple, s: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        words = r["text"].iloc[0].split() if len(r) else []
        s = s.sort_values(["file", "start"], kind="stable")
        found = match_in_order(Matcher(words), [Segment(f, a, b, t.split()) for f, a, b, t in zip(s["file"], s["start"], s["end"], s["text"].fillna(""))])
        rows = [(k[0], p.segment.file, p.segment.start, p.segment.end, p.first if p.first >= 0 else None, p.last if p.first >= 0 else None, p.ratio, " ".join(words[p.first : p.last]) if p.first >= 0 else None) for p in found]
        out = pd.DataFrame(rows, columns=[key, "file", "start", "end", "first", "last", "ratio", "text"])
        return out.astype({"first": "Int64", "last": "Int64"})

    return segments.groupBy(key).cogroup(references.select(key, "text").groupBy(key)).applyInPandas(run, f"`{key}` {kind}, file string, start double, `end` double, first long, last long, ratio double, text string")


def gram_hits(docs: DataFrame, key: str, text: str, passages: list[tuple], name: str, kind: DataType | str, n: int = 5) -> DataFrame:
    """(key, name, hits, first): where a row's text has n words in a row that a passage (name, text) has too: how often, and the
    first place. Every gram of every text is looked up; the passages' grams are tables in each worker. Words are what ASCII
    white space leaves. One row for each row and passage that meet."""
    ids: dict[bytes, int] = {}
    grams: dict[tuple, dict] = {}
    for item, said in passages:
        w = [ids.setdefault(x, len(ids)) for x in said.encode("utf-8", "surrogatepass").split()]
        for i in range(len(w) - n + 1):
            grams.setdefault(tuple(w[i : i + n]), {})[item] = None
    shared = docs.sparkSession.sparkContext.broadcast((ids, {g: list(items) for g, items in grams.items()}))
    schema = docs.select(key).schema.add(name, kind).add("hits", "long").add("first", "long")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, grams = shared.value
        # A gram's hash is a sum of its words' numbers, each times an odd factor of its place; what meets is then compared.
        factors = np.random.default_rng(0).integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
        table = np.array(sorted(grams), np.uint64).reshape(-1, n)
        hashes = np.sort((table * factors).sum(1, dtype=np.uint64))
        types = [to_arrow_type(f.dataType) for f in schema][1:]
        for part in parts:
            rows, out = [], ([], [], [])
            texts = part.column(1).cast(pa.binary())
            for k in range(len(texts) if len(hashes) else 0):
                said = texts[k].as_py()
                words = said.split() if said else []
                if len(words) < n:
                    continue
                w = np.fromiter((ids.get(x, -1) for x in words), np.int64, len(words))
                size = len(w) - n + 1
                sums = np.zeros(size, np.uint64)
                for i in range(n):
                    sums += w[i : i + size].astype(np.uint64) * factors[i]
                at = np.minimum(np.searchsorted(hashes, sums), len(hashes) - 1)
                mine: dict = {}
                for i in np.flatnonzero(hashes[at] == sums).tolist():
                    for item in grams.get(tuple(w[i : i + n].tolist()), ()):
                        mine.setdefault(item, [0, i])[0] += 1
                for item, (hits, first) in mine.items():
                    rows.append(k)
                    for column, x in zip(out, (item, hits, first)):
                        column.append(x)
            own = part.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([own, *(pa.array(c, t) for c, t in zip(out, types))], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)
