"""Operator 10: later copies of passages by longest-previous-factor arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._arrays import flat, ranges, slices, words
from ._repeats import gram_hashes, repeat_sql, spans
from ._suffixes import common_prefixes, previous_factors, suffix_order
from ._tables import beside, fresh, table

#: Words that a repeat has at least, and words of the grams whose least hash marks each window of that length.
LENGTH, GRAM = 50, 25
_PLACE = 24


def minimizers(tokens: np.ndarray, first: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, position and size of the gram of least hash in every window of `length` tokens (the first of equals).

    The choice depends on the window's tokens only, so equal windows have equal marks: none is missed.
    """
    h = gram_hashes(tokens, gram)
    span = length - gram + 1
    n = np.diff(first)
    windows = np.maximum(n - length + 1, 0)
    if not windows.sum():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    in_text = np.arange(len(h)) - np.repeat(first[:-1], n)[: len(h)]
    low = np.uint64((1 << _PLACE) - 1)
    least = h & ~low | in_text.astype(np.uint64) & low
    size = 1
    while size * 2 <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span:
        least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
    i = ranges(first[:-1], windows)
    begin = np.repeat(first[:-1], windows)
    # Only the low bits of the place are there; the window tells the rest.
    inside = i - begin
    at = i + ((least[i] & low).astype(np.int64) - inside) % (1 << _PLACE)
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    return h[at], at, np.full(len(at), gram)


def earlier_factors(tokens: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions with a previous factor of at least `length` tokens, and the first position with these tokens.

    Factors are measured just far enough to tell, to between one and four times `length`.
    """
    order, levels = suffix_order(tokens, ends, length)
    shared = common_prefixes(order, levels, ends)
    factor = previous_factors(order, shared)
    group = np.cumsum(shared < length) - 1
    heads = np.flatnonzero(shared < length)
    first = np.empty(len(tokens), np.int64)
    first[order] = np.minimum.reduceat(order, heads)[group]
    hits = np.flatnonzero(factor >= length)
    return hits, first[hits]


def versioned(docs: DataFrame, length: int = LENGTH, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`later_copies` with the version of each document, where an id repeats with another text."""
    return spans(docs, lambda tokens, first: minimizers(tokens, first, length, length // 2), earlier_factors, length, length - length // 2, None, text, key)


def later_copies(docs: DataFrame, length: int = LENGTH, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Spans of at least `length` words that occur earlier; rows, order and special cases as in `_repeats.spans`.

    Every window of `length` words is marked by its gram of least hash; around marks that occur twice, suffixes are put in
    order, and each position's longest previous factor is read off its neighbours with smaller positions.
    """
    return versioned(docs, length, text, key).drop("version")


def removed(docs: DataFrame, spans_: DataFrame) -> DataFrame:
    """docs without the spans (doc_id, version, start_word, end_word) of their texts; n_chars, where there is one, follows.

    The white space before a removed span goes with it. A document that loses its last word is dropped; documents without
    spans, and rows without an id, stay as they are.
    """
    columns, schema = docs.columns, docs.schema
    id_, version, mark = fresh(docs, "_id", "_version", "_cuts")
    cuts = spans_.groupBy(F.col("doc_id").alias(id_), F.col("version").alias(version)).agg(F.sort_array(F.collect_list(F.struct("start_word", "end_word"))).alias(mark))
    joined = docs.join(beside(cuts), (docs["doc_id"] == F.col(id_)) & (F.xxhash64(docs["text"]) == F.col(version)), "left").drop(id_, version)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                cuts = part.column(mark)
                rows = np.flatnonzero(cuts.is_valid().to_numpy(zero_copy_only=False))
                out = part.drop_columns([mark])
                if len(rows):
                    texts, gone = part.column("text").to_pylist(), []
                    data, offsets = flat(part.column("text"))
                    starts, ends, first = words(data, offsets)
                    for r in rows.tolist():
                        raw = data[offsets[r] : offsets[r + 1]].tobytes()
                        s, e = starts[first[r] : first[r + 1]] - offsets[r], ends[first[r] : first[r + 1]] - offsets[r]
                        kept, at = [], 0
                        for cut in cuts[r].as_py():
                            a, b = cut["start_word"], min(cut["end_word"], len(s))
                            if a >= len(s):
                                break
                            kept.append(raw[at : e[a - 1] if a else 0])
                            at = int(e[b - 1])
                        kept.append(raw[at:])
                        texts[r] = b"".join(kept).decode()
                        if not texts[r].strip():
                            gone.append(r)
                    k = out.schema.get_field_index("text")
                    out = out.set_column(k, out.schema.field(k), pa.array(texts, out.schema.field(k).type))
                    if "n_chars" in columns:
                        k = out.schema.get_field_index("n_chars")
                        was = out.column(k).to_pylist()
                        for r in rows.tolist():
                            was[r] = len(texts[r])
                        out = out.set_column(k, out.schema.field(k), pa.array(was, out.schema.field(k).type))
                    stay = np.ones(len(out), bool)
                    stay[gone] = False
                    out = out.filter(pa.array(stay))
                yield out

    return joined.mapInArrow(run, schema)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`later_copies` over the documents table."""
    return later_copies(table(spark, sf_dir, "documents"))


def cut_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without later copies of passages, all columns.

    Null ids, null, empty and short texts stay as they are; rows that repeat an id and text are cut alike, an id's different
    texts each for itself; clashing columns don't matter; an empty table stays empty.
    """
    return removed(docs, versioned(docs))


SQL = repeat_sql(LENGTH)
