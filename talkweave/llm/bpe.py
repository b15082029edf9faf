"""Operator 2: BPE encoding and decoding of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import _bpe
from ._arrays import flat, lists, slices
from ._tables import table

#: Where the rank files of public vocabularies lie; the driver reads one and sends its tables to the executors.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
_encoders: dict[str, _bpe.Encoder] = {}


def encoder(name: str, shipped) -> _bpe.Encoder:
    """The worker's encoder for a vocabulary, kept between tasks."""
    if name not in _encoders:
        _encoders[name] = _bpe.Encoder(shipped.value)
    return _encoders[name]


def ship(spark: SparkSession, path: str):
    """The tables of a vocabulary for all executors: a few MB, bound by the vocabulary and not by the data."""
    return spark.sparkContext.broadcast(_bpe.load(path))


def encode(docs: DataFrame, path: str = VOCABULARY, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Token ids of each text, and whether decoding them gives its bytes back.

    Greedy longest matches are proposed, all neighbouring pairs checked at once, and only words that fail are merged
    step by step. Result: key, n_tokens, n_bytes, ids (array<int>), exact. A null text counts as an empty one: no
    tokens, exact. Every row is encoded on its own, so repeated rows, also with different texts, null keys and further columns
    change nothing; a very long text is encoded whole; an empty table gives an empty result. No shuffle: the only pass reads
    key and text.
    """
    shipped, kind = ship(docs.sparkSession, path), dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, shipped)
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = flat(part.column("text"))
                ids, first = e.encode(data, offsets)
                back, at = e.decode(ids, first)
                if np.array_equal(back, data) and np.array_equal(at, offsets):
                    exact = np.ones(len(offsets) - 1, bool)
                else:
                    exact = np.array([np.array_equal(back[at[i] : at[i + 1]], data[offsets[i] : offsets[i + 1]]) for i in range(len(offsets) - 1)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(first), pa.int64()), pa.array(np.diff(offsets), pa.int64()), lists(ids, first, pa.int32()), pa.array(exact)],
                    [key, "n_tokens", "n_bytes", "ids", "exact"],
                )

    return docs.select(key, docs[text].alias("text")).mapInArrow(run, f"`{key}` {kind}, n_tokens long, n_bytes long, ids array<int>, exact boolean")


def decode(encoded: DataFrame, path: str = VOCABULARY, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """The texts (key, text) of arrays of token ids. A null array gives a null text, an empty one an empty text;
    an id outside the vocabulary, or bytes that are no text, raise an error."""
    shipped, kind = ship(encoded.sparkSession, path), dict(encoded.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, shipped)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                column = part.column("ids")
                sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                first = np.concatenate([[0], np.cumsum(sizes)])
                back, at = e.decode(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), first)
                raw = back.tobytes()
                null = column.is_null().to_pylist()
                texts = [None if null[i] else raw[at[i] : at[i + 1]].decode() for i in range(len(sizes))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], [key, "text"])

    return encoded.select(key, encoded[ids].alias("ids")).mapInArrow(run, f"`{key}` {kind}, text string")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`encode` over the documents table."""
    return encode(table(spark, sf_dir, "documents"))


