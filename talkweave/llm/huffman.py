"""Operator 7: token ids as canonical, length-limited Huffman code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._arrays import flat, ranges, slices
from ._tables import stored, table
from .bpe import VOCABULARY, encoder, ship

#: The longest code word, and so the size of the decoding table (2^16 entries).
LONGEST = 16
#: Ids between two checkpoints: each such block can be decoded by itself.
BLOCK = 128


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Bits of each symbol's code word by package-merge: the least total among codes of at most `longest` bits.

    Symbols that don't occur have 0 bits; a single symbol has 1. Ties go to the smaller symbol.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} symbols need code words of more than {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.int64)
    n = len(order)
    # Level by level: packages of two from the level below are merged with the single symbols. Only the
    # flags "single or package" are kept; taking the first 2n - 2 at the top is then traced down.
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(longest):
        both = np.concatenate([weight, packages])
        at = np.argsort(both, kind="stable")
        levels.append(at < n)
        both = both[at]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(1)
    take, bits = 2 * n - 2, np.zeros(n, np.int64)
    for single in reversed(levels):
        s = int(single[:take].sum())
        bits[:s] += 1
        take = 2 * (take - s)
    lengths[order] = bits
    return lengths


def codes(lengths: np.ndarray) -> np.ndarray:
    """Canonical code words: by length, then by symbol."""
    out = np.zeros(len(lengths), np.uint32)
    code, before = 0, 0
    for bits in range(1, int(lengths.max(initial=0)) + 1):
        code <<= bits - before
        before = bits
        of = np.flatnonzero(lengths == bits)
        out[of] = code + np.arange(len(of))
        code += len(of)
    return out


def decoding_table(lengths: np.ndarray, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and length for every value of the next `longest` bits."""
    symbol, bits = np.zeros(1 << longest, np.int32), np.ones(1 << longest, np.uint8)
    of = np.flatnonzero(lengths)
    of = of[np.lexsort((of, lengths[of]))]
    spans = (1 << (longest - lengths[of].astype(np.int64))).astype(np.int64)
    symbol[: spans.sum()] = np.repeat(of, spans)
    bits[: spans.sum()] = np.repeat(lengths[of], spans)
    return symbol, bits


def pack(ids: np.ndarray, first: np.ndarray, code: np.ndarray, lengths: np.ndarray, block: int = BLOCK):
    """Bits of all texts, each from a whole byte on: (bytes, first byte of each, bits of each, bit offset of each block
    within its text, first block of each)."""
    size = lengths[ids].astype(np.int64)
    if (size == 0).any():
        raise ValueError("an id without a code word")
    total = np.concatenate([[0], np.cumsum(size)])
    n_bits = total[first[1:]] - total[first[:-1]]
    n_bytes = (n_bits + 7) // 8
    byte = np.concatenate([[0], np.cumsum(n_bytes)])
    n = np.diff(first)
    at = total[:-1] + np.repeat(byte[:-1] * 8 - total[first[:-1]], n)
    # A code word of at most 16 bits touches three bytes at most.
    word = code[ids].astype(np.uint32) << (24 - size - (at & 7)).astype(np.uint32)
    out = np.zeros(int(byte[-1]) + 3, np.int64)
    for k, shift in enumerate((16, 8, 0)):
        out[: len(out)] += np.bincount((at >> 3) + k, (word >> np.uint32(shift)) & np.uint32(255), minlength=len(out)).astype(np.int64)[: len(out)]
    blocks = (n + block - 1) // block
    block_first = np.concatenate([[0], np.cumsum(blocks)])
    heads = ranges(np.zeros(len(n), np.int64), blocks) * block + np.repeat(first[:-1], blocks)
    marks = total[heads] - np.repeat(total[first[:-1]], blocks)
    return out[:-3].astype(np.uint8), byte, n_bits, marks, block_first


def unpack(data: np.ndarray, byte: np.ndarray, n: np.ndarray, marks: np.ndarray, block_first: np.ndarray, symbol: np.ndarray, bits: np.ndarray, block: int = BLOCK, longest: int = LONGEST) -> np.ndarray:
    """The ids again: all blocks advance together, each from its own checkpoint."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    loads = np.ndarray((len(data) + 1,), ">u4", padded, strides=(1,))
    blocks = np.diff(block_first)
    place = ranges(np.zeros(len(n), np.int64), blocks)
    at = np.repeat(byte[:-1] * 8, blocks) + marks
    left = np.minimum(np.repeat(n, blocks) - place * block, block)
    to = np.repeat(np.cumsum(n) - n, blocks) + place * block
    out = np.zeros(int(n.sum()), np.int32)
    # Longest blocks first, so that those still running are always the first ones.
    order = np.argsort(-left, kind="stable")
    at, left, to = at[order], left[order], to[order]
    running = np.searchsorted(-left, -np.arange(block), "left")
    for k in range(block):
        m = int(running[k])
        if not m:
            break
        a = at[:m]
        window = (loads[a >> 3].astype(np.uint32) << (a & 7).astype(np.uint32)) >> np.uint32(32 - longest)
        out[to[:m] + k] = symbol[window]
        at[:m] = a + bits[window]
    return out


def _raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat bytes and offsets of a binary column."""
    return flat(pa.Array.from_buffers(pa.string() if not pa.types.is_large_binary(column.type) else pa.large_string(), len(column), column.buffers(), 0, column.offset))


def tokenise(docs: DataFrame, path: str = VOCABULARY, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key and raw (the ids as two bytes each): what is stored between counting and coding."""
    shipped, kind = ship(docs.sparkSession, path), dict(docs.dtypes)[key]
    if len(shipped.value) > 1 << 16:
        raise ValueError("more than 65,536 ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, shipped)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, first = e.encode(*flat(part.column("text")))
                raw = pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer((first * 2).astype(np.int32)), pa.py_buffer(ids.astype("<u2"))])
                yield pa.RecordBatch.from_arrays([part.column(0), raw], [key, "raw"])

    return docs.select(key, docs[text].alias("text")).mapInArrow(run, f"`{key}` {kind}, raw binary")


def count_ids(tokens: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in all rows. Each task adds up its own; one row a task and 4,096 ids is summed in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            data, _ = _raw(batch.column(0))
            total += np.bincount(data.view("<u2"), minlength=size)
        of = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(of.astype(np.int32)), pa.array(total[of])], ["id", "n"])

    counts = np.zeros(size, np.int64)
    for row in tokens.select("raw").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row.id] = row.n
    return counts


def encode_ids(docs: DataFrame, path: str = VOCABULARY, longest: int = LONGEST, block: int = BLOCK, key: str = "doc_id") -> tuple[DataFrame, np.ndarray]:
    """The coded documents, and the length of each id's code word (all that a reader needs for decoding).

    Rows: key, n_tokens, n_bits, payload (binary), checkpoints (array<long>: bit offset of each block of `block` ids),
    exact (whether decoding the payload gives the ids). The code is made from the counts of all documents. Texts are
    tokenised once; their ids, two bytes each, are stored in the shared folder. An empty or null text has no bits
    and no checkpoints; every row is coded for itself, so repeated rows and null keys change nothing else. A very long
    text is coded whole, in as many blocks as it needs; an empty table gives an empty result and code; further columns
    don't matter. `with_header` and `write` keep the lengths beside the rows.
    """
    spark, kind = docs.sparkSession, dict(docs.dtypes)[key]
    tokens = stored(tokenise(docs, path, key=key))
    size = 1 << 16
    lengths = code_lengths(count_ids(tokens, size), longest)
    shipped = spark.sparkContext.broadcast(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shipped.value
        code, (symbol, bits) = codes(of), decoding_table(of, longest)
        for batch in batches:
            _, offsets = _raw(batch.column(1))
            start = 0
            while start < batch.num_rows:
                stop = min(max(int(np.searchsorted(offsets, offsets[start] + 1_000_000, "right")) - 1, start + 1), batch.num_rows)
                part = batch.slice(start, stop - start)
                start = stop
                data, at = _raw(part.column(1))
                ids, first = data.view("<u2").astype(np.int64), at // 2
                packed, byte, n_bits, marks, block_first = pack(ids, first, code, of, block)
                n = np.diff(first)
                same = unpack(packed, byte, n, marks, block_first, symbol, bits, block, longest) == ids
                wrong = np.concatenate([[0], np.cumsum(~same)])
                payload = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(byte.astype(np.int32)), pa.py_buffer(packed)])
                checks = pa.ListArray.from_arrays(pa.array(block_first.astype(np.int32)), pa.array(marks, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(n_bits, pa.int64()), payload, checks, pa.array(wrong[first[1:]] == wrong[first[:-1]])],
                    [key, "n_tokens", "n_bits", "payload", "checkpoints", "exact"],
                )

    return tokens.mapInArrow(run, f"`{key}` {kind}, n_tokens long, n_bits long, payload binary, checkpoints array<long>, exact boolean"), lengths


def decode_ids(coded: DataFrame, lengths: np.ndarray, longest: int = LONGEST, block: int = BLOCK, key: str = "doc_id") -> DataFrame:
    """key and ids (array<int>) of coded documents."""
    shipped, kind = coded.sparkSession.sparkContext.broadcast(lengths), dict(coded.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol, bits = decoding_table(shipped.value, longest)
        for batch in batches:
            data, byte = _raw(batch.column("payload"))
            n = batch.column("n_tokens").to_numpy()
            checks = batch.column("checkpoints")
            block_first = np.concatenate([[0], np.cumsum(checks.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            ids = unpack(data, byte, n, checks.flatten().to_numpy(), block_first, symbol, bits, block, longest)
            first = np.concatenate([[0], np.cumsum(n)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))], [key, "ids"])

    return coded.select(key, "n_tokens", "payload", "checkpoints").mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def with_header(coded: DataFrame, lengths: np.ndarray, key: str = "doc_id") -> DataFrame:
    """The coded rows, and one row more, the header: a null key, n_tokens -1, and the code lengths, a byte an id, as payload.

    Such a table can be decoded by itself: `decode_table`. Rows with a null key are told from the header by n_tokens.
    """
    held = np.trim_zeros(lengths, "b").tobytes()
    row = coded.sparkSession.createDataFrame([(-1, 8 * len(held), bytearray(held), [], True)], "n_tokens long, n_bits long, payload binary, checkpoints array<long>, exact boolean")
    return coded.unionByName(row.withColumn(key, F.lit(None).cast(coded.schema[key].dataType)))


def decode_table(table_: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and ids of the rows of a table with its header; an error where it has none, or several."""
    heads = table_.where("n_tokens = -1").select("payload").take(2)
    if len(heads) != 1:
        raise ValueError(f"{len(heads)} headers")
    lengths = np.zeros(1 << 16, np.uint8)
    held = np.frombuffer(bytes(heads[0].payload), np.uint8)
    lengths[: len(held)] = held
    return decode_ids(table_.where("n_tokens >= 0"), lengths, key=key)


def write(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, key: str = "doc_id") -> None:
    """The documents' ids, coded, as a Parquet table with its header: what `decode_table(spark.read.parquet(path))` reads."""
    with_header(*encode_ids(docs, vocabulary, key=key), key=key).write.parquet(path)


def op7_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents coded, and the header that decodes them."""
    return with_header(*encode_ids(table(spark, sf_dir, "documents")))
