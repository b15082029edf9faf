"""Operator 4: packing by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._arrays import flat, slices, words
from ._tables import stored, table

#: Words that a window holds at most, and pieces that are packed together (a group, by hash).
CAPACITY, GROUP = 2048, 1024


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Window of each item: near-equal sums over `windows` windows.

    Every item begins as a partition of its own. The two partitions of the widest spread merge, largest sum with smallest,
    until one is left. Equal spreads merge in the order in which they arose.
    """
    n = len(sizes)
    if windows <= 1 or n <= 1:
        return np.zeros(n, np.int64)
    order = np.argsort(-sizes, kind="stable")
    # A partition: sums in descending order (only the positive ones) and the node of each; a node is an item or two nodes.
    left, right = np.full(2 * n * 1, -1, np.int64), np.full(2 * n * 1, -1, np.int64)
    made = n
    heap = []
    for k, i in enumerate(order.tolist()):
        s = int(sizes[i])
        heap.append((-s, k, np.array([s]), np.array([i])))
    heapq.heapify(heap)
    count = n
    while len(heap) > 1:
        _, _, a, na = heapq.heappop(heap)
        _, _, b, nb = heapq.heappop(heap)
        over = len(a) + len(b) - windows
        if over <= 0:  # no two sums need to meet
            sums, nodes = np.concatenate([a, b]), np.concatenate([na, nb])
        else:
            sums = np.concatenate([a[: len(a) - over], a[len(a) - over :] + b[len(b) - over :][::-1], b[: len(b) - over]])
            fresh = np.arange(made, made + over)
            if made + over > len(left):
                left, right = (np.concatenate([x, np.full(len(x) + over, -1, np.int64)]) for x in (left, right))
            left[fresh], right[fresh] = na[len(a) - over :], nb[len(b) - over :][::-1]
            made += over
            nodes = np.concatenate([na[: len(a) - over], fresh, nb[: len(b) - over]])
        at = np.argsort(-sums, kind="stable")
        sums, nodes = sums[at], nodes[at]
        spread = int(sums[0] - (sums[-1] if len(sums) == windows else 0))
        heapq.heappush(heap, (-spread, count, sums, nodes))
        count += 1
    window = np.full(made, -1, np.int64)
    window[heap[0][3]] = np.arange(len(heap[0][3]))
    for node in range(made - 1, n - 1, -1):
        window[left[node]] = window[right[node]] = window[node]
    return window[:n]


def pack_group(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item, none above capacity: the window count starts at the least possible and rises until all fit."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    windows = max(-(-int(sizes.sum()) // capacity), int((sizes > capacity // 2).sum()), 1)
    while True:
        window = differencing(sizes, windows)
        if np.bincount(window, sizes).max() <= capacity:
            return window
        windows += max(1, windows // 100)


def pieces(docs: DataFrame, capacity: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start_word, n_words, ticket): whole texts, cut into equal pieces where they exceed the capacity.

    ticket: a number of its own for each piece (task and place in it), whatever ids and texts are.
    """
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ticket = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text"):
                first = words(*flat(part.column("text")))[2]
                n = np.diff(first)
                count = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * n[row] // np.maximum(count[row], 1)
                stop = (piece + 1) * n[row] // np.maximum(count[row], 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(stop - start), pa.array(ticket + np.arange(len(row)))],
                    ["doc_id", "piece", "start_word", "n_words", "ticket"],
                )
                ticket += len(row)

    return docs.select(docs[key].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, f"doc_id {kind}, piece int, start_word long, n_words long, ticket long")


def pack(docs: DataFrame, capacity: int = CAPACITY, group: int = GROUP, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(window_id, doc_id, piece, start_word, n_words, offset): which words of which document lie where in which window.

    Every word of every text is in one window; no window exceeds the capacity, and those of a group are near-equal. Pieces
    are stored with a ticket each and dealt by its hash into groups of about `group`, so that each group is bounded however
    many rows share an id, a text or neither; windows are not shared between groups. A very long text is cut into many
    pieces, which go to different groups. Texts without words, and null ones, are in no window; a null id is packed like any
    other, and repeated rows, also with different texts, are packed as often as they come. An empty table gives an empty
    result; further columns don't matter.
    """
    cut = stored(pieces(docs, capacity, text, key))
    groups = max(1, -(-cut.count() // group))
    kind = dict(cut.dtypes)["doc_id"]

    def run(key_: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("ticket", kind="stable").reset_index(drop=True)
        size = g["n_words"].to_numpy()
        g["window_id"] = (int(key_[0]) << 32) + pack_group(size, capacity)
        g = g.sort_values("window_id", kind="stable")
        g["offset"] = g.groupby("window_id")["n_words"].cumsum() - g["n_words"]
        return g[["window_id", "doc_id", "piece", "start_word", "n_words", "offset"]]

    dealt = cut.withColumn("deal", F.pmod(F.xxhash64("ticket"), F.lit(groups)))
    return dealt.groupBy("deal").applyInPandas(run, f"window_id long, doc_id {kind}, piece int, start_word long, n_words long, offset long")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`pack` over the documents table."""
    return pack(table(spark, sf_dir, "documents"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the windows of all documents, (window_id, doc_id, piece, start_word, n_words, offset).

    Null and empty texts are in no window; null ids, repeated rows, clashing columns and empty tables as in `pack`."""
    return pack(docs)
