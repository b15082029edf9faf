"""Operator 1: nearest neighbours by additive quantisation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._tables import stored, table

#: Codebooks, code words of each (all of full dimension), and sequences that encoding keeps at each step.
BOOKS, WORDS, BEAM = 16, 64, 4
#: Neighbours that are returned, and candidates of each block and query whose exact distances bound the rest.
NEIGHBOURS, RERANK = 10, 400
#: Queries: every vector whose id this divides. Vectors of a block, vectors that the first codebooks are made from (all
#: vectors then refine them), and cells at most; a cell that outgrows a block is dealt to several.
EVERY, BLOCK, SAMPLE, CELLS = 20, 8192, 20_000, 4096
#: Rounds in which all vectors move the cells' centres.
CELL_ROUNDS = 4


@dataclass
class Quantiser:
    """books: BOOKS x WORDS x dimension; cells: centres of the coarse cells that block the vectors."""

    books: np.ndarray
    cells: np.ndarray


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Centres by Lloyd's steps; an empty cluster takes a vector at random."""
    c = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = np.argmin((c**2).sum(1) - 2 * x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        count = np.bincount(near, minlength=k)
        c = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], x[rng.choice(len(x), k)])
    return c.astype(np.float32)


def encode(books: np.ndarray, x: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Codes (vectors x books) by beam search: the sum of code words that comes nearest, a book at a time, of the `beam`
    best sums so far."""
    n, (m, k, d) = len(x), books.shape
    codes = np.zeros((n, 1, 0), np.int64)
    rest = x[:, None, :]
    norms = (books**2).sum(2)
    for b in range(m):
        width = rest.shape[1]
        error = (rest**2).sum(2)[:, :, None] - 2 * rest @ books[b].T + norms[b]
        keep = min(beam if b + 1 < m else 1, width * k)
        flat = error.reshape(n, -1)
        best = np.argpartition(flat, keep - 1, axis=1)[:, :keep]
        parent, word = best // k, best % k
        rows = np.arange(n)[:, None]
        codes = np.concatenate([codes[rows, parent], word[:, :, None]], axis=2)
        rest = rest[rows, parent] - books[b][word]
    return codes[:, 0].astype(np.uint8)


def decoded(books: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return sum(books[b][codes[:, b]] for b in range(len(books)))


def first_books(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Codebooks one after the other, each from what the ones before it leave."""
    rest, books = x.copy(), []
    for _ in range(BOOKS):
        c = kmeans(rest, WORDS, rng)
        rest -= c[np.argmin((c**2).sum(1) - 2 * rest @ c.T, axis=1)]
        books.append(c)
    return np.stack(books)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(column), -1)


def refined(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """All code words at once, best in the least-squares sense for the codes of all vectors.

    Each task sums up which code words occur together and with which vectors; the sums are added in Spark row by row, so
    what comes to the driver is bound by the codebooks.
    """
    m, k, d = books.shape
    shipped = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m * k, m * k + d))
        for batch in batches:
            for s in range(0, batch.num_rows, 2000):
                x = _matrix(batch.column("embedding").slice(s, 2000))
                one = np.zeros((len(x), m * k), np.float32)
                at = encode(shipped.value, x).astype(np.int64) + np.arange(m) * k
                one[np.arange(len(x))[:, None], at] = 1
                total += one.T @ np.concatenate([one, x], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(m * k)), pa.array([r.tobytes() for r in total], pa.binary())], ["word", "sums"])

    def add(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"word": [key[0]], "sums": [np.sum([np.frombuffer(x) for x in g["sums"]], axis=0).tobytes()]})

    rows = vectors.select("embedding").mapInArrow(run, "word long, sums binary").groupBy("word").applyInPandas(add, "word long, sums binary").collect()
    if not rows:
        return books
    total = np.zeros((m * k, m * k + d))
    for r in rows:
        total[r.word] = np.frombuffer(r.sums)
    gram, cross = total[:, : m * k], total[:, m * k :]
    # A little of the old words keeps unused ones where they were.
    return np.linalg.solve(gram + np.eye(m * k), cross + books.reshape(m * k, d)).reshape(m, k, d).astype(np.float32)


def placed_cells(vectors: DataFrame, n: int, rounds: int = CELL_ROUNDS) -> np.ndarray:
    """Centres of min(n / BLOCK, CELLS) cells by Lloyd's steps over all vectors, from that many of them chosen by a hash of
    the id. Each task adds up its vectors by cell; CELLS rows a task at most are summed in Spark, CELLS come to the driver."""
    k = min(max(1, -(-n // BLOCK)), CELLS)
    start = vectors.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(k).collect()
    cells = np.stack([np.array(r.embedding, np.float32) for r in start])
    spark = vectors.sparkSession
    for _ in range(rounds if k > 1 else 0):
        shipped = spark.sparkContext.broadcast(cells)

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            own = shipped.value
            sums, count = np.zeros(own.shape), np.zeros(len(own), np.int64)
            for batch in batches:
                for s in range(0, batch.num_rows, 2000):
                    x = _matrix(batch.column(0).slice(s, 2000))
                    near = np.argmin((own**2).sum(1) - 2 * x @ own.T, axis=1)
                    np.add.at(sums, near, x)
                    count += np.bincount(near, minlength=len(own))
            of = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(count[of]), pa.array([sums[i].tobytes() for i in of], pa.binary())], ["cell", "n", "sums"])

        def add(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"cell": [key[0]], "n": [g["n"].sum()], "sums": [np.sum([np.frombuffer(x) for x in g["sums"]], axis=0).tobytes()]})

        moved = cells.copy()
        for r in vectors.select("embedding").mapInArrow(run, "cell long, n long, sums binary").groupBy("cell").applyInPandas(add, "cell long, n long, sums binary").collect():
            moved[r.cell] = np.frombuffer(r.sums) / r.n
        cells = moved
    return cells


def train(vectors: DataFrame, n: int) -> Quantiser:
    """The first codebooks from a sample of SAMPLE vectors at most, chosen by a hash of the id (the documented bound); all
    vectors then refine the codebooks and place the cells, whose number doesn't depend on the sample."""
    some = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    x = np.stack(some["embedding"].to_numpy()).astype(np.float32)
    books = refined(vectors, first_books(x, np.random.default_rng(1)))
    return Quantiser(books, placed_cells(vectors, n))


def coded(vectors: DataFrame, q: Quantiser) -> DataFrame:
    """(vec_id, embedding, codes, norm, error, cell, gap): codes, squared norm of their sum and distance from it, nearest
    cell and distance from it."""
    shipped = vectors.sparkSession.sparkContext.broadcast(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, cells = shipped.value.books, shipped.value.cells
        for batch in batches:
            for s in range(0, batch.num_rows, 2000):
                part = batch.slice(s, 2000)
                x = _matrix(part.column("embedding"))
                codes = encode(books, x)
                near = decoded(books, codes)
                norm = (near**2).sum(1)
                error = np.sqrt(((x - near) ** 2).sum(1))
                far = (cells**2).sum(1) - 2 * x @ cells.T
                cell = far.argmin(1)
                gap = np.sqrt(((x - cells[cell]) ** 2).sum(1))
                at = np.arange(len(x) + 1, dtype=np.int32) * codes.shape[1]
                packed = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(codes))])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), packed, pa.array(norm.astype(np.float32)), pa.array(error.astype(np.float32)), pa.array(cell.astype(np.int32)), pa.array(gap.astype(np.float64))], ["vec_id", "embedding", "codes", "norm", "error", "cell", "gap"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, "vec_id long, embedding array<float>, codes binary, norm float, error float, cell int, gap double")


def nearest(books: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, codes: np.ndarray, norm: np.ndarray, error: np.ndarray, k: int, rerank: int):
    """(query index, id, squared distance) of the k nearest of x to each query, itself left out.

    Approximate distances are sums of table entries: for each codebook, the products of its words with the queries. The
    `rerank` best by these are measured exactly, and the k-th of them bounds the rest: whatever may lie as near, given its
    quantisation error (distance from the sum of its code words), is measured too, so none of the k nearest is lost. Of
    equal vectors the k + 1 of least ids are enough.
    """
    order = np.argsort(ids, kind="stable")
    _, same = np.unique(np.ascontiguousarray(x[order]).view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel(), return_inverse=True)
    grouped = np.argsort(same, kind="stable")
    place = np.empty(len(x), np.int64)
    place[grouped] = np.arange(len(x)) - np.searchsorted(same[grouped], same[grouped])
    x, ids, codes, norm, error = (v[order[place <= k]] for v in (x, ids, codes, norm, error))
    wide = x.astype(np.float64)
    squares = (wide**2).sum(1)
    # More than table sums in single precision can be off, for a query of length 0, and a squared length more.
    reach = float(np.sqrt((books.astype(np.float64) ** 2).sum(2)).max(1).sum()) ** 2
    out_q, out_i, out_d = [], [], []
    for s in range(0, len(queries), 256):
        q, own = queries[s : s + 256], query_ids[s : s + 256]
        approx = np.repeat(norm[:, None], len(q), axis=1)
        for b in range(len(books)):
            approx -= (2 * books[b] @ q.T)[codes[:, b]]
        approx = approx.T
        r = min(rerank + 1, len(x))
        some = np.argpartition(approx, r - 1, axis=1)[:, :r] if r < len(x) else np.tile(np.arange(len(x)), (len(q), 1))
        first = ((x[some] - q[:, None, :]) ** 2).sum(2).astype(np.float64)
        first[ids[some] == own[:, None]] = np.inf
        bound = np.partition(first, k - 1, axis=1)[:, k - 1] * (1 + 1e-5) if r >= k else np.full(len(q), np.inf)
        far = q.astype(np.float64)
        length = (far**2).sum(1)
        least = np.sqrt(np.maximum(approx + (length - 1e-5 * (length + reach))[:, None], 0)) - error * (1 + 1e-5)
        may = (least <= np.sqrt(bound)[:, None]) & (ids != own[:, None])
        at = np.flatnonzero(may.any(0))
        # In double precision all at once, then those that can count by their differences.
        close = length[:, None] + squares[at] - 2 * far @ wide[at].T
        slack = 1e-12 * (length[:, None] + squares[at])
        row, col = np.nonzero(may[:, at] & (close <= bound[:, None] + slack))
        col = at[col]
        d = np.concatenate([((wide[col[e : e + 100_000]] - far[row[e : e + 100_000]]) ** 2).sum(1) for e in range(0, max(len(row), 1), 100_000)])
        best = np.lexsort((ids[col], d, row))
        row, col, d = row[best], col[best], d[best]
        fine = np.arange(len(row)) - np.searchsorted(row, row) < k
        out_q.append(row[fine] + s)
        out_i.append(ids[col[fine]])
        out_d.append(d[fine])
    return np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_d)


def neighbours(vectors: DataFrame, k: int = NEIGHBOURS, rerank: int = RERANK, every: int = 1) -> DataFrame:
    """(vec_id, rank, neighbour_id, distance): the k nearest other vectors, by Euclidean distance, of every vector whose id
    `every` divides.

    Each query first searches its own cell; the distance of its k-th neighbour there bounds what other cells can add.
    It then goes to each cell whose ball (centre and radius over all its vectors) comes nearer than that, so no cell is left out
    that could hold a neighbour: on clustered vectors few are visited, on vectors without structure nearly all. Cells meet
    queries in blocks of about BLOCK each, and a block of vectors is sent as often as blocks of queries want it. Equal
    distances rank by id. Rows with a null id, a null or empty vector, a null or non-finite component, or a dimension other
    than the commonest are left out; rows that repeat an id count as one, the one of the least vector. With k or fewer
    vectors every other one is returned; an empty table gives an empty result; further columns don't matter.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, rank int, neighbour_id long, distance double"
    fine = vectors.where("vec_id IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < float('inf'))")
    fine = fine.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>"))
    common = fine.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return spark.createDataFrame([], schema)
    fine = stored(fine.where(F.size("embedding") == common.d).groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    n = fine.count()
    quantiser = train(fine, n)
    points = stored(coded(fine, quantiser))
    asked = points.where(F.col("vec_id") % every == 0).select("vec_id", "embedding", "cell")
    shipped = spark.sparkContext.broadcast(quantiser)

    def search(key: tuple, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"vec_id": [], "neighbour_id": [], "d2": []}).astype({"vec_id": "int64", "neighbour_id": "int64"})
        ids = c["c_vec_id"].to_numpy()
        codes = np.frombuffer(b"".join(c["c_codes"]), np.uint8).reshape(len(c), -1)
        at, i, d = nearest(shipped.value.books, np.stack(q["embedding"]).astype(np.float32), q["vec_id"].to_numpy(), np.stack(c["c_embedding"]).astype(np.float32), ids, codes, c["c_norm"].to_numpy(), c["c_error"].to_numpy(), k, rerank)
        return pd.DataFrame({"vec_id": q["vec_id"].to_numpy()[at], "neighbour_id": i, "d2": d})

    # One row a cell, CELLS at most.
    pieces = stored(points.groupBy("cell").agg(F.max("gap").alias("radius"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("pieces")))
    dealt = points.join(F.broadcast(pieces.drop("radius")), "cell").withColumn("piece", F.pmod(F.xxhash64("vec_id", F.lit(7)), "pieces").cast("int"))

    def visit(queries: DataFrame) -> DataFrame:
        """queries: vec_id, embedding, cell to visit."""
        wanted = queries.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("shares")).join(F.broadcast(pieces.drop("radius")), "cell")
        wanted = F.broadcast(stored(wanted))  # one row a cell
        q = queries.join(wanted, "cell").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).withColumn("share", F.pmod(F.xxhash64("vec_id"), "shares").cast("int")).drop("pieces", "shares")
        c = dealt.drop("pieces").join(wanted.select("cell", "shares"), "cell").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        c = c.select(*(F.col(x).alias(f"c_{x}") for x in ("vec_id", "embedding", "codes", "norm", "error", "cell", "piece", "share")))
        return q.groupBy("cell", "piece", "share").cogroup(c.groupBy("c_cell", "c_piece", "c_share")).applyInPandas(search, "vec_id long, neighbour_id long, d2 double")

    own = stored(visit(asked))
    best = Window.partitionBy("vec_id").orderBy("d2", "neighbour_id")
    bound = own.withColumn("n", F.row_number().over(best)).where(F.col("n") == k).select("vec_id", F.sqrt("d2").alias("bound"))
    radius = {r.cell: r.radius for r in pieces.collect()}  # CELLS at most
    reaches = np.array([radius.get(i, -np.inf) for i in range(len(quantiser.cells))])

    def targets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shipped.value.cells.astype(np.float64)
        for batch in batches:
            for s in range(0, batch.num_rows, 1000):
                p = batch.slice(s, 1000)
                x = _matrix(p.column("embedding")).astype(np.float64)
                gap = np.sqrt(np.maximum((cells**2).sum(1) - 2 * x @ cells.T + (x**2).sum(1)[:, None], 0)) - reaches
                gap[np.arange(len(x)), p.column("cell").to_numpy()] = np.inf
                row, cell = np.nonzero(gap <= p.column("bound").to_numpy()[:, None] + 1e-4)
                yield pa.RecordBatch.from_arrays([p.column("vec_id").take(pa.array(row)), p.column("embedding").take(pa.array(row)), pa.array(cell.astype(np.int32))], ["vec_id", "embedding", "cell"])

    bounded = asked.join(bound, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(1e300)))
    others = visit(bounded.mapInArrow(targets, "vec_id long, embedding array<float>, cell int"))
    ranked = own.unionByName(others).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("vec_id", F.col("rank").cast("int").alias("rank"), "neighbour_id", F.sqrt("d2").alias("distance"))


def op1_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of all vectors to every vector whose id is divisible by EVERY."""
    return neighbours(table(spark, sf_dir, "embeddings"), every=EVERY)
