"""Approximate nearest neighbours by additive quantisation.

CODEBOOKS codebooks of CODEWORDS full-dimensional codewords each are fitted by k-means on
the residuals of a bounded sample (TRAIN rows). Every vector is encoded by beam search: the
sum of one codeword of each book that is near it, found with BEAM partial sums kept. The
index is a row of codes and the stored squared norm of the sum for each vector. A query
scores codes by lookup tables of its inner products with all codewords,
|x|^2 - 2 <q, x>, and the best RERANK per query get exact distances on the original
vectors, of which the best k stay.

The first codes (one; two from CELL_ROWS rows a codeword on) name a vector's cell. A query
scores the cells whose partial sums are nearest to it, as many as hold TARGET of the true
neighbours of queries of the sample; there neighbours are farther away than among all rows,
so all rows need no more. probes="all" scores every cell, and rerank=None then gives exact
distances to all rows: the exact way. How much is saved is up to the data: clustered
vectors need a few cells, vectors without structure half of all or more.

Queries go in blocks and rows in slabs, both of bounded size and dealt by hash whatever their
cells, so no side is broadcast and a large cell or a frequent vector is spread over tasks. A
query gives its best RERANK of a slab, over all cells that it probes there.
All rows are indexed.

Defined cases: vectors that are null, zero, hold null or non-finite components, or have
another length than most take no part, and neither do rows without vec_id; the query's own
rows (equal vec_id) are no candidates; ties go to the smaller vec_id, in codes too, where
equal vectors have equal scores; rows that repeat are candidates each; with fewer candidates
than k all that are found are given; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from korvane.llm.common import trimming
from korvane.session import cut, pick

CODEBOOKS, CODEWORDS, BEAM = 32, 256, 4
#: Rows of the training sample, about; rounds of k-means.
TRAIN, ROUNDS = 8_000, 4
#: Candidates that get exact distances; neighbours given.
RERANK, K = 200, 10
#: Share of the sample's true neighbours that the probed cells must hold; queries of the sample to find that by; rows of a cell, on average, from which cells are of two codes.
TARGET, TRIALS, CELL_ROWS = 0.95, 400, 1 << 16
#: Queries in a block, at most and, as long as tasks are fewer than cores, at least; rows in a slab.
QUERY_BLOCK, LEAST_BLOCK, PART = 2048, 64, 1 << 17


def usable(v: Column) -> Column:
    """Whether a vector takes part, its length aside."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def fit(x: np.ndarray, books: int = CODEBOOKS, words: int = CODEWORDS, rounds: int = ROUNDS, seed: int = 3) -> np.ndarray:
    """Codebooks (books, words, dimensions) by k-means on what the books before leave over."""
    rng = np.random.default_rng(seed)
    rest, out = x.astype(np.float32).copy(), []
    for _ in range(books):
        c = rest[rng.choice(len(rest), words, replace=len(rest) < words)]
        for _ in range(rounds):
            near = (c @ rest.T * 2 - (c * c).sum(1)[:, None]).argmax(0)
            n = np.bincount(near, minlength=words)
            sums = np.zeros_like(c)
            order = np.argsort(near, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(near[order]) > 0])
            sums[near[order][first]] = np.add.reduceat(rest[order], first, axis=0)
            c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
        near = (c @ rest.T * 2 - (c * c).sum(1)[:, None]).argmax(0)
        rest -= c[near]
        out.append(c)
    return np.stack(out)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(codes, squared norms of the sums) of vectors, by beam search."""
    n, d = x.shape
    rest = x.astype(np.float32)[:, None, :]
    codes = np.zeros((n, 1, 0), np.uint8)
    for c in books:
        words = len(c)
        # |rest - c|^2 without |c|-free terms that all share; each kept sum brings its own |rest|^2.
        far = (rest * rest).sum(2)[:, :, None] - 2 * (rest @ c.T) + (c * c).sum(1)
        far = far.reshape(n, -1)
        keep = min(beam, far.shape[1])
        best = np.argpartition(far, keep - 1, axis=1)[:, :keep] if keep < far.shape[1] else np.tile(np.arange(keep), (n, 1))
        from_, word = best // words, best % words
        row = np.arange(n)[:, None]
        rest = rest[row, from_] - c[word]
        codes = np.concatenate([codes[row, from_], word[:, :, None].astype(np.uint8)], axis=2)
    last = (rest * rest).sum(2).argmin(1)
    codes = codes[np.arange(n), last]
    sums = sum(books[m][codes[:, m]].astype(np.float64) for m in range(len(books)))
    return codes, (sums * sums).sum(1).astype(np.float32) if n else np.empty(0, np.float32)


def scores(tables: np.ndarray, codes: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """|x|^2 - 2 <q, x> of one query's tables (books, words) against codes (books, rows)."""
    out = norms.copy()
    for table, column in zip(-2 * tables, codes, strict=True):
        out += table[column]
    return out


def cell_of(codes: np.ndarray, levels: int) -> np.ndarray:
    """The cell that the first codes name."""
    out = np.zeros(len(codes), np.int32)
    for m in range(levels):
        out = out * CODEWORDS + codes[:, m]
    return out


def centres(books: np.ndarray, levels: int) -> np.ndarray:
    """The partial sums of all cells, in order."""
    out = books[0]
    for m in range(1, levels):
        out = (out[:, None] + books[m][None]).reshape(-1, books.shape[2])
    return out


def far_from(q: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return (centre * centre).sum(1) - 2 * (q @ centre.T)


def probes_needed(sample: np.ndarray, books: np.ndarray, levels: int, k: int, target: float = TARGET, seed: int = 5) -> int:
    """The least number of nearest cells that hold a share `target` of the k nearest neighbours, within the sample, of some of its vectors."""
    at = np.random.default_rng(seed).permutation(len(sample))[:TRIALS]
    q, centre = sample[at], centres(books, levels)
    near = far_from(q, sample)
    near[np.arange(len(at)), at] = np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return len(centre)
    cells = cell_of(encode(sample, books[: levels + 3])[0], levels)
    own = cells[np.argpartition(near, k - 1, axis=1)[:, :k]]
    far = far_from(q, centre)
    rank = (far[:, None, :] < np.take_along_axis(far, own, 1)[:, :, None]).sum(2) if len(centre) <= CODEWORDS else far.argsort(1).argsort(1)[np.arange(len(at))[:, None], own]
    return int(np.sort(rank, axis=None)[min(rank.size - 1, int(np.ceil(target * rank.size)) - 1)]) + 1


def index(vectors: DataFrame, books: np.ndarray, levels: int = 1) -> DataFrame:
    """vec_id, cell, codes, norm of every row of vectors (vec_id, v)."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                x = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)
                codes, norms = encode(x, shared.value)
                yield pa.record_batch([part.column(0), pa.array(cell_of(codes, levels)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norms)], names=["vec_id", "cell", "codes", "norm"])

    return vectors.select("vec_id", "v").mapInArrow(trimming(each), "vec_id long, cell int, codes binary, norm float")


def _probed(queries: DataFrame, books, levels: int, probes: int) -> DataFrame:
    """vec_id, v, cells of queries (vec_id, v): their nearest cells."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = centres(books.value, levels)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                far = far_from(part.column(1).flatten().to_numpy().reshape(part.num_rows, -1).astype(np.float32), centre)
                chosen = far <= np.partition(far, probes - 1, axis=1)[:, [probes - 1]]  # cells as near as the last of them too
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(chosen.sum(1))), pa.int32()), pa.array(np.nonzero(chosen)[1].astype(np.int32)))
                yield pa.record_batch([part.column(0), part.column(1), lists], names=["vec_id", "v", "cells"])

    return queries.select("vec_id", "v").mapInArrow(trimming(each), "vec_id long, v array<double>, cells array<int>")


def search(vectors: DataFrame, is_query: Column, k: int = K, rerank: int | None = RERANK, train: int = TRAIN, probes: int | str | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row of vectors (vec_id, embedding) that is a query.

    probes: cells that a query scores (None: as many as the sample needs; "all": every one). rerank: candidates that
    get exact distances (None: all that were scored).
    """
    spark = vectors.sparkSession
    own = pick(vectors, "vec_id", "embedding").withColumn("v", F.col("embedding").cast("array<double>")).where(usable(F.col("v")) & F.col("vec_id").isNotNull()).select("vec_id", "v")
    sizes = own.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n = sizes[0]
    own = own.where(F.size("v") == d)
    draw = F.pmod(F.xxhash64("vec_id", F.lit(17)), F.lit(1_000_000)) / 1e6
    got = own.where(draw < min(1.0, train / n)) if n > train else own
    sample = got.select("v").toArrow().column("v").combine_chunks().flatten().to_numpy().reshape(-1, d).astype(np.float32)  # about `train` rows
    books = fit(sample) if len(sample) else np.zeros((CODEBOOKS, CODEWORDS, d), np.float32)
    levels = 1 if n <= CELL_ROWS * CODEWORDS else 2
    cells = CODEWORDS**levels
    if probes is None:
        probes = probes_needed(sample, books, levels, k)
    probes = cells if probes == "all" else min(probes, cells)

    shared = spark.sparkContext.broadcast(books)
    codes = cut(index(own, books, levels), "codes")
    asked = _probed(own.where(is_query), shared, levels, probes)
    slabs, asking = -(-n // PART), own.where(is_query).count()
    blocks = max(1, -(-asking // QUERY_BLOCK), min(-(-asking // LEAST_BLOCK), -(-2 * spark.sparkContext.defaultParallelism // slabs)))
    bucket = lambda m, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = asked.select("vec_id", "v", "cells", bucket(blocks, 1).alias("block"), every(slabs).alias("slab"))
    right = codes.select("vec_id", "cell", "codes", "norm", bucket(slabs, 2).alias("slab"), every(blocks).alias("block"))

    def best(qs: pa.Table, xs: pa.Table) -> pa.Table:
        xs = xs.sort_by("vec_id")  # equal scores then stay in the order of ids
        n, out = xs.num_rows, []
        if n:
            ids, norms, cell = xs.column("vec_id").to_numpy(), xs.column("norm").to_numpy(), xs.column("cell").to_numpy()
            code = np.ascontiguousarray(np.frombuffer(b"".join(xs.column("codes").to_pylist()), np.uint8).reshape(n, -1).T)
        for qid, v, cells in zip(qs.column("vec_id").to_pylist(), qs.column("v").to_pylist(), qs.column("cells").to_pylist(), strict=True) if n else ():
            probed = np.zeros(CODEWORDS**levels, bool)
            probed[cells] = True
            rows = np.flatnonzero(probed[cell] & (ids != qid))
            if not len(rows):
                continue
            s = scores(shared.value @ np.asarray(v, np.float32), code[:, rows], norms[rows])
            m = min(rerank or len(s), len(s))
            edge = np.partition(s, m - 1)[m - 1]
            under = np.flatnonzero(s < edge)
            at = np.concatenate([under, np.flatnonzero(s == edge)[: m - len(under)]])
            at = at[np.isfinite(s[at])]
            out.append((np.full(len(at), qid, np.int64), ids[rows[at]], s[at]))
        flat = [np.concatenate([np.empty(0, kind), *(x[i] for x in out)]).astype(kind) for i, kind in enumerate((np.int64, np.int64, np.float32))]
        return pa.table(dict(zip(("query_id", "c_id", "near"), flat, strict=True)))

    by = ("slab", "block")
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(best, "query_id long, c_id long, near float")
    if rerank:
        near = Window.partitionBy("query_id").orderBy("near", "c_id")
        found = found.withColumn("nth", F.row_number().over(near)).where(F.col("nth") <= rerank)
    found = cut(found.groupBy("query_id", "c_id").agg(F.count("*").alias("copies")), "candidates")
    q = own.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).toDF("q_id", "q")
    x = own.toDF("x_id", "x")
    exact = F.sqrt(F.aggregate(F.zip_with("q", "x", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, t: s + t))
    got = found.join(q, F.col("query_id") == F.col("q_id")).join(x, F.col("c_id") == F.col("x_id")).select("query_id", F.col("c_id").alias("vec_id"), exact.alias("score"))
    ranked = got.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_report(embeddings: DataFrame) -> DataFrame:
    return search(embeddings, F.col("vec_id") % 100 == 0)
