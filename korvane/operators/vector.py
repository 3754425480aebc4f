"""Retrieval by dense vectors: exact inner products in blocks, and an inverted file over k-means cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from korvane.operators.lexical import top_k

#: Queries and pool rows that one task multiplies at once.
BLOCK = 4096


def encode_texts(df: DataFrame, column: str, load: Callable[[], Callable[[list[str]], np.ndarray]]) -> DataFrame:
    """df with embedding, unit vectors of a text column. load() makes the encoder, once in each worker."""

    @F.pandas_udf("array<float>")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load()
        for texts in batches:
            v = np.asarray(encoder(texts.fillna("").tolist()), np.float32)
            v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            yield pd.Series(list(v))

    return df.withColumn("embedding", each(F.col(column)))


def _blocks(n: int) -> int:
    return max(1, -(-n // BLOCK))


def _scored(q: DataFrame, p: DataFrame, on: list[str], k: int) -> DataFrame:
    """The k best pool rows of every query within each group of on."""

    def best(qs: pd.DataFrame, ps: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(ps):
            return pd.DataFrame({"qid": [], "cand_id": [], "score": []})
        ps = ps.sort_values("p_id", kind="stable")
        s = np.stack(qs["embedding"]).astype(float) @ np.stack(ps["p_vector"]).astype(float).T
        m = min(k, s.shape[1])
        at = np.argsort(-np.round(s, 9), axis=1, kind="stable")[:, :m]
        return pd.DataFrame({"qid": np.repeat(qs["entity_id"].to_numpy(), m), "cand_id": ps["p_id"].to_numpy()[at].ravel(), "score": np.take_along_axis(s, at, 1).ravel()})

    kind = q.schema["entity_id"].dataType.simpleString()
    p = p.select(F.col("entity_id").alias("p_id"), F.col("embedding").alias("p_vector"), *[F.col(c).alias(f"p_{c}") for c in on])
    return q.select("entity_id", "embedding", *on).groupBy(*on).cogroup(p.groupBy(*[f"p_{c}" for c in on])).applyInPandas(best, f"qid {kind}, cand_id {kind}, score double")


def exact_topk(pool: DataFrame, queries: DataFrame, k: int = 100, skip_self: bool = False) -> DataFrame:
    """qid, cand_id, score, rank by inner product of (entity_id, embedding) rows: blocks of queries meet blocks of the pool, neither side is broadcast."""
    nq, np_ = _blocks(queries.count()), _blocks(pool.count())
    bucket = lambda m: F.pmod(F.xxhash64("entity_id"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    q = queries.select("entity_id", "embedding", bucket(nq).alias("qb"), every(np_).alias("pb"))
    p = pool.select("entity_id", "embedding", bucket(np_).alias("pb"), every(nq).alias("qb"))
    found = _scored(q, p, ["qb", "pb"], k + skip_self)
    return top_k(found.where("qid <> cand_id") if skip_self else found, k)


def fit_cells(pool: DataFrame, cells: int | None = None, sample: int = 100_000, seed: int = 42) -> DataFrame:
    """cell, centre: k-means on a bounded sample; as many cells as the root of the pool, 4096 at most."""
    n = pool.count()
    cells = cells or max(1, min(int(n**0.5), 4096))
    some = pool.where(F.pmod(F.xxhash64("entity_id", F.lit(seed)), F.lit(1_000_000)) < int(1e6 * min(1.0, sample / max(n, 1))) + 1)
    model = KMeans(k=cells, seed=seed, maxIter=10).fit(some.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features")))
    return pool.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cell int, centre array<double>")


def assign_cells(vectors: DataFrame, cells: DataFrame, probes: int = 1) -> DataFrame:
    """vectors with cell, once for each of the `probes` nearest centres. The centres are at most 4096 rows and are broadcast."""
    centres = [(r.cell, r.centre) for r in cells.orderBy("cell").collect()]
    ids, c = np.array([i for i, _ in centres]), np.array([x for _, x in centres])

    @F.pandas_udf("array<int>")
    def near(v: pd.Series) -> pd.Series:
        x = np.stack(v).astype(float)
        d = (c * c).sum(1)[None] - 2 * x @ c.T
        return pd.Series(list(ids[np.argsort(d, axis=1, kind="stable")[:, :probes]].astype(np.int32)))

    return vectors.withColumn("cell", F.explode(near("embedding")))


def search_index(vectors: DataFrame, centres: DataFrame, queries: DataFrame, k: int = 100, probes: int | None = None) -> DataFrame:
    """Like exact_topk over the cells nearest to each query only. vectors: the pool with its cells, as assign_cells gives and load_index reads.

    A cell's rows and its queries are dealt to parts of BLOCK by their own counts, so a large cell is spread.
    """
    n = centres.count()
    probes = probes or max(1, min(n // 4, 64))
    p, q = vectors.select("entity_id", "embedding", F.col("cell").cast("int").alias("cell")), assign_cells(queries, centres, probes).select("entity_id", "embedding", "cell")
    counted = lambda df, name: df.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    parts = F.broadcast(counted(p, "pn").join(counted(q, "qn"), "cell"))  # a row for each cell
    bucket = lambda m: F.pmod(F.xxhash64("entity_id"), F.col(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.col(m) - 1))
    q = q.join(parts, "cell").select("entity_id", "embedding", "cell", bucket("qn").alias("qb"), every("pn").alias("pb"))
    p = p.join(parts, "cell").select("entity_id", "embedding", "cell", bucket("pn").alias("pb"), every("qn").alias("qb"))
    return top_k(_scored(q, p, ["cell", "qb", "pb"], k), k)


def ivf_topk(pool: DataFrame, queries: DataFrame, k: int = 100, cells: int | None = None, probes: int | None = None) -> DataFrame:
    """search_index over an index made for the occasion."""
    centres = fit_cells(pool, cells)
    return search_index(assign_cells(pool, centres), centres, queries, k, probes)
