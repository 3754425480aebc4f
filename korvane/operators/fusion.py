"""Rank fusion and the adaptive cut, on rows (retriever, qid, cand_id, score, rank)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rrf(ranked: DataFrame, weights: dict[str, float] | None = None, k: int = 60) -> DataFrame:
    """qid, cand_id, fused, rank: reciprocal rank fusion. weights: by retriever, in order, made to sum to 1; ties go to the first retriever that found the candidate, at its rank there."""
    names = list(weights) if weights else sorted(r.retriever for r in ranked.select("retriever").distinct().collect())
    total = sum(weights.values()) if weights else len(names)
    rows = [(n, i, (weights[n] if weights else 1.0) / total) for i, n in enumerate(names)]
    table = ranked.sparkSession.createDataFrame(rows, "retriever string, nth int, w double")
    share = ranked.join(F.broadcast(table), "retriever")
    fused = share.groupBy("qid", "cand_id").agg(F.sum(F.col("w") / (k + F.col("rank"))).alias("fused"), F.min(F.struct("nth", "rank")).alias("first"))
    order = Window.partitionBy("qid").orderBy(F.desc(F.round("fused", 12)), "first.nth", "first.rank", "cand_id")
    return fused.withColumn("rank", F.row_number().over(order)).select("qid", "cand_id", "fused", "rank")


def adaptive_k(fused: DataFrame, min_k: int = 0, max_k: int = 30, gap: float = 0.15, min_score: float = 0.001, keep_top1: bool = False) -> DataFrame:
    """fused (qid, cand_id, fused, rank) up to the first row after which candidates are not worth a look.

    A row r over max(min_k, 1) ends the list if its score is below min_score, or has fallen by
    more than gap from the row before to less than 0.3 of the best. With min_k = 0 row 1 is
    not part of the result; keep_top1 keeps it. Lists of at most min_k rows stay whole;
    without a positive score only the first min_k rows stay.
    """
    w = Window.partitionBy("qid").orderBy("rank")
    rows = fused.withColumns({"prev": F.lag("fused").over(w), "top": F.first("fused").over(w), "n": F.count("*").over(Window.partitionBy("qid"))})
    drop = F.when(F.col("prev") > 0, (F.col("prev") - F.col("fused")) / F.col("prev")).otherwise(0.0)
    ends = (F.col("rank") > max(min_k, 1)) & ((F.col("fused") < min_score) | ((drop > gap) & (F.col("fused") < 0.3 * F.col("top"))))
    rows = rows.withColumn("ended", F.max(ends.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    always = F.col("rank") <= max(min_k, 1 if keep_top1 else 0)
    scanned = (F.col("rank") > max(min_k, 1)) & (F.col("rank") <= max_k) & (F.col("ended") == 0) & (F.col("top") > 0)
    return rows.where((F.col("n") <= min_k) | always | scanned).select("qid", "cand_id", "fused", "rank")


def cut_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: queries, and mean candidates of a query before and after the cut."""
    a = before.agg(F.countDistinct("qid").alias("queries"), F.count("*").alias("n_before"))
    b = after.agg(F.count("*").alias("n_after"))
    return a.crossJoin(b).select("queries", (F.col("n_before") / F.col("queries")).alias("mean_before"), (F.col("n_after") / F.col("queries")).alias("mean_after"))
