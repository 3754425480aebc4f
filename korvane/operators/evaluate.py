"""Quality of matches and of candidates, as aggregations over (s1_id, matches) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def f_half(tp: Column, n_pred: Column, n_true: Column) -> Column:
    """F0.5 of one entity: 1 if both sides are empty, 0 if one is."""
    p, r = tp / n_pred, tp / n_true
    return F.when((n_pred == 0) & (n_true == 0), 1.0).when((n_pred == 0) | (n_true == 0) | (tp == 0), 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


def entity_scores(pred: DataFrame, truth: DataFrame) -> DataFrame:
    """s1_id, tp, fp, fn, precision, recall, f05 of every record of truth; no prediction counts as empty."""
    none = F.array().cast("array<string>")
    rows = truth.select("s1_id", F.array_distinct(F.coalesce("matches", none)).alias("t")).join(pred.select("s1_id", F.array_distinct("matches").alias("p0")), "s1_id", "left")
    rows = rows.withColumn("p", F.coalesce("p0", none))
    rows = rows.select("s1_id", F.size(F.array_intersect("p", "t")).alias("tp"), F.size("p").alias("n_pred"), F.size("t").alias("n_true"))
    tp, n_pred, n_true = F.col("tp"), F.col("n_pred"), F.col("n_true")
    both = (n_pred == 0) & (n_true == 0)
    part = lambda n: F.when(both, 1.0).when((n_pred == 0) | (n_true == 0), 0.0).otherwise(tp / n)
    return rows.select(
        "s1_id", "tp", (n_pred - tp).alias("fp"), (n_true - tp).alias("fn"), part(n_pred).alias("precision"), part(n_true).alias("recall"), f_half(tp, n_pred, n_true).alias("f05"), "n_pred", "n_true"
    )


def macro_f05(pred: DataFrame, truth: DataFrame) -> DataFrame:
    return entity_scores(pred, truth).agg(F.coalesce(F.avg("f05"), F.lit(0.0)).alias("macro_f05"))


def evaluate(pred: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: macro and micro precision, recall and F0.5, totals, and how well records without a match are told."""
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    s = entity_scores(pred, truth).agg(
        F.avg("f05").alias("macro_f05"), F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        F.sum("tp").alias("total_tp"), F.sum("fp").alias("total_fp"), F.sum("fn").alias("total_fn"), F.count("*").alias("n_entities"),
        F.count_if((F.col("n_pred") == 0) & (F.col("n_true") == 0)).alias("right"), F.count_if(F.col("n_pred") == 0).alias("said"), F.count_if(F.col("n_true") == 0).alias("true"),
    )
    s = s.withColumns({"micro_precision": ratio(F.col("total_tp"), F.col("total_tp") + F.col("total_fp")), "micro_recall": ratio(F.col("total_tp"), F.col("total_tp") + F.col("total_fn"))})
    p, r = F.col("micro_precision"), F.col("micro_recall")
    s = s.withColumn("micro_f05", F.when(p + r > 0, 1.25 * p * r / (0.25 * p + r)).otherwise(0.0))
    return s.select(
        "macro_f05", "macro_precision", "macro_recall", "micro_f05", "micro_precision", "micro_recall", "total_tp", "total_fp", "total_fn",
        ratio(F.col("right"), F.col("said")).alias("singleton_precision"), ratio(F.col("right"), F.col("true")).alias("singleton_recall"), "n_entities",
    )


def blocking_quality(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """One row on candidates (qid, cand_id) against truth: the recall they allow and how many they are."""
    links = truth.select("s1_id", F.explode(F.array_distinct("matches")).alias("cand_id"))
    pairs = candidates.select(F.col("qid").alias("s1_id"), "cand_id").distinct()
    n = pairs.groupBy("s1_id").agg(F.count("*").alias("n"))
    hits = links.join(pairs, ["s1_id", "cand_id"], "left_semi").groupBy("s1_id").agg(F.count("*").alias("hits"))
    rows = truth.select("s1_id", F.size(F.array_distinct("matches")).alias("n_true")).join(n, "s1_id", "left").join(hits, "s1_id", "left").na.fill(0, ["n", "hits"])
    s = rows.agg(
        F.sum("hits").alias("hits"), F.sum("n_true").alias("total_true_matches"), F.sum("n").alias("total_candidates"), F.avg("n").alias("mean_candidates"),
        F.percentile("n", F.lit(0.5)).alias("median_candidates"), F.percentile("n", F.lit(0.95)).alias("p95_candidates"), F.max("n").alias("max_candidates"),
        F.count_if((F.col("n_true") > 0) & (F.col("hits") == 0)).alias("missed_entities"), F.count("*").alias("entities"),
    )
    return s.select(
        F.when(F.col("total_true_matches") > 0, F.col("hits") / F.col("total_true_matches")).otherwise(0.0).alias("recall_ceiling"), "total_true_matches", "total_candidates",
        "mean_candidates", "median_candidates", "p95_candidates", "max_candidates", "missed_entities", (F.col("missed_entities") / F.col("entities") * 100).alias("missed_entity_pct"),
    )
