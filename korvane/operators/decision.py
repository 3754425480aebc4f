"""From scores to matches: thresholds and the greedy one-to-one rule, as one window; threshold calibration.

Rows are (s1_id, cand_id, score, s1_pos). Records of S1 claim candidates in order of their
best score, ties by s1_pos. A record takes every candidate that is still free, so a
candidate goes to the first eligible record in that order: row_number() = 1 over the
candidate's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from korvane.operators.evaluate import f_half

MATCH, SINGLETON = 0.5, 0.3


def _claims(scored: DataFrame, match: Column, singleton: Column, by: list[str]) -> DataFrame:
    best = F.max("score").over(Window.partitionBy(*by, "s1_id"))
    rows = scored.withColumn("best", best).where((F.col("best") >= singleton) & (F.col("score") >= match))
    first = F.row_number().over(Window.partitionBy(*by, "cand_id").orderBy(F.desc("best"), "s1_pos"))
    return rows.withColumn("nth", first).where("nth = 1").drop("nth", "best")


def decide(scored: DataFrame, match: float = MATCH, singleton: float = SINGLETON) -> DataFrame:
    """s1_id, cand_id, score of the matches."""
    return _claims(scored, F.lit(match), F.lit(singleton), []).select("s1_id", "cand_id", "score")


def with_singletons(matches: DataFrame, s1_ids: DataFrame) -> DataFrame:
    """s1_id, matches: every record with its candidates, best first; an empty array without any."""
    by = matches.groupBy("s1_id").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("key"), "cand_id"))), lambda x: x["cand_id"]).alias("matches"))
    return s1_ids.select("s1_id").join(by, "s1_id", "left").select("s1_id", F.coalesce("matches", F.array().cast("array<string>")).alias("matches"))


def grid(spark, low: float, high: float, steps: int) -> DataFrame:
    """i, t: evenly spaced thresholds with both ends."""
    return spark.range(steps).select(F.col("id").cast("int").alias("i"), (F.lit(low) + F.col("id") * F.lit((high - low) / (steps - 1))).alias("t"))


def _held(scored: DataFrame, fixed: float, which: str) -> DataFrame:
    """s1_id, cand_id, low, high: the pairs that are matches for thresholds above low (null: any) up to high, and for no others.

    A candidate's rows come in claim order. Where the match threshold varies, a row wins once all rows before it
    fall below; where the singleton threshold does, the first row wins as long as its record passes at all.
    """
    rows = scored.withColumn("best", F.max("score").over(Window.partitionBy("s1_id")))
    order = Window.partitionBy("cand_id").orderBy(F.desc("best"), "s1_pos")
    if which == "match":
        rows = rows.where(F.col("best") >= fixed).withColumn("low", F.max("score").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        return rows.where(F.col("low").isNull() | (F.col("score") > F.col("low"))).select("s1_id", "cand_id", "low", F.col("score").alias("high"))
    rows = rows.where(F.col("score") >= fixed).withColumn("nth", F.row_number().over(order)).where("nth = 1")
    return rows.select("s1_id", "cand_id", F.lit(None).cast("double").alias("low"), F.col("best").alias("high"))


def threshold_scores(scored: DataFrame, truth: DataFrame, thresholds: DataFrame, fixed: float, which: str = "match") -> DataFrame:
    """i, t, macro_f05 of every threshold, ascending by i from 0. truth: s1_id, matches. which: the threshold that varies; fixed: the other one.

    No row is copied for each threshold: a match counts from one grid point up to another, so a record's predictions
    change at the ends of its matches only, and its score is added to the grid as the steps that it takes there.
    """
    points = [r.t for r in thresholds.orderBy("i").collect()]  # some dozens
    below = lambda x: F.size(F.filter(F.array(*map(F.lit, points)), lambda t: t <= x))
    held = _held(scored, fixed, which).select("s1_id", "cand_id", F.when(F.col("low").isNull(), 0).otherwise(below(F.col("low"))).alias("from"), below(F.col("high")).alias("to")).where("from < to")
    true = truth.select("s1_id", F.size("matches").alias("n_true"))
    links = truth.select("s1_id", F.explode("matches").alias("cand_id")).distinct().withColumn("hit", F.lit(1))
    held = held.join(links, ["s1_id", "cand_id"], "left").select("s1_id", F.explode(F.array(F.struct(F.col("from").alias("i"), F.lit(1).alias("n")), F.struct(F.col("to").alias("i"), F.lit(-1).alias("n")))).alias("e"), F.coalesce("hit", F.lit(0)).alias("hit"))
    steps = held.groupBy("s1_id", F.col("e.i").alias("i")).agg(F.sum("e.n").alias("n"), F.sum(F.col("e.n") * F.col("hit")).alias("hits"))
    so_far = Window.partitionBy("s1_id").orderBy("i")
    steps = steps.withColumns({"n_pred": F.sum("n").over(so_far), "tp": F.sum("hits").over(so_far)}).join(true, "s1_id")
    # A record without a prediction scores 1 if it has no match either.
    without = F.when(F.col("n_true") == 0, 1.0).otherwise(0.0)
    steps = steps.withColumns({"f": F.when(F.col("n_pred") == 0, without).otherwise(f_half(F.col("tp"), F.col("n_pred"), F.col("n_true"))), "f0": without})
    steps = steps.withColumn("step", F.col("f") - F.coalesce(F.lag("f").over(so_far), "f0"))
    grid_steps = steps.groupBy("i").agg(F.sum("step").alias("step"))
    whole = true.agg(F.count("*").alias("n"), F.count_if(F.col("n_true") == 0).alias("empty"))
    sums = thresholds.join(grid_steps, "i", "left").crossJoin(F.broadcast(whole))
    total = F.sum(F.coalesce("step", F.lit(0.0))).over(Window.orderBy("i")) + F.col("empty")  # a row for each threshold
    return sums.select("i", "t", F.when(F.col("n") > 0, total / F.col("n")).otherwise(0.0).alias("macro_f05"))


def _first_best(scores: DataFrame, default: float) -> float:
    row = scores.orderBy(F.desc(F.round("macro_f05", 12)), "i").first()
    return row.t if row and row.macro_f05 > 0 else default


def calibrate_match(scored: DataFrame, truth: DataFrame, singleton: float = SINGLETON, low: float = 0.1, high: float = 0.9, steps: int = 50) -> float:
    return _first_best(threshold_scores(scored, truth, grid(scored.sparkSession, low, high, steps), singleton, "match"), MATCH)


def calibrate_singleton(scored: DataFrame, truth: DataFrame, match: float, low: float = 0.05, high: float = 0.6, steps: int = 30) -> float:
    return _first_best(threshold_scores(scored, truth, grid(scored.sparkSession, low, high, steps), match, "singleton"), SINGLETON)
