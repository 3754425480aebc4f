"""Training pairs (s1_id, cand_id, label): true matches and three kinds of negatives, all deterministic."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from korvane.session import cut

PAIR = ["s1_id", "cand_id"]


def positives(truth: DataFrame) -> DataFrame:
    """truth: s1_id, matches array."""
    return truth.select("s1_id", F.explode("matches").alias("cand_id")).withColumn("label", F.lit(1))


def limits(pos: DataFrame, ratio: float) -> tuple[int, int, int]:
    """How many negatives for these positives: in all, by retrieval at most (60 %), by collision at most (20 %)."""
    n = int(pos.count() * ratio)
    return n, int(n * 0.6), int(n * 0.2)


def retrieval_negatives(retrieved: DataFrame, pos: DataFrame, n: int) -> DataFrame:
    """The n best-scored retrieved pairs (s1_id, cand_id, score) that are no matches; ties by ids."""
    return retrieved.join(pos, PAIR, "left_anti").orderBy(F.desc(F.round("score", 9)), *PAIR).limit(n).select(*PAIR)


def collision_pairs(s1: DataFrame, pool: DataFrame) -> DataFrame:
    """s1_id, cand_id, kind: records with the same non-empty name (kind 0) or address (kind 1); the first kind where both hold."""
    found = None
    for kind, column in enumerate(("name_clean", "addr_clean")):
        a = s1.where(F.col(column) != "").select(F.col("entity_id").alias("s1_id"), F.col(column).alias("key"))
        b = pool.where(F.col(column) != "").select(F.col("entity_id").alias("cand_id"), F.col(column).alias("key"))
        got = a.join(b, "key").select("s1_id", "cand_id", F.lit(kind).alias("kind"))
        found = got if found is None else found.unionByName(got)
    return found.groupBy(*PAIR).agg(F.min("kind").alias("kind"))


def leading(df: DataFrame, n: int, *by: str, weight: str | None = None) -> DataFrame:
    """The first rows of df in a total order, up to that at which `weight` (one a row, where none is named) sums to n.

    Ranges are summed first and only the last is walked through, so no task orders all rows.
    """
    if n <= 0:
        return df.limit(0)
    dealt = cut(df.withColumn("w_", F.col(weight) if weight else F.lit(1)).repartitionByRange(*by).withColumn("range_", F.spark_partition_id()), "ranges")
    last, before = -1, 0
    for r in sorted(dealt.groupBy("range_").agg(F.sum("w_").alias("s")).collect()):
        last = r.range_
        if before + r.s >= n:
            break
        before += r.s
    upto = F.sum("w_").over(Window.partitionBy("range_").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0))
    inner = dealt.where(F.col("range_") == last).withColumn("upto_", upto - F.col("w_")).where(F.col("upto_") < n - before)
    return dealt.where(F.col("range_") < last).select(*df.columns).unionByName(inner.select(*df.columns))


def enough(s1: DataFrame, pool: DataFrame, barred: DataFrame, n: int) -> DataFrame:
    """The first records of s1, in order of id, that surely have n collisions outside `barred`; all of s1 if none are sure.

    A record has as many collisions as its name or its address has ids in the pool, or more; those barred are taken off.
    """
    each = None
    for column in ("name_clean", "addr_clean"):
        sizes = pool.where(F.col(column) != "").groupBy(F.col(column).alias("key")).agg(F.count_distinct("entity_id").alias("m"))
        got = s1.where(F.col(column) != "").select(F.col("entity_id").alias("id_"), F.col(column).alias("key")).join(sizes, "key").select("id_", "m")
        each = got if each is None else each.unionByName(got)
    off = barred.groupBy(F.col("s1_id").alias("off_")).agg(F.count("*").alias("less"))
    each = each.groupBy("id_").agg(F.max("m").alias("m")).join(off, F.col("id_") == F.col("off_"), "left")
    sure = each.select("id_", (F.col("m") - F.coalesce("less", F.lit(0))).alias("sure")).where("sure > 0 AND id_ IS NOT NULL")
    got = leading(sure, n, "id_", weight="sure").agg(F.max("id_").alias("id_"), F.sum("sure").alias("sure")).first()
    if (got.sure or 0) < n:
        return s1
    return s1.where(F.col("entity_id").isNull() | (F.col("entity_id") <= F.lit(got.id_)))


def collision_negatives(s1: DataFrame, pool: DataFrame, barred: DataFrame, n: int) -> DataFrame:
    """At most n collisions outside `barred`, in order of s1 and kind.

    Only the first records that surely have as many are joined, so that the pairs made are about n and those barred,
    not the squares of frequent names and addresses.
    """
    if n <= 0:
        return barred.select(*PAIR).limit(0)
    pairs = collision_pairs(enough(s1, pool, barred, n), pool).join(barred, PAIR, "left_anti")
    return leading(pairs, n, "s1_id", "kind", "cand_id").select(*PAIR)


def random_negatives(s1_ids: DataFrame, pool_ids: DataFrame, barred: DataFrame, n: int, seed: int = 42, tries: int = 10) -> DataFrame:
    """n distinct pairs drawn by hash, none of them barred; fewer only if n * tries draws do not give as many."""
    spark = s1_ids.sparkSession

    def numbered(df: DataFrame, name: str) -> DataFrame:
        # Positions without a global sort: counts of hash buckets, their prefix sums, positions within buckets.
        b = df.select(F.col(df.columns[0]).alias(name)).withColumn("bucket", F.pmod(F.xxhash64(name), F.lit(1024)).cast("int"))
        base = b.groupBy("bucket").agg(F.count("*").alias("m"))
        base = base.select("bucket", (F.sum("m").over(Window.orderBy("bucket")) - F.col("m")).alias("base"))
        inner = F.row_number().over(Window.partitionBy("bucket").orderBy(name)) - 1
        return b.withColumn("inner", inner).join(F.broadcast(base), "bucket").select(name, (F.col("base") + F.col("inner")).alias(f"{name}_at"))

    a, b = s1_ids.count(), pool_ids.count()
    if not a or not b or n <= 0:
        return spark.createDataFrame([], "s1_id string, cand_id string")
    draws = spark.range(n * tries).select("id", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(a)).alias("s1_id_at"), F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.lit(b)).alias("cand_id_at"))
    pairs = draws.join(numbered(s1_ids, "s1_id"), "s1_id_at").join(numbered(pool_ids, "cand_id"), "cand_id_at")
    pairs = pairs.groupBy(*PAIR).agg(F.min("id").alias("id")).join(barred, PAIR, "left_anti")
    return pairs.orderBy("id").limit(n).select(*PAIR)


def training_pairs(s1: DataFrame, pool: DataFrame, truth: DataFrame, retrieved: DataFrame, ratio: float = 3.0, seed: int = 42) -> DataFrame:
    """All matches and ratio times as many negatives: at most 60 % by retrieval, 20 % by collision, the rest at random."""
    pos = positives(truth).select(*PAIR, "label")
    n, by_retrieval, by_collision = limits(pos, ratio)
    known = retrieved.join(pos, PAIR, "left_anti").select(*PAIR)
    hard = retrieval_negatives(retrieved, pos, by_retrieval)
    barred = pos.select(*PAIR).unionByName(known)  # also those retrieved that the cut leaves out
    same = collision_negatives(s1, pool, barred, by_collision)
    drawn = cut(hard.unionByName(same), "negatives")
    rest = random_negatives(s1.select("entity_id"), pool.select("entity_id"), barred.unionByName(drawn), n - drawn.count(), seed)
    return pos.unionByName(drawn.unionByName(rest).withColumn("label", F.lit(0)))


def text_pairs(pairs: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """pairs with text_a and text_b, both records' combined texts: what training an encoder on pairs reads."""
    side = lambda df, k, v: df.select(F.col("entity_id").alias(k), F.col("combined").alias(v))
    return pairs.join(side(s1, "s1_id", "text_a"), "s1_id").join(side(pool, "cand_id", "text_b"), "cand_id").select(*pairs.columns, "text_a", "text_b")
