"""Profiles of sources and truth, and deterministic splits and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def country_counts(df: DataFrame) -> DataFrame:
    return df.where("country is not null").groupBy("country").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "country")


def reverse_truth(truth: DataFrame) -> DataFrame:
    """cand_id, s1_ids: the records that each candidate belongs to, in order."""
    return truth.select("s1_id", F.explode("matches").alias("cand_id")).groupBy("cand_id").agg(F.array_sort(F.collect_list("s1_id")).alias("s1_ids"))


def multi_matched(truth: DataFrame) -> DataFrame:
    """cand_id, n of candidates that belong to more than one record."""
    return truth.select("s1_id", F.explode("matches").alias("cand_id")).groupBy("cand_id").agg(F.countDistinct("s1_id").alias("n")).where("n > 1")


def match_histogram(truth: DataFrame) -> DataFrame:
    """n_matches, n_records, percent."""
    h = truth.groupBy(F.size("matches").cast("long").alias("n_matches")).agg(F.count("*").alias("n_records"))
    return h.crossJoin(F.broadcast(h.agg(F.sum("n_records").alias("whole")))).select("n_matches", "n_records", (F.col("n_records") * 100 / F.col("whole")).alias("percent"))


def match_summary(truth: DataFrame) -> DataFrame:
    n = F.size("matches")
    return truth.agg(F.count("*").alias("n_records"), F.count_if(n == 0).alias("singletons"), F.avg(n).alias("mean_matches"), F.max(n).cast("long").alias("max_matches"))


def source_histogram(truth: DataFrame, prefixes: tuple[str, ...] = ("S2-", "S3-")) -> DataFrame:
    """source, n_matches, n_records: how many matches records have in each source."""

    def of(prefix: str) -> Column:
        own = F.filter("matches", lambda m: m.startswith(prefix))
        return F.struct(F.lit(prefix[:-1]).alias("source"), F.size(own).cast("long").alias("n_matches"))

    rows = truth.select(F.explode(F.array(*map(of, prefixes))).alias("x"))
    return rows.groupBy("x.source", "x.n_matches").agg(F.count("*").alias("n_records"))


def missing_audit(df: DataFrame) -> DataFrame:
    """column, n_null, n_blank, n_rows of every string column, in one pass."""
    names = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    one = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"u{i}") for i, c in enumerate(names)], *[F.count_if(F.trim(c) == "").alias(f"b{i}") for i, c in enumerate(names)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"u{i}").alias("n_null"), F.col(f"b{i}").alias("n_blank"), F.col("n").alias("n_rows")) for i, c in enumerate(names)]
    return one.select(F.inline(F.array(*rows)))


def length_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, mean, median, min, max of text lengths."""
    aggs = []
    for i, c in enumerate(columns):
        n = F.length(F.coalesce(c, F.lit("")))
        aggs += [F.avg(n).alias(f"a{i}"), F.percentile(n, F.lit(0.5)).alias(f"m{i}"), F.min(n).alias(f"l{i}"), F.max(n).alias(f"h{i}")]
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"a{i}").alias("mean_length"), F.col(f"m{i}").alias("median_length"), F.col(f"l{i}").cast("long").alias("min_length"), F.col(f"h{i}").cast("long").alias("max_length"))
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def sample_matches(truth: DataFrame, s1: DataFrame, pool: DataFrame, n: int = 15, each: int = 3) -> DataFrame:
    """The first n matched records with names of their first `each` matches."""
    some = truth.where(F.size("matches") > 0).orderBy("s1_id").limit(n).select("s1_id", F.posexplode("matches").alias("pos", "cand_id")).where(F.col("pos") < each)
    names = lambda df, k, v: df.select(F.col("entity_id").alias(k), F.col("business_name").alias(v))
    return some.join(names(s1, "s1_id", "s1_name"), "s1_id", "left").join(names(pool, "cand_id", "cand_name"), "cand_id", "left").select("s1_id", "pos", "cand_id", "s1_name", "cand_name")


def draw(key: Column, seed: int) -> Column:
    """A digest of the key, as hexadecimal digits, that orders keys at random and alike in any engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def stratified_split(truth: DataFrame, s1: DataFrame, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """s1_id, is_val: round(fraction) of every stratum of country and number of matches (0, 1, 2, 3 or more), drawn by hash.

    The stratum's least hashes are found by quantile-free counting: ranks within (stratum, hash bucket) and prefix
    sums over buckets, so a large stratum is no single task's work.
    """
    size = F.least(F.size("matches"), F.lit(3))
    rows = truth.join(s1.select(F.col("entity_id").alias("s1_id"), "country"), "s1_id").select("s1_id", F.concat_ws("|", F.coalesce("country", F.lit("")), size.cast("string")).alias("stratum"))
    rows = rows.withColumn("h", draw(F.col("s1_id"), seed)).withColumn("bucket", F.substring("h", 1, 3))
    counts = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("m"))
    w = Window.partitionBy("stratum")
    counts = counts.select("stratum", "bucket", (F.sum("m").over(w.orderBy("bucket")) - F.col("m")).alias("base"), F.sum("m").over(w).alias("whole"))
    inner = F.row_number().over(Window.partitionBy("stratum", "bucket").orderBy("h", "s1_id"))
    ranked = rows.withColumn("inner", inner).join(counts, ["stratum", "bucket"])
    return ranked.select("s1_id", (F.col("base") + F.col("inner") <= F.bround(F.lit(fraction) * F.col("whole"))).alias("is_val"))


def sample_training(s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame, n: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The first n records of S1, and of S2 and S3 all their true matches plus the first 2n others, each in order of id."""
    own = s1.orderBy("entity_id").limit(n)
    ids = truth.join(own, F.col("s1_id") == F.col("entity_id"), "left_semi").select(F.explode("matches").alias("entity_id")).distinct()
    cut = lambda df: df.join(ids, "entity_id", "left_semi").unionByName(df.join(ids, "entity_id", "left_anti").orderBy("entity_id").limit(2 * n))
    return own, cut(s2), cut(s3)


def sample_test(s1: DataFrame, s2: DataFrame, s3: DataFrame, n: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    return s1.orderBy("entity_id").limit(n), s2.orderBy("entity_id").limit(2 * n), s3.orderBy("entity_id").limit(2 * n)


def prediction_summary(pred: DataFrame) -> DataFrame:
    """One row on (s1_id, matches): matched records, singletons, matches, mean matches of a matched record."""
    n = F.size("matches")
    return pred.agg(
        F.count_if(n > 0).alias("matched"), F.count_if(n == 0).alias("singletons"), F.sum(n).cast("long").alias("total_matches"),
        F.coalesce(F.sum(n) / F.nullif(F.count_if(n > 0), F.lit(0)), F.lit(0.0)).alias("mean_matches"),
    )
