"""Delimited sources and sinks of records, truth and results; saved vector indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from korvane.functions import vocab
from korvane.functions.text import strip

RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])


def _tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8").csv(path)


def load_records(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """Tab-separated records with a header, all strings; what stands for a missing value becomes empty."""
    df = _tsv(spark, path, schema)
    return df.select(*[F.when(F.col(c).isNull() | F.col(c).isin(*vocab.MISSING), F.lit("")).otherwise(F.col(c)).alias(c) for c in df.columns])


def parse_matches(c):
    """A comma-separated list of ids, each trimmed; blank is the empty list."""
    return F.when(strip(F.coalesce(c, F.lit(""))) == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(c, ","), strip))


def load_truth(spark: SparkSession, path: str) -> DataFrame:
    """s1_id, matches. Of several rows of a record the last in the file counts."""
    rows = _tsv(spark, path, TRUTH).withColumn("at", F.monotonically_increasing_id())
    last = Window.partitionBy("source1_entity_id").orderBy(F.desc("at"))
    rows = rows.withColumn("nth", F.row_number().over(last)).where("nth = 1")
    return rows.select(strip(F.col("source1_entity_id")).alias("s1_id"), parse_matches(F.col("matched_entity_ids")).alias("matches"))


def load_train(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return (*(load_records(spark, f"{folder}/train_source{i}.tsv") for i in (1, 2, 3)), load_truth(spark, f"{folder}/train_ground_truth.tsv"))


def load_test(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(load_records(spark, f"{folder}/test_source{i}.tsv") for i in (1, 2, 3))


def write_lists(df: DataFrame, path: str, ids: str, name: str, single: bool = True) -> None:
    """(s1_id, array) rows as tab-separated text with a header, sorted by id, ids joined by commas, nothing quoted.

    single: one file, as the result's readers expect; otherwise range-partitioned files, sorted across them.
    """
    rows = df.select(F.col("s1_id").alias("source1_entity_id"), F.array_join(ids, ",").alias(name)).orderBy("source1_entity_id")
    (rows.coalesce(1) if single else rows).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def write_matches(df: DataFrame, path: str, single: bool = True) -> None:
    """df: s1_id, matches."""
    write_lists(df, path, "matches", "matched_entity_ids", single)


def write_candidates(df: DataFrame, path: str, single: bool = True) -> None:
    """df: qid, cand_id, rank."""
    lists = df.groupBy(F.col("qid").alias("s1_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "cand_id"))), lambda x: x["cand_id"]).alias("ids"))
    write_lists(lists, path, "ids", "candidate_entity_ids", single)


def save_index(assigned: DataFrame, cells: DataFrame, path: str) -> None:
    """A vector index: rows (entity_id, embedding, cell) in a folder for each cell, and the centres."""
    assigned.repartition("cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")
    cells.write.mode("overwrite").parquet(f"{path}/cells")


def load_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/cells")
