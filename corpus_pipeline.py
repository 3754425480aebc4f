"""The corpus pipeline: stages over documents, each written as Parquet and read again.

Each stage calls one operator of korvane.llm on all that the stage before kept; all but
the last give the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from korvane.llm import bpe, jaccard, lines, mixing, toxicity
from korvane.session import cut, release, scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the labelled ones among docs, does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of windows of three lines; those with nothing left go."""
    return lines.drop_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the least doc_id, of each group of documents that links of Jaccard similarity join."""
    return jaccard.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus, shard by shard: a row for each piece of a document in a slot."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digest of the text that the ids decode to."""
    import public_tokenizers

    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.tokenise(docs, ranks, public_tokenizers.PATTERN)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("ngram_jaccard", drop_near_copies), ("mix", mix_sources), ("bpe", encode)]

#: Learned weights and pseudorandom draws: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents through all stages; what a stage has put aside goes when the next has read its result."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = docs
        with scratch() as keep:
            docs = keep(cut(stage(spark, before, sf_dir), name))
        release(before)
    return docs
