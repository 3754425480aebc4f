"""The registered queries of the corpus operators and of the pipeline."""

from __future__ import annotations

from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession

from korvane.llm import ann, bpe, chat, dedup, jaccard, langid, lines, mixing, pii, toxicity
from korvane.session import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op3_additive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_report(table(spark, sf_dir, "embeddings"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_report(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_report(turns.unionByName(own))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup_report(table(spark, sf_dir, "documents"))


#: Stands in for the key where the session has none: the query's pseudonyms are then for show, not secret.
SHOWN_KEY = "for demonstration only"


def op8_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"), spark.conf.get(pii.KEY_SETTING, SHOWN_KEY))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # a script beside the package

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_mix_sources, op2_byte_bpe, op3_additive_ann, op4_ngram_jaccard, op5_exact_dedup, op6_line_dedup, op7_chat_format, op8_pii_pseudonyms, op9_language_id, op10_toxicity)
    found = {f.__name__: f for f in own}
    if find_spec("corpus_pipeline"):
        found["pipeline"] = pipeline
    return found


def oracle_sql() -> dict[str, str]:
    return {"op4_ngram_jaccard": jaccard.ORACLE, "op5_exact_dedup": dedup.ORACLE, "op6_line_dedup": lines.ORACLE, "op7_chat_format": chat.ORACLE}
