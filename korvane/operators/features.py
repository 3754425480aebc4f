"""Features of pairs (s1_id, cand_id) of normalised records, one row a pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korvane.functions import similarity as sim

# Names of the feature columns, in order.
NAME_FEATURES = ["name_levenshtein", "name_jaro_winkler", "name_token_sort", "name_token_set", "name_partial_ratio", "name_token_jaccard", "name_char3gram_jaccard", "name_char4gram_jaccard", "name_length_ratio"]
ADDRESS_FEATURES = ["addr_levenshtein", "addr_jaro_winkler", "addr_token_sort", "addr_token_set", "addr_token_jaccard", "addr_char3gram_jaccard", "addr_length_ratio", "addr_number_agreement", "addr_pin_zip_match", "addr_both_empty", "addr_one_empty"]
CROSS_FEATURES = ["country_match", "source_is_s2", "source_is_s3"]
FEATURE_COLUMNS = NAME_FEATURES + ADDRESS_FEATURES + CROSS_FEATURES
RETRIEVAL_FEATURE_COLUMNS = [f"retrieval_{r}_{x}" for r in ("lexical", "embedding") for x in ("rank", "score", "found")] + ["retrieval_found_in_n"]

#: Rank of a candidate that a retriever did not find.
NOT_FOUND = 999


def name_features(a: Column, b: Column, mode: str = "edit") -> dict[str, Column]:
    a, b = F.lower(sim.safe(a)), F.lower(sim.safe(b))
    made = (
        sim.levenshtein_ratio(a, b, mode), sim.jaro_winkler(a, b, mode), sim.token_sort_ratio(a, b, mode), sim.token_set_ratio(a, b, mode), sim.partial_ratio(a, b, mode),
        sim.token_jaccard(a, b), sim.char_ngram_jaccard(a, b, 3), sim.char_ngram_jaccard(a, b, 4), sim.length_ratio(a, b),
    )
    return dict(zip(NAME_FEATURES, made, strict=True))


def address_features(a: Column, b: Column, mode: str = "edit") -> dict[str, Column]:
    a, b = F.lower(sim.safe(a)), F.lower(sim.safe(b))
    none, other = a == "", b == ""
    made = (
        sim.levenshtein_ratio(a, b, mode), sim.jaro_winkler(a, b, mode), sim.token_sort_ratio(a, b, mode), sim.token_set_ratio(a, b, mode),
        sim.token_jaccard(a, b), sim.char_ngram_jaccard(a, b, 3), sim.length_ratio(a, b), sim.number_agreement(a, b), sim.pin_zip_match(a, b),
        (none & other).cast("double"), (none != other).cast("double"),
    )
    return dict(zip(ADDRESS_FEATURES, made, strict=True))


def pair_features(pairs: DataFrame, s1: DataFrame, pool: DataFrame, mode: str = "edit") -> DataFrame:
    """pairs with the 23 features. A pair whose record is missing is kept, with the features of empty texts."""
    side = lambda df, p, key: df.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{p}_{c}") for c in ("name_clean", "addr_clean", "country_clean")])
    both = pairs.join(side(s1, "l", "s1_id"), "s1_id", "left").join(side(pool, "r", "cand_id"), "cand_id", "left")
    x, y = sim.safe(F.col("l_country_clean")), sim.safe(F.col("r_country_clean"))
    cross = (F.when((x == "") | (y == ""), 0.5).otherwise((x == y).cast("double")), F.col("cand_id").startswith("S2-").cast("double"), F.col("cand_id").startswith("S3-").cast("double"))
    made = name_features(F.col("l_name_clean"), F.col("r_name_clean"), mode) | address_features(F.col("l_addr_clean"), F.col("r_addr_clean"), mode) | dict(zip(CROSS_FEATURES, cross, strict=True))
    return both.select(*pairs.columns, *[c.alias(n) for n, c in made.items()])


def retrieval_features(pairs: DataFrame, ranked: DataFrame, retrievers: list[str]) -> DataFrame:
    """pairs with rank, score and found of each retriever (retriever, qid, cand_id, score, rank), and how many found the candidate."""
    out = pairs
    for r in retrievers:
        own = ranked.where(F.col("retriever") == r).select(F.col("qid").alias("s1_id"), "cand_id", F.col("rank").alias(f"{r}_k"), F.col("score").alias(f"{r}_s"))
        out = out.join(own, ["s1_id", "cand_id"], "left")
    made = {}
    for r in retrievers:
        made[f"retrieval_{r}_rank"] = F.coalesce(f"{r}_k", F.lit(NOT_FOUND)).cast("int")
        made[f"retrieval_{r}_score"] = F.coalesce(f"{r}_s", F.lit(0.0))
        made[f"retrieval_{r}_found"] = F.col(f"{r}_k").isNotNull().cast("double")
    n = sum((F.col(f"{r}_k").isNotNull().cast("int") for r in retrievers), F.lit(0))
    return out.select(*pairs.columns, *[c.alias(k) for k, c in made.items()], n.alias("retrieval_found_in_n"))
