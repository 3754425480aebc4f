"""The linkage pipelines, training and inference, composed of the operators."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from korvane.functions.text import normalise
from korvane.operators import decision, evaluate, features, fusion, lexical, negatives, profile, stress, vector
from korvane.operators.matcher import PairMatcher
from korvane.session import cut, local_session, release
from korvane.sources import records


@dataclass(frozen=True)
class Settings:
    top_k: int = 100
    ngrams: tuple[int, int] = (3, 4)
    max_features: int = 25_000
    min_k: int = 0
    max_k: int = 30
    gap: float = 0.15
    keep_top1: bool = False
    val_fraction: float = 0.2
    neg_ratio: float = 3.0
    sim_mode: str = "edit"
    seed: int = 42
    rounds: int = 20
    #: Pool rows up to which vectors are searched exactly.
    exact_rows: int = 100_000
    #: Loads a text encoder in a worker; without one only the lexical retriever runs.
    encoder: Callable | None = field(default=None)


def fit_pool(pool: DataFrame, s: Settings) -> lexical.TfIdf:
    """What retrieval keeps of a pool, made once."""
    return lexical.fit_tfidf(pool, low=s.ngrams[0], high=s.ngrams[1], max_features=s.max_features)


def retrieve(pool: DataFrame, queries: DataFrame, s: Settings, model: lexical.TfIdf | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """(ranked rows of all retrievers, the fused and cut candidates, names of the retrievers)."""
    best = lexical.tfidf_topk(model or fit_pool(pool, s), queries, s.top_k)
    ranked, names = best.withColumn("retriever", F.lit("lexical")), ["lexical"]
    if s.encoder is not None:
        p, q = (vector.encode_texts(df, "combined", s.encoder) for df in (pool, queries))
        search = vector.exact_topk if pool.count() <= s.exact_rows else vector.ivf_topk
        ranked, names = ranked.unionByName(search(p, q, s.top_k).withColumn("retriever", F.lit("embedding"))), [*names, "embedding"]
    ranked = cut(ranked.select("retriever", "qid", "cand_id", "score", "rank"), "ranked")
    release(best)
    fused = fusion.rrf(ranked, {n: 1.0 for n in names})
    return ranked, cut(fusion.adaptive_k(fused, s.min_k, s.max_k, s.gap, keep_top1=s.keep_top1), "cut"), names


def featurise(pairs: DataFrame, s1: DataFrame, pool: DataFrame, ranked: DataFrame, names: list[str], s: Settings) -> DataFrame:
    return features.retrieval_features(features.pair_features(pairs, s1, pool, s.sim_mode), ranked, names)


def _scored(matcher: PairMatcher, rows: DataFrame) -> DataFrame:
    return matcher.score(rows).select("s1_id", "cand_id", "score", F.col("s1_id").alias("s1_pos"))


def train(s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame, s: Settings = Settings(), noise: bool = False) -> tuple[PairMatcher, DataFrame, DataFrame]:
    """(matcher with calibrated thresholds, quality of the held-out matches, quality of the candidates). noise: validates on corrupted records."""
    split = cut(profile.stratified_split(truth, s1, s.val_fraction, s.seed), "split")
    val_ids = split.where("is_val").select(F.col("s1_id").alias("entity_id"))
    s1_val, s1_train = s1.join(val_ids, "entity_id", "left_semi"), s1.join(val_ids, "entity_id", "left_anti")
    if noise:
        s1_val = stress.corrupt(s1_val, seed=s.seed)
    pool = cut(normalise(s2.unionByName(s3)), "pool")
    own = {False: cut(normalise(s1_train), "s1"), True: cut(normalise(s1_val), "s1")}
    truth_of = {v: truth.join(split.where(F.col("is_val") == v), "s1_id", "left_semi") for v in (False, True)}

    model = fit_pool(pool, s)
    ranked, candidates, names = retrieve(pool, own[False], s, model)
    pairs = negatives.training_pairs(own[False], pool, truth_of[False], candidates.select(F.col("qid").alias("s1_id"), "cand_id", F.col("fused").alias("score")), s.neg_ratio, s.seed)
    rows = cut(featurise(pairs, own[False], pool, ranked, names, s), "features")

    v_ranked, v_candidates, _ = retrieve(pool, own[True], s, model)
    links = truth_of[True].select("s1_id", F.explode("matches").alias("cand_id")).withColumn("label", F.lit(1))
    v_pairs = v_candidates.select(F.col("qid").alias("s1_id"), "cand_id").join(links, ["s1_id", "cand_id"], "left").na.fill(0, ["label"])
    v_rows = cut(featurise(v_pairs, own[True], pool, v_ranked, names, s), "features")

    matcher = PairMatcher.train(rows, v_rows, rounds=s.rounds, seed=s.seed)
    scored = cut(_scored(matcher, v_rows), "scored")
    matcher.match = decision.calibrate_match(scored, truth_of[True])
    matcher.singleton = decision.calibrate_singleton(scored, truth_of[True], matcher.match)
    pred = decision.with_singletons(decision.decide(scored, matcher.match, matcher.singleton), truth_of[True])
    return matcher, evaluate.evaluate(pred, truth_of[True]), evaluate.blocking_quality(v_candidates, truth_of[True])


def infer(matcher: PairMatcher, s1: DataFrame, s2: DataFrame, s3: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(s1_id, matches of every record; the candidates). One-to-one holds over all records at once."""
    pool, own = cut(normalise(s2.unionByName(s3)), "pool"), cut(normalise(s1), "s1")
    ranked, candidates, names = retrieve(pool, own, s)
    rows = featurise(candidates.select(F.col("qid").alias("s1_id"), "cand_id"), own, pool, ranked, names, s)
    matches = decision.decide(_scored(matcher, rows), matcher.match, matcher.singleton)
    return decision.with_singletons(matches, own.select(F.col("entity_id").alias("s1_id"))), candidates


def _named(encoder: str | None) -> Callable | None:
    if encoder is None:
        return None
    module, _, name = encoder.partition(":")
    return getattr(importlib.import_module(module), name)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Links records of source 1 to sources 2 and 3.")
    p.add_argument("--mode", choices=("train", "inference", "full"), default="full")
    p.add_argument("--data", required=True, help="folder of the delimited files")
    p.add_argument("--out", required=True)
    p.add_argument("--val-fraction", type=float, default=0.2)
    p.add_argument("--neg-ratio", type=float, default=3.0)
    p.add_argument("--sample-size", type=int)
    p.add_argument("--stress-test", action="store_true")
    p.add_argument("--keep-top1", action="store_true")
    p.add_argument("--encoder", help="MODULE:FUNCTION that makes a text encoder in a worker; adds the embedding retriever")
    a = p.parse_args(argv)
    spark, s = local_session(), Settings(val_fraction=a.val_fraction, neg_ratio=a.neg_ratio, keep_top1=a.keep_top1, encoder=_named(a.encoder))
    if a.mode in ("train", "full"):
        s1, s2, s3, truth = records.load_train(spark, a.data)
        if a.sample_size:
            s1, s2, s3 = profile.sample_training(s1, s2, s3, truth, a.sample_size)
            truth = truth.join(s1.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")
        matcher, quality, blocking = train(s1, s2, s3, truth, s, a.stress_test)
        quality.show(vertical=True)
        blocking.show(vertical=True)
        matcher.save(f"{a.out}/matcher")
    if a.mode in ("inference", "full"):
        matcher = PairMatcher.load(f"{a.out}/matcher")
        s1, s2, s3 = records.load_test(spark, a.data)
        if a.sample_size:
            s1, s2, s3 = profile.sample_test(s1, s2, s3, a.sample_size)
        pred, candidates = infer(matcher, s1, s2, s3, s)
        pred = cut(pred, "pred")
        records.write_matches(pred, f"{a.out}/matching_results.tsv")
        records.write_candidates(candidates, f"{a.out}/candidate_pairs.tsv")
        profile.prediction_summary(pred).show(vertical=True)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
