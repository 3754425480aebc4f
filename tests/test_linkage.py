"""Fusion, cut, decision, evaluation, features, sources and the pipelines on small fixtures."""

import difflib
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from korvane.functions import similarity as sim
from korvane.operators import decision, evaluate, features, fusion, lexical, negatives, profile, stress, vector
from korvane.operators.matcher import PairMatcher
from korvane.plans import linkage, queries
from korvane.session import run_dir
from korvane.sources import records
from korvane.streaming.arrivals import match_arrivals


def _lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return 1 - row[-1] / max(len(a), len(b))


def _jaro_winkler(a, b):
    far = max(0, max(len(a), len(b)) // 2 - 1)
    used, left = [False] * len(b), []
    for i, x in enumerate(a):
        j = next((j for j in range(max(0, i - far), min(len(b), i + far + 1)) if not used[j] and b[j] == x), None)
        if j is not None:
            used[j] = True
            left.append(x)
    right = [y for j, y in enumerate(b) if used[j]]
    m = len(left)
    jaro = (m / len(a) + m / len(b) + (m - sum(x != y for x, y in zip(left, right, strict=True)) // 2) / m) / 3 if m else 0.0
    same = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return jaro + 0.1 * same * (1 - jaro)


def _jaccard(a, b):
    return len(a & b) / len(a | b)


def test_features_of_a_pair(spark):
    cols = "entity_id string, name_clean string, addr_clean string, country_clean string"
    x, y = ("granite harbour holdings", "817 saffron avenue dayton oh"), ("granite harbor hldgs", "817 saffron ave dayton oh")
    s1, pool = spark.createDataFrame([("S1-1", *x, "us")], cols), spark.createDataFrame([("S2-1", *y, "us")], cols)
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-9")], "s1_id string, cand_id string")
    got = features.pair_features(pairs.limit(1), s1, pool).first()
    grams = lambda t, n: {t[i : i + n] for i in range(len(t) - n + 1)}
    want = {"addr_number_agreement": 1.0, "country_match": 1.0, "addr_pin_zip_match": 0.5, "source_is_s2": 1.0, "source_is_s3": 0.0, "addr_both_empty": 0.0, "addr_one_empty": 0.0}
    for side, a, b in (("name", x[0], y[0]), ("addr", x[1], y[1])):
        want |= {f"{side}_levenshtein": _lev(a, b), f"{side}_jaro_winkler": _jaro_winkler(a, b), f"{side}_token_jaccard": _jaccard(set(a.split()), set(b.split()))}
        want |= {f"{side}_char3gram_jaccard": _jaccard(grams(a, 3), grams(b, 3)), f"{side}_length_ratio": min(len(a), len(b)) / max(len(a), len(b))}
        want[f"{side}_token_sort"] = None
    want |= {"name_char4gram_jaccard": _jaccard(grams(x[0], 4), grams(y[0], 4))}
    assert {k: round(got[k], 6) for k, v in want.items() if v is not None} == {k: round(v, 6) for k, v in want.items() if v is not None}
    old = features.pair_features(pairs.limit(1), s1, pool, "difflib").first()
    ratio = lambda a, b: difflib.SequenceMatcher(None, a, b).ratio()
    assert old.name_levenshtein == pytest.approx(ratio(x[0], y[0])) and old.addr_jaro_winkler == pytest.approx(ratio(x[1], y[1]))
    lone = features.pair_features(pairs.where("cand_id = 'S2-9'"), s1, pool).first()  # no such record
    assert (lone.addr_one_empty, lone.country_match, lone.name_token_jaccard) == (1.0, 0.5, 0.0)


def test_suffix_and_acronym_match(spark):
    rows = [("limited", "limited", 1.0), ("limited", "llc", 0.0), ("", "llc", 0.5), ("", "", 0.5)]
    got = spark.createDataFrame(rows, "x string, y string, want double").select("want", sim.suffix_match(F.col("x"), F.col("y")).alias("got"))
    assert all(r.want == r.got for r in got.collect())
    rows = [("ab", "ab", 1.0), ("ab", "abc", 0.0), ("a", "ab", 0.5), ("", "ab", 0.5)]
    got = spark.createDataFrame(rows, "x string, y string, want double").select("want", sim.acronym_match(F.col("x"), F.col("y")).alias("got"))
    assert all(r.want == r.got for r in got.collect())


def test_cut_and_prediction_summaries(spark):
    fused = fusion.rrf(_ranked(spark), {"L": 0.5, "E": 0.5})
    r = fusion.cut_summary(fused, fusion.adaptive_k(fused)).first()
    assert (r.queries, r.mean_before, r.mean_after) == (1, 4.0, 3.0)
    pred = spark.createDataFrame([("a", ["x", "y"]), ("b", []), ("c", ["z"])], "s1_id string, matches array<string>")
    r = profile.prediction_summary(pred).first()
    assert (r.matched, r.singletons, r.total_matches, r.mean_matches) == (2, 1, 3, 1.5)


def test_samples(spark):
    ids = lambda p, n: spark.createDataFrame([(f"{p}{i:02}",) for i in range(n)], "entity_id string")
    truth = spark.createDataFrame([("a00", ["b19", "c18"]), ("a01", []), ("a05", ["b17"])], "s1_id string, matches array<string>")
    s1, s2, s3 = profile.sample_training(ids("a", 10), ids("b", 20), ids("c", 20), truth, 3)
    get = lambda df: sorted(r.entity_id for r in df.collect())
    assert get(s1) == ["a00", "a01", "a02"] and get(s2) == [f"b{i:02}" for i in range(6)] + ["b19"] and get(s3) == [f"c{i:02}" for i in range(6)] + ["c18"]
    assert [len(get(x)) for x in profile.sample_test(ids("a", 10), ids("b", 20), ids("c", 20), 4)] == [4, 8, 8]


def test_text_pairs(spark):
    cols = "entity_id string, combined string"
    pairs = spark.createDataFrame([("a", "b", 1)], "s1_id string, cand_id string, label int")
    assert tuple(negatives.text_pairs(pairs, spark.createDataFrame([("a", "one")], cols), spark.createDataFrame([("b", "two")], cols)).first()[3:]) == ("one", "two")


@pytest.mark.parametrize("which", ["match", "singleton"])
def test_threshold_scores_agree_with_every_threshold_on_its_own(spark, which):
    rng = random.Random(17)
    rows = list({(a, c): (f"s{a}", f"c{c}", round(rng.random(), 2), a) for a, c in ((rng.randint(0, 25), rng.randint(0, 20)) for _ in range(150))}.values())
    scored = spark.createDataFrame(rows, "s1_id string, cand_id string, score double, s1_pos int")
    truth = spark.createDataFrame([(f"s{i}", [f"c{j}" for j in rng.sample(range(21), rng.randint(0, 3))]) for i in range(30)], "s1_id string, matches array<string>").persist()
    points = decision.grid(spark, 0.05, 0.95, 10)
    for r in decision.threshold_scores(scored, truth, points, 0.4, which).collect():
        pred = decision.decide(scored, *((r.t, 0.4) if which == "match" else (0.4, r.t)))
        assert r.macro_f05 == pytest.approx(evaluate.macro_f05(decision.with_singletons(pred, truth), truth).first()[0])


def test_search_over_a_saved_index(spark, tmp_path):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(2000, 16)) + 3 * rng.normal(size=(12, 16))[rng.integers(0, 12, 2000)]
    v[:700] = v[0]  # one cell holds a third of all rows
    v[:700] += 0.01 * rng.normal(size=(700, 16))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "entity_id long, embedding array<float>").persist()
    centres = vector.fit_cells(df, 16)
    records.save_index(vector.assign_cells(df, centres), centres, str(tmp_path / "index"))
    old, vector.BLOCK = vector.BLOCK, 150
    try:
        ids = lambda x: {(r.qid, r.cand_id) for r in x.collect()}
        queries = df.where("entity_id % 20 = 0")
        got, want = ids(vector.search_index(*records.load_index(spark, str(tmp_path / "index")), queries, 5)), ids(vector.exact_topk(df, queries, 5))
    finally:
        vector.BLOCK = old
    assert len(got & want) >= 0.9 * len(want)


def hashing_encoder():
    """A stand-in for a text encoder: counts of hashed words."""

    def encode(texts):
        out = np.zeros((len(texts), 64), np.float32)
        for i, t in enumerate(texts):
            for w in t.split():
                out[i, zlib.crc32(w.encode()) % 64] += 1
        return out

    return encode


def _ranked(spark):
    rows = [("L", "q", "a", 1.0, 1), ("L", "q", "b", 1.0, 2), ("L", "q", "c", 1.0, 3), ("E", "q", "b", 1.0, 1), ("E", "q", "d", 1.0, 2)]
    return spark.createDataFrame(rows, "retriever string, qid string, cand_id string, score double, rank int")


def test_fusion_and_cut(spark):
    fused = fusion.rrf(_ranked(spark), {"L": 0.5, "E": 0.5})
    got = [(r.cand_id, round(r.fused, 6)) for r in fused.orderBy("rank").collect()]
    assert got == [("b", 0.016261), ("a", 0.008197), ("d", 0.008065), ("c", 0.007937)]
    order = lambda df: [r.cand_id for r in df.orderBy("rank").collect()]
    assert order(fusion.adaptive_k(fused)) == ["a", "d", "c"]
    assert order(fusion.adaptive_k(fused, keep_top1=True)) == ["b", "a", "d", "c"]


def _rule(scores, min_k, max_k, gap, min_score):
    """The cut, one list at a time."""
    n = len(scores)
    if n <= min_k:
        return list(range(1, n + 1))
    if n and scores[0] <= 0:
        return list(range(1, min_k + 1))
    out = list(range(1, min_k + 1))
    for r in range(max(min_k, 1) + 1, min(n, max_k) + 1):
        prev, s = scores[r - 2], scores[r - 1]
        if s < min_score or ((prev - s) / prev if prev > 0 else 0) > gap and s < 0.3 * scores[0]:
            break
        out.append(r)
    return out


def test_cut_agrees_with_the_rule(spark):
    rng = random.Random(5)
    lists = {q: sorted((round(rng.random() ** 3, 4) for _ in range(rng.randint(1, 12))), reverse=True) for q in range(60)}
    df = spark.createDataFrame([(q, i, s, i + 1) for q, x in lists.items() for i, s in enumerate(x)], "qid long, cand_id long, fused double, rank int").persist()
    for min_k, max_k, gap, least in ((0, 30, 0.15, 0.001), (2, 5, 0.4, 0.05), (1, 30, 0.1, 0.2)):
        got = {}
        for r in fusion.adaptive_k(df, min_k, max_k, gap, least).collect():
            got.setdefault(r.qid, []).append(r.rank)
        assert {q: sorted(v) for q, v in got.items()} == {q: w for q, x in lists.items() if (w := _rule(x, min_k, max_k, gap, least))}


def test_decide_agrees_with_greedy_claims(spark):
    rng = random.Random(9)
    rows = [(f"s{i}", f"c{rng.randint(0, 25)}", round(rng.random(), 2), i) for i in range(30) for _ in range(rng.randint(0, 6))]
    rows = list({(a, c): (a, c, s, p) for a, c, s, p in rows}.values())
    got = decision.decide(spark.createDataFrame(rows, "s1_id string, cand_id string, score double, s1_pos int"), 0.4, 0.5)
    best = {}
    for a, _, s, _ in rows:
        best[a] = max(best.get(a, 0), s)
    taken, want = set(), set()
    for a in sorted(best, key=lambda a: (-best[a], int(a[1:]))):
        if best[a] >= 0.5:
            own = {(a, c) for x, c, s, _ in rows if x == a and s >= 0.4 and c not in taken}
            want |= own
            taken |= {c for _, c in own}
    assert {(r.s1_id, r.cand_id) for r in got.collect()} == want


def test_evaluate(spark):
    t = "s1_id string, matches array<string>"
    truth = spark.createDataFrame([("S1-1", ["S2-1", "S2-2"]), ("S1-2", []), ("S1-3", ["S3-1"])], t)
    pred = spark.createDataFrame([("S1-1", ["S2-1", "S2-2"]), ("S1-2", []), ("S1-3", [])], t)
    e = evaluate.evaluate(pred, truth).first()
    assert [round(x, 6) for x in (e.macro_f05, e.macro_precision, e.macro_recall, e.micro_precision, e.micro_recall, e.micro_f05)] == [0.666667, 0.666667, 0.666667, 1.0, 0.666667, 0.909091]
    assert (e.total_tp, e.total_fp, e.total_fn, e.singleton_precision, e.singleton_recall) == (2, 0, 1, 0.5, 1.0)


def test_calibration_finds_the_gap(spark):
    rows = [(f"s{i}", f"c{i}", 0.8, i) for i in range(10)] + [(f"s{i}", f"x{i}", 0.45, i) for i in range(10)]
    scored = spark.createDataFrame(rows, "s1_id string, cand_id string, score double, s1_pos int")
    truth = spark.createDataFrame([(f"s{i}", [f"c{i}"]) for i in range(10)], "s1_id string, matches array<string>")
    t = decision.calibrate_match(scored, truth)
    assert 0.45 < t <= 0.8
    assert decision.calibrate_singleton(scored, truth, t) == pytest.approx(0.05)


def test_vectors_ivf_recall(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(400, 8)) + 4 * rng.integers(0, 4, size=(400, 1))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "entity_id long, embedding array<float>").persist()
    ids = lambda x: {(r.qid, r.cand_id) for r in x.collect()}
    exact = ids(vector.exact_topk(df, df, 5))
    want = {(i, int(j)) for i, row in enumerate(v.astype(np.float32).astype(float) @ v.astype(np.float32).astype(float).T) for j in np.argsort(-np.round(row, 9), kind="stable")[:5]}
    assert exact == want
    assert len(exact & ids(vector.ivf_topk(df, df, 5, cells=8, probes=4))) >= 0.9 * len(exact)


def test_negatives(spark):
    ids = lambda p, n: spark.createDataFrame([(f"{p}{i}",) for i in range(n)], "entity_id string")
    barred = spark.createDataFrame([("a0", f"b{j}") for j in range(20)], "s1_id string, cand_id string")
    got = [(r.s1_id, r.cand_id) for r in negatives.random_negatives(ids("a", 10), ids("b", 20), barred, 50).collect()]
    again = [(r.s1_id, r.cand_id) for r in negatives.random_negatives(ids("a", 10), ids("b", 20), barred, 50).collect()]
    assert len(set(got)) == 50 and not any(a == "a0" for a, _ in got) and sorted(got) == sorted(again)


def test_split_is_exact_in_every_stratum(spark):
    truth = spark.createDataFrame([(f"s{i}", ["m"] * (i % 3)) for i in range(300)], "s1_id string, matches array<string>")
    s1 = spark.createDataFrame([(f"s{i}", "x" if i % 2 else "y") for i in range(300)], "entity_id string, country string")
    got = profile.stratified_split(truth, s1).join(truth, "s1_id").join(s1.withColumnRenamed("entity_id", "s1_id"), "s1_id").groupBy("country", F.size("matches")).agg(F.count_if("is_val").alias("n"), F.count("*").alias("m"))
    assert [(r.n, r.m) for r in got.collect()] == [(10, 50)] * 6


def test_tfidf_makes_no_pairs_and_loses_none(spark, monkeypatch):
    monkeypatch.setattr(lexical, "QUERIES", 16)
    rng = random.Random(3)
    name = lambda: " ".join(["works", *(rng.choice("amber birch cedar delta ember flint grove haven".split()) + rng.choice(["", str(rng.randrange(40))]) for _ in range(rng.randrange(3)))])
    rows = lambda p, n: [(f"{p}{i}", name(), rng.choice(["", None, name(), "12 hill"])) for i in range(n)]
    cols = "entity_id string, name_clean string, addr_clean string"
    pool, asked = [*rows("p", 500), ("p7", "amber1 twice", "same id"), (None, "works", "no id")], rows("q", 50)
    model = lexical.fit_tfidf(spark.createDataFrame(pool, cols), max_features=10**9)

    def vectors(rows):
        out = {}
        for i, *texts in rows:
            for f, text in enumerate(texts):
                for w in (text or "").split():
                    w = f" {w} "
                    for g in (w[j : j + n] for n in (3, 4) for j in range(len(w) - n + 1)):
                        own = out.setdefault(i, ({}, {}))[f]
                        own[g] = own.get(g, 0) + 1
        return out

    p, q = vectors(pool), vectors(asked)
    idf = [{}, {}]
    for f in (0, 1):
        df = {}
        for v in p.values():
            for g in v[f]:
                df[g] = df.get(g, 0) + 1
        idf[f] = {g: np.log((1 + len(pool)) / (1 + n)) + 1 for g, n in df.items() if n >= 2}
    weigh = lambda v: [{g: w / np.sqrt(sum(x * x for x in raw.values())) for g, w in raw.items()} for raw in ({g: (1 + np.log(n)) * idf[f][g] for g, n in v[f].items() if g in idf[f]} for f in (0, 1))]
    p, q = {i: weigh(v) for i, v in p.items() if i}, {i: weigh(v) for i, v in q.items()}
    for k in (3, 60):
        frame = lexical.tfidf_topk(model, spark.createDataFrame(asked, cols), k)
        assert "Join" not in frame._jdf.queryExecution().executedPlan().toString()
        want = []
        for a, x in q.items():
            s = {b: sum(c * sum(w * y[f].get(g, 0.0) for g, w in x[f].items()) for f, c in ((0, 0.6), (1, 0.4))) for b, y in p.items()}
            want += [(a, b, n) for n, b in enumerate(sorted((b for b in s if s[b] > 0), key=lambda b: (-round(s[b], 9), b))[:k], 1)]
        assert sorted((r.qid, r.cand_id, r["rank"]) for r in frame.collect()) == sorted(want)


def _left(spark):
    """Names of the cuts that lie in the shared folder."""
    at = Path(run_dir(spark).removeprefix("file://"))
    return {x.name for x in at.iterdir()} if at.exists() else set()


def _kinds(names):
    return sorted(x.rpartition("-")[0] for x in names)


def test_tfidf_leaves_its_best_alone(spark, monkeypatch):
    monkeypatch.setattr(lexical, "QUERIES", 2)
    cut, plans = lexical.cut, []
    monkeypatch.setattr(lexical, "cut", lambda df, *more: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df, *more))
    pool = spark.createDataFrame([(f"p{i}", f"birch {i % 3} works", "") for i in range(20)], "entity_id string, name_clean string, addr_clean string")
    model, before = lexical.fit_tfidf(pool), _left(spark)
    got = lexical.tfidf_topk(model, pool, 30)
    assert _kinds(_left(spark) - before) == ["best"] and got.count() == 400
    assert not any("Join" in p for p in plans)


def test_gbt_scores_keeps_only_its_rows(spark, sf, monkeypatch):
    before, during, train = _left(spark), [], PairMatcher.train
    monkeypatch.setattr(PairMatcher, "train", lambda *a, **b: during.append(_left(spark) - before) or train(*a, **b))
    got = queries.gbt_scores(spark, sf)
    assert _kinds(during[0]) == _kinds(_left(spark) - before) == ["features"]
    assert got.columns == ["s1_id", "cand_id", "label", "score"] and got.where("label = 1").count() == got.count() / 4 > 0


def test_training_is_the_same_in_any_order_of_rows(spark):
    rng = random.Random(4)
    rows = [(i, rng.random(), rng.random(), rng.random(), rng.random() < 0.2) for i in range(14_000)]
    rows = [(*r, int(r[1] + 0.5 * r[2] + rng.gauss(0, 0.3) > 1)) for r in rows]
    df = spark.createDataFrame(rows, "id int, name_levenshtein double, name_jaro_winkler double, addr_levenshtein double, is_val boolean, label int")
    got = []
    for seed in (1, 2):
        own = df.repartition(3 + seed, F.xxhash64(F.lit(seed), "id")).sortWithinPartitions(F.xxhash64(F.lit(seed + 5), "id"))
        model = PairMatcher.train(own.where("not is_val"), own.where("is_val"), rounds=4, depth=3)
        got.append({r.id: r.score for r in model.score(df.select("id", *model.columns)).collect()})
    assert got[0] == got[1]


def test_token_block_joins_only_the_first_ids_of_a_token(spark, monkeypatch):
    rng = random.Random(8)
    cols = "entity_id string, name_clean string, addr_clean string"
    rows = [(f"p{i}", f"{rng.choice(['oak', 'elm', 'ash'])} own{i}", rng.choice([None, "hill", "everywhere"]) if i % 2 else "everywhere") for i in range(900)]
    rows += rows[:30]
    asked = [("q1", "oak hill", ""), ("q2", "elm own7 ash", None), ("q3", "everywhere", "own8"), ("q4", "none", ""), ("q5", None, None)]
    tokens = lambda r: {w for x in r[1:] for w in (x or "").split() if len(w) >= 3}
    df = {}
    for r in rows:
        for w in tokens(r):
            df[w] = df.get(w, 0) + 1
    want = {(q[0], c) for q in asked for c in sorted({r[0] for r in rows if any(df[w] < 0.5 * len(df) for w in tokens(q) & tokens(r))})[:20]}
    joined, plain = [], type(spark.range(0)).distinct
    monkeypatch.setattr(type(spark.range(0)), "distinct", lambda df: joined.append(df.count()) or plain(df))
    got = lexical.token_block(spark.createDataFrame(rows, cols), spark.createDataFrame(asked, cols), most=20, common=0.5).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == want
    assert joined[0] <= 7 * 25


def test_collisions_join_only_the_records_needed(spark, monkeypatch):
    rng = random.Random(5)
    cols = "entity_id string, name_clean string, addr_clean string"
    make = lambda p, n: [(f"{p}{i}", rng.choice(["oak", "elm", "ash", "", f"only {i}"]), rng.choice(["hill", "dale", "", None, f"{i} lane"])) for i in range(n)]
    a, b = make("a", 300), [*make("b", 300), ("b7", "oak", "dale")]
    barred = [(x[0], y[0]) for x in a for y in b[:290] if x[0] < "a13" and x[1] == y[1] != ""]
    want = {}
    for x in a:
        for y in b:
            kinds = [k for k in (0, 1) if x[k + 1] and x[k + 1] == y[k + 1]]
            if kinds:
                want[x[0], y[0]] = min(kinds[0], want.get((x[0], y[0]), 1))
    gone = set(barred)
    order = [p for _, p in sorted(((s, k, c), (s, c)) for (s, c), k in want.items() if (s, c) not in gone)]
    s1, pool, out = spark.createDataFrame(a, cols), spark.createDataFrame(b, cols), spark.createDataFrame(barred, "s1_id string, cand_id string")
    joined, plain = [], negatives.collision_pairs
    monkeypatch.setattr(negatives, "collision_pairs", lambda s, p: joined.append(s.count()) or plain(s, p))
    for n in (0, 1, 700, 10**6):
        got = [(r.s1_id, r.cand_id) for r in negatives.collision_negatives(s1, pool, out, n).collect()]
        assert len(got) == len(set(got)) and set(got) == set(order[:n])
    assert joined[0] < 60 and joined[1] < 150 and joined[2] == 300


def test_stress_changes_scores_and_repeats(spark):
    df = spark.createDataFrame([("S1-1", "Acme Engineering Works Limited Company", "12 Main Rd, Some Town, Some State", "us")], records.RECORD)
    a, b = stress.corrupt(df, 0.5, 1.0).first(), stress.corrupt(df, 0.5, 1.0).first()
    assert a == b and a.business_name != "Acme Engineering Works Limited Company" and a.business_address.count(",") <= 2


def test_tfidf_matches_numpy(spark):
    names = ["acme corp", "acme corporation", "beta works", "a b", "acme acme"]
    pool = spark.createDataFrame([(f"p{i}", n, "") for i, n in enumerate(names)], "entity_id string, name_clean string, addr_clean string")
    got = {(r.qid, r.cand_id): r.score for r in lexical.tfidf_topk(lexical.fit_tfidf(pool, fields={"name_clean": 1.0}), pool, 10).collect()}

    def grams(t):
        out = []
        for w in t.split():
            w = f" {w} "
            out += [w[i : i + n] for n in (3, 4) for i in range(len(w) - n + 1)]
        return out

    docs = [grams(n) for n in names]
    terms = sorted({g for d in docs for g in d if sum(g in x for x in docs) >= 2})
    idf = {g: np.log((1 + len(docs)) / (1 + sum(g in x for x in docs))) + 1 for g in terms}
    m = np.array([[(1 + np.log(d.count(g))) * idf[g] if g in d else 0.0 for g in terms] for d in docs])
    m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    want = {(f"p{i}", f"p{j}"): s for i, r in enumerate(m @ m.T) for j, s in enumerate(r) if s > 0}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d, rng = tmp_path_factory.mktemp("data"), random.Random(3)
    words = "alpha bravo carbon delta ember falcon garnet harbor indigo jasper kernel lumen meadow nectar onyx prairie quartz raven summit timber".split()
    def put(path, rows):
        path.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join("\t".join(r) + "\n" for r in rows), encoding="utf-8")
    for kind in ("train", "test"):
        s1 = [(f"S1-{i}", " ".join(rng.sample(words, 3)) + " Ltd", f"{rng.randint(1, 999)} {rng.choice(words)} Road", rng.choice(["us", "in", "NA"])) for i in range(60)]
        s2 = [(f"S2-{i}", r[1].replace("Ltd", "Limited"), r[2].replace("Road", "Rd."), r[3]) for i, r in enumerate(s1) if i % 3]
        s3 = [(f"S3-{i}", " ".join(rng.sample(words, 3)), f"{rng.randint(1, 999)} {rng.choice(words)} St", "us") for i in range(60)]
        for n, rows in enumerate((s1, s2, s3), 1):
            put(d / f"{kind}_source{n}.tsv", rows)
    truth = {f"S1-{i}": f"S2-{i}" for i in range(60) if i % 3}
    (d / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i}\t{truth.get(f'S1-{i}', '')}\n" for i in range(60)))
    return d


def test_sources(spark, folder):
    s1, _, _, truth = records.load_train(spark, str(folder))
    assert s1.where("country = 'NA'").count() == 0 and s1.where("country = ''").count() > 0
    assert truth.where(F.size("matches") == 0).count() == 20


def test_truth_rows_of_one_record(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("source1_entity_id\tmatched_entity_ids\na\tx, y\na\t z \nb\t\n")
    assert {r.s1_id: r.matches for r in records.load_truth(spark, str(tmp_path / "t.tsv")).collect()} == {"a": ["z"], "b": []}


def test_pipelines_end_to_end(spark, folder, tmp_path):
    settings = linkage.Settings(rounds=5, keep_top1=True)
    matcher, quality, blocking = linkage.train(*records.load_train(spark, str(folder)), settings)
    q, b = quality.first(), blocking.first()
    assert q.macro_f05 > 0.7 and b.recall_ceiling > 0.9
    matcher.save(str(tmp_path / "m"))
    again = type(matcher).load(str(tmp_path / "m"))
    assert (again.match, again.singleton, again.columns) == (matcher.match, matcher.singleton, matcher.columns)
    pred, candidates = linkage.infer(again, *records.load_test(spark, str(folder)), settings)
    records.write_matches(pred, str(tmp_path / "out"))
    records.write_candidates(candidates, str(tmp_path / "cand"))
    lines = next((tmp_path / "out").glob("part-*")).read_text().splitlines()
    assert lines[0] == "source1_entity_id\tmatched_entity_ids" and len(lines) == 61
    records.load_records(spark, str(folder / "test_source1.tsv")).write.parquet(str(tmp_path / "arrivals"))
    arriving = spark.readStream.schema(records.RECORD).parquet(str(tmp_path / "arrivals"))
    _, s2, s3 = records.load_test(spark, str(folder))
    match_arrivals(arriving, s2, s3, again, str(tmp_path / "matched"), str(tmp_path / "state"), settings, once=True).awaitTermination()
    assert {(r.s1_id, tuple(r.matches)) for r in spark.read.parquet(str(tmp_path / "matched")).collect()} == {(r.s1_id, tuple(r.matches)) for r in pred.collect()}
    claimed = [c for x in lines[1:] for c in x.split("\t")[1].split(",") if c]
    assert len(claimed) == len(set(claimed)) > 20


def test_command_line_with_embeddings_noise_and_samples(spark, folder, tmp_path, capfd):
    assert linkage.main(["--data", str(folder), "--out", str(tmp_path), "--sample-size", "50", "--stress-test", "--keep-top1", "--encoder", "tests.test_linkage:hashing_encoder"]) == 0
    assert "macro_f05" in capfd.readouterr().out
    for name, column in (("matching_results", "matched_entity_ids"), ("candidate_pairs", "candidate_entity_ids")):
        got = spark.read.option("sep", "\t").option("header", True).csv(f"{tmp_path}/{name}.tsv")
        assert got.columns == ["source1_entity_id", column] and [r[0] for r in got.collect()] == sorted(r[0] for r in got.collect())
    matcher = PairMatcher.load(f"{tmp_path}/matcher")
    assert {"retrieval_lexical_rank", "retrieval_embedding_score", "retrieval_found_in_n"} <= set(matcher.columns)
    gains = matcher.importance()
    assert [n for n, _ in gains] and gains == sorted(gains, key=lambda x: (-x[1], x[0])) and sum(g for _, g in gains) == pytest.approx(1)
