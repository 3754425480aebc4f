"""Toxicity by a learned lexicon, matched by Levenshtein automata, with context windows.

The lexicon comes from a bounded sample of labelled rows, near copies counted once: words,
and beginnings of families of words, that toxic rows hold more often than chance can
explain. A candidate is tested by the rows that hold it (Chernoff's bound of the binomial
tail against the share of toxic rows, corrected for how many candidates could pass at
all), and its weight is the lower bound of how much more frequent it is in toxic rows. Of
nested candidates the one stays that says most by all its occurrences. Words that no clean
row holds and that weigh SURE or more allow edits.

The lexicon forms a trie. The Levenshtein automata of all terms are intersected with the trie
by a subset construction that is made as words call for it: a state is a set of (node,
edits) pairs, transitions are remembered, and most words leave the automaton after a few
letters. So misspelled terms are caught at about the price of exact lookups. Words near a
term that clean rows hold too are no misspellings and are spared.

Each hit then gets the weight of its term, less where clean rows hold the term too and the
text is too long for so few hits (the log likelihood of its hits as Poisson draws), and is put to one of two sides by a score of
its window: quotation (quote marks around it, words of reporting) or abuse (none of that,
words of address, further hits near by). Words of both kinds are given ones and those that
the windows of hits in clean and in toxic rows tell apart. A logistic regression over the
sums for each side and the hits' share of the text, held near prior weights, gives the score.

Defined cases: null and empty texts get the score of a text without hits; without
labelled rows the lexicon is empty; rows are handled one by one, so ties and repeats need
no rule; labels for unknown documents are ignored, of several labels of a document the
largest counts; empty tables give no rows; other columns stay.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korvane.llm.common import Hidden, trim, trimming
from korvane.llm.langid import held_out
from korvane.llm.shingles import shingle_set
from korvane.session import cut, pick, release

#: Labelled rows to learn from, about, at most; terms in the lexicon, at most (those surest first); words spared, at most.
TRAIN_ROWS, TERMS, SPARED = 20_000, 5_000, 50_000
#: Chance that any term is one by accident; least toxic rows that hold it; least log of how much more frequent it is in toxic rows, and that of full weight.
ALPHA, SUPPORT, LIFT, FULL = 0.01, 5, 2.0, 5.0
#: Lengths of word beginnings; the share of a beginning's evidence that a longer one must keep to stand for it.
STEMS, SAME = (3, 4, 5, 6, 7, 8), 0.9
#: Learned words of reporting and of address, of each at most.
CONTEXT = 200
#: Words on each side of a hit that its window has.
AROUND = 8
#: Edits that a term of this length or more allows, and the least weight of a term that allows any.
EDITS, SURE = ((9, 2), (4, 1)), 0.5
#: States and words that a worker remembers.
CACHE = 100_000
_TOKEN = re.compile(r"[^\W_]+(?:[@$*!'’][^\W_]+)*")
#: Signs written for letters; quotation marks; words of reporting; words of address.
SIGNS = str.maketrans("013457@$!", "oieastasi")
QUOTES = "\"“”„«»"
REPORT = frozenset("said says saying quote quoted quotes quoting wrote writes written called calls reported reports term word words phrase slur insult insults means definition".split())
ADDRESS = frozenset("you your you're youre u ur yourself are such stupid go shut".split())
#: Prior weights: base, abuse, quotation, misspelled abuse, misspelled quotation, hits' share of the words; how firmly they are held.
PRIOR, HOLD = np.array([-4.0, 5.0, 1.8, 3.6, 0.8, 1.0]), 0.02


def edits_of(term: str) -> int:
    return next((k for n, k in EDITS if len(term) >= n), 0)


class Automaton:
    """The union of the Levenshtein automata of the terms, run over their trie. Terms that end in * match words that begin so; those and the terms exact allow no edits."""

    def __init__(self, weights: dict[str, float], exact: frozenset[str] = frozenset()):
        self.weights = weights
        self.edits = {t: 0 if t.endswith("*") or t in exact or w < SURE else edits_of(t) for t, w in weights.items()}
        self.next: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.most: list[int] = [0]  # edits that any term below a node allows
        for term in weights:
            word, k, at = term.rstrip("*"), self.edits[term], 0
            self.most[0] = max(self.most[0], k)
            for c in word:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.term.append(None)
                    self.stem.append(None)
                    self.most.append(0)
                at = self.next[at][c]
                self.most[at] = max(self.most[at], k)
            if term.endswith("*"):
                self.stem[at] = term
            else:
                self.term[at] = term
        self._reset()

    def _reset(self) -> None:
        self.sets: list[frozenset] = []
        self.ids: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []
        self.start = self._state({(0, 0)}, None)
        self.found: dict[str, tuple[str, int] | None] = {}

    def _state(self, pairs: set[tuple[int, int]], stem: str | None) -> int:
        """The state of these (node, edits) pairs, with letters left out of the word; stem: a beginning met on the way."""
        todo, least = list(pairs), {}
        while todo:
            node, e = todo.pop()
            if least.get(node, 99) <= e:
                continue
            least[node] = e
            todo += [(x, e + 1) for x in self.next[node].values() if e < self.most[x]]
        stem = next((self.stem[x] for x, e in sorted(least.items()) if e == 0 and self.stem[x]), None) or stem
        key = frozenset([*least.items(), stem] if stem else least.items())
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
        return self.ids[key]

    def _step(self, state: int, c: str) -> int:
        out, stem = set(), None
        for x in self.sets[state]:
            if isinstance(x, str):
                stem = x
                continue
            node, e = x
            for d, child in self.next[node].items():
                if d == c:
                    out.add((child, e))
                elif e < self.most[child]:
                    out.add((child, e + 1))
            if e < self.most[node]:
                out.add((node, e + 1))
        self.moves[state][c] = got = self._state(out, stem) if out or stem else -1
        return got

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) with the fewest edits that a word matches."""
        if word in self.found:
            return self.found[word]
        if len(self.found) > CACHE or len(self.sets) > CACHE:
            self._reset()
        state = self.start
        for c in word:
            to = self.moves[state].get(c)
            state = self._step(state, c) if to is None else to
            if state < 0:
                break
        best = None
        if state >= 0:
            for x in self.sets[state]:
                if isinstance(x, str):
                    got = (x, 0)
                else:
                    term = self.term[x[0]]
                    if term is None or x[1] > self.edits[term]:
                        continue
                    got = (term, x[1])
                if best is None or (got[1], got[0]) < (best[1], best[0]):
                    best = got
        self.found[word] = best
        return best


class Model:
    """The lexicon's automaton, the words of context and the weights of the logistic regression."""

    def __init__(self, weights: dict[str, float], rates: dict[str, float] | None = None, beta: np.ndarray = PRIOR, spared: frozenset[str] = frozenset(), report: frozenset[str] = REPORT, address: frozenset[str] = ADDRESS):
        """rates: how much more often a word of toxic texts than one of clean texts is the term; spared: words near a term that are words of clean texts."""
        self.automaton, self.rates, self.beta, self.spared, self.report, self.address = Automaton(weights, frozenset(rates or ())), rates or {}, beta, spared, report, address

    def __reduce__(self):
        return Model, (self.automaton.weights, self.rates, self.beta, self.spared, self.report, self.address)

    def word(self, token: str) -> tuple[str, int] | None:
        if token in self.spared:
            return None
        got = self.automaton.match(token)
        if got is None and not token.isalpha():
            plain = token.translate(SIGNS).replace("*", "").replace("'", "").replace("’", "")
            got = self.automaton.match(plain)
            got = got and (got[0], got[1] + 1)
        return got

    def near(self, text: str) -> tuple[int, list[tuple[int, int, str, int, str, str, list[str]]]]:
        """The count of words, and (start, end, term, edits, text before, text after, words) of every hit and its window."""
        low = text.lower()
        words = _TOKEN.findall(low)
        known = {t: h for t in set(words) if (h := self.word(t))}
        if not known:
            return len(words), []
        if len(low) != len(text):  # a character whose lower case is longer: offsets are those of the lowered text
            text = low
        tokens = [(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(low)]
        out = []
        for i, (a, b, token) in enumerate(tokens):
            if token in known:
                lo, hi = max(0, i - AROUND), min(len(tokens), i + AROUND + 1)
                out.append((a, b, *known[token], text[tokens[lo][0] : a], text[b : tokens[hi - 1][1] + 1], words[lo:hi]))
        return len(words), out

    def hits(self, text: str) -> tuple[int, list[tuple[int, int, str, int, float]]]:
        """The count of words, and (start, end, term, edits, quotation between 0 and 1) of every hit."""
        n, found = self.near(text)
        out = []
        for a, b, term, edits, left, right, words in found:
            marks = any(q in left for q in QUOTES) and any(q in right for q in QUOTES)
            others = sum(not (w in self.spared or self.word(w) is None) for w in words) - 1
            quote = 1.6 * marks + 1.2 * sum(w in self.report for w in words) - 0.8 * sum(w in self.address for w in words) - 0.8 * others - 0.8
            out.append((a, b, term, edits, 1 / (1 + math.exp(-2 * quote))))
        return n, out

    def features(self, n: int, hits: list[tuple[int, int, str, int, float]]) -> np.ndarray:
        """1, the weights of hits by side, exact and misspelled, each sum bent to stay below 2, and all weights to 100 words."""
        f = np.zeros(6)
        f[0] = 1
        k = Counter(term for _, _, term, _, _ in hits)
        for _, _, term, edits, quote in hits:
            w = self.automaton.weights[term]
            w *= max(0.0, 1 - n * self.rates.get(term, 0.0) / (k[term] * w * FULL))
            f[1 + 2 * (edits > 0)] += w * (1 - quote)
            f[2 + 2 * (edits > 0)] += w * quote
            f[5] += w * 100 / max(n, 50)
        f[1:] = 2 * np.tanh(f[1:] / 2)
        return f

    def score(self, n: int, hits: list[tuple[int, int, str, int, float]]) -> float:
        return float(1 / (1 + np.exp(-self.features(n, hits) @ self.beta)))


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression held near PRIOR, by Newton steps; rows weigh so that either label weighs the same."""
    beta = PRIOR.copy()
    if not len(y) or y.min() == y.max():
        return beta
    w = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float((w * (np.logaddexp(0, z) - y * z)).sum() + HOLD / 2 * ((b - PRIOR) ** 2).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        grad = x.T @ (w * (p - y)) + HOLD * (beta - PRIOR)
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + HOLD * np.eye(len(beta)), grad)
        size = 1.0
        while size > 1e-6 and loss(beta - size * step) > loss(beta):  # a whole step may go too far
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    beta[1:] = np.maximum(beta[1:], 0)  # a hit never speaks for a clean text
    return beta


def _distinct_rows(rows: DataFrame) -> DataFrame:
    """text, toxic of labelled rows, one row of near copies of one label: those that share their least shingle of three words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = [int(x[0]) - 2**63 if len(x := shingle_set(t.as_py(), 3)) else None for t in batch.column(0)]
            yield pa.record_batch([pa.array(least, pa.int64()), batch.column(0), batch.column(1)], names=["sign", "text", "toxic"])

    signed = rows.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(trimming(sign), "sign long, text string, toxic int")
    return signed.where("sign is not null").groupBy("sign", "toxic").agg(F.max("text").alias("text")).select("text", "toxic")


def _counted(rows: DataFrame, terms) -> DataFrame:
    """term, t, c (toxic and clean rows that hold it), tn, cn (how often) of terms(text), a Counter; "" counts rows and words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, often = (Counter(), Counter()), (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                got = terms(text.as_py() or "")
                held[toxic].update(got.keys())
                often[toxic].update(got)
        own = sorted(held[0].keys() | held[1].keys())
        yield pa.record_batch([pa.array(own, pa.string()), *(pa.array([x[w] for w in own], pa.int64()) for x in (held[1], held[0], often[1], often[0]))], names=["term", "t", "c", "tn", "cn"])

    got = rows.mapInArrow(trimming(count), "term string, t long, c long, tn long, cn long")
    return got.groupBy("term").agg(*[F.sum(x).alias(x) for x in ("t", "c", "tn", "cn")])


def _words(text: str) -> Counter:
    """Words of a text, beginnings of words (marked by *), and "" for all words."""
    words = Counter(_TOKEN.findall(text.lower()))
    out = Counter({"": words.total()})
    for w, n in words.items():
        if len(w) >= STEMS[0]:
            out[w] += n
        if w.isalpha():
            for k in STEMS:
                if len(w) > k:
                    out[w[:k] + "*"] += n
    return out


def _evidence(base: Column) -> Column:
    """Chernoff's bound, as a negative log, of the chance of t of t + c rows or more where each is of a kind with the share base."""
    n = F.col("t") + F.col("c")
    p = F.col("t") / n
    kl = F.when(p > 0, p * F.log(p / base)).otherwise(0.0) + F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - base))).otherwise(0.0)
    return F.when(p > base, n * kl).otherwise(0.0)


def _significant(counts: DataFrame, base: float, alpha: float) -> DataFrame:
    """counts with evidence, of those that chance explains with less than alpha among all that could pass; toxic rows have the share base."""
    n = F.col("t") + F.col("c")
    size = {r.n: r["count"] for r in counts.groupBy(F.least(n, F.lit(200)).alias("n")).count().collect()}  # 200 rows
    # Candidates of so few rows that even all of one kind would be no evidence are not tried.
    least = next((k for k in range(1, 201) if k * -math.log(base) >= math.log(max(1, sum(v for x, v in size.items() if x >= k)) / alpha)), 201)
    tried = max(1, sum(v for x, v in size.items() if x >= least))
    return counts.withColumn("evidence", _evidence(F.lit(base))).where((n >= least) & (F.col("evidence") >= math.log(tried / alpha)))


def learn_lexicon(rows: DataFrame, terms: int = TERMS) -> tuple[dict[str, float], dict[str, float], frozenset[str]]:
    """Terms with weights and with rates from labelled rows (text, toxic), and words near a term that clean rows hold as often."""
    counts = _counted(rows, _words).persist()
    all_ = counts.where("term = ''").first()
    if all_ is None or not all_.t or not all_.c:
        counts.unpersist()
        return {}, {}, frozenset()
    own = counts.where("term <> ''")
    lift = F.log((F.col("tn") + 0.5) / (F.col("cn") + 0.5) * F.lit(all_.cn / all_.tn)) - 1.64 * F.sqrt(1 / (F.col("tn") + 0.5) + 1 / (F.col("cn") + 0.5))
    n, base = F.col("tn") + F.col("cn"), all_.tn / (all_.tn + all_.cn)
    gain = F.col("tn") * F.log(F.col("tn") / n / base) + F.when(F.col("cn") > 0, F.col("cn") * F.log(F.col("cn") / n / (1 - base))).otherwise(0.0)
    good = _significant(own, all_.t / (all_.t + all_.c), ALPHA).withColumns({"lift": lift, "gain": gain}).where((F.col("lift") >= LIFT) & (F.col("t") >= SUPPORT))
    found = {r.term: r for r in good.orderBy(F.desc("evidence"), "term").limit(terms).collect()}
    weights: dict[str, float] = {}
    closed: set[str] = set()  # all that is nested with a chosen term
    for term in sorted(found, key=lambda x: (-found[x].gain, x)):
        if term in closed:
            continue
        stem = term.rstrip("*")
        longer = [x for x in found if x not in closed and x.startswith(stem) and found[x].gain >= SAME * found[term].gain] if term.endswith("*") else [term]
        best = max(longer, key=lambda x: (not x.endswith("*"), len(x), x))
        weights[best] = min(1.0, found[best].lift / FULL)
        stem, family = best.rstrip("*"), best.endswith("*")
        closed |= {x for x in found if (family and x.startswith(stem)) or (x.endswith("*") and stem.startswith(x[:-1]))} | {best}
    rates = {x: r.tn / all_.tn - r.cn / all_.cn for x in weights if (r := found[x]).c}
    shared = rows.sparkSession.sparkContext.broadcast(Model(weights, rates))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [(h := shared.value.word(w.as_py())) is not None and h[1] > 0 for w in batch.column(0)]
            yield batch.filter(pa.array(hit, pa.bool_()))

    clean = own.where(~F.col("term").endswith("*") & (F.col("c") > 0) & (F.col("t") <= F.col("c"))).select("term", "c").mapInArrow(trimming(near), "term string, c long")
    spared = frozenset(r.term for r in clean.orderBy(F.desc("c"), "term").limit(SPARED).collect())
    counts.unpersist()
    return weights, rates, spared


def learn_context(rows: DataFrame, model: Model, most: int = CONTEXT) -> tuple[frozenset[str], frozenset[str]]:
    """Words of reporting and of address: REPORT and ADDRESS, and words that the windows of one term hold in clean rows (or in toxic ones) more often than chance explains, given how often that term is in rows of either kind."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def around(text: str) -> Counter:
        m = shared.value
        return Counter({f"{term} {w}" for _, _, term, _, _, _, words in m.near(text)[1] for w in ["", *words] if not w or m.word(w) is None})

    pair = _counted(rows, around).select(F.substring_index("term", " ", 1).alias("of"), F.substring_index("term", " ", -1).alias("word"), "t", "c").persist()
    whole = pair.where("word = ''").select(F.col("of").alias("w_of"), F.col("t").alias("wt"), F.col("c").alias("wc")).where((F.col("wt") >= SUPPORT) & (F.col("wc") >= SUPPORT))
    own = pair.where("word <> ''").join(F.broadcast(whole), F.col("of") == F.col("w_of")).where(F.col("t") + F.col("c") >= SUPPORT)  # a row a term at most
    tried, out = max(1, own.count()), []
    for kind, other, given in (("c", "t", REPORT), ("t", "c", ADDRESS)):
        same = own.select("word", F.col(kind).alias("t"), F.col(other).alias("c"), (F.col("w" + kind) / (F.col("wt") + F.col("wc"))).alias("base"))
        best = same.withColumn("evidence", _evidence(F.col("base"))).where(F.col("evidence") >= math.log(tried / ALPHA))
        out.append(given | {r.word for r in best.groupBy("word").agg(F.max("evidence").alias("evidence")).orderBy(F.desc("evidence"), "word").limit(most).collect()})
    pair.unpersist()
    return tuple(out)


def train(labelled: DataFrame, most: int = TRAIN_ROWS, seed: int = 5) -> Model:
    """A model from a sample of labelled rows (text, toxic, and a key to sample by): about `most` of them at most."""
    total = labelled.count()
    draw = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1_000_000)) / 1e6
    rows = cut(_distinct_rows(labelled.where(draw < min(1.0, most / max(1, total)))), "labelled")
    weights, rates, spared = learn_lexicon(rows)
    report, address = learn_context(rows, Model(weights, rates, spared=spared))
    prior = Model(weights, rates, PRIOR, spared, report, address)
    shared = rows.sparkSession.sparkContext.broadcast(prior)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = np.array([shared.value.features(*shared.value.hits(t.as_py() or "")) for t in batch.column(0)]).reshape(-1, len(PRIOR))
            yield pa.record_batch([*(pa.array(f[:, i]) for i in range(1, len(PRIOR))), batch.column(1)], names=[*names, "y"])

    names = [f"f{i}" for i in range(1, len(PRIOR))]
    got = rows.select("text", F.col("toxic").cast("double").alias("y")).mapInArrow(trimming(features), ", ".join(f"{x} double" for x in [*names, "y"])).toArrow()  # `most` rows of numbers
    release(rows)
    x = np.column_stack([np.ones(got.num_rows), *(got.column(n).to_numpy() for n in names)])
    return Model(weights, rates, fit(x, got.column("y").to_numpy()), spared, report, address)


def _scored(own: Hidden, model: Model, with_hits: bool) -> DataFrame:
    """The hidden frame with t_score, and with t_hits where asked for."""
    shared = own.df.sparkSession.sparkContext.broadcast(model)
    kinds = {"start": pa.int32(), "stop": pa.int32(), "term": pa.string(), "edits": pa.int32(), "quotation": pa.float64()}

    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for texts in batches:
            got = [m.hits(t.as_py() or "") for t in texts]
            scores = pa.array([m.score(*x) for x in got], pa.float64())
            if not with_hits:
                yield scores
                continue
            hits = [h for _, h in got]
            flat = [x for h in hits for x in h]
            fields = [pa.array([x[i] for x in flat], kind) for i, kind in enumerate(kinds.values())]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, hits)]), pa.int32()), pa.StructArray.from_arrays(fields, names=list(kinds)))
            yield pa.StructArray.from_arrays([scores, lists], names=["score", "hits"])
        trim()

    each.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    if not with_hits:
        return own.df.withColumn("t_score", F.arrow_udf(each, "double")("text"))
    got = F.arrow_udf(each, "struct<score:double,hits:array<struct<start:int,stop:int,term:string,edits:int,quotation:double>>>")("text")
    return own.df.withColumn("t_got", got).select(*own.private, F.col("t_got.score").alias("t_score"), F.col("t_got.hits").alias("t_hits"))


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score and hits (start, stop, term, edits, quotation) after its own columns."""
    own = Hidden(docs, "text")
    return own.shown(_scored(own, model, True).withColumnsRenamed({"t_score": "score", "t_hits": "hits"}), "score", "hits")


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic, key of the documents that have a label and are not held out."""
    toxic = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"), 5, 0)).groupBy(F.col("doc_id").alias("l_id")).agg(F.max("toxic").alias("toxic"))
    return pick(docs, "doc_id", "text").join(toxic, F.col("doc_id") == F.col("l_id")).select("text", "toxic", F.col("doc_id").alias("key"))


def sample_labels(labels: DataFrame, most: int, seed: int = 5) -> DataFrame:
    """About `most` of the labels, at most, drawn by document."""
    total = labels.count()
    return labels.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) / 1e6 < min(1.0, most / max(1, total)))


def trained(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """A model from documents and their labels, without the held-out rows."""
    own = pick(labels, "doc_id", "toxic").where(~held_out(F.col("doc_id"), 5, 0))
    rows = labelled_rows(docs, sample_labels(own, most)).persist()
    try:
        return train(rows, most)
    finally:
        rows.unpersist()


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_hits."""
    got = score_texts(pick(docs, "doc_id", "text"), trained(docs, labels))
    return got.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("hits").cast("long").alias("n_hits"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that score 0.5 or more."""
    own = Hidden(docs, "text")
    return own.shown(_scored(own, trained(docs, labels), False).where("t_score < 0.5"))
