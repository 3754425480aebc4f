"""Language identification: script ranges, then Viterbi over the scores of words.

Learned from a bounded sample of labelled rows: how often each language uses each
script, and the relative frequency of character 1- to 3-grams of its words. A word is a run
of letters and their marks, cut where its characters change script. The script narrows a
word's candidates to the languages that use it; the n-grams score those. The path through
the document's words that maximises the summed scores less SWITCH for each change of
language (Viterbi) labels spans of mixed text; no path goes through a language whose script
does not fit a word. The document's language is the one with most letters.

Words of more than PIECE characters, as in scripts without spaces, are steps of PIECE
characters to the path, so that the language may change within; their n-grams are those of
the whole word, each counted once. Texts are split and words looked up for a batch at a
time, in Arrow; only words that a worker does not remember are scored.

Defined cases: null text and text without letters are `und` with score 0 and no spans;
words in scripts that no learned language uses are left out, and a text with only such
words gets the language of most training letters with score 0; rows without lang are not
learned from; without any training row all is `und`; ties go to the lesser language name;
rows are handled one by one; an empty table gives no rows; other columns stay.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from korvane.llm.common import Hidden, trim, trimming
from korvane.session import pick

#: Rows of a language to learn from, at most about; n-grams in the model, of which each language has an equal share; words whose scores a worker remembers.
TRAIN_ROWS, GRAMS, CACHE = 3000, 400_000, 300_000
#: Cost of a change of language, in nats; what speaks against a language that does not use a word's script.
SWITCH, NEVER = 14.0, 1e9
#: A language uses a script that has at least this share of its letters.
SCRIPT_SHARE = 0.02
#: Characters of a step of the path, at most.
PIECE = 40
#: Languages up to which Python's lists are quicker than numpy's arrays in a step of the path.
FEW = 12
_LATIN = re.compile("[A-Za-zªµºÀ-ÖØ-öø-ɏ]+")
_APART = r"[^\p{L}\p{M}]+"
#: First and last code point of scripts.
SCRIPTS = (
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x6FF),
    ("syriac", 0x700, 0x74F), ("arabic", 0x750, 0x77F), ("arabic", 0x8A0, 0x8FF), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("gurmukhi", 0xA00, 0xA7F),
    ("gujarati", 0xA80, 0xAFF), ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F), ("kannada", 0xC80, 0xCFF), ("malayalam", 0xD00, 0xD7F), ("sinhala", 0xD80, 0xDFF),
    ("thai", 0xE00, 0xE7F), ("lao", 0xE80, 0xEFF), ("tibetan", 0xF00, 0xFFF), ("myanmar", 0x1000, 0x109F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF),
    ("ethiopic", 0x1200, 0x139F), ("khmer", 0x1780, 0x17FF), ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF), ("han", 0xF900, 0xFAFF), ("arabic", 0xFB50, 0xFDFF), ("arabic", 0xFE70, 0xFEFE), ("han", 0x20000, 0x323AF),
)


def script_of(c: str) -> str:
    x = ord(c)
    return next((s for s, a, b in SCRIPTS if a <= x <= b), "other")


def runs_of(word: str) -> list[tuple[str, str]]:
    """(script, part) of a run of letters and marks, cut where the script changes. Marks and letters of no listed script stay with those before them; without a letter there is none."""
    if not word:
        return []
    if _LATIN.fullmatch(word):
        return [("latin", word)]
    out: list[list[str]] = []
    letter = False
    for c in word:
        own = unicodedata.category(c)[0] == "L"
        letter |= own
        script = script_of(c) if own else None
        if not out or (script not in (None, "other") and out[-1][0] not in (script, None)):
            out.append([script, c])
        else:
            out[-1][0] = out[-1][0] or script
            out[-1][1] += c
    return [(s or "other", w) for s, w in out] if letter else []


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(ends, index, words): the distinct words of lower-cased texts, the index of each word of all texts, and where each text's end (from 0)."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), _APART)
    coded = lists.flatten().dictionary_encode()
    return np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64), coded.indices.to_numpy(), coded.dictionary.to_pylist()


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def grams_of(part: str) -> list[str]:
    """The 1- to 3-grams of a part of one script, bounded by spaces."""
    w = f" {part} "
    return [*part, *(w[i : i + 2] for i in range(len(w) - 1)), *(w[i : i + 3] for i in range(len(w) - 2))]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _key(*chars: np.ndarray) -> np.ndarray:
    """A number for each n-gram of at most three code points."""
    out = np.zeros(len(chars[0]), np.uint64)
    for c in chars:
        out = out << np.uint64(21) | c
    return out


class Model:
    """Scores of n-grams by language, and the languages of scripts."""

    def __init__(self, counts: pd.DataFrame):
        """counts: lang, gram, n, where grams that start with '#' are scripts and their characters."""
        self.langs = sorted(counts["lang"].unique())
        at = {x: i for i, x in enumerate(self.langs)}
        script = counts[counts["gram"].str.startswith("#")]
        letters = script.groupby("lang")["n"].sum()
        self.scripts: dict[str, np.ndarray] = {}
        for lang, gram, n in script[["lang", "gram", "n"]].itertuples(index=False):
            if n >= SCRIPT_SHARE * letters[lang]:
                self.scripts.setdefault(gram[1:], np.zeros(len(at), bool))[at[lang]] = True
        self.most = max(self.langs, key=lambda x: letters.get(x, 0)) if self.langs else "und"
        grams = counts[~counts["gram"].str.startswith("#")]
        table = grams.pivot_table(index="gram", columns="lang", values="n", fill_value=0.0).reindex(columns=self.langs, fill_value=0.0)
        raw, size = table.to_numpy(float).reshape(len(table), len(self.langs)), np.array([len(g) for g in table.index], int)
        self.keys, self.logs = [], []
        for k in (1, 2, 3):  # shares within n-grams of one length; the last row is that of unknown n-grams
            part = raw[size == k] + 0.5
            codes = _codes("".join(g for g in table.index if len(g) == k)).reshape(-1, k)
            keys = _key(*(codes[:, i] for i in range(k)))
            order = np.argsort(keys)
            self.keys.append(keys[order])
            self.logs.append(np.vstack([np.log(part / part.sum(0))[order], np.zeros((1, len(self.langs)))]).astype(np.float32))
        self._forget()

    def _forget(self) -> None:
        self.words: dict[str, tuple[int, ...]] = {}  # the steps of a word; () without letters
        self.table = np.zeros((1024, len(self.langs)), np.float32)  # row 0: steps that are not scored
        self.size = np.zeros(1024, np.int32)
        self.used = 1

    def _logs(self, *chars: np.ndarray) -> np.ndarray:
        """The row of every n-gram."""
        known, key = self.keys[len(chars) - 1], _key(*chars)
        at = np.minimum(np.searchsorted(known, key), max(0, len(known) - 1))
        return self.logs[len(chars) - 1][np.where(known[at] == key, at, len(known)) if len(known) else np.zeros(len(key), np.int64)]

    def scores(self, parts: list[str], starts: list[int]) -> np.ndarray:
        """The summed scores of steps that begin at starts (counted over the characters of all parts, one after the other).

        An n-gram counts in the step of its only, second or middle character; a part's last two characters in that of its last.
        """
        code = _codes(f" {' '.join(parts)} ")
        at = np.flatnonzero(code != 32)
        total = self._logs(code[at]) + self._logs(code[at - 1], code[at]) + self._logs(code[at - 1], code[at], code[at + 1])
        last = np.flatnonzero(code[at + 1] == 32)
        total[last] += self._logs(code[at[last]], code[at[last] + 1])
        return np.add.reduceat(total, starts, axis=0, dtype=np.float64)

    def learn(self, words: list[str]) -> None:
        """Puts a row of scores for every step of new words into the table: 0 for the best language, less for others."""
        if len(self.words) > CACHE:
            self._forget()
        new = [w for w in words if w not in self.words]
        for i in range(0, len(new), 20_000):
            self._learn(new[i : i + 20_000])

    def _learn(self, words: list[str]) -> None:
        parts, starts, can, sizes, size, row = [], [], [], [], 0, self.used
        for w in words:
            steps = []
            for script, part in runs_of(w):
                langs = self.scripts.get(script)
                if langs is None:
                    steps.append(0)
                    continue
                parts.append(part)
                for a in range(0, len(part), PIECE):
                    starts.append(size + a)
                    can.append(langs)
                    sizes.append(min(PIECE, len(part) - a))
                    steps.append(row)
                    row += 1
                size += len(part)
            self.words[w] = tuple(steps)
        if not parts:
            return
        s = np.where(np.array(can), self.scores(parts, starts), -np.inf)
        s = np.maximum(s - s.max(1, keepdims=True), -NEVER)
        while row > len(self.table):
            self.table, self.size = np.vstack([self.table, np.zeros_like(self.table)]), np.append(self.size, np.zeros_like(self.size))
        self.table[self.used : row] = s
        self.size[self.used : row] = sizes
        self.used = row

    def spans(self, texts: pa.Array) -> Iterator[tuple[bool, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of every text: whether it has a letter, and of its spans the first and the last word (from 0), language and letters."""
        ends, index, words = split_words(texts)
        if not self.langs:
            has = np.array([bool(runs_of(w)) for w in words], bool)[index]
            none = np.empty(0, np.int64)
            yield from ((bool(has[a:b].any()), none, none, none, none) for a, b in zip(ends, ends[1:], strict=False))
            return
        self.learn(words)
        steps = [self.words[w] for w in words]
        n = np.fromiter(map(len, steps), np.int64, len(steps))
        flat = np.fromiter((x for s in steps for x in s), np.int64, int(n.sum()))
        first = np.cumsum(n) - n
        each = n[index]  # steps of the words of all texts
        done = np.append(0, np.cumsum(each))
        row = flat[np.repeat(first[index] - done[:-1], each) + np.arange(done[-1])]
        word = np.cumsum(each > 0) - 1  # words without a letter are none
        at_word = np.repeat(word, each)
        for a, b in zip(ends, ends[1:], strict=False):
            lo, hi = done[a], done[b]
            own = row[lo:hi]
            keep = np.flatnonzero(own)
            own = own[keep]
            if not len(own):
                none = np.empty(0, np.int64)
                yield bool(hi > lo), none, none, none, none
                continue
            path = viterbi(self.table[own], SWITCH)
            cuts = np.append(0, np.flatnonzero(path[1:] != path[:-1]) + 1)
            at = at_word[lo:hi][keep] - at_word[lo]
            yield True, at[cuts], at[np.append(cuts[1:], len(own)) - 1], path[cuts], np.add.reduceat(self.size[own], cuts)


def viterbi(s: np.ndarray, switch: float) -> np.ndarray:
    """The languages, one a step, with the greatest sum of scores less switch for each change.

    A constant path is given without a search where that is exact: with G the most that another
    language gains over a run of steps, and P and E the most over runs at the start and the end,
    G <= switch covers paths that leave it and come back, P + E <= switch those that never take it.
    """
    gain = np.zeros((len(s) + 1, s.shape[1]))
    np.cumsum(s, 0, out=gain[1:])
    best = int(gain[-1].argmax())
    gain -= gain[:, [best]]
    low = np.minimum.accumulate(gain, 0)
    if gain[-1, best] > -NEVER and (gain - low).max() <= switch and gain.max() + (gain[-1] - low[-1]).max() <= switch:
        return np.full(len(s), best)
    from_, stays = _searched(s.tolist(), switch) if s.shape[1] <= FEW else _searched_arrays(s.astype(np.float64), switch)
    path = np.empty(len(s), np.int64)
    path[-1] = at = stays.pop()
    for i in range(len(s) - 1, 0, -1):
        if not stays[i][at]:
            at = from_[i]
        path[i - 1] = at
    return path


def _searched(s: list[list[float]], switch: float) -> tuple[list, list]:
    """For each step the best language of the step before, and which languages are better off without a change; at the end of the latter the best last language."""
    v, from_, stays = s[0], [0], [[]]
    for row in s[1:]:
        high = max(v)
        out = high - switch
        from_.append(v.index(high))
        stays.append([x >= out for x in v])
        v = [(x if x >= out else out) + y for x, y in zip(v, row, strict=True)]
    return from_, [*stays, v.index(max(v))]


def _searched_arrays(s: np.ndarray, switch: float) -> tuple[list, list]:
    v, from_, stays = s[0], [0], [[]]
    for row in s[1:]:
        j = int(v.argmax())
        out = v[j] - switch
        from_.append(j)
        stays.append(v >= out)
        v = np.maximum(v, out) + row
    return from_, [*stays, int(v.argmax())]


def train(rows: DataFrame, most: int = TRAIN_ROWS, seed: int = 11) -> Model:
    """A model from a sample of rows (text, lang, and a key to sample by): at most about `most` of each language."""
    rows = rows.where("lang is not null and text is not null")
    n = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row per language
    if not n:
        return Model(pd.DataFrame({"lang": pd.Series(dtype=str), "gram": pd.Series(dtype=str), "n": pd.Series(dtype=float)}))
    share = F.lit(0.0)
    for lang, count in n.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, most / count))).otherwise(share)
    draw = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1_000_000)) / 1e6

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: Counter = Counter()
        for batch in batches:
            ends, index, words = split_words(batch.column(0))
            langs = batch.column(1).dictionary_encode()
            lang = np.repeat(langs.indices.to_numpy(), np.diff(ends))
            pairs, c = np.unique(lang * np.int64(len(words)) + index, return_counts=True) if len(words) else (np.empty(0, np.int64), np.empty(0, np.int64))
            names = langs.dictionary.to_pylist()
            for k, times in zip(pairs.tolist(), c.tolist(), strict=True):
                name = names[k // len(words)]
                for script, part in runs_of(words[k % len(words)]):
                    got[name, "#" + script] += times * len(part)
                    for g in grams_of(part):
                        got[name, g] += times
        if got:
            yield pa.record_batch([pa.array([k[0] for k in got]), pa.array([k[1] for k in got]), pa.array(list(got.values()), pa.int64())], names=["lang", "gram", "n"])

    counts = rows.where(draw < share).select("text", "lang").mapInArrow(trimming(count), "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).persist()
    script = F.col("gram").startswith("#")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    kept = counts.where(~script).withColumn("nth", nth).where(F.col("nth") <= max(1, GRAMS // len(n))).select(F.col("gram").alias("k_gram")).distinct()
    model = Model(counts.where(script).unionByName(counts.join(kept, F.col("gram") == F.col("k_gram"), "left_semi")).toPandas())
    counts.unpersist()
    return model


def _identified(own: Hidden, model: Model, with_spans: bool) -> DataFrame:
    """The hidden frame with l_got: lang_pred, score, n_spans, and spans where asked for."""
    shared = own.df.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for texts in batches:
            pred, score, n, parts = [], [], [], []
            for letters, *spans in m.spans(texts):
                lang, size = spans[2], spans[3]
                by = np.bincount(lang, size) if len(lang) else None
                best = int(by.argmax()) if len(lang) else -1
                pred.append(m.langs[best] if len(lang) else m.most if letters else "und")
                score.append(float(by[best] / by.sum()) if len(lang) else 0.0)
                n.append(len(lang))
                parts.append(spans)
            out = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(n, pa.int32())]
            if with_spans:
                flat = [np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64) for i in range(4)]
                langs = pa.array(m.langs, pa.string()).take(pa.array(flat[2])) if m.langs else pa.array([], pa.string())
                rows = pa.StructArray.from_arrays([pa.array(flat[0].astype(np.int32)), pa.array(flat[1].astype(np.int32)), langs, pa.array(flat[3].astype(np.int32))], names=["first_word", "last_word", "lang", "letters"])
                out.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), rows))
            yield pa.StructArray.from_arrays(out, names=["lang_pred", "score", "n_spans", "spans"][: len(out)])
        trim()

    each.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    spans = ",spans:array<struct<first_word:int,last_word:int,lang:string,letters:int>>" if with_spans else ""
    return own.df.withColumn("l_got", F.arrow_udf(each, f"struct<lang_pred:string,score:double,n_spans:int{spans}>")("text"))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred, score and spans (first_word, last_word, lang, letters) after its own columns."""
    own = Hidden(docs, "text")
    return own.shown(_identified(own, model, True).select(*own.private, "l_got.*"), "lang_pred", "score", "spans")


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_spans; learned from the rows that are not held out."""
    out = held_out(F.col("doc_id"), 3, 1)
    model = train(pick(docs, "doc_id", "text", "lang").where(~out).select("text", "lang", F.col("doc_id").alias("key")))
    got = _identified(Hidden(pick(docs, "doc_id", "text"), "doc_id", "text"), model, False)
    return got.select("doc_id", out.alias("held_out"), "l_got.lang_pred", "l_got.score", F.col("l_got.n_spans").cast("long").alias("n_spans"))
