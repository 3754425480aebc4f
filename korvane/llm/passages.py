"""Removal of repeated passages, word for word, wherever they begin or end.

Words are runs of anything but ASCII white space. Every LEAST consecutive words are a
window; a window's first occurrence, by (doc_id, position), stays, and the words that
its later occurrences cover are merged and removed, each with the white space after it.
So no stretch of LEAST words or more stays that the given texts hold earlier, whether
it is one long sentence, part of one, or several.

Not every window is dealt. A text's samples are the least hashes of KEEP consecutive
runs of RUN words (winnowing); LEAST words hold KEEP such runs, and equal windows have
equal samples. Only windows that hold a sample met twice (by a bitmap)
are compared, by 96 bits, so what is found is the same as if all were.

Defined cases: null text stays null and texts under LEAST words stay; null doc_ids come
first; rows equal in doc_id and text are one document; an empty table gives no rows;
other columns stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from korvane.llm.common import WORD, Hidden, bitmap, has, keyed, mix64, trimming
from korvane.llm.shingles import word_hashes
from korvane.session import cut, pick

#: Words in a run that is sampled; runs of which one is kept at least; words in a window.
RUN, KEEP = 25, 26
LEAST = RUN + KEEP - 1
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WORD = re.compile(WORD)


def _runs(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """A hash for every width consecutive words."""
    n = len(words) - width + 1
    total = np.zeros(n, np.uint64)
    done, power = 0, np.uint64(1)
    step, size = words, 1  # step: hashes of size consecutive words, by doubling
    while True:
        if width & size:
            total += step[done : done + n] * power
            done += size
            power = np.uint64(pow(base, done, 2**64))
        if done == width:
            return mix64(total + np.uint64(width))
        step = step[:-size] + step[size:] * np.uint64(pow(base, size, 2**64))
        size *= 2


def _sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """least (np.minimum or np.maximum) over every width consecutive values."""
    size = 1
    while size * 2 <= width:
        x = least(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return least(x[:-rest], x[rest:]) if rest else x


def samples(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the sampled runs of a text of LEAST words or more."""
    h = _runs(words, RUN, _BASES[0])
    low = _sliding(h, KEEP, np.minimum)
    edge = np.zeros(KEEP - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate([edge, low, edge]), KEEP, np.maximum) == h)
    return h[at], at


def _hashed(text: str | None) -> np.ndarray:
    return word_hashes((text or "").encode("utf-8", "surrogatepass"))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """h and the least and greatest key of its places within a text, of all samples."""
    for batch in batches:
        h, low, high = [], [], []
        keys = mix64(mix64(batch.column(0).to_numpy().view(np.uint64)) ^ batch.column(1).to_numpy().view(np.uint64))
        for key, text in zip(keys, batch.column(2), strict=True):
            words = _hashed(text.as_py())
            if len(words) >= LEAST:
                a, at = samples(words)
                a, first, n = np.unique(a, return_index=True, return_counts=True)
                h.append(a)
                low.append(mix64(key + at[first].astype(np.uint64)))
                high.append(low[-1] + (n > 1).astype(np.uint64))  # another place of the same text
        if h:
            yield pa.record_batch([np.concatenate(x).view(np.int64) for x in (h, low, high)], names=["h", "low", "high"])


def _windows(docs: DataFrame, wanted) -> DataFrame:
    """h, h2, k_id, k_hash, pos of the windows that hold a sample in the bitmap."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, h2, pos, n = [], [], [], np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(batch.column(2)):
                words = _hashed(text.as_py())
                if len(words) < LEAST:
                    continue
                a, at = samples(words)
                at = at[has(wanted.value, a)]
                if not len(at):
                    continue
                size = len(words) - LEAST + 1
                open_ = np.zeros(size + 1, np.int64)
                np.add.at(open_, np.clip(at - KEEP + 1, 0, size), 1)  # the starts of windows that hold the run
                np.add.at(open_, np.minimum(at + 1, size), -1)
                p = np.flatnonzero(np.cumsum(open_[:-1]) > 0)
                h.append(_runs(words, LEAST, _BASES[0])[p])
                h2.append((_runs(words, LEAST, _BASES[1])[p] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                pos.append(p.astype(np.int32))
                n[i] = len(p)
            if h:
                ids = [np.repeat(batch.column(i).to_numpy(), n) for i in (0, 1)]
                yield pa.record_batch([np.concatenate(h).view(np.int64), np.concatenate(h2), *ids, np.concatenate(pos)], names=["h", "h2", "k_id", "k_hash", "pos"])

    return docs.select("k_id", "k_hash", "text").mapInArrow(trimming(each), "h long, h2 int, k_id long, k_hash long, pos int")


def covered(docs: DataFrame) -> DataFrame:
    """k_id, k_hash, starts: where the windows to remove begin, ascending, of documents that have any."""
    own = keyed(pick(docs, "doc_id", "text"))
    met = own.select("k_id", "k_hash", "text").mapInArrow(trimming(_sampled), "h long, low long, high long")
    twice = met.groupBy("h").agg(F.min("low").alias("low"), F.max("low").alias("top"), F.max(F.col("low") != F.col("high")).alias("own")).where("low < top or own")
    twice = cut(twice.select("h"), "repeated-samples")
    found = cut(_windows(own, docs.sparkSession.sparkContext.broadcast(bitmap(twice, "h"))), "passages")
    place = F.struct("k_id", "k_hash", "pos")
    seen = found.groupBy("h", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = cut(seen.where("first < last").select(F.col("h").alias("r_h"), F.col("h2").alias("r_h2"), "first"), "repeated-passages")
    later = found.join(repeated, (F.col("h") == F.col("r_h")) & (F.col("h2") == F.col("r_h2"))).where(place > F.col("first"))
    return later.groupBy("k_id", "k_hash").agg(F.array_sort(F.collect_list("pos")).alias("starts"))


def without(text: str, starts: list[int]) -> tuple[str, int]:
    """The text without the words that windows at starts cover, and how many those were."""
    at = [m.start() for m in _WORD.finditer(text)]
    at.append(len(text))
    out, kept, gone, end = [], 0, 0, 0  # kept: up to which character, end: up to which word, the text is settled
    for s in starts:
        a, b = max(s, end), s + LEAST
        if a < b:
            out.append(text[kept : at[a]])
            kept, end = at[b], b
            gone += b - a
    return "".join([*out, text[kept:]]), gone


def passage_dedup(docs: DataFrame) -> DataFrame:
    """docs with text rebuilt, and the column n_cut, the words removed, after its own."""
    own = Hidden(docs, "doc_id", "text")
    hit = covered(own.df).toDF("c_id", "c_hash", "c_starts")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [without(t.as_py(), s.as_py()) if s.is_valid else (t.as_py(), 0) for t, s in zip(batch.column("text"), batch.column("c_starts"), strict=True)]
            rest = [batch.column(c) for c in kept]
            yield pa.record_batch([*rest, pa.array([t for t, _ in got], pa.string()), pa.array([n for _, n in got], pa.int32())], names=[*kept, "text", "n_cut"])

    kept = [c for c in own.private if c != "text"]
    joined = keyed(own.df).join(hit, (F.col("k_id") == F.col("c_id")) & (F.col("k_hash") == F.col("c_hash")), "left")
    got = joined.select(*kept, "text", "c_starts").mapInArrow(trimming(rebuild), own.schema(*kept, text="string", n_cut="int"))
    return own.shown(got, "n_cut")
