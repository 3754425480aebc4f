"""Line dedup over overlapping windows of three lines.

A text is cut into lines, since one physical line may hold a whole passage: a line ends
at a line end, or at sentence marks (. ! ?) that white space follows, and has the white
space (and marks alone) after that, so that words do not run together where a line goes.
Marks within numbers, names and addresses end nothing. Lines are compared without white
space at their ends. Every three consecutive lines with at least MIN_WORDS words are a window (a
text of one or two lines is one window). A window's first occurrence, by (doc_id,
position), stays; the lines that its later occurrences cover are merged and removed, also
where they overlap the first: of a line that repeats on and on its first occurrence stays.

Every window's hash (96 bits) is counted by partial aggregation; only windows met twice
go on. Their occurrences, found again through a bitmap, join that table by
an equi-join that AQE may split, so a window with very many occurrences is no single
task's work. Texts are rebuilt after one join by document.

Defined cases: null text stays null and empty text empty, with no lines; null doc_ids
come first; rows equal in doc_id and text are one document whose result each of them
gets; an empty table gives no rows; other columns stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from korvane.llm.common import Hidden, bitmap, has, keyed, mix64, trimming
from korvane.llm.passages import passage_dedup
from korvane.session import cut, pick

#: Lines in a window; least words in a window (1: all but windows of white space).
WINDOW, MIN_WORDS = 3, 1
_LINE = r"[^\n.!?]*(?:[.!?]+[^ \t\r\n.!?][^\n.!?]*)*(?:[.!?]+[ \t\r\n]|\n)(?:[.!?]*[ \t\r\n])*|[\s\S]+"
_ENDS = " \t\n\r\x0b\x0c"
_Q = [np.uint64(q) for q in (1, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def split_lines(text: str) -> list[str]:
    """The lines of a text; joined they are the text."""
    return re.findall(_LINE, text)


def windows(lines: list[str], least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, further 32 bits, position) of a text's windows that have at least so many words."""
    own = [x.strip(_ENDS).encode("utf-8", "surrogatepass") for x in lines]
    words = np.array([len(x.split()) for x in own], np.int64)
    both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in own), np.uint64).reshape(-1, 2)
    width = min(WINDOW, len(lines))
    n = len(lines) - width + 1 if width else 0
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int32)
    total, sums = np.zeros(n, np.int64), np.full((n, 2), width, np.uint64)
    for j in range(width):
        total += words[j : j + n]
        sums += both[j : j + n] * _Q[j]
    at = np.flatnonzero(total >= least)
    return mix64(sums[at, 0]), (mix64(sums[at, 1]) >> np.uint64(32)).astype(np.uint32).view(np.int32), at.astype(np.int32)


def _occurrences(docs: DataFrame, least: int, wanted=None) -> DataFrame:
    """h, h2, k_id, k_hash, pos of all windows, or of those whose hash is in the bitmap."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, h2, pos, n = [], [], [], []
            for text in batch.column(2):
                a, b, p = windows(split_lines(text.as_py() or ""), least)
                if wanted is not None and len(a):
                    some = has(wanted.value, a)
                    a, b, p = a[some], b[some], p[some]
                h.append(a)
                h2.append(b)
                pos.append(p)
                n.append(len(a))
            if sum(n):
                ids = [np.repeat(batch.column(i).to_numpy(), n) for i in (0, 1)]
                yield pa.record_batch([np.concatenate(h).view(np.int64), np.concatenate(h2), *ids, np.concatenate(pos)], names=["h", "h2", "k_id", "k_hash", "pos"])

    return docs.select("k_id", "k_hash", "text").mapInArrow(trimming(each), "h long, h2 int, k_id long, k_hash long, pos int")


def covered(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """k_id, k_hash, lines: the positions of the lines to remove, ascending, of documents that have any."""
    own = keyed(pick(docs, "doc_id", "text"))
    # Rows that are one document must not count as each other's copies: occurrences are told apart by (k_id, k_hash, pos).
    place = F.struct("k_id", "k_hash", "pos")
    seen = _occurrences(own, least).groupBy("h", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = cut(seen.where("first < last").select(F.col("h").alias("r_h"), F.col("h2").alias("r_h2"), "first"), "repeated")
    again = _occurrences(own, least, docs.sparkSession.sparkContext.broadcast(bitmap(repeated, "r_h")))
    later = again.join(repeated, (F.col("h") == F.col("r_h")) & (F.col("h2") == F.col("r_h2"))).where(F.struct("k_id", "k_hash", "pos") > F.col("first"))
    starts = later.select("k_id", "k_hash", "pos").distinct()
    return starts.groupBy("k_id", "k_hash").agg(F.array_sort(F.collect_list("pos")).alias("starts"))


def line_dedup(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """docs with text rebuilt, and the columns n_lines and n_removed after its own; windows of fewer words than least do not count."""
    own = Hidden(docs, "doc_id", "text")
    hit = covered(own.df, least).toDF("c_id", "c_hash", "c_starts")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n, gone = [], [], []
            for text, starts in zip(batch.column("text"), batch.column("c_starts"), strict=True):
                t, s = text.as_py(), starts.as_py()
                lines = split_lines(t or "")
                out = {p + j for p in s or () for j in range(min(WINDOW, len(lines)))}
                texts.append("".join(x for i, x in enumerate(lines) if i not in out) if out else t)
                n.append(len(lines))
                gone.append(len(out))
            rest = [batch.column(c) for c in kept]
            yield pa.record_batch([*rest, pa.array(texts, pa.string()), pa.array(n, pa.int32()), pa.array(gone, pa.int32())], names=[*kept, "text", "n_lines", "n_removed"])

    kept = [c for c in own.private if c != "text"]
    joined = keyed(own.df).join(hit, (F.col("k_id") == F.col("c_id")) & (F.col("k_hash") == F.col("c_hash")), "left")
    got = joined.select(*kept, "text", "c_starts").mapInArrow(trimming(rebuild), own.schema(*kept, text="string", n_lines="int", n_removed="int"))
    return own.shown(got, "n_lines", "n_removed")


def line_dedup_report(docs: DataFrame) -> DataFrame:
    return line_dedup(pick(docs, "doc_id", "text")).select("doc_id", "text", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """docs without repeated windows that have any word, then without repeated passages (see passages); documents of which nothing but white space is left go, n_chars is counted anew."""
    own = Hidden(docs, "doc_id", "text")
    got = passage_dedup(cut(line_dedup(own.df), "lines"))
    same = (F.col("n_removed") == 0) & (F.col("n_cut") == 0)
    got = got.where(same | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    if "n_chars" not in docs.columns:
        return own.shown(got)
    before = F.col(own.private[docs.columns.index("n_chars")])
    return own.shown(got, changed={"n_chars": F.when(same, before).otherwise(F.length("text")).cast("long")})


ORACLE = r"""
WITH u AS (
  SELECT doc_id, text, coalesce(regexp_extract_all(text, '[^\n.!?]*(?:[.!?]+[^ \t\r\n.!?][^\n.!?]*)*(?:[.!?]+[ \t\r\n]|\n)(?:[.!?]*[ \t\r\n])*|(?s:.)+'), []) AS x FROM documents),
t AS (
  SELECT doc_id, text, x, len(x) AS n, list_transform(x, lambda s: trim(s, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS y FROM u),
w AS (
  SELECT doc_id, n, unnest(range(1, greatest(n - 1, CASE WHEN n > 0 THEN 2 ELSE 1 END))) AS p, y FROM t),
k AS (
  SELECT doc_id, n, p, list_slice(y, p, least(p + 2, n)) AS win FROM w),
f AS (
  SELECT doc_id, n, p, row_number() OVER (PARTITION BY win ORDER BY doc_id NULLS FIRST, p) AS nth FROM k
  WHERE len(regexp_extract_all(array_to_string(win, ' '), '[^\x20\x09-\x0D]+')) >= 1),
g AS (
  SELECT DISTINCT doc_id, unnest(range(p, least(p + 3, n + 1))) AS i FROM f WHERE nth > 1),
r AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id)
SELECT t.doc_id, CASE WHEN gone IS NULL THEN text
  ELSE array_to_string(list_transform(list_filter(range(1, n + 1), lambda i: NOT list_contains(gone, i)), lambda i: x[i]), '') END AS text,
  CAST(n AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed
FROM t LEFT JOIN r ON t.doc_id = r.doc_id
"""
