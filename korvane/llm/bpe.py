"""Byte-level BPE: ranked merges folded over the distinct words of blocks of texts.

1. Texts are split by the vocabulary's pattern; a block of texts (BLOCK_CHARS) becomes one
   row with its distinct words and, for every text, the indices of its words. No text is
   shuffled, so encoding costs no disk and no word can be a hot key.
2. Spark higher-order functions fold the merges over the bytes of every distinct word: the
   state is the array of the pieces' borders and the array of the ranks of neighbouring
   pairs; each step takes out the border within the pair of least rank (the leftmost of
   equals) and looks up the two ranks beside it. The rank map is a literal, an array of
   small maps by hash, since a map's keys are searched in order. Words longer than FOLD
   bytes, for which the fold's work would grow with the square of the length, are merged
   with a heap in step 1 instead, by the same rule.
3. A text's ids are the ids of its words in order.

The words of a bounded sample of texts go through the fold first; their ids, at most
CACHE_WORDS words, are broadcast, so that blocks fold only what is not among them. Which
words those are changes the work, never the ids.

Decoding concatenates the binary pieces of ids.

Defined cases: null text is empty and gives no ids; texts of any length are read whole;
strings that look like special tokens are ordinary text; rows are handled one by one, so
ties and repeats need no rule; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korvane.llm.common import trim, trimming
from korvane.session import cut, pick

#: Characters of a block, about; longest word for the fold; small maps of the rank map.
BLOCK_CHARS, FOLD, BUCKETS = 12_000_000, 64, 1 << 14
#: Texts whose words are folded beforehand, about; words kept of them, at most (some 40 bytes each).
CACHE_TEXTS, CACHE_WORDS = 40_000, 1_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def splitter(pattern: str) -> regex.Pattern:
    """The pattern with white space as the Unicode property."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: pairs joined in order of rank, leftmost first, by a heap over a linked list."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        r, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != stop or ranks.get(word[i : end[j]]) != r:
            continue
        end[i], alive[j], after[i] = end[j], False, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(word[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[after[i]]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p : end[i]])) is not None:
            heapq.heappush(heap, (r, p, end[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = after[i]
    return out


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The ranks as a literal: BUCKETS maps from tokens (a character for each byte) to ranks, by the tokens' hash."""
    maps: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        text = token.decode("latin-1")
        maps[xxhash.xxh64_intdigest(text.encode(), 42) % BUCKETS][text] = rank  # xxhash64() of Spark has this seed
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")


def _let(value: Column, body) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold(word: Column, table: Column) -> Column:
    """Ids of a word, a string with a character for each byte, by the rank map."""
    rank = lambda s: F.try_element_at(F.get(table, F.xxhash64(s).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")), s)
    span = lambda a, b: rank(F.substring(word, a + 1, b - a))
    n = F.length(word)
    borders = F.sequence(F.lit(0), n)
    ranks = F.transform(F.sequence(F.lit(1), n - 1), lambda i: rank(F.substring(word, i, F.lit(2))))

    def step(s: Column, _: Column) -> Column:
        b, rk = s["b"], s["r"]
        least = F.array_min(rk)

        def joined(i: Column) -> Column:  # i: the left piece, from 0
            new = lambda x, j: F.when(j == i - 1, span(F.get(b, i - 1), F.get(b, i + 2))).when(j == i, span(F.get(b, i), F.get(b, i + 3))).otherwise(x)
            return F.struct(F.array_remove(b, F.get(b, i + 1)).alias("b"), F.transform(F.filter(rk, lambda _, j: j != i), new).alias("r"))

        return F.when(least.isNotNull(), _let((F.array_position(rk, least) - 1).cast("int"), joined)).otherwise(s)

    merged = F.aggregate(F.sequence(F.lit(2), n), F.struct(borders.alias("b"), ranks.alias("r")), step, lambda s: s["b"])
    pieces = lambda b: F.transform(F.slice(b, F.lit(1), F.size(b) - 1), lambda x, j: span(x, F.get(b, j + 1)))
    return _let(rank(word), lambda r: F.when(r.isNotNull() | (n < 2), F.array(r)).otherwise(_let(merged, pieces)))


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(-1, 2)


def _places(words: list[bytes], known: np.ndarray) -> np.ndarray:
    """The place of each word among the sorted hashes of known words, or -1."""
    h = _hashes(words)
    if not len(known) or not len(h):
        return np.full(len(words), -1, np.int32)
    i = np.minimum(np.searchsorted(known[:, 0], h[:, 0]), len(known) - 1)
    return np.where((known[i] == h).all(1), i, -1).astype(np.int32)


def build_cache(docs: DataFrame, ranks: dict[bytes, int], pattern: str, texts: int = CACHE_TEXTS, most: int = CACHE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted 128-bit hashes, ids one word after the other, ids of each) of the words of about `texts` of the rows (doc_id, text); of too many words the rarer ones are left to the blocks."""
    total = docs.count()
    some = docs if total <= texts else docs.where(F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1_000_000)) < int(1e6 * texts / total) + 1)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(pattern).findall
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                got = pa.chunked_array([pa.array(split(t.as_py() or ""), pa.string()) for t in batch.column(0).slice(lo, 2000)], pa.string()).value_counts()
                own = [(w.encode(), n) for w, n in zip(got.field(0).to_pylist(), got.field(1).to_pylist(), strict=True)]
                own = [(w, n) for w, n in own if len(w) <= FOLD]
                yield pa.record_batch([pa.array([w.decode("latin-1") for w, _ in own], pa.string()), pa.array([n for _, n in own], pa.int64())], names=["word", "n"])

    counts = cut(some.select("text").mapInArrow(words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    steps = {r.step: r["count"] for r in counts.groupBy(F.floor(F.log2("n") * 4).cast("int").alias("step")).count().collect()}  # some dozens
    least, room = 0, most
    for step in sorted(steps, reverse=True):
        if steps[step] > room:
            least = step + 1
            break
        room -= steps[step]
    kept = counts.where(F.floor(F.log2("n") * 4) >= least).groupBy(F.spark_partition_id(), F.pmod(F.xxhash64("word"), F.lit(16))).agg(F.collect_list("word").alias("words"))
    got = kept.select("words", _let(rank_map(ranks), lambda table: F.transform("words", lambda w: fold(w, table))).alias("ids")).toArrow()
    flat_words = got.column("words").combine_chunks().flatten().to_pylist() if got.num_rows else []
    ids = pa.chunked_array([c.flatten() for c in got.column("ids").chunks], pa.list_(pa.int32())).combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.int32()))
    n = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
    h = _hashes([w.encode("latin-1") for w in flat_words])
    order = np.argsort(h[:, 0], kind="stable")
    at = np.cumsum(n) - n
    return h[order], _gather(ids.flatten().to_numpy(), at, n, order), n[order]


def _blocks(pattern: str, ranks, hashes, chars: int):
    """doc_id, text batches to rows of blocks: doc_ids, sizes, index, known, words, long_at, long_ids.

    known: for each distinct word its place in the cache, or -1; words: those without one.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(pattern).findall
        ids: list = []
        sizes: list[int] = []
        found: list[str] = []
        chunks: list[pa.Array] = []
        size = 0

        def row() -> pa.RecordBatch:
            coded = pa.chunked_array([*chunks, pa.array(found, pa.string()).dictionary_encode()]).unify_dictionaries()
            index = pa.concat_arrays([c.indices for c in coded.chunks])
            every = coded.chunk(0).dictionary.cast(pa.binary())
            known = _places(every.to_pylist(), hashes.value)
            new = every.take(pa.array(np.flatnonzero(known < 0)))
            far = np.flatnonzero(pc.binary_length(new).to_numpy(zero_copy_only=False) > FOLD)
            merged = [merge(new[i].as_py(), ranks.value) for i in far.tolist()]
            if len(far):
                new = pc.if_else(pc.greater(pc.binary_length(new), FOLD), pa.scalar(b"", pa.binary()), new)
            one = lambda v, t: pa.array([v], pa.list_(t))
            whole = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
            out = [one(ids, pa.int64()), one(sizes, pa.int32()), whole(index), whole(pa.array(known)), whole(new), one(far, pa.int32()), pa.array([merged], pa.list_(pa.list_(pa.int32())))]
            return pa.record_batch(out, names=["doc_ids", "sizes", "index", "known", "words", "long_at", "long_ids"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                t = text.as_py() or ""
                got = split(t)
                found += got
                ids.append(doc_id.as_py())
                sizes.append(len(got))
                size += len(t) + 16
                if len(found) >= 200_000:
                    chunks.append(pa.array(found, pa.string()).dictionary_encode())
                    found = []
                if size >= chars:
                    out = row()
                    ids, sizes, found, chunks, size = [], [], [], [], 0
                    yield out
                    del out
                    trim()
        if ids:
            yield row()

    return trimming(each)


def _texts(start, cache, names: list[str]):
    """Rows of blocks to a row per text: doc_id and the columns that start()(ids of some texts, where each text's begin) gives."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (kept, kept_n), finish = cache.value, start()
        kept_at = np.cumsum(kept_n) - kept_n
        for batch in batches:
            for b in range(batch.num_rows):
                own = lambda name, b=b, batch=batch: batch.column(name)[b].values
                known = own("known").to_numpy()
                coded = own("coded")  # of the words that the cache lacks
                new_n = coded.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                new_at, flat = np.cumsum(new_n) - new_n, coded.flatten().to_numpy()
                far = own("long_at").to_numpy()
                if len(far):  # ids of long words go to the end
                    more = own("long_ids")
                    k = more.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                    new_at[far], new_n[far] = len(flat) + np.cumsum(k) - k, k
                    flat = np.concatenate([flat, more.flatten().to_numpy()])
                old = known >= 0
                at, n = np.empty(len(known), np.int64), np.empty(len(known), np.int64)
                at[~old], n[~old] = new_at, new_n
                n[old] = kept_n[known[old]]
                at[old] = len(flat) + np.cumsum(n[old]) - n[old]
                flat = np.concatenate([flat, _gather(kept, kept_at, kept_n, known[old])])
                index, doc_ids = own("index").to_numpy(), own("doc_ids")
                ends = np.append(0, np.cumsum(own("sizes").to_numpy()))
                for lo in range(0, len(doc_ids), 500):
                    hi = min(lo + 500, len(doc_ids))
                    words = index[ends[lo] : ends[hi]]
                    tokens = np.append(0, np.cumsum(n[words]))
                    yield pa.record_batch([doc_ids.slice(lo, hi - lo), *finish(_gather(flat, at, n, words), tokens[ends[lo : hi + 1] - ends[lo]])], names=["doc_id", *names])

    return trimming(each)


_BLOCK = "doc_ids array<long>, sizes array<int>, index array<int>, known array<int>, words array<binary>, long_at array<int>, long_ids array<array<int>>"


def _encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, chars: int, start, schema: dict[str, str]) -> DataFrame:
    own = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    context = docs.sparkSession.sparkContext
    hashes, ids, n = build_cache(own, ranks, pattern)
    cache = context.broadcast((ids, n))
    blocks = own.mapInArrow(_blocks(pattern, context.broadcast(ranks), context.broadcast(hashes), chars), _BLOCK)
    one = F.array(F.lit(0))  # stands for words that step 1 has merged

    def coded(table: Column) -> Column:
        return F.transform("words", lambda w: F.when(F.octet_length(w) == 0, one).otherwise(_let(F.decode(w, "ISO-8859-1"), lambda c: fold(c, table))))

    return blocks.withColumn("coded", _let(rank_map(ranks), coded)).drop("words").mapInArrow(_texts(start, cache, list(schema)), ", ".join(["doc_id long", *(f"{k} {t}" for k, t in schema.items())]))


def _gather(flat: np.ndarray, at: np.ndarray, n: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The ids of the words of index, one after the other."""
    size = n[index]
    ends = np.cumsum(size)
    if not len(ends):
        return np.empty(0, np.int32)
    return flat[np.repeat(at[index] - (ends - size), size) + np.arange(ends[-1])]


def _lists(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


def _hashed(pieces: pa.Array, ids: np.ndarray, ends: np.ndarray, less: int) -> list[str]:
    """The digest of each text's pieces, concatenated, without the last `less` bytes."""
    got = pieces.take(pa.array(ids))
    _, offsets, data = got.buffers()
    at = np.frombuffer(offsets, np.int32)[ends].tolist() if len(ids) else [0] * len(ends)
    view = memoryview(data) if data is not None else memoryview(b"")
    return [hashlib.sha256(view[a : max(a, b - less)]).hexdigest() for a, b in zip(at, at[1:], strict=False)]


def _meanings(ranks: dict[bytes, int]) -> pa.Array:
    """The piece of every id."""
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return pa.array(out, pa.binary())


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, ids of every text."""
    return _encoded(docs, ranks, pattern, chars, lambda: lambda ids, ends: (_lists(ids, ends),), {"ids": "array<int>"})


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes that ids stand for: their pieces, looked up in a literal array of binary and concatenated."""
    pieces = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.hex()
    table = F.split(F.lit(",".join(pieces)), ",")
    return F.unhex(_let(table, lambda t: F.array_join(F.transform(ids, lambda i: F.get(t, i)), "")))


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text: encoded as by encode(), the ids then written out and decoded."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def start():
        meant = _meanings(shared.value)
        said = pa.array([f"{i} ".encode() for i in range(len(meant))], pa.binary())
        return lambda ids, ends: (pa.array(np.diff(ends), pa.int64()), pa.array(_hashed(said, ids, ends, 1)), pa.array(_hashed(meant, ids, ends, 0)))

    return _encoded(docs, ranks, pattern, chars, start, {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"})


def tokenise(docs: DataFrame, ranks: dict[bytes, int], pattern: str, chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256 of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def start():
        meant = _meanings(shared.value)
        return lambda ids, ends: (pa.array(np.diff(ends), pa.int64()), _lists(ids, ends), pa.array(_hashed(meant, ids, ends, 0)))

    return _encoded(docs, ranks, pattern, chars, start, {"n_tokens": "long", "ids": "array<int>", "decoded_sha256": "string"})
