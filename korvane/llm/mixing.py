"""Mixing sources to target weights by blocks, slots and index permutations.

The words of a source, in a fixed order of its documents, form one stream that is
cut into blocks of BLOCK words. A source's target becomes a number of slots. The
slots are dealt to output shards by multinomial draws, conditioned on each source's
total (a multivariate hypergeometric tree that every shard walks by itself, so no
driver loop grows with the data). A slot j of a source maps to pass j // n and,
through that pass's keyed Feistel permutation of n block indices, to a block; slots
and blocks then meet in an equi-join on (source, block). The last slot of a source
is trimmed so that its words are the target, rounded.

The mixed corpus (mix_documents) is written as it was drawn: shard by shard, in each the
slots of all sources in a pseudorandom order, in each slot the pieces of its block's documents.

Nothing gathers a source in one task: prefix sums are made within hash buckets of
documents and over bucket totals. The driver and every task that draws hold a row per
source; so sources should be named corpora, thousands or some hundred thousands of them.

Defined cases: null text has size 0; a null source is a source of its own, the last;
rows equal in doc_id, text and source are separate rows, numbered among themselves;
empty tables give no rows; other columns, whatever their names, are ignored by the report
and kept by the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from korvane.llm.common import WORD, Hidden, doc_id_of, keyed, mix64, trimming
from korvane.llm.shingles import word_bounds
from korvane.session import cut, few, pick

#: Words in a block.
BLOCK = 1024
#: Slots in an output shard.
SHARD_SLOTS = 256
#: Bytes of text in a batch that the corpus hands on, about.
BATCH_BYTES = 4 << 20
#: Weights of the sources in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: All targets together, as a share of all words; a source's target is at most CAP times its words.
SHARE, CAP = 1.5, 2.0
SEED = 20260101


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> list[float]:
    """Targets by weight; the excess over cap times the size is dealt again until none is above.

    In order of cap * size / weight the sources that end at their cap come first, so one pass settles all.
    """
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out, left, whole = [0.0] * len(sizes), share * sum(sizes), sum(x for x, s in zip(w, sizes, strict=True) if s)
    for i in sorted((i for i, s in enumerate(sizes) if s), key=lambda i: cap * sizes[i] / w[i]):
        out[i] = min(cap * sizes[i], left * w[i] / whole)
        left, whole = left - out[i], whole - w[i]
    return out


def _round_keys(seed: int, source: int, epoch: int) -> np.ndarray:
    return mix64(np.arange(1, 5, dtype=np.uint64) + np.uint64((seed * 1_000_003 + source * 8191 + epoch) * 0x9E3779B97F4A7C15 % 2**64))


def permute(i: np.ndarray, n: int, seed: int, source: int, epoch: int, back: bool = False) -> np.ndarray:
    """The keyed permutation of range(n), or its inverse, at the indices i: a Feistel network, walked until it falls in range."""
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    mask, shift, keys = np.uint64((1 << half) - 1), np.uint64(half), _round_keys(seed, source, epoch)
    x = i.astype(np.uint64)
    todo = np.ones(len(x), bool)
    while todo.any():
        a, b = x[todo] >> shift, x[todo] & mask
        for k in keys[::-1] if back else keys:
            a, b = (b ^ (mix64(a + k) & mask), a) if back else (b, a ^ (mix64(b + k) & mask))
        x[todo] = (a << shift) | b
        todo = x >= np.uint64(n)
    return x.astype(np.int64)


def plan_source(size: int, target: float, source: int, block: int, seed: int) -> tuple[int, int, int]:
    """Blocks, slots, and how many words the last slot leaves out, so that the words taken are the target, rounded."""
    blocks, want = -(-size // block), round(target)
    if not blocks or not want:
        return blocks, 0, 0
    epoch, rest = divmod(want, size)
    if not rest:
        return blocks, epoch * blocks, 0
    short = blocks * block - size  # the last block lacks so many words
    at = int(permute(np.array([blocks - 1]), blocks, seed, source, epoch, back=True)[0])
    words = lambda m: m * block - (short if m > at else 0)
    m = max(1, rest // block)
    while words(m) < rest:
        m += 1
    return blocks, epoch * blocks + m, words(m) - rest


def _hypergeometric(good: int, bad: int, drawn: int, rng: np.random.Generator) -> int:
    """How many of the drawn are good. numpy draws from up to 10^9; beyond, the same law is inverted over all values of more than double precision's weight."""
    total = good + bad
    if total < 10**9:
        return int(rng.hypergeometric(good, bad, drawn))
    mean, p = drawn * good / total, good / total
    reach = int(40 * (drawn * p * (1 - p) * (total - drawn) / (total - 1)) ** 0.5) + 40
    lo, hi = max(0, drawn - bad, int(mean) - reach), min(good, drawn, int(mean) + reach)
    k = np.arange(lo + 1, hi + 1, dtype=np.float64)
    logs = np.append(0.0, np.cumsum(np.log((good - k + 1) * (drawn - k + 1)) - np.log(k * (bad - drawn + k))))
    sums = np.cumsum(np.exp(logs - logs.max()))
    return lo + int(np.searchsorted(sums, rng.random() * sums[-1], side="right").clip(0, hi - lo))


def _split(counts: np.ndarray, left: int, rng: np.random.Generator) -> np.ndarray:
    """How many of each source's slots fall into the left `left` of all slots."""
    out, rest = np.zeros_like(counts), int(counts.sum())
    for i in np.flatnonzero(counts).tolist():
        if not left:
            break
        c = int(counts[i])
        out[i] = got = _hypergeometric(c, rest - c, left, rng) if rest > c else left
        left, rest = left - got, rest - c
    return out


@lru_cache(1 << 12)
def _half(lo: int, hi: int, counts: bytes, size: int, whole: int, seed: int) -> np.ndarray:
    """The draw of a node of the tree; the upper ones are those of very many shards."""
    return _split(np.frombuffer(counts, np.int64), min((lo + hi) // 2 * size, whole) - lo * size, np.random.default_rng([seed, lo, hi]))


def shard_draw(shard: int, shards: int, slots: np.ndarray, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first slot, slots) of each source in a shard, by walking the tree of splits from the root."""
    lo, hi, start, counts = 0, shards, np.zeros_like(slots), slots.astype(np.int64)
    whole = int(slots.sum())
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = _half(lo, hi, counts.tobytes(), size, whole, seed)
        if shard < mid:
            hi, counts = mid, left
        else:
            lo, start, counts = mid, start + left, counts - left
    return start, counts


def _keyed(docs: DataFrame) -> DataFrame:
    """The row key of common.keyed, with the source in its hash."""
    return keyed(docs).withColumn("k_hash", F.xxhash64("k_hash", "source"))


def sizes(docs: DataFrame) -> DataFrame:
    """k_id, k_hash, copy, source, size of every row; copy tells equal rows apart."""
    d = _keyed(pick(docs, "doc_id", "text", "source")).select("k_id", "k_hash", "source", F.regexp_count("text", F.lit(WORD)).alias("n"))
    d = d.select("k_id", "k_hash", "source", F.coalesce("n", F.lit(0)).cast("long").alias("size"))
    d = d.groupBy("k_id", "k_hash", "source", "size").agg(F.count("*").alias("copies"))
    return d.select("k_id", "k_hash", "source", "size", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))


def mix(docs: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(rows, taken). rows: k_id, k_hash, copy, source, size, source_size, target.

    taken, the mix itself: shard, s and slot (the slot's source and its number there), place (the
    slot's in its shard), epoch, block, and the row's words from word_from up to word_to (counted from 0)
    that this slot puts out, the block's word block_at being the first of them.
    """
    spark = docs.sparkSession
    slim = cut(sizes(docs), "sizes")
    by = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")).orderBy(F.col("source").asc_nulls_last()).collect()  # a row per source
    target = targets([r.source_size for r in by], weights, share, cap)
    plan = [plan_source(r.source_size, t, s, block, seed) for s, (r, t) in enumerate(zip(by, target, strict=True))]
    buckets = 1 + int(sum(r.n for r in by) ** 0.5 / 2)  # as many rows in a bucket as buckets, about: both stay small

    names = spark.createDataFrame([(s, r.source, r.source_size, t) for s, (r, t) in enumerate(zip(by, target, strict=True))], "s int, source string, source_size long, target double")
    known = names.withColumnRenamed("source", "s_name")
    rows = slim.join(F.broadcast(known) if len(by) <= 100_000 else known, F.col("source").eqNullSafe(F.col("s_name"))).drop("s_name")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("k_id", "k_hash", F.lit(seed)), F.lit(buckets)).cast("int"))

    totals = rows.groupBy("s", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(F.col("s").alias("b_s"), F.col("bucket").alias("b_bucket"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("bucket", "s").orderBy("k_id", "k_hash", "copy").rowsBetween(Window.unboundedPreceding, -1)
    dealt = rows.repartition("bucket").withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = dealt.where("size > 0").join(base, (F.col("s") == F.col("b_s")) & (F.col("bucket") == F.col("b_bucket"))).withColumn("first", F.col("base") + F.col("inner"))
    b = F.lit(block)
    pieces = placed.select(
        "s", "k_id", "k_hash", "copy", "size", "first", F.explode(F.sequence(F.floor(F.col("first") / b), F.floor((F.col("first") + F.col("size") - 1) / b))).alias("block")
    ).select(
        "s", "block", "k_id", "k_hash", "copy", "size", F.col("first").alias("p_first"),
        F.greatest(F.lit(0), F.col("block") * b - F.col("first")).alias("word_from"),
        F.least(F.col("size"), (F.col("block") + 1) * b - F.col("first")).alias("word_to"),
    )

    blocks = np.array([p[0] for p in plan], np.int64)
    slots = np.array([p[1] for p in plan], np.int64)
    trims = [p[2] for p in plan]
    shards = -(-int(slots.sum()) // shard_slots)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for shard in batch["id"].tolist():
                start, counts = shard_draw(shard, shards, slots, shard_slots, seed)
                for s in np.flatnonzero(counts).tolist():
                    j = np.arange(start[s], start[s] + counts[s])
                    epoch = j // blocks[s]
                    at = np.empty_like(j)
                    for e in np.unique(epoch).tolist():
                        at[epoch == e] = permute(j[epoch == e] % blocks[s], int(blocks[s]), seed, s, e)
                    out.append(pd.DataFrame({"shard": shard, "slot": j, "m_s": s, "epoch": epoch, "m_block": at, "trim": np.where(j == slots[s] - 1, trims[s], 0)}))
                if len(out) >= 1000:
                    yield pd.concat(out)
                    out = []
            if out:
                yield pd.concat(out)

    drawn = spark.range(shards, numPartitions=max(1, min(shards, 8 * spark.sparkContext.defaultParallelism))).mapInPandas(draw, "shard long, slot long, m_s int, epoch long, m_block long, trim long")
    # A trimmed slot loses the words at the end of its block.
    ends = {s: int(min((k + 1) * block, r.source_size)) for s, (r, (n, m, t)) in enumerate(zip(by, plan, strict=True)) if t for k in [int(permute(np.array([(m - 1) % n]), n, seed, s, (m - 1) // n)[0])]}
    end = spark.createDataFrame([(s, e) for s, e in ends.items()] or [(-1, 0)], "e_s int, e_end long")
    taken = (
        drawn.join(pieces.hint("merge"), (F.col("m_s") == F.col("s")) & (F.col("m_block") == F.col("block")))
        .join(F.broadcast(end), F.col("s") == F.col("e_s"), "left")
        .withColumn("word_to", F.when(F.col("trim") > 0, F.least(F.col("word_to"), F.col("e_end") - F.col("trim") - F.col("p_first"))).otherwise(F.col("word_to")))
        .where("word_to > word_from")
        .select(
            "shard", F.xxhash64("s", "slot", F.lit(seed)).alias("place"), "s", "slot", "epoch", "block", "k_id", "k_hash", "copy", "size",
            (F.col("p_first") + F.col("word_from") - F.col("block") * b).cast("int").alias("block_at"), "word_from", "word_to",
        )
    )
    return rows.select("k_id", "k_hash", "copy", "source", "size", "source_size", "target"), taken


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: what the mix takes of every row."""
    rows, taken = mix(docs)
    sums = taken.groupBy("k_id", "k_hash", "copy").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("taken"))
    return rows.join(sums, ["k_id", "k_hash", "copy"], "left").select(
        doc_id_of(F.col("k_id")).alias("doc_id"), "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mixed corpus with the columns of docs: a row for each piece of a document in a slot, shards in partitions, slots and pieces in their order.

    The text of a row is the piece; blocks' words are in the rows as they follow one another.
    """
    own = Hidden(docs, "doc_id", "text", "source")
    rows, taken = mix(docs)
    span = F.struct("shard", "place", "s", "slot", "block_at", "word_from", "word_to")
    spans = taken.groupBy("k_id", "k_hash", "copy").agg(F.collect_list(span).alias("m_spans")).withColumnsRenamed({"k_id": "m_id", "k_hash": "m_hash"})
    # Copy c of a key goes with the c-th of its rows; only rows that repeat must be numbered.
    base = _keyed(own.df)
    twice = cut(rows.where("copy = 2").select(F.col("k_id").alias("t_id"), F.col("k_hash").alias("t_hash")), "repeated-rows")
    twice = F.broadcast(twice) if few(twice) else twice
    repeats = (F.col("k_id") == F.col("t_id")) & (F.col("k_hash") == F.col("t_hash"))
    nth = F.row_number().over(Window.partitionBy("k_id", "k_hash").orderBy("k_id"))
    base = base.join(twice, repeats, "left_anti").withColumn("m_row", F.lit(1)).unionByName(base.join(twice, repeats, "left_semi").withColumn("m_row", nth))
    kept = [c for c in own.private if c != "text"]
    both = base.join(spans, (F.col("k_id") == F.col("m_id")) & (F.col("k_hash") == F.col("m_hash")) & (F.col("m_row") == F.col("copy")))
    order = ["shard", "place", "s", "slot", "block_at"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, row, texts, size = batch.schema.names, [], [], 0
            lists = batch.column(names.index("m_spans"))
            ends, flat = lists.offsets.to_numpy(), lists.values
            first, last = flat.field("word_from").to_numpy(), flat.field("word_to").to_numpy()
            done = int(ends[0])

            def out(upto: int, row=row, texts=texts, batch=batch, names=names, flat=flat) -> pa.RecordBatch:
                at = pa.array(row, pa.int32())
                part = flat.slice(done, upto - done)
                made = pa.record_batch([*(batch.column(names.index(c)).take(at) for c in kept), pa.array(texts, pa.string()), *(part.field(c) for c in order)], names=[*kept, "text", *order])
                row.clear()
                texts.clear()
                return made

            for i, text in enumerate(batch.column(names.index("text"))):
                data = text.as_py().encode("utf-8", "surrogatepass")
                starts, stops = word_bounds(data)
                for k in range(ends[i], ends[i + 1]):
                    texts.append(data[starts[first[k]] : stops[last[k] - 1]])
                    row.append(i)
                    size += len(texts[-1])
                    if size >= BATCH_BYTES:
                        yield out(k + 1)
                        done, size = k + 1, 0
            if row:
                yield out(int(ends[-1]))

    got = both.select(*kept, "text", "m_spans").mapInArrow(trimming(pieces), own.schema(*kept, "text", shard="long", place="long", s="int", slot="long", block_at="int"))
    got = got.repartition("shard").sortWithinPartitions(*order)
    return own.shown(got, changed={"n_chars": F.length("text").cast("long")} if "n_chars" in docs.columns else None)
