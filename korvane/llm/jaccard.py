"""N-gram Jaccard join with prefix filters under several global token orders.

A document is the set of its distinct five-word shingles. Two sets link when their
Jaccard similarity is at least THRESHOLD per cent. Steps:

1. Frequent shingles: every task counts shingles within blocks of documents and hands
   on those met more than once; their sums give the HOT_MAX most frequent ones, a table
   of bounded size. It only ranks tokens; no token is left out.
2. Equal sets form classes; one class row goes on, copies follow their class. Each row keeps
   its prefixes, the first n - ceil(0.75 n) + 1 tokens, under three orders of all tokens:
   by (frequency, hash), so that passages and lines that many documents share come last, and
   by two other hashes, of which only 16 bits a token are kept. Linked sets share a token of
   their prefixes under every order, and more the more alike they are.
3. Postings of the first prefixes meet by token. Tokens of step 1's table are known to be
   shared; the others, which no task can have many of, are dealt by token, and those of one
   class fall away.
4. Classes that meet under a token are candidates. Runs of at most SHORT classes give
   all pairs within the length bound, at most SHORT / 2 for a posting. With the count c
   of shared prefix tokens, overlap is at most c + n - prefix for one side or the other,
   which prunes; tokens of longer runs count as shared as far as either side has them.
   Longer runs need only give the pairs that share no token of a short run, so both sides
   must have enough tokens of long runs, from the one they meet under onwards. They are resolved in rounds: a few hubs a run (by
   a hash of the class) meet the others, verified links merge components, and only pairs
   of different components go to the next round with MORE times the hubs, until a run is
   in one component or all its pairs are done. No link between components is lost.
5. A candidate must also share enough prefix tokens under orders 2 and 3: those prefixes
   alone are joined to the pairs. Only of pairs that pass all orders, sets are moved and the
   intersection is counted.
6. Verified links and classes give components; a document's is the least doc_id.
7. The report counts every class's links, also those within components that 4 leaves out:
   a component's classes are dealt to blocks, and each pair of blocks counts its common
   tokens as products of 0/1 matrices and hands on a number for each class, no links.
   This is work with the square of a component's classes; the pipeline does not need it.

Defined cases: null, empty or wordless texts have the empty set and link with nothing;
null doc_ids take part and are never the least unless alone (then null); rows that
repeat are copies; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from korvane.llm.common import Hidden, bitmap, doc_id_of, has, keyed, mix64, trimming
from korvane.llm.components import components
from korvane.llm.shingles import set_digest, shingle_set
from korvane.session import cut, few, pick, release, scratch

#: Words in a shingle; per cent of similarity.
WIDTH, THRESHOLD = 5, 75
#: Most tokens ranked by frequency (16 bytes each); documents and shingles in a counting block.
HOT_MAX, BLOCK_DOCS, BLOCK_TOKENS = 1 << 20, 4000, 1 << 22
#: Classes in a run that gives all its pairs; how many times the hubs a round has more than the one before.
SHORT, MORE = 32, 32
#: Classes, and tokens of their sets, in a block of a component (about).
SIDE, SIDE_TOKENS = 1024, 1 << 20
#: Tokens in a piece of a block's 0/1 matrix.
COLUMNS = 4096
#: Salts of the token orders 2 and 3.
ORDERS = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def prefix_size(n: int, percent: int) -> int:
    """Tokens of a set of n that surely hold one of any set at least percent similar."""
    return n - (-(-percent * n // 100)) + 1


def needed_overlap(n: int, m: int, percent: int) -> int:
    """Least intersection of sets of n and m that are percent similar."""
    return -(-percent * (n + m) // (100 + percent))


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((np.concatenate(rows) if rows else np.empty(0, np.uint64)).view(np.int64)))


def frequent_tokens(docs: DataFrame, width: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, counts), sorted by token: at most `most` of the tokens that blocks of documents hold more than once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: list[np.ndarray] = []

        def out():
            all_ = np.sort(np.concatenate(sets))
            sets.clear()
            first = np.flatnonzero(np.append(True, all_[1:] != all_[:-1])) if len(all_) else np.empty(0, np.int64)
            c = np.diff(np.append(first, len(all_)))
            return pa.record_batch([pa.array(all_[first[c > 1]].view(np.int64)), pa.array(c[c > 1])], names=["token", "n"])

        tokens = 0
        for batch in batches:
            for text in batch.column(0):
                sets.append(shingle_set(text.as_py(), width))
                tokens += len(sets[-1])
                if len(sets) >= BLOCK_DOCS or tokens >= BLOCK_TOKENS:
                    yield out()
                    tokens = 0
        if sets:
            yield out()

    sums = cut(docs.select("text").mapInArrow(trimming(count), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")), "frequent")
    steps = {r.step: r["count"] for r in sums.groupBy(F.floor(F.log2("n") * 4).cast("int").alias("step")).count().collect()}  # some dozens
    least, room = 0, most
    for step in sorted(steps, reverse=True):
        if steps[step] > room:
            least = step + 1
            break
        room -= steps[step]
    top = sums.where(F.floor(F.log2("n") * 4) >= least).toArrow()
    release(sums)
    tokens = top.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top.column("n").to_numpy()[order]


def further_prefixes(values: np.ndarray, size: int) -> np.ndarray:
    """16 bits of each of the first `size` tokens under orders 2 and 3, ascending in each."""
    out = []
    for salt in ORDERS:
        h = mix64(values ^ np.uint64(salt))
        first = np.partition(h, size - 1)[:size] if size < len(h) else h
        out.append(np.sort((mix64(first) >> np.uint64(48)).astype(np.uint16)))
    return np.concatenate(out)


def describe(docs: DataFrame, width: int, percent: int, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """rid, k_id, k_hash, n, digest, frequent and prefix (tokens of order 1 that are in the table hot and that are not), further (prefixes of the other orders) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = shared.value
        for batch in batches:
            n, digest, frequent, prefix, further = [], [], [], [], []
            for text in batch.column(2):
                s = shingle_set(text.as_py(), width)
                size = prefix_size(len(s), percent) if len(s) else 0
                n.append(len(s))
                digest.append(set_digest(s))
                further.append(further_prefixes(s, size).tobytes() if size else b"")
                often = np.zeros(len(s), np.int64)
                if len(s) and len(tokens):
                    at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                    often = np.where(tokens[at] == s, counts[at], 0)
                    order = np.argsort(often, kind="stable")[:size]
                    s, often = s[order], often[order]
                s, often = s[:size], often[:size]
                frequent.append(s[often > 0])
                prefix.append(s[often == 0])
            columns = [batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array(digest, pa.binary()), _lists(frequent), _lists(prefix), pa.array(further, pa.binary())]
            yield pa.record_batch(columns, names=["k_id", "k_hash", "n", "digest", "frequent", "prefix", "further"])

    kind = "k_id long, k_hash long, n int, digest binary, frequent array<long>, prefix array<long>, further binary"
    return docs.select("k_id", "k_hash", "text").mapInArrow(trimming(each), kind).withColumn("rid", F.monotonically_increasing_id())


def _shared_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by their first column, those whose value another row has."""
    kept: pa.RecordBatch | None = None  # the last row, while its value may come again; whether it was given out
    given = False
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = pa.concat_batches([kept, batch]) if kept is not None else batch
        t = whole.column(0).to_numpy()
        same = t[1:] == t[:-1]
        mask = np.append(same, False) | np.insert(same, 0, False)
        if kept is not None and given:
            mask[0] = False
        last = mask[-1] or (given and len(t) == 1)
        yield whole.filter(pa.array(mask))
        kept, given = whole.slice(len(t) - 1), bool(last)


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How often each value of x, ascending, is met in y too, at most: the smaller of both counts."""
    a, n = np.unique(x, return_counts=True)
    b, m = np.unique(y, return_counts=True)
    at, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    return np.repeat(at, np.minimum(n[i], m[j]))


def shares_enough(n: np.ndarray, m: np.ndarray, x: pa.Array, y: pa.Array, percent: int) -> list[np.ndarray]:
    """For orders 2 and 3, which pairs of sets of n and m share as many prefix tokens, of the columns further, as similar sets do at least."""
    need = -(-percent * (n + m) // (100 + percent))
    p, q = n - -(-percent * n // 100) + 1, m - -(-percent * m // 100) + 1
    least = np.maximum(1, np.minimum(need - n + p, need - m + q))
    pair, out = np.arange(len(n)), []

    def keys(column: pa.Array, size: np.ndarray, order: int) -> np.ndarray:
        _, offsets, data = column.buffers()
        start = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column)] // 2 + order * size
        at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.repeat(pair, size) << 16 | np.frombuffer(data, np.uint16)[at]

    for order in range(len(ORDERS)):
        common = _common(keys(x, p, order), keys(y, q, order)) if len(n) else np.empty(0, np.int64)
        out.append(np.bincount(common >> 16, minlength=len(n)) >= least)
    return out


def filtered(pairs: DataFrame, further: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those that share enough prefix tokens under orders 2 and 3; further: c, n, further of the classes."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
            hit = np.logical_and.reduce(shares_enough(n, m, batch.column(4), batch.column(5), percent))
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(hit))

    x, y = further.toDF("x_c", "x_n", "x_further"), further.toDF("y_c", "y_n", "y_further")
    both = pairs.join(x, F.col("a") == F.col("x_c")).join(y, F.col("b") == F.col("y_c"))
    return both.select("a", "b", "x_n", "y_n", "x_further", "y_further").mapInArrow(trimming(each), "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose sets are similar."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = np.zeros(batch.num_rows, bool)
            flat = [(c.offsets.to_numpy(), c.values.to_numpy().view(np.uint64)) for c in (batch.column(2), batch.column(3))]
            for i in range(batch.num_rows):
                x, y = (v[o[i] : o[i + 1]] for o, v in flat)
                hit[i] = len(np.intersect1d(x, y, assume_unique=True)) >= needed_overlap(len(x), len(y), percent)
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(hit))

    x, y = sets.toDF("x_c", "x_set"), sets.toDF("y_c", "y_set")
    both = pairs.join(x, F.col("a") == F.col("x_c")).join(y, F.col("b") == F.col("y_c"))
    return both.select("a", "b", "x_set", "y_set").mapInArrow(trimming(each), "a long, b long")


def class_sets(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(c, set) of the classes (c, digest), shingled again from the texts that a bitmap of their digests lets through."""
    key = F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(classes.select(key.alias("key")), "key"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py(), width) for text in batch.column(0)]
            digests = [set_digest(s) for s in sets]
            some = np.flatnonzero(has(shared.value, np.array([int.from_bytes(d[:6], "big") for d in digests], np.uint64))).tolist()
            yield pa.record_batch([pa.array([digests[i] for i in some], pa.binary()), _lists([sets[i] for i in some])], names=["digest", "set"])

    found = docs.select("text").mapInArrow(trimming(each), "digest binary, set array<long>")
    one = found.withColumn("nth", F.row_number().over(Window.partitionBy("digest").orderBy("digest"))).where("nth = 1")
    return cut(one.join(classes.withColumnRenamed("digest", "c_digest"), F.col("digest") == F.col("c_digest")).select("c", "set"), "sets")


def _degrees(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """How many of the sets right each of left is similar to, and the other way round; a set is not met with itself."""
    size = np.array([len(x) for x in sets], np.int64)
    row = np.repeat(np.arange(len(sets)), size)
    _, col, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n > 1
    keep = shared[col]
    row, col = row[keep], (np.cumsum(shared) - 1)[col[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    common = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(col, (at, at + COLUMNS))
        m = np.zeros((len(sets), min(COLUMNS, int(shared.sum()) - at)), np.float32)
        m[row[a:b], col[a:b] - at] = 1
        common += np.rint(m[left] @ m[right].T).astype(np.int64)
    hit = (common * (100 + percent) >= percent * (size[left][:, None] + size[right][None, :])) & (left[:, None] != right[None, :])
    out = np.zeros(len(sets), np.int64)
    out[left] += hit.sum(1)
    if not np.array_equal(left, right):
        out[right] += hit.sum(0)
    return out


def link_counts(leads: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """d_c, n_links: how many other classes each class (c, comp) of components of several is similar to."""
    size = sets.select(F.col("c").alias("z_c"), F.size("set").alias("t"))
    blocks = F.ceil(F.greatest(F.col("m") / SIDE, F.col("t") / SIDE_TOKENS)).cast("int")
    sums = leads.join(size, F.col("c") == F.col("z_c")).groupBy(F.col("comp").alias("s_comp")).agg(F.count("*").alias("m"), F.sum("t").alias("t"))
    sums = cut(sums.where("m > 1").withColumn("blocks", blocks), "blocks")
    two = leads.join(sums.where("m = 2"), F.col("comp") == F.col("s_comp")).select(F.col("c").alias("d_c"), F.lit(1).cast("long").alias("n_links"))
    # Only sets of larger components are met; where these are few, they are picked out without moving any other.
    many = cut(leads.join(sums.where("m > 2"), F.col("comp") == F.col("s_comp")).select(F.col("c").alias("l_c"), "comp", "blocks"), "larger")
    own = sets.join(F.broadcast(many) if few(many) else many, F.col("c") == F.col("l_c"))
    b, o = F.pmod(F.xxhash64("c", F.lit(11)), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = own.withColumn("b", b).withColumn("o", o)
    dealt = dealt.select("comp", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "c", "set")

    def each(group: pa.Table) -> pa.Table:
        side = group.column("b").to_numpy()
        lists = [x for chunk in group.column("set").chunks for x in np.split(chunk.flatten().to_numpy(), np.cumsum(chunk.value_lengths().to_numpy())[:-1])]
        left = np.flatnonzero(side == side.min())
        right = np.flatnonzero(side == side.max())
        alone = group.column("i")[0].as_py() != group.column("j")[0].as_py() and side.min() == side.max()  # the other block is empty
        n = np.zeros(len(side), np.int64) if alone else _degrees(lists, left, right, percent)
        return pa.table({"c": group.column("c"), "n": pa.array(n)})

    counted = dealt.groupBy("comp", "i", "j").applyInArrow(each, "c long, n long")
    return counted.groupBy(F.col("c").alias("d_c")).agg(F.sum("n").alias("n_links")).union(two)


def jaccard_groups(docs: DataFrame, width: int = WIDTH, percent: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(rows, links).

    rows: rid, k_id, k_hash, n, c, comp: a row per document row with its class and component (ids of classes).
    links: a, b, verified pairs of classes that span the components.
    """
    return _grouped(docs, width, percent)[:2]


def _grouped(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows, links, leads, sets).

    rows: rid, k_id, k_hash, n, c, comp: a row per document row with its class and component (ids of classes).
    links: a, b, verified pairs of classes that span the components.
    leads: digest, c, comp, a row per class; sets: c, set of at least those that have links.
    """
    own = keyed(pick(docs, "doc_id", "text"))
    hot = frequent_tokens(own, width, HOT_MAX)
    described = cut(describe(own, width, percent, hot), "described")
    rows = cut(described.select("rid", "k_id", "k_hash", "n", "digest"), "rows")

    # One row of a class goes on; the others are taken out by a table that is broadcast only if it is small.
    leads = cut(rows.where("n > 0").groupBy("digest").agg(F.min("rid").alias("c")), "leads")
    slim = rows.where("n > 0").select("rid", F.col("digest").alias("r_digest"))
    copies = cut(slim.join(leads, F.col("r_digest") == F.col("digest")).where("rid <> c").select("rid"), "copies")
    classes = described.where("n > 0").select("rid", "n", "frequent", "prefix", "further").join(F.broadcast(copies) if few(copies) else copies, "rid", "left_anti")
    further = classes.select(F.col("rid").alias("c"), "n", "further")
    postings = lambda c: classes.select(F.explode(c).alias("token"), F.col("rid").alias("c"), "n")
    rare = postings("prefix").repartition("token").sortWithinPartitions("token").mapInArrow(trimming(_shared_runs), "token long, c long, n int")
    runs = cut(rare.union(postings("frequent")), "runs")

    length = runs.groupBy("token").agg(F.count("*").alias("k"))
    long_tokens = cut(length.where(F.col("k") > SHORT), "long")
    in_short = runs.join(F.broadcast(long_tokens) if few(long_tokens) else long_tokens, "token", "left_anti")
    in_long = runs.join(long_tokens, "token")
    extra = cut(in_long.groupBy("c").agg(F.count("*").alias("more")), "extra")  # long runs that a class is in
    # nth: where a class's tokens of long runs come in one order of them all.
    nth = F.row_number().over(Window.partitionBy("c").orderBy("k", "token"))
    in_long = cut(in_long.join(extra.withColumnRenamed("c", "e_c"), F.col("c") == F.col("e_c")).drop("e_c").withColumn("nth", nth), "long-runs")

    near = lambda n, m: (F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m))

    def need(n: Column, m: Column) -> Column:
        """How many prefix tokens similar sets of n and m share, at least."""
        size = lambda x: x - F.ceil(F.lit(percent) * x / 100) + 1
        both = F.ceil(F.lit(percent) * (n + m) / (100 + percent))
        return F.least(both - n + size(n), both - m + size(m))

    x, y = in_short.toDF("token", "a", "a_n"), in_short.toDF("token", "b", "b_n")
    shared = x.join(y, "token").where((F.col("a") < F.col("b")) & near(F.col("a_n"), F.col("b_n"))).groupBy("a", "b", "a_n", "b_n").agg(F.count("*").alias("common"))
    shared = shared.join(extra.toDF("e_a", "a_more"), F.col("a") == F.col("e_a"), "left").join(extra.toDF("e_b", "b_more"), F.col("b") == F.col("e_b"), "left")
    most = F.col("common") + F.least(F.coalesce("a_more", F.lit(0)), F.coalesce("b_more", F.lit(0)))
    candidates = cut(shared.where(most >= need(F.col("a_n"), F.col("b_n"))).select("a", "b"), "candidates")
    ends = lambda pairs: pairs.select(F.col("a").alias("p")).union(pairs.select("b")).union(extra.select("c")).distinct()
    further = cut(further.join(ends(candidates), F.col("c") == F.col("p"), "left_semi"), "further")
    release(described, runs, long_tokens)
    pairs = cut(filtered(candidates, further, percent), "pairs")
    members = cut(leads.join(ends(pairs), F.col("c") == F.col("p"), "left_semi"), "members")
    sets = class_sets(own, members, width)
    release(candidates, members, extra)

    # Longer runs: a hub and the others; u orders the classes, so that each pair is met once, from its hub of smaller u.
    u = lambda c: F.pmod(F.xxhash64(c, F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    longest = in_long.agg(F.max("k")).first()[0] or 0

    def hub_pairs(low: float, high: float, labels: DataFrame | None) -> DataFrame | None:
        """Pairs of hubs and others of different components; None if no run has such any more."""
        open_, mixed = in_long.withColumn("comp", F.col("c")), None
        if labels is not None:
            open_ = in_long.join(labels, F.col("c") == F.col("id"), "left").withColumn("comp", F.coalesce("comp", "c"))
            mixed = cut(open_.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token"), "mixed")
            if mixed.isEmpty():
                return None
            open_ = cut(open_.select("token", "c", "n", "k", "more", "nth", "comp").join(mixed, "token"), "open-runs")
        hubs = open_.where((u(F.col("c")) >= F.lit(low) / F.col("k")) & (u(F.col("c")) < F.lit(high) / F.col("k")))
        hubs = hubs.select("token", F.col("c").alias("h"), F.col("n").alias("h_n"), F.col("more").alias("h_more"), F.col("nth").alias("h_nth"), F.col("comp").alias("h_comp"))
        # The first token that both share has need - 1 more after it, in either class.
        room = F.least(F.col("more") - F.col("nth"), F.col("h_more") - F.col("h_nth")) + 1 >= need(F.col("n"), F.col("h_n"))
        met = hubs.join(open_, "token").where((F.col("comp") != F.col("h_comp")) & near(F.col("n"), F.col("h_n")) & room)
        met = met.where((u(F.col("c")) > u(F.col("h"))) | ((u(F.col("c")) == u(F.col("h"))) & (F.col("c") > F.col("h"))))
        found = cut(filtered(met.select(F.least("c", "h").alias("a"), F.greatest("c", "h").alias("b")).distinct(), further, percent), "pairs")
        if mixed is not None:
            release(mixed, open_)
        return found

    high, labels, links = 1.5, None, docs.sparkSession.createDataFrame([], "a long, b long")
    if longest:
        pairs = cut(pairs.union(hub_pairs(0.0, high, None)).distinct(), "pairs")
    while True:
        if not pairs.isEmpty():
            before, links = links, cut(links.union(verified(pairs, sets, percent)), "links")
            release(before, pairs, *([labels] if labels is not None else []))
            labels = components(links)
        if high >= longest:
            break
        low, high = high, high * MORE
        pairs = hub_pairs(low, high, labels)
        if pairs is None:
            break
    if labels is None:
        labels = links.select(F.col("a").alias("id"), F.col("a").alias("comp"))

    leads = cut(leads.join(labels, F.col("c") == F.col("id"), "left").select("digest", "c", F.coalesce("comp", "c").alias("comp")), "labelled")
    worded = rows.where("n > 0").join(leads.withColumnRenamed("digest", "l_digest"), F.col("digest") == F.col("l_digest"))
    wordless = rows.where("n = 0").select("rid", "k_id", "k_hash", "n", F.col("rid").alias("c"), F.col("rid").alias("comp"))
    return worded.select("rid", "k_id", "k_hash", "n", "c", "comp").unionByName(wordless), links, leads, sets


def _least(rows: DataFrame) -> DataFrame:
    """comp with its first row: the least doc_id (null last), then the least rid."""
    return rows.groupBy("comp").agg(F.min(F.struct((F.col("k_id") == F.lit(-(2**63))).alias("none"), "k_id", "rid")).alias("least")).withColumnRenamed("comp", "l_comp")


def jaccard_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, and the number of other classes that link with the row's class."""
    with scratch() as keep:
        rows, _, leads, sets = _grouped(docs, WIDTH, THRESHOLD)
        rows = cut(rows, "grouped")
        ends = link_counts(leads, sets, THRESHOLD)
        out = rows.join(cut(_least(rows), "least"), F.col("comp") == F.col("l_comp")).join(ends, F.col("c") == F.col("d_c"), "left")
        out = out.select(
            doc_id_of(F.col("k_id")).alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), doc_id_of(F.col("least.k_id")).alias("component_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_class_links"),
        )
        return keep(cut(out, "report"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """docs with one row of each component, that of the least doc_id; wordless rows all stay."""
    own = Hidden(docs, "doc_id", "text")
    with scratch() as keep:
        rows, _ = jaccard_groups(own.df)
        rows = cut(rows, "grouped")
        best = _least(rows).select("least.k_id", "least.rid")
        first = rows.join(best.toDF("b_id", "b_rid"), F.col("rid") == F.col("b_rid"), "left_semi")
        keys = keep(cut(first.groupBy(F.col("k_id").alias("g_id"), F.col("k_hash").alias("g_hash")).agg(F.count("*").alias("copies")), "kept"))
    nth = F.row_number().over(Window.partitionBy("k_id", "k_hash").orderBy("k_id"))
    left = keyed(own.df).join(keys, (F.col("k_id") == F.col("g_id")) & (F.col("k_hash") == F.col("g_hash")))
    return own.shown(left.withColumn("g_nth", nth).where("g_nth <= copies"))


#: The report: shingles met by an equi-join, components by a recursive closure.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS x FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(v, ' ') AS sh
  FROM (SELECT doc_id, unnest(CASE WHEN len(x) = 0 THEN [] WHEN len(x) < 5 THEN [x] ELSE list_transform(range(1, len(x) - 3), lambda i: x[i:i + 4]) END) AS v FROM w)),
d AS (SELECT doc_id, count(*) AS n, md5(string_agg(sh, chr(10) ORDER BY sh)) AS sig FROM s GROUP BY doc_id),
k AS (SELECT sig, min(doc_id) AS c, min(n) AS n FROM d GROUP BY sig),
t AS (SELECT c, n, sh FROM k JOIN s ON s.doc_id = k.c),
p AS (
  SELECT a.c AS a, b.c AS b FROM t a JOIN t b ON a.sh = b.sh AND a.c < b.c AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT c, c AS o FROM k UNION SELECT r.c, e.b FROM r JOIN e ON e.a = r.o),
m AS (SELECT c, min(o) AS comp FROM r GROUP BY c),
l AS (SELECT a, count(*) AS links FROM e GROUP BY a)
SELECT w.doc_id, coalesce(d.n, 0) AS n_shingles, coalesce(m.comp, w.doc_id) AS component_id, coalesce(l.links, 0) AS n_class_links
FROM w LEFT JOIN d ON d.doc_id = w.doc_id LEFT JOIN k ON k.sig = d.sig LEFT JOIN m ON m.c = k.c LEFT JOIN l ON l.a = k.c
"""
