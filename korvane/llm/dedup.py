"""Exact dedup with a heavy-hitter split, in DataFrame operations only.

Misra-Gries counters (DataFrame.stat.freqItems) name the fingerprints that may be
frequent, at most 1/support of them. Their groups are counted exactly, and the
verified winners, a table with that same proven bound, are broadcast: rows of
frequent texts get their answer on the map side and never meet in one task. The
other digests have groups below support of all rows and go through an ordinary
shuffle (partial aggregation, then an equi-join that AQE may split).

Defined cases: a null text counts as the empty text; null doc_ids sort lowest; of
rows equal in text and doc_id exactly one is kept; an empty table gives no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korvane.session import cut, pick

#: A digest with this share of all rows is surely found by Misra-Gries.
SUPPORT = 0.0005


def exact_dedup(docs: DataFrame, text: Column | None = None, support: float = SUPPORT) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    text: what must be equal, an expression over doc_id and text (default: the text as it is).
    """
    own = F.coalesce(F.col("text") if text is None else text, F.lit(""))
    slim = pick(docs, "doc_id", "text").select("doc_id", F.unhex(F.sha2(own, 256)).alias("digest"), F.monotonically_increasing_id().alias("rid"))
    slim = cut(slim.withColumn("fp", F.xxhash64("digest")), "digests")

    frequent = slim.stat.freqItems(["fp"], support).select(F.explode("fp_freqItems").alias("fp"))
    last = F.max(F.struct("doc_id", "rid")).alias("last")
    winners = slim.join(F.broadcast(frequent), "fp", "left_semi").groupBy("digest").agg(last, F.count("*").alias("group_size"))
    winners = cut(winners.where("group_size > 1"), "winners")

    marked = slim.join(F.broadcast(winners), "digest", "left")
    hot = marked.where("last is not null")
    rest = marked.where("last is null").select("doc_id", "digest", "rid")
    groups = rest.groupBy("digest").agg(last, F.count("*").alias("group_size"))
    cold = rest.join(groups, "digest")
    return hot.select("doc_id", "digest", "rid", "last", "group_size").unionByName(cold.select("doc_id", "digest", "rid", "last", "group_size")).select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("rid") == F.col("last.rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


ORACLE = """
WITH h AS (SELECT doc_id, sha256(coalesce(text, '')) AS s FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY s) AS kept, s AS text_sha256
FROM h
"""
