"""Connected components by contraction: hook every node to its least neighbour, jump pointers, relabel, repeat.

Edges stay distributed; every round cuts lineage through the shared folder. A node with
very many edges is an equi-join key that AQE may split, or a partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from korvane.session import cut, scratch


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every id of edges (a long, b long); comp is the least id reachable."""
    with scratch() as keep:
        return keep(_contracted(edges))


def _contracted(edges: DataFrame) -> DataFrame:
    cur = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    ids = cur.select(F.col("hi").alias("id")).union(cur.select("lo")).distinct()
    labels = cut(ids.select("id", F.col("id").alias("comp")), "labels")
    while not cur.isEmpty():
        up = cut(cur.groupBy("hi").agg(F.min("lo").alias("up")), "up")
        while True:
            over = up.select(F.col("hi").alias("o_hi"), F.col("up").alias("o_up"))
            jumped = cut(up.join(over, F.col("up") == F.col("o_hi"), "left").select("hi", F.coalesce("o_up", "up").alias("up"), F.col("o_up").isNotNull().alias("moved")), "up")
            up = jumped.select("hi", "up")
            if jumped.where("moved").isEmpty():
                break
        a, b = up.toDF("a_hi", "a_up"), up.toDF("b_hi", "b_up")
        moved = cur.join(a, F.col("hi") == F.col("a_hi"), "left").join(b, F.col("lo") == F.col("b_hi"), "left")
        moved = moved.select(F.coalesce("a_up", "hi").alias("x"), F.coalesce("b_up", "lo").alias("y")).where("x <> y")
        cur = cut(moved.select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct(), "edges")
        labels = cut(labels.join(a, F.col("comp") == F.col("a_hi"), "left").select("id", F.coalesce("a_up", "comp").alias("comp")), "labels")
    return labels
