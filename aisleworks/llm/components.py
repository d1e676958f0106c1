"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleworks.llm.shared import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star round over distinct edges (low, high) with low < high.

    A node's least neighbour is a minimum combined before the shuffle.  It is stored, so that
    both sides of the join are plain shuffles, which adaptive execution splits at a hub.
    """
    if large:
        near = edges.select(F.col("high").alias("node"), F.col("low").alias("next")).unionByName(
            edges.select(F.col("low").alias("node"), F.col("high").alias("next"))
        )
    else:
        near = edges.select(F.col("high").alias("node"), F.col("low").alias("next"))
    least = stored(
        near.groupBy("node").agg(F.min("next").alias("least"))
        .select("node", F.least("node", "least").alias("least")),
        "least",
    )
    joined = near.join(least, "node")
    if large:
        moved = joined.filter("next > node").select(F.col("least").alias("low"), F.col("next").alias("high"))
    else:
        moved = joined.filter("next > least").select(F.col("least").alias("low"), F.col("next").alias("high")).unionByName(
            least.select(F.col("least").alias("low"), F.col("node").alias("high"))
        )
    return moved.filter("low < high").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (low, high): the smallest node reachable.

    Edges may repeat, point both ways and be loops; NULL ends are left out.  Rounds go on until the
    edges no longer change, that is until each component is a star around its smallest node;
    that takes about the logarithm of the longest path.  Every round is stored.
    """
    edges = stored(
        edges.select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high"))
        .filter(edges["low"].isNotNull() & edges["high"].isNotNull())
        .filter("low < high")
        .distinct(),
        "edges",
    )
    mark = [F.count(F.lit(1)), F.bit_xor(F.xxhash64("low", "high")), F.sum(F.xxhash64("low", "high") % 1000003)]
    before = edges.agg(*mark).first()
    while True:
        edges = stored(_star(_star(edges, large=True), large=False), "edges")
        now = edges.agg(*mark).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )
