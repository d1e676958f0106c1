"""Exact inner-product search: ball trees per shard, branch and bound, shared k-th scores.

Candidates are dealt to shards of bounded size by a hash, so a vector that thousands of rows repeat is spread like any
other.  Each shard becomes one row: its vectors in the order of a ball tree, and the tree.  Queries travel in blocks.  In a
first wave a block searches its own shard, which yields a k-th best score for each query; with it the
block then searches the other shards, where a node is visited only by queries whose upper bound (query . centre +
|query| * radius) reaches their k-th score.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aisleworks.llm.shared import stored

SCALE = 256
SHARD_ROWS = 8192
LEAF_ROWS = 256
_NO_SCORE = -(2**63)

_FOUND = "query_id long, vec_id long, score long"


def _packed(*arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, *arrays)
    return out.getvalue()


def _unpacked(data: bytes) -> list[np.ndarray]:
    with np.load(io.BytesIO(data)) as arrays:
        return [arrays[name] for name in arrays.files]


def build_tree(vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, ...]:
    """(order, begins, ends, children, centres, radii) of a ball tree; a leaf's first child is -1.

    Nodes are halved at the median of their widest dimension, so equal vectors make no deep trees.
    """
    order = np.arange(len(vectors))
    begins, ends, children, centres, radii = [], [], [], [], []

    def add(begin: int, end: int) -> int:
        own = vectors[order[begin:end]].astype(float)
        centre = own.mean(axis=0)
        begins.append(begin), ends.append(end), children.append((-1, -1)), centres.append(centre)
        radii.append(float(np.sqrt(((own - centre) ** 2).sum(axis=1).max())))
        return len(begins) - 1

    open_nodes = [add(0, len(vectors))]
    while open_nodes:
        node = open_nodes.pop()
        begin, end = begins[node], ends[node]
        if end - begin <= leaf_rows or radii[node] == 0:
            continue
        own = vectors[order[begin:end]]
        widest = int((own.max(axis=0) - own.min(axis=0)).argmax())
        middle = (end - begin) // 2
        order[begin:end] = order[begin:end][np.argpartition(own[:, widest], middle)]
        pair = (add(begin, begin + middle), add(begin + middle, end))
        children[node] = pair
        open_nodes.extend(pair)
    return order, np.array(begins), np.array(ends), np.array(children), np.array(centres), np.array(radii)


def _tree_row(group: pd.DataFrame) -> pd.DataFrame:
    ids = group["vec_id"].to_numpy(np.int64)
    vectors = np.stack(group["vector"].to_numpy()).astype(np.int64).reshape(len(ids), -1)
    small = np.abs(vectors).max(initial=0) < 2**15
    order, *tree = build_tree(vectors)
    data = _packed(ids[order], vectors[order].astype(np.int16 if small else np.int64), *tree)
    return pd.DataFrame({"size": [group["size"].iloc[0]], "shard": [group["shard"].iloc[0]], "tree": [data]})


def _block_row(group: pd.DataFrame) -> pd.DataFrame:
    ids = group["vec_id"].to_numpy(np.int64)
    vectors = np.stack(group["vector"].to_numpy()).astype(np.int64).reshape(len(ids), -1)
    return pd.DataFrame({"size": [group["size"].iloc[0]], "home": [group["shard"].iloc[0]], "queries": [_packed(ids, vectors)]})


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer inner products; floats are used only where they are exact."""
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[1]
    if largest < 2**53:
        return (queries.astype(float) @ vectors.astype(float).T).astype(np.int64)
    return (queries.astype(object) @ vectors.astype(object).T).astype(np.int64)  # raises beyond 64 bits


def search(
    query_ids: np.ndarray, queries: np.ndarray, kth: np.ndarray, k: int, data: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """(vec_ids, scores), each queries x k, best first and ties to smaller ids; places not filled score ``_NO_SCORE``.

    ``kth`` is a score that each query's k-th best is known to reach; nothing below it is returned.
    """
    ids, vectors, begins, ends, children, centres, radii = data
    best = np.full((len(queries), k), _NO_SCORE)
    best_ids = np.full((len(queries), k), np.iinfo(np.int64).max)
    floor = kth.copy()
    norms = np.sqrt((queries.astype(float) ** 2).sum(axis=1))
    # A little is added to each bound, so that rounding never hides a tie.
    bounds = queries.astype(float) @ centres.T + norms[:, None] * radii[None, :]
    bounds += 1 + 1e-9 * (np.abs(queries.astype(float)) @ np.abs(centres).T + norms[:, None] * radii[None, :])
    waiting = [(0, np.arange(len(queries)))]
    while waiting:
        node, active = waiting.pop()
        active = active[bounds[active, node] >= floor[active]]
        if not len(active):
            continue
        if children[node][0] >= 0:
            pair = sorted(children[node], key=lambda child: bounds[active, child].sum())
            waiting.extend((child, active) for child in pair)  # the likelier child is taken first
            continue
        here = slice(begins[node], ends[node])
        scores = _products(queries[active], vectors[here])
        own = np.broadcast_to(ids[here], scores.shape)
        keep = (scores >= floor[active, None]) & (own != query_ids[active, None])
        hit = keep.any(axis=1)
        if not hit.any():
            continue
        active, scores, own, keep = active[hit], scores[hit], own[hit], keep[hit]
        every = np.concatenate([best[active], np.where(keep, scores, _NO_SCORE)], axis=1)
        every_ids = np.concatenate([best_ids[active], np.where(keep, own, np.iinfo(np.int64).max)], axis=1)
        # Complement instead of minus: the lowest number has no positive counterpart.
        order = np.lexsort((every_ids, ~every), axis=1)[:, :k]
        best[active] = np.take_along_axis(every, order, axis=1)
        best_ids[active] = np.take_along_axis(every_ids, order, axis=1)
        floor[active] = np.maximum(floor[active], best[active, k - 1])
    return best_ids, best


def _searched(k: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, tree, known in zip(batch["queries"], batch["tree"], batch["kth"]):
                query_ids, queries = _unpacked(block)
                kth = np.full(len(query_ids), _NO_SCORE)
                if known is not None:
                    kth = np.array([dict(known).get(int(q), _NO_SCORE) for q in query_ids], np.int64)
                ids, scores = search(query_ids, queries, kth, k, _unpacked(tree))
                row, place = np.nonzero(ids != np.iinfo(np.int64).max)
                yield pd.DataFrame(
                    {"query_id": query_ids[row], "vec_id": ids[row, place], "score": scores[row, place]}
                )

    return run


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector, size): floor(256 * x) of every component, x as double.

    Vectors that are NULL or hold NULL or non-finite components, and rows without vec_id, take no part.  Of
    rows that share a vec_id the one with the smallest vector counts.
    """
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("embedding"))
        .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(whole)
        .select("vec_id", F.transform("embedding", lambda x: F.floor(x * SCALE)).alias("vector"))
        .groupBy("vec_id").agg(F.min("vector").alias("vector"))
        .withColumn("size", F.size("vector"))
    )


def exact_top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query, ties to smaller vec_id.

    Both frames have (vec_id, embedding); see ``quantised`` for which rows count.  A query's own vec_id is no
    candidate; vectors of different lengths are not compared.  With fewer than k candidates all are
    returned; empty tables give an empty result; other columns are ignored.  Scores beyond 64 bits fail.
    """
    vectors = stored(quantised(candidates), "vectors")
    counts = {row["size"]: row["count"] for row in vectors.groupBy("size").count().collect()}  # a row per vector length
    shards = {size: -(-count // shard_rows) for size, count in counts.items()}
    number = F.coalesce(*(F.when(F.col("size") == size, F.lit(n)) for size, n in shards.items()), F.lit(0)) if shards else F.lit(0)
    own = F.pmod(F.xxhash64("vec_id"), number).cast("int")
    trees = stored(
        vectors.withColumn("shard", own).groupBy("size", "shard")
        .applyInPandas(_tree_row, "size int, shard int, tree binary"),
        "trees",
    )
    blocks = stored(
        quantised(queries).filter(number > 0).withColumn("shard", own).groupBy("size", "shard")
        .applyInPandas(_block_row, "size int, home int, queries binary"),
        "blocks",
    )
    nothing = F.lit(None).cast("array<struct<query_id:bigint,score:bigint>>")
    first = blocks.join(trees, (blocks["size"] == trees["size"]) & (blocks["home"] == trees["shard"])).select(
        blocks["size"], "home", "queries", "tree", nothing.alias("kth")
    )
    run = _searched(k)
    near = stored(first.select("queries", "tree", "kth").mapInPandas(run, _FOUND), "near")
    # A query's k-th score is known where its own shard holds k others; the block's are carried with it.
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    known = (
        near.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") == k)
        .join(quantised(queries).withColumn("home", own).select(F.col("vec_id").alias("query_id"), "size", "home"), "query_id")
        .groupBy("size", "home").agg(F.collect_list(F.struct("query_id", "score")).alias("kth"))
    )
    others = (
        blocks.join(known, ["size", "home"], "left")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), number - 1)))
        .filter("shard <> home")
        .join(trees, ["size", "shard"])
        .select("queries", "tree", "kth")
    )
    found = near.unionByName(others.mapInPandas(run, _FOUND))
    return (
        found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
