"""Hard negatives by slot-decomposed selection.

An anchor's positives are its nearest rows of its own label; a row of another label is a hard negative of a positive if
its score lies in a window that ends at the positive's own.  The windows of an anchor overlap.  The scores of its
positives, which are their upper limits, split the scores into disjoint slots.  Tasks multiply blocks of anchors with
shards of rows and combine what they find to the first k rows of each slot, however many rows there are; merged from
the lowest slot up, the slots give the first k rows below each limit, and with them every window at once.

Two waves read the same shards: the first keeps rows of the anchor's label, the second all others.  A shard and a
block take far longer to multiply than to send, so each block is sent to each group of shards.
"""

from __future__ import annotations

import io
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisleworks.llm.shared import stored

SCALE = 256
SHARD_ROWS, BLOCK_ROWS = 8192, 1024
#: Shards that follow one another in a task, so that what they hold is combined there.
GROUP_SHARDS = 16
#: A table too small for that many shards is cut finer, down to so many rows, so that all cores work.
LEAST_ROWS = 1024
#: Scores compared at a time: 16 MB of them.
TILE = 2**21

_LOWEST, _HIGHEST = -(2**63), 2**63 - 1


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vector, size) of the rows that take part.

    Rows without vec_id, label or vector, or with a NULL or non-finite component, do not.  Of rows that share a vec_id the
    one with the smallest label, then vector, counts.
    """
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    named = rows.select(
        rows["vec_id"].cast("long").alias("vec_id"), rows["label"].cast("long").alias("label"),
        rows["embedding"].cast("array<double>").alias("vector"),
    )
    return (
        named.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").filter(whole)
        .groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
        .select("vec_id", "row.*", F.size("row.vector").alias("size"))
    )


def quantised(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of each component: as 16-bit numbers, as doubles where those are exact, or as Python's integers."""
    largest = float(np.abs(vectors).max(initial=0))
    if largest < 2**15 / SCALE - 1:
        return np.floor(SCALE * vectors).astype(np.int16)
    if largest < 2**52 / SCALE:
        return np.floor(SCALE * vectors)
    whole = [[math.floor(SCALE * x) if abs(x) < 2**52 else SCALE * int(x) for x in row] for row in vectors.tolist()]
    return np.array(whole, dtype=object)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer inner products; those beyond 64 bits count as the nearest number within."""
    if left.dtype != object and right.dtype != object:
        bound = float(np.abs(left.astype(float)).max(initial=0)) * float(np.abs(right.astype(float)).max(initial=0)) * left.shape[1]
        if bound < 2**53:  # no partial sum leaves what the float type holds exactly
            kind = np.float32 if bound < 2**24 else np.float64
            return (left.astype(kind) @ right.astype(kind).T).astype(np.int64)
    exact = _whole(left) @ _whole(right).T if left.shape[1] else np.zeros((len(left), len(right)), object)
    return np.clip(exact, -_HIGHEST, _HIGHEST).astype(np.int64)


def _whole(numbers: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in numbers.tolist()], dtype=object).reshape(numbers.shape)


def window_floor(limit: int, percent: int) -> int:
    """The least score of the window below ``limit``; greater than it where the window is empty.

    >>> window_floor(101, 80), window_floor(0, 80), window_floor(-10, 80)
    (81, 0, -8)
    """
    return -(-(percent * limit) // 100)


# A pack holds rows of one vector length, sorted by vec_id, as a row of its own.

_PACK = "size int, part int, pack binary"


def _packed(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("vec_id")
    size = int(group["size"].iloc[0])
    vectors = np.array(group["vector"].tolist(), float).reshape(len(group), size)
    parts = {"ids": group["vec_id"].to_numpy(np.int64), "labels": group["label"].to_numpy(np.int64)}
    if float(np.abs(vectors).max(initial=0)) < 2**15 / SCALE - 1:
        parts["small"] = quantised(vectors)
    else:
        parts["vectors"] = vectors
    if "limits" in group:
        limits = group["limits"].tolist()
        parts["limits"] = np.full((len(group), max(map(len, limits))), _LOWEST)
        for row, own in zip(parts["limits"], limits):
            row[: len(own)] = own
    out = io.BytesIO()
    np.savez(out, **parts)
    return pd.DataFrame({"size": [size], "part": [group["part"].iloc[0]], "pack": [out.getvalue()]})


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as arrays:
        parts = {name: arrays[name] for name in arrays.files}
    parts["rows"] = parts["small"] if "small" in parts else quantised(parts["vectors"])
    return parts


class Slots:
    """The first k rows of each slot of each anchor of a block, best score first and ties to smaller ids.

    A row is in slot j of an anchor if ``low[j] <= score <= high[j]`` there; the slots of an anchor are disjoint.
    """

    def __init__(self, anchors: dict[str, np.ndarray], low: np.ndarray, high: np.ndarray, same: bool, k: int):
        self.anchors, self.low, self.high, self.same, self.k = anchors, low, high, same, k
        self.scores = np.full((*low.shape, k), _LOWEST)
        self.ids = np.full((*low.shape, k), _HIGHEST)

    def add(self, shard: dict[str, np.ndarray]) -> None:
        """Combine the rows of a shard, whose ids ascend, with those found before."""
        step = max(1, TILE // max(1, len(shard["ids"])))
        for begin in range(0, len(self.low), step):
            here = slice(begin, begin + step)
            scores = products(self.anchors["rows"][here], shard["rows"])
            mine = self.anchors["labels"][here, None] == shard["labels"]
            wanted = mine & (self.anchors["ids"][here, None] != shard["ids"]) if self.same else ~mine
            for slot in range(self.low.shape[1]):
                least = np.maximum(self.low[here, slot], self.scores[here, slot, -1])
                inside = wanted & (scores >= least[:, None]) & (scores <= self.high[here, slot, None])
                active = np.flatnonzero(inside.any(axis=1))
                if len(active):
                    self._take(begin + active, slot, np.where(inside[active], scores[active], _LOWEST), shard["ids"])

    def _take(self, anchors: np.ndarray, slot: int, scores: np.ndarray, ids: np.ndarray) -> None:
        # The first of equal maxima has the smallest id.
        found = np.full((len(anchors), self.k), _LOWEST)
        found_ids = np.full((len(anchors), self.k), _HIGHEST)
        every = np.arange(len(anchors))
        for place in range(min(self.k, scores.shape[1])):
            best = scores.argmax(axis=1)
            found[:, place] = scores[every, best]
            found_ids[:, place] = np.where(found[:, place] == _LOWEST, _HIGHEST, ids[best])
            scores[every, best] = _LOWEST
        both = np.concatenate([self.scores[anchors, slot], found], axis=1)
        both_ids = np.concatenate([self.ids[anchors, slot], found_ids], axis=1)
        order = np.lexsort((both_ids, ~both), axis=1)[:, : self.k]
        self.scores[anchors, slot] = np.take_along_axis(both, order, axis=1)
        self.ids[anchors, slot] = np.take_along_axis(both_ids, order, axis=1)

    def rows(self) -> pd.DataFrame:
        anchor, slot, place = np.nonzero(self.scores != _LOWEST)
        return pd.DataFrame({
            "anchor_id": self.anchors["ids"][anchor], "slot": slot.astype(np.int32),
            "vec_id": self.ids[anchor, slot, place], "score": self.scores[anchor, slot, place],
        })


_FOUND = "anchor_id long, slot int, vec_id long, score long"


def _slots(anchors: dict[str, np.ndarray], percent: int, k: int) -> Slots:
    """Empty slots of a block: one without bounds for positives, one per limit for negatives."""
    count = len(anchors["ids"])
    if "limits" not in anchors:
        return Slots(anchors, np.full((count, 1), -_HIGHEST), np.full((count, 1), _HIGHEST), True, k)
    limits = anchors["limits"]
    low = np.full(limits.shape, _HIGHEST)
    for row, slot in zip(*np.nonzero(limits != _LOWEST)):
        below = int(limits[row, slot + 1]) + 1 if slot + 1 < limits.shape[1] else _LOWEST
        low[row, slot] = max(window_floor(int(limits[row, slot]), percent), below)
    return Slots(anchors, low, limits, False, k)


def _wave(percent: int, k: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Search a task's pairs of block and shard; what one block finds in shards that follow each other is combined."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_block, slots = None, None
        for batch in batches:
            for size, block, anchors, shard in zip(batch["size"], batch["block"], batch["anchors"], batch["shard"]):
                if open_block != (size, block):
                    if slots is not None:
                        yield slots.rows()
                    open_block, slots = (size, block), _slots(_unpacked(anchors), percent, k)
                slots.add(_unpacked(shard))
        if slots is not None:
            yield slots.rows()

    return run


def _number(size: Column, numbers: dict[int, int]) -> Column:
    """The number given for a vector length, 1 for others."""
    chosen = [F.when(size == F.lit(length), F.lit(number)) for length, number in numbers.items()]
    return F.coalesce(*chosen, F.lit(1))


def _packs(rows: DataFrame, numbers: dict[int, int]) -> DataFrame:
    """Rows dealt by a hash of vec_id to so many packs of each vector length."""
    part = F.pmod(F.xxhash64("vec_id"), _number(F.col("size"), numbers)).cast("int")
    return stored(rows.withColumn("part", part).groupBy("size", "part").applyInPandas(_packed, _PACK), "packs")


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def hard_negatives(
    rows: DataFrame, anchors: str = "vec_id % 100 = 0", positives: int = 5, negatives: int = 5, percent: int = 80,
    shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), ranked from 1 per anchor and positive.

    ``rows`` has (vec_id, embedding, label); ``usable`` says which count.  Anchors are those that meet the condition
    ``anchors``.  The score of a row is its integer inner product with the anchor, of components ``floor(256 * x)``;
    higher ones come first, ties by smaller vec_id, and one beyond 64 bits counts as the nearest number within.  An
    anchor's positives are its first ``positives`` other rows of its label, or all.  The negatives of a positive are the
    first ``negatives`` rows of other labels with ``percent / 100 * positive_score <= score <= positive_score``;
    below 0 that window is empty.  Vectors of different lengths are not compared.  Positives without
    negatives have no row; an empty table gives an empty result; other columns are ignored.
    """
    vectors = stored(usable(rows), "vectors")
    # A row per vector length comes to the driver.
    counts = vectors.groupBy("size").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.expr(anchors)).alias("anchors")).collect()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    fine = {c["size"]: max(-(-c["rows"] // shard_rows), min(2 * cores, c["rows"] // LEAST_ROWS), 1) for c in counts}
    groups = {size: max(-(-number // GROUP_SHARDS), min(number, 2 * cores)) for size, number in fine.items()}
    blocks = {c["size"]: max(-(-c["anchors"] // block_rows), 1) for c in counts}
    group = F.pmod("part", _number(F.col("size"), groups)).alias("shards")
    shards = _packs(vectors, fine).select("size", group, F.col("pack").alias("shard"))

    def searched(chosen: DataFrame, k: int) -> DataFrame:
        every = F.sequence(F.lit(0), _number(F.col("size"), groups) - 1)
        sent = _packs(chosen, blocks).select(
            "size", F.explode(every).alias("shards"), F.col("part").alias("block"), F.col("pack").alias("anchors")
        )
        # A merge join takes the blocks in turn, each with all shards of its group.
        pairs = sent.hint("merge").join(shards, ["size", "shards"]).select("size", "block", "anchors", "shard")
        return pairs.mapInPandas(_wave(percent, k), _FOUND)

    chosen = vectors.filter(anchors)
    near = _first(searched(chosen, positives), ["anchor_id"], positives)
    limit = Window.partitionBy("anchor_id").orderBy(F.col("score").desc())
    near = stored(near.select("anchor_id", "vec_id", "score", (F.dense_rank().over(limit) - 1).alias("slot")), "positives")
    limits = near.groupBy("anchor_id").agg(F.sort_array(F.collect_set("score"), asc=False).alias("limits"))
    bounded = chosen.join(limits.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    found = stored(_first(searched(bounded, negatives), ["anchor_id", "slot"], negatives), "slots")

    # The first rows of each slot, then, from the lowest slot up, the first rows of it and all below.
    slot_rows = found.groupBy("anchor_id", "slot").agg(
        F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("first")
    )
    by_slot = slot_rows.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("slot", "first")), asc=False).alias("slots"))
    kind = "array<struct<slot:int,first:array<struct<place:int,vec_id:bigint,score:bigint>>>>"

    def merged(below: Column, slot: Column) -> Column:
        rest = F.coalesce(F.try_element_at(below, F.lit(-1))["first"], F.filter(slot["first"], lambda _: F.lit(False)))
        first = F.slice(F.concat(slot["first"], rest), 1, negatives)
        return F.concat(below, F.array(F.struct(slot["slot"].alias("slot"), first.alias("first"))))

    merges = by_slot.select("anchor_id", F.aggregate("slots", F.array().cast(kind), merged).alias("merges"))
    joined = near.join(merges, "anchor_id")
    upto = F.filter("merges", lambda merge: merge["slot"] >= F.col("slot"))
    wide = "decimal(25,0)"
    high_enough = lambda row: row["score"].cast(wide) * 100 >= F.col("score").cast(wide) * percent
    window = F.filter(F.try_element_at(upto, F.lit(-1))["first"], high_enough)
    return (
        joined.select("anchor_id", F.col("vec_id").alias("positive_id"), "score", F.posexplode(window).alias("at", "row"))
        .select(
            "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("row.vec_id").alias("negative_id"),
            F.col("score").alias("positive_score"), F.col("row.score").alias("negative_score"),
        )
    )


#: The mining of ``op11`` in DuckDB SQL: every anchor against every row.
ORACLE_SQL = f"""
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.vector, b.vector) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT * FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
mined AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM mined WHERE rank <= 5
"""
