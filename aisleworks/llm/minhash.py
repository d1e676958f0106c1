"""Near-duplicate documents by minima of universal hashes, banding and exact confirmation.

1. Each text becomes the set of its word shingles; texts with equal sets are one class,
   stood for by its smallest doc_id, so copies never meet each other again.
2. Each class gets the minima of ``BANDS * ROWS`` universal hashes over its set.  Classes that agree
   on all minima of a band share a bucket.  Two sets of similarity 0.8 miss each other in every
   band with probability 3e-6 (0.8 ** 5 per band, 32 bands).
3. Buckets are joined into clusters by star edges to each bucket's smallest member.  A link can only lie
   within a cluster, so each candidate's text travels once, to its cluster's task.
4. There the full sets are compared and links that span the cluster's components are returned, never
   all pairs.  Clusters beyond ``CLUSTER_DOCS`` or ``CLUSTER_SHINGLES`` are compared bucket by bucket, in
   pairs of blocks of bounded size, with the same exact comparison.
5. Components of the links come from alternating large-star and small-star rounds.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisleworks.llm.components import components
from aisleworks.llm.shared import lookup, only, stored

BANDS, ROWS = 32, 5
#: Largest cluster that one task compares whole; larger ones go bucket by bucket, in blocks.
CLUSTER_DOCS, CLUSTER_SHINGLES = 8192, 4_000_000
#: Documents and shingles of a bucket that one block holds; a task compares two blocks.
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 1_000_000

_SIGNED = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_key", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)

_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_SHIFT30, _SHIFT27, _SHIFT31, _SHIFT32 = (np.uint64(n) for n in (30, 27, 31, 32))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose result looks random (the splitmix64 finaliser)."""
    x = (x ^ (x >> _SHIFT30)) * _MIX1
    x = (x ^ (x >> _SHIFT27)) * _MIX2
    return x ^ (x >> _SHIFT31)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``words``-word shingles of a text.

    A-Z is lower-cased and words are runs without ASCII white space.  A text of fewer words is
    one shingle, its whole sequence; without words the set is empty.

    >>> [len(shingles(t, 2)) for t in ("a b A B", "word", " ", None)]
    [2, 1, 0, 0]
    """
    # bytes.lower and bytes.split know ASCII letters and white space only, which is just what is asked for
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(found))
    count = len(found) - width + 1
    state = np.full(count, width, np.uint64)
    for k in range(width):
        state = mixed(state * _STEP + hashed[k : k + count])
    return np.unique(state)


def _universal() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of the multiply-shift hashes, the same in every run."""
    start = np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _STEP
    return mixed(start) | np.uint64(1), mixed(start + np.uint64(1))


def band_keys(members: np.ndarray) -> np.ndarray:
    """One signed 64-bit key per band: equal when all minima of the band are equal."""
    factors, addends = _universal()
    least = np.full(BANDS * ROWS, np.uint64(2**64 - 1))
    for at in range(0, len(members), 2048):
        hashed = (factors[:, None] * members[None, at : at + 2048] + addends[:, None]) >> _SHIFT32
        np.minimum(least, hashed.min(axis=1), out=least)
    least = least.reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = mixed(keys * _STEP + least[:, k])
    return keys.view(np.int64)


def _signed(words: int) -> Callable[[Column], Column]:
    @F.pandas_udf(_SIGNED)
    def signed(texts: pd.Series) -> pd.DataFrame:
        sizes, keys, bands = [], [], []
        for text in texts:
            members = shingles(text, words)
            sizes.append(len(members))
            keys.append(xxhash.xxh3_128_digest(members.tobytes()) if len(members) else None)
            bands.append(band_keys(members) if len(members) else None)
        return pd.DataFrame({"n_shingles": sizes, "set_key": keys, "bands": bands})

    return signed


def spanning_links(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join the same components as all pairs with 100 * common >= percent * union.

    A pivot is compared with all others at once, by counting along the postings of its shingles.
    Every document outside the largest component becomes a pivot, so a pair that was never compared
    lies within that component.

    >>> a, b, c = (np.arange(k, k + 9, dtype=np.uint64) for k in (0, 1, 50))
    >>> spanning_links([1, 2, 3], [a, b, c], 80)
    [(1, 2)]
    """
    count = len(ids)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(count), sizes)
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(codes, kind="stable")
    posting = owner[order]
    bounds = np.searchsorted(codes[order], np.arange(codes.max(initial=-1) + 2))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    frequency = np.diff(bounds)
    central = np.array([frequency[codes[ends[k] : ends[k + 1]]].sum() for k in range(count)])
    group = np.arange(count)
    pivot = np.zeros(count, bool)
    links: list[tuple[int, int]] = []
    at = int(central.argmax())
    while True:
        pivot[at] = True
        own = codes[ends[at] : ends[at + 1]]
        common = np.bincount(
            np.concatenate([posting[bounds[c] : bounds[c + 1]] for c in own]), minlength=count
        )
        union = sizes + sizes[at] - common
        near = np.flatnonzero((100 * common >= percent * union) & (group != group[at]))
        for other in near:
            if group[other] != group[at]:
                links.append((ids[at], ids[other]))
                group[group == group[other]] = group[at]
        largest = np.bincount(group, minlength=count).argmax()
        rest = np.flatnonzero(~pivot & (group != largest))
        if not len(rest):
            return links
        at = int(rest[central[rest].argmax()])


def _linked(words: int, percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        sets = [shingles(text, words) for text in group["text"]]
        links = spanning_links(group["node"].tolist(), sets, percent)
        return pd.DataFrame(links, columns=["low", "high"], dtype="int64")

    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    Documents are linked when 100 * common shingles >= percent * all shingles of both; component_id is the
    smallest doc_id reachable and kept marks the row with that id.  Empty and NULL texts have no
    shingles and are linked with nothing.  A row without doc_id is linked with nothing: its
    component_id is NULL and it is kept.  Repeated rows share their id's component; rows of
    one doc_id with different texts count as one document with the links of all.  Other columns are
    ignored; an empty table gives an empty result.
    """
    rows = only(docs, doc_id="long", text="string")
    signed = stored(
        rows.select("doc_id", _signed(words)(F.coalesce("text", F.lit(""))).alias("signed")).select("doc_id", "signed.*"),
        "signed",
    )
    # The bands follow from the set, so any of a class's rows can give them.
    classes = stored(
        signed.filter("doc_id is not null and set_key is not null")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"),
             F.max("n_shingles").alias("n_shingles"), F.count(F.lit(1)).alias("copies")),
        "classes",
    )
    banded = classes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    shared = stored(
        banded.groupBy("bucket")
        .agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("mark"),
             F.sum("n_shingles").alias("total"))
        .filter("size > 1")
        # Buckets with the same members need only be looked at once.
        .groupBy("low", "size", "mark", "total")
        .agg(F.min("bucket").alias("bucket")),
        "buckets",
    )
    members = stored(
        banded.join(shared, "bucket").select("bucket", "size", "total", "low", "node"), "members"
    )
    links = stored(_links(rows, classes, members, words, percent), "links")
    reached = components(links)
    merged = classes.filter("copies > 1").select("set_key", F.col("node").alias("class"))
    named = lookup(signed.drop("bands"), merged, ["set_key"], F.col("doc_id"))
    return (
        named.withColumn("class", F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id")))
        .join(reached.withColumnRenamed("node", "class"), "class", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "class").alias("component_id"),
            F.coalesce(F.col("doc_id") == F.coalesce("component", "class"), F.lit(True)).alias("kept"),
        )
    )


def _links(rows: DataFrame, classes: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """Confirmed links (low, high) that span the components, from whole clusters or from blocks of buckets."""
    clusters = components(members.filter("node <> low").select("low", F.col("node").alias("high")))
    sized = clusters.join(classes.groupBy("node").agg(F.max("n_shingles").alias("n_shingles")), "node")
    clusters = stored(
        lookup(
            sized,
            sized.groupBy("component").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_shingles").alias("total")),
            ["component"],
            F.col("node"),
            "inner",
            salts=8,
        ).withColumn("whole", (F.col("docs") <= CLUSTER_DOCS) & (F.col("total") <= CLUSTER_SHINGLES)),
        "clusters",
    )
    texts = stored(
        rows.join(clusters.select(F.col("node").alias("doc_id"), "component", "whole"), "doc_id"), "texts"
    ).withColumnRenamed("doc_id", "node")
    find = _linked(words, percent)
    inside = (
        texts.filter("whole").select("component", "node", "text")
        .groupBy("component").applyInPandas(find, "low long, high long")
    )
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK_DOCS, F.col("total") / BLOCK_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("node", "bucket"), blocks).cast("int")
    paired = (
        members.join(clusters.filter("not whole").select("node"), "node")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("node", "bucket", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"))
    )
    across = (
        texts.filter("not whole").select("node", "text").join(paired, "node")
        .groupBy("bucket", "one", "two").applyInPandas(find, "low long, high long")
    )
    return inside.unionByName(across).distinct()


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group: the row whose doc_id is the smallest of its group.

    Of the rows that share a kept doc_id the one with the smallest text stays (NULL last, then the one whose values hash to the
    least), so that a rerun keeps the same; rows without doc_id stay.
    """
    kept = near_duplicates(docs, words, percent).filter("kept and doc_id is not null").select("doc_id").distinct()
    whole = F.struct(*(docs[f"`{c}`"] for c in docs.columns))
    others = F.to_json(F.struct(*(docs[f"`{c}`"] for c in docs.columns if c != "text")))
    order = F.struct(docs["text"].isNull(), docs["text"], F.xxhash64(others)).alias("order")
    named = (
        docs.filter("doc_id is not null").select("doc_id", whole.alias("row"), order)
        .groupBy("doc_id").agg(F.min_by("row", "order").alias("row"))
    )
    one = named.join(kept, "doc_id", "left_semi").select("row.*")
    return one.unionByName(docs.filter("doc_id is null")).select(docs.columns)
