"""Packing token sequences by patterns of few documents, fitted with non-negative least squares.

Only the histogram of piece lengths (at most one row per length) reaches the driver.  There the patterns of up to three
lengths that fill a sequence are listed, their repeat counts are fitted to the histogram by non-negative least squares and
rounded, and what they leave is packed by best fit, also on counts.  The outcome is a table of slots: the pieces of a
length, numbered in Spark within groups of bounded size, find their sequence and offset there.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisleworks.llm.shared import once, only, stored

LENGTH = 1024
END_ID = 2
#: The added token of ``byte_bpe_50k.json``; its id follows the last rank (50256).
MARKER = "<|endoftext|>"
#: Rounds of the least-squares fit.
ROUNDS = 300

_PIECE = T.StructType(
    [
        T.StructField("piece", T.IntegerType()),
        *(T.StructField(name, T.LongType()) for name in ("start", "length", "ids_crc32")),
    ]
)
_PLACE = T.StructType([T.StructField(name, T.LongType()) for name in ("sequence_id", "offset")])


def default_vocabulary() -> str:
    """Rank file of the byte-level vocabulary: the same ids as ``byte_bpe_50k.json``, several times as fast."""
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(path: str, marker: str | None = None) -> Callable[[str], list[int]]:
    """Text to ids by a rank file; special tokens' strings are ordinary text, but for ``marker``, which is one id."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = {} if marker is None else {marker: max(ranks.values()) + 1}
    coding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    if marker is None:
        return coding.encode_ordinary
    # Only texts that hold the marker pay for the search of it.
    return lambda text: coding.encode(text, allowed_special="all") if marker in text else coding.encode_ordinary(text)


def cut_points(count: int, length: int) -> list[int]:
    """Where pieces of ``count`` ids begin: the first piece may be shorter, the others are full.

    >>> cut_points(5, 2), cut_points(4, 2), cut_points(1, 2)
    ([0, 1, 3], [0, 2], [0])
    """
    first = count % length or length
    return [0, *range(first, count, length)]


def pieces(
    docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None, with_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): every row's ids, then id 2, cut to at most ``length``.

    ``MARKER`` within a text is its one id, as ``tokenizers`` reads it.
    """
    path = vocabulary or default_vocabulary()
    fields = _PIECE.fields + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])

    @F.pandas_udf(T.ArrayType(T.StructType(fields)))
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = once(f"encoder {path} {MARKER}", lambda: encoder(path, MARKER))
        for texts in batches:
            out: list[list[tuple]] = []
            for text in texts:
                ids = np.array([*encode(text), END_ID], "<u4")
                starts = cut_points(len(ids), length)
                found = []
                for piece, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    own = ids[start:end]
                    row = (piece, start, end - start, zlib.crc32(own.tobytes()))
                    found.append((*row, own.tolist()) if with_ids else row)
                out.append(found)
            yield pd.Series(out, dtype=object)

    rows = only(docs, doc_id="long", text="string")
    return rows.select("doc_id", F.explode(cut(F.coalesce("text", F.lit("")))).alias("cut")).select("doc_id", "cut.*")


def patterns(length: int) -> np.ndarray:
    """Rows (a, b, c) with a >= b >= c and a + b + c = length; 0 stands for no document.

    >>> patterns(4).tolist()
    [[4, 0, 0], [3, 1, 0], [2, 2, 0], [2, 1, 1]]
    """
    found = []
    for c in range(length // 3 + 1):
        b = np.arange(max(c, 0), (length - c) // 2 + 1)
        found.append(np.stack([length - c - b, b, np.full_like(b, c)], axis=1))
    every = np.concatenate(found)
    return every[(every[:, 1] > 0) | (every[:, 2] == 0)]


def fit_repeats(rows: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative x with small || A x - histogram ||, where A counts each pattern's lengths.

    Multiplicative steps x * (A' h) / (A' A x) keep x non-negative and never raise the error.
    """
    size = len(histogram)
    weight = np.where(np.arange(size) > 0, 1.0, 0.0)
    target = np.where(np.arange(size) > 0, histogram, 0).astype(float)

    def forward(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(rows[:, k], x, size) for k in range(rows.shape[1])) * weight

    def backward(h: np.ndarray) -> np.ndarray:
        return sum(h[rows[:, k]] for k in range(rows.shape[1]))

    pull = backward(target)
    x = np.where((target[rows] > 0).all(axis=1, where=rows > 0), 1.0, 0.0) * target.sum() / max(1, len(rows))
    for _ in range(rounds):
        push = backward(forward(x))
        x *= np.divide(pull, push, out=np.zeros_like(x), where=push > 1e-12)
    return x


def plan_sequences(histogram: np.ndarray, length: int = LENGTH) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """[(((piece length, copies), ...), sequences), ...] that holds each piece of the histogram once.

    >>> plan_sequences(np.array([0, 1, 0, 1, 2]), 4)
    [(((4, 1),), 2), (((3, 1), (1, 1)), 1)]
    """
    left = histogram.astype(np.int64).copy()
    plan: list[tuple[tuple[tuple[int, int], ...], int]] = []
    if left[length]:
        plan.append((((length, 1),), int(left[length])))
        left[length] = 0
    rows = patterns(length)[1:]
    if left.sum() and len(rows):
        repeats = fit_repeats(rows, left)
        order = np.argsort(-repeats, kind="stable")
        for at in order[repeats[order] >= 0.5]:
            runs: dict[int, int] = {}
            for part in rows[at]:
                if part:
                    runs[int(part)] = runs.get(int(part), 0) + 1
            times = min(int(repeats[at] + 0.5), *(int(left[part]) // copies for part, copies in runs.items()))
            if times > 0:
                plan.append((tuple(runs.items()), times))
                for part, copies in runs.items():
                    left[part] -= copies * times
    # Best fit of the rest, longest first, on counts: groups of equal sequences by the room they have left.
    rooms: dict[int, list[list]] = {}
    for part in range(length - 1, 0, -1):
        count = int(left[part])
        while count:
            room = next((r for r in range(part, length) if rooms.get(r)), None)
            if room is None:
                copies = min(length // part, count)
                times = count // copies
                rooms.setdefault(length - copies * part, []).append([((part, copies),), times])
            else:
                runs, have = rooms[room].pop()
                copies = min(room // part, count)
                times = min(have, count // copies)
                if have > times:
                    rooms[room].append([runs, have - times])
                rooms.setdefault(room - copies * part, []).append([(*runs, (part, copies)), times])
            count -= copies * times
    plan.extend((runs, times) for room in sorted(rooms) for runs, times in rooms[room])
    return plan


def slots(plan: list, length: int = LENGTH) -> np.ndarray:
    """Rows (piece length, first rank, copies in a sequence, first sequence, offset), by length and rank."""
    next_rank = np.zeros(length + 1, np.int64)
    found, sequence = [], 0
    for runs, times in plan:
        offset = 0
        for part, copies in runs:
            found.append((part, next_rank[part], copies, sequence, offset))
            next_rank[part] += copies * times
            offset += part * copies
        sequence += times
    table = np.array(found, np.int64).reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def pack(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """``cut`` (doc_id, piece, start, length, ids_crc32, ...) with sequence_id and offset; a stored table is best.

    Pieces of one length, which may be a third of all, are numbered in about sqrt(n) groups of about
    sqrt(n) pieces.  The slots depend on the histogram alone and are bounded by its patterns.
    """
    counts = np.zeros(length + 1, np.int64)
    for row in cut.groupBy("length").count().collect():  # at most ``length`` rows
        counts[row["length"]] = row["count"]
    table = slots(plan_sequences(counts, length), length)
    shared = cut.sparkSession.sparkContext.broadcast(table)

    groups = F.element_at(F.lit([max(1, math.isqrt(int(n))) for n in counts[1:]]), F.col("length").cast("int"))
    grouped = cut.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), groups))
    running = Window.partitionBy("length").orderBy("_group")
    begins = (
        grouped.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("_here"))
        .select("length", "_group", (F.sum("_here").over(running) - F.col("_here")).alias("_begin"))
    )
    ranked = (
        grouped.withColumn(
            "_place",
            F.row_number().over(Window.partitionBy("length", "_group").orderBy("doc_id", "piece", "ids_crc32")) - 1,
        )
        .join(begins, ["length", "_group"])
        .withColumn("_rank", F.col("_begin") + F.col("_place"))
        .drop("_begin", "_place", "_group")
    )

    @F.pandas_udf(_PLACE)
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        found = shared.value
        wide = np.int64(1) << 48
        keys = found[:, 0] * wide + found[:, 1]
        for parts, ranks in batches:
            parts, ranks = parts.to_numpy(np.int64), ranks.to_numpy(np.int64)
            own = found[np.searchsorted(keys, parts * wide + ranks, side="right") - 1]
            order = ranks - own[:, 1]
            yield pd.DataFrame(
                {"sequence_id": own[:, 3] + order // own[:, 2], "offset": own[:, 4] + order % own[:, 2] * parts}
            )

    return ranked.withColumn("_at", place("length", "_rank")).select(*cut.columns, "_at.*")


def pack_documents(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row of ``docs``.

    A NULL or empty text is the single id 2.  Only documents longer than ``length`` are cut.  Repeated rows are
    documents of their own and a row without doc_id is packed like any other; other columns are ignored; an
    empty table gives an empty result.
    """
    packed = pack(stored(pieces(docs, length, vocabulary), "pieces"), length)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, each of at most ``length`` ids."""
    packed = pack(stored(pieces(docs, length, vocabulary, with_ids=True), "pieces"), length)
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
