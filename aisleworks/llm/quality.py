"""Text quality by nearest-neighbour voting in a latent semantic space.

A text's terms are the shapes of its words and of neighbouring words, hashed to ``TERMS`` slots, and how often
a word repeats the word before it.  Inverse document frequencies come from all documents.  The latent space is spanned by
the leading singular vectors of labelled texts; up to ``PER_CLASS`` labelled texts of either class are broadcast
as unit vectors (at most 2 * PER_CLASS * DIMENSIONS floats, whatever the size of the corpus).  Every document is
compared with all of them in blocks of exact cosine products, and its nearest ones vote with their similarity.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisleworks.llm.shared import only

TERMS, DIMENSIONS = 1024, 48
#: Labelled texts of each class that are fitted and vote, those with the smallest hashed doc_id.
PER_CLASS = 2000
NEIGHBOURS = 24
#: A neighbour's vote is its cosine raised to this power.
SHARPNESS = 8
THRESHOLD = 0.7
#: Documents compared at once.
BLOCK = 1024


def _class_table() -> bytes:
    """Bytes to classes: lower case a, upper case A, digits 0, white space one blank, other ASCII itself."""
    table = bytearray(range(128)) + b"a" * 128
    for code in range(128):
        char = chr(code)
        if char.islower():
            table[code] = ord("a")
        elif char.isupper():
            table[code] = ord("A")
        elif char.isdigit():
            table[code] = ord("0")
    for code in b"\t\n\x0b\x0c\r":
        table[code] = ord(" ")
    return bytes(table)


_CLASSES = _class_table()


def term_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights) of a text's terms: square roots of their share of the words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    shaped = np.frombuffer(data.translate(_CLASSES), np.uint8)
    runs = shaped[np.concatenate([[True], shaped[1:] != shaped[:-1]])]
    shapes = runs.tobytes().split()
    counts = Counter(shapes)
    counts.update(a + b" " + b for a, b in zip(shapes, shapes[1:]))
    counts[b"repeated word"] = sum(a == b for a, b in zip(words, words[1:]))
    slots = np.fromiter((xxhash.xxh3_64_intdigest(t) % TERMS for t in counts), np.int64, len(counts))
    weights = np.bincount(slots, np.fromiter(counts.values(), float, len(counts)), TERMS)
    found = np.flatnonzero(weights)
    return found, np.sqrt(weights[found] / len(words)).astype(np.float32)


@dataclass
class Model:
    """What a fit yields; its size is bounded by the constants above."""

    project: np.ndarray  # TERMS x DIMENSIONS, with the inverse document frequencies in it
    vectors: np.ndarray  # labelled unit vectors
    labels: np.ndarray

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.project, self.vectors, self.labels

    def embed(self, texts) -> np.ndarray:
        """Unit vectors of texts; zero for a text without words."""
        dense = np.zeros((len(texts), TERMS), np.float32)
        for row, text in enumerate(texts):
            slots, weights = term_counts(text)
            dense[row, slots] = weights
        latent = dense @ self.project
        norms = np.linalg.norm(latent, axis=1, keepdims=True)
        return np.divide(latent, norms, out=np.zeros_like(latent), where=norms > 1e-12)

    def scores(self, texts) -> np.ndarray:
        """Share of votes for label 1; 0.5 where nothing can vote."""
        result = np.full(len(texts), 0.5)
        if not len(self.labels):
            return result
        for at in range(0, len(texts), BLOCK):
            cosine = self.embed(texts[at : at + BLOCK]) @ self.vectors.T
            count = min(NEIGHBOURS, cosine.shape[1])
            near = np.argpartition(-cosine, count - 1, axis=1)[:, :count]
            votes = np.clip(np.take_along_axis(cosine, near, axis=1), 0, 1).astype(float) ** SHARPNESS
            total = votes.sum(axis=1)
            share = np.divide((votes * self.labels[near]).sum(axis=1), total, where=total > 0, out=np.full(len(near), 0.5))
            result[at : at + BLOCK] = np.clip(share, 0, 1)
        return result


def _document_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = np.zeros(TERMS + 1, np.int64)
    for batch in batches:
        for text in batch["text"]:
            held[term_counts(text)[0]] += 1
            held[TERMS] += 1
    yield pd.DataFrame({"slot": np.arange(TERMS + 1), "held": held})


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may learn from: crc32 of doc_id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality).

    Document frequencies cover all rows of ``docs``; the voters are a bounded sample (``PER_CLASS``) of labelled
    rows that are not held out.  Labels other than 0 and 1 do not count; without labels nothing votes.
    """
    rows = only(docs, doc_id="long", text="string")
    held = rows.select("text").mapInPandas(_document_terms, "slot int, held long").groupBy("slot").agg(F.sum("held").alias("held"))
    counts = np.zeros(TERMS + 1)
    for row in held.collect():  # at most TERMS + 1 rows
        counts[row["slot"]] = row["held"]
    weights = np.log((1 + counts[TERMS]) / (1 + counts[:TERMS])) + 1

    marked = (
        only(labels, doc_id="long", quality="int").filter("quality in (0, 1)").filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
    )
    chosen = [
        part
        for label in (0, 1)
        for part in [
            marked.filter(F.col("quality") == label)
            .join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS)
        ]
    ]
    sample = chosen[0].unionByName(chosen[1])
    texts = rows.join(sample, "doc_id").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("text").alias("text"))
    fitted = texts.mapInPandas(_terms_of, "doc_id long, quality int, slots array<int>, weights array<float>").collect()
    fitted.sort(key=lambda row: row["doc_id"])
    dense = np.zeros((len(fitted), TERMS), np.float32)
    for at, row in enumerate(fitted):  # at most 2 * PER_CLASS rows of at most TERMS numbers
        dense[at, row["slots"]] = row["weights"]
    dense *= weights.astype(np.float32)
    values, vectors = np.linalg.eigh((dense.T @ dense).astype(float))
    basis = vectors[:, np.argsort(-values)[:DIMENSIONS]]
    project = (weights[:, None] * basis).astype(np.float32)
    model = Model(project, np.empty((0, DIMENSIONS), np.float32), np.empty(0))
    latent = dense @ basis.astype(np.float32)
    norms = np.linalg.norm(latent, axis=1)
    some = norms > 1e-12
    model.vectors = (latent[some] / norms[some, None]).astype(np.float32)
    model.labels = np.array([row["quality"] for row in fitted], float)[some]
    return model


def _terms_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        terms = [term_counts(text) for text in batch["text"]]
        yield pd.DataFrame(
            {"doc_id": batch["doc_id"], "quality": batch["quality"],
             "slots": [slots.tolist() for slots, _ in terms], "weights": [weights.tolist() for _, weights in terms]}
        )


def _scorer(docs: DataFrame, model: Model) -> Callable[[Column], Column]:
    """A column function that scores texts with ``model``, which is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())

    @F.pandas_udf(T.DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted = Model(*shared.value)
        for texts in batches:
            yield pd.Series(fitted.scores(texts.tolist()))

    return lambda text: scored(F.coalesce(text.cast("string"), F.lit("")))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text).

    Only the text is scored.  Texts without words score 0.5, which is below the threshold.  A row without
    doc_id is scored and is not held out; repeated rows score alike; other columns are ignored.
    """
    scored = only(docs, doc_id="long", text="string").withColumn("score", _scorer(docs, model)(F.col("text")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) that score at least ``THRESHOLD``, unchanged."""
    return docs.filter(_scorer(docs, fit(docs, labels))(docs["text"]) >= THRESHOLD)
