from __future__ import annotations

import zlib

import numpy as np

from aisleworks.llm import quality

LABELS = "doc_id long, quality int, toxic int"
GOOD = "A sentence of plain words, as people write them. Another one follows it here."
JUNK = "BUY!! NOW!! CHEAP!! BUY!! NOW!! CHEAP!!"


def corpus(documents, spark, count=80):
    rows = [(k, f"{GOOD} Number {'abcdefgh'[k % 8]} ends it." if k % 2 else f"{JUNK} {'ABCDEFGH'[k % 8]}!!") for k in range(count)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(count)], LABELS)
    return rows, labels


def test_votes_against_plain_neighbours(spark, tables):
    """The blocked products and the choice of neighbours, against one document at a time."""
    docs, labels = tables("documents"), tables("labels")
    model = quality.fit(docs, labels)
    texts = [row.text for row in docs.collect()]
    got = model.scores(texts)
    for text, score in zip(texts, got):
        cosine = (model.embed([text]) @ model.vectors.T)[0].astype(float)
        order = np.argsort(-cosine)[: quality.NEIGHBOURS]
        votes = np.clip(cosine[order], 0, 1) ** quality.SHARPNESS
        assert abs(score - (votes * model.labels[order]).sum() / votes.sum()) < 1e-3


def test_held_out_accuracy(spark, tables):
    docs, labels = tables("documents", "sf0.1"), tables("labels", "sf0.1")
    truth = {row.doc_id: row.quality for row in labels.collect()}
    rows = [row for row in quality.score(docs, quality.fit(docs, labels)).collect() if row.held_out and row.doc_id in truth]
    assert all(zlib.crc32(str(row.doc_id).encode()) % 4 == 2 for row in rows)
    assert sum(row.predicted == truth[row.doc_id] for row in rows) / len(rows) > 0.97
    assert not any(row.predicted == 0 and truth[row.doc_id] == 1 for row in rows[:200])


def test_the_sample_is_bounded_and_never_held_out(spark, documents, monkeypatch):
    monkeypatch.setattr(quality, "PER_CLASS", 10)
    rows, labels = corpus(documents, spark)
    assert len(quality.fit(documents(*rows), labels).labels) == 20


def test_odd_rows(spark, documents):
    rows, labels = corpus(documents, spark)
    rows += [(None, None), (500, ""), (501, " \n "), (502, "BUY!! " * 50_000), (1, rows[1][1]), (503, GOOD)]
    docs = documents(*rows).withColumnRenamed("lang", "score").withColumnRenamed("n_chars", "quality")
    labels = labels.unionByName(spark.createDataFrame([(None, None, None), (3, None, 1), (5, 9, 1)], LABELS))
    found = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(found) == len(rows)
    by_id = {row.doc_id: row for row in found}
    assert all(row.predicted == int(row.score >= 0.7) for row in found)
    assert by_id[500].score == by_id[501].score == by_id[None].score == 0.5
    assert by_id[502].predicted == 0 and by_id[503].predicted == 1
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {row.doc_id for row in kept.collect()} == {row.doc_id for row in found if row.predicted}


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], LABELS)
    assert quality.score(documents(), quality.fit(documents(), none)).collect() == []
    (row,) = quality.score(documents((1, "text")), quality.fit(documents((1, "text")), none)).collect()
    assert row.score == 0.5 and row.predicted == 0
