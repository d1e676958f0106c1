from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from aisleworks.llm import imatch


def signed(number):
    return number - (1 << 64) if number >= 1 << 63 else number


def terms(text):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return {signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words}


def test_band_counts_every_document(spark, documents, monkeypatch):
    monkeypatch.setattr(imatch, "RARE", 0.2)
    monkeypatch.setattr(imatch, "COMMON", 0.6)
    texts = ["all some rare", "all some", "ALL, some!", "all", None, "", "all mid", "all mid2 2"]
    bits = imatch.band(documents(*enumerate(texts)).select("text"))
    held = Counter(t & ((1 << 20) - 1) for text in texts if text for t in terms(text))
    inside = {slot for slot, count in held.items() if 0.2 * 6 <= count <= 0.6 * 6}
    assert {64 * place + bit for place, word in enumerate(bits) for bit in range(64) if word >> bit & 1} == inside


def test_hashes_are_those_of_sorted_terms(spark, documents):
    text = " ".join(f"word{k}" for k in range(300))
    frame = documents((1, text)).select(imatch.fingerprint(F.col("text"), [0] * (1 << 14)).alias("f"))
    found = frame.first().f
    assert found.level == 4  # 300 / 32 is above 8 and not above 16
    for level, hashes in ((4, found.dense), (5, found.sparse)):
        kept = sorted(t for t in terms(text) if (t >> 45) & ((1 << level) - 1) == 0)
        lexicons = [[t for t in kept if t >> 40 & 31 == number] for number in range(32)]
        sizes = Counter(len(x) for x in lexicons)
        assert sizes[0] == sum(h == 0 for h in hashes)
        same = {}
        for members, value in zip(lexicons, hashes):
            assert same.setdefault(tuple(members), value) == value
        assert len(set(hashes)) == len(set(map(tuple, lexicons)))


def test_edits_and_neighbours_over_a_whole_table(spark, tables):
    docs = tables("documents")
    rows = {row.doc_id: row for row in imatch.fingerprint_edits(docs).collect()}
    texts = {row.doc_id: row.text for row in docs.collect()}
    order = sorted(texts, reverse=True)
    for place, doc_id in enumerate(order):
        text, following = texts[doc_id], texts[order[(place + 1) % len(order)]]
        size = len(text)
        edited = text[: size - size // 3] + following[: size // 3]
        row = rows[doc_id]
        assert row.n_chars == size and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        next_row = rows[order[(place + 1) % len(order)]]
        assert (row.near_next == 1) == (row.fingerprint == next_row.fingerprint)
    assert sum(r.near_edited for r in rows.values()) > 10 * sum(r.near_next for r in rows.values())


def test_likeness_by_hand(spark):
    schema = "level int, dense array<long>, sparse array<long>"
    frame = spark.createDataFrame(
        [((0, [1, 2, 0], [5, 0, 0]), (0, [1, 3, 0], [5, 0, 0])), ((1, [5, 0, 7], [9, 0, 0]), (0, [1, 1, 1], [5, 0, 8])),
         ((0, [1, 1, 1], [5, 0, 8]), (1, [5, 0, 7], [9, 0, 0])), ((3, [1], [1]), (1, [1], [1])), ((0, [0], [0]), (0, [0], [0]))],
        f"a struct<{schema.replace(' ', ':').replace(',:', ',')}>, b struct<{schema.replace(' ', ':').replace(',:', ',')}>",
    )
    found = [row[0] for row in frame.select(imatch.likeness(F.col("a"), F.col("b"))).collect()]
    assert found == pytest.approx([2 / 3, 1 / 2, 1 / 2, 0, 1])


def test_odd_rows(spark, documents):
    rows = [(3, "gamma words"), (None, None), (None, "null id"), (2, ""), (2, ""), (5, "x" * 100_000 + " y"), (4, "é" * 10)]
    docs = documents(*rows).withColumnRenamed("lang", "range").withColumnRenamed("source", "next")
    found = imatch.fingerprint_edits(docs).collect()
    assert len(found) == len(rows)
    five = next(r for r in found if r.doc_id == 5)
    text = rows[5][1]
    assert five.edited_sha256 == hashlib.sha256((text[: len(text) - len(text) // 3] + "é" * 10).encode()).hexdigest()
    twos = [r for r in found if r.doc_id == 2]
    assert twos[0].fingerprint == twos[1].fingerprint and any(r.near_next == 1 for r in twos)
    # the last row, without doc_id, is followed by the first
    assert sum(r.doc_id is None for r in found) == 2


def test_one_row_and_none(spark, documents):
    assert imatch.fingerprint_edits(documents()).collect() == []
    (row,) = imatch.fingerprint_edits(documents((7, "abcdef"))).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and row.near_next == 1
