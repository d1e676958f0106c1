from __future__ import annotations

import doctest
import random
import re
from itertools import combinations

import pytest

from aisleworks.llm import components, minhash

_UPPER = {k: k + 32 for k in range(65, 91)}


def shingle_set(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_UPPER))
    width = min(words, len(found))
    return frozenset(tuple(found[k : k + width]) for k in range(len(found) - width + 1)) if found else frozenset()


def plain(rows, words, percent):
    """Components of all pairs."""
    sets = [(doc_id, shingle_set(text, words)) for doc_id, text in rows]
    label = {doc_id: doc_id for doc_id, _ in sets}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for (a, one), (b, two) in combinations(sets, 2):
        if one and two and 100 * len(one & two) >= percent * len(one | two):
            low, high = sorted((top(a), top(b)))
            label[high] = low
    return {(doc_id, len(s), top(doc_id)) for doc_id, s in sets}


def check(spark, documents, rows, words=2, percent=80):
    found = minhash.near_duplicates(documents(*rows), words, percent).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found} == plain(rows, words, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def edited(rand, text, share):
    words = text.split()
    for place in rand.sample(range(len(words)), int(share * len(words))):
        words[place] = f"new{rand.randint(0, 10**9)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def families():
    """Copies, near copies on either side of the threshold, and chains of edits."""
    rand = random.Random(4)
    rows, doc_id = [], 0
    for family in range(12):
        text = " ".join(f"f{family}w{rand.randint(0, 400)}" for _ in range(rand.choice([8, 60, 200])))
        for _ in range(rand.choice([2, 5, 30])):
            rows.append((doc_id := doc_id + 1, edited(rand, text, rand.choice([0, 0.02, 0.05, 0.1, 0.2]))))
            if rand.random() < 0.2:
                text = rows[-1][1]
    rand.shuffle(rows)
    return [(k, text) for k, (_, text) in enumerate(rows)]


def test_doctests():
    assert doctest.testmod(minhash).failed == 0


@pytest.mark.parametrize("words", [2, 5])
def test_against_all_pairs(spark, documents, families, words):
    check(spark, documents, families, words)


def test_large_clusters_go_through_blocks(spark, documents, families, monkeypatch):
    monkeypatch.setattr(minhash, "CLUSTER_DOCS", 3)
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 4)
    check(spark, documents, families)


def test_given_table(spark, documents, tables):
    check(spark, documents, [(r.doc_id, r.text) for r in tables("documents").collect()])


def test_exactly_at_the_threshold(spark, documents):
    base = [f"w{k}" for k in range(10)]
    at = " ".join(base[:9])  # 8 of 9 shingles of the first text, 88 %
    rows = [(1, " ".join(base)), (2, at), (3, " ".join(base[:5])), (4, "a b c d e f"), (5, "a b c d e")]
    check(spark, documents, rows)
    check(spark, documents, rows, percent=89)
    check(spark, documents, [(4, "a b c d e f"), (5, "a b c d e")], percent=80)  # 4 of 5, just enough


def test_odd_rows(spark, documents):
    rows = [(5, None), (6, ""), (7, " \t\n\x0b "), (8, "word"), (9, "WORD"), (3, "É a"), (2, "é a"), (10, "a b c"),
            (11, "long " + " ".join(f"x{k}" for k in range(60_000))), (12, " ".join(f"x{k}" for k in range(60_000)))]
    check(spark, documents, rows)
    docs = documents(*rows, (None, "word"), (8, "word")).withColumnRenamed("lang", "node").withColumnRenamed("source", "class")
    found = minhash.near_duplicates(docs, 2).collect()
    assert len(found) == len(rows) + 2
    (alone,) = [r for r in found if r.doc_id is None]
    assert alone.component_id is None and alone.kept and alone.n_shingles == 1
    left = minhash.without_near_duplicates(docs, 2)
    assert left.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in left.collect()) == sorted(
        {(r.doc_id is None, r.doc_id or 0) for r in found if r.kept}
    )
    assert minhash.near_duplicates(documents()).collect() == []


def test_components_of_long_paths_and_hubs(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (31, 30), (200, 199), (199, 198)]
    found = components.components(spark.createDataFrame(edges, "low long, high long")).collect()
    label = {row.node: row.component for row in found}
    assert len(found) == len(label)
    assert label == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 160)} | {k: 198 for k in (198, 199, 200)}
    assert components.components(spark.createDataFrame([], "low long, high long")).collect() == []


def test_one_of_several_texts_of_a_doc_id_stays_the_same(spark, documents):
    texts = [f"text {k} of one id, long enough to be like no other: {'abc' * k}" for k in range(6)]
    rows = [(7, text, f"s{k}") for k, text in enumerate(texts)] + [(7, texts[0], "s9"), (7, None), (8, "alone")]
    for turned in (rows, rows[::-1]):
        left = {r.doc_id: r for r in minhash.without_near_duplicates(documents(*turned).repartition(5), 2).collect()}
        assert set(left) == {7, 8} and left[7].text == texts[0]
