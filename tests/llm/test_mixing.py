from __future__ import annotations

import doctest
import random
import re
from collections import Counter

import numpy as np
import pytest

from aisleworks.llm import mixing


def plain_targets(sizes):
    """Deal by weight, take back what is above the bound, and deal that again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8")))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        total, given, left = sum(weight[s] for s in open_), left, 0.0
        for s in list(open_):
            target[s] += given * weight[s] / total
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def nearest(sizes, target):
    """Distance of the nearest sum that taking each document up to twice, one time less or more, can reach."""
    own = sum(sizes)
    base = own if target >= own else 0
    reach = 1
    for size in sizes:
        reach |= reach << size
    return min(abs(base + s - target) for s in range(own + 1) if reach >> s & 1)


def check(rows, docs):
    sizes = {}
    for row in docs:
        sizes.setdefault(row.source, []).append(len(re.findall(r"[^\x20\x09-\x0D]+", row.text or "")))
    wanted, taken = plain_targets({s: sum(x) for s, x in sizes.items()}), Counter()
    for row in rows:
        assert row.taken in (0, row.size, 2 * row.size)
        assert row.source_size == sum(sizes[row.source]) and row.target == pytest.approx(wanted[row.source])
        taken[row.source] += row.taken
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= nearest(sizes[source], target) + 1


def test_doctests():
    assert doctest.testmod(mixing).failed == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_targets_and_budgets(spark, tables, sf):
    docs = tables("documents", sf)
    first = mixing.mixed(docs).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    check(first, docs.collect())
    again = mixing.mixed(docs.repartition(13)).select("doc_id", "taken").collect()
    assert {r.doc_id: r.taken for r in again} == {r.doc_id: r.taken for r in first}


def test_budgets_against_every_subset():
    rand = random.Random(5)
    for _ in range(200):
        sizes = np.array(sorted(rand.sample(range(1, 40), rand.randint(1, 4))))
        counts = np.array([rand.randint(1, 3) for _ in sizes])
        sums = {0}
        for size, count in zip(sizes, counts):
            sums = {s + k * int(size) for s in sums for k in range(count + 1)}
        budget = rand.randint(0, int((sizes * counts).sum()) + 3)
        taken = mixing.fit_counts(sizes, counts, budget)
        assert ((0 <= taken) & (taken <= counts)).all()
        assert abs(int((taken * sizes).sum()) - budget) == min(abs(s - budget) for s in sums)


def test_one_length_on_a_hot_source(spark, documents):
    """A third of all documents of one length: just as many of them are taken as the budget asks."""
    rows = [(k, "w " * 7, "hot") for k in range(3000)] + [(3000 + k, "w " * (k % 50), f"s{k % 9}") for k in range(3000)]
    docs = documents(*rows)
    found = mixing.mixed(docs).collect()
    check(found, docs.collect())


def test_odd_rows(spark, documents):
    rows = [(1, None, None), (2, "", "a"), (3, "  x y", "b"), (None, "one two", "b"), (4, "w " * 200_000, "é"), (5, "v w", None),
            (6, "v w", "a"), (6, "v w", "a")]
    docs = documents(*rows).withColumnRenamed("lang", "size").withColumnRenamed("n_chars", "draw")
    assert mixing.mix(docs).columns == docs.columns
    found = mixing.mixed(docs).collect()
    assert {(r.doc_id, r.draw) for r in found} == {(r.doc_id, r.draw) for r in docs.collect()}
    assert len(found) == len(rows)
    by_id = {row.doc_id: row for row in found}
    assert by_id[3].size == 2 and by_id[4].size == 200_000 and by_id[1].size == by_id[1].taken == by_id[2].taken == 0
    assert all(row.taken <= 2 * row.size for row in found)


def test_the_mix_repeats_documents_and_keeps_their_columns(spark, tables):
    docs = tables("documents")
    mix, taken = mixing.mix(docs), mixing.mixed(docs).collect()
    assert mix.columns == docs.columns
    assert Counter(r.doc_id for r in mix.collect()) == Counter({r.doc_id: r.taken // r.size for r in taken if r.taken})


def test_empty_tables(spark, documents):
    assert mixing.mixed(documents()).collect() == [] and mixing.mix(documents()).collect() == []
    (row,) = mixing.mixed(documents((1, None))).collect()
    assert (row.size, row.source_size, row.target, row.taken) == (0, 0, 0.0, 0)


def test_sources_of_many_lengths_against_every_subset():
    """Hundreds of distinct lengths, of which no few hold enough words for what is left."""
    rand = np.random.default_rng(11)
    cases = [(np.arange(1, 2001), np.ones(2000, np.int64), 150_000), (2 * np.arange(1, 1001), np.ones(1000, np.int64), 150_001)]
    for docs, median, share in ((1500, 100, 0.95), (1000, 150, 0.84)):
        lengths, counts = np.unique(np.maximum(1, rand.lognormal(np.log(median), 1.5, docs)).astype(np.int64), return_counts=True)
        assert len(lengths) > 256
        cases.append((lengths, counts, int(share * (lengths * counts).sum())))
    for sizes, counts, budget in cases:
        reach = 1
        for size in np.repeat(sizes, counts):
            reach |= reach << int(size)
        nearest = next(k for k in range(budget) if reach >> (budget - k) & 1 or reach >> (budget + k) & 1)
        taken = mixing.fit_counts(sizes, counts, budget)
        assert ((0 <= taken) & (taken <= counts)).all()
        assert abs(int((taken * sizes).sum()) - budget) == nearest
