import doctest
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from aisleworks.llm import catalog, hard_negatives
from retail_checks.compare import differences

COLUMNS = "vec_id long, embedding array<double>, label int"


def plain(rows, every=100, positives=5, negatives=5, percent=80):
    """The definition, every pair."""
    kept = {}
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        row = (label, vector)
        kept[vec_id] = min(kept.get(vec_id, row), row)
    whole = {i: (label, [math.floor(256 * x) if abs(x) < 2**52 else 256 * int(x) for x in v]) for i, (label, v) in kept.items()}
    out = []
    for anchor in (i for i in whole if i % every == 0):
        label, own = whole[anchor]
        scores = sorted(
            (-max(-(2**63 - 1), min(2**63 - 1, sum(a * b for a, b in zip(own, other)))), i, mark == label)
            for i, (mark, other) in whole.items() if i != anchor and len(other) == len(own)
        )
        for score, positive, _ in [row for row in scores if row[2]][:positives]:
            fit = [(s, i) for s, i, same in scores if not same and percent * -score <= 100 * -s <= 100 * -score]
            out += [(anchor, positive, k + 1, i, -score, -s) for k, (s, i) in enumerate(fit[:negatives])]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame(rows, COLUMNS).withColumn("score", F.lit("x")).withColumn("size", F.lit(1)).withColumn("slot", F.lit(2))
    return sorted(map(tuple, hard_negatives.hard_negatives(frame, **options).collect()))


def test_examples():
    assert doctest.testmod(hard_negatives).failed == 0


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"shard_rows": 50, "block_rows": 2}), (3, {"positives": 3, "negatives": 7, "percent": 50})])
def test_equals_every_pair(spark, seed, options):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=6)
    rows = [(i, (centre + rng.normal(size=6) * 0.5).round(1).tolist(), int(rng.integers(0, 4))) for i in range(600)]
    rows += [(1000 + i, rows[100][1], i % 3) for i in range(150)]  # copies of an anchor, under several labels
    expected = plain(rows, **{k: v for k, v in options.items() if not k.endswith("rows")})
    assert expected and mined(spark, rows, **options) == expected


def test_overlapping_windows_share_slots():
    """Positives 100, 90, 90, 50: the window of 90 reaches into the slot of 50, not below its own floor."""
    anchors = {"ids": np.array([0]), "labels": np.array([1]), "rows": np.array([[1]]), "limits": np.array([[100, 90, 50]])}
    slots = hard_negatives._slots(anchors, 80, 2)
    assert slots.low.tolist() == [[91, 72, 40]] and slots.high.tolist() == [[100, 90, 50]]
    values = [101, 100, 95, 95, 90, 72, 71, 50, 40, 39]
    shard = {"ids": np.arange(len(values)), "labels": np.zeros(len(values), int), "rows": np.array(values)[:, None]}
    slots.add(shard)
    assert slots.rows()[["slot", "vec_id", "score"]].values.tolist() == [[0, 1, 100], [0, 2, 95], [1, 4, 90], [1, 5, 72], [2, 7, 50], [2, 8, 40]]


def test_odd_rows(spark):
    one = [1.0, 0.5]
    rows = [
        (0, one, 1), (1, one, 1), (2, one, 2), (2, one, 2), (3, [1.0, None], 2), (4, [1.0, float("nan")], 2), (5, None, 2),
        (6, one, None), (None, one, 2), (7, [1.0, float("inf")], 2), (8, [0.9, 0.5], 2), (9, [], 2), (10, [1.0, 0.5, 0.0], 2),
        (100, [], 1), (101, [], 1), (200, [-1.0, -0.5], 1), (300, [1e30, 1e300], 3), (301, [1e30, 1e300], 3), (302, [1e30, 1e300], 4),
        (400, [1.0], 5), (0, one, 7),
    ]
    expected = plain(rows)
    assert mined(spark, rows) == expected
    assert (0, 1, 1, 2, 81920, 81920) in expected and (100, 101, 1, 9, 0, 0) in expected
    assert any(row[0] == 300 and row[4] == 2**63 - 1 for row in expected)
    assert mined(spark, rows[2:3]) == [] and mined(spark, []) == []


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(catalog.op11_hard_negatives(spark, sf), catalog.ORACLE["op11_hard_negatives"], sf) == []
