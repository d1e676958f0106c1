import doctest
import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aisleworks.llm import catalog, fill_middle
from retail_checks.compare import differences

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    """The contract, read off."""
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_examples():
    assert doctest.testmod(fill_middle).failed == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \t\n\x0b\x1c  aé𝔘<", max_size=60))
def test_units_are_those_of_the_pattern(text):
    assert fill_middle.unit_widths(text).tolist() == [len(unit) for unit in UNITS.findall(text)]


def test_descent_reaches_every_rank():
    widths = np.random.default_rng(1).integers(1, 9, 3000)
    lanes = fill_middle.build_lanes(widths)
    before = np.concatenate([[0], np.cumsum(widths)])
    assert [fill_middle.points_before(lanes, rank) for rank in range(len(before))] == before.tolist()
    assert len(lanes) > 4
    for (units, points, down), (low_units, low_points, _) in zip(lanes[1:], lanes):
        assert units.sum() == len(widths) and points.sum() == widths.sum()
        assert np.array_equal(units, np.add.reduceat(low_units, down))
        assert np.array_equal(points, np.add.reduceat(low_points, down))
        assert len(units) <= len(low_units) / 2


def test_odd_rows_equal_the_plain_reading(spark):
    texts = [None, "", " ", "\n\t ", "one", " one", "a b c d", "é 𝔘𝔘  x y z  ", "has <M> in it", "a < b <S c > d",
             "x<" * 40, "w " * 50_000, "long" * 50_000, "tie tie tie", "<P", "M> <S"]
    rows = [(i + 100 * k, text) for i, text in enumerate(texts) for k in range(6)] + [(None, "no id at all"), (7, "again"), (7, "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit("x")).withColumn("n", F.lit("x"))
    made = fill_middle.fill_in_middle(frame)
    back = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    got = sorted(back.collect(), key=str)
    expected = sorted(((*plain(*row), row[1] or "") for row in rows), key=lambda row: str(got[0].__class__(*row)))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert {row.form for row in got} == {"plain", "psm", "spm"}


def test_empty_table(documents):
    assert fill_middle.digests(documents().limit(0)).collect() == []


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert differences(catalog.op13_fill_middle(spark, sf), catalog.ORACLE["op13_fill_middle"], sf) == []
