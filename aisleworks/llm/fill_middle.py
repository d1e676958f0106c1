"""Fill-in-middle texts, cut by an indexable skip list over their units.

A unit is a run of non-space with the white space before it; white space at the end of a text is a unit of its own.  The
bottom lane of the list links unit to unit; each express lane above keeps about a quarter of the nodes of
the lane below, drawn by a hash of their rank.  Every link carries two widths, the units and the code points that it
passes, so that a descent which adds up widths reaches a given rank exactly and knows its place in the text.
Only the cut places come from Python; Spark's own functions choose the form and put the parts together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisleworks.llm.shared import only

SEED = 42
#: Of a hundred texts so many are rearranged, and of a hundred rearranged ones so many begin with their suffix.
RATE, SUFFIX_FIRST = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: One node in so many goes up a lane; a lane with no more links than this is the topmost.
FAN = 4

Lane = tuple[np.ndarray, np.ndarray, np.ndarray]


def unit_widths(text: str) -> np.ndarray:
    """Code points of each unit of ``text``.

    >>> unit_widths(" ab  c\\n").tolist()
    [3, 3, 1]
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    space = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    ends = np.flatnonzero(~space & np.append(space[1:], True)[: len(space)]) + 1
    if len(points) and space[-1]:
        ends = np.append(ends, len(points))
    return np.diff(ends, prepend=0)


def _drawn(count: int) -> np.ndarray:
    """A fixed pseudo-random number for each rank below ``count``."""
    mixed = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(27))


def build_lanes(widths: np.ndarray) -> list[Lane]:
    """Lanes from the bottom up, each as (units, points, down).

    Link i of a lane leads from its node i to node i + 1, or to the end of the list, and passes that many units and code
    points; ``down`` is the same node's index one lane below.  Node 0 is the head, which is in every lane.
    """
    units, points = np.ones(len(widths), np.int64), np.asarray(widths, np.int64)
    drawn, lanes = _drawn(len(widths)), [(units, points, np.arange(len(widths)))]
    while len(units) > FAN:
        up = drawn % np.uint64(FAN) == 0
        up[0] = True
        down = np.flatnonzero(up)
        units, points = np.add.reduceat(units, down), np.add.reduceat(points, down)
        drawn = drawn[down] // np.uint64(FAN)
        lanes.append((units, points, down))
    return lanes


def points_before(lanes: list[Lane], rank: int) -> int:
    """Code points before unit ``rank``; for the number of units, those of the whole text.

    >>> lanes = build_lanes(np.array([3, 3, 1]))
    >>> [points_before(lanes, rank) for rank in range(4)]
    [0, 3, 6, 7]
    """
    node = passed = at = 0
    for level in range(len(lanes) - 1, -1, -1):
        units, points, down = lanes[level]
        while node < len(units) and passed + units[node] <= rank:
            passed, at, node = passed + int(units[node]), at + int(points[node]), node + 1
        if level:
            node = int(down[node]) if node < len(down) else len(lanes[level - 1][0])
    return at


def _cuts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Units of each text and, where it is cut, the code points before either of its two cuts."""
    for texts, cut, first, second in batches:
        found = []
        for text, wanted, *draws in zip(texts, cut, first, second):
            widths = unit_widths(text)
            if wanted:
                lanes = build_lanes(widths)
                ranks = sorted(int(draw) % (len(widths) + 1) for draw in draws)
                found.append((len(widths), *(points_before(lanes, rank) for rank in ranks)))
            else:
                found.append((len(widths), None, None))
        yield pd.DataFrame(found, columns=["n", "first", "second"]).astype("Int64")


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs``.

    Four numbers are the first eight-digit groups of the hex SHA-256 of ``seed:doc_id``.  The first two, modulo n + 1,
    are the unit ranks of the cuts; the others choose the form: ``plain`` (the text), ``psm`` (prefix, suffix,
    middle) or ``spm`` (suffix, prefix, middle), each part after its mark.  Empty texts and texts that hold a mark
    are always plain, and plain rows have no cut.

    NULL texts count as empty, a NULL doc_id as an empty one.  Rows that share a doc_id are drawn alike; rows that
    repeat stay; other columns are ignored; an empty table gives an empty result.  A text passes through one
    task whole, in memory of about thirty times its code points in the worst case, one unit each.
    """
    rows = only(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    text = F.col("text")
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    form = (
        F.when((text == "") | marked | (draws[2] % 100 >= rate), "plain")
        .when(draws[3] % 100 < suffix_first, "spm")
        .otherwise("psm")
    )
    cut = (
        rows.withColumn("form", form)
        .withColumn("cuts", F.pandas_udf(_cuts, "n long, first long, second long")("text", F.col("form") != "plain", draws[0], draws[1]))
        .withColumns({
            "prefix_chars": F.col("cuts.first"),
            "middle_chars": F.col("cuts.second") - F.col("cuts.first"),
        })
    )
    first, second = F.col("cuts.first").cast("int"), F.col("cuts.second").cast("int")
    prefix = F.concat(F.lit(PREFIX), text.substr(F.lit(1), first))
    middle = F.concat(F.lit(MIDDLE), text.substr(first + 1, second - first))
    suffix = F.concat(F.lit(SUFFIX), text.substr(second + 1, F.length(text)))
    output = (
        F.when(F.col("form") == "psm", F.concat(prefix, suffix, middle))
        .when(F.col("form") == "spm", F.concat(suffix, prefix, middle))
        .otherwise(text)
    )
    return cut.select("doc_id", F.col("cuts.n").alias("n"), "form", "prefix_chars", "middle_chars", output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of, from nothing but it and its form.

    Cut texts hold no mark and no mark overlaps itself or its neighbours, so the first of each is the one set here.
    """

    def parts(second_mark: str) -> tuple[Column, Column, Column]:
        lead = F.substring_index(output, second_mark, 1)
        rest = output.substr(F.length(lead) + 4, F.length(output))
        other = F.substring_index(rest, MIDDLE, 1)
        return lead.substr(F.lit(4), F.length(lead)), other, rest.substr(F.length(other) + 4, F.length(rest))

    prefix, suffix, middle = parts(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """``fill_in_middle`` with the SHA-256 of its output and of the text rebuilt from that instead of the output."""
    made = fill_in_middle(docs)
    return made.withColumns({
        "output_sha256": F.sha2("output", 256),
        "restored_sha256": F.sha2(restored(F.col("output"), F.col("form")), 256),
    }).drop("output")


#: The same in DuckDB SQL, which lists the units instead of descending to them.
ORACLE_SQL = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
units AS (
  SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS parts,
         ('0x' || substr(digest, 1, 8))::BIGINT AS h1, ('0x' || substr(digest, 9, 8))::BIGINT AS h2,
         ('0x' || substr(digest, 17, 8))::BIGINT AS h3, ('0x' || substr(digest, 25, 8))::BIGINT AS h4
  FROM texts),
chosen AS (
  SELECT *, len(parts)::BIGINT AS n,
         CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
                OR h3 % 100 >= {RATE} THEN 'plain'
              WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
  FROM units),
cut AS (
  SELECT *, array_to_string(parts[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
         array_to_string(parts[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
         array_to_string(parts[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS suffix
  FROM chosen)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                        WHEN 'spm' THEN '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle
                        ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
