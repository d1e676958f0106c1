"""Orders that keep rows near in several columns at once near in files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of all columns together; a 64-bit number without its sign.
_BITS = 62


def interleaved(*columns: str) -> Column:
    """One number whose bits are in turn those of whole-number columns, the least first.

    Rows with equal numbers in all columns are equal in it, and rows near in all of them are mostly near in it.  Bits
    beyond an equal share of 62 are left out, which costs order among keys that differ in nothing else; NULL counts as 0.
    """
    share = _BITS // len(columns)
    values = [F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in columns]
    bits = [
        F.shiftleft(F.shiftright(value, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(columns) + place)
        for bit in range(share)
        for place, value in enumerate(values)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def clustered(df: DataFrame, by: Sequence[str], then: Sequence[str] = ()) -> DataFrame:
    """``df`` in ranges of the interleaved ``by``, sorted within each; equal ones go on in the order of ``then``.

    Ranges are sampled from the whole key and adaptive execution merges small ones, so a hot value of one
    column, or a hot key that ``then`` can split, takes several.
    """
    keyed = df.withColumn("_interleaved", interleaved(*by))
    order = ["_interleaved", *then]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_interleaved")
