"""Digests of rows and of sets of rows, whatever their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(*columns: str | Column) -> Column:
    """64 bits of a row's values.

    Spark's hash passes over NULL, so each value is followed by whether it is one: (NULL, 1) differs from (1, NULL).
    """
    values = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.xxhash64(*[part for value in values for part in (value, value.isNull())])


def multiset_digest(*columns: str | Column) -> dict[str, Column]:
    """Aggregates (rows, high, low) that are equal for equal multisets of rows and for others almost never.

    The halves of the row hashes are summed apart, so no sum leaves 64 bits below two thousand million rows a group;
    beyond that ANSI mode fails.  Sums, unlike exclusive ors, count rows that repeat.  Digests of parts add up to the
    digest of the whole.
    """
    value = row_hash(*columns)
    return {
        "rows": F.count(F.lit(1)),
        "high": F.coalesce(F.sum(F.shiftright(value, 32)), F.lit(0)),
        "low": F.coalesce(F.sum(value.bitwiseAND(F.lit(0xFFFFFFFF))), F.lit(0)),
    }


def digest_columns(frame: DataFrame) -> list[Column]:
    """The multiset digest of all columns of a frame, in its order, ready for ``agg`` or ``observe``."""
    return [value.alias(name) for name, value in multiset_digest(*(frame[f"`{c}`"] for c in frame.columns)).items()]
