"""Load checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


class DuplicateKeyError(ValueError):
    """A table that must have unique keys has not."""


def require_unique(df: DataFrame, keys: Sequence[str], table: str) -> None:
    """Fail with a few examples when keys repeat."""
    examples = duplicate_keys(df, keys).limit(5).collect()
    if examples:
        raise DuplicateKeyError(f"{table} repeats {tuple(keys)}: {examples}")
