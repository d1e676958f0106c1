"""Reading what has been published."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession

from aisleworks.versions import current_versions, date_slot


class NothingPublishedError(LookupError):
    """No version of any date asked for has been published."""


def published_paths(spark: SparkSession, root: str, days: Collection[dt.date] | None = None) -> list[str]:
    """The folders that hold the published dates, for readers other than Spark; the rest under ``root`` is not theirs."""
    found = current_versions(spark, root)
    slots = sorted(found) if days is None else [date_slot(day) for day in sorted(days) if date_slot(day) in found]
    return [found[slot].path for slot in slots]


def read_published(spark: SparkSession, root: str, days: Collection[dt.date] | None = None) -> DataFrame:
    """The rows of all published dates, or of ``days``, with their run date as ``date``.

    The versions are fixed when this is called: a frame reads the same rows for as long as ``clean`` keeps them,
    whatever is published meanwhile.
    """
    paths = published_paths(spark, root, days)
    if not paths:
        raise NothingPublishedError(f"nothing published under {root}" + (f" for {sorted(map(str, days))}" if days else ""))
    return spark.read.option("basePath", root).parquet(*paths).drop("version")
