"""Publishing results under one ``date=`` slot per run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from aisleworks.operators.clustering import clustered
from aisleworks.versions import date_slot, new_version, point_to


def write_partition(
    df: DataFrame,
    root: str,
    run_date: dt.date,
    cluster_by: str | Sequence[str] | None = "trans_dt",
    compression: str = "gzip",
    row_group_bytes: int | None = None,
) -> int:
    """Replace what is published for ``run_date`` and nothing else; return rows written.

    Rows are gathered by ``cluster_by`` with a rebalance: adaptive execution cuts
    a hot date into several files and merges quiet ones, so no task has to hold a
    whole date; None leaves them as they come.  Several columns, such as store and product, cluster them
    by their interleaved bits, then by date: reads of a store, a product or both skip most row groups by their
    statistics, the more the smaller ``row_group_bytes``.  The rows form a new version that ``read_published`` sees once it
    is whole, also if there are none; until then, and if the run fails, it sees the old one.  One run at
    a time should publish a date; of two at once either stays, whole.
    """
    seen = Observation("published")
    version = new_version(root, date_slot(run_date))
    if isinstance(cluster_by, str):
        gathered = df.hint("rebalance", cluster_by)
    else:
        gathered = clustered(df, cluster_by, ["trans_dt"]) if cluster_by else df
    writer = gathered.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", compression)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(version.path)
    rows = seen.get["rows"]
    point_to(df.sparkSession, version, rows)
    return rows
