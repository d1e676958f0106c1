"""Running sums over groups of any size: a prefix scan over ranges of the total order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisleworks.operators.joins import join_null_safe
from aisleworks.scratch import scratch_path


def plus(*terms: Column) -> Column:
    """Sum of the terms that are not NULL; NULL if all are."""
    total = reduce(lambda a, b: a + b, [F.coalesce(t, F.lit(0)) for t in terms])
    return F.when(F.coalesce(*terms).isNotNull(), total)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"prefix-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_ranges(rows: DataFrame, order: Sequence[str], ranges: int) -> DataFrame:
    """``rows`` with ``_at``, a number of their own, and ``_range``: about equal ranges of the order, stored.

    The split points are sampled from the whole ordering key, with ``_at`` as its end, so rows that are equal in all else
    are split too, however many there are.  The numbers are taken from stored rows: a task that is run again
    gives each row the same one.
    """
    held = _stored(rows, "rows").withColumn("_at", F.monotonically_increasing_id())
    return _stored(held.repartitionByRange(ranges, *order, "_at").withColumn("_range", F.spark_partition_id()), "ranges")


def running_sum(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, ranges: int | None = None
) -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows of their ``keys`` up to them, by ``order``; NULL if none has a value.

    Rows are cut into ranges of (keys, order).  Each range is summed by one task; a scan of the ranges' sums gives what
    earlier ranges hold of the only key that can go on into a range, its first one.  So no task sorts more than a
    range, whatever the size of a key.  Rows equal in ``order`` share their places among
    themselves.  ``ranges`` is ``spark.sql.shuffle.partitions`` unless given.
    """
    number = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = in_ranges(rows, [*keys, *order], number)
    sums = ranged.groupBy("_range", *keys).agg(F.sum(value).alias("held"))
    earlier = Window.partitionBy(*keys).orderBy("_range")
    carried = sums.select(
        "_range", *keys, F.row_number().over(earlier).alias("nth"),
        F.sum("held").over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
    ).where("nth > 1").drop("nth")
    upto = Window.partitionBy("_range", *keys).orderBy(*order, "_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A task for each range, which the window then needs no shuffle for.
    own = ranged.repartitionById(number, "_range").withColumn("_own", F.sum(value).over(upto))
    # At most one key goes on into a range, so the other side has no more rows than there are ranges.
    joined = join_null_safe(own, F.broadcast(carried), ["_range", *keys], "left")
    return joined.withColumn(name, plus(F.col("_before"), F.col("_own"))).drop("_at", "_range", "_own", "_before")
