"""The two joins behind every KPI.

No broadcast is forced.  Spark broadcasts a side only while its size is under
``spark.sql.autoBroadcastJoinThreshold`` (the calendar, one row per day, always
is) and shuffles both sides beyond that.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_calendar(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Add ``yr_wk_num``; sales on days the calendar lacks are dropped."""
    weeks = calendar.select(F.col("cal_dt").alias("trans_dt"), "yr_wk_num")
    return sales.join(weeks, "trans_dt", "inner")


def join_inventory(sales: DataFrame, inventory: DataFrame) -> DataFrame:
    """Add the stock columns of the same day, store and product; keep all sales.

    Used directly for row-level results only.  There the join is the last shuffle,
    so adaptive execution may split a hot day, store and product over many tasks.
    """
    stock = inventory.select(
        F.col("cal_dt").alias("trans_dt"),
        "store_key",
        "prod_key",
        "inventory_on_hand_qty",
        "inventory_on_order_qty",
        "out_of_stock_flg",
    )
    return sales.join(stock, ["trans_dt", "store_key", "prod_key"], "left")


def join_null_safe(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right`` where ``columns`` are equal, NULL to NULL."""
    other = right.withColumnsRenamed({c: f"_{c}" for c in columns})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    return left.join(other, same, how).drop(*[f"_{c}" for c in columns])
