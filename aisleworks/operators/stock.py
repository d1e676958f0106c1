"""Row-level stock measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stock_value() -> Column:
    """Stock on hand at the sale's price; exact, four decimals."""
    value = F.col("inventory_on_hand_qty") * F.col("sales_price")
    return value.cast(T.DecimalType(28, 4))


def low_stock_flag() -> Column:
    """1 when less was on hand than was sold, else 0, also where stock is unknown."""
    short = F.col("inventory_on_hand_qty") < F.col("sales_qty")
    return F.when(short, F.lit(1)).otherwise(F.lit(0))
