"""Aggregations from sale rows to KPI rows.

Low stock compares each sale's quantity with the day's stock, so it cannot be
summed before stock is known; but sales of one day, store, product *and quantity*
all compare alike.  ``sales_by_quantity`` therefore folds sales to that grain
before any join.  The fold combines on the map side and its shuffle key includes
the quantity, so a day, store and product that holds a third of all sales becomes
a handful of rows long before it meets the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisleworks.functions import as_count, as_total, from_cents, to_cents
from aisleworks.operators.stock import low_stock_flag

DAY_KEY = ("yr_wk_num", "trans_dt", "store_key", "prod_key")
WEEK_KEY = ("yr_wk_num", "store_key", "prod_key")

_COUNTS = {"total_low_stock_impact", "low_stock_instances", "no_stock_instances"}
# Whole cents, and cents times a quantity of two decimals.
_WHOLE, _FINE = T.DecimalType(20, 0), T.DecimalType(32, 2)


def sales_by_quantity(dated_sales: DataFrame) -> DataFrame:
    """Sales joined with the calendar, folded by day, store, product, quantity.

    Money is summed in cents.
    """
    amount, price = F.col("sales_amt"), F.col("sales_price")
    return dated_sales.groupBy(*DAY_KEY, "sales_qty").agg(
        F.count(F.lit(1)).alias("sales"),
        F.sum(to_cents(amount)).alias("amt"),
        F.sum(to_cents(F.col("sales_cost"))).alias("cost"),
        # Amount minus stock value exists only for rows having both operands.
        F.sum(to_cents(F.when(amount.isNotNull(), price))).alias("prices"),
        F.sum(to_cents(F.when(price.isNull(), amount))).alias("unpriced_amt"),
    )


def folded_measures() -> dict[str, Column]:
    """KPI aggregates over folded sales that carry their stock columns.

    The results equal the same sums over single sales: every term is a row count
    or an exact sum times a value that is constant within the fold.  Quantities
    and money stay in cents; ``published`` gives the published form.
    """
    low, out = low_stock_flag(), F.col("out_of_stock_flg")
    priced = F.col("amt") - F.coalesce("unpriced_amt", F.lit(0))
    beyond_stock = priced.cast(_WHOLE) - F.col("inventory_on_hand_qty") * F.col("prices").cast(
        _WHOLE
    )
    return {
        "sum_sales_qty": F.sum(to_cents(F.col("sales_qty")) * F.col("sales")),
        "sum_sales_amt": F.sum("amt"),
        "sum_sales_cost": F.sum("cost"),
        "total_low_stock_impact": F.sum(F.col("sales") * (low + out)),
        "potential_low_stock_impact": F.sum(F.when(low == 1, beyond_stock).otherwise(F.lit(0))),
        "no_stock_impact": F.sum(F.when(out == 1, F.col("amt")).otherwise(F.lit(0))),
        "low_stock_instances": F.sum(F.col("sales") * low),
        "no_stock_instances": F.sum(F.col("sales") * out),
    }


def published(name: str) -> Column:
    """A summed measure in units, or as the count it is."""
    if name in _COUNTS:
        return as_count(F.col(name)).alias(name)
    return as_total(F.round(from_cents(F.col(name).cast(_FINE)), 2)).alias(name)


def day_totals(folded_with_stock: DataFrame) -> DataFrame:
    """One row per week, day, store, product and stock level."""
    keys = (*DAY_KEY, "week_end_stock_on_hand", "week_end_ordered_stock")
    measures = folded_measures()
    totals = folded_with_stock.groupBy(
        *DAY_KEY,
        F.col("inventory_on_hand_qty").alias("week_end_stock_on_hand"),
        F.col("inventory_on_order_qty").alias("week_end_ordered_stock"),
    ).agg(*[expr.alias(name) for name, expr in measures.items()])
    return totals.select(*keys, *[published(name) for name in measures])
