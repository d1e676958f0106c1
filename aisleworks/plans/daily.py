"""KPIs per day, store and product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleworks.functions import as_count, ratio2
from aisleworks.operators.aggregates import WEEK_KEY, day_totals, sales_by_quantity
from aisleworks.operators.joins import join_calendar, join_inventory
from aisleworks.operators.stock import low_stock_flag, stock_value
from aisleworks.operators.windows import running_out_of_stock, with_last_sales
from aisleworks.schemas import KPI_COLUMNS


def kpi_base(sales: DataFrame, calendar: DataFrame, inventory: DataFrame) -> DataFrame:
    """Each sale with its week and the stock of its day.

    The week-end stock columns are the row's own stock: a last value over a frame
    that ends at the current row is the current row, so no window is needed.
    """
    return join_inventory(join_calendar(sales, calendar), inventory).select(
        "yr_wk_num",
        "store_key",
        "prod_key",
        "trans_dt",
        "sales_qty",
        "sales_amt",
        "sales_cost",
        "inventory_on_hand_qty",
        "inventory_on_order_qty",
        "out_of_stock_flg",
        stock_value().alias("stock_on_hand_amt"),
        F.col("inventory_on_hand_qty").alias("week_end_stock_on_hand"),
        F.col("inventory_on_order_qty").alias("week_end_ordered_stock"),
        low_stock_flag().alias("low_stock_flg"),
    )


def kpi_agg(sales: DataFrame, calendar: DataFrame, inventory: DataFrame) -> DataFrame:
    """Sums, impacts and sale-side ratios per day, store, product and stock level."""
    folded = sales_by_quantity(join_calendar(sales, calendar))
    sold, amount = F.col("sum_sales_qty"), F.col("sum_sales_amt")
    return (
        day_totals(join_inventory(folded, inventory))
        .withColumn("avg_sales_price", ratio2(amount, sold))
        .withColumn("week_supply_stock", ratio2(F.col("week_end_stock_on_hand"), sold))
    )


def with_ratios(kpis: DataFrame) -> DataFrame:
    """Growth over the previous row in percent, and stock turnover."""
    amount, last = F.col("sum_sales_amt"), F.col("last_week_sales")
    return kpis.withColumn(
        "week_over_week_growth", ratio2((amount - last) * 100, last)
    ).withColumn(
        "stock_turnover_rate", ratio2(F.col("sum_sales_qty"), F.col("week_end_stock_on_hand"))
    )


def kpi_daily(sales: DataFrame, calendar: DataFrame, inventory: DataFrame) -> DataFrame:
    """The nineteen published columns, one row per day, store and product."""
    kpis = with_ratios(with_last_sales(kpi_agg(sales, calendar, inventory)))
    return kpis.select(*KPI_COLUMNS)


def week_out_of_stock_running(
    sales: DataFrame, calendar: DataFrame, inventory: DataFrame
) -> DataFrame:
    """Out-of-stock sales so far in the week of a store and product, sale by sale."""
    sale = ["trans_dt", "trans_id", "sales_qty", "sales_amt", "sales_price"]
    total = "week_out_of_stock"
    counted = running_out_of_stock(join_calendar(sales, calendar), inventory, sale, total)
    return counted.select(*WEEK_KEY, *sale, as_count(F.col(total)).alias(total))
