"""KPIs at true week grain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aisleworks.functions import as_count, ratio2
from aisleworks.operators.aggregates import (
    WEEK_KEY, folded_measures, published, sales_by_quantity,
)
from aisleworks.operators.joins import join_calendar, join_inventory

_SUMS = (
    "sum_sales_qty",
    "sum_sales_amt",
    "sum_sales_cost",
    "potential_low_stock_impact",
    "no_stock_impact",
    "low_stock_instances",
)


def week_numbers(calendar: DataFrame) -> DataFrame:
    """The calendar's weeks counted 1, 2, 3 … in order.

    The unpartitioned window sees one row per calendar week and nothing else.
    """
    weeks = calendar.select("yr_wk_num").distinct()
    return weeks.withColumn("week_idx", F.row_number().over(Window.orderBy("yr_wk_num")))


def week_sales(sales: DataFrame, calendar: DataFrame, inventory: DataFrame) -> DataFrame:
    """Sales and low-stock sums of each week, store and product that had sales."""
    folded = join_inventory(sales_by_quantity(join_calendar(sales, calendar)), inventory)
    measures = folded_measures()
    return folded.groupBy(*WEEK_KEY).agg(*[measures[name].alias(name) for name in _SUMS])


def week_stock(calendar: DataFrame, inventory: DataFrame) -> DataFrame:
    """Last stock and out-of-stock days of each week, store and product that had stock."""
    stock = join_calendar(
        inventory.select(
            F.col("cal_dt").alias("trans_dt"),
            "store_key",
            "prod_key",
            "inventory_on_hand_qty",
            "inventory_on_order_qty",
            "out_of_stock_flg",
        ),
        calendar,
    )
    return stock.groupBy(*WEEK_KEY).agg(
        F.max_by("inventory_on_hand_qty", "trans_dt").alias("week_end_stock_on_hand"),
        F.max_by("inventory_on_order_qty", "trans_dt").alias("week_end_ordered_stock"),
        as_count(F.sum("out_of_stock_flg")).alias("out_of_stock_days"),
    )


def kpi_weekly(sales: DataFrame, calendar: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row per week, store and product that had sales or stock.

    Sales meet the stock of their day in a left join, which adaptive execution can split
    at a hot key; sales and stock are then summed to weeks separately, and the full
    join sees one row of either side per week, store and product.
    """
    stocked = week_stock(calendar, inventory).withColumnsRenamed({c: f"stock_{c}" for c in WEEK_KEY})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"stock_{c}")) for c in WEEK_KEY])
    weeks = week_sales(sales, calendar, inventory).join(stocked, same, "full_outer").select(
        *[F.coalesce(c, f"stock_{c}").alias(c) for c in WEEK_KEY],
        "week_end_stock_on_hand",
        "week_end_ordered_stock",
        "out_of_stock_days",
        *[F.coalesce(name, F.lit(0)).alias(name) for name in _SUMS],
    )

    earlier = Window.partitionBy("store_key", "prod_key").orderBy("week_idx")
    follows = F.lag("week_idx").over(earlier) == F.col("week_idx") - 1
    sold, amount, last = (F.col(c) for c in ("sum_sales_qty", "sum_sales_amt", "last_week_sales"))
    on_hand = F.col("week_end_stock_on_hand")
    return (
        weeks.select(
            *WEEK_KEY,
            "week_end_stock_on_hand",
            "week_end_ordered_stock",
            "out_of_stock_days",
            *[published(name) for name in _SUMS],
        )
        .join(week_numbers(calendar), "yr_wk_num")
        .withColumn("last_week_sales", F.when(follows, F.lag("sum_sales_amt").over(earlier)))
        .select(
            *WEEK_KEY,
            "week_end_stock_on_hand",
            "week_end_ordered_stock",
            "out_of_stock_days",
            *_SUMS,
            ratio2(amount, sold).alias("avg_sales_price"),
            ratio2(on_hand, sold).alias("week_supply_stock"),
            last,
            ratio2((amount - last) * 100, last).alias("week_over_week_growth"),
            ratio2(sold, on_hand).alias("stock_turnover_rate"),
        )
    )
