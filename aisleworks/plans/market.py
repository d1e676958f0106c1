"""KPIs per week, market and product category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleworks.functions import as_count, as_total, ratio2
from aisleworks.plans.daily import kpi_agg

_TOTALS = (
    "sum_sales_qty",
    "sum_sales_amt",
    "sum_sales_cost",
    "potential_low_stock_impact",
    "no_stock_impact",
)
_COUNTS = ("total_low_stock_impact", "low_stock_instances", "no_stock_instances")


def _one_per_key(dimension: DataFrame, key: str, group: str) -> DataFrame:
    """``group`` of each key; a repeated key, which would multiply sales, fails the query."""
    rows = dimension.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.max(group).alias(group)
    )
    repeated = F.raise_error(F.format_string(f"{key} %s is repeated", key))
    return rows.select(key, F.when(F.col("rows") > 1, repeated).otherwise(F.col(group)).alias(group))


def kpi_by_market_category(
    sales: DataFrame,
    calendar: DataFrame,
    inventory: DataFrame,
    store: DataFrame,
    product: DataFrame,
) -> DataFrame:
    """Day KPIs summed over the stores of a market and the products of a category.

    Sales of stores or products that the dimensions lack, or that have no key, are in the
    groups whose market or category is NULL, so the totals are those of the daily KPIs.
    Dimensions meet day totals, never single sales.  Spark broadcasts them while
    they are small and shuffles on their key when they are not.
    """
    return (
        kpi_agg(sales, calendar, inventory)
        .join(_one_per_key(store, "store_key", "market_key"), "store_key", "left")
        .join(_one_per_key(product, "prod_key", "category_key"), "prod_key", "left")
        .groupBy("yr_wk_num", "market_key", "category_key")
        .agg(
            *[as_total(F.sum(c)).alias(c) for c in _TOTALS],
            *[as_count(F.sum(c)).alias(c) for c in _COUNTS],
        )
        .withColumn("avg_sales_price", ratio2(F.col("sum_sales_amt"), F.col("sum_sales_qty")))
    )
