"""Ordered calculations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aisleworks.operators.aggregates import DAY_KEY, WEEK_KEY
from aisleworks.operators.joins import join_inventory, join_null_safe
from aisleworks.operators.prefix import plus, running_sum


def with_last_sales(kpis: DataFrame) -> DataFrame:
    """Sales of the previous KPI row of the same store and product.

    A window holds at most one row per calendar day, however many sales there
    were, because it runs over day totals.  The stock columns only break ties
    should an inventory key ever be duplicated.
    """
    previous = Window.partitionBy("store_key", "prod_key").orderBy(
        "yr_wk_num", "trans_dt", "week_end_stock_on_hand", "week_end_ordered_stock"
    )
    return kpis.withColumn("last_week_sales", F.lag("sum_sales_amt").over(previous))


def stock_days(dated_sales: DataFrame, inventory: DataFrame) -> DataFrame:
    """Each stock row of each traded day, with what the week's earlier days counted.

    ``carry`` is the sum of the out-of-stock flag over the sales of earlier days of the week,
    NULL if none had a flag.  ``numbered`` tells days on which sales must be counted one by
    one: those out of stock, and those whose repeated stock rows disagree.  Sales are
    counted per day before they meet stock, so a window holds a week's days only.
    """
    traded = dated_sales.groupBy(*DAY_KEY).agg(F.count(F.lit(1)).alias("sold"))
    flag = F.col("out_of_stock_flg")
    day = Window.partitionBy(*DAY_KEY)
    upto = Window.partitionBy(*WEEK_KEY).orderBy("trans_dt")  # with the day itself
    stocked = join_inventory(traded, inventory).withColumns(
        {
            "own": F.sum(flag * F.col("sold")).over(day),
            "own_flags": F.count(flag).over(day),
            "copies": F.count(F.lit(1)).over(day),
            "least": F.min(flag).over(day),
            "most": F.max(flag).over(day),
            "all": F.sum(flag * F.col("sold")).over(upto),
            "all_flags": F.count(flag).over(upto),
        }
    )
    mixed = ((F.col("own_flags") > 0) & (F.col("own_flags") < F.col("copies"))) | (F.col("least") < F.col("most"))
    return stocked.select(
        *DAY_KEY,
        flag,
        F.when(
            F.col("all_flags") > F.col("own_flags"), F.col("all") - F.coalesce("own", F.lit(0))
        ).alias("carry"),
        F.coalesce(mixed | (F.col("most") != 0), F.lit(False)).alias("numbered"),
    )


def running_out_of_stock(
    dated_sales: DataFrame, inventory: DataFrame, order: Sequence[str], name: str, ranges: int | None = None
) -> DataFrame:
    """Running sum of the out-of-stock flag over the sales of a week, store and product.

    ``order`` begins with the day.  Where a whole day has flag 0 or none, its sales need only the carry.  Sales of
    other days are summed up to each within their day by a prefix scan, whose ranges cut through days and
    transactions alike; they are stored for it when this is called.
    """
    sales = dated_sales.select(*WEEK_KEY, *order)
    found = join_null_safe(sales, stock_days(dated_sales, inventory), DAY_KEY)
    flag = F.col("out_of_stock_flg")
    kept = [*WEEK_KEY, *order]
    plain = found.where(~F.col("numbered")).select(*kept, plus(F.col("carry"), flag).alias(name))
    numbered = found.where("numbered").select(*kept, "out_of_stock_flg", "carry")
    within = [c for c in order if c not in DAY_KEY]
    counted = running_sum(numbered, DAY_KEY, [*within, "out_of_stock_flg"], "out_of_stock_flg", "_day", ranges)
    return plain.unionByName(counted.select(*kept, plus(F.col("carry"), F.col("_day")).alias(name)))
