"""Restating the daily KPIs by difference: from what was published and what has changed since.

Two snapshots of the inputs are compared by digest, first per date (one row per date and task is shuffled), then, on the
dates that differ, per day, store and product.  Only those day keys are computed anew.  A changed key
also changes the previous sales of the row that follows it in its store and product, and only of that row; rows
next to changed keys are looked for in widening slices of dates around them.  All other published rows are taken
over as they are, and rows of dates that hold neither changed keys nor followers are never shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aisleworks.functions.digests import row_hash
from aisleworks.operators.joins import join_null_safe
from aisleworks.plans.daily import kpi_agg, with_ratios
from aisleworks.schemas import KPI_COLUMNS
from aisleworks.scratch import scratch_path

KEY = ("trans_dt", "store_key", "prod_key")
_PAIR = ("store_key", "prod_key")
_STOCK = ("week_end_stock_on_hand", "week_end_ordered_stock")
# What the KPIs use of each fact; other columns may change freely.
_SALES = (*KEY, "sales_qty", "sales_amt", "sales_cost", "sales_price")
_INVENTORY = (*KEY, "inventory_on_hand_qty", "inventory_on_order_qty", "out_of_stock_flg")

#: Days around a change that are searched first for its neighbours, and how much wider each further search is.
NEAR_DAYS, WIDEN = 14, 8


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"restate-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def changed_groups(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The ``keys`` of which the two frames hold different multisets of rows.

    Rows count positive or negative by their side and equal ones cancel out, so a group of any size is one row per
    task before the shuffle.
    """
    def halves(df: DataFrame, sign: int) -> DataFrame:
        value = row_hash(*df.columns)
        high, low = F.shiftright(value, 32), value.bitwiseAND(F.lit(0xFFFFFFFF))
        return df.select(*keys, F.lit(sign).cast("long").alias("n"), (high * sign).alias("high"), (low * sign).alias("low"))

    sums = halves(after, 1).unionByName(halves(before, -1)).groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in ("n", "high", "low")]
    )
    return sums.where("n <> 0 OR high <> 0 OR low <> 0").select(*keys)


class _Days:
    """The order of all days of both calendars, by week and day.

    A calendar has a row per day, so it is held here; nothing that grows with sales is.
    """

    def __init__(self, spark: SparkSession, before: DataFrame, after: DataFrame, published: DataFrame):
        old, new = (Counter((row.yr_wk_num, row.cal_dt) for row in df.select("yr_wk_num", "cal_dt").collect()) for df in (before, after))
        every = sorted({*old, *new}, key=lambda day: (day[0] is not None, day[0] or 0, day[1]))
        self.changed = {day for week, day in every if old[week, day] != new[week, day]}
        self.dates = [day for _, day in every]
        self.known = set(self.dates)
        # No published row lies before or after these places.
        least, most = published.agg(F.min("trans_dt"), F.max("trans_dt")).first()
        held = [place for place, day in enumerate(self.dates) if least and least <= day <= most]
        self.first, self.last = (held[0], held[-1]) if held else (0, -1)
        self._places = spark.createDataFrame(
            [(week, day, place) for place, (week, day) in enumerate(every)], "yr_wk_num int, trans_dt date, place int"
        )

    def placed(self, df: DataFrame) -> DataFrame:
        return join_null_safe(df, self._places, ("yr_wk_num", "trans_dt"))

    def beside(self, before: Collection[int], after: Collection[int], width: int) -> set[dt.date]:
        """Dates at most ``width`` places before any of ``before`` or after any of ``after``."""
        near: set[int] = set()
        for place in before:
            near.update(range(max(self.first, place - width), min(self.last + 1, place)))
        for place in after:
            near.update(range(max(self.first, place + 1), min(self.last, place + width) + 1))
        return {self.dates[place] for place in near}


def _on(df: DataFrame, dates: Collection[dt.date], column: str = "trans_dt") -> DataFrame:
    return df.where(F.col(column).isin(sorted(dates)) if dates else F.lit(False))


def _changed_keys(
    before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], published: DataFrame, days: _Days
) -> tuple[DataFrame, set[dt.date]]:
    """Day keys whose KPIs may differ, and their dates."""
    facts = []
    for table, columns, dated in (("sales", _SALES, "trans_dt"), ("inventory", _INVENTORY, "cal_dt")):
        sides = [side[table].withColumnRenamed(dated, "trans_dt").select(*columns) for side in (before, after)]
        differ = {row.trans_dt for row in changed_groups(*sides, ("trans_dt",)).collect()} & days.known
        facts.append((sides, differ))
    keys = [changed_groups(*(_on(side, differ) for side in sides), KEY) for sides, differ in facts if differ]
    if days.changed:  # a day that moved to another week, came or went: all of its keys
        keys += [_on(df.select(*KEY), days.changed) for df in (published, after["sales"])]
    dates = set().union(days.changed, *(differ for _, differ in facts))
    if not keys:
        return published.select(*KEY).limit(0), dates
    every = keys[0]
    for more in keys[1:]:
        every = every.unionByName(more)
    return _stored(every.distinct(), "keys"), dates


_ROW = "struct(place, week_end_stock_on_hand, week_end_ordered_stock, trans_dt, yr_wk_num, sum_sales_amt)"


def _neighbours(kept: DataFrame, marks: DataFrame, days: _Days, near: int) -> DataFrame:
    """(store_key, prod_key, follows, row): the kept rows next to marks, with no other mark between.

    ``marks`` (store_key, prod_key, place) says where rows came or went.  A search covers all days within some
    distance of each open mark, so what it finds within that distance is next to it, and a mark that
    finds nothing goes on to a wider one until that spans all days.
    """
    open_marks, width, found = marks, near, []
    while True:
        # At most two rows per calendar day.
        sides = open_marks.groupBy("place").agg(F.bool_and("done_before").alias("before"), F.bool_and("done_after").alias("after")).collect()
        if not sides:
            break
        dates = days.beside([s.place for s in sides if not s.before], [s.place for s in sides if not s.after], width)
        rows = days.placed(_on(kept, dates)).select(*_PAIR, "place", F.expr(_ROW).alias("row"))
        # Marks of a pair bound each other's search, so all marks of the pairs in question are there.
        pairs = open_marks.select(*_PAIR).distinct()
        around = join_null_safe(rows, pairs, _PAIR, "left_semi").unionByName(
            join_null_safe(marks.select(*_PAIR, "place"), pairs, _PAIR, "left_semi"), allowMissingColumns=True
        )
        upto, mark = (Window.unboundedPreceding, -1), F.when(F.col("row").isNull(), F.col("place"))
        stock = [F.col("row")[name] for name in _STOCK]
        rising = Window.partitionBy(*_PAIR).orderBy("place", *stock).rowsBetween(*upto)
        falling = Window.partitionBy(*_PAIR).orderBy(F.desc("place"), *[value.desc() for value in stock]).rowsBetween(*upto)
        ends = {}
        for side, window in (("before", rising), ("after", falling)):
            ends[side] = F.last("row", ignorenulls=True).over(window)
            ends[f"{side}_mark"] = F.last(mark, ignorenulls=True).over(window)
        sought = join_null_safe(around.withColumns(ends).where("row IS NULL").drop("row"), open_marks, (*_PAIR, "place"))
        # A neighbour counts if it is near enough to be sure of, and nearer than the next mark.
        low, high = F.col("place") - width, F.col("place") + width
        before_row, after_row = F.col("before.place"), F.col("after.place")
        nothing = F.lit(days.first - 1), F.lit(days.last + 1)
        before_mark, after_mark = F.coalesce("before_mark", nothing[0]), F.coalesce("after_mark", nothing[1])
        sure_before = F.greatest(F.coalesce(before_row, nothing[0]), before_mark) >= F.greatest(low, nothing[0])
        sure_after = F.least(F.coalesce(after_row, nothing[1]), after_mark) <= F.least(high, nothing[1])
        settled = _stored(sought.select(
            *_PAIR, "place",
            F.when(~F.col("done_before") & sure_before & (before_row > before_mark), F.col("before")).alias("before"),
            F.when(~F.col("done_after") & sure_after & (after_row < after_mark), F.col("after")).alias("after"),
            (F.col("done_before") | sure_before).alias("done_before"),
            (F.col("done_after") | sure_after).alias("done_after"),
        ), "neighbours")
        for side, follows in (("before", False), ("after", True)):
            found.append(settled.where(f"{side} IS NOT NULL").select(*_PAIR, F.lit(follows).alias("follows"), F.col(side).alias("row")))
        open_marks = settled.where("NOT (done_before AND done_after)").select(*_PAIR, "place", "done_before", "done_after")
        width *= WIDEN
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy(*_PAIR, "row").agg(F.bool_or("follows").alias("follows"))


def restate(
    published: DataFrame, before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], near: int = NEAR_DAYS
) -> DataFrame:
    """``kpi_daily(**after)``, made of ``published``, which is ``kpi_daily(**before)``.

    Both sides name sales, calendar and inventory; tables should be stored, as they are read more than once.  Rows may
    have been added, changed and deleted in any of them.
    """
    published = published.select(*KPI_COLUMNS)
    spark = published.sparkSession
    days = _Days(spark, before["calendar"], after["calendar"], published)
    keys, dates = _changed_keys(before, after, published, days)
    if not dates:
        return published
    sales = join_null_safe(_on(after["sales"], dates), keys, KEY, "left_semi")
    stock_keys = keys.withColumnRenamed("trans_dt", "cal_dt")
    inventory = join_null_safe(_on(after["inventory"], dates, "cal_dt"), stock_keys, ("cal_dt", *_PAIR), "left_semi")
    fresh = _stored(kpi_agg(sales, after["calendar"], inventory), "fresh")

    gone = join_null_safe(_on(published, dates), keys, KEY, "left_semi")
    kept = _on(published, dates)
    kept = published.where(~F.col("trans_dt").isin(sorted(dates))).unionByName(join_null_safe(kept, keys, KEY, "left_anti"))
    marks = _stored(
        days.placed(fresh.select(*_PAIR, "yr_wk_num", "trans_dt").unionByName(gone.select(*_PAIR, "yr_wk_num", "trans_dt")))
        .select(*_PAIR, "place").distinct()
        .select("*", F.lit(False).alias("done_before"), F.lit(False).alias("done_after")),
        "marks",
    )
    if marks.isEmpty():
        return published
    neighbours = _neighbours(kept, marks, days, near)

    # In order, each fresh row and each follower comes right after the row whose sales it needs.
    beside = neighbours.select(*_PAIR, "row.*", "follows").drop("place")
    line = fresh.select(
        *_PAIR, *_STOCK, "trans_dt", "yr_wk_num", "sum_sales_amt", F.lit(None).cast("boolean").alias("follows")
    )
    in_order = Window.partitionBy(*_PAIR).orderBy("yr_wk_num", "trans_dt", *_STOCK)
    last = _stored(
        line.unionByName(beside).withColumn("last_week_sales", F.lag("sum_sales_amt").over(in_order))
        .where("follows IS NULL OR follows"),
        "last",
    )
    full_key = ("yr_wk_num", *KEY, *_STOCK)
    fresh_rows = join_null_safe(fresh, last.where("follows IS NULL").select(*full_key, "last_week_sales"), full_key)
    followers = last.where("follows").select(*full_key, F.col("last_week_sales").alias("_last"), F.lit(True).alias("_follows"))
    touched = dates | {r.trans_dt for r in followers.select("trans_dt").distinct().collect()}  # at most one per calendar day
    same = published.where(~F.col("trans_dt").isin(sorted(touched)))
    beside_rows = join_null_safe(join_null_safe(_on(published, touched), keys, KEY, "left_anti"), followers, full_key, "left")
    followed = F.coalesce("_follows", F.lit(False))
    beside_rows = beside_rows.withColumn("last_week_sales", F.when(followed, F.col("_last")).otherwise(F.col("last_week_sales")))
    merged = [with_ratios(df).select(*KPI_COLUMNS) for df in (fresh_rows, beside_rows)]
    return same.unionByName(merged[0]).unionByName(merged[1])
