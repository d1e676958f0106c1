"""Time the headline queries over stored typed tables and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores; BENCH_RUNS the timed runs after
one warm-up (median is reported).  The retail tables are derived and written once, before
any timing, so that the engine is timed and not its test tables.  ``--compare``
instead times the daily KPIs over tables of four shapes, BENCH_COPIES times the
sales, against the same KPIs computed sale by sale with and without the two identity
windows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aisleworks import sinks, sources
from aisleworks.functions import as_count, as_total, ratio2
from aisleworks.operators import readiness
from aisleworks.operators.windows import with_last_sales
from aisleworks.plans import batch, daily, kpi_by_market_category, kpi_weekly
from aisleworks.schemas import INVENTORY_KEY, TABLES
from aisleworks.scratch import scratch_path
from aisleworks.session import build_session
from retail_checks import derived
from retail_checks.catalog import LANDING, LAST_DATE, MID_DATE


def stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five typed tables and a file listing, written once; as many files as cores."""
    root = scratch_path(spark, "bench-tables")
    tables = {}
    for name, df in derived.all_tables(spark, sf_dir).items():
        df.repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{root}/{name}")
        tables[name] = spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")
    required = readiness.required_files(derived.business_days(spark, sf_dir))
    for name, df in (("required", required), ("listing", derived.listing(required, LANDING))):
        df.write.parquet(f"{root}/{name}")
        tables[name] = spark.read.parquet(f"{root}/{name}")
    return tables


def headline(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """Each query as a function that does all of its work when its result is written."""
    facts = {name: tables[name] for name in ("sales", "calendar", "inventory")}
    typed = {name: tables[name] for name in TABLES}

    def publish() -> DataFrame:
        root = scratch_path(spark, "bench-publish")
        for day in (MID_DATE, LAST_DATE, MID_DATE):
            known = {name: sinks.snapshot(df, name, day) for name, df in facts.items()}
            sinks.write_partition(daily.kpi_daily(**known), root, day)
        return sources.read_published(spark, root)

    def audit() -> DataFrame:
        location = sources.Location(scratch_path(spark, "bench-export"))
        return sinks.audit_frame(spark, sinks.export_snapshot(typed, location, MID_DATE))

    def whole_batch() -> DataFrame:
        landing = sources.Location(scratch_path(spark, "bench-landing"))
        root = scratch_path(spark, "bench-output")
        sinks.export_snapshot(typed, landing, LAST_DATE)
        batch.run(spark, landing, root, LAST_DATE)
        return sources.read_published(spark, root)

    return {
        "kpi_daily": lambda: daily.kpi_daily(**facts),
        "kpi_weekly": lambda: kpi_weekly(**facts),
        "kpi_by_market_category": lambda: kpi_by_market_category(**typed),
        "kpi_base": lambda: daily.kpi_base(**facts),
        "week_out_of_stock_running": lambda: daily.week_out_of_stock_running(**facts),
        "sink_partition_overwrite": publish,
        "export_audit": audit,
        "readiness_by_date": lambda: readiness.readiness_by_date(tables["required"], tables["listing"]),
        "batch_end_to_end": whole_batch,
    }


def sale_by_sale(
    sales: DataFrame, calendar: DataFrame, inventory: DataFrame, identity_windows: bool = False
) -> DataFrame:
    """The daily KPIs from single sales, as a yardstick for the folded plan."""
    base = daily.kpi_base(sales, calendar, inventory)
    if identity_windows:
        day = Window.partitionBy("trans_dt", "store_key", "prod_key").orderBy("yr_wk_num")
        week = Window.partitionBy("yr_wk_num", "store_key", "prod_key").orderBy("yr_wk_num")
        upto = (Window.unboundedPreceding, Window.currentRow)
        on_hand, on_order = F.last("inventory_on_hand_qty"), F.last("inventory_on_order_qty")
        base = base.withColumns(
            {
                "week_end_stock_on_hand": on_hand.over(day.rowsBetween(*upto)),
                "week_end_ordered_stock": on_order.over(week.rowsBetween(*upto)),
            }
        )
    low, out, amount = (F.col(c) for c in ("low_stock_flg", "out_of_stock_flg", "sales_amt"))
    beyond = F.when(low == 1, amount - F.col("stock_on_hand_amt")).otherwise(0)
    sums = base.groupBy(
        "yr_wk_num", "trans_dt", "store_key", "prod_key",
        "week_end_stock_on_hand", "week_end_ordered_stock",
    ).agg(
        as_total(F.sum("sales_qty")).alias("sum_sales_qty"),
        as_total(F.sum(amount)).alias("sum_sales_amt"),
        as_total(F.sum("sales_cost")).alias("sum_sales_cost"),
        as_count(F.sum(low + out)).alias("total_low_stock_impact"),
        as_total(F.round(F.sum(beyond), 2)).alias("potential_low_stock_impact"),
        as_total(F.sum(F.when(out == 1, amount).otherwise(0))).alias("no_stock_impact"),
        as_count(F.sum(low)).alias("low_stock_instances"),
        as_count(F.sum(out)).alias("no_stock_instances"),
    )
    sold = F.col("sum_sales_qty")
    kpis = sums.withColumn("avg_sales_price", ratio2(F.col("sum_sales_amt"), sold)).withColumn(
        "week_supply_stock", ratio2(F.col("week_end_stock_on_hand"), sold)
    )
    return daily.with_ratios(with_last_sales(kpis))


def _stored(spark: SparkSession, sf_dir: str, copies: int) -> dict[str, dict[str, DataFrame]]:
    """Typed Parquet tables: copies spread over new stores, on the same keys, and
    with a third of all sales on one day, store and product."""
    root = scratch_path(spark, "bench")
    tables = derived.kpi_tables(spark, sf_dir)
    for name in ("calendar", "inventory"):
        tables[name].write.parquet(f"{root}/{name}")
    stored = {name: spark.read.parquet(f"{root}/{name}") for name in ("calendar", "inventory")}

    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    dense = tables["sales"].withColumn("copy", copy)
    hot = F.pmod(F.xxhash64("trans_id", "copy"), F.lit(3)) == 0
    target = stored["inventory"].orderBy(*INVENTORY_KEY).first()
    shapes = {
        "sparse": dense.withColumn("store_key", F.col("store_key") + F.col("copy") * 5),
        "dense": dense,
        "hot": dense.withColumns(
            {
                "trans_dt": F.when(hot, F.lit(target.cal_dt)).otherwise(F.col("trans_dt")),
                "store_key": F.when(hot, F.lit(target.store_key)).otherwise(F.col("store_key")),
                "prod_key": F.when(hot, F.lit(target.prod_key)).otherwise(F.col("prod_key")),
            }
        ),
    }
    # Goods sold by weight: quantities hardly ever repeat.
    grams = F.pmod(F.xxhash64("trans_id", "copy"), F.lit(1_000_000)) / 10_000
    shapes["hot_fractional"] = shapes["hot"].withColumn("sales_qty", grams.cast("decimal(18,2)"))
    result = {}
    for shape, sales in shapes.items():
        sales.drop("copy").repartition(32).write.parquet(f"{root}/{shape}")
        result[shape] = {**stored, "sales": spark.read.parquet(f"{root}/{shape}")}
    return result


def compare(spark: SparkSession, sf_dir: str, runs: int) -> dict[str, float]:
    """Inventory is shuffled, as it would be at full size; only the calendar is not."""
    shapes = _stored(spark, sf_dir, int(os.environ.get("BENCH_COPIES", "16")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100KB")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "100KB")
    times = {}
    for shape, tables in shapes.items():
        plans = {
            "folded": daily.kpi_daily(**tables),
            "sale_by_sale": sale_by_sale(**tables),
            "identity_windows": sale_by_sale(**tables, identity_windows=True),
        }
        for name, df in plans.items():
            times[f"{shape}_{name}"] = _time(lambda df=df: df, runs)
    return times


def _time(query: Callable[[], DataFrame], runs: int) -> float:
    seconds = []
    for _ in range(runs + 1):
        began = time.perf_counter()
        query().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - began)
    return round(statistics.median(seconds[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    if "--compare" in sys.argv:
        times = compare(spark, sf_dir, runs)
    else:
        queries = headline(spark, stored_tables(spark, sf_dir))
        _time(queries["kpi_daily"], 1)  # let the JVM compile first
        times = {name: _time(queries[name], runs) for name in sys.argv[1:] or queries}
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
