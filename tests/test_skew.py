"""One key holding a third of all rows, and groups larger than a task's share."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from aisleworks.operators.aggregates import sales_by_quantity
from aisleworks.operators.joins import join_calendar
from aisleworks.plans import kpi_agg, week_out_of_stock_running
from retail_checks import derived
from tests.conftest import DAY, days

SF = "/root/testdata/sf0.01"


@pytest.fixture
def skewed(spark):
    """A third of all sales on one day, in one store, of one product."""
    tables = derived.kpi_tables(spark, SF)
    hot = F.col("trans_id") % 3 == 0
    tables["sales"] = tables["sales"].withColumns(
        {
            "trans_dt": F.when(hot, F.lit("1998-09-02").cast("date")).otherwise(F.col("trans_dt")),
            "store_key": F.when(hot, F.lit(1)).otherwise(F.col("store_key")),
            "prod_key": F.when(hot, F.lit(1)).otherwise(F.col("prod_key")),
        }
    )
    return tables


def test_hot_key_shrinks_to_its_quantities(skewed):
    dated = join_calendar(skewed["sales"], skewed["calendar"])
    on_key = (F.col("trans_dt") == "1998-09-02") & (F.col("store_key") == 1) & (
        F.col("prod_key") == 1
    )
    assert dated.where(on_key).count() > 15_000
    assert sales_by_quantity(dated).where(on_key).count() <= 51


def test_hot_key_gives_the_same_kpis_as_single_sales(skewed):
    from bench import sale_by_sale

    columns = ["trans_dt", "store_key", "prod_key", "sum_sales_qty", "sum_sales_amt",
               "sum_sales_cost", "total_low_stock_impact", "potential_low_stock_impact",
               "no_stock_impact", "low_stock_instances", "no_stock_instances"]
    folded = kpi_agg(**skewed).select(columns)
    plain = sale_by_sale(**skewed).select(columns)
    assert folded.exceptAll(plain).count() == 0
    assert plain.exceptAll(folded).count() == 0


def brute_force_running(sales, calendar, inventory):
    """Sale by sale, in order, as a plain loop."""
    weeks = {row.cal_dt: row.yr_wk_num for row in calendar.collect()}
    flags = defaultdict(list)
    for row in inventory.collect():
        flags[row.cal_dt, row.store_key, row.prod_key].append(row.out_of_stock_flg)
    low = lambda row: tuple((v is not None, v) for v in row)  # noqa: E731  NULL first
    groups = defaultdict(list)
    for r in sales.collect():
        if r.trans_dt in weeks:
            sale = (r.trans_dt, r.trans_id, r.sales_qty, r.sales_amt, r.sales_price)
            own = flags.get((r.trans_dt, r.store_key, r.prod_key), [None])
            groups[weeks[r.trans_dt], r.store_key, r.prod_key] += [(*sale, flag) for flag in own]
    out = Counter()
    for group, members in groups.items():
        total = None
        for *sale, flag in sorted(members, key=low):
            total = total if flag is None else (total or 0) + flag
            out[(*group, *sale, total)] += 1
    return out


def running(tables):
    return Counter(tuple(r) for r in week_out_of_stock_running(**tables).collect())


def test_running_total_of_repeated_stock_null_flags_and_ties(shop):
    """Days out of stock, in stock, without stock or flag, with stock rows that repeat and disagree."""
    a, b, c, d = days(4)
    sales = [(day, 1, k % 3, 1, 0, store, 1, k % 7) for day in (a, b, c, d) for store in (1, 2, 3) for k in range(9)]
    sales += [(a, 1, 1, 1, 0, None, 1, 4), (b, 1, 1, 1, 0, None, 1, None), (b, 2, 2, 2, 0, 1, 1, None)]
    stock = [(a, 0, 0, 1, 1, 1), (b, 0, 0, 0, 1, 1), (c, 0, 0, 1, 1, 1), (c, 5, 0, 0, 1, 1), (d, 0, 0, 1, 1, 1),
             (b, 0, 0, None, 2, 1), (c, 0, 0, 1, 2, 1), (c, 0, 0, None, 2, 1), (d, 0, 0, 0, 2, 1), (d, 1, 0, 0, 2, 1)]
    tables = dict(sales=shop.sales(*sales), calendar=shop.calendar(a, b, c, d), inventory=shop.stock(*stock))
    assert running(tables) == brute_force_running(**tables)


def test_running_total_over_a_hot_week(skewed):
    assert running(skewed) == brute_force_running(**skewed)


def test_hot_transaction_is_cut_into_even_ranges(spark, shop):
    """A third of all sales are one transaction, half of them copies of one row; no range is twice the median."""
    from statistics import median

    from aisleworks.operators.prefix import in_ranges
    from aisleworks.plans.daily import week_out_of_stock_running as plan

    one = shop.sales((DAY, 1, 1, 1))
    hot = one.drop("sales_qty").join(spark.range(12_000).select(F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(3).alias("q")))
    hot = hot.withColumn("sales_qty", (F.col("q") % 1000).cast("decimal(18,2)")).select(one.columns)
    rest = one.drop("trans_id").join(spark.range(24_000).select((F.col("id") + 10).alias("trans_id"))).select(one.columns)
    sales = hot.unionByName(rest)
    keys = ["trans_dt", "store_key", "prod_key"]
    ranged = in_ranges(sales, [*keys, "trans_id", "sales_qty"], 40)
    sizes = [row["count"] for row in ranged.groupBy("_range").count().collect()]
    assert len(sizes) == 40 and sum(sizes) == 36_000 and max(sizes) <= 2 * median(sizes)
    ends = ranged.groupBy("_range").agg(F.min(F.struct("trans_id", "sales_qty", "_at")).alias("low"), F.max(F.struct("trans_id", "sales_qty", "_at")).alias("high"))
    ends = sorted((r._range, r.low, r.high) for r in ends.collect())
    assert all(before[2] < after[1] for before, after in zip(ends, ends[1:]))  # ranges of one total order
    got = plan(sales, shop.calendar(DAY), shop.stock((DAY, 0, 0, 1)))
    assert sorted(r.week_out_of_stock for r in got.select("week_out_of_stock").collect()) == list(range(1, 36_001))


def test_scan_needs_no_shuffle_after_its_ranges(spark, shop):
    from aisleworks.operators.prefix import running_sum

    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), "id", F.when(F.col("id") % 5 > 0, 1).alias("v"))
    total = running_sum(rows, ["k"], ["id"], "v", "total", ranges=7)
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("BroadcastExchange") == 3  # one task a range; two for the few sums
    seen, got = defaultdict(int), {(r.k, r.id): r.total for r in total.collect()}
    for i in range(1000):
        seen[i % 3] += bool(i % 5)
        assert got[i % 3, i] == (seen[i % 3] or None)


@pytest.mark.parametrize("ranges", [1, 5, 64])
def test_scan_with_nulls_ties_and_few_rows(spark, ranges):
    from aisleworks.operators.prefix import running_sum

    rows = [(k, o, v) for k in (None, 1, 2) for o in (None, 1, 1, 2) for v in (None, 1, 5)]
    frame = spark.createDataFrame(rows, "k int, o int, v int")
    got = running_sum(frame, ["k"], ["o", "v"], "v", "total", ranges).collect()
    expected = Counter()
    for k in (None, 1, 2):
        total = None
        for _, o, v in sorted((r for r in rows if r[0] == k), key=lambda r: [(x is not None, x or 0) for x in r]):
            total = total if v is None else (total or 0) + v
            expected[k, o, v, total] += 1
    assert Counter(map(tuple, got)) == expected
    assert running_sum(frame.limit(0), ["k"], ["o"], "v", "total", ranges).collect() == []


def unique_quantities(tables):
    """Quantities of two decimals that hardly repeat, as of goods sold by weight."""
    fine = (F.col("sales_qty") + (F.col("trans_id") % 9973) / 100).cast("decimal(18,2)")
    tables["sales"] = tables["sales"].withColumn("sales_qty", fine)
    return tables


@pytest.mark.parametrize("plan", ["daily", "weekly"])
def test_hot_key_with_unique_quantities_is_split(spark, conf, skewed, plan, tmp_path):
    """The stock join splits a third of all sales, though their quantities do not fold."""
    from aisleworks.plans import kpi_daily, kpi_weekly

    tables = unique_quantities(skewed)
    # Every sale six times, so that the hot key is large against the others.
    tables["sales"] = tables["sales"].withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(5)))).withColumn(
        "sales_qty", (F.col("sales_qty") + F.col("copy") / 7).cast("decimal(18,2)")
    ).drop("copy")
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    stored = {name: spark.read.parquet(str(tmp_path / name)) for name in tables}
    conf(shuffle__partitions=16, adaptive__autoBroadcastJoinThreshold=-1, autoBroadcastJoinThreshold=-1,
         adaptive__skewJoin__skewedPartitionThresholdInBytes="64k", adaptive__advisoryPartitionSizeInBytes="64k",
         adaptive__skewJoin__skewedPartitionFactor=2, adaptive__coalescePartitions__enabled="false")
    kpis = (kpi_daily if plan == "daily" else kpi_weekly)(**stored)
    kpis.collect()
    assert "skew=true" in kpis._jdf.queryExecution().executedPlan().toString()


def test_hot_output_date_is_cut_into_several_files(spark, conf, tmp_path):
    from aisleworks.sinks import write_partition

    conf(adaptive__advisoryPartitionSizeInBytes="200KB")
    kpis = spark.range(200_000).select(
        F.lit(DAY).alias("trans_dt"), F.xxhash64("id").alias("noise")
    ).repartition(8)
    assert write_partition(kpis, str(tmp_path), DAY) == 200_000
    assert len(list((tmp_path / f"date={DAY}").rglob("*.parquet"))) > 3
