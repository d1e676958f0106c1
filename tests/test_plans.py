"""What the physical plans must look like."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from aisleworks import schemas, sinks, sources
from aisleworks.operators.joins import join_inventory
from aisleworks.plans import kpi_base, kpi_by_market_category, kpi_daily, kpi_weekly
from retail_checks import derived

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Typed Parquet tables, as the engine would find them."""
    root = tmp_path_factory.mktemp("stored")
    tables = {}
    for name, df in derived.all_tables(spark, SF).items():
        df.write.parquet(f"{root}/{name}")
        tables[name] = spark.read.schema(schemas.TABLES[name]).parquet(f"{root}/{name}")
    return tables


@pytest.fixture
def facts(stored):
    return {name: stored[name] for name in ("sales", "calendar", "inventory")}


@pytest.fixture
def large(conf):
    """Only the calendar is small enough to broadcast."""
    conf(autoBroadcastJoinThreshold="60KB", adaptive__autoBroadcastJoinThreshold="60KB")


def plan(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def count(text, operator):
    return len(re.findall(rf"[-:+ ]{operator}\b", text))


def test_daily_shuffles(facts, large):
    """Fold, both join sides, lag.  The KPI aggregate reuses the join's shuffle."""
    text = plan(kpi_daily(**facts))
    assert count(text, "Exchange") == 4
    assert count(text, "Window") == 1
    assert count(text, "BroadcastHashJoin") == 1 and "Inner, BuildRight" in text
    assert count(text, "SortMergeJoin") == 1 and "LeftOuter" in text


def test_bucketed_inventory_is_not_shuffled(spark, facts, large, tmp_path):
    stock = sources.replace_table(
        facts["inventory"], str(tmp_path / "t"), "stock_in_buckets", 8, schemas.INVENTORY_KEY
    )
    try:
        bucketed = kpi_daily(facts["sales"], facts["calendar"], stock)
        assert count(plan(bucketed), "Exchange") == 3
        assert bucketed.exceptAll(kpi_daily(**facts)).count() == 0
    finally:
        spark.sql("DROP TABLE stock_in_buckets")


def test_sales_are_combined_before_their_first_shuffle(facts, large):
    text = plan(kpi_daily(**facts))
    shuffled = text[: text.index("FileScan")].rsplit("Exchange hashpartitioning", 1)[1]
    assert "sales_qty" in shuffled.split("ENSURE")[0]
    assert "partial_sum" in shuffled


def test_weekly_joins_sales_with_stock_by_day_and_weeks_once(facts, large):
    """The join at day grain can be split at a hot key; the full join sees weeks only."""
    text = plan(kpi_weekly(**facts))
    assert text.count("FullOuter") == 1 and text.count("LeftOuter") == 1
    full = re.search(r"SortMergeJoin \[([^\]]*)\][^\n]*FullOuter", text)[1]
    assert "trans_dt" not in full and "yr_wk_num" in full
    assert len(re.findall(r"Location: \S+ paths\)\[\S*/inventory\]", text)) == 2


def test_no_cross_joins_and_no_python(stored, facts):
    for df in (kpi_daily(**facts), kpi_weekly(**facts), kpi_base(**facts),
               kpi_by_market_category(**stored)):
        text = plan(df)
        assert "Cartesian" not in text and "NestedLoop" not in text
        assert "Python" not in text and "Pandas" not in text


def test_daily_reads_only_the_columns_it_needs(facts):
    schemas_read = re.findall(r"ReadSchema: struct<(.*?)>", plan(kpi_daily(**facts), "formatted"))
    read = [set(re.findall(r"(\w+):", s)) for s in schemas_read]
    assert {"trans_dt", "store_key", "prod_key", "sales_qty", "sales_price", "sales_amt",
            "sales_cost"} in read
    assert {"cal_dt", "yr_wk_num"} in read
    assert not any({"waste_qty", "ship_cost", "trans_time"} & columns for columns in read)


def test_snapshot_date_reaches_the_scan(facts):
    from retail_checks.catalog import MID_DATE

    text = plan(sinks.snapshot(facts["sales"], "sales", MID_DATE))
    assert "LessThanOrEqual(trans_dt,1998-09-02)" in text


def test_whole_run_date_partitions_are_pruned(spark, facts, tmp_path):
    from retail_checks.catalog import LAST_DATE, MID_DATE

    for day in (MID_DATE, LAST_DATE):
        sinks.write_partition(facts["calendar"], str(tmp_path), day, cluster_by="yr_wk_num")
    one = sources.read_published(spark, str(tmp_path)).where(F.col("date") == F.lit(MID_DATE))
    assert re.search(r"PartitionFilters: \[isnotnull\(date.*1998-09-02", plan(one))
    assert len(one.inputFiles()) > 0


def test_output_is_rebalanced_not_hashed_into_fixed_partitions(facts):
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(kpi_daily(**facts).hint("rebalance", "trans_dt"))


def test_dimension_too_large_to_broadcast_is_shuffled(stored, conf):
    conf(autoBroadcastJoinThreshold=-1, adaptive__autoBroadcastJoinThreshold=-1)
    assert "Broadcast" not in plan(kpi_by_market_category(**stored))


def test_hot_row_level_join_is_split_at_run_time(spark, facts, conf):
    """A day, store and product holding most sales is spread over many tasks."""
    conf(
        autoBroadcastJoinThreshold=-1,
        adaptive__autoBroadcastJoinThreshold=-1,
        adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        adaptive__skewJoin__skewedPartitionFactor=2,
        adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    sales = facts["sales"].repartition(16, "trans_id")
    target = facts["inventory"].orderBy("cal_dt", "store_key", "prod_key").first()
    hot = F.col("trans_id") % 3 == 0
    skewed = sales.withColumns(
        {
            "trans_dt": F.when(hot, F.lit(target.cal_dt)).otherwise(F.col("trans_dt")),
            "store_key": F.when(hot, F.lit(target.store_key)).otherwise(F.col("store_key")),
            "prod_key": F.when(hot, F.lit(target.prod_key)).otherwise(F.col("prod_key")),
        }
    )
    joined = join_inventory(skewed, facts["inventory"])
    assert joined.count() == sales.count()
    rows = joined.select("trans_id", "inventory_on_hand_qty")
    rows.collect()
    assert "SortMergeJoin(skew=true)" in rows._jdf.queryExecution().executedPlan().toString()


def test_tie_numbers_follow_a_local_sort(spark):
    """The optimizer must not drop the sort that makes the numbering repeatable."""
    numbered = (
        spark.range(10).repartition(3).sortWithinPartitions("id")
        .withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange("id", "_tie")
    )
    assert "Sort [id" in plan(numbered)
