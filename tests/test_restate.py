"""Restated KPIs equal a full run, and touch no more than they must."""

from __future__ import annotations

import importlib
import random

import pytest
from pyspark.sql import functions as F

from aisleworks.plans import kpi_daily, restate
from aisleworks.plans.restate import changed_groups
from aisleworks.schemas import KPI_COLUMNS
from retail_checks import derived
from tests.conftest import days

restate_module = importlib.import_module("aisleworks.plans.restate")  # the package exports its function by that name

SF = "/root/testdata/sf0.001"


def stored(spark, tmp_path, name, tables):
    found = {}
    for table, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}/{table}")
        found[table] = spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}/{table}")
    return found


def check(spark, tmp_path, before, after, **options):
    before, after = (stored(spark, tmp_path, name, side) for name, side in (("before", before), ("after", after)))
    kpi_daily(**before).write.parquet(f"{tmp_path}/published")
    published = spark.read.parquet(f"{tmp_path}/published")
    got = restate(published, before, after, **options)
    assert tuple(got.columns) == KPI_COLUMNS and got.dtypes == published.dtypes
    want = kpi_daily(**after)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    return got


def shops(shop, rng, all_days):
    """Few sales a pair, so that neighbours lie far apart; some keys NULL, some stock repeated."""
    keys = [(store, prod) for store in (1, 2, None) for prod in (1, 2)]
    sales = [(rng.choice(all_days), rng.randint(0, 3), rng.randint(0, 90), rng.choice([None, 2, 5]), 1, *rng.choice(keys), n)
             for n in range(90)]
    stock = {(day, *key): (day, rng.randint(0, 4), rng.randint(0, 2), rng.choice([0, 1, None]), *key)
             for day in all_days for key in keys if rng.random() < 0.6}
    stock = [*stock.values(), *rng.sample(list(stock.values()), 3)]
    return sales, stock, [day for day in all_days if rng.random() < 0.95]


@pytest.mark.parametrize("seed", range(6))
def test_inserted_changed_and_deleted_rows(spark, shop, tmp_path, seed):
    rng = random.Random(seed)
    all_days = days(40)
    sales, stock, calendar = shops(shop, rng, all_days)
    before = dict(sales=shop.sales(*sales), inventory=shop.stock(*stock), calendar=shop.calendar(*calendar))
    for _ in range(rng.randint(1, 6)):
        kind = rng.choice(["add", "change", "delete", "stock", "unstock"])
        at = rng.randrange(len(sales))
        if kind == "add":
            sales.append((rng.choice(all_days), 1, 7, 2, 1, rng.choice([1, 2, 3, None]), 1, 1000 + at))
        elif kind == "change":
            sales[at] = (*sales[at][:2], sales[at][2] + 1, *sales[at][3:])
        elif kind == "delete":
            del sales[at]
        elif kind == "stock":
            stock.append((rng.choice(all_days), 9, 9, 1, 3, 1))
        else:
            del stock[rng.randrange(len(stock))]
    if seed % 2:
        calendar.remove(rng.choice(calendar))
        moved = rng.choice(calendar)
        after_calendar = shop.calendar(*calendar).withColumn(
            "yr_wk_num", F.when(F.col("cal_dt") == F.lit(moved), F.lit(202099)).otherwise(F.col("yr_wk_num"))
        )
    else:
        after_calendar = shop.calendar(*calendar)
    after = dict(sales=shop.sales(*sales), inventory=shop.stock(*stock), calendar=after_calendar)
    check(spark, tmp_path, before, after, near=1)


def test_nothing_everything_and_only_unused_columns_changed(spark, shop, tmp_path):
    sales, stock, calendar = shops(shop, random.Random(9), days(12))
    tables = dict(sales=shop.sales(*sales), inventory=shop.stock(*stock), calendar=shop.calendar(*calendar))
    none = dict(sales=shop.sales(), inventory=shop.stock(), calendar=shop.calendar())
    other = {**tables, "sales": tables["sales"].withColumn("trans_time", F.lit(7)).withColumn("trans_id", F.lit(1).cast("long"))}
    for n, (before, after) in enumerate([(tables, tables), (tables, none), (none, tables), (tables, other), (none, none)]):
        check(spark, tmp_path / str(n), before, after)


def test_digests_find_the_groups_that_differ(spark):
    def rows(*values):
        return spark.createDataFrame(list(values), "k int, v int")

    before = rows((1, 1), (1, 2), (2, 5), (2, 5), (3, None), (None, 1), (4, 4))
    after = rows((1, 2), (1, 1), (2, 5), (3, 0), (None, 1), (5, 4))
    assert sorted(r.k for r in changed_groups(before, after, ["k"]).collect()) == [2, 3, 4, 5]


@pytest.fixture
def history(spark, tmp_path):
    """All of the test tables as before; after has one day's sales corrected and one pair's deleted there."""
    tables = stored(spark, tmp_path, "before", derived.kpi_tables(spark, SF))
    busy = tables["sales"].groupBy("trans_dt").count().orderBy(F.desc("count"), "trans_dt").first().trans_dt
    on_day = F.col("trans_dt") == F.lit(busy)
    sales = tables["sales"].where(~(on_day & (F.col("prod_key") % 3 == 0))).withColumn(
        "sales_amt", F.when(on_day, (F.col("sales_amt") + 1).cast("decimal(18,2)")).otherwise(F.col("sales_amt"))
    )
    after = {**tables, **stored(spark, tmp_path, "after", {"sales": sales})}
    kpi_daily(**tables).write.parquet(f"{tmp_path}/published")
    return spark.read.parquet(f"{tmp_path}/published"), tables, after, busy


def shuffled_rows(df):
    """Rows written by the shuffles of a plan that has run."""
    total, waiting = 0, [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        metrics = node.metrics()
        if node.nodeName() == "Exchange" and metrics.contains("shuffleRecordsWritten"):
            total += metrics.apply("shuffleRecordsWritten").value()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            waiting.append(node.plan())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return total


def test_rows_of_other_dates_are_not_shuffled(spark, history, monkeypatch, conf):
    published, before, after, busy = history
    conf(autoBroadcastJoinThreshold=-1, adaptive__autoBroadcastJoinThreshold=-1)
    shuffles, label = {}, restate_module._stored

    def counted(df, name):
        from pyspark.sql import DataFrame

        assert isinstance(df, DataFrame)
        rows = df.collect()
        shuffles[name] = shuffles.get(name, 0) + shuffled_rows(df)
        return label(spark.createDataFrame(rows, df.schema), name)

    monkeypatch.setattr(restate_module, "_stored", counted)
    got = restate(published, before, after, near=3)
    got.collect()
    everything = before["sales"].count()
    days_sales = before["sales"].where(F.col("trans_dt") == F.lit(busy)).count()
    assert 0 < shuffles["keys"] <= 4 * days_sales + 10 and 0 < shuffles["fresh"] <= 20 * days_sales
    assert days_sales < everything / 100
    # Only followers' dates and the changed day itself meet a join in the merge.
    total = published.count()
    assert shuffled_rows(got) < total / 3
    want = kpi_daily(**after)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_files_of_two_dates_give_the_same_as_a_whole_run(spark, tmp_path, monkeypatch, capsys):
    from aisleworks import __main__ as cli
    from aisleworks import sinks, sources
    from aisleworks.plans import batch
    from retail_checks.catalog import LAST_DATE, MID_DATE

    monkeypatch.setattr(cli, "build_session", lambda app: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    landing, root = sources.Location(str(tmp_path / "landing")), str(tmp_path / "out")
    for day in (MID_DATE, LAST_DATE):
        sinks.export_snapshot(derived.all_tables(spark, SF), landing, day)
    batch.run(spark, landing, root, MID_DATE)
    monkeypatch.setattr("sys.argv", ["aisleworks", "run", str(LAST_DATE), "--since", str(MID_DATE),
                                     "--landing", landing.root, "--output", root])
    cli.main()
    rows = batch.run(spark, landing, str(tmp_path / "whole"), LAST_DATE)
    assert f"{rows} rows published" in capsys.readouterr().out
    got = sources.read_published(spark, root, [LAST_DATE])
    want = sources.read_published(spark, str(tmp_path / "whole"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
