"""Loads are proven as they are written, and publish all or nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aisleworks import schemas, sources
from aisleworks.operators.checks import DuplicateKeyError
from aisleworks.sources import RejectBudget, RejectBudgetError, tables
from tests.conftest import DAY, days

NAMES = ",".join(schemas.INVENTORY.names)
REST = "1.00,1.00,0,0.00,1,2020-01-07"


def deliver(tmp_path, *lines, table="inventory", header=NAMES):
    (tmp_path / f"{table}.csv").write_text("\n".join([header, *lines]) + "\n")
    return sources.Location(str(tmp_path))


def rows(*keys):
    return [f"{day},{store},{prod},{REST}" for day, store, prod in keys]


@pytest.fixture
def counted(spark, monkeypatch):
    """How many rows the loads have parsed, over all jobs."""
    parsed = spark.sparkContext.accumulator(0)

    def counting(read):
        def run(*args, **kwargs):
            df = read(*args, **kwargs)

            def through(batches):
                for batch in batches:
                    parsed.add(batch.num_rows)
                    yield batch

            return df.mapInArrow(through, df.schema)

        return run

    monkeypatch.setattr(tables, "read_positional", counting(tables.read_positional))
    monkeypatch.setattr(tables, "marked_rows", counting(tables.marked_rows))
    return parsed


def test_a_load_reads_its_file_once_and_proves_its_key(spark, tmp_path, counted):
    keys = [(day, store, prod) for day in days(10) for store in (1, 2) for prod in (1, 2, "")]
    place, target = deliver(tmp_path, *rows(*keys)), str(tmp_path / "table")
    loaded = sources.load_table(spark, place, "inventory", target)
    assert loaded.count() == 60 and counted.value == 60
    assert sources.read_table(spark, target, schemas.INVENTORY).exceptAll(loaded).count() == 0
    deliver(tmp_path, *rows(*keys, keys[7], (DAY, 1, ""), (DAY, 1, "")))
    with pytest.raises(DuplicateKeyError, match=r"in 3 rows, such as .*2020-01-06"):
        sources.load_table(spark, place, "inventory", target)
    assert counted.value == 60 + 63
    assert sources.read_table(spark, target).count() == 60


def test_named_and_bucketed_tables_keep_the_old_one_too(spark, tmp_path, counted):
    keys = [(day, 1, 1) for day in days(10)]
    place, target = deliver(tmp_path, *rows(*keys)), str(tmp_path / "table")
    options = dict(name="proven_stock", buckets=4, by=["cal_dt", "store_key"])
    try:
        assert sources.load_table(spark, place, "inventory", target, **options).count() == 10
        deliver(tmp_path, *rows(*keys, keys[0]))
        with pytest.raises(DuplicateKeyError):
            sources.load_table(spark, place, "inventory", target, **options)
        assert spark.table("proven_stock").count() == 10
        deliver(tmp_path, *rows(*keys[:3]))
        assert sources.load_table(spark, place, "inventory", target, **options).count() == 3
        assert spark.table("proven_stock").count() == 3 and counted.value == 24
        plan = spark.table("proven_stock").groupBy("cal_dt", "store_key").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.sql("DROP TABLE IF EXISTS proven_stock")
        spark.sql("DROP TABLE IF EXISTS proven_stock__loading")


def test_a_proof_needs_no_second_shuffle(spark, tmp_path):
    place = deliver(tmp_path, *rows((DAY, 1, 1)))
    read = tables.read_positional(spark, place, "inventory", schemas.INVENTORY)
    proven, _ = tables._proven(read, schemas.INVENTORY_KEY)
    assert proven._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_reject_budget_on_both_sides_of_its_limit(spark, tmp_path, counted):
    good = rows(*[(day, 1, 1) for day in days(16)])
    bad = [f"2020-01-06,x,1,{REST}", f"2020-02-31,x,1,{REST}", "2020-03-01,1", f"2020-03-01,1,1,{REST},more"]
    place, target = deliver(tmp_path, *good, *bad), str(tmp_path / "split")
    accepted, rejected = sources.load_with_rejects(spark, place, "inventory", target, budget=RejectBudget(rows=4, share=0.2))
    assert accepted.count() == 16 and rejected.count() == 4 and counted.value == 20
    for budget in (RejectBudget(rows=3), RejectBudget(share=0.19), RejectBudget(rows=3, share=0.9), RejectBudget(rows=0)):
        with pytest.raises(RejectBudgetError, match="4 of 20 rows rejected") as err:
            sources.load_with_rejects(spark, place, "inventory", target, budget=budget)
        assert {rule: n for rule, n in err.value.counts.items() if n} == {"*": 2, "cal_dt": 1, "store_key": 2}
    assert counted.value == 20 * 5
    deliver(tmp_path, *good[:5], *bad, *bad)
    with pytest.raises(RejectBudgetError):
        sources.load_with_rejects(spark, place, "inventory", target, budget=RejectBudget(share=0.5))
    old, old_bad = sources.read_split(spark, "inventory", target)
    assert old.count() == 16 and old_bad.count() == 4
    accepted, rejected = sources.load_with_rejects(spark, place, "inventory", target)  # no budget, no limit
    assert accepted.count() == 5 and rejected.count() == 8
    assert sources.read_split(spark, "inventory", target)[0].count() == 5


def test_repeated_rejects_are_no_repeated_keys(spark, tmp_path):
    bad = [f"2020-01-06,x,1,{REST}"] * 3
    place = deliver(tmp_path, *rows((DAY, 1, 1), (DAY, "", 1)), *bad)
    accepted, rejected = sources.load_with_rejects(spark, place, "inventory", str(tmp_path / "a"))
    assert accepted.count() == 2 and rejected.count() == 3
    deliver(tmp_path, *rows((DAY, "", 1), (DAY, "", 1)), *bad)
    with pytest.raises(DuplicateKeyError):
        sources.load_with_rejects(spark, place, "inventory", str(tmp_path / "a"))
    assert sources.read_split(spark, "inventory", str(tmp_path / "a"))[0].count() == 2


def test_empty_files_and_tables_without_a_key(spark, tmp_path):
    empty = deliver(tmp_path)
    assert sources.load_table(spark, empty, "inventory", str(tmp_path / "t")).count() == 0
    good, bad = sources.load_with_rejects(spark, empty, "inventory", str(tmp_path / "s"), budget=RejectBudget(rows=0, share=0.0))
    assert good.schema == schemas.INVENTORY and good.count() == bad.count() == 0
    names = ",".join(schemas.SALES.names)
    line = "1,1,1,2020-01-06,0,1.00,1.00,1.00,0.00,0.00,0.00,0.00"
    sales = deliver(tmp_path, line, line, table="sales", header=names)
    assert sources.load_table(spark, sales, "sales", str(tmp_path / "u")).count() == 2
    good, bad = sources.load_with_rejects(spark, sales, "sales", str(tmp_path / "v"))
    assert good.count() == 2 and bad.count() == 0
    with pytest.raises(sources.NothingPublishedError):
        sources.read_table(spark, str(tmp_path / "nothing"))
    assert good.select(F.max("sales_qty")).first()[0] == 1
