"""Whole-result properties and brute force in plain Python."""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aisleworks.functions import ratio2
from aisleworks.operators.joins import join_calendar, join_inventory
from aisleworks.plans import kpi_agg, kpi_daily, kpi_weekly
from retail_checks import derived
from tests.conftest import dec, days

SF = "/root/testdata/sf0.001"


def sum_or_null(values):
    values = [v for v in values if v is not None]
    return sum(values) if values else None


def brute_force_agg(sales, stock, calendar_days):
    """Sale by sale, with SQL's NULL rules spelled out."""
    by_key = defaultdict(list)
    for day, on_hand, on_order, out in stock:
        by_key[day].append((dec(on_hand), dec(on_order), out))
    groups = defaultdict(list)
    for day, qty, amt, price, cost in sales:
        if day in calendar_days:
            for on_hand, on_order, out in by_key.get(day, [(None, None, None)]):
                groups[day, on_hand, on_order].append(
                    (dec(qty), dec(amt), dec(price), dec(cost), on_hand, out)
                )
    result = {}
    for (day, on_hand, on_order), rows in groups.items():
        beyond, lows, both, outs, no_stock = [], [], [], [], []
        for qty, amt, price, _, hand, out in rows:
            low = int(hand is not None and qty is not None and hand < qty)
            lows.append(low)
            outs.append(out)
            both.append(None if out is None else low + out)
            no_stock.append(amt if out == 1 else 0)
            if not low:
                beyond.append(0)
            else:
                beyond.append(None if amt is None or price is None else amt - hand * price)
        total = sum_or_null(beyond)
        result[day, on_hand, on_order] = (
            sum_or_null(r[0] for r in rows),
            sum_or_null(r[1] for r in rows),
            sum_or_null(r[3] for r in rows),
            sum_or_null(both),
            None if total is None
            else Decimal(total).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP),
            sum_or_null(no_stock),
            sum(lows),
            sum_or_null(outs),
        )
    return result


@pytest.mark.parametrize("seed", range(4))
def test_fold_equals_brute_force_with_nulls_everywhere(shop, seed):
    rng = random.Random(seed)
    span = days(6)

    def maybe(value, chance=0.25):
        return None if rng.random() < chance else value

    sales = [
        (
            rng.choice(span),
            maybe(rng.choice([0, 1, 2, "2.50", 7, -1])),
            maybe(rng.choice(["0.00", "3.10", "19.99", "-4.05"])),
            maybe(rng.choice(["0.01", "0.33", "5.55"])),
            maybe(rng.choice(["1.00", "2.22"])),
        )
        for _ in range(150)
    ]
    stock = [
        (d, maybe(rng.choice(["0.00", "0.50", "1.25", 3])), maybe(4), maybe(rng.choice([0, 1])))
        for d in span[:-1]
        # A repeated key must multiply sales in the same way on both sides.
        for _ in range(2 if d == span[0] else 1)
    ]
    got = {
        (r.trans_dt, r.week_end_stock_on_hand, r.week_end_ordered_stock): (
            r.sum_sales_qty, r.sum_sales_amt, r.sum_sales_cost, r.total_low_stock_impact,
            r.potential_low_stock_impact, r.no_stock_impact, r.low_stock_instances,
            r.no_stock_instances,
        )
        for r in kpi_agg(
            shop.sales(*sales), shop.calendar(*span[1:], span[0]), shop.stock(*stock)
        ).collect()
    }
    assert got == brute_force_agg(sales, stock, set(span))


def test_one_row_per_group_and_sales_are_conserved(spark):
    tables = derived.kpi_tables(spark, SF)
    kpis = kpi_daily(**tables)
    joined = join_calendar(tables["sales"], tables["calendar"])
    keys = ["trans_dt", "store_key", "prod_key"]
    assert kpis.count() == joined.select(keys).distinct().count()
    want = joined.agg(F.sum("sales_amt"), F.sum("sales_qty"), F.sum("sales_cost")).first()
    got = kpis.agg(F.sum("sum_sales_amt"), F.sum("sum_sales_qty"), F.sum("sum_sales_cost")).first()
    assert tuple(got) == tuple(want)


def test_result_ignores_row_order_and_partition_count(spark, conf):
    tables = derived.kpi_tables(spark, SF)
    want = sorted(map(tuple, kpi_daily(**tables).collect()), key=repr)
    conf(shuffle__partitions=3, autoBroadcastJoinThreshold=-1)
    mixed = {name: df.orderBy(F.rand(7)).repartition(5) for name, df in tables.items()}
    assert sorted(map(tuple, kpi_daily(**mixed).collect()), key=repr) == want


def test_last_value_up_to_the_current_row_is_the_rows_own(spark):
    tables = derived.kpi_tables(spark, SF)
    rows = join_inventory(join_calendar(tables["sales"], tables["calendar"]), tables["inventory"])
    upto = (Window.unboundedPreceding, Window.currentRow)
    day = Window.partitionBy("trans_dt", "store_key", "prod_key").orderBy("yr_wk_num")
    week = Window.partitionBy("yr_wk_num", "store_key", "prod_key").orderBy("yr_wk_num")
    on_hand, on_order = F.col("inventory_on_hand_qty"), F.col("inventory_on_order_qty")
    windowed = rows.withColumns(
        {
            "last_hand": F.last(on_hand).over(day.rowsBetween(*upto)),
            "last_order": F.last(on_order).over(week.rowsBetween(*upto)),
        }
    )
    same = F.col("last_hand").eqNullSafe(on_hand) & F.col("last_order").eqNullSafe(on_order)
    assert windowed.where(~same).count() == 0


def test_weeks_add_up_to_the_days(spark):
    tables = derived.kpi_tables(spark, SF)
    sums = [F.sum(c) for c in ("sum_sales_amt", "sum_sales_cost", "low_stock_instances")]
    assert tuple(kpi_weekly(**tables).agg(*sums).first()) == tuple(
        kpi_daily(**tables).agg(*sums).first()
    )


def test_ratio_rounds_exact_halves_up_and_near_halves_down(spark):
    cases = [
        ("1.00", "8.00", "0.13"),  # 0.125
        ("-1.00", "8.00", "-0.13"),
        ("2.01", "2.00", "1.01"),  # 1.005
        # A hair below half: a quotient kept to ten decimals would round up.
        ("1249999999999.99", "9999999999999.99", "0.12"),
        ("5.00", "0.00", None),
        (None, "2.00", None),
    ]
    rows = spark.createDataFrame(
        [(dec(n), dec(d), dec(w)) for n, d, w in cases],
        "num decimal(18,2), den decimal(18,2), want decimal(18,2)",
    )
    done = rows.withColumn("got", ratio2(F.col("num"), F.col("den"))).collect()
    assert [(r.got, r.want) for r in done] == [(dec(w), dec(w)) for _, _, w in cases]


def test_ratio_equals_exact_decimal_arithmetic(spark):
    """Random operands, many of them built to fall on or next to a half."""
    rng = random.Random(11)
    cases = []
    for _ in range(20_000):
        den = rng.choice([rng.randint(1, 500), rng.randint(1, 10**9), rng.randint(1, 10**15)])
        half = den * (2 * rng.randint(0, 10**4) + 1) // 200
        num = rng.choice([half, half + 1, half - 1, rng.randint(-(10**12), 10**12)])
        sign = rng.choice([1, -1])
        want = (Decimal(abs(num)) / Decimal(den)) if num else Decimal(0)
        exact = (2 * 100 * abs(num) + den) // (2 * den)  # half up, in whole hundredths
        assert abs(want * 100 - exact) <= Decimal("0.51")
        negative = (num < 0) != (sign < 0)
        cases.append(
            (Decimal(num * sign).scaleb(-2), Decimal(den).scaleb(-2),
             Decimal(-exact if negative else exact).scaleb(-2))
        )
    rows = spark.createDataFrame(
        cases, "num decimal(18,2), den decimal(18,2), want decimal(18,2)"
    )
    wrong = rows.where(~ratio2(F.col("num"), F.col("den")).eqNullSafe(F.col("want")))
    assert wrong.collect() == []


def test_cents_round_trip(spark):
    from aisleworks.functions import from_cents, to_cents

    values = ["0.00", "-0.01", "9999999999999999.99", "-9999999999999999.99", "12.30"]
    rows = spark.createDataFrame([(dec(v),) for v in values], "v decimal(18,2)")
    back = rows.select("v", from_cents(to_cents(F.col("v")).cast("decimal(20,0)")).alias("b"))
    assert all(r.v == r.b for r in back.collect())
