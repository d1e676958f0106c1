from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from aisleworks import schemas
from aisleworks.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": 8,
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": f"{home}/shared",
            "spark.sql.warehouse.dir": f"{home}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test and put them back afterwards."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, str(value))

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


DAY = dt.date(2020, 1, 6)


def dec(value) -> Decimal | None:
    return None if value is None else Decimal(str(value))


# What short rows leave out: cost, store, product, id; and store, product.
_SALE_REST = (0, 1, 1, 1)
_STOCK_REST = (1, 1)


class Shop:
    """Small hand-written tables; unnamed columns are NULL."""

    def __init__(self, spark):
        self.spark = spark

    def _frame(self, table, rows):
        schema = schemas.TABLES[table]
        return self.spark.createDataFrame(
            [tuple(row.get(name) for name in schema.names) for row in rows], schema
        )

    def sales(self, *rows):
        """(day, quantity, amount, price) and optionally (cost, store, product, id)."""
        full = []
        for row in rows:
            day, qty, amt, price, cost, store, prod, trans = (*row, *_SALE_REST[len(row) - 4:])
            full.append(
                dict(trans_dt=day, sales_qty=dec(qty), sales_amt=dec(amt), sales_price=dec(price),
                     sales_cost=dec(cost), store_key=store, prod_key=prod, trans_id=trans)
            )
        return self._frame("sales", full)

    def stock(self, *rows):
        """(day, on hand, on order, out flag) and optionally (store, product)."""
        full = []
        for row in rows:
            day, on_hand, on_order, out, store, prod = (*row, *_STOCK_REST[len(row) - 4:])
            full.append(
                dict(cal_dt=day, inventory_on_hand_qty=dec(on_hand),
                     inventory_on_order_qty=dec(on_order), out_of_stock_flg=out,
                     store_key=store, prod_key=prod)
            )
        return self._frame("inventory", full)

    def calendar(self, *days):
        return self._frame(
            "calendar",
            [
                dict(cal_dt=d, yr_wk_num=d.isocalendar().year * 100 + d.isocalendar().week)
                for d in days
            ],
        )


@pytest.fixture
def shop(spark):
    return Shop(spark)


def days(n, start=DAY):
    return [start + dt.timedelta(days=i) for i in range(n)]
