"""Typed schemas of the five warehouse tables and of the KPI result.

Keys are 64-bit; money and quantities are decimal(18,2).  Every column may be
NULL except ``calendar.cal_dt``.
"""

from __future__ import annotations

from pyspark.sql import types as T

_KEY, _INT, _DATE, _BOOL = T.LongType(), T.IntegerType(), T.DateType(), T.BooleanType()
_MONEY = T.DecimalType(18, 2)
_SIZE, _DEGREES = T.DecimalType(19, 3), T.DecimalType(19, 6)


def _text(cap: int | None = None) -> tuple[T.DataType, dict]:
    """Text with its documented length noted, not enforced."""
    return T.StringType(), {"max_length": cap} if cap else {}


def _schema(required: tuple[str, ...] = (), **columns) -> T.StructType:
    fields = []
    for name, kind in columns.items():
        kind, metadata = kind if isinstance(kind, tuple) else (kind, {})
        fields.append(T.StructField(name, kind, name not in required, metadata))
    return T.StructType(fields)


# Column names, order, types and text lengths of the source tables.
STORE = _schema(
    store_key=_KEY,
    store_num=_text(30),
    store_desc=_text(150),
    addr=_text(500),
    city=_text(50),
    region=_text(100),
    cntry_cd=_text(30),
    cntry_nm=_text(150),
    postal_zip_cd=_text(10),
    prov_state_desc=_text(30),
    prov_state_cd=_text(30),
    store_type_cd=_text(30),
    store_type_desc=_text(150),
    frnchs_flg=_BOOL,
    store_size=_SIZE,
    market_key=_KEY,
    market_name=_text(150),
    submarket_key=_KEY,
    submarket_name=_text(150),
    latitude=_DEGREES,
    longitude=_DEGREES,
)

SALES = _schema(
    trans_id=_KEY,
    prod_key=_KEY,
    store_key=_KEY,
    trans_dt=_DATE,
    trans_time=_INT,
    sales_qty=_MONEY,
    sales_price=_MONEY,
    sales_amt=_MONEY,
    discount=_MONEY,
    sales_cost=_MONEY,
    sales_mgrn=_MONEY,
    ship_cost=_MONEY,
)

CALENDAR = _schema(
    required=("cal_dt",),
    cal_dt=_DATE,
    cal_type_desc=_text(20),
    day_of_wk_num=_text(30),
    day_of_wk_desc=_text(),
    yr_num=_INT,
    wk_num=_INT,
    yr_wk_num=_INT,
    mnth_num=_INT,
    yr_mnth_num=_INT,
    qtr_num=_INT,
    yr_qtr_num=_INT,
)

PRODUCT = _schema(
    prod_key=_KEY,
    prod_name=_text(),
    vol=_MONEY,
    wgt=_MONEY,
    brand_name=_text(),
    status_code=_INT,
    status_code_name=_text(),
    category_key=_KEY,
    category_name=_text(),
    subcategory_key=_KEY,
    subcategory_name=_text(),
)

INVENTORY = _schema(
    cal_dt=_DATE,
    store_key=_KEY,
    prod_key=_KEY,
    inventory_on_hand_qty=_MONEY,
    inventory_on_order_qty=_MONEY,
    out_of_stock_flg=_INT,
    waste_qty=_MONEY,
    promotion_flg=_BOOL,
    next_delivery_dt=_DATE,
)

TABLES: dict[str, T.StructType] = {
    "calendar": CALENDAR,
    "inventory": INVENTORY,
    "product": PRODUCT,
    "sales": SALES,
    "store": STORE,
}

# Facts carry a date; a snapshot taken on a run date keeps rows up to that date.
SNAPSHOT_DATE = {"sales": "trans_dt", "inventory": "cal_dt"}

INVENTORY_KEY = ("cal_dt", "store_key", "prod_key")

# Keys that must not repeat; a load refuses tables in which they do.
UNIQUE_KEYS = {
    "calendar": ("cal_dt",),
    "inventory": INVENTORY_KEY,
    "product": ("prod_key",),
    "store": ("store_key",),
}

# The published columns, in their order.
KPI_COLUMNS = (
    "yr_wk_num",
    "trans_dt",
    "store_key",
    "prod_key",
    "week_end_stock_on_hand",
    "week_end_ordered_stock",
    "sum_sales_qty",
    "sum_sales_amt",
    "avg_sales_price",
    "sum_sales_cost",
    "total_low_stock_impact",
    "potential_low_stock_impact",
    "no_stock_impact",
    "low_stock_instances",
    "no_stock_instances",
    "week_supply_stock",
    "last_week_sales",
    "week_over_week_growth",
    "stock_turnover_rate",
)
