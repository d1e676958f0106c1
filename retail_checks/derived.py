"""Retail tables derived from the given test tables, in Spark and in SQL.

Both sides use the same integer arithmetic, row for row.  Product and store keys
are folded to few values so that one day, store and product has several sales;
stock leaves out some keys so that the left join has misses, and some sales are
zero so that every division guard is met.  All rows of the given tables are used.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleworks.functions import MONEY
from aisleworks.operators.readiness import REQUIRED
from aisleworks.schemas import TABLES

EPOCH = "1995-01-01"
CALENDAR_END = "2001-12-31"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem")


def _days(day: Column) -> Column:
    return F.datediff(day, F.to_date(F.lit(EPOCH))).cast("bigint")


def _dec(text: str) -> Column:
    return F.lit(Decimal(text))


def _shaped(df: DataFrame, table: str) -> DataFrame:
    """Columns in schema order and type."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[table].fields])


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, quantity, price = F.col("l_orderkey"), F.col("l_quantity"), F.col("l_extendedprice")
    no_sale = order % 97 == 0
    unit_price = (price / F.nullif(quantity, F.lit(0.0))).cast("decimal(38,10)")
    return _shaped(
        _lines(spark, sf_dir)
        .withColumns(
            {
                "trans_id": order * 10 + F.col("l_linenumber"),
                "prod_key": F.col("l_partkey") % 10,
                "store_key": F.col("l_suppkey") % 5,
                "trans_dt": F.col("l_shipdate").cast("date"),
                "trans_time": (order * 7919 + F.col("l_linenumber")) % 86400,
                "sales_qty": F.when(no_sale, F.lit(0)).otherwise(quantity).cast(MONEY),
                "sales_price": F.round(unit_price, 2).cast(MONEY),
                "sales_amt": F.when(no_sale, F.lit(0)).otherwise(price).cast(MONEY),
                "sales_cost": (price.cast(MONEY) * _dec("0.70")).cast(MONEY),
            }
        )
        .withColumns(
            {
                "discount": (F.col("sales_amt") * F.col("l_discount").cast(MONEY)).cast(MONEY),
                "sales_mgrn": F.col("sales_amt") - F.col("sales_cost"),
                "ship_cost": (_dec("1.00") + _dec("0.10") * F.col("sales_qty")).cast(MONEY),
            }
        ),
        "sales",
    )


def stock_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock keys as delivered, one per sale line, so most keys come repeatedly."""
    return _lines(spark, sf_dir).select(
        F.col("l_shipdate").cast("date").alias("cal_dt"),
        (F.col("l_suppkey") % 5).alias("store_key"),
        (F.col("l_partkey") % 10).alias("prod_key"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, store_key, prod_key = _days(F.col("cal_dt")), F.col("store_key"), F.col("prod_key")
    on_hand = (((day * 7 + store_key * 13 + prod_key * 31) % 61) * _dec("0.5")).cast(MONEY)
    return _shaped(
        stock_feed(spark, sf_dir)
        .distinct()
        .where((day + store_key * 3 + prod_key * 7) % 11 != 0)
        .withColumns(
            {
                "inventory_on_hand_qty": on_hand,
                "inventory_on_order_qty": (day * 3 + store_key * 5 + prod_key * 11) % 23,
                "out_of_stock_flg": F.when(on_hand == 0, 1).otherwise(0),
                "waste_qty": (day % 3) * _dec("0.25"),
                "promotion_flg": day % 7 == 0,
                "next_delivery_dt": F.date_add("cal_dt", ((day % 5) + 1).cast("int")),
            }
        ),
        "inventory",
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("cal_dt")
    dates = spark.range(1).select(
        F.explode(
            F.sequence(F.to_date(F.lit(EPOCH)), F.to_date(F.lit(CALENDAR_END)))
        ).alias("cal_dt")
    )
    return _shaped(
        dates.where(_days(day) % 101 != 0).withColumns(
            {
                "cal_type_desc": F.lit("ISO"),
                "day_of_wk_num": (F.weekday(day) + 1).cast("string"),
                "day_of_wk_desc": F.date_format(day, "EEEE"),
                "yr_num": F.year(day),
                "wk_num": F.weekofyear(day),
                "yr_wk_num": F.extract(F.lit("yearofweek"), day) * 100 + F.weekofyear(day),
                "mnth_num": F.month(day),
                "yr_mnth_num": F.year(day) * 100 + F.month(day),
                "qtr_num": F.quarter(day),
                "yr_qtr_num": F.year(day) * 100 + F.quarter(day),
            }
        ),
        "calendar",
    )


def sales_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar days that have sales."""
    traded = business_days(spark, sf_dir).withColumnRenamed("business_date", "cal_dt")
    return calendar(spark, sf_dir).join(traded, "cal_dt", "left_semi")


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Includes quotes, commas, outer blanks, empty text and NULL on purpose."""
    key, name = F.col("r_regionkey"), F.col("r_name")
    text = key.cast("string")
    return _shaped(
        _table(spark, sf_dir, "region").withColumns(
            {
                "store_key": key,
                "store_num": F.concat(F.lit("S"), F.lpad(text, 3, "0")),
                "store_desc": F.concat(F.lit("  "), name, F.lit(" store ")),
                "addr": F.concat(text, F.lit(' Main St, "Unit '), text, F.lit('"')),
                "city": F.concat(name, F.lit(" City")),
                "region": name,
                "cntry_cd": F.concat(F.lit("C"), text),
                "cntry_nm": name,
                "postal_zip_cd": F.lpad((key * 1111).cast("string"), 5, "0"),
                "prov_state_desc": F.lit(None).cast("string"),
                "prov_state_cd": F.lit(""),
                "store_type_cd": F.concat(F.lit("T"), (key % 2).cast("string")),
                "store_type_desc": F.concat(F.lit("back\\slash "), (key % 2).cast("string")),
                "frnchs_flg": key % 2 == 1,
                "store_size": (key + 1) * _dec("1250.125"),
                "market_key": key % 2,
                "market_name": F.concat(F.lit("Market "), (key % 2).cast("string")),
                "submarket_key": key % 3,
                "submarket_name": F.concat(F.lit("Submarket "), (key % 3).cast("string")),
                "latitude": key + _dec("40.123456"),
                "longitude": _dec("-75.500000") - key,
            }
        ),
        "store",
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return _shaped(
        _table(spark, sf_dir, "part").withColumns(
            {
                "prod_key": key,
                "prod_name": F.col("p_name"),
                "vol": F.col("p_size"),
                "wgt": F.col("p_size") * _dec("0.25"),
                "brand_name": F.col("p_brand"),
                "status_code": key % 2,
                "status_code_name": F.when(key % 2 == 0, "active").otherwise("retired"),
                "category_key": key % 3,
                "category_name": F.col("p_type"),
                "subcategory_key": key % 7,
                "subcategory_name": F.concat(F.lit("Sub "), (key % 7).cast("string")),
            }
        ),
        "product",
    )


def all_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: globals()[name](spark, sf_dir) for name in REQUIRED}


def kpi_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: globals()[name](spark, sf_dir) for name in ("sales", "calendar", "inventory")}


def business_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day with sales."""
    day = F.col("l_shipdate").cast("date").alias("business_date")
    return _table(spark, sf_dir, "lineitem").select(day).distinct()


def listing(required: DataFrame, root: str) -> DataFrame:
    """A file listing: every thirteenth required file is absent and every seventeenth is half written.

    Files that are there have two parts; finished ones have a manifest besides.
    """
    index = F.array_position(F.array(*[F.lit(t) for t in REQUIRED]), F.col("table_name")) - 1
    days = _days(F.col("business_date"))
    gone, half = (days * 7 + index * 3) % 13 == 0, (days * 5 + index) % 17 == 0
    data = F.concat(F.lit(f"{root}/"), "file_name")
    manifest = F.concat(F.regexp_replace(data, r"csv$", "manifest"), F.lit("/part-00000.json"))
    parts = [F.concat(data, F.lit(f"/part-{k}.csv")) for k in range(2)]
    return required.where(~gone).select(
        F.explode(F.when(half, F.array(*parts)).otherwise(F.array(*parts, manifest))).alias("path")
    )


def arrivals(required: DataFrame) -> DataFrame:
    """When each required file is seen, up to 29 hours into its date; every thirteenth never is."""
    index = F.array_position(F.array(*[F.lit(t) for t in REQUIRED]), F.col("table_name")) - 1
    days = _days(F.col("business_date"))
    hours = (days * 11 + index * 5) % 30
    return required.where((days * 7 + index * 3) % 13 != 0).select(
        "business_date", "table_name",
        F.timestamp_seconds(F.unix_date("business_date").cast("long") * 86400 + hours * 3600).alias("seen_at"),
    )


# The same tables as DuckDB common table expressions.

_DN = f"date_diff('day', DATE '{EPOCH}', {{day}})"



_DEC = "DECIMAL(18,2)"
_AMT = f"CAST(CASE WHEN l_orderkey % 97 = 0 THEN 0 ELSE l_extendedprice END AS {_DEC})"
_QTY = f"CAST(CASE WHEN l_orderkey % 97 = 0 THEN 0 ELSE l_quantity END AS {_DEC})"
_COST = f"CAST(CAST(l_extendedprice AS {_DEC}) * 0.70 AS {_DEC})"
_UNIT = "ROUND(CAST(l_extendedprice / NULLIF(l_quantity, 0) AS DECIMAL(38,10)), 2)"
_INV_DN = _DN.format(day="cal_dt")
_ON_HAND = f"CAST((({_INV_DN} * 7 + store_key * 13 + prod_key * 31) % 61) * 0.5 AS {_DEC})"

SQL_TABLES: dict[str, str] = {
    "sales": f"""
        SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS trans_id,
               CAST(l_partkey % 10 AS BIGINT) AS prod_key,
               CAST(l_suppkey % 5 AS BIGINT) AS store_key,
               CAST(l_shipdate AS DATE) AS trans_dt,
               CAST((l_orderkey * 7919 + l_linenumber) % 86400 AS INTEGER) AS trans_time,
               {_QTY} AS sales_qty,
               CAST({_UNIT} AS {_DEC}) AS sales_price,
               {_AMT} AS sales_amt,
               CAST({_AMT} * CAST(l_discount AS {_DEC}) AS {_DEC}) AS discount,
               {_COST} AS sales_cost,
               CAST({_AMT} - {_COST} AS {_DEC}) AS sales_mgrn,
               CAST(1.00 + 0.10 * {_QTY} AS {_DEC}) AS ship_cost
        FROM lineitem""",
    "stock_feed": """
        SELECT CAST(l_shipdate AS DATE) AS cal_dt,
               CAST(l_suppkey % 5 AS BIGINT) AS store_key,
               CAST(l_partkey % 10 AS BIGINT) AS prod_key
        FROM lineitem""",
    "inventory": f"""
        SELECT cal_dt, store_key, prod_key,
               {_ON_HAND} AS inventory_on_hand_qty,
               CAST(({_INV_DN} * 3 + store_key * 5 + prod_key * 11) % 23 AS {_DEC})
                   AS inventory_on_order_qty,
               CAST(CASE WHEN {_ON_HAND} = 0 THEN 1 ELSE 0 END AS INTEGER) AS out_of_stock_flg,
               CAST(({_INV_DN} % 3) * 0.25 AS {_DEC}) AS waste_qty,
               {_INV_DN} % 7 = 0 AS promotion_flg,
               CAST(cal_dt + CAST({_INV_DN} % 5 + 1 AS INTEGER) AS DATE) AS next_delivery_dt
        FROM (SELECT DISTINCT * FROM stock_feed)
        WHERE ({_INV_DN} + store_key * 3 + prod_key * 7) % 11 <> 0""",
    "calendar": f"""
        SELECT cal_dt, 'ISO' AS cal_type_desc,
               CAST(isodow(cal_dt) AS VARCHAR) AS day_of_wk_num,
               dayname(cal_dt) AS day_of_wk_desc,
               CAST(year(cal_dt) AS INTEGER) AS yr_num,
               CAST(week(cal_dt) AS INTEGER) AS wk_num,
               CAST(isoyear(cal_dt) * 100 + week(cal_dt) AS INTEGER) AS yr_wk_num,
               CAST(month(cal_dt) AS INTEGER) AS mnth_num,
               CAST(year(cal_dt) * 100 + month(cal_dt) AS INTEGER) AS yr_mnth_num,
               CAST(quarter(cal_dt) AS INTEGER) AS qtr_num,
               CAST(year(cal_dt) * 100 + quarter(cal_dt) AS INTEGER) AS yr_qtr_num
        FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '{EPOCH}', TIMESTAMP '{CALENDAR_END}',
                                                 INTERVAL 1 DAY)) AS DATE) AS cal_dt)
        WHERE {_INV_DN} % 101 <> 0""",
    "sales_calendar": """
        SELECT * FROM calendar WHERE cal_dt IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)""",
    "store": """
        SELECT CAST(r_regionkey AS BIGINT) AS store_key,
               'S' || lpad(CAST(r_regionkey AS VARCHAR), 3, '0') AS store_num,
               '  ' || r_name || ' store ' AS store_desc,
               r_regionkey || ' Main St, "Unit ' || r_regionkey || '"' AS addr,
               r_name || ' City' AS city, r_name AS region,
               'C' || r_regionkey AS cntry_cd, r_name AS cntry_nm,
               lpad(CAST(r_regionkey * 1111 AS VARCHAR), 5, '0') AS postal_zip_cd,
               CAST(NULL AS VARCHAR) AS prov_state_desc, '' AS prov_state_cd,
               'T' || (r_regionkey % 2) AS store_type_cd,
               'back\\slash ' || (r_regionkey % 2) AS store_type_desc,
               r_regionkey % 2 = 1 AS frnchs_flg,
               CAST((r_regionkey + 1) * 1250.125 AS DECIMAL(19,3)) AS store_size,
               CAST(r_regionkey % 2 AS BIGINT) AS market_key,
               'Market ' || (r_regionkey % 2) AS market_name,
               CAST(r_regionkey % 3 AS BIGINT) AS submarket_key,
               'Submarket ' || (r_regionkey % 3) AS submarket_name,
               CAST(r_regionkey + 40.123456 AS DECIMAL(19,6)) AS latitude,
               CAST(-75.500000 - r_regionkey AS DECIMAL(19,6)) AS longitude
        FROM region""",
    "product": f"""
        SELECT CAST(p_partkey AS BIGINT) AS prod_key, p_name AS prod_name,
               CAST(p_size AS {_DEC}) AS vol, CAST(p_size * 0.25 AS {_DEC}) AS wgt,
               p_brand AS brand_name, CAST(p_partkey % 2 AS INTEGER) AS status_code,
               CASE WHEN p_partkey % 2 = 0 THEN 'active' ELSE 'retired' END AS status_code_name,
               CAST(p_partkey % 3 AS BIGINT) AS category_key, p_type AS category_name,
               CAST(p_partkey % 7 AS BIGINT) AS subcategory_key,
               'Sub ' || (p_partkey % 7) AS subcategory_name
        FROM part""",
    "business_days": """
        SELECT DISTINCT CAST(l_shipdate AS DATE) AS business_date FROM lineitem""",
    "required": """
        SELECT business_date, table_name,
               table_name || '_' || strftime(business_date, '%Y-%m-%d') || '.csv' AS file_name
        FROM (SELECT business_date,
                     unnest(['calendar', 'inventory', 'product', 'sales', 'store']) AS table_name
              FROM business_days)""",
    "seen": f"""
        SELECT business_date, table_name,
               ({_DN.format(day="business_date")} * 7 + idx * 3) % 13 = 0 AS gone,
               ({_DN.format(day="business_date")} * 11 + idx * 5) % 30 AS hours
        FROM required
        JOIN (VALUES ('calendar', 0), ('inventory', 1), ('product', 2), ('sales', 3),
                     ('store', 4)) AS i(name, idx) ON name = table_name""",
    "listed": f"""
        SELECT file_name, business_date, table_name FROM required
        JOIN (VALUES ('calendar', 0), ('inventory', 1), ('product', 2), ('sales', 3),
                     ('store', 4)) AS i(name, idx) ON name = table_name
        WHERE ({_DN.format(day="business_date")} * 7 + idx * 3) % 13 <> 0
          AND ({_DN.format(day="business_date")} * 5 + idx) % 17 <> 0""",
}
