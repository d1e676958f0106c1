"""DuckDB SQL giving the expected result of each registered query.

Written from the definitions, sale by sale, without the fold by quantity that the
Spark plans use, so the two sides do not share a method.
"""

from __future__ import annotations

from aisleworks.schemas import SALES
from retail_checks.catalog import LANDING, LAST_DATE, MID_DATE
from retail_checks.derived import SQL_TABLES

MONEY = "DECIMAL(18,2)"
TOTAL = "DECIMAL(28,2)"


def _ratio(num: str, den: str) -> str:
    return (
        f"CAST(ROUND(CAST(({num}) / NULLIF({den}, 0) AS DECIMAL(38,10)), 2) AS {MONEY})"
    )


def _with(parts: dict[str, str], select: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items())
    return f"WITH {ctes}\n{select}"


def _tables(*names: str) -> dict[str, str]:
    return {name: SQL_TABLES[name] for name in names}


_FACTS = _tables("sales", "stock_feed", "inventory", "calendar")

_STOCKED = """
    SELECT s.*, i.inventory_on_hand_qty, i.inventory_on_order_qty, i.out_of_stock_flg
    FROM sales s LEFT JOIN inventory i
      ON s.trans_dt = i.cal_dt AND s.store_key = i.store_key AND s.prod_key = i.prod_key"""

_BASE = """
    SELECT yr_wk_num, k.*,
           CAST(inventory_on_hand_qty * sales_price AS DECIMAL(28,4)) AS stock_on_hand_amt,
           CAST(CASE WHEN inventory_on_hand_qty < sales_qty THEN 1 ELSE 0 END AS INTEGER)
               AS low_stock_flg
    FROM stocked k JOIN calendar c ON k.trans_dt = c.cal_dt"""

_KEY = "yr_wk_num, trans_dt, store_key, prod_key"
_STOCK_KEY = f"{_KEY}, week_end_stock_on_hand, week_end_ordered_stock"

_AGG = f"""
    SELECT {_KEY}, inventory_on_hand_qty AS week_end_stock_on_hand,
           inventory_on_order_qty AS week_end_ordered_stock,
           CAST(SUM(sales_qty) AS {TOTAL}) AS sum_sales_qty,
           CAST(SUM(sales_amt) AS {TOTAL}) AS sum_sales_amt,
           CAST(SUM(sales_cost) AS {TOTAL}) AS sum_sales_cost,
           CAST(SUM(low_stock_flg + out_of_stock_flg) AS BIGINT) AS total_low_stock_impact,
           CAST(ROUND(SUM(CASE WHEN low_stock_flg = 1 THEN sales_amt - stock_on_hand_amt
                          ELSE 0 END), 2) AS {TOTAL}) AS potential_low_stock_impact,
           CAST(SUM(CASE WHEN out_of_stock_flg = 1 THEN sales_amt ELSE 0 END) AS {TOTAL})
               AS no_stock_impact,
           CAST(SUM(low_stock_flg) AS BIGINT) AS low_stock_instances,
           CAST(SUM(out_of_stock_flg) AS BIGINT) AS no_stock_instances
    FROM base GROUP BY ALL"""

_DAILY = f"""
    SELECT a.*, {_ratio("sum_sales_amt", "sum_sales_qty")} AS avg_sales_price,
           {_ratio("week_end_stock_on_hand", "sum_sales_qty")} AS week_supply_stock,
           {_ratio("(sum_sales_amt - last_week_sales) * 100", "last_week_sales")}
               AS week_over_week_growth,
           {_ratio("sum_sales_qty", "week_end_stock_on_hand")} AS stock_turnover_rate
    FROM (SELECT *, LAG(sum_sales_amt) OVER (PARTITION BY store_key, prod_key
                                             ORDER BY yr_wk_num, trans_dt) AS last_week_sales
          FROM agg) a"""

_CHAIN = {**_FACTS, "stocked": _STOCKED, "base": _BASE, "agg": _AGG, "daily": _DAILY}


def _known_on(day) -> dict[str, str]:
    """The KPI chain over the snapshot of a run date."""
    chain = dict(_CHAIN)
    chain["sales"] = f"SELECT * FROM ({chain['sales']}) WHERE trans_dt <= DATE '{day}'"
    chain["inventory"] = f"SELECT * FROM ({chain['inventory']}) WHERE cal_dt <= DATE '{day}'"
    # Stock is derived from all sales first, then cut to the date.
    return chain


def _from(table: str, select: str) -> str:
    names = ["sales", "stocked", "base", "agg", "daily"]
    upto = [*_FACTS, *names[1 : names.index(table) + 1]]
    return _with({name: _CHAIN[name] for name in upto}, f"SELECT {select} FROM {table}")


_SALE = "trans_id, trans_dt, store_key, prod_key, sales_qty"


def _published(day) -> str:
    return _with(_known_on(day), f"SELECT *, DATE '{day}' AS date FROM daily")


_WEEK_SALES = f"""
    SELECT yr_wk_num, store_key, prod_key,
           SUM(sales_qty) AS qty, SUM(sales_amt) AS amt, SUM(sales_cost) AS cost,
           SUM(low_stock_flg) AS lows,
           ROUND(SUM(CASE WHEN low_stock_flg = 1 THEN sales_amt - stock_on_hand_amt
                     ELSE 0 END), 2) AS beyond,
           SUM(CASE WHEN out_of_stock_flg = 1 THEN sales_amt ELSE 0 END) AS no_stock
    FROM base GROUP BY ALL"""

_WEEK_STOCK = """
    SELECT yr_wk_num, store_key, prod_key,
           arg_max(inventory_on_hand_qty, i.cal_dt) AS on_hand,
           arg_max(inventory_on_order_qty, i.cal_dt) AS on_order,
           SUM(out_of_stock_flg) AS out_days
    FROM inventory i JOIN calendar c ON i.cal_dt = c.cal_dt GROUP BY ALL"""

_WEEKS = f"""
    SELECT yr_wk_num, store_key, prod_key, on_hand AS week_end_stock_on_hand,
           on_order AS week_end_ordered_stock, CAST(out_days AS BIGINT) AS out_of_stock_days,
           CAST(COALESCE(qty, 0) AS {TOTAL}) AS sum_sales_qty,
           CAST(COALESCE(amt, 0) AS {TOTAL}) AS sum_sales_amt,
           CAST(COALESCE(cost, 0) AS {TOTAL}) AS sum_sales_cost,
           CAST(COALESCE(beyond, 0) AS {TOTAL}) AS potential_low_stock_impact,
           CAST(COALESCE(no_stock, 0) AS {TOTAL}) AS no_stock_impact,
           CAST(COALESCE(lows, 0) AS BIGINT) AS low_stock_instances
    FROM week_sales FULL JOIN week_stock USING (yr_wk_num, store_key, prod_key)"""

_NUMBERED = """
    SELECT w.*, week_idx,
           LAG(sum_sales_amt) OVER p AS prev_amt, LAG(week_idx) OVER p AS prev_idx
    FROM weeks w
    JOIN (SELECT yr_wk_num, row_number() OVER (ORDER BY yr_wk_num) AS week_idx
          FROM (SELECT DISTINCT yr_wk_num FROM calendar)) USING (yr_wk_num)
    WINDOW p AS (PARTITION BY store_key, prod_key ORDER BY week_idx)"""

_WEEKLY = f"""
    SELECT * EXCLUDE (week_idx, prev_amt, prev_idx, lw), lw AS last_week_sales,
           {_ratio("sum_sales_amt", "sum_sales_qty")} AS avg_sales_price,
           {_ratio("week_end_stock_on_hand", "sum_sales_qty")} AS week_supply_stock,
           {_ratio("(sum_sales_amt - lw) * 100", "lw")} AS week_over_week_growth,
           {_ratio("sum_sales_qty", "week_end_stock_on_hand")} AS stock_turnover_rate
    FROM (SELECT *, CASE WHEN prev_idx = week_idx - 1 THEN prev_amt END AS lw FROM numbered)"""

_MARKET = f"""
    SELECT yr_wk_num, market_key, category_key,
           CAST(SUM(sum_sales_qty) AS {TOTAL}) AS sum_sales_qty,
           CAST(SUM(sum_sales_amt) AS {TOTAL}) AS sum_sales_amt,
           CAST(SUM(sum_sales_cost) AS {TOTAL}) AS sum_sales_cost,
           CAST(SUM(potential_low_stock_impact) AS {TOTAL}) AS potential_low_stock_impact,
           CAST(SUM(no_stock_impact) AS {TOTAL}) AS no_stock_impact,
           CAST(SUM(total_low_stock_impact) AS BIGINT) AS total_low_stock_impact,
           CAST(SUM(low_stock_instances) AS BIGINT) AS low_stock_instances,
           CAST(SUM(no_stock_instances) AS BIGINT) AS no_stock_instances,
           {_ratio("SUM(sum_sales_amt)", "SUM(sum_sales_qty)")} AS avg_sales_price
    FROM daily LEFT JOIN store USING (store_key) LEFT JOIN product USING (prod_key) GROUP BY ALL"""

_STATUS = """
    SELECT business_date, CAST(COUNT(l.table_name) AS INTEGER) AS files_arrived,
           COALESCE(string_agg(CASE WHEN l.table_name IS NULL THEN r.table_name END, ','
                               ORDER BY r.table_name), '') AS files_missing,
           COUNT(l.table_name) = 5 AS ready
    FROM required r LEFT JOIN listed l USING (business_date, table_name)
    GROUP BY business_date"""

_GATE = {**_tables("business_days", "required", "listed"), "status": _STATUS}

_PAYLOAD = " || ',' || ".join(
    f"""'"{t}_' || d || '.csv":"{LANDING}/{t}_' || d || '.csv"'"""
    for t in ("calendar", "inventory", "product", "sales", "store")
)

_TEXT_DATE = "strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d')"

_SALES_TEXT = {
    name: f"strftime({name}, '%Y-%m-%d')" if name == "trans_dt" else f"CAST({name} AS VARCHAR)"
    for name in SALES.names
}

_DAMAGED = """
    SELECT *, trans_id % 19 = 0 AS short, trans_id % 19 <> 0 AND trans_id % 29 = 0 AS long,
           trans_id % 19 <> 0 AND trans_id % 29 <> 0 AND trans_id % 23 = 0 AS swapped
    FROM sales"""

_REJECTS = f"""
    SELECT {", ".join(
        f"CASE WHEN swapped THEN 'n/a' ELSE {text} END AS {name}" if name in ("trans_dt", "sales_qty")
        else f"CASE WHEN NOT short THEN {text} END AS {name}" if name == "ship_cost"
        else f"{text} AS {name}"
        for name, text in _SALES_TEXT.items()
    )},
           CASE WHEN short OR long THEN '*' ELSE 'trans_dt,sales_qty' END AS bad_columns,
           CASE WHEN short THEN concat_ws(',', {", ".join(list(_SALES_TEXT.values())[:-1])})
                WHEN long THEN concat_ws(',', {", ".join(_SALES_TEXT.values())}, 'EXTRA 1', 'EXTRA 2')
           END AS raw_line
    FROM damaged WHERE short OR long OR swapped"""


def _snapshot(table: str, dated: str | None = None) -> str:
    needs = {"inventory": ("stock_feed", "inventory")}.get(table, (table,))
    where = f" WHERE {dated} <= DATE '{MID_DATE}'" if dated else ""
    return _with(_tables(*needs), f"SELECT * FROM {table}{where}")


_FILES_BY_MONTH = """
    SELECT strftime(CAST(l_shipdate AS DATE), '%Y-%m-01') AS month,
           COUNT(*) AS rows, true AS whole
    FROM lineitem GROUP BY 1"""


ORACLE: dict[str, str] = {
    "scan_csv_header": _with(_tables("sales"), "SELECT * FROM sales"),
    "load_typed_csv": _with(_tables("sales"), "SELECT * FROM sales"),
    "load_typed_inventory": _with(
        _tables("stock_feed", "inventory"), "SELECT * FROM inventory"
    ),
    "load_typed_calendar": _with(
        _tables("calendar", "sales_calendar"), "SELECT * FROM sales_calendar"
    ),
    "load_typed_store": _with(_tables("store"), "SELECT * FROM store"),
    "load_typed_product": _with(_tables("product"), "SELECT * FROM product"),
    "load_rejects": _with({**_tables("sales"), "damaged": _DAMAGED}, _REJECTS),
    "load_accepted": _with(
        {**_tables("sales"), "damaged": _DAMAGED},
        "SELECT * EXCLUDE (short, long, swapped) FROM damaged WHERE NOT short AND NOT long AND NOT swapped",
    ),
    "load_reject_counts": _with(
        {**_tables("sales"), "damaged": _DAMAGED},
        """SELECT 'rows' AS rule, COUNT(*) AS rows FROM damaged
           UNION ALL SELECT 'rejected', COUNT(*) FROM damaged WHERE short OR long OR swapped
           UNION ALL SELECT '*', COUNT(*) FROM damaged WHERE short OR long
           UNION ALL SELECT 'trans_dt', COUNT(*) FROM damaged WHERE swapped
           UNION ALL SELECT 'sales_qty', COUNT(*) FROM damaged WHERE swapped""",
    ),
    "inventory_key_dupes": _with(
        _tables("stock_feed"),
        """SELECT cal_dt, store_key, prod_key, COUNT(*) AS copies
           FROM stock_feed GROUP BY ALL HAVING COUNT(*) > 1""",
    ),
    "list_files": _FILES_BY_MONTH,
    "list_tree": _FILES_BY_MONTH,
    "export_snapshot": _snapshot("sales", "trans_dt"),
    "export_snapshot_inventory": _snapshot("inventory", "cal_dt"),
    "export_snapshot_calendar": _with(
        _tables("calendar", "sales_calendar"), "SELECT * FROM sales_calendar"
    ),
    "export_snapshot_store": _snapshot("store"),
    "export_snapshot_product": _snapshot("product"),
    "export_audit": _with(
        _tables("sales", "stock_feed", "inventory", "calendar", "store", "product"),
        f"""SELECT 'calendar' AS table_name, COUNT(*) AS rows_unloaded FROM calendar
            UNION ALL SELECT 'inventory', COUNT(*) FROM inventory WHERE cal_dt <= DATE '{MID_DATE}'
            UNION ALL SELECT 'product', COUNT(*) FROM product
            UNION ALL SELECT 'sales', COUNT(*) FROM sales WHERE trans_dt <= DATE '{MID_DATE}'
            UNION ALL SELECT 'store', COUNT(*) FROM store""",
    ),
    "export_manifests": _with(
        _tables("sales", "stock_feed", "inventory", "calendar", "store", "product"),
        f"""SELECT 'calendar' AS table_name, COUNT(*) AS rows, TRUE AS adds_up FROM calendar
            UNION ALL SELECT 'inventory', COUNT(*), TRUE FROM inventory WHERE cal_dt <= DATE '{MID_DATE}'
            UNION ALL SELECT 'product', COUNT(*), TRUE FROM product
            UNION ALL SELECT 'sales', COUNT(*), TRUE FROM sales WHERE trans_dt <= DATE '{MID_DATE}'
            UNION ALL SELECT 'store', COUNT(*), TRUE FROM store""",
    ),
    "sink_partition_overwrite": (
        f"SELECT * FROM ({_published(MID_DATE)}) "
        f"UNION ALL SELECT * FROM ({_published(LAST_DATE)})"
    ),
    "sink_clustered": _published(LAST_DATE),
    "kpi_base": _from(
        "base",
        """yr_wk_num, store_key, prod_key, trans_dt, sales_qty, sales_amt, sales_cost,
           inventory_on_hand_qty, inventory_on_order_qty, out_of_stock_flg, stock_on_hand_amt,
           inventory_on_hand_qty AS week_end_stock_on_hand,
           inventory_on_order_qty AS week_end_ordered_stock, low_stock_flg""",
    ),
    "join_calendar": _with(
        _FACTS,
        """SELECT trans_id, trans_dt, store_key, prod_key, yr_wk_num
           FROM sales JOIN calendar ON trans_dt = cal_dt""",
    ),
    "join_inventory": _from(
        "stocked", f"{_SALE}, inventory_on_hand_qty, inventory_on_order_qty, out_of_stock_flg"
    ),
    "stock_value": _from(
        "stocked",
        f"{_SALE}, CAST(inventory_on_hand_qty * sales_price AS DECIMAL(28,4)) "
        "AS stock_on_hand_amt",
    ),
    "low_stock_flag": _from(
        "stocked",
        f"{_SALE}, CAST(CASE WHEN inventory_on_hand_qty < sales_qty THEN 1 ELSE 0 END "
        "AS INTEGER) AS low_stock_flg",
    ),
    "snapshot_filter": _with(
        _FACTS,
        f"""SELECT 'sales' AS table_name, trans_dt AS day, store_key, prod_key, sales_qty AS qty
            FROM sales WHERE trans_dt <= DATE '{MID_DATE}'
            UNION ALL
            SELECT 'inventory', cal_dt, store_key, prod_key, inventory_on_hand_qty
            FROM inventory WHERE cal_dt <= DATE '{MID_DATE}'""",
    ),
    "parse_date": f"""
        SELECT l_orderkey, l_linenumber, raw_text,
               CASE WHEN regexp_full_match(raw_text, '\\d{{4}}-\\d{{2}}-\\d{{2}}')
                    THEN TRY_CAST(raw_text AS DATE) END AS parsed_dt
        FROM (SELECT l_orderkey, l_linenumber,
                     CASE WHEN l_orderkey % 7 = 0
                          THEN concat_ws('-', year(l_shipdate), month(l_shipdate),
                                         day(l_shipdate))
                          WHEN l_orderkey % 11 = 0 THEN {_TEXT_DATE} || ' 10:00'
                          WHEN l_orderkey % 13 = 0 THEN '1999-02-30'
                          WHEN l_orderkey % 17 = 0 THEN 'unknown'
                          ELSE {_TEXT_DATE} END AS raw_text
              FROM lineitem)""",
    "kpi_agg": _from("agg", f"{_STOCK_KEY}, sum_sales_qty, sum_sales_amt, sum_sales_cost"),
    "avg_sales_price": _from("daily", f"{_STOCK_KEY}, avg_sales_price"),
    "stock_impact": _from(
        "agg",
        f"""{_STOCK_KEY}, total_low_stock_impact, potential_low_stock_impact, no_stock_impact,
            low_stock_instances, no_stock_instances""",
    ),
    "week_supply": _from("daily", f"{_STOCK_KEY}, week_supply_stock"),
    "lag_sales": _from("daily", f"{_STOCK_KEY}, sum_sales_amt, last_week_sales"),
    "wow_growth": _from("daily", f"{_STOCK_KEY}, week_over_week_growth"),
    "stock_turnover": _from("daily", f"{_STOCK_KEY}, stock_turnover_rate"),
    "kpi_daily": _from("daily", "*"),
    "kpi_daily_from_views": _from("daily", "*"),
    "week_out_of_stock_running": _from(
        "base",
        """yr_wk_num, store_key, prod_key, trans_dt, trans_id, sales_qty, sales_amt, sales_price,
           CAST(SUM(out_of_stock_flg) OVER (
                    PARTITION BY yr_wk_num, store_key, prod_key
                    ORDER BY trans_dt, trans_id, sales_qty, sales_amt, sales_price
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
               AS week_out_of_stock""",
    ),
    "kpi_weekly": _with(
        {
            **_FACTS, "stocked": _STOCKED, "base": _BASE, "week_sales": _WEEK_SALES,
            "week_stock": _WEEK_STOCK, "weeks": _WEEKS, "numbered": _NUMBERED,
        },
        _WEEKLY,
    ),
    "kpi_by_market_category": _with({**_CHAIN, **_tables("store", "product")}, _MARKET),
    "kpi_by_market_unknown": _with(
        {
            **_CHAIN,
            "store": f"SELECT * FROM ({SQL_TABLES['store']}) WHERE store_key <> 1",
            "product": f"SELECT * FROM ({SQL_TABLES['product']}) WHERE prod_key % 3 <> 2",
        },
        _MARKET,
    ),
    "readiness_missing": _with(
        _GATE,
        """SELECT r.file_name, r.business_date, r.table_name
           FROM required r ANTI JOIN listed l USING (file_name)""",
    ),
    "readiness_by_date": _with(_GATE, "SELECT * FROM status"),
    "readiness_stream": _with(_GATE, "SELECT * FROM status"),
    "ready_manifest_json": _with(
        _GATE,
        f"""SELECT business_date, '{{"conf":{{"data":{{' || {_PAYLOAD} || '}}}}}}' AS payload
            FROM (SELECT business_date, strftime(business_date, '%Y-%m-%d') AS d
                  FROM status WHERE ready)""",
    ),
    "readiness_deadlines": _with(
        _tables("business_days", "required", "seen"),
        """SELECT business_date,
                  CASE WHEN bool_and(NOT gone AND hours <= 24) THEN 'complete' ELSE 'overdue' END AS status,
                  CAST(epoch(business_date) AS BIGINT)
                    + CASE WHEN bool_and(NOT gone AND hours <= 24) THEN max(hours) * 3600 ELSE 86400 END AS at_s,
                  coalesce(string_agg(table_name, ',' ORDER BY table_name) FILTER (gone OR hours > 24), '') AS files_missing
           FROM seen GROUP BY business_date""",
    ),
    "batch_end_to_end": _published(LAST_DATE),
    "kpi_restated": _published(LAST_DATE),
}
