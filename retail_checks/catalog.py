"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All of them read whole tables.  Those that write use a new folder each time, in
the shared folder the session names.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleworks import schemas, sinks, sources, streaming
from aisleworks.functions import date_text, parse_date
from aisleworks.operators import checks, joins, readiness, stock
from aisleworks.operators.aggregates import DAY_KEY
from aisleworks.operators.windows import with_last_sales
from aisleworks.plans import batch, daily, kpi_by_market_category, kpi_weekly
from aisleworks.scratch import scratch_path
from aisleworks.sources.manifests import manifest_lines
from retail_checks import derived

Query = Callable[[SparkSession, str], DataFrame]

# A date inside the data, so a snapshot drops some rows, and one after all of it.
MID_DATE = dt.date(1998, 9, 2)
LAST_DATE = dt.date(2001, 12, 31)
EARLY_DATE = dt.date(2001, 10, 15)

STOCK_KEY = (*DAY_KEY, "week_end_stock_on_hand", "week_end_ordered_stock")
LANDING = "s3://landing/raw"


def _location(spark: SparkSession, label: str) -> sources.Location:
    return sources.Location(scratch_path(spark, label))


def _stored_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables written once, for queries that read them more than once."""
    root = scratch_path(spark, "tables")
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}")
    return {name: spark.read.schema(df.schema).parquet(f"{root}/{name}") for name, df in tables.items()}


def _exported(spark: SparkSession, df: DataFrame, table: str, day: dt.date, label: str):
    location = _location(spark, label)
    sinks.export_snapshot({table: df}, location, day)
    return location


# Sources


def scan_csv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns arrive in another order and case and are found by header name."""
    sales = derived.sales(spark, sf_dir)
    shuffled = sales.select([F.col(c).alias(c.upper()) for c in reversed(sales.columns)])
    location = _location(spark, "scan")
    options = {**location.csv_options(), "header": True}
    shuffled.write.options(**options).csv(location.path("sales", LAST_DATE))
    return sources.read_by_header(spark, location, "sales", schemas.SALES, LAST_DATE)


def _load(table: str, rows: str = "") -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Header text differs from the schema and is skipped; position decides."""
        df = getattr(derived, rows or table)(spark, sf_dir)
        renamed = df.toDF(*[f"field {i}" for i in range(len(df.columns))])
        location = _location(spark, "load")
        renamed.write.options(**location.csv_options()).option("header", True).csv(
            location.path(table)
        )
        return sources.load_table(spark, location, table, scratch_path(spark, f"table-{table}"))

    return query


def _damaged(spark: SparkSession, sf_dir: str) -> sources.Location:
    """Sales lines as text, some with a bad date and number, a value too few or two too many."""
    sales = derived.sales(spark, sf_dir)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sales.columns]
    line, order = F.concat_ws(",", *text), F.col("trans_id")
    swapped = F.concat_ws(
        ",", *[F.lit("n/a") if c in ("trans_dt", "sales_qty") else t
               for c, t in zip(sales.columns, text, strict=True)]
    )
    lines = sales.select(
        F.when(order % 19 == 0, F.concat_ws(",", *text[:-1]))
        .when(order % 29 == 0, F.concat_ws(",", line, F.lit("EXTRA 1"), F.lit("EXTRA 2")))
        .when(order % 23 == 0, swapped)
        .otherwise(line)
        .alias(",".join(sales.columns))
    )
    location = _location(spark, "rejects")
    # No quoting: the lines are already CSV and hold no separator of this writer.
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "").csv(
        location.path("sales")
    )
    return location


def _loaded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    target = scratch_path(spark, "table-sales")
    return sources.load_with_rejects(spark, _damaged(spark, sf_dir), "sales", target)


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir)[1]


def load_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir)[0]


def load_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load tells that has far more rejects than its budget, and so publishes nothing."""
    target = scratch_path(spark, "table-refused")
    try:
        sources.load_with_rejects(spark, _damaged(spark, sf_dir), "sales", target, budget=sources.RejectBudget(rows=0))
        counts = []
    except sources.RejectBudgetError as err:
        counts = [("rows", err.rows), ("rejected", err.rejected), *((rule, n) for rule, n in err.counts.items() if n)]
    return spark.createDataFrame(counts, "rule string, rows bigint")


def inventory_key_dupes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run on the raw stock feed, where keys do repeat."""
    return checks.duplicate_keys(derived.stock_feed(spark, sf_dir), schemas.INVENTORY_KEY)


def list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir, sources.list_files)


def list_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir, sources.list_tree)


def _listed(spark: SparkSession, sf_dir: str, lister: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """Write sales by month, list the files, and compare their sizes with what was read from them."""
    root = scratch_path(spark, "listing")
    sales = derived.sales(spark, sf_dir).withColumn("month", F.date_trunc("month", "trans_dt"))
    by_month = sales.withColumn("month", F.col("month").cast("date")).hint("rebalance", "month")
    by_month.write.partitionBy("month").option("header", True).csv(root)
    month = F.regexp_extract("path", r"/month=([0-9-]+)/", 1)
    listed = lister(spark, root).select(month.alias("month"), "path", "length")
    # Lines of the listed files, without their headers; a line ends with one byte.
    lines = spark.read.text(root).select(
        F.col("_metadata.file_path").alias("path"), F.octet_length("value").alias("bytes")
    ).groupBy("path").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.col("bytes") + 1).alias("bytes"))
    same = F.regexp_replace(listed["path"], "^file:/+", "/") == F.regexp_replace(lines["path"], "^file:/+", "/")
    return (
        listed.join(lines, same, "left")
        .groupBy("month")
        .agg(F.sum(F.col("lines") - 1).alias("rows"), F.bool_and(F.col("length") == F.col("bytes")).alias("whole"))
    )


# Sinks


def _export_readback(table: str, rows: str = "") -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(derived, rows or table)(spark, sf_dir)
        location = _exported(spark, df, table, MID_DATE, "export")
        return sources.read_by_header(spark, location, table, schemas.TABLES[table], MID_DATE)

    return query


def export_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sinks.export_snapshot(
        derived.all_tables(spark, sf_dir), _location(spark, "audit"), MID_DATE
    )
    return sinks.audit_frame(spark, rows)


def export_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each export by the lines of its parts, and whether their digests add up to the whole export's."""
    location = _location(spark, "manifests")
    tables = derived.all_tables(spark, sf_dir)
    sinks.export_snapshot(tables, location, MID_DATE)
    lines = reduce(DataFrame.unionByName, (manifest_lines(spark, location, name, MID_DATE) for name in tables))

    def adds_up(name: str) -> Column:
        parts = F.coalesce(F.sum(F.when(F.col("part").isNotNull(), F.col(name))), F.lit(0))
        return parts == F.max(F.when(F.col("part").isNull(), F.col(name)))

    return lines.groupBy("table_name").agg(
        F.coalesce(F.sum(F.when(F.col("part").isNotNull(), F.col("rows"))), F.lit(0)).alias("rows"),
        (adds_up("rows") & adds_up("high") & adds_up("low")).alias("adds_up"),
    )


def sink_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two run dates published, the first one published again."""
    root = scratch_path(spark, "publish")
    tables = derived.kpi_tables(spark, sf_dir)
    for day in (MID_DATE, LAST_DATE, MID_DATE):
        known = {name: sinks.snapshot(df, name, day) for name, df in tables.items()}
        sinks.write_partition(daily.kpi_daily(**known), root, day)
    return sources.read_published(spark, root)


def sink_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published in the order of store and product, and read back."""
    root = scratch_path(spark, "clustered")
    batch.run_tables(spark, derived.kpi_tables(spark, sf_dir), root, LAST_DATE, cluster_by=("store_key", "prod_key"))
    return sources.read_published(spark, root)


# Rows


def kpi_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.kpi_base(**derived.kpi_tables(spark, sf_dir))


def join_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = joins.join_calendar(derived.sales(spark, sf_dir), derived.calendar(spark, sf_dir))
    return joined.select("trans_id", "trans_dt", "store_key", "prod_key", "yr_wk_num")


def _stocked_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.join_inventory(derived.sales(spark, sf_dir), derived.inventory(spark, sf_dir))


_SALE = ("trans_id", "trans_dt", "store_key", "prod_key", "sales_qty")


def join_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stocked_sales(spark, sf_dir).select(
        *_SALE, "inventory_on_hand_qty", "inventory_on_order_qty", "out_of_stock_flg"
    )


def stock_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = stock.stock_value().alias("stock_on_hand_amt")
    return _stocked_sales(spark, sf_dir).select(*_SALE, value)


def low_stock_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = stock.low_stock_flag().alias("low_stock_flg")
    return _stocked_sales(spark, sf_dir).select(*_SALE, flag)


def snapshot_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = sinks.snapshot(derived.sales(spark, sf_dir), "sales", MID_DATE)
    stocks = sinks.snapshot(derived.inventory(spark, sf_dir), "inventory", MID_DATE)
    return sales.select(
        F.lit("sales").alias("table_name"), F.col("trans_dt").alias("day"),
        "store_key", "prod_key", F.col("sales_qty").alias("qty"),
    ).unionAll(
        stocks.select(
            F.lit("inventory").alias("table_name"), F.col("cal_dt").alias("day"),
            "store_key", "prod_key", F.col("inventory_on_hand_qty").alias("qty"),
        )
    )


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship dates as text, some unpadded or with a time and some no date at all."""
    day, order = F.col("l_shipdate").cast("date"), F.col("l_orderkey")
    text = (
        F.when(order % 7 == 0, F.concat_ws("-", F.year(day), F.month(day), F.day(day)))
        .when(order % 11 == 0, F.concat(date_text(day), F.lit(" 10:00")))
        .when(order % 13 == 0, F.lit("1999-02-30"))
        .when(order % 17 == 0, F.lit("unknown"))
        .otherwise(date_text(day))
    )
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", text.alias("raw_text")
    )
    return lines.withColumn("parsed_dt", parse_date(F.col("raw_text")))


# KPIs


def _agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.kpi_agg(**derived.kpi_tables(spark, sf_dir))


def kpi_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _agg(spark, sf_dir).select(
        *STOCK_KEY, "sum_sales_qty", "sum_sales_amt", "sum_sales_cost"
    )


def avg_sales_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _agg(spark, sf_dir).select(*STOCK_KEY, "avg_sales_price")


def stock_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _agg(spark, sf_dir).select(
        *STOCK_KEY, "total_low_stock_impact", "potential_low_stock_impact",
        "no_stock_impact", "low_stock_instances", "no_stock_instances",
    )


def week_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _agg(spark, sf_dir).select(*STOCK_KEY, "week_supply_stock")


def lag_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpis = with_last_sales(_agg(spark, sf_dir))
    return kpis.select(*STOCK_KEY, "sum_sales_amt", "last_week_sales")


def wow_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi_daily(spark, sf_dir).select(*STOCK_KEY, "week_over_week_growth")


def stock_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.with_ratios(_agg(spark, sf_dir).withColumn("last_week_sales", F.lit(None))).select(
        *STOCK_KEY, "stock_turnover_rate"
    )


def kpi_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.kpi_daily(**derived.kpi_tables(spark, sf_dir))


def kpi_daily_from_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables pass through application-wide views."""
    tables = derived.kpi_tables(spark, sf_dir)
    names = {name: f"aisleworks_check_{name}" for name in tables}
    sources.register_views({names[name]: df for name, df in tables.items()}, shared=True)
    kpis = daily.kpi_daily(**{name: spark.table(f"global_temp.{view}") for name, view in names.items()})
    for view in names.values():  # the plan keeps what the views stood for
        spark.catalog.dropGlobalTempView(view)
    return kpis


def week_out_of_stock_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.week_out_of_stock_running(**derived.kpi_tables(spark, sf_dir))


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi_weekly(**derived.kpi_tables(spark, sf_dir))


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi_by_market_category(**derived.all_tables(spark, sf_dir))


def market_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store and a third of the products are unknown; their sales stay in the totals."""
    tables = derived.all_tables(spark, sf_dir)
    tables["store"] = tables["store"].where("store_key <> 1")
    tables["product"] = tables["product"].where("prod_key % 3 <> 2")
    return kpi_by_market_category(**tables)


# Gate and batch


def readiness_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    required = readiness.required_files(derived.business_days(spark, sf_dir))
    return readiness.missing_files(required, derived.listing(required, LANDING))


def readiness_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    required = readiness.required_files(derived.business_days(spark, sf_dir))
    return readiness.readiness_by_date(required, derived.listing(required, LANDING))


def ready_manifest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = readiness_by_date(spark, sf_dir).where("ready").select("business_date")
    return readiness.manifest_json(ready, LANDING)


def readiness_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing arrives as notification files, several per micro-batch."""
    required = readiness.required_files(derived.business_days(spark, sf_dir))
    feed, output, state = (scratch_path(spark, f"arrivals-{part}") for part in "abc")
    derived.listing(required, LANDING).repartition(6, "path").write.json(feed)
    paths = (
        spark.readStream.schema("path string").option("maxFilesPerTrigger", 3).json(feed)
    )
    streaming.track_arrivals(paths, output, state).awaitTermination()
    return readiness.readiness_status(required, streaming.current_flags(spark, output))


def readiness_deadlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each date announced, its files as they were seen, and one event long after: which dates were complete in a day?"""
    required = readiness.required_files(derived.business_days(spark, sf_dir))
    feed, output, state = (scratch_path(spark, f"deadlines-{part}") for part in "abc")
    announced = streaming.announcements(required.select("business_date").distinct())
    after_all = F.timestamp_seconds(F.max(F.unix_date("business_date")).cast("long") * 86400 + 10 * 86400)
    later = required.agg(after_all.alias("seen_at")).select(
        F.lit(None).cast("date").alias("business_date"), F.lit(None).cast("string").alias("table_name"), "seen_at"
    )
    announced.unionByName(derived.arrivals(required)).unionByName(later).write.parquet(feed)
    events = spark.readStream.schema(streaming.EVENTS).parquet(feed)
    streaming.watch_deadlines(events, output, state, dt.timedelta(days=1)).awaitTermination()
    return streaming.verdicts(spark, output).select(
        "business_date", "status", F.unix_seconds("at").alias("at_s"), "files_missing"
    )


def batch_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export all five tables, pass the gate, publish the KPIs, read them back."""
    landing, root = _location(spark, "landing"), scratch_path(spark, "output")
    sinks.export_snapshot(derived.all_tables(spark, sf_dir), landing, LAST_DATE)
    batch.run(spark, landing, root, LAST_DATE)
    return sources.read_published(spark, root)


def kpi_restated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published once before two weeks were corrected and the last weeks came in, then restated by difference."""
    after = _stored_tables(spark, derived.kpi_tables(spark, sf_dir))
    order, sales, stocks = F.col("trans_id"), after["sales"], after["inventory"]
    corrected = F.col("trans_dt").between(F.date_sub(F.lit(MID_DATE), 14), F.lit(MID_DATE))
    known = sales.where(F.col("trans_dt") <= F.lit(EARLY_DATE)).where(~(corrected & (order % 7 == 0)))
    wrong = known.withColumn("sales_amt", F.when(corrected & (order % 3 == 0), F.col("sales_amt") + 5)
                             .otherwise(F.col("sales_amt")).cast("decimal(18,2)"))
    sold = wrong.unionByName(known.where(corrected & (order % 5 == 0)))
    moved = F.col("cal_dt").between(F.date_sub(F.lit(MID_DATE), 14), F.lit(MID_DATE)) & (F.col("store_key") == 2)
    counted = stocks.where(F.col("cal_dt") <= F.lit(EARLY_DATE)).withColumn(
        "inventory_on_hand_qty", (F.col("inventory_on_hand_qty") + moved.cast("int")).cast("decimal(18,2)")
    )
    before = {**after, **_stored_tables(spark, {"sales": sold, "inventory": counted})}
    root = scratch_path(spark, "restated")
    batch.run_tables(spark, before, root, EARLY_DATE)
    batch.restate_tables(spark, before, after, root, EARLY_DATE, LAST_DATE)
    return sources.read_published(spark, root, [LAST_DATE])


QUERIES: dict[str, Query] = {
    "scan_csv_header": scan_csv_header,
    "load_typed_csv": _load("sales"),
    "load_typed_inventory": _load("inventory"),
    "load_typed_calendar": _load("calendar", "sales_calendar"),
    "load_typed_store": _load("store"),
    "load_typed_product": _load("product"),
    "load_rejects": load_rejects,
    "load_accepted": load_accepted,
    "load_reject_counts": load_reject_counts,
    "inventory_key_dupes": inventory_key_dupes,
    "list_files": list_files,
    "list_tree": list_tree,
    "export_snapshot": _export_readback("sales"),
    "export_snapshot_inventory": _export_readback("inventory"),
    "export_snapshot_calendar": _export_readback("calendar", "sales_calendar"),
    "export_snapshot_store": _export_readback("store"),
    "export_snapshot_product": _export_readback("product"),
    "export_audit": export_audit,
    "export_manifests": export_manifests,
    "sink_partition_overwrite": sink_partition_overwrite,
    "sink_clustered": sink_clustered,
    "kpi_base": kpi_base,
    "join_calendar": join_calendar,
    "join_inventory": join_inventory,
    "stock_value": stock_value,
    "low_stock_flag": low_stock_flag,
    "snapshot_filter": snapshot_filter,
    "parse_date": parse_dates,
    "kpi_agg": kpi_agg,
    "avg_sales_price": avg_sales_price,
    "stock_impact": stock_impact,
    "week_supply": week_supply,
    "lag_sales": lag_sales,
    "wow_growth": wow_growth,
    "stock_turnover": stock_turnover,
    "kpi_daily": kpi_daily,
    "kpi_daily_from_views": kpi_daily_from_views,
    "week_out_of_stock_running": week_out_of_stock_running,
    "kpi_weekly": weekly,
    "kpi_by_market_category": market,
    "kpi_by_market_unknown": market_unknown,
    "readiness_missing": readiness_missing,
    "readiness_by_date": readiness_by_date,
    "ready_manifest_json": ready_manifest_json,
    "readiness_stream": readiness_stream,
    "readiness_deadlines": readiness_deadlines,
    "batch_end_to_end": batch_end_to_end,
    "kpi_restated": kpi_restated,
}
