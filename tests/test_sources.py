from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from aisleworks import schemas, sources
from aisleworks.operators.checks import DuplicateKeyError, duplicate_keys, require_unique
from aisleworks.plans import kpi_daily
from retail_checks import derived
from tests.conftest import DAY

SF = "/root/testdata/sf0.001"
# A failed task surfaces as either, depending on its cause.
FAILURES = (PySparkException, Py4JJavaError)
CALENDAR_HEADER = ",".join(schemas.CALENDAR.names)


def put(root, name, *lines):
    (root / name).write_text("\n".join(lines) + "\n")
    return sources.Location(str(root))


def test_positional_load_ignores_header_text(spark, tmp_path):
    landing = put(tmp_path, "calendar.csv", "a,b,c,d,e,f,g,h,i,j,k",
                  "2020-01-06,ISO,1,Monday,2020,2,202002,1,202001,1,202001")
    row = sources.read_positional(spark, landing, "calendar", schemas.CALENDAR).first()
    assert (row.cal_dt, row.yr_wk_num, row.day_of_wk_num) == (DAY, 202002, "1")


def test_header_read_finds_columns_in_any_order_and_case(spark, tmp_path):
    names = list(reversed([n.upper() for n in schemas.CALENDAR.names]))
    landing = put(tmp_path, f"calendar_{DAY}.csv", ",".join(names),
                  "202001,1,202001,1,202002,2,2020,Monday,1,ISO,2020-01-06")
    df = sources.read_by_header(spark, landing, "calendar", schemas.CALENDAR, DAY)
    assert df.columns == schemas.CALENDAR.names
    assert (df.first().cal_dt, df.first().yr_wk_num) == (DAY, 202002)


def test_header_read_names_absent_columns(spark, tmp_path):
    landing = put(tmp_path, "calendar.csv", "cal_dt,yr_wk_num", "2020-01-06,202002")
    with pytest.raises(ValueError, match="wk_num"):
        sources.read_by_header(spark, landing, "calendar", schemas.CALENDAR)


def test_header_read_refuses_part_files_that_differ(spark, tmp_path):
    folder = tmp_path / "calendar.csv"
    folder.mkdir()
    row = "2020-01-06,ISO,1,Monday,2020,2,202002,1,202001,1,202001"
    put(folder, "part-0.csv", CALENDAR_HEADER, row)
    put(folder, "part-1.csv", CALENDAR_HEADER.replace("yr_num,wk_num", "wk_num,yr_num"), row)
    df = sources.read_by_header(
        spark, sources.Location(str(tmp_path)), "calendar", schemas.CALENDAR
    )
    with pytest.raises(FAILURES, match="CSV header does not conform"):
        df.collect()


@pytest.mark.parametrize("bad", ["2020-13-06", "06/01/2020", "soon"])
def test_bad_value_fails_both_strict_reads(spark, tmp_path, bad):
    landing = put(tmp_path, "calendar.csv", CALENDAR_HEADER,
                  f"{bad},ISO,1,Monday,2020,2,202002,1,202001,1,202001")
    for read in (sources.read_by_header, sources.read_positional):
        with pytest.raises(FAILURES, match="MALFORMED|CANNOT_PARSE"):
            read(spark, landing, "calendar", schemas.CALENDAR).collect()


def test_load_checks_columns_nobody_asked_for(spark, tmp_path):
    landing = put(tmp_path, "calendar.csv", CALENDAR_HEADER,
                  "2020-01-06,ISO,1,Monday,2020,2,202002,1,202001,1,oops")
    with pytest.raises(FAILURES, match="CAST_INVALID_INPUT"):
        sources.load_table(spark, landing, "calendar", str(tmp_path / "table"))


def test_one_dialect_of_booleans_and_dates_in_all_readers(spark, tmp_path):
    names = schemas.INVENTORY.names
    rest = "1,1,1.00,1.00,0,0.00"
    landing = put(tmp_path, "inventory.csv", ",".join(names), f"2020-01-06,{rest},1,2020-01-07", f"2020-01-07,{rest},no,2020-01-08")
    want = [(True,), (False,)]
    by_header = sources.read_by_header(spark, landing, "inventory", schemas.INVENTORY)
    by_place = sources.read_positional(spark, landing, "inventory", schemas.INVENTORY)
    good, bad = sources.read_with_rejects(spark, landing, "inventory", schemas.INVENTORY)
    kept, _ = sources.split_rejects(spark, landing, "inventory", schemas.INVENTORY, str(tmp_path / "split"))
    for frame in (by_header, by_place, good, kept):
        assert sorted(frame.select("promotion_flg").collect(), reverse=True) == want and frame.schema == by_place.schema
    assert bad.count() == 0


def test_rejects_keep_the_whole_line_in_one_pass(spark, tmp_path):
    tail = "ISO,1,Monday,2020,2,202002,1,202001,1,202001"
    lines = [f"2020-01-06,{tail}", f"2020-01-07,{tail},EXTRA1,EXTRA2", "2020-01-08,ISO", f"2020-01-39,{tail}"]
    landing = put(tmp_path, "calendar.csv", CALENDAR_HEADER, *lines)
    good, bad = sources.split_rejects(spark, landing, "calendar", schemas.CALENDAR, str(tmp_path / "split"))
    assert [r.cal_dt for r in good.collect()] == [DAY]
    found = {r.cal_dt: r for r in bad.collect()}
    assert found["2020-01-07"].raw_line == lines[1] and found["2020-01-08"].raw_line == lines[2]
    assert found["2020-01-39"].raw_line is None and found["2020-01-39"].bad_columns == "cal_dt"
    assert found["2020-01-39"].yr_qtr_num == "202001"


def test_rejects_name_the_faulty_columns_whatever_is_selected(spark, tmp_path):
    tail = "2020,2,202002,1,202001,1,202001"
    landing = put(
        tmp_path, "calendar.csv", CALENDAR_HEADER,
        f"2020-01-06,ISO,1,Monday,{tail}",
        f"2020-01-32,ISO,2,Tuesday,{tail}",
        f",ISO,3,Wednesday,{tail}",
        f"2020-01-09,ISO,4,Thursday,x{tail}",
        "2020-01-10,ISO,5",
        f"2020-01-11,ISO,6,Saturday,{tail},more",
    )
    good, bad = sources.read_with_rejects(spark, landing, "calendar", schemas.CALENDAR)
    assert [r.cal_dt for r in good.select("cal_dt").collect()] == [DAY]
    assert sorted(r.bad_columns for r in bad.select("bad_columns").collect()) == [
        "*", "*", "cal_dt", "cal_dt", "yr_num",
    ]
    assert good.count() + bad.count() == 6


def test_table_is_replaced_and_registered(spark, tmp_path):
    first = sources.replace_table(spark.range(5), str(tmp_path / "t"), "aisle_numbers")
    assert first.count() == 5
    sources.replace_table(spark.range(2), str(tmp_path / "t"), "aisle_numbers")
    assert spark.table("aisle_numbers").count() == 2
    spark.sql("DROP TABLE aisle_numbers")


def test_views_serve_sql_users(spark):
    tables = derived.kpi_tables(spark, SF)
    sources.register_views(tables, shared=True)
    total = spark.sql(
        """SELECT sum(s.sales_amt) AS amt FROM global_temp.sales s
           JOIN global_temp.calendar c ON s.trans_dt = c.cal_dt"""
    ).first().amt
    assert total == kpi_daily(**tables).agg(F.sum("sum_sales_amt")).first()[0]


def test_listing(spark, tmp_path):
    assert sources.list_files(spark, str(tmp_path / "nothing")).count() == 0
    put(tmp_path, "a.csv", "12345")
    (tmp_path / "deep").mkdir()
    put(tmp_path / "deep", "b.csv", "1")
    rows = {r.path.rsplit("/", 1)[1]: r.length for r in
            sources.list_files(spark, str(tmp_path)).collect()}
    assert rows == {"a.csv": 6, "b.csv": 2}
    for pattern, names in (("d*", ["b.csv"]), ("*.csv", ["a.csv"]), ("x*", [])):
        found = sources.list_files(spark, str(tmp_path), pattern).collect()
        assert [r.path.rsplit("/", 1)[1] for r in found] == names


def test_paths_are_zero_padded():
    landing = sources.Location("s3://bucket/raw/")
    assert landing.path("sales", dt.date(2020, 1, 6)) == "s3://bucket/raw/sales_2020-01-06.csv"


def test_duplicate_keys(shop):
    stock = shop.stock((DAY, 9, 0, 0), (DAY, 9, 0, 0), (DAY, 1, 0, 0, 2, 1))
    rows = duplicate_keys(stock, schemas.INVENTORY_KEY).collect()
    assert [(r.store_key, r.copies) for r in rows] == [(1, 2)]
    with pytest.raises(DuplicateKeyError, match="inventory"):
        require_unique(stock, schemas.INVENTORY_KEY, "inventory")
    require_unique(stock.limit(1), schemas.INVENTORY_KEY, "inventory")


def test_schemas_note_text_lengths():
    assert schemas.STORE["addr"].metadata == {"max_length": 500}
    assert [f.name for f in schemas.CALENDAR.fields if not f.nullable] == ["cal_dt"]
    assert schemas.SALES["sales_amt"].dataType.simpleString() == "decimal(18,2)"


AWKWARD = ["plain", "", None, "  outer blanks  ", 'a "quoted", word', "back\\slash", "'", "né ü 漢",
           "tab\there", "#hash", '"', ",", "\\"]


def test_awkward_text_survives_export_and_load(spark, tmp_path):
    from aisleworks import sinks

    rows = [
        tuple({"prod_key": i, "prod_name": text, "vol": Decimal("1.50")}.get(n)
              for n in schemas.PRODUCT.names)
        for i, text in enumerate(AWKWARD)
    ]
    df = spark.createDataFrame(rows, schemas.PRODUCT)
    landing = sources.Location(str(tmp_path))
    assert sinks.export_snapshot({"product": df}, landing, DAY) == {"product": len(AWKWARD)}
    for read in (sources.read_by_header, sources.read_positional):
        back = read(spark, landing, "product", schemas.PRODUCT, DAY)
        assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_line_breaks_in_text_need_a_multi_line_location(spark, tmp_path):
    from aisleworks import sinks

    names = schemas.PRODUCT.names
    rows = [
        tuple({"prod_key": 1, "prod_name": "two\nlines"}.get(n) for n in names),
        tuple({"prod_key": 2, "prod_name": "one line"}.get(n) for n in names),
    ]
    df = spark.createDataFrame(rows, schemas.PRODUCT)
    sinks.export_snapshot({"product": df}, sources.Location(str(tmp_path)), DAY, verify=False)
    whole = sources.Location(str(tmp_path), multi_line=True)
    back = sources.read_by_header(spark, whole, "product", schemas.PRODUCT, DAY)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    split = sources.Location(str(tmp_path))
    with pytest.raises(FAILURES, match="MALFORMED"):
        sources.read_positional(spark, split, "product", schemas.PRODUCT, DAY).collect()
