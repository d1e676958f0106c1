"""Results must not depend on the session's time zone or defaults."""

import pytest

import __spark_entry__ as driver
from retail_checks.compare import differences

SF = "/root/testdata/sf0.001"
DATED = ("scan_csv_header", "load_typed_inventory", "parse_date", "list_files", "kpi_daily",
         "kpi_weekly", "readiness_by_date", "ready_manifest_json", "sink_partition_overwrite")


@pytest.mark.parametrize("key", DATED)
def test_other_time_zone(spark, conf, key):
    conf(session__timeZone="America/Los_Angeles")
    assert differences(driver.queries()[key](spark, SF), driver.oracle_sql()[key], SF) == []


@pytest.mark.parametrize("key", ("kpi_daily", "kpi_weekly", "kpi_by_market_category"))
def test_without_adaptive_execution_and_broadcasts(spark, conf, key):
    conf(adaptive__enabled="false", autoBroadcastJoinThreshold=-1)
    assert differences(driver.queries()[key](spark, SF), driver.oracle_sql()[key], SF) == []
