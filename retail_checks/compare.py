"""Run registered queries in Spark and their SQL in DuckDB and compare all rows."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return [f"{names[i]}" for i in order], rows


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*names).collect())


def differences(df: DataFrame, sql: str, sf_dir: str) -> list[str]:
    """Empty when both sides hold the same rows, copies included."""
    got_names, got = spark_rows(df)
    want_names, want = oracle_rows(sql, sf_dir)
    if got_names != want_names:
        return [f"columns {got_names} != {want_names}"]
    if got == want:
        return []
    extra, lacking = got - want, want - got
    return [
        f"rows {sum(got.values())} vs {sum(want.values())}, "
        f"{sum(extra.values())} unexpected, {sum(lacking.values())} absent",
        f"unexpected {list(extra)[:2]}",
        f"absent {list(lacking)[:2]}",
    ]


def main(sf_dir: str, keys: list[str]) -> int:
    from aisleworks.session import build_session
    from retail_checks.catalog import QUERIES
    from retail_checks.oracle import ORACLE

    spark: SparkSession = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for key in keys or QUERIES:
        began = time.time()
        found = differences(QUERIES[key](spark, sf_dir), ORACLE[key], sf_dir)
        failed += bool(found)
        print("FAIL" if found else "ok  ", key, f"{time.time() - began:.1f}s", *found, sep="  ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
