"""Published rows in the order of store and product let reads of either skip most of the file."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from aisleworks import sinks, sources
from aisleworks.operators.clustering import interleaved
from tests.conftest import DAY

STORES, PRODUCTS, DATES = 128, 256, 10


def test_bits_alternate(spark):
    rows = spark.createDataFrame([(0b101, 0b011), (0, 0), (None, 1), (2**40 + 1, 0), (2**31, 2**30)], "a long, b long")
    got = [r.z for r in rows.select(interleaved("a", "b").alias("z")).collect()]
    assert got == [0b011011, 0, 2, 1, 2**61]
    three = rows.limit(1).select(interleaved("a", "b", "a").alias("z")).first().z
    assert three == 0b101010111
    assert rows.select(interleaved("a").alias("z")).first().z == 0b101


@pytest.fixture(scope="module")
def groups(spark, tmp_path_factory):
    """Row groups' ranges of (store, product) as published by date and clustered."""
    rows = spark.range(STORES * PRODUCTS * DATES).select(
        (F.col("id") % STORES).alias("store_key"),
        (F.col("id") / STORES).cast("long").alias("n"),
    ).select(
        "store_key", (F.col("n") % PRODUCTS).alias("prod_key"),
        F.date_add(F.lit(DAY), (F.col("n") / PRODUCTS).cast("int")).alias("trans_dt"),
        F.xxhash64("store_key", "n").alias("noise"),
    )
    mixed = str(tmp_path_factory.mktemp("mixed") / "rows")
    rows.orderBy("noise").write.parquet(mixed)
    rows = spark.read.parquet(mixed)
    found, frames = {}, {}
    for name, by in (("plain", "trans_dt"), ("clustered", ("store_key", "prod_key"))):
        root = str(tmp_path_factory.mktemp(name))
        assert sinks.write_partition(rows, root, DAY, by, row_group_bytes=32_000) == STORES * PRODUCTS * DATES
        frames[name] = sources.read_published(spark, root)
        (folder,) = sources.published_paths(spark, root)
        found[name] = []
        for file in sorted(Path(folder).glob("*.parquet")):
            meta = pq.ParquetFile(file).metadata
            places = [meta.schema.names.index(c) for c in ("store_key", "prod_key")]
            for number in range(meta.num_row_groups):
                stats = [meta.row_group(number).column(place).statistics for place in places]
                found[name].append([(s.min, s.max) for s in stats])
    return found, frames, rows


def touched(groups, store=None, product=None):
    hits = [g for g in groups if all(v is None or low <= v <= high for v, (low, high) in zip((store, product), g))]
    return len(hits) / len(groups)


def test_a_store_and_product_read_touches_few_row_groups(groups):
    found, _, _ = groups
    assert len(found["clustered"]) >= 40
    picks = [(s, p) for s in range(0, STORES, 9) for p in range(0, PRODUCTS, 17)]
    assert max(touched(found["clustered"], s, p) for s, p in picks) <= 0.08
    assert min(touched(found["plain"], s, p) for s, p in picks) > 0.5


def test_reads_of_one_of_the_two_skip_too(groups):
    found, _, _ = groups
    assert max(touched(found["clustered"], store=s) for s in range(0, STORES, 7)) <= 0.35
    assert max(touched(found["clustered"], product=p) for p in range(0, PRODUCTS, 7)) <= 0.35


def test_rows_are_the_same_and_filters_reach_the_scan(groups):
    _, frames, rows = groups
    assert frames["clustered"].drop("date").exceptAll(rows).count() == 0
    one = frames["clustered"].where("store_key = 5 AND prod_key = 7")
    assert one.count() == DATES
    assert "EqualTo(store_key,5), EqualTo(prod_key,7)" in one._jdf.queryExecution().executedPlan().toString()
