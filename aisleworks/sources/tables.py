"""Typed tables: create or replace, bulk load, and views for SQL users.

A table is a folder of versions, of which a pointer names the one that counts: a load that turns out to be wrong
when it has been written leaves the old one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisleworks.operators.checks import DuplicateKeyError
from aisleworks.schemas import TABLES, UNIQUE_KEYS
from aisleworks.sources.csv_files import bad_rows, good_rows, marked_rows, read_positional, rule_counts
from aisleworks.sources.location import Location
from aisleworks.sources.published import NothingPublishedError
from aisleworks.versions import Version, current_versions, new_version, point_to

_SLOT = "table"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The version of the table at ``path`` that counts now."""
    version = current_versions(spark, path).get(_SLOT)
    if not version:
        raise NothingPublishedError(f"no table at {path}")
    return (spark.read.schema(schema) if schema else spark.read).parquet(version.path)


def replace_table(
    df: DataFrame, path: str, name: str | None = None, buckets: int = 0, by: Sequence[str] = ()
) -> DataFrame:
    """Create or replace a Parquet table at ``path``, in the catalog if named.

    A named table may be bucketed: inventory in buckets ``by`` its key is not
    shuffled again by the KPI joins.  Bucket only on keys that are unique,
    or nearly so; a repeated key sits whole in one bucket.
    """
    seen = Observation()
    version = _write(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, name, buckets, by)
    return _commit(df, version, seen.get["rows"], name)


def _write(df: DataFrame, path: str, name: str | None, buckets: int, by: Sequence[str]) -> Version:
    """A new version, under a passing name if it is to have one in the catalog."""
    version = new_version(path, _SLOT)
    if not name:
        if buckets:
            raise ValueError("buckets are kept in the catalog: give the table a name")
        df.write.parquet(version.path)
        return version
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}__loading")
    # Shuffled first: one file per bucket instead of one per task and bucket.
    writer = df.repartition(buckets, *by).write.bucketBy(buckets, *by) if buckets else df.write
    writer.format("parquet").option("path", version.path).saveAsTable(f"{name}__loading")
    return version


def _commit(df: DataFrame, version: Version, rows: int, name: str | None) -> DataFrame:
    """Let the version count, and the name, if any, stand for it."""
    spark = df.sparkSession
    point_to(spark, version, rows)
    if name:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {name}__loading RENAME TO {name}")
        return spark.table(name)
    return spark.read.schema(df.schema).parquet(version.path)


def _proven(rows: DataFrame, keys: Sequence[str | T.StructField]) -> tuple[DataFrame, Observation]:
    """``rows`` brought together by key, and an observation of the rows that repeat the key before them.

    The one shuffle also writes the table: rows are compared with their neighbours in the tasks that write them.
    """
    seen = Observation()
    again = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)) > 1
    example = F.min(F.when(F.col("_again"), F.to_json(F.struct(*keys))))
    observed = rows.withColumn("_again", again).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if("_again").alias("repeats"), example.alias("example")
    )
    return observed.drop("_again"), seen


def _refuse_repeats(table: str, keys: Sequence[str], seen: dict) -> None:
    if seen["repeats"]:
        raise DuplicateKeyError(f"{table} repeats {tuple(keys)} in {seen['repeats']} rows, such as {seen['example']}")


def load_table(
    spark: SparkSession,
    source: Location,
    table: str,
    target: str,
    day: dt.date | None = None,
    name: str | None = None,
    buckets: int = 0,
    by: Sequence[str] = (),
) -> DataFrame:
    """Bulk-load one CSV file into its typed table; any malformed row aborts it.

    Writing every column makes Spark check every column.  The file is read once; a table whose declared
    key repeats is found out as it is written, and then the old table stays.
    """
    rows = read_positional(spark, source, table, TABLES[table], day)
    if table not in UNIQUE_KEYS:
        return replace_table(rows, target, name, buckets, by)
    keys = UNIQUE_KEYS[table]
    # Rows that are in buckets by part of their key are together already.
    together = rows.repartition(buckets, *by) if buckets and set(by) <= set(keys) else rows
    observed, seen = _proven(together, keys)
    version = _write(observed, target, name, buckets, by)
    _refuse_repeats(table, keys, seen.get)
    return _commit(rows, version, seen.get["rows"], name)


@dataclass(frozen=True)
class RejectBudget:
    """How many rejected rows a load may have: a number, a share of all rows, or both; None does not limit."""

    rows: int | None = None
    share: float | None = None

    def exceeded(self, rejected: int, rows: int) -> bool:
        return (self.rows is not None and rejected > self.rows) or (self.share is not None and rejected > self.share * rows)


class RejectBudgetError(ValueError):
    """A load has more rejects than its budget; ``counts`` has them by rule, ``rejected`` and ``rows`` in all."""

    def __init__(self, table: str, counts: dict[str, int], rejected: int, rows: int):
        told = ", ".join(f"{rule} {count}" for rule, count in sorted(counts.items()) if count)
        super().__init__(f"{table}: {rejected} of {rows} rows rejected ({told})")
        self.counts, self.rejected, self.rows = counts, rejected, rows


def load_with_rejects(
    spark: SparkSession,
    source: Location,
    table: str,
    target: str,
    day: dt.date | None = None,
    budget: RejectBudget | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Bulk-load the good rows and keep the bad ones: (accepted, rejected), one version below ``target``.

    The file is read once.  Rejects are counted by rule as they are written; with more than ``budget`` allows, or with
    accepted rows that repeat a key, neither table is published and both old ones stay.
    """
    schema, keys = TABLES[table], UNIQUE_KEYS.get(table, ())
    marked = marked_rows(spark, source, table, schema, day)
    if keys:
        # Rejects have no key; the hash of their values spreads them, and none of them counts as a repeat.
        parts = [F.col("good")[key].alias(key) for key in keys]
        spread = F.when(F.col("rejected"), F.xxhash64("bad", "raw_line"))
        window = Window.partitionBy("rejected", *parts, spread).orderBy("rejected")
        again = ~F.col("rejected") & (F.row_number().over(window) > 1)
        example = F.min(F.when(F.col("_again"), F.to_json(F.struct(*parts))))
    else:
        again, example = F.lit(False), F.lit(None).cast("string")
        example = F.min(example)
    seen = Observation()
    counts = {f"rule {rule}": count for rule, count in rule_counts(schema).items()}
    observed = marked.withColumn("_again", again).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if("rejected").alias("rejected"),
        F.count_if("_again").alias("repeats"), example.alias("example"), *[c.alias(name) for name, c in counts.items()],
    ).drop("_again")
    version = new_version(target, _SLOT)
    observed.write.partitionBy("rejected").parquet(version.path)
    found = seen.get
    if budget and budget.exceeded(found["rejected"], found["rows"]):
        by_rule = {name.removeprefix("rule "): found[name] for name in counts}
        raise RejectBudgetError(table, by_rule, found["rejected"], found["rows"])
    _refuse_repeats(table, keys, found)
    point_to(spark, version, found["rows"])
    return read_split(spark, table, target)


def read_split(spark: SparkSession, table: str, target: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of the last load at ``target`` that was published."""
    version = current_versions(spark, target).get(_SLOT)
    if not version:
        raise NothingPublishedError(f"no load at {target}")
    schema = TABLES[table]
    text = T.StructType([T.StructField(name, T.StringType()) for name in schema.names])
    stored = spark.read.schema(
        T.StructType([T.StructField("good", schema), T.StructField("bad", text), T.StructField("bad_columns", T.StringType()),
                      T.StructField("raw_line", T.StringType()), T.StructField("rejected", T.BooleanType())])
    ).parquet(version.path)
    return good_rows(stored, schema), bad_rows(stored, schema)


def register_views(tables: Mapping[str, DataFrame], shared: bool = False) -> None:
    """Expose tables to SQL by name; ``shared`` puts them in ``global_temp``."""
    for name, df in tables.items():
        if shared:
            df.createOrReplaceGlobalTempView(name)
        else:
            df.createOrReplaceTempView(name)
