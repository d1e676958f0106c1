"""Headered CSV readers that always end in a declared schema."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisleworks.functions.dates import DATE_FORMAT, parse_date
from aisleworks.session import require_ansi
from aisleworks.sources.location import Location

_BROKEN = "_broken_line"


def _typed(text: Column, field: T.StructField) -> Column:
    """Strict conversion: bad text fails the job."""
    if isinstance(field.dataType, T.DateType):
        return F.to_date(text, DATE_FORMAT).alias(field.name)
    return text.cast(field.dataType).alias(field.name)


def _try_typed(text: Column, field: T.StructField) -> Column:
    """Lenient conversion: bad text gives NULL."""
    if isinstance(field.dataType, T.DateType):
        return parse_date(text).alias(field.name)
    return text.try_cast(field.dataType).alias(field.name)


def read_by_header(
    spark: SparkSession,
    location: Location,
    table: str,
    schema: T.StructType,
    day: dt.date | None = None,
    part: str | None = None,
) -> DataFrame:
    """Match columns by header name, in any order and case, then type them.

    Only the columns a query uses are parsed.  All part files of one export must
    share a header; one that differs fails the read instead of mixing columns.
    ``part`` names a column for the name of each row's file.
    """
    require_ansi(spark)
    raw = (
        spark.read.options(**location.read_options())
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(location.path(table, day))
    )
    found = {name.lower(): name for name in raw.columns}
    absent = [f.name for f in schema.fields if f.name.lower() not in found]
    if absent:
        raise ValueError(f"{location.path(table, day)} lacks columns {absent}")
    named = [raw["_metadata.file_name"].alias(part)] if part else []
    return raw.select([*(_typed(raw[f"`{found[f.name.lower()]}`"], f) for f in schema.fields), *named])


def _text_by_position(
    spark: SparkSession, location: Location, table: str, schema: T.StructType, day: dt.date | None, mode: str
) -> DataFrame:
    """Every value as text, the header line skipped; ``_BROKEN`` has a malformed line if ``mode`` lets it pass.

    All columns are parsed whatever a query uses, so a line with a value too many or too few never goes
    unnoticed.
    """
    fields = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    if mode == "PERMISSIVE":
        fields.append(T.StructField(_BROKEN, T.StringType()))
    return (
        spark.read.schema(T.StructType(fields))
        .options(**location.read_options())
        .option("enforceSchema", True)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", _BROKEN)
        .option("columnPruning", False)
        .csv(location.path(table, day))
    )


def read_positional(
    spark: SparkSession,
    location: Location,
    table: str,
    schema: T.StructType,
    day: dt.date | None = None,
) -> DataFrame:
    """Skip the header line and take columns by position; bad rows fail the job.

    Values are converted as in the other readers.  Spark converts only the columns
    it uses, so let a load write every column.
    """
    require_ansi(spark)
    raw = _text_by_position(spark, location, table, schema, day, "FAILFAST")
    return raw.select([_typed(F.col(f.name), f) for f in schema.fields])


def read_with_rejects(
    spark: SparkSession,
    location: Location,
    table: str,
    schema: T.StructType,
    day: dt.date | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split a file into typed good rows and rejected rows as text.

    Rejects keep every value, name the columns at fault in ``bad_columns``, and have
    the whole line in ``raw_line`` where values alone would lose some of it: a line
    with too many or too few lists ``*``.  The test is an expression over all
    columns, so later column pruning cannot weaken it.  Using both frames reads the
    file twice; ``split_rejects`` keeps one pass.
    """
    marked = marked_rows(spark, location, table, schema, day)
    return good_rows(marked, schema), bad_rows(marked, schema)


def split_rejects(
    spark: SparkSession,
    location: Location,
    table: str,
    schema: T.StructType,
    target: str,
    day: dt.date | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The same two frames from one pass: the file is read once and written, split, to ``target``."""
    marked = marked_rows(spark, location, table, schema, day)
    marked.write.mode("overwrite").partitionBy("rejected").parquet(target)
    stored = spark.read.schema(marked.schema).parquet(target)
    return good_rows(stored, schema), bad_rows(stored, schema)


def marked_rows(
    spark: SparkSession, location: Location, table: str, schema: T.StructType, day: dt.date | None = None
) -> DataFrame:
    """Typed values of good lines in ``good``, all values of bad ones in ``bad``, and which it is."""
    raw = _text_by_position(spark, location, table, schema, day, "PERMISSIVE")

    def fault(f: T.StructField) -> Column:
        text = F.col(f.name)
        wrong = text.isNotNull() & _try_typed(text, f).isNull()
        return wrong if f.nullable else wrong | text.isNull()

    faults = [
        (f.name, fault(f)) for f in schema.fields if not (isinstance(f.dataType, T.StringType) and f.nullable)
    ]
    broken = F.col(_BROKEN).isNotNull()
    rejected = reduce(lambda a, b: a | b, [test for _, test in faults], broken)
    named = F.concat_ws(",", *[F.when(test, F.lit(name)) for name, test in faults])
    return raw.select(
        F.when(~rejected, F.struct([_try_typed(F.col(f.name), f) for f in schema.fields])).alias("good"),
        F.when(rejected, F.struct(*schema.names)).alias("bad"),
        F.when(broken, F.lit("*")).otherwise(named).alias("bad_columns"),
        F.col(_BROKEN).alias("raw_line"),
        rejected.alias("rejected"),
    )


def rule_counts(schema: T.StructType) -> dict[str, Column]:
    """Aggregates over marked rows: how many break each rule, by column, and ``*`` for lines of another length."""
    named = F.split("bad_columns", ",")
    tested = [f.name for f in schema.fields if not (isinstance(f.dataType, T.StringType) and f.nullable)]
    return {rule: F.count_if(F.col("rejected") & F.array_contains(named, rule)) for rule in (*tested, "*")}


def good_rows(marked: DataFrame, schema: T.StructType) -> DataFrame:
    return marked.where(~F.col("rejected")).select([F.col("good")[name].alias(name) for name in schema.names])


def bad_rows(marked: DataFrame, schema: T.StructType) -> DataFrame:
    return marked.where("rejected").select(
        *[F.col("bad")[name].alias(name) for name in schema.names], "bad_columns", "raw_line"
    )
