"""File arrivals as a stream: which dates became complete?"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aisleworks.operators.readiness import REQUIRED, arrival_flags, arrived_files
from aisleworks.versions import clean, current_versions, new_version, point_to

_SLOT = "flags"
_FLAGS = ", ".join(["business_date date", *[f"has_{t} boolean" for t in REQUIRED]])


def file_arrivals(spark: SparkSession, root: str) -> DataFrame:
    """New files below a landing folder, as a stream of paths and when they were written."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return (
        spark.readStream.format("binaryFile")
        .schema(schema)
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "modificationTime")
    )


def track_arrivals(
    paths: DataFrame, output: str, checkpoint: str, keep: dt.timedelta = dt.timedelta(hours=1)
) -> StreamingQuery:
    """Keep five flags per business date, published anew with each batch.

    ``paths`` is any stream with a ``path`` column: a watched folder, or the
    notification feed of an object store.  A path seen twice changes nothing.
    The stream itself has no state.  Each batch adds what has arrived to the flags published before it; as a flag only
    ever turns from false to true, a replayed batch changes nothing.  Readers see whole versions, while the stream
    runs too; older ones go ``keep`` after they were superseded.
    Processes all that is available, then stops.
    """

    def publish(arrived: DataFrame, batch: int) -> None:
        spark = arrived.sparkSession
        changed = arrived.groupBy("business_date").agg(*arrival_flags())
        seen = Observation()
        merged = _merged(current_flags(spark, output).unionByName(changed)).observe(seen, F.count(F.lit(1)).alias("dates"))
        version = new_version(output, _SLOT)
        merged.write.parquet(version.path)
        point_to(spark, version, seen.get["dates"])
        clean(spark, output, dt.datetime.now(dt.UTC) - keep)

    return (
        arrived_files(paths)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(publish)
        .start()
    )


def _merged(flags: DataFrame) -> DataFrame:
    """One row per date; a flag only ever turns from false to true."""
    return flags.groupBy("business_date").agg(
        *[F.bool_or(f"has_{t}").alias(f"has_{t}") for t in REQUIRED]
    )


def current_flags(spark: SparkSession, output: str) -> DataFrame:
    """The flags as of the last batch; empty before the first."""
    version = current_versions(spark, output).get(_SLOT)
    return spark.read.schema(_FLAGS).parquet(version.path) if version else spark.createDataFrame([], _FLAGS)
