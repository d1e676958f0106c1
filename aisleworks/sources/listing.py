"""File listings as DataFrames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LISTING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modificationTime", T.TimestampType()),
    ]
)


def list_files(spark: SparkSession, root: str, pattern: str = "") -> DataFrame:
    """Every file below ``root``; file contents are never read.

    ``pattern`` is a glob for the names directly below ``root``, files or folders, and
    spares listing the others.  What does not exist yet lists as empty.
    """
    where = f"{root.rstrip('/')}/{pattern}"
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(where)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in (err.getCondition() or ""):
            raise
        return spark.createDataFrame([], LISTING)
    return files.select(*LISTING.names)
