"""Helpers that several corpus operators use."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleworks.scratch import scratch_path

#: Words of a text, as every operator counts them: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the folder of ``spark.checkpoint.dir``, which driver and executors share; nothing else uses it."""
    return scratch_path(spark, f"corpus-{label}")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written as Parquet to the shared folder and read back.

    Cuts the lineage: what follows reads files that survive lost executors, and
    a result that several readers use is computed once.
    """
    path = new_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def lookup(
    rows: DataFrame, table: DataFrame, on: list[str], spread: Column, how: str = "left", salts: int = 32
) -> DataFrame:
    """``rows`` joined with ``table`` on ``on``, where one key may hold a third of ``rows``.

    Each key of ``rows`` is dealt over ``salts`` tasks by the hash of ``spread``; each row of
    ``table``, which should hold only keys that can match and each of them once, is
    repeated ``salts`` times.  NULL keys match nothing.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def only(frame: DataFrame, **columns: str) -> DataFrame:
    """The named columns alone, cast to the given types, so extra columns cannot clash."""
    return frame.select(*(frame[name].cast(kind).alias(name) for name, kind in columns.items()))


def once(name: str, make: Callable[[], Any]) -> Any:
    """``make()``, made once in this Python process: a worker keeps it from task to task.

    Functions travel by value, so their modules' globals are new in every task; this is not.
    """
    kept = sys.modules.setdefault("corpus_worker_memory", types.ModuleType("corpus_worker_memory"))
    if name not in vars(kept):
        vars(kept)[name] = make()
    return vars(kept)[name]
