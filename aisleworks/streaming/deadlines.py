"""Deadlines of business dates as a stream: which dates were complete in time, and which are overdue?

Everything is judged by when files were seen, not by when a batch got to them.  A date is known from the first event about
it, an announcement or a file, and keeps one small state until its deadline has passed; then the state goes, whatever
the date came to.  So the stream holds as many states as there are dates whose deadline is still ahead.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from aisleworks.operators.readiness import REQUIRED, manifest_of

EVENTS = "business_date date, table_name string, seen_at timestamp"
VERDICTS = "business_date date, status string, at timestamp, files_missing string"
COMPLETE, OVERDUE = "complete", "overdue"

_DAY = 86_400


def arrival_events(files: DataFrame) -> DataFrame:
    """Events of a stream of files (path, modificationTime).

    Files that are no manifest are events about no date: they only say that time has passed.
    """
    table, day = manifest_of(F.col("path"))
    return files.select(day.alias("business_date"), table.alias("table_name"), F.col("modificationTime").alias("seen_at"))


def announcements(days: DataFrame) -> DataFrame:
    """Events that make dates known before any of their files: seen as their day (UTC) begins."""
    start = F.timestamp_seconds(F.unix_date("business_date").cast("long") * _DAY)
    return days.select("business_date", F.lit(None).cast("string").alias("table_name"), start.alias("seen_at"))


def _judge(due_after: int, tables: tuple[str, ...]):
    """The function of one date's events and state; times are whole seconds since 1970."""

    def verdict(day: dt.date, status: str, at: int, missing: list[str]) -> pd.DataFrame:
        return pd.DataFrame({"business_date": [day], "status": [status], "at_s": [at], "files_missing": [",".join(missing)]})

    def judge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (day,) = key
        if day is None:
            return
        deadline = (day - dt.date(1970, 1, 1)).days * _DAY + due_after
        done, *first = state.get if state.exists else (False, *(None for _ in tables))
        if state.hasTimedOut:
            state.remove()
            if not done:
                yield verdict(day, OVERDUE, deadline, [t for t, seen in zip(tables, first) if seen is None])
            return
        on_time = False
        for batch in batches:
            for table, seen in zip(batch["table_name"], batch["seen_s"]):
                if pd.isna(seen) or seen > deadline:
                    continue
                on_time = True
                if table in tables:
                    place = tables.index(table)
                    first[place] = int(seen) if first[place] is None else min(first[place], int(seen))
        if not on_time and not state.exists:
            return  # the deadline's verdict, if there was one, has been given
        if not done and None not in first:
            done = True
            yield verdict(day, COMPLETE, max(first), [])
        state.update((done, *first))
        state.setTimeoutTimestamp(deadline * 1000)

    return judge


def judge_dates(events: DataFrame, due_after: dt.timedelta, out_of_order: str = "0 seconds") -> DataFrame:
    """The stream of verdicts, one per known date: ``complete`` when the last of its tables came in time, or ``overdue``.

    ``events`` is a stream of ``EVENTS``; those without ``seen_at`` count for nothing.  A date is due ``due_after`` after it begins (UTC).  A file counts if it was seen
    by then; seen twice it counts once.  ``complete`` comes at once, at the time the last table was first seen; ``overdue``
    comes when events have gone beyond the deadline by more than ``out_of_order``, the time by which an
    event may come after later ones; those still later are dropped.  Where files may stay away, let some other
    event pass time on: a rate source, or any file.
    """
    schema = "business_date date, status string, at_s long, files_missing string"
    state = ", ".join(["done boolean", *[f"{table} long" for table in REQUIRED]])
    judged = (
        events.withWatermark("seen_at", out_of_order)
        # Names the event time, or Spark would drop events about no date before it has taken their time.
        .where("seen_at IS NULL OR business_date IS NOT NULL")
        .withColumn("seen_s", F.unix_seconds("seen_at"))
        .groupBy("business_date")
        .applyInPandasWithState(
            _judge(int(due_after.total_seconds()), REQUIRED), schema, state, "append", GroupStateTimeout.EventTimeTimeout
        )
    )
    return judged.select("business_date", "status", F.timestamp_seconds("at_s").alias("at"), "files_missing")


def watch_deadlines(
    events: DataFrame, output: str, checkpoint: str, due_after: dt.timedelta, out_of_order: str = "0 seconds"
) -> StreamingQuery:
    """Append the verdicts to Parquet files at ``output``, each exactly once; take in all that is there, then stop."""
    return (
        judge_dates(events, due_after, out_of_order)
        .writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(output)
    )


def verdicts(spark: SparkSession, output: str) -> DataFrame:
    """All verdicts so far; the sink's own log keeps files of unfinished batches out."""
    return spark.read.schema(VERDICTS).parquet(output)
