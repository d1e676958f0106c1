"""Session settings for runs that do not already have a session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str, master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution on and the time zone pinned to UTC.

    On a cluster ``master`` comes from spark-submit.  Shuffle partitions are only
    an upper bound there: adaptive execution merges small ones, so set
    ``spark.sql.shuffle.partitions`` high (several per core).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split a hot key's join even where the next step must then shuffle again.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def require_ansi(spark: SparkSession) -> None:
    """Refuse a session in which bad text and overflow become NULL instead of failing."""
    if spark.conf.get("spark.sql.ansi.enabled").lower() != "true":
        raise RuntimeError("set spark.sql.ansi.enabled to true: strict reads and sums rely on it")
