"""Where jobs put tables that must outlive a lost executor."""

from __future__ import annotations

import re
import uuid

from pyspark import SparkFiles
from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str, root: str | None = None) -> str:
    """A new folder under ``root`` or the shared folder named by ``spark.checkpoint.dir``.

    A cluster session that names neither is refused.  In local mode, where driver
    and executors are one process, the session's own folder serves; Spark removes
    it when the session ends.
    """
    base = root or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = SparkFiles.getRootDirectory()
    return f"{base.rstrip('/')}/aisleworks-{label}-{uuid.uuid4().hex}"
