"""Listings of large trees as a data source: executors list, the driver only names the prefixes."""

from __future__ import annotations

import json
from collections.abc import Sequence
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from aisleworks.sources.listing import LISTING, list_files

#: Stores that Python workers can list themselves, by the scheme of a path; "" and "file" are the local one.
SCHEMES = ("", "file", "hdfs", "s3", "s3a", "s3n", "gs", "gcs", "abfs", "abfss")
#: Rows that a worker hands over at a time.
BATCH_ROWS = 10_000


def _data_source() -> type[DataSource]:
    """The source's class, made here so that it travels to the workers by value, without this package."""
    rows_at_once, fields = BATCH_ROWS, LISTING

    class Below(InputPartition):
        """One prefix with all below it, or the files that lie directly in the root."""

        def __init__(self, path: str, whole: bool):
            self.path, self.whole = path, whole

    class Reader(DataSourceReader):
        def __init__(self, root: str, prefixes: list[str] | None):
            self.root, self.prefixes = root, prefixes

        def store(self):
            """(file system, path in it, what Spark puts before such a path)."""
            from pyarrow import fs

            scheme, host, path, *_ = urlsplit(self.root)
            if scheme in ("", "file"):
                return fs.LocalFileSystem(), path.rstrip("/") or "/", "file:"
            plain = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}.get(scheme, scheme)
            store, inner = fs.FileSystem.from_uri(f"{plain}://{host}{path}")
            before = f"{scheme}://" if plain in ("s3", "gs") else f"{scheme}://{host}"
            return store, inner.rstrip("/"), before

        def entries(self, store, path: str):
            """Entries of one folder but those that Spark does not list; none if it does not exist."""
            from pyarrow import fs

            for entry in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                hidden = entry.base_name.startswith(".") or (entry.base_name.startswith("_") and "=" not in entry.base_name)
                if not hidden:
                    yield entry, entry.type == fs.FileType.Directory

        def partitions(self):
            store, root, _ = self.store()
            names = self.prefixes
            if names is None:
                names = [entry.base_name for entry, folder in self.entries(store, root) if folder]
            return [Below(root, False), *(Below(f"{root}/{name}", True) for name in names)]

        def read(self, partition):
            import pyarrow as pa

            store, _, before = self.store()
            kept = []

            def batch():
                paths, lengths, times = zip(*kept)
                kept.clear()
                return pa.RecordBatch.from_arrays(
                    [pa.array(paths, pa.string()), pa.array(lengths, pa.int64()), pa.array(times, pa.timestamp("us", tz="UTC"))],
                    names=["path", "length", "modificationTime"],
                )

            waiting = [partition.path]
            while waiting:
                for entry, folder in self.entries(store, waiting.pop()):
                    if folder and partition.whole:
                        waiting.append(entry.path)
                    elif not folder:
                        kept.append((before + entry.path, entry.size, entry.mtime))
                        if len(kept) >= rows_at_once:
                            yield batch()
            if kept:
                yield batch()

    class FileTree(DataSource):
        @classmethod
        def name(cls) -> str:
            return "aisleworks_file_tree"

        def schema(self) -> StructType:
            return fields

        def reader(self, schema: StructType) -> DataSourceReader:
            import json

            prefixes = self.options.get("prefixes")
            return Reader(self.options["root"], json.loads(prefixes) if prefixes else None)

    return FileTree


def list_tree(spark: SparkSession, root: str, prefixes: Sequence[str] | None = None) -> DataFrame:
    """What ``list_files`` gives for all below ``root``, listed by a task per folder in it.

    A worker holds one folder's entries at a time and the driver the names of the folders directly in ``root``, or
    ``prefixes`` if the caller knows them.  A store that Python cannot reach is listed by Spark's own index, which
    the driver holds.  What does not exist lists as empty.
    """
    if urlsplit(root).scheme not in SCHEMES:
        return list_files(spark, root)
    source = _data_source()
    spark.dataSource.register(source)
    reader = spark.read.format(source.name()).option("root", root)
    if prefixes is not None:
        reader = reader.option("prefixes", json.dumps(list(prefixes)))
    return reader.load()
