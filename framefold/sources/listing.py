"""Object listings read by the executors: one partition per folder, no file status on the driver."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

# Workers need not be able to import this package: what they run is sent by value.
register_pickle_by_value(sys.modules[__name__])

BATCH = 10_000


@dataclass
class Folder(InputPartition):
    """A folder below the root, with everything in it or its own objects only."""

    path: str
    deep: bool


def _entries(store: fs.FileSystem, path: str) -> list[fs.FileInfo]:
    """Objects and folders in one folder; none where it is absent."""
    return store.get_file_info(fs.FileSelector(path, allow_not_found=True))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"].rstrip("/")
        self.folder = options.get("folder", "")
        self.depth = int(options.get("depth", "2"))

    def _open(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.root)

    def partitions(self) -> list[Folder]:
        """The folders ``depth`` levels below the prefix, and those above them without what lies deeper."""
        store, base = self._open()
        level, found = [f"{base}/{self.folder}".rstrip("/")], []
        for _ in range(self.depth):
            found += [Folder(path, False) for path in level]
            level = [e.path for path in level for e in _entries(store, path) if e.type == fs.FileType.Directory]
        return found + [Folder(path, True) for path in level]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        store, base = self._open()
        waiting = [partition.path]
        while waiting:
            entries = _entries(store, waiting.pop())
            if partition.deep:
                waiting += [e.path for e in entries if e.type == fs.FileType.Directory]
            files = [e for e in entries if e.type == fs.FileType.File]
            for k in range(0, len(files), BATCH):
                some = files[k : k + BATCH]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([e.path[len(base) :].lstrip("/") for e in some], pa.string()),
                        pa.array([e.size for e in some], pa.int64()),
                        pa.array([e.mtime for e in some], pa.timestamp("us", tz="UTC")),
                    ],
                    names=["key", "length", "modified"],
                )


class ObjectListing(DataSource):
    """``key`` below the root, ``length`` and ``modified`` of every object; contents are not read.

    Options: ``path`` (the root, as a folder or a URI that Arrow opens), ``folder`` below it and ``depth``. The driver
    sees the folders of the first ``depth`` levels only; each task walks its folder level by level.
    """

    @classmethod
    def name(cls) -> str:
        return "object_listing"

    def schema(self) -> str:
        return "key string, length bigint, modified timestamp"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))
