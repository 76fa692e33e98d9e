"""A Python data source of files: one row for each file below a path, whatever its format.

The folders of the first level make the partitions, so prefixes are listed side by side by the
executors and no file name passes through the driver. Files of size 0 are listed like any
other, with their time. On request the first line of each file is read as a CSV header, and nothing after it.
"""

from __future__ import annotations

import csv
import fnmatch
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "millrace_files"
LISTED = "path string, size bigint, last_modified timestamp"
HEADED = f"{LISTED}, names array<string>"
BLOCK = 1 << 16  # bytes read at a time in search of the end of a first line
LONGEST_LINE = 1 << 24


def _opened(path: str):
    """The file system of a path, and the path on it."""
    from pyarrow import fs

    scheme, found, rest = path.partition(":/")
    if not found:
        return fs.LocalFileSystem(), path.rstrip("/") or "/"
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.strip("/")
    return fs.FileSystem.from_uri(f"{scheme.replace('s3a', 's3')}://{rest.lstrip('/')}")


@dataclass
class Prefix(InputPartition):
    """A folder, with all below it or only its own files."""

    folder: str
    deep: bool


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


class FileReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.pattern = options.get("pattern", "*")
        self.header = options.get("header", "false") == "true"
        self.hidden = options.get("hidden", "false") == "true"

    def _children(self, files, folder: str):
        from pyarrow import fs

        for info in files.get_file_info(fs.FileSelector(folder)):
            if self.hidden or not _hidden(info.base_name):
                yield info, info.type == fs.FileType.Directory

    def partitions(self) -> list[Prefix]:
        from pyarrow import fs

        files, top = _opened(self.path)
        if files.get_file_info(top).type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        folders = [info.path for info, is_folder in self._children(files, top) if is_folder]
        return [Prefix(top, False), *(Prefix(folder, True) for folder in sorted(folders))]

    def _names(self, files, path: str) -> list[str]:
        data = b""
        with files.open_input_stream(path) as stream:
            while b"\n" not in data and len(data) < LONGEST_LINE and (more := stream.read(BLOCK)):
                data += more
        line = data.split(b"\n", 1)[0].removeprefix(b"\xef\xbb\xbf").rstrip(b"\r")
        names = next(csv.reader([line.decode("utf-8", "replace")]), [])
        if len(set(names)) < len(names):
            raise ValueError(f"{path}: a column name is there twice")
        return names

    def read(self, partition: Prefix) -> Iterator[tuple]:
        files, _ = _opened(self.path)
        waiting = [partition.folder]
        while waiting:  # a folder at a time
            for info, is_folder in self._children(files, waiting.pop()):
                if is_folder:
                    if partition.deep:
                        waiting.append(info.path)
                elif fnmatch.fnmatch(info.base_name, self.pattern):
                    path = info.path if info.path.startswith("/") else f"/{info.path}"
                    row = (path, info.size, info.mtime)
                    yield (*row, self._names(files, info.path)) if self.header else row


class FileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return HEADED if self.options.get("header", "false") == "true" else LISTED

    def reader(self, schema) -> FileReader:
        return FileReader(dict(self.options))


def files(spark: SparkSession, path: str, pattern: str = "*", *, hidden: bool = False, header: bool = False) -> DataFrame:
    """``path`` (without scheme), ``size`` and ``last_modified`` of all files below ``path``, and
    the ``names`` of their CSV ``header`` if wanted. Names that begin with ``_`` or ``.`` are left out unless
    ``hidden``."""
    spark.dataSource.register(FileSource)
    return (
        spark.read.format(NAME)
        .option("path", path)
        .option("pattern", pattern)
        .option("hidden", str(hidden).lower())
        .option("header", str(header).lower())
        .load()
    )
