"""Inventory of a folder: every file, empty ones too, listed on the executors.

The data source `file_inventory` plans by folders: a few levels are opened while it plans, until
there are enough folders to go round, and each task lists what lies below some of them. So the
driver sees the upper folders of a tree and never the files below. Folders are read through
pyarrow's file systems (local and mounted paths, s3, gs, hdfs); where an address is known to Spark's
readers alone, `list_files` asks Hadoop's listing instead.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "file_inventory"
SCHEMA = "path string, kind string, length bigint, modified timestamp"
FOLDERS = 64  # planning opens folders until there are this many to list
# Schemes that pyarrow opens on an executor (fixed values).
OPENED = ("", "file", "s3", "gs", "hdfs")


def opened(path: str):
    """-> file system, path within it, what to put before a path to get its address."""
    from pyarrow import fs

    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path) if parts.scheme else path, "file://"
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner, f"{parts.scheme}://{parts.netloc}" if parts.scheme == "hdfs" else f"{parts.scheme}://"


LINE_ROWS = 10_000


def lines_of_files(batches: Iterator) -> Iterator:
    """Batches of paths -> batches of value, file_path: the lines of each file, read as a stream."""
    import pyarrow as pa

    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, inner, before = opened(path)
            with system.open_input_stream(inner, buffer_size=1 << 20) as stream:
                rest = b""
                while True:
                    block = stream.read(1 << 20)
                    *lines, rest = (rest + bytes(block)).split(b"\n")
                    if not block:
                        lines = [rest] if rest else []
                    for i in range(0, len(lines), LINE_ROWS):
                        part = [x.removesuffix(b"\r").decode(errors="replace") for x in lines[i : i + LINE_ROWS]]
                        names = pa.array([f"{before}{inner}"] * len(part))
                        yield pa.RecordBatch.from_arrays([pa.array(part), names], names=["value", "file_path"])
                    if not block:
                        break


class _Folders(InputPartition):
    """Folders to list with all below them, and rows of files met while planning."""

    def __init__(self, folders: list[str], rows: list[tuple]) -> None:
        super().__init__(None)
        self.folders, self.rows = folders, rows


def _hidden(name: str) -> bool:
    """Whether Spark's readers pass over a name, as they do over markers and unfinished writes."""
    return name.startswith((".", "_"))


class InventoryReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options.get("path", "")
        self.recursive = options.get("recursive", "false").lower() == "true"
        self.directories = options.get("directories", "false").lower() == "true"
        self.hidden = options.get("hidden", "false").lower() == "true"
        if not self.path:
            raise ValueError("file_inventory needs a path")

    def _entries(self, system, folder: str, before: str) -> tuple[list[str], list[tuple]]:
        """-> folders within a folder, and the rows of what it holds."""
        from pyarrow import fs

        below, rows = [], []
        for info in system.get_file_info(fs.FileSelector(folder)):
            if not self.hidden and _hidden(info.base_name):
                continue
            is_folder = info.type == fs.FileType.Directory
            if is_folder:
                below.append(info.path)
            if not is_folder or self.directories:
                kind = "directory" if is_folder else "file"
                rows.append((f"{before}{info.path}", kind, 0 if is_folder else info.size, info.mtime))
        return below, rows

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, inner, before = opened(self.path)
        top = system.get_file_info(inner)
        if top.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if top.type == fs.FileType.File:
            return [_Folders([], [(f"{before}{top.path}", "file", top.size, top.mtime)])]
        if not self.recursive:
            return [_Folders([], self._entries(system, inner, before)[1])]
        folders, rows = [inner], []
        while folders and len(folders) < FOLDERS:
            deeper = []
            for folder in folders:
                below, met = self._entries(system, folder, before)
                deeper += below
                rows += met
            folders = deeper
        share = max(1, len(folders) // (4 * FOLDERS))
        parts = [_Folders(folders[i : i + share], []) for i in range(0, len(folders), share)]
        return [_Folders([], rows), *parts]

    def read(self, partition: _Folders) -> Iterator[tuple]:
        yield from partition.rows
        if not partition.folders:
            return
        system, _, before = opened(self.path)
        todo = list(partition.folders)
        while todo:
            below, rows = self._entries(system, todo.pop(), before)
            todo += below
            yield from rows


class FileInventory(DataSource):
    """`spark.read.format("file_inventory").option("recursive", True).load(folder)`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> InventoryReader:
        return InventoryReader(self.options)


def file_inventory(
    spark: SparkSession,
    path: str,
    recursive: bool = True,
    directories: bool = False,
    hidden: bool = False,
) -> DataFrame:
    """-> path, kind, length, modified of every file of a folder, empty ones too.

    `recursive` takes all folders below; `directories` lists these as well, with length 0; `hidden`
    lists names that begin with a dot or an underscore and what lies below them. A path to a file is
    that file alone; one to nothing is an error. Contents are not read.
    """
    spark.dataSource.register(FileInventory)
    reader = spark.read.format(FORMAT)
    for name, value in (("recursive", recursive), ("directories", directories), ("hidden", hidden)):
        reader = reader.option(name, str(value).lower())
    return reader.load(path)


def hadoop_inventory(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """The same rows for addresses that only Hadoop's file systems open; each file passes the driver."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, recursive)
    above = len(root.toUri().getPath().rstrip("/").split("/"))
    rows = []
    while found.hasNext():
        status = found.next()
        names = status.getPath().toUri().getPath().split("/")[above:]
        if not any(map(_hidden, names)):
            rows.append((status.getPath().toString(), "file", status.getLen(), status.getModificationTime()))
    listed = spark.createDataFrame(rows, "path string, kind string, length bigint, ms bigint")
    return listed.selectExpr("path", "kind", "length", "timestamp_millis(ms) AS modified")


# Executors get this module with their tasks, so they need not find it on their own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
