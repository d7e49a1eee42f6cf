"""The first bytes of files, as a data source of its own.

The driver lists the folder that is read, and nothing else: sub-folders are
listed by the tasks, and a task opens its files and reads a few bytes of each,
so what is read grows with the number of files and never with their size. Empty
files are rows like all others.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Files that one task opens.
FILES_PER_TASK = 500


@dataclass
class Listing(InputPartition):
    """Files to open, or a folder to list first."""

    files: tuple[tuple[str, int], ...] = ()
    folder: str | None = None


def _store(uri: str):
    """The file system of a path and the path as that system names it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def hidden(path: str) -> bool:
    """Names that Spark's readers skip, too."""
    return path.rsplit("/", 1)[-1].startswith(("_", "."))


class PrefixReader(DataSourceReader):
    def __init__(self, uri: str, shown: str, glob: str | None, size: int):
        self.uri, self.shown, self.glob, self.size = uri, shown, glob, size

    def wanted(self, path: str) -> bool:
        name = path.rsplit("/", 1)[-1]
        return not hidden(name) and (self.glob is None or fnmatch.fnmatchcase(name, self.glob))

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, root = _store(self.uri)
        top = store.get_file_info(root)
        if top.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.shown)
        if top.type == fs.FileType.File:
            return [Listing(files=((top.path, top.size),))]
        entries = store.get_file_info(fs.FileSelector(root))
        files = sorted((e.path, e.size) for e in entries if e.type == fs.FileType.File and self.wanted(e.path))
        folders = sorted(e.path for e in entries if e.type == fs.FileType.Directory and not hidden(e.path))
        chunks = [files[i : i + FILES_PER_TASK] for i in range(0, len(files), FILES_PER_TASK)]
        found = [Listing(files=tuple(chunk)) for chunk in chunks] + [Listing(folder=f) for f in folders]
        return found or [Listing()]

    def files_of(self, store, part: Listing) -> Iterator[tuple[str, int]]:
        from pyarrow import fs

        yield from part.files
        folders = [part.folder] if part.folder is not None else []
        while folders:
            for entry in store.get_file_info(fs.FileSelector(folders.pop())):
                if entry.type == fs.FileType.Directory and not hidden(entry.path):
                    folders.append(entry.path)
                elif entry.type == fs.FileType.File and self.wanted(entry.path):
                    yield entry.path, entry.size

    def read(self, partition: Listing) -> Iterator[tuple]:
        store, root = _store(self.uri)
        for path, length in self.files_of(store, partition):
            with store.open_input_file(path) as file:
                start = file.read(self.size)
            inside = path.removeprefix(root.rstrip("/")).lstrip("/")
            shown = f"{self.shown.rstrip('/')}/{inside}" if inside else self.shown
            yield shown, length, bytes(start)


class FilePrefixes(DataSource):
    """``spark.read.format("file_prefix")`` with the options ``path``, ``uri``
    (the same place as a store's own address), ``glob`` and ``bytes``."""

    @classmethod
    def name(cls) -> str:
        return "file_prefix"

    def schema(self) -> str:
        return "path string, length long, prefix binary"

    def reader(self, schema) -> DataSourceReader:
        options = self.options
        return PrefixReader(
            options.get("uri") or options["path"], options["path"], options.get("glob"), int(options.get("bytes", "4"))
        )


# Addresses that the file systems of pyarrow open without further settings.
KNOWN_STORES = ("file", "s3", "gs", "gcs", "hdfs")


def store_address(spark: SparkSession, path: str) -> str | None:
    """The address of a path in its store, with the session's own names for
    stores resolved, or None if only Spark can open it. No file is read."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = files.resolvePath(at).toUri()
    scheme = {"s3a": "s3", "s3n": "s3"}.get(uri.getScheme(), uri.getScheme())
    if scheme not in KNOWN_STORES:
        return None
    authority = uri.getAuthority()
    return f"{scheme}://{authority or ''}{quote(uri.getPath())}"


def file_prefixes(spark: SparkSession, path: str, size: int, glob: str | None = None) -> DataFrame | None:
    """(path, length, prefix) of every file under ``path``; None if the store is
    one that only Spark can open."""
    uri = store_address(spark, path)
    if uri is None:
        return None
    spark.dataSource.register(FilePrefixes)
    reader = spark.read.format("file_prefix").option("path", path).option("uri", uri).option("bytes", str(size))
    if glob is not None:
        reader = reader.option("glob", glob)
    return reader.load()
