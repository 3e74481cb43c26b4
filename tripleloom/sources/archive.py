"""Python data source ``tar_members``: (file, value) of the text members of tar archives."""

from __future__ import annotations

import hashlib
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def open_path(path: str):
    """A file system and the path in it; a bare path is a local one."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def files(path: str) -> list[str]:
    """The file itself, or the files of a folder in the order of their names."""
    system, at = open_path(path)
    info = system.get_file_info(at)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [path]
    inside = system.get_file_info(fs.FileSelector(at))
    stem = path.rstrip("/")
    return sorted(f"{stem}/{x.base_name}" for x in inside if x.type == fs.FileType.File and not x.base_name.startswith((".", "_")))


def fingerprint(path: str) -> tuple[str, int]:
    """MD5 and size of a file, streamed."""
    digest, size = hashlib.md5(usedforsecurity=False), 0
    system, at = open_path(path)
    with system.open_input_stream(at) as f:
        while block := f.read(1 << 20):
            digest.update(block)
            size += len(block)
    return digest.hexdigest(), size


class _Archive(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.suffix = options["path"], options.get("suffix", "")

    def partitions(self) -> list[_Archive]:
        return [_Archive(x) for x in files(self.path)]

    def read(self, partition: _Archive) -> Iterator[pa.RecordBatch]:
        system, at = open_path(partition.path)
        names, texts, size = [], [], 0
        # without decompression by name: tarfile looks at the first bytes
        with system.open_input_stream(at, compression=None) as raw, tarfile.open(fileobj=raw, mode="r|*") as tar:
            for member in tar:
                if member.isfile() and member.name.endswith(self.suffix):
                    names.append(f"{partition.path}!{member.name}")
                    texts.append(tar.extractfile(member).read().decode("utf-8", "replace"))
                    size += member.size
                    if size > 8 << 20:
                        yield _batch(names, texts)
                        names, texts, size = [], [], 0
        if names:
            yield _batch(names, texts)


def _batch(names: list[str], texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], ["file", "value"])


class TarMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tar_members"

    def schema(self) -> str:
        return "file string, value string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TarMembers)
