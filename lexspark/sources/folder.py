"""A folder of deliveries as a stream in the order of file names: package files by line, ZIP archives by member.

`FolderSource` is a Python data source. A stream's offset is the name of the last file taken, so that a batch, repeated after
a restart, has the same files; each file is one partition, read piece by piece. Files whose names come before the offset
(late ones) are none of the stream: `later_than` and a log tell them.
"""

from __future__ import annotations

import fnmatch
import io
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from lexspark.sources import zips

LINES = "package string, line_no long, body string"
NAMES = "package string, bytes long"
PIECE = 4_096


def listed(folder: str, glob: str) -> list[tuple[str, int]]:
    """Names (paths below the folder) and sizes of its files whose own names match, in the order of names; hidden ones are left out."""
    system, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    base = base.rstrip("/")
    found = system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
    own = lambda path: path[len(base) :].lstrip("/")
    return sorted((own(f.path), f.size) for f in found if f.is_file and fnmatch.fnmatchcase(f.base_name, glob) and not any(p.startswith((".", "_")) for p in own(f.path).split("/")))


def opened(folder: str, name: str) -> pa.NativeFile:
    system, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    return system.open_input_file(f"{base.rstrip('/')}/{name}")


def lines_of(folder: str, name: str) -> Iterator[pa.RecordBatch]:
    """Numbered lines of a file, PIECE at a time."""
    numbers, held = [], []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.repeat(name, len(held)), pa.array(numbers, pa.int64()), pa.array(held, pa.string())], ["package", "line_no", "body"])

    with io.BufferedReader(opened(folder, name), 1 << 20) as f:
        for n, line in enumerate(f, 1):
            numbers.append(n)
            held.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
            if len(held) == PIECE:
                yield batch()
                numbers, held = [], []
    if held:
        yield batch()


class _File(InputPartition):
    def __init__(self, name: str, size: int):
        self.name, self.size = name, size


class FolderSource(DataSource):
    """Options: path, glob, rows (lines, names, or members: files in ZIP archives), and for batches later_than, a name."""

    @classmethod
    def name(cls) -> str:
        return "lexspark_folder"

    def schema(self) -> str:
        return {"lines": LINES, "names": NAMES, "members": zips.SCHEMA}[self.options.get("rows", "lines")]

    def reader(self, schema) -> FolderReader:
        return FolderReader(self.options)

    def streamReader(self, schema) -> FolderStream:
        return FolderStream(self.options)


class _Files:
    def __init__(self, options: dict[str, str]):
        self.folder, self.rows = options["path"], options.get("rows", "lines")
        self.glob = options.get("glob", "*.zip" if self.rows == "members" else "*.jsonl")
        self.after = options.get("later_than", "")

    def between(self, after: str, last: str | None = None) -> list[_File]:
        return [_File(n, size) for n, size in listed(self.folder, self.glob) if n > after and (last is None or n <= last)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if self.rows == "names":
            yield pa.RecordBatch.from_arrays([pa.array([partition.name]), pa.array([partition.size], pa.int64())], ["package", "bytes"])
        elif self.rows == "members":
            with opened(self.folder, partition.name) as f:
                yield from zips.rows_of(partition.name, f, partition.size)
        else:
            yield from lines_of(self.folder, partition.name)


class FolderReader(_Files, DataSourceReader):
    def partitions(self) -> list[_File]:
        return self.between(self.after)


class FolderStream(_Files, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"last": self.after}

    def latestOffset(self) -> dict:
        found = self.between(self.after)
        return {"last": max((f.name for f in found), default=self.after)}

    def partitions(self, start: dict, end: dict) -> list[_File]:
        return self.between(start["last"], end["last"])
