"""Files that grow, as a stream: each complete line once, from the byte where the last batch ended."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes that one task reads, of a look back for the last line's end, and of a file's beginning by which it is known.
CHUNK, LOOK, HEAD = 64 << 20, 1 << 16, 64


class Piece(InputPartition):
    def __init__(self, path: str, start: int, first: int, last: int, end: int):
        self.path, self.start, self.first, self.last, self.end = path, start, first, last, end


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, suffix: str, chunk: int):
        self.files, self.root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        self.suffix, self.chunk = suffix, chunk

    def _found(self) -> Iterator[fs.FileInfo]:
        info = self.files.get_file_info(self.root)
        some = self.files.get_file_info(fs.FileSelector(self.root, recursive=True)) if info.type == fs.FileType.Directory else [info]
        return (f for f in some if f.type == fs.FileType.File and f.path.endswith(self.suffix))

    def _end(self, f, size: int) -> int:
        """The byte after the last line end, 0 if there is none: a line that is still being written waits."""
        at = size
        while at > 0:
            first = max(0, at - LOOK)
            f.seek(first)
            found = f.read(at - first).rfind(b"\n")
            if found >= 0:
                return first + found + 1
            at = first
        return 0

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        out = {}
        for info in self._found():
            with self.files.open_input_file(info.path) as f:
                end = self._end(f, f.size())
                f.seek(0)
                out[info.path] = [end, base64.b64encode(f.read(min(HEAD, end))).decode()]
        return {"files": json.dumps(out, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        before, out = json.loads(start["files"]), []
        for path, (last, head) in json.loads(end["files"]).items():
            at, known = before.get(path, [0, ""])
            # shorter than before, or with another beginning: it was cut off or replaced, and begins anew
            if last < at or not base64.b64decode(head).startswith(base64.b64decode(known)):
                at = 0
            out += [Piece(path, at, i, min(i + self.chunk, last), last) for i in range(at, last, self.chunk)]
        return out

    def read(self, partition: Piece) -> Iterator[tuple]:
        """The lines that begin in the bytes first to last - 1 of what is new."""
        with self.files.open_input_file(partition.path) as f:
            at = partition.first
            if at > partition.start:  # the line that runs into these bytes belongs to the task before
                f.seek(at - 1)
                at += len(self._line(f, partition.end)) - 1
            f.seek(at)
            while at < partition.last:
                line = self._line(f, partition.end)
                if not line:
                    return
                text = line.rstrip(b"\n").rstrip(b"\r")
                if text:
                    yield partition.path, at, text.decode("utf-8", "replace")
                at += len(line)

    def _line(self, f, end: int) -> bytes:
        out = b""
        while not out.endswith(b"\n") and f.tell() < end:
            at = f.tell()
            block = f.read(min(LOOK, end - at))
            stop = block.find(b"\n") + 1
            out += block[:stop] if stop else block
            if stop:
                f.seek(at + stop)
            elif not block:
                break
        return out

    def commit(self, end: dict) -> None:
        pass


class GrowingLines(DataSource):
    """Options: path (a file, or a folder with its subfolders), suffix (of the files in it), chunk (bytes a task)."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "path string, position long, line string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options["path"], self.options.get("suffix", ""), int(self.options.get("chunk", CHUNK)))


def growing_lines(spark: SparkSession, path: str, suffix: str = "", chunk: int = CHUNK) -> DataFrame:
    """STM-1: path, position (its first byte) and line of each line as it is completed, empty ones left out.

    A trigger reads what was appended since the last one, and no more. A last line without its end waits until it is
    complete. A file that is shorter than what was read, or begins otherwise, is read again from its first byte; one
    that disappears keeps nothing. Offsets are in the checkpoint of the query: after a restart it goes on where it
    was. Bytes that are no UTF-8 are replaced. Any number of tasks share what is new of one file, `chunk` bytes each.
    """
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format("growing_lines").option("path", path).option("suffix", suffix).option("chunk", str(chunk)).load()
