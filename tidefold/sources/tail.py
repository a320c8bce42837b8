"""A streaming source that follows growing files.

The offset maps each path to its inode and byte position. A batch reads the complete lines between
two offsets; a file that was replaced or truncated is read from its beginning; vanished files leave the
offset. An unfinished last line waits for its end.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .files import discover

FORMAT = "tidefold_tail"


class FilePart(InputPartition):
    def __init__(self, path: str, start: int, end: int, rank: int) -> None:
        self.path, self.start, self.end, self.rank = path, start, end, rank


def complete_end(path: str, start: int, size: int, step: int = 1 << 16) -> int:
    """Position after the last line end in [start, size), or start."""
    with open(path, "rb") as f:
        at = size
        while at > start:
            low = max(start, at - step)
            f.seek(low)
            found = f.read(at - low).rfind(b"\n")
            if found >= 0:
                return low + found + 1
            at = low
    return start


def next_end(path: str, start: int, size: int, step: int = 1 << 16) -> int | None:
    """Position after the first line end in [start, size), or None."""
    with open(path, "rb") as f:
        f.seek(start)
        at = start
        while at < size:
            part = f.read(min(step, size - at))
            if (found := part.find(b"\n")) >= 0:
                return at + found + 1
            at += len(part) or size
    return None


def flush_threshold(low: int, initial: int, high: int, backlog: int, capacity: int) -> int:
    """Batch size by backlog: the largest when idle, ``initial`` half full, the smallest when full; linear between."""
    low = max(low, 1)
    initial = max(initial if initial > 0 else low, low)
    high = max(high if high > 0 else initial, initial)
    if capacity <= 0 or backlog <= 0:
        return high
    r = backlog / capacity
    if r >= 1:
        return low
    a, b, t = (high, initial, r / 0.5) if r <= 0.5 else (initial, low, (r - 0.5) / 0.5)
    return int(a + (b - a) * t)


class TailReader(DataSourceStreamReader):
    """``limit`` is what a batch takes of a file at most; less when files hold much that is unread, down to a 64th."""

    def __init__(self, patterns: list[str], limit: int) -> None:
        self.patterns, self.limit, self.known = patterns, limit, {}

    def initialOffset(self) -> dict:
        return {"files": "{}", "epoch": "0"}

    def latestOffset(self) -> dict:
        files, found = {}, {}
        for path in discover(self.patterns):
            try:
                stat = os.stat(path)
            except OSError:
                continue
            inode, position = self.known.get(path, (stat.st_ino, 0))
            found[path] = stat, 0 if inode != stat.st_ino or stat.st_size < position else position
        unread = sum(stat.st_size - position for stat, position in found.values())
        limit = flush_threshold(self.limit >> 6, self.limit >> 2, self.limit, unread, 64 * self.limit * max(1, len(found)))
        for path, (stat, position) in found.items():
            size = min(stat.st_size, position + limit)
            end = complete_end(path, position, size)
            if end == position and size < stat.st_size:  # a line longer than the limit
                end = next_end(path, size, stat.st_size) or position
            files[path] = (stat.st_ino, end)
        self.known = files
        return {"files": json.dumps(files, sort_keys=True), "epoch": "0"}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        before, after = json.loads(start["files"]), json.loads(end["files"])
        self.known = {p: tuple(v) for p, v in after.items()} if not self.known else self.known
        parts = []
        for rank, (path, (inode, stop)) in enumerate(sorted(after.items())):
            old_inode, position = before.get(path, (inode, 0))
            position = position if old_inode == inode and position <= stop else 0
            if stop > position:
                parts.append(FilePart(path, position, stop, rank))
        return parts

    def read(self, part: FilePart) -> Iterator[tuple[str, str, int]]:
        with open(part.path, "rb") as f:
            f.seek(part.start)
            at = part.start
            for raw in f.read(part.end - part.start).split(b"\n"):  # a lone carriage return ends no line
                line = raw.removesuffix(b"\r").decode("utf-8", "replace")
                if line:
                    yield line, part.path, at
                at += len(raw) + 1

    def commit(self, end: dict) -> None:
        pass


class TailSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "line string, file string, at long"

    def streamReader(self, schema) -> TailReader:
        return TailReader(json.loads(self.options["patterns"]), int(self.options.get("maxbytesperfile", 64 << 20)))


def tail(spark: SparkSession, patterns: list[str], max_bytes_per_file: int = 64 << 20):
    """Streaming (line, file, at) of all files that match the patterns."""
    spark.dataSource.register(TailSource)
    return spark.readStream.format(FORMAT).option("patterns", json.dumps(patterns)).option("maxbytesperfile", max_bytes_per_file).load()
