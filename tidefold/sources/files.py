"""Line sources: lists, readers, and files named by patterns."""

from __future__ import annotations

import glob
import logging
import os
import re
from collections.abc import Iterable, Iterator
from typing import TextIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import running_total

LOG = logging.getLogger(__name__)
#: A reader stops at a longer line.
MAX_LINE = 1 << 20


def from_lines(spark: SparkSession, lines: Iterable[str], first: int = 1) -> DataFrame:
    """(line, seq) of the lines that aren't empty."""
    rows = [(x, first + i) for i, x in enumerate(x for x in lines if x)]
    return spark.createDataFrame(rows, "line string, seq long")


def from_reader(spark: SparkSession, reader: TextIO) -> DataFrame:
    """Lines up to the end, or to the first line over MAX_LINE bytes, which ends the reading with a warning."""
    return from_lines(spark, read_lines(reader))


def read_lines(reader: TextIO) -> Iterator[str]:
    for n, line in enumerate(reader, 1):
        line = line.rstrip("\r\n")
        if len(line) > MAX_LINE or len(line.encode()) > MAX_LINE:
            LOG.warning("line %d is longer than %d bytes; reading ends before it", n, MAX_LINE)
            return
        yield line


def from_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(line, seq) of text files below a path; the order is by file name, then place in the file.

    The sequence number is the row's place in its file after the bytes of all files before, so it stays
    the same on a rerun.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    lines = reader.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
    )
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("start"), F.first("size").alias("size"))
    files = running_total(blocks.groupBy("file").agg(F.first("size").alias("size")), "file", F.col("size") + 1, "before")
    keyed = lines.join(blocks.drop("size"), ["file", "block"]).join(files.drop("size"), "file")
    # a block of a file starts at its byte offset, which is more than the number of lines before it
    return keyed.where("line <> ''").select("line", (F.col("before") + F.col("block") + F.col("at") - F.col("start") + 1).alias("seq"))


def walk_root(pattern: str) -> str:
    """The folder before the first part of a pattern that has a metacharacter."""
    parts = pattern.split("/")
    plain = next((i for i, p in enumerate(parts) if re.search(r"[*?\[]", p)), len(parts) - 1)
    return "/".join(parts[:plain]) or ("/" if pattern.startswith("/") else ".")


def discover(patterns: Iterable[str]) -> list[str]:
    """Files that match any pattern (``*``, ``**``, ``?``, ``[..]``), each once, sorted."""
    known = [p for p in map(normal_path, patterns) if os.path.isdir(walk_root(p))]
    return sorted({f for p in known for f in glob.glob(p, recursive=True)})


def normal_path(path: str) -> str:
    """Forward slashes; a drive letter, or a drive mounted under /mnt, as ``/c/``."""
    path = path.replace("\\", "/")
    if m := re.match(r"(?:([A-Za-z]):/|/mnt/([A-Za-z])/)(.*)", path):
        return f"/{(m[1] or m[2]).lower()}/{m[3]}"
    return path

