"""What lies in a folder, found by the executors: the driver holds no names, and tasks don't grow with the files."""

from __future__ import annotations

import fnmatch
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..shared import written

BATCH = 10_000


def mounted(root: str) -> str | None:
    """root as a path that Python can open; None if it isn't a folder that is mounted here."""
    path = "/" + root.removeprefix("file:").lstrip("/") if root.startswith("file:") else root
    return os.path.abspath(path) if os.path.isdir(path) else None


def walk(root: str, glob: str, recursive: bool) -> Iterator[str]:
    """Files by name pattern, folder by folder as they are read; hidden files and folders (and folders named _*) are passed over."""
    waiting = [root]
    while waiting:
        with os.scandir(waiting.pop()) as found:
            for e in found:
                if e.name.startswith("."):
                    continue
                if e.is_dir():
                    if recursive and not e.name.startswith("_"):
                        waiting.append(e.path)
                elif fnmatch.fnmatchcase(e.name, glob):
                    yield e.path


def _paths(spark: SparkSession, root: str, glob: str, recursive: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            held: list[str] = []
            for path in walk(root, glob, recursive):
                held.append(path)
                if len(held) == BATCH:
                    yield pa.RecordBatch.from_pydict({"path": held})
                    held = []
            yield pa.RecordBatch.from_pydict({"path": pa.array(held, pa.string())})

    return spark.range(0, 1, 1, 1).mapInArrow(run, "path string")


def paths(spark: SparkSession, root: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """(path) of the files in a mounted folder, or below it, as they are now."""
    return written(_paths(spark, root, glob, recursive), "listing")


def stats(spark: SparkSession, root: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """(path, modificationTime, length) of the files that aren't empty, as they are now."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for path in b.column(0).to_pylist():
                try:
                    found = os.stat(path)
                except FileNotFoundError:  # gone since its folder was read
                    continue
                if found.st_size:
                    rows.append((path, found.st_mtime_ns // 1_000_000, found.st_size))
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))], ["path", "ms", "length"])

    found = _paths(spark, root, glob, recursive).repartition("path").mapInArrow(run, "path string, ms long, length long")
    return written(found.selectExpr("path", "timestamp_millis(ms) AS modificationTime", "length"), "listing")
