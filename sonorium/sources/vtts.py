"""Subtitle files: one document a file."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.texts import stem
from ..operators.subtitle import parse
from ..shared import spread
from . import listing

HELD = 4_000_000  # characters of text that are passed on at once


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, vtt): stem and whole text of each file of a folder that isn't empty, as listed now.

    A folder that is mounted is listed and read by the executors, many files a task; what is elsewhere, by Spark.
    """
    root = listing.mounted(path)
    if root is None:
        found = spark.read.option("pathGlobFilter", "*.vtt").text(path, wholetext=True)
        return found.select(stem(F.input_file_name()).alias("file"), F.col("value").alias("vtt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths, docs, held = [], [], 0
            for p in b.column(0).to_pylist():
                with open(p, "rb") as f:
                    doc = f.read().decode("utf-8", "replace")
                if doc:
                    paths.append(p)
                    docs.append(doc)
                    held += len(doc)
                if held > HELD:
                    yield pa.RecordBatch.from_pydict({"path": paths, "vtt": docs})
                    paths, docs, held = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(docs, pa.string())], ["path", "vtt"])

    found = spread(listing.paths(spark, root, "*.vtt"), "path").mapInArrow(run, "path string, vtt string")
    return found.select(stem(F.col("path")).alias("file"), "vtt")


def read_cues(spark: SparkSession, path: str) -> DataFrame:
    return parse(read_documents(spark, path), "file")


def write_documents(rendered: DataFrame, folder: str, key: str = "file") -> DataFrame:
    """(file, bytes): writes <file>.vtt of each row into a folder that all executors share, by rename."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for f in frames:
            sizes = []
            for name, vtt in zip(f[key], f["vtt"]):
                target = os.path.join(folder, f"{name}.vtt")
                with open(f"{target}.{os.getpid()}.part", "w", encoding="utf-8") as out:
                    out.write(vtt)
                os.replace(out.name, target)
                sizes.append(len(vtt.encode()))
            yield pd.DataFrame({"file": f[key].astype(str), "bytes": sizes})

    return spread(rendered.select(key, "vtt"), key).mapInPandas(run, "file string, bytes long")
