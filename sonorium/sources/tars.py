"""Tar archives of samples: a Python data source that reads one archive a partition, and a writer of planned shards."""

from __future__ import annotations

import glob
import io
import os
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "archive string, key string, json string, audio binary"


class TarReader(DataSourceReader):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        """Samples in the archive's order: members that share a name but for its extension are one."""
        key, sample = None, {}
        with tarfile.open(partition.value, "r|*") as tar:
            for m in tar:
                if not m.isfile():
                    continue
                base, _, kind = m.name.rpartition(".")
                if base != key and key is not None:
                    yield partition.value, key, sample.get("json"), sample.get("audio")
                    sample = {}
                key, data = base, tar.extractfile(m).read()
                sample["json" if kind == "json" else "audio"] = data.decode() if kind == "json" else data
        if key is not None:
            yield partition.value, key, sample.get("json"), sample.get("audio")


class TarSource(DataSource):
    """``spark.read.format("samples_tar").load(glob)``."""

    @classmethod
    def name(cls) -> str:
        return "samples_tar"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> DataSourceReader:
        return TarReader(sorted(glob.glob(self.options["path"])))


def write_shards(planned: DataFrame, folder: str, dry_run: bool = False) -> DataFrame:
    """(shard_name, samples, bytes) of planned members (shard_name, sample_index, path, mtime, audio_member, json_member, payload).

    Each shard is one group of a task. It is written under a name of the attempt's own and then renamed, so a task
    that runs again leaves one whole archive. folder must be one that all executors share. A dry run makes no folder.
    """

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("sample_index")
        name, total = f["shard_name"].iloc[0], 0
        target = os.path.join(folder, name)
        part = f"{target}.{os.getpid()}.part"
        if not dry_run:
            os.makedirs(folder, exist_ok=True)
        tar = None if dry_run else tarfile.open(part, "w")
        for path, audio, js, payload, mtime in zip(f["path"], f["audio_member"], f["json_member"], f["payload"], f["mtime"]):
            data = payload.encode()
            total += os.path.getsize(path) + len(data)
            if tar:
                tar.add(path, arcname=audio)
                info = tarfile.TarInfo(js)
                info.size, info.mtime = len(data), int(mtime)
                tar.addfile(info, io.BytesIO(data))
        if tar:
            tar.close()
            os.replace(part, target)
        return pd.DataFrame({"shard_name": [name], "samples": [len(f)], "bytes": [total]})

    cols = ["shard_name", "sample_index", "path", "mtime", "audio_member", "json_member", "payload"]
    return planned.select(*cols).groupBy("shard_name").applyInPandas(run, "shard_name string, samples long, bytes long")
