"""Archive shards by next-fit packing: the one operator whose running sum starts anew.

Packing is sequential, but a shard has at most so many samples: whatever stands before a chunk of the sorted rows, its
first fresh shard begins at one of its first rows. A chunk is therefore a small table, from the place of that row to
the shards begun and the state of the last; tables are composed in order, and all chunks are packed side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..functions.texts import json_payload, strip
from ..shared import written

SAMPLES, BYTES = 20, 1500 * 1024 * 1024


class Packer:
    """Next-fit over sizes that arrive in chunks; state is one open shard, whatever a group's size."""

    def __init__(self, samples: int, most: int, shard: int = 0, count: int = 0, total: int = 0) -> None:
        self.samples, self.most = samples, most
        self.shard, self.count, self.total = shard, count, total

    def take(self, sizes: np.ndarray) -> np.ndarray:
        """The shard of each size. One step a shard: its end is found in the running sum."""
        out = np.empty(len(sizes), np.int32)
        sums, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < len(sizes):
            base = sums[at - 1] if at else 0
            to = int(np.searchsorted(sums, base + self.most - self.total, "right"))
            to = min(to, at + self.samples - self.count)
            if to <= at and self.count == 0:
                to = at + 1  # larger than a shard: it has one of its own
            if to <= at:
                self.shard, self.count, self.total = self.shard + 1, 0, 0
                continue
            out[at:to] = self.shard
            self.count += to - at
            self.total += int(sums[to - 1] - base)
            at = to
        return out


def outlook(sizes: np.ndarray, samples: int, most: int) -> list[tuple[int, int, int]]:
    """For each place from 0 at which a chunk's first fresh shard can begin: (shards begun, rows and bytes of the last)."""
    n, sums = len(sizes), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    known: dict[int, tuple[int, int, int]] = {}  # by where a shard begins; most ways in soon meet
    for first in range(min(samples, n - 1) + 1):
        way, at = [], first
        while at < n and at not in known:
            to = min(n, at + samples, max(at + 1, int(np.searchsorted(sums, sums[at] + most, "right")) - 1))
            way.append((at, to))
            at = to
        for begin, end in reversed(way):
            known[begin] = (1, end - begin, int(sums[end] - sums[begin])) if end == n else (known[end][0] + 1, *known[end][1:])
    return [known[i] for i in range(min(samples, n - 1) + 1)]


def _groups(b: pa.RecordBatch, *names: str) -> Iterator[tuple[tuple, int, int]]:
    """((values of the columns), from, to) of a batch's stretches of equal values."""
    cols = [b.column(n).dictionary_encode() for n in names]
    codes = [c.indices.to_numpy(zero_copy_only=False) for c in cols]
    if b.num_rows:
        change = np.flatnonzero(np.any([np.diff(c) != 0 for c in codes], 0)) + 1
        for a, z in zip([0, *change.tolist()], [*change.tolist(), b.num_rows]):
            yield tuple(c.dictionary[int(k[a])].as_py() for c, k in zip(cols, codes)), a, z


def _sizes(b: pa.RecordBatch, size: str) -> np.ndarray:
    return b.column(size).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)


_TABLE = "_part long, _group string, rows long, bytes long, firsts array<long>, begun array<long>, last_rows array<long>, last_bytes array<long>"
_ENTRY = "_part long, _group string, _shard int, _count int, _total long, _index long"


def _summaries(size: str, samples: int, most: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []

        def table() -> Iterator[pa.RecordBatch]:
            if here is not None:
                x = np.concatenate(held)
                begun, rows, total = zip(*outlook(x, samples, most))
                cols = (here[0], here[1], len(x), int(x.sum()), x[:samples].tolist(), list(begun), list(rows), list(total))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 4]
                yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cols, kinds)], [c.split()[0] for c in _TABLE.split(", ")])

        for b in batches:
            sizes = _sizes(b, size)
            for key, a, z in _groups(b, "_part", "_group"):
                if key != here:
                    yield from table()
                    here, held = key, []
                held.append(sizes[a:z])
        yield from table()

    return run


def _entries(samples: int, most: int):  # noqa: ANN202
    """The packing's state before each chunk, from the chunks' tables in order; a row a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = None
        shard = count = total = index = 0
        for b in batches:
            out = []
            for part, group, rows, size, firsts, begun, last_rows, last_bytes in zip(*(c.to_pylist() for c in b.columns)):
                if group != here:
                    here, shard, count, total, index = group, 0, 0, 0, 0
                out.append((part, group, shard, count, total, index))
                fit = min(int(np.searchsorted(np.cumsum(firsts), most - total, "right")), samples - count) if count else 0
                if fit >= rows:
                    count, total = count + rows, total + size
                else:
                    shard += begun[fit] - (0 if count else 1)
                    count, total = last_rows[fit], last_bytes[fit]
                index += rows
            if out:
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [c.split()[0] for c in _ENTRY.split(", ")])

    return run


def pack(df: DataFrame, group: str, order: list[str], size: str, samples: int = SAMPLES, most: int = BYTES) -> DataFrame:
    """df with (shard, sample_index): shards of each group in order, closed at so many samples or before so many bytes.

    Rows are range-partitioned by group and order and written once; every partition's stretch of a group is a chunk.
    Chunks are packed in parallel, from states composed of their tables, so that a group may fill any number of
    tasks. Null sizes count as 0. Columns named _part, _in, _group, _shard, _count, _total or _index aren't allowed.
    """
    if samples < 1 or most < 1:
        raise ValueError("caps must be positive")
    keyed = df.withColumn("_group", F.coalesce(F.col(group).cast("string"), F.lit("\0")))
    ranged = keyed.repartitionByRange("_group", *order).sortWithinPartitions("_group", *order).withColumn("_at", F.monotonically_increasing_id())
    rows = written(ranged, "packed").withColumn("_part", F.shiftrightunsigned("_at", 33)).withColumnRenamed("_at", "_in")
    chunked = lambda x: x.repartition("_part", "_group").sortWithinPartitions("_part", "_group", "_in")
    tables = chunked(rows.select("_part", "_group", "_in", size)).mapInArrow(_summaries(size, samples, most), _TABLE)
    entries = tables.repartition("_group").sortWithinPartitions("_group", "_part").mapInArrow(_entries(samples, most), _ENTRY)

    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, packer, index = None, Packer(samples, most), 0
        for b in batches:
            sizes = _sizes(b, size)
            shard, idx = np.empty(b.num_rows, np.int32), np.empty(b.num_rows, np.int64)
            for key, a, z in _groups(b, "_part", "_group"):
                if key != here:
                    here = key
                    at, count, total, index = (b.column(c)[a].as_py() for c in ("_shard", "_count", "_total", "_index"))
                    packer = Packer(samples, most, at, count, total)
                shard[a:z] = packer.take(sizes[a:z])
                idx[a:z] = np.arange(index, index + z - a)
                index += z - a
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array(shard), pa.array(idx)], [*columns, "shard", "sample_index"])

    schema = StructType([*df.schema.fields, StructField("shard", IntegerType()), StructField("sample_index", LongType())])
    return chunked(rows.join(entries, ["_part", "_group"])).mapInArrow(run, schema)


def sort_key(df: DataFrame) -> DataFrame:
    """df of samples with the trimmed text columns that order them in a year: date, title, id, audio."""
    cols = {f"_{c}": strip(F.coalesce(F.col(c), F.lit(""))) for c in ("publish_date", "title", "id", "audio")}
    return df.withColumns(cols)


def plan_shards(samples: DataFrame, prefix: str, per_shard: int = SAMPLES, most: int = BYTES) -> DataFrame:
    """Members of every shard: (year, shard, shard_name, sample_index, audio_member, json_member, payload, ...).

    samples has the metadata columns, year, size_bytes and mtime.
    """
    keys = ["_publish_date", "_title", "_id", "_audio"]
    packed = pack(sort_key(samples), "year", keys, "size_bytes", per_shard, most).drop(*keys)
    base = F.format_string(f"{prefix}-%s-%06d", "year", "sample_index")
    fields = [c for c in samples.columns if c not in ("year", "size_bytes", "mtime", "path")]
    out = packed.withColumn("shard_name", F.format_string(f"{prefix}-%s-%05d.tar", "year", "shard")).withColumn("audio_member", F.concat(base, F.lit(".opus"))).withColumn("json_member", F.concat(base, F.lit(".json")))
    return out.withColumn("payload", json_payload({c: F.col("audio_member") if c == "audio" else F.col(c) for c in fields}))


def shard_sizes(planned: DataFrame) -> DataFrame:
    """(year, shard, samples, bytes) with the JSON members' bytes counted."""
    return planned.groupBy("year", "shard").agg(F.count("*").alias("samples"), F.sum(F.coalesce("size_bytes", F.lit(0)) + F.octet_length("payload")).alias("bytes"))
