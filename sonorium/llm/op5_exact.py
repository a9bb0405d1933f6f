"""Exact deduplication by a tree merge of sorted digest runs.

Every input partition sorts its (64-bit digest, verifier, smallest id) entries into one run, cut into slices of the
digest range and, in these, into blocks of ``BLOCK`` entries. Partitions then exchange runs in binomial
rounds: in round r the holders whose numbers agree but for their r-th bit merge theirs at the lower of them,
slice by slice (``fan_in`` above 2 merges as many holders at once, in fewer rounds). A merge streams: blocks arrive in the
order of their first digests, whatever lies below the next block's first digest is final, and no more than a
block of each run is held. Runs are merged by binary searches in one another, never sorted again. Of the
entries equal in digest *and* verifier (SHA-256 and byte length) each merge keeps the smallest identifier, so 64-bit
collisions never join different texts. Only digests travel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, partitions, released, remove_rows

FAN_IN = 2
#: Entries of a block, 60 bytes each.
BLOCK = 1 << 16
_SCHEMA = "slice int, holder int, first long, run binary"
#: SHA-256 is held as four integers (a, b, c, e).
_RUN = np.dtype([("d", "<i8"), ("a", "<u8"), ("b", "<u8"), ("c", "<u8"), ("e", "<u8"), ("n", "<i8"), ("id", "<i8"), ("copies", "<i4")])


def merged(runs: list[np.ndarray]) -> np.ndarray:
    """One run of several that are sorted by digest, by their places in one another."""
    runs = [r for r in runs if len(r)]
    while len(runs) > 1:  # neighbours pair up, as equal digests stay in the runs' order
        done = []
        for x, y in zip(runs[::2], runs[1::2]):
            out = np.empty(len(x) + len(y), _RUN)
            out[np.arange(len(x)) + np.searchsorted(y["d"], x["d"], "left")] = x
            out[np.arange(len(y)) + np.searchsorted(x["d"], y["d"], "right")] = y
            done.append(out)
        runs = done + runs[len(done) * 2 :]
    return runs[0] if runs else np.empty(0, _RUN)


def least_of_equals(x: np.ndarray) -> np.ndarray:
    """Of a run's entries with equal digest and verifier the smallest id.

    ``copies`` counts the rows that had exactly this id and text, so repeated rows are told apart from copies. Only
    where different verifiers share a digest are entries put in order among themselves.
    """
    if not len(x):
        return x
    near = x["d"][1:] == x["d"][:-1]
    other = np.zeros(len(x) - 1, bool)
    for f in ("a", "b", "c", "e", "n"):
        other |= x[f][1:] != x[f][:-1]
    if (near & other).any():
        group = np.concatenate([[0], np.cumsum(~near)])
        mixed = np.flatnonzero(np.isin(group, group[1:][near & other]))
        y = x[mixed]
        x = x.copy()
        x[mixed] = y[np.lexsort((y["n"], y["e"], y["c"], y["b"], y["a"], y["d"]))]
    same = np.zeros(len(x), bool)
    same[1:] = x["d"][1:] == x["d"][:-1]
    for f in ("a", "b", "c", "e", "n"):
        same[1:] &= x[f][1:] == x[f][:-1]
    head = np.flatnonzero(~same)
    group = np.cumsum(~same) - 1
    out = x[head]
    out["id"] = np.minimum.reduceat(x["id"], head)
    out["copies"] = np.bincount(group, np.where(x["id"] == out["id"][group], x["copies"], 0), len(head)).astype(np.int32)
    return out


def merge_runs(runs: list[np.ndarray]) -> np.ndarray:
    """One run of several, keeping the smallest id of each verified text."""
    return least_of_equals(merged(runs))


def _emit(slice_: int, holder: int, x: np.ndarray, block: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(x), block):
        part = x[at : at + block]
        cols = ((slice_, pa.int32()), (holder, pa.int32()), (int(part["d"][0]), pa.int64()), (part.tobytes(), pa.binary()))
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in cols], ["slice", "holder", "first", "run"])


def _leaf(slices: int, block: int):  # noqa: ANN202
    edges = np.array([(-1 << 63) + (i << 64) // slices for i in range(1, slices)], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        holder, held = TaskContext.get().partitionId(), []
        for b in batches:
            x = np.empty(b.num_rows, _RUN)
            x["d"], x["n"], x["id"] = (b.column(k).to_numpy(zero_copy_only=False) for k in ("d", "n", "id"))
            sha = np.frombuffer(b"".join(b.column("sha").to_pylist()), "<u8").reshape(-1, 4)
            for i, f in enumerate(("a", "b", "c", "e")):
                x[f] = sha[:, i]
            x["copies"] = 1
            held.append(least_of_equals(x[np.argsort(x["d"], kind="stable")]))
        x = merge_runs(held)
        cuts = [0, *np.searchsorted(x["d"], edges).tolist(), len(x)]
        for s, (a, z) in enumerate(zip(cuts, cuts[1:])):
            yield from _emit(s, holder, x[a:z], block)

    return run


def _merge(block: int):  # noqa: ANN202
    """Blocks come by slice and holder, in the order of their first digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, pending = None, np.empty(0, _RUN)
        done: list[np.ndarray] = []

        def rows(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal done
            if here is not None and done and (final or sum(map(len, done)) >= block):
                yield from _emit(*here, np.concatenate(done), block)
                done = []

        for b in batches:
            for s, to, first, blob in zip(*(b.column(k).to_pylist() for k in ("slice", "to", "first", "run"))):
                if (s, to) != here:
                    done.append(pending)
                    yield from rows(True)
                    here, pending = (s, to), np.empty(0, _RUN)
                at = int(np.searchsorted(pending["d"], first))
                if at:
                    done.append(pending[:at])
                    yield from rows(False)
                pending = merge_runs([pending[at:], np.frombuffer(blob, _RUN)])
        done.append(pending)
        yield from rows(True)

    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for run in b.column("run").to_pylist():
            x = np.frombuffer(run, _RUN)
            sha = np.stack([x["a"], x["b"], x["c"], x["e"]], 1).astype("<u8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(x["d"]), pa.array([sha[i : i + 32] for i in range(0, len(sha), 32)], pa.binary()), pa.array(x["n"]), pa.array(x["id"]), pa.array(x["copies"])],
                ["d", "sha", "n", "keep_id", "copies"],
            )


def digests(docs: DataFrame, bits: int = 64) -> DataFrame:
    """(d, sha, n, id, mark) of the documents that have a text and an id; fewer bits force collisions, for tests."""
    d = F.xxhash64(F.col("text").cast("string"))
    return docs.select(
        (d if bits == 64 else F.pmod(d, F.lit(1 << bits))).alias("d"), F.unhex(F.sha2(F.col("text"), 256)).alias("sha"), F.octet_length("text").cast("long").alias("n"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("mark"), F.col("text").isNotNull().alias("ok")
    ).filter("ok AND id IS NOT NULL").drop("ok")


def kept(docs: DataFrame, fan_in: int = FAN_IN, bits: int = 64, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(every document's digest entry, the merged entries): the result of the last round, one row a text."""
    spark = docs.sparkSession
    slices = max(1, partitions(spark))
    every = cut(digests(docs, bits), "digests")
    leaves = max(1, every.rdd.getNumPartitions())
    runs = every.mapInArrow(released(_leaf(slices, block)), _SCHEMA)
    while leaves > 1:
        to = F.floor(F.col("holder") / fan_in).cast("int")
        placed = runs.select("slice", to.alias("to"), "first", "run").repartition(slices, "slice", "to").sortWithinPartitions("slice", "to", "first")
        runs = placed.mapInArrow(released(_merge(block)), _SCHEMA)
        leaves = -(-leaves // fan_in)
    return every, runs.mapInArrow(released(_entries), "d long, sha binary, n long, keep_id long, copies int")


def exact_duplicates(docs: DataFrame, fan_in: int = FAN_IN, bits: int = 64, block: int = BLOCK) -> DataFrame:
    """(doc_id, keep_id, is_duplicate) of every row of docs.

    keep_id is the smallest doc_id among the rows with exactly this text (empty text included); a row is a
    duplicate if its id is another. Rows with a null text or a null doc_id match nothing and keep their own id.
    Repeated rows of one id and text are listed as often as they occur and are no duplicates by id. Very
    long texts are digested whole. An empty table gives no rows; other columns are ignored.
    """
    every, last = kept(docs, fan_in, bits, block)
    found = every.join(last, ["d", "sha", "n"]).select(F.col("id").alias("doc_id"), "keep_id")
    rest = docs.filter(F.col("text").isNull() | F.col("doc_id").isNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("doc_id").cast("long").alias("keep_id"))
    out = found.unionByName(rest)
    return out.select("doc_id", "keep_id", F.coalesce(F.col("doc_id") != F.col("keep_id"), F.lit(False)).alias("is_duplicate"))


def drop_exact_duplicates(docs: DataFrame, fan_in: int = FAN_IN, bits: int = 64) -> DataFrame:
    """docs without the rows whose text a smaller doc_id has, all columns kept.

    Of rows that repeat both doc_id and text one stays. Rows with a null text or doc_id stay as they are,
    very long texts are digested whole, an empty table gives an empty table.
    """
    every, last = kept(docs, fan_in, bits)
    last = cut(last, "merged")
    found = every.join(last, ["d", "sha", "n"]).select("id", F.col("mark"), F.col("keep_id"), F.when(F.col("id") == F.col("keep_id"), F.col("copies")).otherwise(1).alias("copies"))
    return remove_rows(docs, found.distinct(), "id <> keep_id")
