"""Substring deduplication: passages of ``WINDOW`` words that stand anywhere else, too.

A window's key for the sketch is the smallest hash among its grams of ``GRAM`` words (its anchor): equal
windows have equal anchors, so an anchor is selected at least as often as any of its windows occurs, and
counting anchors overestimates windows' counts with a twentieth of the keys. Each partition makes its sketch of the
anchors that it selects, as sorted 32-bit cells for both hash rows; merging adds the partitions' counts and
folds the cells to a width fit for the number of anchors (``CELLS`` a key, ``MAX_BITS`` at most: beyond that
more windows are taken for repeated, none is lost). The merged sketch keeps one bit a cell: counted twice.

The second pass hashes the windows whose anchor both rows count at least twice (128 bits each), brings equal anchors
together and groups the windows. What a stretch of texts repeats itself is settled before anything travels: of a passage
that a third of all documents share, only its first place in every stretch does. The windows' order in their documents comes back as spans of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, partitions, released
from .textops import U64, buffer, chunks, mix, window_hashes, word_hashes, words

WINDOW, GRAM = 50, 16
CELLS, MAX_BITS, SLICE_BITS = 8, 29, 6
_SALT = (U64(0x243F6A8885A308D3), U64(0x13198A2E03707344))
_TOP = U64(0xFFFFFFFFFFFFFFFF)
_OTHER = U64(0x452821E638D01377)
#: A window is known by two hashes of 64 bits, made of words hashed in two ways.
_KEY = np.dtype([("h", "<u8"), ("g", "<u8")])


def _slide(x: np.ndarray, n: int, of) -> np.ndarray:  # noqa: ANN001
    """of (minimum or maximum) over x[i:i+n] for every i, in log n steps."""
    done = 1
    while done < n:
        step = min(done, n - done)
        x = of(x[:-step], x[step:])
        done += step
    return x


class Windows:
    """The windows of a batch of texts: words' hashes, anchors of all windows, and which are whole in one text."""

    def __init__(self, texts: pa.Array, window: int, gram: int) -> None:
        buf, offsets = buffer(pc.utf8_lower(texts))
        start, end, self.first = words(buf, offsets)
        self.h, self.window, self.gram = word_hashes(buf, start, end), window, gram
        n = len(self.h)
        self.ok = np.zeros(0, bool)
        if n < window:
            return
        last = np.repeat(self.first[1:], np.diff(self.first))  # past the last word of the text of each word
        place = np.arange(n)
        self.grams = window_hashes(self.h, gram)
        self.grams[place[: n - gram + 1] + gram > last[: n - gram + 1]] = _TOP
        self.anchor = _slide(self.grams, window - gram + 1, np.minimum)
        self.ok = place[: n - window + 1] + window <= last[: n - window + 1]

    def anchors(self) -> np.ndarray:
        """Hashes of the grams that are the smallest of some window, one for each place."""
        if not self.ok.any():
            return np.empty(0, U64)
        n = self.window - self.gram
        m = np.concatenate([np.zeros(n, U64), np.where(self.ok, self.anchor, U64(0)), np.zeros(n, U64)])
        return self.grams[_slide(m, n + 1, np.maximum) == self.grams]


def _cells(anchors: np.ndarray) -> list[np.ndarray]:
    return [(mix(anchors ^ s) >> U64(32)).astype(np.uint32) for s in _SALT]


_PART = "row int, slice int, ones binary, twos binary, keys long"


def _sketches(window: int, gram: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Windows(b.column("text"), window, gram).anchors() for batch in batches for b in chunks(batch, "text")]
        anchors = np.concatenate(held) if held else np.empty(0, U64)
        for row, cells in enumerate(_cells(anchors)):
            cells, count = np.unique(cells, return_counts=True)
            part = cells >> np.uint32(32 - SLICE_BITS)
            for s in np.unique(part).tolist():
                a, b = np.searchsorted(part, [s, s + 1])
                some, many = cells[a:b], count[a:b] > 1
                cols = ([row], [s], [some[~many].tobytes()], [some[many].tobytes()], [len(anchors) if row == 0 and s == part[0] else 0])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64()))], ["row", "slice", "ones", "twos", "keys"])

    return run


def repeated_cells(parts: DataFrame, bits: int) -> list[np.ndarray]:
    """For both hash rows the cells, packed to bits, that the merged sketch counts at least twice."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for row, s, ones, twos in zip(*(b.column(i).to_pylist() for i in range(4))):
                c = counts.setdefault((row, s), np.zeros(1 << max(3, bits - SLICE_BITS), np.uint8))
                for blob, times in ((ones, 1), (twos, 2)):
                    # cells of one partition can fold onto one, so they are counted again
                    at = (np.frombuffer(blob, np.uint32) & np.uint32((1 << (32 - SLICE_BITS)) - 1)) >> np.uint32(32 - bits)
                    at, n = np.unique(at, return_counts=True)
                    c[at] = np.minimum(c[at].astype(np.int64) + n * times, 2)
        for (row, s), c in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([s], pa.int32()), pa.array([np.packbits(c >= 2).tobytes()], pa.binary())], ["row", "slice", "bits"])

    out = [np.zeros(1 << (bits - 3), np.uint8) for _ in _SALT]
    width = 1 << (bits - SLICE_BITS - 3)
    for r in parts.repartition(2 << SLICE_BITS, "row", "slice").mapInArrow(released(merge), "row int, slice int, bits binary").collect():
        out[r["row"]][r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)
    return out


def _repeated(anchors: np.ndarray, maps: list[np.ndarray], bits: int) -> np.ndarray:
    hit = np.ones(len(anchors), bool)
    for cells, m in zip(_cells(anchors), maps):
        at = cells >> np.uint32(32 - bits)
        hit &= (m[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return hit


_REC = np.dtype([("doc", "<i8"), ("at", "<i4"), ("n", "<i4"), ("twice", "<i4")])
_SPAN = np.dtype([("doc", "<i8"), ("kind", "<i4"), ("start", "<i4"), ("end", "<i4")])


def _spans(doc: np.ndarray, at: np.ndarray, kind: int, window: int) -> np.ndarray:
    """The stretches that windows at these places cover, windows one after the other joined."""
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order]
    head = np.ones(len(doc), bool)
    head[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + 1)
    h = np.flatnonzero(head)
    out = np.empty(len(h), _SPAN)
    out["doc"], out["kind"], out["start"] = doc[h], kind, at[h]
    out["end"] = at[np.append(h[1:], len(doc)) - 1] + window if len(h) else 0
    return out


def _expanded(rec: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(record, document, place) of each of the records' windows."""
    n = rec["n"].astype(np.int64)
    which = np.repeat(np.arange(len(rec)), n)
    return which, rec["doc"][which], rec["at"][which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)


def _emit_windows(maps, bits: int, buckets: int, window: int, gram: int):  # noqa: ANN001, ANN202
    def row(k: int, recs: np.ndarray, hashes: bytes | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([recs.tobytes()], pa.binary()), pa.array([hashes], pa.binary())], ["bucket", "recs", "hashes"])

    def flush(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        """Each window that these texts hold travels once; its later places here are repetitions already."""
        bucket, rec, key = (np.concatenate([x[i] for x in held]) for i in range(3))
        which, doc, at = _expanded(rec)
        order = np.lexsort((at, doc, key["g"], key["h"]))
        head = np.append(True, key[order][1:] != key[order][:-1])
        later = order[~head]
        spans = np.concatenate([_spans(doc[later], at[later], kind, window) for kind in (0, 1)])
        to = (mix(spans["doc"].astype(U64)) % U64(buckets)).astype(np.int64)
        for k in np.unique(to).tolist():
            yield row(k, spans[to == k], None)
        twice = np.zeros(len(key), np.int32)
        twice[order[head]] = np.diff(np.append(np.flatnonzero(head), len(order))) > 1
        left = np.sort(order[head])
        begin = np.append(True, (np.diff(left) != 1) | (np.diff(which[left]) != 0) | (np.diff(twice[left]) != 0))
        start = np.flatnonzero(begin)
        runs = np.empty(len(start), _REC)
        runs["doc"], runs["at"], runs["twice"] = doc[left[start]], at[left[start]], twice[left[start]]
        runs["n"] = np.diff(np.append(start, len(left)))
        bucket, hashes = bucket[which[left[start]]], key[left]
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            mine = order[cuts[k] : cuts[k + 1]]
            n = runs["n"][mine].astype(np.int64)
            yield row(k, runs[mine], hashes[np.repeat(start[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())].tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for b in chunks(batch, "text"):
                w = Windows(b.column("text"), window, gram)
                if not w.ok.any():
                    continue
                head = w.ok.copy()  # where a stretch of windows with one anchor begins
                head[1:] &= (w.anchor[1:] != w.anchor[:-1]) | ~w.ok[:-1]
                at = np.flatnonzero(head)
                stop = np.append(at[1:], len(head))
                bad = np.flatnonzero(~w.ok)
                if len(bad):
                    nxt = np.append(bad, len(head))[np.searchsorted(bad, at)]
                    stop = np.minimum(stop, nxt)
                keep = _repeated(w.anchor[at], maps, bits)
                at, stop = at[keep], stop[keep]
                if not len(at):
                    continue
                doc = np.searchsorted(w.first, at, "right") - 1
                rec = np.empty(len(at), _REC)
                rec["doc"] = b.column("id").to_numpy()[doc]
                rec["at"], rec["n"], rec["twice"] = at - w.first[doc], stop - at, 0
                place = np.repeat(at - (np.cumsum(rec["n"]) - rec["n"]), rec["n"]) + np.arange(rec["n"].sum())
                hashes = np.empty(len(place), _KEY)
                hashes["h"] = window_hashes(w.h, window)[place]
                hashes["g"] = window_hashes(mix(w.h ^ _OTHER), window)[place]
                held.append(((mix(w.anchor[at]) % U64(buckets)).astype(np.int64), rec, hashes))
                size += len(hashes)
                if size > 500_000:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return run


def _group(window: int):  # noqa: ANN202
    def batch(spans: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(spans[f])) for f in ("doc", "kind", "start", "end")], ["doc_id", "kind", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recs: dict[int, list[bytes]] = {}
        hashes: dict[int, list[bytes]] = {}
        for b in batches:
            for k, r, h in zip(*(b.column(i).to_pylist() for i in range(3))):
                if h is None:
                    yield batch(np.frombuffer(r, _SPAN))
                    continue
                recs.setdefault(k, []).append(r)
                hashes.setdefault(k, []).append(h)
        for k in sorted(recs):
            rec = np.frombuffer(b"".join(recs.pop(k)), _REC)
            h = np.frombuffer(b"".join(hashes.pop(k)), _KEY)
            which, doc, at = _expanded(rec)
            order = np.lexsort((at, doc, h["g"], h["h"]))
            same = h[order][1:] == h[order][:-1]
            twice = rec["twice"][which] > 0
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            later = order[1:][same]
            yield batch(_spans(doc[twice], at[twice], 0, window))
            yield batch(_spans(doc[later], at[later], 1, window))

    return run


def repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, spans, repeated_words, cut_spans, cut_words) of each document that has a repeated window.

    Words are lower-cased runs of letters and digits, counted from 0; spans are [start, end) over words and joined
    where they overlap or touch. ``spans``
    covers all windows that occur more than once in the table, ``cut_spans`` those that occurred before, in an
    earlier document (by doc_id) or earlier in the same one: removing these leaves every passage once. Texts
    shorter than a window, empty and null ones have none, very long ones are read whole; rows with a null doc_id are left out. Repeated rows
    count as occurrences and share the one result row of their doc_id, where their places fall together. An
    empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    todo = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    parts = cut(todo.select("text").mapInArrow(released(_sketches(window, gram)), _PART), "sketches")
    keys = parts.agg(F.sum("keys")).first()[0] or 0
    bits = min(MAX_BITS, max(SLICE_BITS + 6, int(np.ceil(np.log2(CELLS * max(keys, 1))))))
    maps = spark.sparkContext.broadcast(repeated_cells(parts, bits))
    buckets = partitions(spark)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _emit_windows(maps.value, bits, buckets, window, gram)(batches)

    sent = todo.mapInArrow(released(emit), "bucket int, recs binary, hashes binary").repartition(buckets, "bucket")
    pieces = sent.mapInArrow(released(_group(window)), "doc_id long, kind int, start int, end int")
    before = Window.partitionBy("doc_id", "kind").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    gap = pieces.withColumn("open", (F.col("start") > F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int"))
    upto = Window.partitionBy("doc_id", "kind").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    merged = gap.withColumn("island", F.sum("open").over(upto)).groupBy("doc_id", "kind", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    of = lambda k: F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("start", "end"))))
    long = lambda k: F.sum(F.when(F.col("kind") == k, F.col("end") - F.col("start")).otherwise(0)).cast("long")
    return merged.groupBy("doc_id").agg(of(0).alias("spans"), long(0).alias("repeated_words"), of(1).alias("cut_spans"), long(1).alias("cut_words"))
